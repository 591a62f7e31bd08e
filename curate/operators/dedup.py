"""Duplicate removal: exact copies, then conflicting versions of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

COPIES = "n_copies"
VARIANTS = "n_variants"


def dedup_exact(df: DataFrame) -> DataFrame:
    """One of each set of identical rows. Copies collapse before the shuffle,
    so a record repeated millions of times travels once per task."""
    return df.distinct()


def _total_order(df: DataFrame, key: str, latest: str, then: str) -> list[str]:
    rest = [c for c in df.columns if c not in (key, latest, then)]
    return [then, *rest]


def dedup_latest(df: DataFrame, key: str, latest: str, then: str) -> DataFrame:
    """One row per key: the latest ``latest`` (NULL last), then lowest ``then``.

    Remaining columns break remaining ties, so the winner never depends on the
    order rows arrive in, and exact copies need no separate pass. Spark limits
    each task to its best row per key before the shuffle, which keeps a key
    that holds much of the table harmless.
    """
    order = [F.col(latest).desc_nulls_last()]
    order += [F.col(c).asc_nulls_first() for c in _total_order(df, key, latest, then)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def exact_groups(df: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct rows with the number of copies of each.

    With ``key`` the rows are shuffled by that column alone. Copies still meet,
    and ``fold_versions`` by the same key then needs no shuffle of its own. Only
    for rows without a hot key: nothing collapses before this shuffle.
    """
    rows = df.repartition(key) if key else df
    return rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def fold_versions(groups: DataFrame, key: str, latest: str, then: str) -> DataFrame:
    """The rows of ``dedup_latest`` over ``exact_groups``, with the copies and
    the distinct versions each key had.

    The counts make a second pass over the raw rows unnecessary. Winner and
    counts are one aggregate, partly done before the shuffle: a window over all
    versions of a key could not be split if one key held most rows.
    """
    columns = [c for c in groups.columns if c != COPIES]
    plain = groups.drop(COPIES)
    rank: list[Column] = [
        F.col(latest).isNull().alias("_missing"),
        (-F.unix_date(F.col(latest))).alias("_recency"),
    ]
    rank += [F.col(c).alias(f"_{c}") for c in _total_order(plain, key, latest, then)]
    best = F.min(F.struct(*rank, F.col(latest).alias("_latest")))
    folded = groups.groupBy(key).agg(
        best.alias("_best"),
        F.sum(COPIES).alias(COPIES),
        F.count(F.lit(1)).alias(VARIANTS),
    )
    picked = [
        F.col(key) if c == key else F.col("_best._latest" if c == latest else f"_best._{c}").alias(c)
        for c in columns
    ]
    return folded.select(*picked, COPIES, VARIANTS)
