"""Classification tags and masking, as properties of columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curate.fixed_values import MASK_TEXT


def tag_column(df: DataFrame, column: str, **tags: str) -> DataFrame:
    """Add tags to a column; they live in its field metadata, so they follow
    the column through projections and into parquet files."""
    metadata = {**df.schema[column].metadata, **tags}
    return df.withMetadata(column, metadata)


def column_tags(df: DataFrame) -> dict[str, dict[str, str]]:
    return {f.name: dict(f.metadata) for f in df.schema.fields if f.metadata}


def tagged_columns(df: DataFrame, classifications: Iterable[str]) -> list[str]:
    wanted = set(classifications)
    return [f.name for f in df.schema.fields if f.metadata.get("classification") in wanted]


def tag_table(spark: SparkSession, table: str, **tags: str) -> None:
    """Tags of a catalog table, as table properties."""
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def mask_columns(
    df: DataFrame,
    reader: bool | Column,
    classifications: Iterable[str] = ("PII",),
    mask: str = MASK_TEXT,
    untagged_ok: bool = False,
) -> DataFrame:
    """Replace the values of classified columns unless ``reader`` holds.

    ``reader`` may be a column, to decide row by row. Which columns are masked
    follows from their tags. A table without any such column is an error, since its
    tags may have been lost, unless ``untagged_ok``.
    """
    names = tagged_columns(df, classifications)
    if not names and not untagged_ok:
        raise ValueError(f"no column is tagged {', '.join(classifications)}")
    allowed = F.lit(reader) if isinstance(reader, bool) else reader
    masked = {}
    for name in names:
        value = F.when(allowed, F.col(name).cast("string")).otherwise(mask)
        masked[name] = value.alias(name, metadata=df.schema[name].metadata)
    return df.select(*[masked.get(c, F.col(c)) for c in df.columns])


def masked_view(
    spark: SparkSession,
    view: str,
    table: str,
    readers: str,
    classifications: Iterable[str] = ("PII",),
    mask: str = MASK_TEXT,
) -> None:
    """A view over a stored ``table`` (a name, or a folder of parquet) in which the
    values of classified columns show only to those whom the table ``readers``
    (column ``reader``) lists.

    Who asks is decided when the view is read, by ``current_user()``: a reader added
    to or taken from the list counts at once, and filters of a query see masked
    values, since the mask is part of the column. The view stays in the catalog,
    so the stored table can be kept from those who may read only the view. Columns
    are found by their tags in the stored schema; a table without any is an error.
    """
    stored = spark.read.parquet(table) if "/" in table else spark.table(table)
    names = set(tagged_columns(stored, classifications))
    if not names:
        raise ValueError(f"no column of {table} is tagged {', '.join(classifications)}")
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in stored.columns}
    text = mask.replace("\\", "\\\\").replace("'", "\\'")
    allowed = f"(SELECT count(*) > 0 FROM {readers} WHERE reader = current_user())"
    columns = ", ".join(
        f"element_at(array('{text}', CAST({q} AS STRING)), IF({allowed}, 2, 1)) AS {q}" if c in names else q
        for c, q in quoted.items()
    )
    source = f"parquet.`{table}`" if "/" in table else table
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {source}")
