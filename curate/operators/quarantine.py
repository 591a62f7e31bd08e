"""Curated rows on one side, rejects with a reason on the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def quarantine(df: DataFrame, ok: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows where ``ok`` is TRUE, all other rows with ``reject_reason``).

    Two filters over one input: give it a written table where the input is
    expensive.
    """
    certain = F.coalesce(ok, F.lit(False))
    return df.where(certain), df.where(~certain).withColumn("reject_reason", F.lit(reason))
