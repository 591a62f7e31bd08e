"""Row checks that flag and keep, never drop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def validate_range(df: DataFrame, column: str, low: int, high: int, out: str, flag: str) -> DataFrame:
    """``out``: the value as int where it lies in [low, high], else NULL;
    ``flag``: whether it does, FALSE for text that is no number or missing."""
    number = F.col(column).try_cast("int")
    inside = F.coalesce(number.between(low, high), F.lit(False))
    return df.withColumns({out: F.when(inside, number), flag: inside})


def _total(columns: Sequence[str]) -> Column:
    # Summed as bigint: two large ints would overflow and fail the job.
    return reduce(lambda a, b: a + b, [F.col(c).cast("bigint") for c in columns])


def flag_reconcile(df: DataFrame, parts: Sequence[str], total: str, flag: str) -> DataFrame:
    """``flag`` is TRUE where the parts do not add up to the total or any of
    them is missing."""
    return df.withColumn(flag, F.coalesce(_total(parts) != F.col(total), F.lit(True)))
