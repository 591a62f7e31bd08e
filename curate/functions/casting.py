"""Casts that turn bad text into NULL instead of failing the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def safe_cast(df: DataFrame, columns: Sequence[str], to: str = "int") -> DataFrame:
    """Cast ``columns`` in place; text that is not castable becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(to) for name in columns})
