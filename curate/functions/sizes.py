"""Decisions that depend on how big an input really is."""

from __future__ import annotations

from pyspark.sql import DataFrame

MAX_BROADCAST_ROWS = 10_000


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as
    it is, for Spark to shuffle. Counting stops one row past the bound."""
    few = df.limit(max_rows + 1).count() <= max_rows
    return df.hint("broadcast") if few else df


def spread_small(df: DataFrame) -> DataFrame:
    """Spread an input of a single split over all cores.

    A table in one small file would otherwise keep every step up to the next
    shuffle on one core. One split is at most ``spark.sql.files.maxPartitionBytes``,
    so what is moved is bounded; larger inputs are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() == 1 else df
