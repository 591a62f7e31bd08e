"""Group-level rates, weighted and simple. They are different measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curate.fixed_values import RATE_SCALE
from curate.functions.rates import safe_rate


def weighted_rate(
    df: DataFrame,
    key: str,
    num: str = "days_attended",
    den: str = "number_of_days",
    exclude: Column | None = None,
) -> DataFrame:
    """Total over total per key, so a long course weighs more than a short one.

    ``exclude`` drops rows it is TRUE for (the strict variant). A group whose
    total is 0 or unknown has a NULL rate.
    """
    rows = df if exclude is None else df.where(~F.coalesce(exclude, F.lit(False)))
    totals = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("num_records"),
        F.sum(den).alias("total_scheduled_days"),
        F.sum(num).alias("total_attended_days"),
    )
    return totals.withColumn(
        "attendance_rate", safe_rate("total_attended_days", "total_scheduled_days")
    )


def simple_rate(df: DataFrame, key: str, rate: str = "attendance_rate") -> DataFrame:
    """Mean of the record rates per key, lowest first. Records without a rate
    count as records but not in the mean.

    Rates carry four decimals, so they are summed as decimals: the mean is exact
    and its rounding does not depend on the order of summation, as that of
    doubles would where the mean lies halfway between two results.
    """
    total = F.sum(F.col(rate).cast("decimal(14,4)"))
    rated = F.count(rate).cast("decimal(14,0)")
    means = df.groupBy(key).agg(
        F.round(F.try_divide(total, rated), RATE_SCALE).cast("double").alias("avg_attendance_rate"),
        F.count(F.lit(1)).alias("num_records"),
    )
    return means.orderBy("avg_attendance_rate", key)


def rank_groups(totals: DataFrame, key: str) -> DataFrame:
    """Group rates, lowest first."""
    return totals.select(key, "attendance_rate", "num_records").orderBy("attendance_rate", key)
