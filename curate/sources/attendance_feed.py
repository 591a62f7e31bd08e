"""A messy attendance feed derived from the star-schema tables.

One record per order plus exact repeats and later conflicting versions of some
orders, with the bad ages, mixed date formats, uncastable counts and counts
that do not add up which the cleansing steps exist for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curate.fixed_values import ATTENDANCE_HEADERS, SERIAL_DAY_EPOCH
from curate.functions.sizes import spread_small


def attendance_feed(spark: SparkSession, sf_dir: str, with_version: bool = False) -> DataFrame:
    """The feed under its raw headers, all text. ``with_version`` keeps a column
    ``version``: 0 the original, 1 an exact repeat, 2 a conflicting record."""
    orders = spread_small(
        spark.read.parquet(f"{sf_dir}/orders.parquet").select(
            F.col("o_orderkey").alias("ok"),
            F.col("o_orderdate").cast("date").alias("ordered"),
            "o_custkey",
            "o_orderpriority",
        )
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey"
    )
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    ok = F.col("ok")
    # Repeats come from one scan: an order is exploded into its versions.
    versions = F.array_compact(
        F.array(F.lit(0), F.when(ok % 50 == 0, 1), F.when(ok % 70 == 0, 2))
    )
    rows = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("version", F.explode(versions))
        .withColumn("d", F.date_add("ordered", F.when(F.col("version") == 2, 30).otherwise(0)))
        .withColumn("scheduled", 1 + ok % 10)
        .withColumn("attended", ok % (2 + ok % 10))
        .withColumn(
            "absent",
            F.col("scheduled") - F.col("attended") + F.when(ok % 13 == 0, 1).otherwise(0),
        )
    )
    age = (
        F.when(ok % 11 == 0, "thirty")
        .when(ok % 11 == 1, "150")
        .when(ok % 11 == 2, "-5")
        .when(ok % 11 == 3, "")
        .otherwise((14 + ok % 60).cast("string"))
    )
    serial = F.datediff("d", F.lit(SERIAL_DAY_EPOCH).cast("date")).cast("string")
    date_text = (
        F.when(ok % 10 == 4, "2024-13-45")
        .when(ok % 5 == 1, F.date_format("d", "dd/MM/yyyy"))
        .when(ok % 5 == 2, F.date_format("d", "yyyy/MM/dd"))
        .when(ok % 5 == 3, serial)
        .otherwise(F.date_format("d", "yyyy-MM-dd"))
    )
    values = [
        F.concat(F.lit("TST-"), ok.cast("string")),
        F.col("c_name"),
        age,
        F.col("n_name"),
        F.col("o_orderpriority"),
        date_text,
        F.when(ok % 97 == 0, "n/a").otherwise(F.col("scheduled").cast("string")),
        F.col("attended").cast("string"),
        F.col("absent").cast("string"),
    ]
    columns = [value.alias(header) for value, header in zip(values, ATTENDANCE_HEADERS)]
    return rows.select(*columns, *(["version"] if with_version else []))
