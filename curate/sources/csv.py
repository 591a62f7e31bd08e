"""Raw delimited files, every column read as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from curate.fixed_values import ATTENDANCE_HEADERS

BRONZE_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in ATTENDANCE_HEADERS])


MALFORMED = "_malformed"
MALFORMED_REASON = "malformed_record"


def _options(reader, schema: T.StructType, multi_line: bool):
    """A line of too many or too few fields, or with an open quote, is kept whole in
    ``MALFORMED``. All columns are parsed even if few are asked for: else such lines
    would pass unseen."""
    return (
        reader.schema(T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
    )


def read_lines(spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA, multi_line: bool = False) -> DataFrame:
    """Files with a header row, without type inference, and a column ``MALFORMED``
    with the text of what is no record (else NULL).

    Inference costs a pass over the data and gives other types for other days'
    files. ``enforceSchema`` is off so a file whose header differs fails loudly.
    ``multi_line`` allows line breaks within quotes; it is off by default so big
    files remain splittable, and torn records then count as malformed.
    """
    return _options(spark.read, schema, multi_line).csv(path)


def _where(lines: DataFrame, condition: Column) -> DataFrame:
    # Spark refuses scans of the malformed text alone, as a count would ask for; the
    # length of another column, which is never negative, makes it a second one.
    other = F.length(F.concat_ws("", F.col(f"`{lines.columns[0]}`")))
    return lines.where(condition & (other >= 0))


def records(lines: DataFrame) -> DataFrame:
    return _where(lines, F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(lines: DataFrame) -> DataFrame:
    """(record, reject_reason) of every line that is no record."""
    return _where(lines, F.col(MALFORMED).isNotNull()).select(
        F.col(MALFORMED).alias("record"), F.lit(MALFORMED_REASON).alias("reject_reason")
    )


def parted(lines: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``records`` and ``malformed`` of ``lines``; rows without the column of
    malformed text are all records, and there is no second part."""
    return (records(lines), malformed(lines)) if MALFORMED in lines.columns else (lines, None)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA, multi_line: bool = False) -> DataFrame:
    """The records of ``read_lines``; ``malformed`` gives the rest."""
    return records(read_lines(spark, path, schema, multi_line))


def stream_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BRONZE_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same files as a stream that picks up only those not yet seen."""
    reader = _options(spark.readStream, schema, False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def stream_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BRONZE_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The records of ``stream_lines``; ``malformed`` gives the rest."""
    return records(stream_lines(spark, path, schema, max_files_per_trigger))
