"""Incremental ingest of new files, with the batch functions per micro-batch.

Every output is keyed by the batch number and replaced when a batch runs again
after a failure, so each input row counts exactly once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from curate.operators.dedup import COPIES, VARIANTS, dedup_latest
from curate.operators.headers import clean_headers
from curate.operators.quality import dq_report
from curate.plans.medallion import counted_records, flagged
from curate.sources.csv import MALFORMED, parted
from curate.streaming.merged import merge_batch, read_merged

DERIVED = ("age_clean", "is_age_valid", "dq_days_mismatch")


def _start(writer: DataStreamWriter, continuous: str | None) -> StreamingQuery:
    """All files there are, then stop; or ``continuous`` as trigger interval."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _needs_rejects(raw: DataFrame, rejects: str | None) -> None:
    if MALFORMED in raw.columns and not rejects:
        raise ValueError("a stream of lines needs a folder for the malformed ones")


def _keep_malformed(malformed: DataFrame | None, rejects: str | None, batch_id: int) -> DataFrame | None:
    """Write a batch's malformed lines under its number; gives the written table."""
    if malformed is None:
        return None
    path = f"{rejects}/batch_id={batch_id}"
    malformed.write.mode("overwrite").parquet(path)
    return malformed.sparkSession.read.schema(malformed.schema).parquet(path)


def ingest_bronze(
    raw: DataFrame, out: str, checkpoint: str, continuous: str | None = None, rejects: str | None = None
) -> StreamingQuery:
    """Append new records, under clean names and still all text, to a table.

    Given the lines of ``stream_lines``, what is no record goes to ``rejects`` with
    its text; both tables are then kept by batch, ``out`` in a folder of its own.
    """
    _needs_rejects(raw, rejects)
    if MALFORMED in raw.columns:

        def handle(batch: DataFrame, batch_id: int) -> None:
            records, malformed = parted(batch)
            _keep_malformed(malformed, rejects, batch_id)
            clean_headers(records).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        return _start(raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint), continuous)
    writer = (
        clean_headers(raw)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _start(writer, continuous)


def ingest_silver(
    raw: DataFrame,
    versions: str,
    dq_log: str,
    checkpoint: str,
    run_prefix: str,
    run_ts: datetime,
    continuous: str | None = None,
    rejects: str | None = None,
    table: str | None = None,
) -> StreamingQuery:
    """Clean each batch into its best record per key and report on it.

    Given the lines of ``stream_lines``, what is no record goes to ``rejects`` with
    its text, under the batch's number, and is counted in its report.

    A batch appends its own records and rewrites nothing: ``current_records``
    picks among the batches when read, and ``fold_batches`` merges them from
    time to time. The cost of a batch depends on the batch, not on the table.

    With ``table`` the batch is also merged into that table, which holds one record
    per key: of its hash buckets those are rewritten that the batch has keys in, and
    ``merged_records`` reads it as it is. That suits many reads between batches;
    ``versions`` then serves the report and may be removed up to the last batch.
    """

    _needs_rejects(raw, rejects)

    def handle(batch: DataFrame, batch_id: int) -> None:
        path = f"{versions}/batch_id={batch_id}"
        records, malformed = parted(batch)
        malformed = _keep_malformed(malformed, rejects, batch_id)
        counted_records(records).write.mode("overwrite").parquet(path)
        staged = batch.sparkSession.read.parquet(path)
        report = dq_report(staged, f"{run_prefix}-{batch_id}", run_ts, versions, malformed=malformed)
        report.write.mode("overwrite").parquet(f"{dq_log}/batch_id={batch_id}")
        if table:
            merge_batch(staged.drop(COPIES, VARIANTS, *DERIVED), table, batch_id, "fileno", "course_date", "applicant")

    writer = raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _start(writer, continuous)


def _merged(spark: SparkSession, versions: str, wanted: Column, folded: str | None) -> DataFrame:
    rows = spark.read.parquet(versions).where(wanted).drop("batch_id", COPIES, VARIANTS, *DERIVED)
    if folded:
        rows = rows.unionByName(spark.read.parquet(folded).drop(*DERIVED))
    return flagged(dedup_latest(rows, "fileno", "course_date", "applicant"))


def current_records(
    spark: SparkSession, versions: str, folded: str | None = None, after: int = -1
) -> DataFrame:
    """One flagged record per key over all batches so far.

    The best of the batches' bests is the best of all rows, because the order
    of versions is total. Batches up to ``after`` may be read from ``folded``.
    """
    return _merged(spark, versions, F.col("batch_id") > after, folded)


def merged_records(spark: SparkSession, table: str) -> DataFrame:
    """One flagged record per key, from the table that batches were merged into."""
    return flagged(read_merged(spark, table))


def fold_batches(
    spark: SparkSession,
    versions: str,
    through: int,
    out: str,
    folded: str | None = None,
    after: int = -1,
) -> None:
    """Merge the batches up to ``through``, and an earlier fold, into one record
    per key below a new folder. Readers then give it as ``folded``."""
    wanted = F.col("batch_id").between(after + 1, through)
    _merged(spark, versions, wanted, folded).write.mode("errorifexists").parquet(out)
