"""From raw attendance records to silver, rejects and gold."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from curate import fixed_values as fixed
from curate.functions.casting import safe_cast
from curate.functions.dates import parse_mixed_date
from curate.functions.rates import band, exact_rate, safe_rate
from curate.operators.aggregate import weighted_rate
from curate.operators.dedup import dedup_latest, exact_groups, fold_versions
from curate.operators.governance import masked_view
from curate.operators.headers import clean_headers
from curate.operators.quality import dq_report
from curate.operators.quarantine import quarantine
from curate.operators.validate import flag_reconcile, validate_range
from curate.sources.csv import MALFORMED_REASON, parted
from curate.sources.tables import append_log, layer_path, publish_run, published_runs

DAY_COLUMNS = ("number_of_days", "days_attended", "days_absent")


def typed(raw: DataFrame) -> DataFrame:
    """Clean names, day counts as int. These nine columns are all a record has:
    later columns derive from them, so duplicates are decided on them alone."""
    return safe_cast(clean_headers(raw), DAY_COLUMNS, "int")


def dated(records: DataFrame) -> DataFrame:
    return records.withColumn("course_date", parse_mixed_date("course_date_raw"))


def flagged(records: DataFrame) -> DataFrame:
    """Age and day-count flags; narrow, so they come after deduplication."""
    aged = validate_range(
        records, "age_raw", fixed.AGE_MIN, fixed.AGE_MAX, out="age_clean", flag="is_age_valid"
    )
    return flag_reconcile(aged, ("days_attended", "days_absent"), "number_of_days", "dq_days_mismatch")


def latest_records(raw: DataFrame) -> DataFrame:
    """One flagged record per fileno, in one shuffle. Exact copies tie with each
    other, so picking one version per key removes them too."""
    return flagged(dedup_latest(dated(typed(raw)), "fileno", "course_date", "applicant"))


def counted_records(raw: DataFrame, even_keys: bool = False) -> DataFrame:
    """The same records with the copies and versions each had, for the report.

    Counting copies exactly takes a shuffle of whole rows, and folding versions
    per key another; both collapse what they can beforehand, so hot keys do no
    harm. Where a caller knows that keys are even, one shuffle by key serves
    both. The plan is the same at every size, and building it runs nothing.
    """
    groups = exact_groups(typed(raw), key="fileno" if even_keys else None)
    return flagged(fold_versions(dated(groups), "fileno", "course_date", "applicant"))


def split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, rejects) by whether the course date could be read."""
    good, bad = quarantine(records, F.col("course_date").isNotNull(), fixed.REJECT_REASON)
    return good.select(*fixed.SILVER_COLUMNS), bad.select(*fixed.REJECT_COLUMNS, "reject_reason")


def all_rejects(rejects: DataFrame, malformed: DataFrame | None) -> DataFrame:
    """``rejects`` and the malformed lines, these with nothing but their text as
    ``record``. Every line is kept, repeated ones too, so that counts add up."""
    rows = rejects.withColumn("record", F.lit(None).cast("string"))
    return rows if malformed is None else rows.unionByName(malformed, allowMissingColumns=True)


def gold_records(silver: DataFrame) -> DataFrame:
    """Silver without its quality flags, with rate and band."""
    return silver.drop("is_age_valid", "dq_days_mismatch").withColumns(
        {
            "attendance_rate": safe_rate("days_attended", "number_of_days"),
            "attendance_band": band(exact_rate("days_attended", "number_of_days")),
        }
    )


@dataclass(frozen=True)
class Layers:
    """Paths of everything a run writes. The log is shared by all runs."""

    root: str
    run: str

    def _table(self, layer: str, table: str) -> str:
        return f"{layer_path(self.root, layer, table)}/{self.run}"

    @property
    def staged(self) -> str:
        return self._table("silver", "staged")

    @property
    def silver(self) -> str:
        return self._table("silver", "training")

    @property
    def rejects(self) -> str:
        return self._table("silver", "training_rejects")

    @property
    def records(self) -> str:
        return self._table("gold", "training_records")

    @property
    def by_branch(self) -> str:
        return self._table("gold", "attendance_by_branch")

    @property
    def by_course(self) -> str:
        return self._table("gold", "attendance_by_course")

    @property
    def dq_log(self) -> str:
        return layer_path(self.root, "governance", "dq_run_log")


def current_layers(spark: SparkSession, root: str) -> Layers:
    """The tables of the last run that was finished below ``root``, all of one run."""
    runs = published_runs(spark, root)
    if not runs:
        raise FileNotFoundError(f"no finished run below {root}")
    return Layers(root, runs[-1])


def drop_old_runs(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the tables of all but the newest ``keep`` published runs; gives their
    names. Readers of older runs must be done; unpublished runs are left alone."""
    old = [run for run in published_runs(spark, root)[:-keep] if run not in published_runs(spark, root)[-keep:]]
    for run in old:
        out = Layers(root, run)
        for path in (out.staged, out.silver, out.rejects, out.records, out.by_branch, out.by_course):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return old


def _together(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Jobs that need nothing of each other, side by side, so that one's last tasks
    do not leave cores idle. The first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for future in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            future.result()


def build_layers(
    spark: SparkSession, raw: DataFrame, root: str, run_id: str, run_ts: datetime
) -> Layers:
    """Read ``raw``, write every table of a run below ``root``, then publish the run.

    Given the lines of ``read_lines``, what is no record goes to the rejects with
    its text and is counted in the report; that is a second read of the files. Rows
    of ``read_bronze`` are records only, read once.

    The deduplicated records are written first: silver, rejects, gold and the
    quality report all read that table, so they agree with each other, and a
    lost executor costs a re-read instead of a second pass over the raw files.

    Tables lie in folders of the run, which ``current_layers`` finds once all of
    them are whole: a run that fails midway leaves readers the one before, and
    nobody meets tables of two runs.
    """
    out = Layers(root, f"{re.sub('[^A-Za-z0-9_.-]', '_', run_id)}-{uuid.uuid4().hex[:8]}")
    records, malformed = parted(raw)
    counted_records(records).write.parquet(out.staged)
    staged = spark.read.parquet(out.staged)
    silver, rejects = split(staged)
    _together(
        spark,
        lambda: all_rejects(rejects, malformed).write.parquet(out.rejects),
        lambda: silver.write.parquet(out.silver),
    )
    stored = spark.read.parquet(out.silver)
    if malformed is not None:
        malformed = spark.read.parquet(out.rejects).where(F.col("reject_reason") == MALFORMED_REASON)
    _together(
        spark,
        lambda: gold_records(stored).write.parquet(out.records),
        lambda: weighted_rate(stored, "branch").write.parquet(out.by_branch),
        lambda: weighted_rate(stored, "course_name").write.parquet(out.by_course),
        lambda: append_log(dq_report(staged, run_id, run_ts, out.silver, malformed=malformed), out.dq_log),
    )
    publish_run(spark, root, out.run)
    return out


def masked_layers(spark: SparkSession, layers: Layers, readers: str, prefix: str = "masked_") -> list[str]:
    """A view of each table of a run that has names in it, under which only those
    listed in ``readers`` see them (``governance.masked_view``); gives the views."""
    views = {"silver_training": layers.silver, "silver_training_rejects": layers.rejects, "gold_training_records": layers.records}
    for name, path in views.items():
        masked_view(spark, f"{prefix}{name}", path, readers)
    return [f"{prefix}{name}" for name in views]
