"""Declarative quality rules, the run report, its log and its alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from curate.fixed_values import (
    ALERT_FLOOR,
    ALERT_WINDOW_DAYS,
    EXACT_RULE,
    KEY_RULE,
    MALFORMED_RULE,
    RATE_SCALE,
    ROW_RULES,
)
from curate.operators.dedup import COPIES, VARIANTS
from curate.sources.tables import LOG_DATE


@dataclass(frozen=True)
class Rule:
    """A check on rows: where it applies, and when an applicable row passes.

    Keeping the two apart keeps one defect from counting under two rules.
    """

    name: str
    severity: str
    applicable: str
    passes: str
    note: str = ""

    @property
    def is_applicable(self) -> Column:
        return F.expr(self.applicable)

    @property
    def is_passed(self) -> Column:
        return F.expr(self.applicable) & F.expr(self.passes)

    @property
    def is_satisfied(self) -> Column:
        return ~F.expr(self.applicable) | F.expr(self.passes)


ATTENDANCE_RULES = tuple(Rule(*values) for values in ROW_RULES)


def _all_satisfied(rules: Sequence[Rule]) -> Column:
    clean = F.lit(True)
    for rule in rules:
        clean = clean & rule.is_satisfied
    return clean


def _counters(rules: Sequence[Rule]) -> list[Column]:
    """Two counters per rule; only TRUE counts, so a NULL predicate is a fail."""
    counters = []
    for i, rule in enumerate(rules):
        counters.append(F.count_if(rule.is_applicable).alias(f"evaluated_{i}"))
        counters.append(F.count_if(rule.is_passed).alias(f"passed_{i}"))
    return counters


def _line(name: str, severity: str, note: str, evaluated: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rule_name"),
        F.lit(severity).alias("severity"),
        evaluated.alias("rows_evaluated"),
        passed.alias("rows_passed"),
        (evaluated - passed).alias("rows_failed"),
        F.lit(note).alias("rule_note"),
    )


def _rule_lines(rules: Sequence[Rule]) -> list[Column]:
    return [
        _line(r.name, r.severity, r.note, F.col(f"evaluated_{i}"), F.col(f"passed_{i}"))
        for i, r in enumerate(rules)
    ]


def pass_rate(passed: str = "rows_passed", evaluated: str = "rows_evaluated") -> Column:
    """Share of evaluated rows that passed; NULL where none was evaluated."""
    return F.round(F.try_divide(passed, evaluated), RATE_SCALE)


def evaluate(df: DataFrame, rules: Sequence[Rule] = ATTENDANCE_RULES) -> DataFrame:
    """One line per rule, all rules counted in one pass over ``df``."""
    counts = df.agg(*_counters(rules))
    return counts.select(F.inline(F.array(*_rule_lines(rules))))


def clean_rows(df: DataFrame, rules: Sequence[Rule] = ATTENDANCE_RULES) -> DataFrame:
    """Rows that pass every rule that applies to them."""
    return df.where(_all_satisfied(rules))


def _timestamp(moment: datetime) -> Column:
    """``moment`` on the clock of the session, or of its own zone if it has one."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def row_counts(staged: DataFrame, curated: Column) -> DataFrame:
    """The size of each step in one pass: rows in, after exact and key
    deduplication, curated, quarantined."""
    return staged.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).cast("bigint").alias("rows_in"),
        F.coalesce(F.sum(VARIANTS), F.lit(0)).cast("bigint").alias("rows_after_exact_dedup"),
        F.count(F.lit(1)).alias("rows_after_key_dedup"),
        F.count_if(curated).alias("rows_curated"),
        F.count_if(~F.coalesce(curated, F.lit(False))).alias("rows_quarantined"),
    )


def dq_report(
    staged: DataFrame,
    run_id: str,
    run_ts: datetime,
    dataset: str,
    rules: Sequence[Rule] = ATTENDANCE_RULES,
    malformed: DataFrame | None = None,
) -> DataFrame:
    """The run's report, one line per rule, from the deduplicated rows alone.

    ``staged`` is the output of ``fold_versions``: its copy and version counts
    carry the raw row counts, so rules and deduplication are reported from one
    aggregate and nothing passes through the driver.

    ``malformed`` has a row per line that was no record. They then have a line of
    their own and are part of ``rows_in``; what passes it goes into the others.
    """
    counts = staged.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).cast("bigint").alias("records_in"),
        F.coalesce(F.sum(VARIANTS), F.lit(0)).cast("bigint").alias("after_exact"),
        F.count(F.lit(1)).alias("after_key"),
        *_counters(rules),
    )
    (exact, exact_severity, exact_note), (key, key_severity, key_note) = EXACT_RULE, KEY_RULE
    lines = [
        _line(exact, exact_severity, exact_note, F.col("records_in"), F.col("after_exact")),
        _line(key, key_severity, key_note, F.col("after_exact"), F.col("after_key")),
        *_rule_lines(rules),
    ]
    rows_in = F.col("records_in")
    if malformed is not None:
        # One row each.
        counts = counts.crossJoin(malformed.agg(F.count(F.lit(1)).alias("malformed")))
        rows_in = rows_in + F.col("malformed")
        lines.insert(0, _line(*MALFORMED_RULE, rows_in, F.col("records_in")))
    return (
        counts.select(rows_in.alias("rows_in"), F.inline(F.array(*lines)))
        .select(
            F.lit(run_id).alias("run_id"),
            _timestamp(run_ts).alias("run_ts"),
            F.lit(dataset).alias("dataset"),
            "rule_name",
            "severity",
            "rows_in",
            "rows_evaluated",
            "rows_passed",
            "rows_failed",
            "rule_note",
            pass_rate().alias("pass_rate"),
        )
    )


def sort_report(report: DataFrame) -> DataFrame:
    return report.orderBy("severity", "rule_name")


def alerts(
    log: DataFrame,
    now: datetime | None = None,
    window_days: int = ALERT_WINDOW_DAYS,
    floor: float = ALERT_FLOOR,
) -> DataFrame:
    """Recent log lines to act on: a blocking rule with any failure, or a warn
    rule below ``floor``. An unknown pass rate never fires. Of a log kept by
    days only the days of the window are read."""
    current = F.current_timestamp() if now is None else _timestamp(now)
    if LOG_DATE in log.columns:
        # A day more, for runs written under another time zone.
        log = log.where(F.col(LOG_DATE) >= F.date_sub(F.to_date(current), window_days + 1))
    recent = F.col("run_ts") >= current - F.make_dt_interval(F.lit(window_days))
    blocking = (F.col("severity") == "blocking") & (F.col("rows_failed") > 0)
    low = (F.col("severity") == "warn") & (F.col("pass_rate") < floor)
    return (
        log.where(recent & (blocking | low))
        .select("run_ts", "rule_name", "severity", "rows_evaluated", "rows_failed", "pass_rate")
        .orderBy("severity", "pass_rate", "rule_name", "run_ts")
    )


@dataclass(frozen=True)
class Expectation:
    """A condition rows should meet; ``drop`` removes those that do not."""

    name: str
    condition: str
    drop: bool = False


def apply_expectations(
    df: DataFrame, expectations: Sequence[Expectation]
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, one line of counts per expectation).

    The counts are an aggregate rather than observed metrics: those may count
    a partition twice when a lost executor's stage runs again.
    """
    kept = df
    for e in expectations:
        if e.drop:
            kept = kept.where(F.coalesce(F.expr(e.condition), F.lit(False)))
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.expr(e.condition)).alias(f"passed_{i}") for i, e in enumerate(expectations)],
    )
    return kept, _expectation_lines(counts, expectations)


def _expectation_lines(counts: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """A line per expectation from one row of ``total`` and ``passed_<i>``."""
    lines = [
        F.struct(
            F.lit(e.name).alias("expectation"),
            F.lit("drop" if e.drop else "keep").alias("on_failure"),
            F.col(f"passed_{i}").alias("passed_rows"),
            (F.col("total") - F.col(f"passed_{i}")).alias("failed_rows"),
        )
        for i, e in enumerate(expectations)
    ]
    nothing = "array<struct<expectation: string, on_failure: string, passed_rows: bigint, failed_rows: bigint>>"
    return counts.select(F.inline(F.array(*lines) if lines else F.array().cast(nothing)))


MET, KEPT = "expectations_met", "expectations_kept"


def store_expectations(
    df: DataFrame, expectations: Sequence[Expectation], path: str
) -> tuple[DataFrame, DataFrame]:
    """What ``apply_expectations`` gives, from one pass over ``df``.

    Every row is written once below ``path``, with what it meets beside it and in
    a folder by whether it is kept, so dropped rows can be looked at too. Kept rows
    and counts are both read from there: they agree, and a retried task cannot
    count twice. A null condition is not met. ``path`` is replaced; an input with a
    column of the names used here is an error.
    """
    if {MET, KEPT} & set(df.columns):
        raise ValueError(f"columns {MET} and {KEPT} are taken")
    met = [F.coalesce(F.expr(e.condition), F.lit(False)) for e in expectations]
    kept = reduce(lambda a, b: a & b, [m for m, e in zip(met, expectations) if e.drop], F.lit(True))
    none = F.array().cast("array<boolean>")
    marked = df.withColumns({MET: F.array(*met) if met else none, KEPT: kept})
    marked.write.mode("overwrite").partitionBy(KEPT).parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    counts = stored.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.get(F.col(MET), F.lit(i))).alias(f"passed_{i}") for i in range(len(met))],
    )
    return stored.where(F.col(KEPT)).select(*df.columns), _expectation_lines(counts, expectations)


ATTENDANCE_EXPECTATIONS = (
    Expectation("course_date_parseable", "course_date IS NOT NULL", drop=True),
    Expectation("days_reconcile", "CAST(days_attended AS BIGINT) + days_absent = number_of_days"),
    Expectation("age_in_range_16_100", "is_age_valid"),
)
