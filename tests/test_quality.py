from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curate.operators import quality
from curate.plans import medallion
from curate.session import work_path
from curate.sources.tables import append_log, read_log

TS = datetime(2024, 9, 1, 12, 0, 0)


@pytest.fixture
def report(sample):
    return quality.dq_report(medallion.counted_records(sample), "r1", TS, "silver.training")


def test_report_of_the_sample(report):
    got = {r.rule_name: (r.rows_evaluated, r.rows_passed, r.rows_failed, r.pass_rate) for r in report.collect()}
    assert got == {
        "exact_duplicate_rows": (10, 9, 1, 0.9),
        "duplicate_fileno_conflict": (9, 9, 0, 1.0),
        "days_numeric_cast": (9, 9, 0, 1.0),
        "course_date_parseable": (9, 8, 1, 0.8889),
        "age_in_range_16_100": (9, 6, 3, 0.6667),
        "days_reconcile": (9, 8, 1, 0.8889),
    }
    assert {r.rows_in for r in report.collect()} == {10}


def test_report_schema_and_order(report):
    assert report.columns == [
        "run_id", "run_ts", "dataset", "rule_name", "severity", "rows_in", "rows_evaluated",
        "rows_passed", "rows_failed", "rule_note", "pass_rate",
    ]
    types = dict(report.dtypes)
    assert types["run_ts"] == "timestamp" and types["rows_failed"] == "bigint" and types["pass_rate"] == "double"
    names = [(r.severity, r.rule_name) for r in quality.sort_report(report).collect()]
    assert names == sorted(names)


def test_alerts_of_the_sample(report):
    fired = [r.rule_name for r in quality.alerts(report, now=TS + timedelta(hours=1)).collect()]
    assert fired == ["course_date_parseable", "age_in_range_16_100", "days_reconcile"]
    assert quality.alerts(report, now=TS + timedelta(days=2)).count() == 0
    assert quality.alerts(report, now=TS + timedelta(days=1)).count() == 3


def test_alert_boundaries(spark):
    log = spark.createDataFrame(
        [("a", "warn", 10, 1, 0.9), ("b", "warn", 10, 2, 0.8999), ("c", "warn", 0, 0, None), ("d", "blocking", 9, 0, 0.1), ("e", "blocking", 9, 1, 0.99)],
        "rule_name string, severity string, rows_evaluated long, rows_failed long, pass_rate double",
    ).withColumn("run_ts", F.lit(TS))
    assert {r.rule_name for r in quality.alerts(log, now=TS).collect()} == {"b", "e"}


def test_current_time_is_the_default_now(report):
    assert quality.alerts(report.withColumn("run_ts", F.current_timestamp())).count() == 3
    assert quality.alerts(report).count() == 0


def test_empty_input_reports_zero_and_no_rate(records):
    rows = quality.dq_report(medallion.counted_records(records([])), "r", TS, "d").collect()
    assert len(rows) == 6
    assert {(r.rows_in, r.rows_evaluated, r.rows_failed, r.pass_rate) for r in rows} == {(0, 0, 0, None)}


def test_missing_days_count_under_one_rule_only(records):
    row = ("k", "Al", "", "B", "C", "2024-01-01", "n/a", "1", "0")
    staged = medallion.counted_records(records([row]))
    assert staged.first().dq_days_mismatch
    got = {r.rule_name: (r.rows_evaluated, r.rows_passed) for r in quality.evaluate(staged).collect()}
    assert got["days_numeric_cast"] == (1, 0)
    assert got["days_reconcile"] == (0, 0)
    assert got["age_in_range_16_100"] == (0, 0)
    assert quality.clean_rows(staged).count() == 0


def test_conflicting_versions_and_uncastable_days(records):
    rows = [
        ("k", "Al", "30", "B", "C", "2024-01-01", "3", "1", "2"),
        ("k", "Al", "30", "B", "C", "2024-02-01", "3", "1", "2"),
        # These two differ only in text that is no number: one record.
        ("m", "Bo", "30", "B", "C", "2024-01-01", "x", "1", "2"),
        ("m", "Bo", "30", "B", "C", "2024-01-01", "y", "1", "2"),
    ]
    got = {r.rule_name: (r.rows_in, r.rows_evaluated, r.rows_passed) for r in quality.dq_report(
        medallion.counted_records(records(rows)), "r", TS, "d").collect()}
    assert got["exact_duplicate_rows"] == (4, 4, 3)
    assert got["duplicate_fileno_conflict"] == (4, 3, 2)


def test_clean_rows_and_counts(sample):
    staged = medallion.counted_records(sample)
    assert quality.clean_rows(staged).count() == 6
    assert tuple(quality.row_counts(staged, F.col("course_date").isNotNull()).first()) == (10, 9, 9, 8, 1)


def test_null_predicate_counts_as_failed(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    rule = quality.Rule("positive", "warn", "TRUE", "x > 0")
    assert tuple(quality.evaluate(df, [rule]).first())[2:5] == (2, 1, 1)
    assert quality.clean_rows(df, [rule]).count() == 1


def test_expectations(sample):
    rows = medallion.latest_records(sample)
    kept, counts = quality.apply_expectations(rows, quality.ATTENDANCE_EXPECTATIONS)
    assert kept.count() == 8
    assert {r.expectation: (r.on_failure, r.passed_rows, r.failed_rows) for r in counts.collect()} == {
        "course_date_parseable": ("drop", 8, 1),
        "days_reconcile": ("keep", 8, 1),
        "age_in_range_16_100": ("keep", 6, 3),
    }


def test_log_grows_and_takes_new_columns(spark, report):
    path = work_path(spark, "log")
    append_log(report.drop("pass_rate"), path)
    append_log(report.withColumn("run_id", F.lit("r2")), path)
    log = read_log(spark, path)
    assert log.count() == 12
    assert {r.run_id: r.n for r in log.groupBy("run_id").agg(F.count("pass_rate").alias("n")).collect()} == {"r1": 0, "r2": 6}


def test_repeated_run_replaces_itself(spark, report):
    path = work_path(spark, "log")
    for _ in range(2):
        append_log(report, path)
    assert read_log(spark, path).count() == 6


def test_alerts_read_the_days_of_the_window_only(spark, report):
    path = work_path(spark, "log")
    append_log(report, path)
    append_log(report.withColumns({"run_id": F.lit("r0"), "run_ts": F.lit(TS - timedelta(days=40))}), path)
    fired = quality.alerts(read_log(spark, path), now=TS)
    assert [r.rule_name for r in fired.collect()] == ["course_date_parseable", "age_in_range_16_100", "days_reconcile"]
    plan = fired._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan


def test_time_of_a_run_is_on_the_session_clock(spark, sample):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        report = quality.dq_report(medallion.counted_records(sample), "r", TS, "d")
        shown = report.select(F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss")).first()[0]
        assert shown == "2024-09-01 12:00:00" and quality.alerts(report, now=TS).count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
