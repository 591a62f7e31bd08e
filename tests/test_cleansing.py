import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from curate.functions.casting import safe_cast
from curate.functions.dates import parse_mixed_date
from curate.operators.headers import clean_headers, header_tags, snake_name
from curate.operators.quarantine import quarantine
from curate.operators.validate import flag_reconcile, validate_range


def parsed(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", parse_mixed_date("t", **options).cast("string").alias("d")).collect()
    return [r.d for r in sorted(rows)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-05-20", "2024-05-20"),
        ("14/05/2024", "2024-05-14"),
        ("05/06/2024", "2024-06-05"),
        ("2024/06/30", "2024-06-30"),
        ("45230", "2023-10-31"),
        ("2024", "1905-07-16"),
        ("999999", "4637-11-25"),
        ("123", None),
        ("1234567", None),
        ("2024-13-45", None),
        ("31/02/2024", None),
        ("29/02/2023", None),
        ("29/02/2024", "2024-02-29"),
        ("2024-5-2", None),
        (" 2024-05-20", None),
        ("2024-05-20 10:00", None),
        ("2024-05-20\n", None),
        ("2024-05/20", None),
        ("", None),
        (None, None),
    ],
)
def test_mixed_dates(spark, text, expected):
    assert parsed(spark, [text]) == [expected]


def test_mixed_dates_agree_with_the_pattern_parser(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        y, m, d = rng.choice([rng.randint(0, 9999), rng.randint(1900, 2100)]), rng.randint(0, 13), rng.randint(0, 32)
        text = rng.choice([f"{y:04}-{m:02}-{d:02}", f"{d:02}/{m:02}/{y:04}", f"{y:04}/{m:02}/{d:02}", f"+{y + 10000}-{m:02}-{d:02}"])
        # More year digits would overflow the pattern parser and fail the job.
        if rng.random() < 0.3 and "+" not in text:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("0123456789/- ") + text[at + rng.randint(0, 1):]
        texts.append(text)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.coalesce(
        *[F.try_to_date("t", f) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd")],
        F.when(F.col("t").rlike("^[0-9]{4,6}$"), F.date_add(F.lit("1899-12-30").cast("date"), F.col("t").try_cast("int"))),
    )
    differing = df.select("t", parse_mixed_date("t").cast("string").alias("a"), by_pattern.cast("string").alias("b"))
    assert differing.where("NOT (a <=> b)").collect() == []


def test_a_year_that_overflows_the_parser_does_not_fail_the_job(spark):
    texts = ["+300000-01-01", "+9999999-01-01", "2024-01-02"]
    assert parsed(spark, texts) == ["+300000-01-01", None, "2024-01-02"]


def test_formats_are_tried_in_order_and_others_are_possible(spark):
    assert parsed(spark, ["03/04/2024", "25/12/2024"], formats=("MM/dd/yyyy", "dd/MM/yyyy")) == ["2024-03-04", "2024-12-25"]
    assert parsed(spark, ["5 Jun 2024", "45230"], formats=("d MMM yyyy",), excel_serial=False) == ["2024-06-05", None]


def test_safe_cast(spark):
    df = spark.createDataFrame([("46",), (" 46 ",), ("46.5",), ("1e2",), ("n/a",), ("",), (None,), ("99999999999",)], "n string")
    assert [r.n for r in safe_cast(df, ["n"]).collect()] == [46, 46, None, None, None, None, None, None]


def test_validate_range_never_leaves_the_flag_null(spark):
    df = spark.createDataFrame([("16",), ("100",), ("15",), ("101",), ("thirty",), ("",), (None,)], "age string")
    rows = validate_range(df, "age", 16, 100, "clean", "ok").collect()
    assert [(r.clean, r.ok) for r in rows] == [(16, True), (100, True)] + [(None, False)] * 5


def test_flag_reconcile(spark):
    df = spark.createDataFrame(
        [(9, 8, 1), (5, 3, 3), (None, 1, 1), (2, None, 2), (2, 2, None), (2147483647, 2147483647, 2147483647), (0, 0, 0)],
        "n int, a int, b int",
    )
    rows = flag_reconcile(df, ("a", "b"), "n", "bad").collect()
    assert [r.bad for r in rows] == [False, True, True, True, True, True, False]


def test_clean_headers_moves_tags_to_metadata(sample):
    df = clean_headers(sample)
    assert df.columns[:2] == ["fileno", "applicant"] and df.columns[5] == "course_date_raw"
    assert df.schema["applicant"].metadata == {"classification": "PII"}
    assert df.schema["branch"].metadata == {}


def test_clean_headers_without_mapping(spark):
    df = spark.createDataFrame([("a", "b")], "`Some Name&12# SECRET x` string, `Other-Field` string")
    out = clean_headers(df, mapping={})
    assert out.columns == ["some_name", "other_field"]
    assert out.schema["some_name"].metadata == {"classification": "SECRET x"}
    assert snake_name("Age") == "age"


def test_header_tags(sample, spark):
    rows = {tuple(r) for r in header_tags(sample).collect()}
    assert rows == {("fileno", "CONFIDENTIAL", 10), ("applicant", "PII", 10)}
    assert header_tags(spark.range(3)).count() == 0


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    good, bad = quarantine(df, F.col("x") > 0, "not positive")
    assert [r.x for r in good.collect()] == [1]
    assert {(r.x, r.reject_reason) for r in bad.collect()} == {(-1, "not positive"), (None, "not positive")}


def test_serial_dates_are_days_from_the_epoch(spark):
    assert parsed(spark, ["1000", "73050"]) == [str(date(1902, 9, 26)), str(date(2099, 12, 31))]
