"""Views that mask what is stored, expectations stored with their rows, streams merged by bucket."""

import re
from datetime import datetime

import pytest
from tests.conftest import SAMPLE, raw_frame
from pyspark.sql import functions as F

from curate.fixed_values import MASK_TEXT
from curate.operators import governance, quality
from curate.operators.quality import Expectation
from curate.operators.answers import answer_all
from curate.plans import medallion
from curate.plans.question_answering import store_corpus, threshold_for
from curate.session import work_path
from curate.sources import csv, tables
from curate.streaming import ingest


@pytest.fixture
def stored(spark, sample):
    path = work_path(spark, "silver")
    tables.write_replace(medallion.split(medallion.latest_records(sample))[0], path)
    return path


def readers(spark, *names):
    path = work_path(spark, "readers")
    spark.createDataFrame([(n,) for n in names], "reader string").write.parquet(path)
    return f"parquet.`{path}`"


def test_a_masked_view_shows_names_to_listed_readers_only(spark, stored):
    me = spark.sql("SELECT current_user()").first()[0]
    plain = spark.read.parquet(stored)
    governance.masked_view(spark, "hidden_training", stored, readers(spark, "someone else"))
    hidden = spark.table("hidden_training")
    assert hidden.columns == plain.columns and {r.applicant for r in hidden.collect()} == {MASK_TEXT}
    assert hidden.drop("applicant").exceptAll(plain.drop("applicant")).count() == 0
    governance.masked_view(spark, "hidden_training", stored, readers(spark, me, "someone else"))
    assert spark.table("hidden_training").exceptAll(plain).count() == 0


def test_no_filter_reaches_below_the_mask(spark, stored):
    governance.masked_view(spark, "hidden_training", stored, readers(spark))
    for condition in ("applicant = 'Ada'", "applicant LIKE 'A%'", "length(applicant) = 3"):
        asked = spark.table("hidden_training").where(condition)
        assert asked.count() == 0
        plan = asked._jdf.queryExecution().executedPlan().toString()
        # The scan gets no filter on the names, so neither statistics nor errors tell.
        assert "PushedFilters: [" in plan and not [f for f in re.findall(r"PushedFilters: \[[^\]]*\]", plan) if "applicant" in f]
        conditions = [line for line in plan.splitlines() if "Filter " in line and "applicant" in line]
        assert conditions and all("element_at(array(" in line for line in conditions)


def test_a_view_of_a_named_table_follows_its_readers(spark, stored):
    me = spark.sql("SELECT current_user()").first()[0]
    spark.sql("DROP TABLE IF EXISTS governed_readers")
    spark.sql("DROP TABLE IF EXISTS governed_training")
    spark.createDataFrame([], "reader string").write.saveAsTable("governed_readers")
    spark.read.parquet(stored).write.saveAsTable("governed_training")
    try:
        governance.masked_view(spark, "governed_view", "governed_training", "governed_readers", mask="it's hidden \\ here")
        assert {r.applicant for r in spark.table("governed_view").collect()} == {"it's hidden \\ here"}
        spark.createDataFrame([(me,)], "reader string").write.mode("append").saveAsTable("governed_readers")
        assert MASK_TEXT not in {r.applicant for r in spark.table("governed_view").collect()} and "Ada" in {
            r.applicant for r in spark.table("governed_view").collect()
        }
    finally:
        spark.sql("DROP VIEW IF EXISTS governed_view")
        spark.sql("DROP TABLE governed_readers")
        spark.sql("DROP TABLE governed_training")


def test_a_view_needs_tags(spark):
    path = work_path(spark, "untagged")
    spark.range(2).write.parquet(path)
    with pytest.raises(ValueError, match="tagged"):
        governance.masked_view(spark, "no_tags", path, readers(spark))


RULES = (Expectation("small", "id < 8", drop=True), Expectation("even", "id % 2 = 0"), Expectation("known", "name IS NOT NULL", drop=True))


def test_stored_expectations_equal_the_lazy_ones(spark):
    df = spark.range(20).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("name"))
    lazy, told = quality.apply_expectations(df, RULES)
    kept, counts = quality.store_expectations(df, RULES, work_path(spark, "expected"))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, lazy.collect()))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, told.collect()))
    assert kept.columns == df.columns


def test_the_input_is_read_once(spark):
    source = work_path(spark, "input")
    spark.range(100).withColumn("name", F.lit("x")).write.parquet(source)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(i):
        reads.add(1)
        return i

    df = spark.read.parquet(source).withColumn("id", counted.asNondeterministic()("id"))
    kept, counts = quality.store_expectations(df, RULES, work_path(spark, "expected"))
    assert reads.value == 100
    assert kept.count() == 8 and {r.expectation: r.passed_rows for r in counts.collect()} == {"small": 8, "even": 50, "known": 100}
    assert reads.value == 100
    for result in (kept, counts):
        assert source not in result._jdf.queryExecution().executedPlan().toString()


def test_expectations_of_odd_inputs(spark):
    df = spark.range(3).select("id", F.lit(None).cast("string").alias("name"))
    kept, counts = quality.store_expectations(df, RULES, work_path(spark, "expected"))
    assert kept.count() == 0 and {r.failed_rows for r in counts.where("expectation = 'known'").collect()} == {3}
    kept, counts = quality.store_expectations(df.where("false"), RULES, work_path(spark, "expected"))
    assert kept.count() == 0 and {(r.passed_rows, r.failed_rows) for r in counts.collect()} == {(0, 0)}
    kept, counts = quality.store_expectations(df, (), work_path(spark, "expected"))
    assert kept.count() == 3 and counts.collect() == []
    with pytest.raises(ValueError, match="taken"):
        quality.store_expectations(df.withColumn(quality.MET, F.lit(1)), RULES, work_path(spark, "expected"))


def test_a_stream_merged_by_bucket_equals_the_batches_read_together(spark):
    folder, versions, log, merged, checkpoint = (work_path(spark, n) for n in ("drops", "versions", "log", "merged", "offsets"))
    later = [("R-0012", "Ben", "26", "North", "Growth", "15/05/2024", "10", "7", "3"), ("R-0099", "Jo", "30", "West", "Export", "2024-02-02", "3", "3", "0")]
    for rows in (SAMPLE, later):
        raw_frame(spark, rows).write.mode("append").option("header", True).csv(folder)
        stream = csv.stream_bronze(spark, folder)
        ingest.ingest_silver(stream, versions, log, checkpoint, "b", datetime(2024, 9, 1), table=merged).awaitTermination()
    together = ingest.current_records(spark, versions)
    one = ingest.merged_records(spark, merged).select(*together.columns)
    assert sorted(map(str, one.collect())) == sorted(map(str, together.collect()))
    assert {r.fileno: r.days_attended for r in one.collect()}["R-0012"] == 7


def test_readers_follow_finished_runs_only(spark, sample, monkeypatch):
    root = work_path(spark, "layers")
    with pytest.raises(FileNotFoundError):
        medallion.current_layers(spark, root)
    first = medallion.build_layers(spark, sample, root, "r 1", datetime(2024, 9, 1))
    assert medallion.current_layers(spark, root) == first

    def torn(*args, **kwargs):
        raise RuntimeError("lost")

    # The second run fails after its silver table is written.
    with monkeypatch.context() as m:
        m.setattr(medallion, "gold_records", torn)
        with pytest.raises(RuntimeError, match="lost"):
            medallion.build_layers(spark, sample.limit(2), root, "r2", datetime(2024, 9, 2))
    current = medallion.current_layers(spark, root)
    assert current == first and spark.read.parquet(current.silver).count() == 8
    third = medallion.build_layers(spark, sample.limit(3), root, "r3", datetime(2024, 9, 3))
    assert medallion.current_layers(spark, root) == third and spark.read.parquet(third.silver).count() == 3
    assert medallion.drop_old_runs(spark, root, keep=1) == [first.run]
    assert medallion.current_layers(spark, root) == third and spark.read.parquet(third.records).count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(first.silver)


def test_two_runs_that_end_together_are_both_listed(spark):
    root = work_path(spark, "runs")
    medallion._together(spark, *(lambda i=i: tables.publish_run(spark, root, f"run{i}") for i in range(6)))
    assert sorted(tables.published_runs(spark, root)) == [f"run{i}" for i in range(6)]


def test_layers_can_be_read_masked(spark, sample):
    out = medallion.build_layers(spark, sample, work_path(spark, "layers"), "r", datetime(2024, 9, 1))
    views = medallion.masked_layers(spark, out, readers(spark))
    assert len(views) == 3
    for view in views:
        assert {r.applicant for r in spark.table(view).collect()} == {MASK_TEXT}


def test_threshold_belongs_to_the_encoder(spark, sample):
    gold = medallion.gold_records(medallion.split(medallion.latest_records(sample))[0])
    corpus = store_corpus(spark, gold, work_path(spark, "vectors"))
    known = "attendance record r 0012 growth course at the north branch"
    rows = [("a", known, 1, True), ("b", "zebra quagga", 1, False)]
    labelled = spark.createDataFrame(rows, "question_id string, question string, k int, answerable boolean")
    scores = {r.question_id: r.top_score for r in answer_all(labelled, corpus, threshold=-9.0).collect()}
    found = threshold_for(labelled, corpus)
    assert scores["b"] < found < scores["a"] and found == (scores["a"] + scores["b"]) / 2
    # Overlapping bands leave the default.
    swapped = labelled.withColumn("answerable", ~F.col("answerable"))
    assert threshold_for(swapped, corpus, default=0.3) == 0.3
    assert threshold_for(labelled.where("answerable"), corpus) == 0.49


def test_work_folders_go_when_asked(spark, tmp_path, monkeypatch):
    from curate import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    path = session.work_path(spark, "some")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and session.qualified(spark, path) == f"file://{path}"
    session.drop_work(spark)
    assert list((tmp_path / "curate").iterdir()) == []
    session.drop_work(spark)
    (tmp_path / "curate" / "other-driver-1").mkdir()
    session.drop_work(spark)
    assert len(list((tmp_path / "curate").iterdir())) == 1
