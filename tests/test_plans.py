"""What reaches the scan, what is shuffled, what runs in Python."""

import re

import pytest
from pyspark.sql import functions as F

from curate.operators.aggregate import weighted_rate
from curate.operators.embed import embed
from curate.operators.knn import knn_join
from curate.operators.quality import dq_report
from curate.plans import medallion
from curate.plans.question_answering import store_corpus
from curate.session import work_path
from curate.sources.csv import read_bronze
from tests.test_quality import TS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    return sorted(re.findall(r"(\w+):", ",".join(re.findall(r"ReadSchema: struct<([^\n]*)>", plan(df)))))


@pytest.fixture(scope="module")
def stored(spark):
    from tests.conftest import SAMPLE, raw_frame

    path = work_path(spark, "staged")
    medallion.counted_records(raw_frame(spark, SAMPLE)).write.parquet(path)
    return spark.read.parquet(path)


def test_aggregates_read_three_columns(stored):
    rates = weighted_rate(stored, "branch")
    assert read_columns(rates) == ["branch", "days_attended", "number_of_days"]
    # Sums are partial before the one shuffle.
    assert "partial_sum" in plan(rates) and plan(rates).count("Exchange") == 1


def test_split_filters_reach_the_scan(stored):
    good, bad = medallion.split(stored)
    assert "PushedFilters: [IsNotNull(course_date)]" in plan(good)
    assert "PushedFilters: [IsNull(course_date)]" in plan(bad)
    assert "dq_days_mismatch" not in read_columns(bad)


def test_filters_on_cluster_keys_reach_the_scan(stored):
    found = stored.where((F.col("branch") == "West") & (F.col("course_date") >= "2024-06-01"))
    pushed = re.search(r"PushedFilters: \[[^\n]*", plan(found)).group()
    assert "EqualTo(branch,West)" in pushed and "GreaterThanOrEqual(course_date" in pushed


def test_report_is_one_scan_and_one_aggregate(stored):
    report = dq_report(stored, "r", TS, "d")
    text = plan(report)
    assert text.count("FileScan") == 1 and text.count("Exchange SinglePartition") == 1
    assert "applicant" not in read_columns(report)


def test_silver_is_one_shuffle(spark, sample):
    path = work_path(spark, "raw")
    sample.write.option("header", True).csv(path)
    text = plan(medallion.latest_records(read_bronze(spark, path)))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_default_encoder_stays_on_the_jvm(stored):
    text = plan(embed(stored.select("fileno", F.col("course_name").alias("text"))))
    assert "Arrow" not in text and "Python" not in text and "Exchange" not in text


def test_search_reads_ids_and_vectors_and_moves_hits_only(spark, stored):
    corpus = store_corpus(spark, medallion.gold_records(medallion.split(stored)[0]), work_path(spark, "v"))
    asked = embed(corpus.select(F.col("doc_id").alias("question_id"), "text")).select("question_id", "vec")
    hits = knn_join(asked, corpus)
    assert read_columns(hits) == ["doc_id", "vec"]
    scan_to_shuffle = plan(hits).split("Exchange")
    assert len(scan_to_shuffle) == 2 and "MapInArrow" in scan_to_shuffle[1]
