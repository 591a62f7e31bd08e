import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curate import session
from curate.operators import governance, layout
from curate.plans import medallion
from curate.session import work_path
from curate.fixed_values import ATTENDANCE_HEADERS
from curate.sources import csv, tables
from curate.sources.csv import read_bronze
from curate.streaming import ingest


@pytest.fixture
def silver(sample):
    return medallion.split(medallion.latest_records(sample))[0]


def test_csv_round_trip(spark, sample):
    path = work_path(spark, "csv")
    sample.write.option("header", True).csv(path)
    back = read_bronze(spark, path)
    assert back.dtypes == sample.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sample.collect()))


def test_csv_with_another_header_fails(spark, sample):
    path = work_path(spark, "csv")
    sample.withColumnRenamed("Age", "Years").write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        read_bronze(spark, path).collect()


def test_replace_drops_old_rows_and_columns(spark, silver):
    path = work_path(spark, "table")
    tables.write_replace(spark.range(100), path)
    tables.write_replace(silver, path)
    back = tables.read_table(spark, path)
    assert back.columns == silver.columns and back.count() == 8


def test_catalog_tables_layers_and_tags(spark, silver):
    tables.create_layers(spark)
    name = tables.layer_table("silver", f"training_{datetime.now():%H%M%S%f}")
    tables.write_replace(silver, name)
    tables.write_replace(silver.limit(3), name)
    assert tables.read_table(spark, name).count() == 3
    governance.tag_table(spark, name, data_domain="training", layer="silver")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["data_domain"] == "training"
    assert governance.tagged_columns(spark.table(name), ["PII"]) == ["applicant"]
    spark.sql(f"DROP TABLE {name}")


def test_layer_names():
    assert tables.layer_table("gold", "t", "cat") == "cat.gold.t"
    assert tables.layer_path("/r/", "gold", "t") == "/r/gold/t"
    with pytest.raises(ValueError):
        tables.layer_path("/r", "platinum", "t")


def test_all_layers_agree(spark, sample):
    out = medallion.build_layers(spark, sample, work_path(spark, "layers"), "r", datetime(2024, 9, 1))
    count = {p: spark.read.parquet(p).count() for p in (out.staged, out.silver, out.rejects, out.records, out.by_branch, out.by_course, out.dq_log)}
    assert list(count.values()) == [9, 8, 1, 8, 3, 3, 6]
    # A second run replaces the tables and adds to the log.
    medallion.build_layers(spark, sample, out.root, "r2", datetime(2024, 9, 2))
    assert spark.read.parquet(out.silver).count() == 8 and spark.read.parquet(out.dq_log).count() == 12


def test_mask_follows_the_tag(silver):
    masked = governance.mask_columns(silver, reader=False)
    assert {r.applicant for r in masked.collect()} == {"***REDACTED***"}
    assert masked.columns == silver.columns and masked.schema["applicant"].metadata == {"classification": "PII"}
    assert masked.drop("applicant").exceptAll(silver.drop("applicant")).count() == 0
    assert governance.mask_columns(silver, reader=True).exceptAll(silver).count() == 0
    partly = governance.mask_columns(silver, reader=F.col("branch") == "West")
    assert {r.applicant for r in partly.collect()} == {"Ada", "Hal", "***REDACTED***"}


def test_mask_hides_missing_names_too(spark):
    df = governance.tag_column(spark.createDataFrame([(None,), ("x",)], "n string"), "n", classification="PII")
    assert {r.n for r in governance.mask_columns(df, reader=False).collect()} == {"***REDACTED***"}


def test_tags_survive_parquet(spark, silver):
    path = work_path(spark, "tagged")
    governance.tag_column(silver, "branch", classification="INTERNAL", owner="ops").write.parquet(path)
    tags = governance.column_tags(spark.read.parquet(path))
    assert tags["branch"] == {"classification": "INTERNAL", "owner": "ops"} and tags["fileno"] == {"classification": "CONFIDENTIAL"}


def test_clustered_files_hold_neighbouring_keys_and_split_hot_ones(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), (F.col("id") % 50).cast("string"))).alias("branch"),
        F.expr("date_add(date'2024-01-01', cast(id % 7 as int))").alias("course_date"),
        "id",
    )
    path = work_path(spark, "clustered")
    layout.write_clustered(df, path, ("branch",), files=12)
    back = spark.read.parquet(path)
    assert back.count() == 20_000 and back.select("id").distinct().count() == 20_000
    per_file = back.groupBy("_metadata.file_path").agg(
        F.count("*").alias("n"), F.count_distinct("branch").alias("branches"), F.count_if(F.col("branch") == "hot").alias("hot")
    ).collect()
    assert max(r.n for r in per_file) < 3 * 20_000 / 12
    assert sum(r.hot > 0 for r in per_file) >= 3
    assert max(r.branches for r in per_file) < 15


def test_compaction(spark):
    small, out = work_path(spark, "small"), work_path(spark, "whole")
    spark.range(50_000).repartition(40).write.parquet(small)
    assert layout.folder_bytes(spark, small) > 0
    assert layout.compact(spark, small, out) == 1
    back = spark.read.parquet(out)
    assert back.count() == 50_000 and len(back.inputFiles()) == 1
    with pytest.raises(Exception):
        layout.compact(spark, small, out)


def test_compaction_keeps_clustering(spark):
    path, small, out = (work_path(spark, n) for n in ("a", "b", "c"))
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    layout.write_clustered(rows, path, ("key",), files=32)
    layout.write_clustered(rows, small, ("key",), files=4)

    def span(folder):
        per = spark.read.parquet(folder).groupBy("_metadata.file_path").agg((F.max("key") - F.min("key")).alias("s"))
        return per.agg(F.avg("s"), F.count("*")).first()

    target = max(1, layout.folder_bytes(spark, path) // 4 >> 20)
    wrote = layout.compact(spark, path, out, target_mb=target, keys=("key",))
    average, files = span(out)
    assert files == wrote and wrote < 32 and average <= 40_000 / wrote * 1.5


def test_failed_replacement_leaves_the_old_table(spark):
    path = work_path(spark, "kept")
    tables.write_replace(spark.range(5), path)
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        tables.write_replace(bad, path)
    assert spark.read.parquet(path).count() == 5
    tables.write_replace(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7


@pytest.mark.parametrize("streamed", [False, True])
def test_malformed_records_are_kept(spark, tmp_path, streamed):
    header = ",".join(f'"{h}"' for h in ATTENDANCE_HEADERS)
    good = "R-1,Ada,30,B,C,2024-01-01,3,1,2"
    lines = [good, good + ",tenth", "R-2,short,1,2", 'R-3,"Ap', 'ril",30,B,C,2024-01-01,3,1,2', good.replace("R-1", "R-4")]
    (tmp_path / "feed.csv").write_text("\n".join([header, *lines]) + "\n")
    if streamed:
        out = work_path(spark, "lines")
        stream = csv.stream_lines(spark, str(tmp_path)).writeStream.format("parquet").option("checkpointLocation", work_path(spark, "c"))
        stream.trigger(availableNow=True).start(out).awaitTermination()
        rows = spark.read.parquet(out)
    else:
        rows = csv.read_lines(spark, str(tmp_path))
    first = next(iter(ATTENDANCE_HEADERS))
    assert sorted(r[0] for r in csv.records(rows).select(f"`{first}`").collect()) == ["R-1", "R-4"]
    bad = csv.malformed(rows).collect()
    assert sorted(r.record for r in bad) == sorted(lines[1:5]) and {r.reject_reason for r in bad} == {"malformed_record"}
    if not streamed:
        assert csv.read_bronze(spark, str(tmp_path)).count() == 2
        assert csv.read_bronze(spark, str(tmp_path), multi_line=True).count() == 3


def torn_folder(spark, name):
    """Two records, one of them twice, and four lines that are none, one of them twice."""
    path = work_path(spark, name)
    header = ",".join(f'"{h}"' for h in ATTENDANCE_HEADERS)
    good = ["R-1,Ada,30,B,C,2024-01-01,3,1,2", "R-1,Ada,30,B,C,2024-01-01,3,1,2", "R-4,Ben,30,B,C,never,3,1,2"]
    bad = [good[0] + ",tenth", "R-2,short,1,2", "R-2,short,1,2", 'R-3,"Ap', 'ril",30,B,C,2024-01-01,3,1,2']
    os.makedirs(path)
    with open(f"{path}/feed.csv", "w") as file:
        file.write("\n".join([header, *good, *bad]) + "\n")
    return path, bad


def test_layers_keep_malformed_lines(spark):
    path, bad = torn_folder(spark, "torn")
    out = medallion.build_layers(spark, csv.read_lines(spark, path), work_path(spark, "layers"), "r", datetime(2024, 9, 1))
    rejects = spark.read.parquet(out.rejects).collect()
    assert sorted(r.record for r in rejects if r.reject_reason == "malformed_record") == sorted(bad)
    assert [(r.fileno, r.record) for r in rejects if r.reject_reason != "malformed_record"] == [("R-4", None)]
    assert spark.read.parquet(out.silver).count() == 1
    report = {r.rule_name: (r.rows_in, r.rows_evaluated, r.rows_passed) for r in spark.read.parquet(out.dq_log).collect()}
    assert len(report) == 7 and {r[0] for r in report.values()} == {8}
    steps = [report[n][1:] for n in ("well_formed_record", "exact_duplicate_rows", "duplicate_fileno_conflict", "course_date_parseable")]
    assert steps == [(8, 3), (3, 2), (2, 2), (2, 1)]


def test_streams_keep_malformed_lines(spark):
    path, bad = torn_folder(spark, "torn")
    bronze, silver, log, *rejects = (work_path(spark, n) for n in ("bronze", "silver", "log", "r", "r"))
    lines = csv.stream_lines(spark, path)
    with pytest.raises(ValueError):
        ingest.ingest_bronze(lines, bronze, work_path(spark, "c"))
    # The second round has another checkpoint and repeats the batch.
    for _ in range(2):
        ingest.ingest_bronze(lines, bronze, work_path(spark, "c"), rejects=rejects[0]).awaitTermination()
        args = (silver, log, work_path(spark, "c"), "b", datetime(2024, 9, 1))
        ingest.ingest_silver(lines, *args, rejects=rejects[1]).awaitTermination()
    for kept in rejects:
        assert sorted(r.record for r in spark.read.parquet(kept).collect()) == sorted(bad)
    assert spark.read.parquet(bronze).count() == 3
    report = {r.rule_name: (r.rows_in, r.rows_failed) for r in tables.read_log(spark, log).collect()}
    assert report["well_formed_record"] == (8, 5) and len(report) == 7


def test_masking_needs_tags(spark):
    with pytest.raises(ValueError):
        governance.mask_columns(spark.range(1), reader=False)
    assert governance.mask_columns(spark.range(1), reader=False, untagged_ok=True).columns == ["id"]


def test_runtime_settings(spark):
    settings = layout.runtime_settings(spark)
    assert len(settings) == 4 and settings["spark.sql.adaptive.enabled"] == "true"


class FakeSession:
    """Just what naming the shared folder looks at."""

    def __init__(self, master, named=None):
        self.named, self.master, self.own = named, master, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.own

    def setCheckpointDir(self, path):
        self.own = path


def test_shared_folder_comes_from_the_session(spark):
    cluster = FakeSession("spark://host:1", named="hdfs:///shared/")
    assert session.shared_dir(cluster) == "hdfs:///shared"
    assert session.work_path(cluster, "x").startswith("hdfs:///shared/curate/x-")
    assert session.work_path(cluster, "x") != session.work_path(cluster, "x")
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("spark://host:1"))
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.own


def test_partition_settings_grow_with_the_input():
    small, big = session.sized_conf(10 << 30), session.sized_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))


def test_view_for_sql(spark, silver):
    name = tables.as_view(silver, "silver_for_sql")
    assert spark.sql(f"SELECT count(*) AS n FROM {name} WHERE dq_days_mismatch").first().n == 1
