"""Space-filling order and packing of small files."""

import os

import pytest
from pyspark.sql import functions as F

from curate.operators import layout
from curate.session import work_path


def plain(path):
    return path.removeprefix("file:")


def files_of(path):
    found = {}
    for folder, _, names in os.walk(plain(path)):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(folder, name), "rb") as f:
                    found[os.path.relpath(os.path.join(folder, name), plain(path))] = f.read()
    return found


def spans(spark, path, column):
    """Least and greatest value per file, as its statistics have them."""
    rows = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return [(r.lo, r.hi) for r in rows.collect()]


def test_a_filter_on_either_key_skips_half_of_the_files(spark):
    df = spark.range(60_000).select(
        F.concat(F.lit("branch"), F.lpad((F.xxhash64("id") % 25 + 25).cast("string"), 2, "0")).alias("branch"),
        F.expr("date_add(date'2020-01-01', cast(pmod(xxhash64(id, 1), 1500) as int))").alias("course_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    path = work_path(spark, "clustered")
    written = layout.write_clustered(df, path, ("branch", "course_date"), target_mb=0.2)
    assert rows(spark, path) == sorted(map(str, df.collect()))
    dates, branches = spans(spark, path, "course_date"), spans(spark, path, "branch")
    assert len(dates) == written >= 16
    for day in [r[0] for r in df.select("course_date").distinct().limit(20).collect()]:
        assert sum(lo <= day <= hi for lo, hi in dates) <= len(dates) / 2
    for name in [r[0] for r in df.select("branch").distinct().limit(20).collect()]:
        assert sum(lo <= name <= hi for lo, hi in branches) <= len(branches) / 2


def rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_the_number_of_files_follows_the_bytes(spark):
    few, many = (spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad")) for n in (4_000, 40_000))
    paths = [work_path(spark, "c") for _ in range(2)]
    counts = [layout.write_clustered(df, path, ("id",), target_mb=0.05) for df, path in zip((few, many), paths)]
    assert 7 <= counts[1] / counts[0] <= 13
    assert [len(spark.read.parquet(path).inputFiles()) for path in paths] == counts


def test_order_of_odd_keys(spark):
    df = spark.createDataFrame([(None, 1.5), ("a", None), ("a", 2.0), ("b", float("nan"))], "k string, order_ double")
    path = work_path(spark, "odd")
    layout.write_clustered(df, path, ("k", "order_"))
    assert rows(spark, path) == sorted(map(str, df.collect()))
    layout.write_clustered(df.where("false"), path, ("k", "order_"))
    assert spark.read.parquet(path).count() == 0
    order = df.select(layout.space_filling_order(df, ("k",)).alias("z")).collect()
    assert sorted(r.z for r in order)[0] == 0


def small_and_large(spark):
    path = work_path(spark, "packed")
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad"), (F.col("id") % 2).alias("part"))
    df.where("id < 30000").repartition(1, "part").write.partitionBy("part").parquet(path)
    df.where("id >= 30000").repartition(20, "id").write.mode("append").partitionBy("part").parquet(path)
    return path, df


def test_packing_keeps_large_files_and_folders(spark):
    path, df = small_and_large(spark)
    before = files_of(path)
    large = {p: b for p, b in before.items() if len(b) > 300_000}
    assert len(large) == 2 and len(before) == 42
    less = layout.pack(spark, path, target_mb=0.3, keys=("id",))
    after = files_of(path)
    assert {p: after[p] for p in large} == large
    assert len(before) - len(after) == less >= 34
    assert {p.split("/")[0] for p in after} == {"part=0", "part=1"}
    assert rows(spark, path) == sorted(map(str, df.select("id", "pad", F.col("part").cast("int")).collect()))
    assert not [n for n in os.listdir(plain(path)) if "compaction" in n]
    merged = [p for p in after if p not in before]
    for p in merged:
        ids = [r.id for r in spark.read.parquet(f"{path}/{p}").collect()]
        assert ids == sorted(ids)
    # Nothing is left to pack, so nothing is touched.
    assert layout.pack(spark, path, target_mb=0.3) == 0 or len(files_of(path)) < len(after)


def test_a_packing_that_broke_off_is_finished_later(spark, monkeypatch):
    path, df = small_and_large(spark)
    expected = rows(spark, path)
    calls = []
    monkeypatch.setattr(layout, "finish_compaction", lambda spark, path: calls.append(path))
    layout.pack(spark, path, target_mb=0.3)
    monkeypatch.undo()
    assert len(calls) == 2 and rows(spark, path) == expected
    assert layout.finish_compaction(spark, path) and not layout.finish_compaction(spark, path)
    spark.catalog.refreshByPath(path)
    assert rows(spark, path) == expected and len(files_of(path)) < 42


@pytest.mark.parametrize("lengths, expected", [([10] * 10, {0: 5, 1: 5}), ([60, 10, 10], {1: 2}), ([50], {}), ([49, 49, 2], {0: 2})])
def test_bins(spark, lengths, expected):
    files = spark.createDataFrame([(f"file:/t/p=1/{i:02}.parquet", n) for i, n in enumerate(lengths)], "path string, length long")
    found = [r.bin for r in layout.bins(files, 50).collect()]
    assert sorted(found.count(b) for b in set(found)) == sorted(expected.values())


def test_files_hold_what_one_task_can_sort(spark, monkeypatch):
    df = spark.range(40_000).select("id", F.lit("same").alias("k"), F.array(F.lit("x" * 50)).alias("pad"))
    monkeypatch.setattr(layout, "SORT_BYTES", 1 << 20)
    limit = layout.sort_rows(df, 40_000)
    assert (1 << 20) / 250 < limit < (1 << 20) / 100
    path = work_path(spark, "c")
    files = layout.write_clustered(df, path, ("k",))
    held = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert files == -(-40_000 // limit) and len(held) == files and max(held) < 2 * limit
    assert rows(spark, path) == sorted(map(str, df.collect()))


def test_bins_too_large_to_sort_become_several_files(spark, monkeypatch):
    path, df = small_and_large(spark)
    expected, before = rows(spark, path), files_of(path)
    monkeypatch.setattr(layout, "SORT_BYTES", 100_000)
    layout.pack(spark, path, target_mb=0.3, keys=("id",))
    merged = [p for p in files_of(path) if p not in before]
    held = [[r.id for r in spark.read.parquet(f"{path}/{p}").collect()] for p in merged]
    assert rows(spark, path) == expected and all(ids == sorted(ids) for ids in held)
    assert sum(map(len, held)) == 10_000 and max(map(len, held)) <= 2 * 100_000 / (32 + 16 * 2 + 64)


def test_packing_does_not_shuffle_rows_to_their_names(spark, monkeypatch):
    """Rows of one file would all go to one task."""
    path, _ = small_and_large(spark)
    joined = []
    plain_join = type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, *a, **k: joined.append(plain_join(self, *a, **k)) or joined[-1])
    layout.pack(spark, path, target_mb=0.3)
    monkeypatch.undo()
    assert joined and "BroadcastHashJoin" in joined[0]._jdf.queryExecution().sparkPlan().toString()
