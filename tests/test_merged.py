"""A table that batches are merged into: what is rewritten, what readers see."""

import os

import pytest
from pyspark.sql import functions as F

from curate.operators.dedup import dedup_latest
from curate.session import work_path
from curate.streaming import merged


def batch(spark, rows):
    return spark.createDataFrame(rows, "key string, day date, name string, n int").withColumn("day", F.col("day"))


def records(spark, keys, day, name="x"):
    return spark.createDataFrame([(k, name, i) for i, k in enumerate(keys)], "key string, name string, n int").select(
        "key", F.lit(day).cast("date").alias("day"), "name", "n"
    )


def merge(rows, root, number, buckets=8):
    return merged.merge_batch(rows, root, number, "key", "day", "name", buckets)


def plain(root):
    return root.removeprefix("file:")


def files(root):
    found = {}
    for folder, _, names in os.walk(plain(root) + "/data"):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                with open(path, "rb") as f:
                    found[path] = (os.stat(path).st_mtime_ns, f.read())
    return found


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_batches_one_by_one_equal_all_at_once(spark):
    root = work_path(spark, "merged")
    parts = [
        records(spark, [f"k{i % 40}" for i in range(200)], "2024-01-02"),
        records(spark, [f"k{i}" for i in range(30, 60)], "2024-01-03", "b"),
        records(spark, [f"k{i}" for i in range(0, 50, 7)], "2023-01-01", "c"),
        records(spark, ["k1", None, None], None, "a"),
    ]
    whole = parts[0]
    for number, part in enumerate(parts):
        merge(part, root, number)
        whole = whole if number == 0 else whole.unionByName(part)
        assert rows_of_text(merged.read_merged(spark, root)) == rows_of_text(dedup_latest(whole, "key", "day", "name"))


def rows_of_text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_untouched_buckets_keep_their_files(spark):
    root = work_path(spark, "merged")
    all_buckets = merge(records(spark, [f"k{i}" for i in range(100)], "2024-01-01"), root, 0)
    before = files(root)
    touched = merge(records(spark, ["k3"], "2024-02-01", "new"), root, 1)
    assert len(all_buckets) == 8 and len(touched) == 1
    after = files(root)
    assert {p: after[p] for p in before} == before
    added = [p for p in after if p not in before]
    assert len(added) == 1 and f"bucket={touched[0]}/" in added[0]
    assert {r["key"]: r["name"] for r in merged.read_merged(spark, root).collect()}["k3"] == "new"
    merged.vacuum(spark, root, keep=1)
    left = files(root)
    assert len(left) == 8 and all(p in after for p in left)
    assert merged.read_merged(spark, root).count() == 100


def test_a_failed_batch_leaves_readers_the_table(spark):
    root = work_path(spark, "merged")
    merge(records(spark, ["a", "b"], "2024-01-01"), root, 0)
    held = rows_of(merged.read_merged(spark, root))
    bad = records(spark, ["a", "c"], "2024-01-02").withColumn("n", F.when(F.col("key") == "c", F.raise_error(F.lit("torn"))).otherwise(1).cast("int"))
    with pytest.raises(Exception, match="torn"):
        merge(bad, root, 1)
    assert rows_of(merged.read_merged(spark, root)) == held
    # Data that was written without being published is not read, and is replaced.
    records(spark, ["zz"], "2024-01-05").write.parquet(f"{root}/data/generation=1/bucket=0", mode="overwrite")
    assert rows_of(merged.read_merged(spark, root)) == held
    merge(records(spark, ["a", "c"], "2024-01-02"), root, 1)
    assert [r[0] for r in rows_of(merged.read_merged(spark, root))] == ["a", "b", "c"]


def test_a_repeated_batch_counts_once(spark):
    root = work_path(spark, "merged")
    merge(records(spark, ["a", "b"], "2024-01-01"), root, 0)
    for name in ("wrong", "right"):
        merge(records(spark, ["b"], "2024-01-02", name), root, 1)
    assert {r["key"]: r["name"] for r in merged.read_merged(spark, root).collect()} == {"a": "x", "b": "right"}


def test_empty_batches(spark):
    root = work_path(spark, "merged")
    with pytest.raises(FileNotFoundError):
        merged.read_merged(spark, root)
    merge(records(spark, ["a"], "2024-01-01"), root, 0)
    assert merge(records(spark, [], "2024-01-01"), root, 1) == []
    assert merged.read_merged(spark, root).count() == 1
