"""A table of one record per key that batches are merged into, bucket by bucket.

Keys are dealt to hash buckets. A batch reads and rewrites only the buckets its
keys fall in, into a folder of its own generation, and then publishes which
generation each bucket is in. Readers follow the newest published list, so a batch
that fails leaves them the table as it was, and buckets it does not touch keep
their files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curate.operators.dedup import dedup_latest

BUCKETS = 64
BUCKET, GENERATION = "bucket", "generation"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _generations(spark: SparkSession, root: str) -> list[int]:
    """Published generations, oldest first. A list counts once it is whole."""
    place, system = _system(spark, f"{root}/published")
    if not system.exists(place):
        return []
    names = ((s.getPath(), s.getPath().getName()) for s in system.listStatus(place))
    path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n.partition("=")[2]) for p, n in names if n.startswith(GENERATION) and system.exists(path(p, "_SUCCESS")))


def _places(spark: SparkSession, root: str, before: int | None = None) -> dict[int, int]:
    """Bucket to generation, as of the newest list (before ``before``): at most as
    many entries as there are buckets."""
    known = [g for g in _generations(spark, root) if before is None or g < before]
    if not known:
        return {}
    rows = spark.read.schema(f"{BUCKET} int, of int").parquet(f"{root}/published/{GENERATION}={known[-1]}").collect()
    return {r[BUCKET]: r["of"] for r in rows}


def _folder(root: str, generation: int, bucket: int) -> str:
    return f"{root}/data/{GENERATION}={generation}/{BUCKET}={bucket}"


def _read(spark: SparkSession, root: str, places: dict[int, int]) -> DataFrame | None:
    if not places:
        return None
    folders = [_folder(root, g, b) for b, g in sorted(places.items())]
    schema = spark.read.parquet(f"{root}/schema").schema
    return spark.read.schema(schema).parquet(*folders)


def merge_batch(
    records: DataFrame, root: str, batch_id: int, key: str, latest: str, then: str, buckets: int = BUCKETS
) -> list[int]:
    """Merge ``records`` into the table at ``root``; returns the buckets rewritten.

    One row per ``key`` stays, the best under ``dedup_latest`` of what the table and
    the batch hold; the order is total, so batches may be merged one by one. A batch
    that runs again starts from the list before it and replaces its own folder.
    ``buckets`` belongs to the table and may not change. Rows with a null key count
    as one key. An empty batch publishes the old list again.
    """
    spark = records.sparkSession
    before = _places(spark, root, batch_id)
    if not before:
        records.limit(0).write.mode("overwrite").parquet(f"{root}/schema")
    bucketed = records.withColumn(BUCKET, _bucket(key, buckets))
    # At most as many values as there are buckets.
    touched = sorted(r[0] for r in bucketed.select(BUCKET).distinct().collect())
    old = _read(spark, root, {b: g for b, g in before.items() if b in set(touched)})
    rows = records if old is None else records.unionByName(old.select(*records.columns))
    merged = dedup_latest(rows, key, latest, then).withColumn(BUCKET, _bucket(key, buckets))
    # A bucket's rows meet in one task, so it gets one file.
    merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/data/{GENERATION}={batch_id}")
    places = {**before, **dict.fromkeys(touched, batch_id)}
    listed = spark.createDataFrame(sorted(places.items()), f"{BUCKET} int, of int")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{root}/published/{GENERATION}={batch_id}")
    return touched


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    """The table as last published."""
    rows = _read(spark, root, _places(spark, root))
    if rows is None:
        raise FileNotFoundError(f"no batch has been merged into {root}")
    return rows


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove the folders that none of the newest ``keep`` lists names, and older
    lists. Readers of older lists must be done."""
    known = _generations(spark, root)
    named = {(g, b) for k in known[-keep:] for b, g in _places(spark, root, k + 1).items()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    place, system = _system(spark, f"{root}/data")
    for generation in system.listStatus(place) if system.exists(place) else ():
        number = int(generation.getPath().getName().partition("=")[2])
        # A folder without a list may be of a batch that is being written.
        if number > (known or [-1])[-1]:
            continue
        for folder in system.listStatus(generation.getPath()):
            name = folder.getPath().getName()
            if name.startswith(BUCKET) and (number, int(name.partition("=")[2])) not in named:
                system.delete(folder.getPath(), True)
    for old in known[:-keep]:
        system.delete(path(f"{root}/published/{GENERATION}={old}"), True)
