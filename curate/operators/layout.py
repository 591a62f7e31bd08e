"""File layout: clustering, compaction, the session's adaptive settings."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from curate.session import work_path

ADAPTIVE_SETTINGS = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.autoBroadcastJoinThreshold",
)
# Ranks of keys are taken from about so many sampled rows; they decide where rows
# lie, not what is written.
SAMPLE_ROWS = 20_000
# Rows that one task puts in order take about so much of its memory. Files that would
# need more are written as several: how far a file's bytes unfold is not known before.
SORT_BYTES = 1 << 30
JOURNAL = "_compaction.json"


def _rank(column: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most the value, as a decision tree;
    0 for null."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    above = F.lit(middle + 1) + _rank(column, bounds[middle + 1 :])
    return F.when(column >= F.lit(bounds[middle]), above).otherwise(_rank(column, bounds[:middle]))


def sort_rows(df: DataFrame, count: int) -> int:
    """How many of the ``count`` rows of ``df`` one task may sort: a fixed part for each
    column, and the length of values without a fixed width by a sample."""
    free = [f.name for f in df.schema if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    plain = [F.col(f"`{n}`") if isinstance(df.schema[n].dataType, (T.StringType, T.BinaryType)) else F.to_json(F.array(F.col(f"`{n}`"))) for n in free]
    taken = 0
    if free:
        sizes = df.select([F.coalesce(F.octet_length(c), F.lit(0)).alias(f"c{i}") for i, c in enumerate(plain)])
        sizes = sizes.sample(min(1.0, SAMPLE_ROWS / max(1, count)), seed=1)
        taken = sizes.agg(F.avg(reduce(lambda a, b: a + b, (F.col(c) for c in sizes.columns)))).first()[0] or 0
    return max(1, int(SORT_BYTES / (32 + 16 * len(df.columns) + taken)))


def space_filling_order(df: DataFrame, keys: Sequence[str], bits: int = 6, count: int | None = None) -> Column:
    """A number that keeps rows near in every key together: the ranks of the keys
    among ``2 ** bits`` quantiles, their bits interleaved."""
    share = min(1.0, SAMPLE_ROWS / max(1, df.count() if count is None else count))
    sampled = df.select(*keys).sample(share, seed=1).toPandas()
    order = F.lit(0).cast("long")
    for i, key in enumerate(keys):
        values = sorted(sampled[key].dropna().tolist())
        cuts = (values[len(values) * q // (1 << bits)] for q in range(1, 1 << bits)) if values else ()
        rank = _rank(F.col(key), sorted(set(cuts)))
        spread = [F.shiftleft(F.shiftright(rank, b).bitwiseAND(1).cast("long"), b * len(keys) + len(keys) - 1 - i) for b in range(bits)]
        order = reduce(lambda a, b: a.bitwiseOR(b), spread, order)
    return order


def _clustered(rows: DataFrame, keys: Sequence[str], files: int, count: int) -> DataFrame:
    """``rows`` dealt to ``files`` ranges of the space-filling order. A hash of the
    whole row ends the range key: one that a third of the rows share is spread over
    several files."""
    place = f"order_{uuid.uuid4().hex[:8]}"
    spread = F.xxhash64(*rows.columns)
    placed = rows.withColumn(place, space_filling_order(rows, keys, count=count))
    return placed.repartitionByRange(files, place, spread).sortWithinPartitions(place, *keys).drop(place)


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], files: int | None = None, target_mb: float = 256
) -> int:
    """Write with rows near in the keys in the same files, so that a filter on any
    one of them skips files by their statistics; returns the number of files.

    ``df`` is written once to the shared folder as it comes. Its size there gives
    the number of files, about ``target_mb`` each or less where their rows would
    take more than ``SORT_BYTES`` to sort, and ranks, ranges and rows are then read
    from it instead of being computed three times.
    """
    spark = df.sparkSession
    staged = work_path(spark, "unclustered")
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    count = rows.count()
    by_bytes = ceil(folder_bytes(spark, staged) / (target_mb * (1 << 20)))
    files = files or max(1, by_bytes, ceil(count / sort_rows(rows, count)))
    _clustered(rows, keys, files, count).write.mode("overwrite").parquet(path)
    return files


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """The parquet files below ``path``; their contents stay unread unless asked for."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the parquet files below ``path``, without reading them."""
    return parquet_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def compact(
    spark: SparkSession, path: str, out: str, target_mb: int = 512, keys: Sequence[str] = ()
) -> int:
    """Rewrite many small files as files of about ``target_mb``; returns how many.

    Without ``keys`` the scan's tasks are merged, no shuffle, and files mix what
    lay apart. A table that was clustered names its ``keys`` and is clustered
    again. ``out`` must be a new folder: readers move over when it is whole.
    """
    files = max(1, ceil(folder_bytes(spark, path) / (target_mb << 20)))
    rows = spark.read.parquet(path)
    if keys:
        ranged = rows.repartitionByRange(files, *keys, F.xxhash64(*rows.columns))
        rows = ranged.sortWithinPartitions(*keys)
    else:
        rows = rows.coalesce(files)
    rows.write.mode("errorifexists").parquet(out)
    return parquet_files(spark, out).count()


def bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """``(path, length, folder, bin)`` of the files under ``target_bytes`` that have
    company in their bin: neighbours by name, up to about the target together."""
    small = files.where(F.col("length") < target_bytes).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    upto = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    # Files are counted into bins of twice the target by where they begin, so each gets near it.
    begun = F.coalesce(F.sum("length").over(upto), F.lit(0))
    placed = small.withColumn("bin", F.floor(begun / target_bytes).cast("int"))
    company = Window.partitionBy("folder", "bin")
    return placed.withColumn("n", F.count(F.lit(1)).over(company)).where("n > 1").drop("n")


def _plain(path: Column) -> Column:
    """A path with one slash behind its scheme where no host follows."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):///", "$1:/")


def _filesystem(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def pack(spark: SparkSession, path: str, target_mb: float = 512, keys: Sequence[str] = ()) -> int:
    """Pack the small files below ``path`` into files of about ``target_mb``, where
    they are; returns how many files there were less.

    Files of the target's size and more stay byte for byte, partition folders stay
    what they are, and a small file without another to join stays too. Rows of one
    bin are put in order of ``keys`` where given, which narrows the statistics
    within the merged file. A bin whose rows would take more than ``SORT_BYTES`` to
    sort becomes several files, ranges of the keys.

    New files are written to a hidden folder, then a journal is stored, then they
    take the old ones' place. Between the last two steps readers may meet rows
    twice, so no reader should start then; after a crash there ``finish_compaction``
    ends the work from the journal. Names of small files go through the driver, as
    Spark's own list of files does.
    """
    finish_compaction(spark, path)
    found = bins(parquet_files(spark, path), int(target_mb * (1 << 20))).collect()
    if not found:
        return 0
    mark = uuid.uuid4().hex[:12]
    hidden = f"{path.rstrip('/')}/.compaction-{mark}"
    root = _qualified(spark, path)
    of_bin: dict[tuple[str, int], list[str]] = {}
    for row in found:
        of_bin.setdefault((row["folder"], row["bin"]), []).append(row["path"])
    named = spark.createDataFrame(
        [(p, i) for i, paths in enumerate(of_bin.values()) for p in paths], "path string, bin int"
    ).withColumn("path", _plain(F.col("path")))
    # Partition values lie in the folders' names and are no columns of the files.
    rows = spark.read.option("recursiveFileLookup", True).parquet(*[p for paths in of_bin.values() for p in paths])
    columns = rows.columns
    file, bin_ = f"file_{mark}", f"bin_{mark}"
    rows = rows.withColumn(file, F.col("_metadata.file_path"))
    plain = _plain(F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B"))))
    per_file = rows.groupBy(file).count().withColumn("path", plain).join(F.broadcast(named), "path").select(file, "bin", "count").collect()
    counts: dict[int, int] = {}
    for row in per_file:
        counts[row["bin"]] = counts.get(row["bin"], 0) + row["count"]
    # The driver has the names, so each task may; rows need no shuffle to meet them.
    of_file = spark.createDataFrame([(row[file], row["bin"]) for row in per_file], f"{file} string, {bin_} int")
    binned = rows.join(F.broadcast(of_file), file).select(*columns, bin_)
    limit = sort_rows(rows.select(*columns), sum(counts.values()))
    tasks = sum(ceil(n / limit) for n in counts.values())
    if tasks > len(counts):
        # A hash of the row deals out keys that many rows share.
        ordered = binned.repartitionByRange(tasks, bin_, *keys, F.xxhash64(*columns))
    else:
        ordered = binned.repartitionById(len(of_bin), bin_)
    ordered = ordered.sortWithinPartitions(bin_, *keys)
    ordered.write.partitionBy(bin_).parquet(hidden)
    moves = []
    system = _filesystem(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    for i, (folder, _) in enumerate(of_bin):
        place = jpath(f"{hidden}/{bin_}={i}")
        for status in system.listStatus(place) if system.exists(place) else ():
            # A task may have written rows of two bins, to files of the same name.
            moves.append((status.getPath().toString(), f"{folder}/bin-{i:05d}-{status.getPath().getName()}"))
    journal = {"root": root, "hidden": hidden, "moves": moves, "old": [p for paths in of_bin.values() for p in paths]}
    _store(spark, f"{path.rstrip('/')}/{JOURNAL}", json.dumps(journal))
    finish_compaction(spark, path)
    return len(found) - len(moves)


def _qualified(spark: SparkSession, path: str) -> str:
    return _filesystem(spark, path).makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path)).toString()


def _store(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: beside its place, then renamed into it."""
    system, jpath = _filesystem(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    out = system.create(jpath(f"{path}.tmp"), True)
    out.write(bytearray(text.encode()))
    out.close()
    system.rename(jpath(f"{path}.tmp"), jpath(path))


def finish_compaction(spark: SparkSession, path: str) -> bool:
    """Bring a compaction that has its journal to its end; whether there was one."""
    path = path.rstrip("/")
    system, jpath = _filesystem(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    journal = jpath(f"{path}/{JOURNAL}")
    if not system.exists(journal):
        return False
    source = system.open(journal)
    todo = json.loads(bytes(source.readAllBytes()).decode())
    source.close()
    for old, new in todo["moves"]:
        if system.exists(jpath(old)) and not system.rename(jpath(old), jpath(new)):
            raise OSError(f"cannot move {old} to {new}")
    for old in todo["old"]:
        system.delete(jpath(old), False)
    system.delete(jpath(todo["hidden"]), True)
    system.delete(journal, False)
    spark.catalog.refreshByPath(path)
    return True


def runtime_settings(spark: SparkSession) -> dict[str, str]:
    return {name: spark.conf.get(name) for name in ADAPTIVE_SETTINGS}
