"""Named tables, full replacement, append-only logs and layer names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from curate.fixed_values import LAYERS

# Folders of a log: the day of a run, then the run.
LOG_DATE = "log_date"
LOG_RUN = "log_run"
# Folder of the list of runs that readers may follow.
PUBLISHED = "published_runs"


def _is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A catalog table, or a parquet folder where ``target`` is a path."""
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def write_replace(df: DataFrame, target: str) -> None:
    """Replace the whole of ``target``. It must not be an input of ``df``.

    A folder is written beside the old one and takes its place when it is whole,
    by renaming: a job that fails leaves the old table as it was.
    """
    if not _is_path(target):
        df.write.mode("overwrite").format("parquet").saveAsTable(target)
        return
    target = target.rstrip("/")
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{target}.next-{mark}", f"{target}.old-{mark}"
    df.write.parquet(fresh)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(conf)
    replaced = system.exists(path(target))
    if replaced and not system.rename(path(target), path(old)):
        raise OSError(f"cannot move {target} away")
    if not system.rename(path(fresh), path(target)):
        if replaced:
            system.rename(path(old), path(target))
        raise OSError(f"cannot move {fresh} into place")
    if replaced:
        system.delete(path(old), True)


def _published(spark: SparkSession, root: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{PUBLISHED}")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(system, folder) -> list[int]:
    if not system.exists(folder):
        return []
    names = (status.getPath().getName() for status in system.listStatus(folder))
    return sorted(int(name) for name in names if name.isdigit())


def publish_run(spark: SparkSession, root: str, run: str) -> None:
    """Make ``run`` the one that readers of ``root`` follow.

    Everything the run wrote must be in place. The list gets one small file under
    the next number, created only if nobody else has taken that number: of two runs
    that end together both are listed, and readers see either run whole.
    """
    folder, system = _published(spark, root)
    system.mkdirs(folder)
    number = max(_numbers(system, folder), default=-1) + 1
    while not _written_first(system, spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}"), run.encode()):
        number += 1


def _written_first(system, place, text: bytes) -> bool:
    """Write ``text`` to the file ``place``, or nothing if somebody else has made it."""
    if system.getUri().getScheme() == "file":
        # Hadoop's local files are looked for first and made then, so two can make one.
        try:
            with open(place.toUri().getPath(), "xb") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = system.create(place, False)
    except Py4JJavaError:
        if not system.exists(place):
            raise
        return False
    out.write(bytearray(text))
    out.close()
    return True


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """The runs published below ``root``, oldest first; a file without its text yet
    is of a run that is not published yet."""
    folder, system = _published(spark, root)
    runs = []
    for number in _numbers(system, folder):
        source = system.open(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}"))
        runs.append(bytes(source.readAllBytes()).decode())
        source.close()
    return [run for run in runs if run]


def append_log(df: DataFrame, path: str) -> None:
    """Add the rows of a run (``run_id``, ``run_ts``) to a parquet log.

    They lie under the run's day and id, so a run that is repeated replaces its
    own rows, and readers of some days skip the others. Later runs may bring new
    columns.
    """
    placed = df.withColumns({LOG_DATE: F.to_date("run_ts"), LOG_RUN: F.col("run_id")})
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(LOG_DATE, LOG_RUN).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log under one schema; columns a run did not have are NULL.

    A log of ``append_log`` also has the day of each run as ``LOG_DATE``.
    """
    return spark.read.option("mergeSchema", True).parquet(path).drop(LOG_RUN)


def as_view(df: DataFrame, name: str) -> str:
    """Make ``df`` available to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return name


def create_layers(spark: SparkSession, layers: tuple[str, ...] = LAYERS) -> None:
    """One catalog schema per layer."""
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def layer_table(layer: str, table: str, catalog: str | None = None) -> str:
    """Qualified name, so that nothing lands in a session's default schema."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return ".".join(part for part in (catalog, layer, table) if part)


def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{table}"
