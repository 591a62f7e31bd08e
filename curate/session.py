"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Tells the work folders of one driver process from those of others.
_PROCESS = uuid.uuid4().hex[:12]


def build_session(app_name: str = "curate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the time zone pinned to UTC.

    Cluster sizing (master, memory, shuffle partitions) is left to spark-submit
    unless given here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_conf(input_bytes: int, partition_mb: int = 256) -> dict[str, str]:
    """Settings that keep scan and shuffle partitions near ``partition_mb``.

    Adaptive execution merges partitions that turn out small, so the number is
    chosen from the size before anything is filtered or folded away.
    """
    target = partition_mb << 20
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // target))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back to a folder of its own; on a cluster an
    unset ``spark.checkpoint.dir`` is an error, because a machine-local folder
    would lose data with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="curate-"))
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. Nothing there is used twice, and nothing
    removed until ``drop_work``, since results may read it."""
    return f"{shared_dir(spark)}/curate/{name}-{_PROCESS}-{uuid.uuid4().hex[:12]}"


def drop_work(spark: SparkSession) -> None:
    """Remove what this driver process has written below ``work_path``. Call it when
    all results that are still wanted are stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    place = path(f"{shared_dir(spark)}/curate")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(place) if system.exists(place) else ():
        if f"-{_PROCESS}-" in status.getPath().getName():
            system.delete(status.getPath(), True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and host, as Spark itself resolves it: for readers in
    tasks, which would take a bare path for one on their own disk."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return re.sub("^file:/(?=[^/])", "file:///", full)
