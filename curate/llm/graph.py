"""Connected components by joins, for graphs that fit no single machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curate.session import work_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _roots(parents: DataFrame) -> DataFrame:
    """``node, root`` from ``node, root`` where a root is a smaller node or itself:
    each takes its root's root until nothing changes, so paths halve."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = stored(parents.join(up, "root").select("node", F.col("further"), "root"), "roots")
        parents = after.select("node", F.col("further").alias("root"))
        if after.where(F.col("further") != F.col("root")).isEmpty():
            return parents


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge between different nodes once, the lesser node first."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node of each component, for edges ``a, b``.

    In a round every node hooks to its least neighbour below it, the trees shrink to
    their roots, and edges within a tree go. At least half of the nodes that still
    have edges go with each round, and the edges left are read, not all of them.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stored(nodes.select("node", F.col("node").alias("root")), "labels")
    left = stored(_ordered(edges), "edges")
    while not left.isEmpty():
        ends = F.explode(F.array(F.struct(F.col("b").alias("node"), F.col("a").alias("root")), F.struct(F.col("a").alias("node"), F.col("a").alias("root"))))
        hooked = stored(left.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.min("root").alias("root")), "hooked")
        roots = _roots(hooked)
        first = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
        second = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
        left = stored(_ordered(left.join(first, "a").join(second, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))), "edges")
        moved = roots.select(F.col("node").alias("root"), F.col("root").alias("to"))
        labels = stored(labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
    return labels
