"""A vector index: documents dealt to cells once, searches that open few of them.

A cell holds the documents nearest to one pivot, at a like angle from it. By the
triangle inequality for angles no document of a cell can score above a bound that
follows from the question, the pivot and the cell's angles and lengths alone, so
cells whose bound is below a question's k-th score stay closed and nothing is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from curate.fixed_values import DEFAULT_K
from curate.operators.knn import BLOCK_ROWS, OPENED, _matrix, ranked, scan, searched, write_questions
from curate.session import work_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pivots are fitted to so many sampled documents each; every document is indexed.
SAMPLE_PER_PIVOT = 32
ROUNDS = 6
# Angles are known to about 1e-8 where they are small.
SLACK = 1e-6
# Rows of questions with their vectors, one per cell, that a task makes at once.
PROBE_ROWS = 16_384


@dataclass(frozen=True)
class VectorIndex:
    """Where the documents lie, the pivots, and per cell its number, pivot, rows and
    the least and greatest angle and length. Its size follows from ``pivots`` and
    ``rings``, not from the documents, so it may travel to every task."""

    path: str
    schema: T.StructType
    pivots: np.ndarray
    cells: dict[str, np.ndarray]

    def documents(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)

    def bounds(self, questions: np.ndarray) -> np.ndarray:
        """No document of a cell scores higher, per question and cell."""
        size, unit = _unit(questions)
        angle = np.arccos(np.clip(unit @ self.pivots.T, -1, 1))[:, self.cells["pivot"]]
        gap = np.maximum(self.cells["low"] - angle, angle - self.cells["high"])
        cosine = np.cos(np.clip(gap - SLACK, 0, np.pi))
        length = np.where(cosine >= 0, self.cells["longest"], self.cells["shortest"])
        return size[:, None] * (length * cosine + SLACK * self.cells["longest"])


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.sqrt((vectors * vectors).sum(1))
    return size, vectors / np.where(size == 0, 1, size)[:, None]


def fit_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Directions that the sample gathers around: mutually far ones to begin with,
    then means of those nearest to each."""
    _, unit = _unit(sample)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(pivots, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    centres = unit[chosen]
    for _ in range(ROUNDS):
        own = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        size, moved = _unit(sums)
        centres = np.where(size[:, None] > 0, moved, centres)
    return centres


def build_index(
    docs: DataFrame, path: str, pivots: int = 64, rings: int = 4, keep: tuple[str, ...] = ()
) -> VectorIndex:
    """Index every row of ``docs`` (doc_id, vec and the columns to ``keep``) that has
    a vector, as a table below ``path``.

    Pivots are fitted to ``pivots * SAMPLE_PER_PIVOT`` documents drawn by a hash of
    their ids; where the sample is poor cells are wide and searches open more of
    them, with the same hits. A cell of any size lies in several files: ranges go
    by cell, angle and a hash of the id.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "vec", *keep).where(F.col("vec").isNotNull())
    drawn = rows.select("vec").orderBy(F.xxhash64("doc_id")).limit(pivots * SAMPLE_PER_PIVOT).toArrow()
    sample = _matrix(drawn.column("vec")) if drawn.num_rows else np.zeros((1, 1))
    centres = fit_pivots(sample, pivots)
    _, unit = _unit(sample)
    own = np.arccos(np.clip((unit @ centres.T).max(1), -1, 1))
    edges = np.quantile(own, np.arange(1, rings) / rings)

    schema = T.StructType([*rows.schema, T.StructField("cell", T.IntegerType()), *(T.StructField(n, T.DoubleType()) for n in ("angle", "length"))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in batches:
            if not batch.num_rows:
                continue
            size, unit = _unit(_matrix(batch.column("vec")))
            cosine = np.clip(unit @ centres.T, -1, 1)
            pivot = cosine.argmax(1)
            angle = np.arccos(cosine[np.arange(len(pivot)), pivot])
            cell = pivot * rings + np.searchsorted(edges, angle)
            added = [pa.array(cell.astype("int32")), pa.array(angle), pa.array(size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema=out)

    placed = rows.mapInArrow(place, schema)
    ranged = placed.repartitionByRange("cell", "angle", F.xxhash64("doc_id"))
    ranged.sortWithinPartitions("cell", "angle").write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    figures = stored.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), *(f(c).alias(a) for a, f, c in (
            ("low", F.min, "angle"), ("high", F.max, "angle"), ("shortest", F.min, "length"), ("longest", F.max, "length")))
    )
    # At most pivots * rings rows.
    table = figures.orderBy("cell").toArrow()
    cells = {name: table.column(name).to_numpy() for name in table.column_names}
    cells["pivot"] = cells["cell"] // rings
    return VectorIndex(path, schema, centres, cells)


@dataclass(frozen=True)
class Searched:
    """``hits`` as of ``knn_join``, and per question how many documents were
    ``scored`` of ``total``."""

    hits: DataFrame
    scored: DataFrame


def _opening(index: VectorIndex, batch: pa.RecordBatch, first: bool, probes: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Per question the places of the cells, best bound first, and which of these to open.
    The ``first`` ones hold k documents or are ``probes`` in number; later all others
    whose bound the question's ``floor`` does not beat."""
    count = index.cells["n"]
    bound = index.bounds(_matrix(batch.column("vec")))
    order = np.argsort(-bound, axis=1, kind="stable")
    ahead = np.cumsum(count[order], axis=1) - count[order]
    k = batch.column("k").to_numpy()[:, None]
    opened = (np.arange(bound.shape[1])[None, :] < probes) if probes else ahead < k
    opened = np.broadcast_to(opened, bound.shape)
    if not first:
        floor = batch.column("floor").to_numpy()[:, None]
        opened = ~opened & (np.take_along_axis(bound, order, 1) >= floor)
    return order, opened


def _steps(batches: Iterator[pa.RecordBatch], index: VectorIndex) -> Iterator[pa.RecordBatch]:
    """Questions that with every cell make at most ``PROBE_ROWS`` rows."""
    step = max(1, PROBE_ROWS // max(1, len(index.cells["n"])))
    for whole in batches if len(index.cells["n"]) else ():
        yield from (whole.slice(at, step) for at in range(0, whole.num_rows, step))


def _probes(questions: DataFrame, index: VectorIndex, first: bool, probes: int | None) -> DataFrame:
    """A row with the question per question and cell to open, for few cells to a question."""
    schema = T.StructType([*questions.schema, T.StructField("cell", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in _steps(batches, index):
            order, opened = _opening(index, batch, first, probes)
            q, place = np.nonzero(opened)
            cell = order[q, place]
            columns = batch.take(pa.array(q)).columns
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(index.cells["cell"][cell].astype("int32")), pa.array(index.cells["n"][cell])], schema=out
            )
        pa.default_memory_pool().release_unused()

    return questions.mapInArrow(run, schema)


def _masks(questions: DataFrame, index: VectorIndex, first: bool) -> DataFrame:
    """The questions that open some cell, once each: a bit per cell of the index in
    ``OPENED``, and how many documents ``n`` these cells hold."""
    schema = T.StructType([*questions.schema, T.StructField(OPENED, T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in _steps(batches, index):
            order, opened = _opening(index, batch, first, None)
            mask = np.zeros(opened.shape, bool)
            np.put_along_axis(mask, order, opened, 1)
            some = np.flatnonzero(mask.any(1))
            bits = np.packbits(mask[some], axis=1)
            packed = pa.Array.from_buffers(pa.binary(bits.shape[1]), len(some), [None, pa.py_buffer(bits.tobytes())])
            added = [packed.cast(pa.binary()), pa.array(mask[some] @ index.cells["n"])]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(some)).columns, *added], schema=out)
        pa.default_memory_pool().release_unused()

    return questions.mapInArrow(run, schema)


def _any_opened(masked: DataFrame, index: VectorIndex) -> list[int]:
    """Cells that some question opens, at most as many as the index has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = -(-len(index.cells["n"]) // 8)
        held = np.zeros(width, np.uint8)
        for batch in batches:
            if batch.num_rows:
                held |= np.bitwise_or.reduce(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width), 0)
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["held"])

    bits = [np.frombuffer(r.held, np.uint8) for r in masked.select(OPENED).mapInArrow(run, "held binary").collect()]
    if not bits or not len(index.cells["n"]):
        return []
    held = np.unpackbits(np.bitwise_or.reduce(bits, 0), count=len(index.cells["n"])).astype(bool)
    return index.cells["cell"][held].tolist()


def search_index(
    questions: DataFrame, index: VectorIndex, k: int = DEFAULT_K, probes: int | None = None,
    group: str | None = None, block_rows: int = BLOCK_ROWS,
) -> Searched:
    """The hits of ``knn_join`` from an index.

    Exact by default: each question opens its most promising cells until they hold
    k documents, and then those cells whose bound its k-th score so far does not
    beat. With ``probes`` it opens that many cells only, and may miss hits. Both
    passes read only the cells that some question opens. ``groups`` of a question
    apply as in ``knn_join``; a question that may see few documents opens more.
    """
    spark = questions.sparkSession
    own = {"k", "groups"} & set(questions.columns)
    asked = questions.select(
        "question_id", "vec", (F.col("k") if "k" in own else F.lit(k)).cast("int").alias("k"),
        *(["groups"] if "groups" in own else []),
    ).where(F.col("vec").isNotNull() & (F.col("k") > 0))
    docs = index.documents(spark)
    opened_paths, hit_paths, most = [], [], 0
    floors = None
    for first in (True, False) if probes is None else (True,):
        wanted = asked
        if floors is not None:
            wanted = asked.join(floors, "question_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        if probes is None:
            # A question may open nearly all cells, so it is written once, with a bit for each.
            folder, kind, largest = write_questions(_masks(wanted, index, first), k, block_rows, merge=False)
            masked = spark.read.schema(T.StructType([T.StructField("question_id", kind), T.StructField(OPENED, T.BinaryType()), T.StructField("n", T.LongType())])).parquet(folder)
            cells = _any_opened(masked, index)
            opened_paths.append(masked.select("question_id", "n"))
            bits = {cell: i for i, cell in enumerate(index.cells["cell"].tolist())}
        else:
            path = work_path(spark, "probes")
            probe = _probes(wanted, index, first, probes)
            probe.write.parquet(path)
            probe = spark.read.schema(probe.schema).parquet(path)
            # At most as many as the index has cells.
            cells = [r[0] for r in probe.select("cell").distinct().collect()]
            folder, kind, largest = write_questions(probe.drop("n"), k, block_rows)
            opened_paths.append(probe.select("question_id", "n"))
            bits = None
        most = max(most, largest)
        among = searched(docs.where(F.col("cell").isin(cells)), ["cell"], None, group)
        path = work_path(spark, "hits")
        best = ranked(scan(among, folder, kind, [], by_cell=True, bits=bits), most).drop("rank")
        best.write.parquet(path)
        hits = spark.read.schema(best.schema).parquet(path)
        hit_paths.append(hits)
        full = F.count(F.lit(1)) >= F.first("k")
        floors = hits.groupBy("question_id").agg(F.when(full, F.min("score")).alias("floor"))
    hits, opened = hit_paths[0], opened_paths[0]
    for more, others in zip(hit_paths[1:], opened_paths[1:]):
        hits, opened = hits.unionByName(more), opened.unionByName(others)
    scored = asked.select("question_id").join(opened.groupBy("question_id").agg(F.sum("n").alias("scored")), "question_id", "left")
    return Searched(
        ranked(hits, most).select("question_id", "doc_id", "score", "rank"),
        scored.select("question_id", F.coalesce("scored", F.lit(0)).alias("scored"), F.lit(int(index.cells["n"].sum())).alias("total")),
    )
