"""Exact best-k search of a question table in a document table.

Documents stay where they are. The questions are written once to the shared
folder as files of bounded size, and every task streams these files past its
documents, a chunk of bounded size at a time. A chunk and a block of questions, of
one file or of several small ones, are scored as matrix products; at most k hits
per question leave a chunk. No pair is ever written down, no document is copied,
and the plan is the same for ten questions and for ten million.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from curate.fixed_values import DEFAULT_K
from curate.session import qualified, work_path

# Tasks get this module's helpers with the function itself, so executors need
# not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Products are taken in single precision of vectors scaled to a length of 1 at most,
# and err by less than this for every number of a vector, and a few more for the
# scaling. What may be among the best by it is scored again with compensated sums,
# so that ranks follow the scores themselves and equal scores the ids.
PRODUCT_ERROR = 2.0**-23
# Scores held at once per task, and numbers of candidates scored again at once.
_CELLS = 2_000_000
# Rows of a file of questions, and of a block that is scored at once.
BLOCK_ROWS = 16_384
# A chunk of documents is closed when it has so many rows or bytes: files of
# questions are read once for each, so its size does not follow theirs.
CHUNK_ROWS = 65_536
CHUNK_BYTES = 16 << 20

LOWEST, HIGHEST = "lowest", "highest"
# Names that carried columns will not have.
VALUE, GROUP = "searched_value", "searched_group"
# Bits of the cells that a question opens.
OPENED = "opened"


def _matrix(column: pa.Array | pa.ChunkedArray, dtype: str | None = "float64") -> np.ndarray:
    """A column of equally long lists as a matrix, without Python objects; without a
    ``dtype`` in single precision where the column is, else in double."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.unique(pc.list_value_length(column))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.to_pylist()}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype or _float_type(column), copy=False)
    return flat.reshape(len(column), -1)


def _float_type(column: pa.Array) -> str:
    return "float32" if pa.types.is_float32(column.type.value_type) else "float64"


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype="float64"))


def _scaled(vectors: np.ndarray, by: np.ndarray | float) -> np.ndarray:
    """``vectors`` in single precision, divided by lengths; those of none stay zero."""
    by = np.where(by == 0, 1, by)
    return (vectors / (by[:, None] if by.ndim else by)).astype("float32")


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``. What each addition rounds off
    is added up too; the order is the same for every row, so equal rows tie."""
    total, lost = np.zeros(len(a)), np.zeros(len(a))
    for j in range(a.shape[1]):
        term = a[:, j] * b[:, j]
        added = total + term
        back = added - total
        lost += (total - (added - back)) + (term - back)
        total = added
    return total + lost


def _copy_numbers(vectors: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many rows before each one have the same vector and group.

    Such rows tie under every question, so beyond the first k none is a hit.
    Rows are told apart by a hash, and those that differ from the first row of
    their hash count as unlike any other.
    """
    bits = np.ascontiguousarray(vectors).view(f"u{vectors.dtype.itemsize}")
    factors = np.random.default_rng(1).integers(1, 2**63, bits.shape[1], dtype=np.uint64) | np.uint64(1)
    hashes = group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    step = max(1, _CELLS // max(1, bits.shape[1]))
    for at in range(0, len(bits), step):
        hashes[at : at + step] += (bits[at : at + step] * factors).sum(1, dtype=np.uint64)
    _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(of, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(of[order]) > 0)[: len(order)])
    number = np.empty(len(of), np.int64)
    number[order] = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
    repeated = np.flatnonzero(number > 0)
    for at in range(0, len(repeated), step):
        part = repeated[at : at + step]
        lead = first[of[part]]
        unlike = (vectors[part] != vectors[lead]).any(1) | (group[part] != group[lead])
        number[part[unlike]] = 0
    return number


@dataclass
class _Questions:
    """A block of questions. ``end`` is -1, 1 or 0: the search is among the documents
    of the lowest value, of the highest, or among all."""

    table: pa.Table
    vectors: np.ndarray = field(init=False)
    ks: np.ndarray = field(init=False)
    end: np.ndarray = field(init=False)
    floor: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.vectors = _matrix(self.table.column("vec"))
        self.ks = self.table.column("k").to_numpy()
        self.end = self.table.column("end").to_numpy()
        self.floor = self.table.column("floor").to_numpy().copy()
        self.length = _lengths(self.vectors)
        self.support = self._support()

    def _support(self) -> np.ndarray | None:
        """Where each question's vector is not zero, in order, filled up with places
        of zeros; None unless that is a small part of every vector. The other places
        add nothing to a score, and nothing to what its sum rounds off."""
        filled = self.vectors != 0
        most = int(filled.sum(1).max(initial=0))
        if 4 * most > filled.shape[1]:
            return None
        return np.sort(np.argsort(~filled, axis=1, kind="stable")[:, :most], axis=1)

    def only(self, rows: np.ndarray) -> _Questions:
        """The questions ``rows``, with the floors they have by now."""
        if len(rows) == len(self.ks):
            return self
        some = _Questions(self.table.take(pa.array(rows)))
        some.floor = self.floor[rows]
        return some

    def opening(self, bit: int) -> np.ndarray:
        """Which questions have the ``bit`` set in their ``OPENED``."""
        column = self.table.column(OPENED).combine_chunks()
        at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)[:-1]
        data = np.frombuffer(column.buffers()[2], np.uint8)
        return np.flatnonzero((data[at + (bit >> 3)] >> (7 - (bit & 7))) & 1)

    def scores(self, vectors: np.ndarray, row: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exactly rounded scores of the documents ``row`` for the questions ``which``."""
        out = np.empty(len(row))
        width = vectors.shape[1] if self.support is None else self.support.shape[1]
        again = max(1, _CELLS // max(1, width))
        for at in range(0, len(row), again):
            r, q = row[at : at + again], which[at : at + again]
            if self.support is None:
                out[at : at + again] = _dots(vectors[r].astype("float64", copy=False), self.vectors[q])
            else:
                place = self.support[q]
                held = vectors[r[:, None], place].astype("float64", copy=False)
                out[at : at + again] = _dots(held, self.vectors[q[:, None], place])
        return out

    def allowed(self, groups: pa.Array) -> np.ndarray | None:
        """Which question may see which group; None where all see all."""
        if "groups" not in self.table.column_names:
            return None
        sets = self.table.column("groups").combine_chunks()
        out = np.repeat(sets.is_null().to_numpy(zero_copy_only=False)[None, :], len(groups), axis=0)
        owner = pc.list_parent_indices(sets).to_numpy()
        place = pc.index_in(sets.flatten(), value_set=groups)
        known = place.is_valid().to_numpy(zero_copy_only=False)
        out[place.drop_null().to_numpy(), owner[known]] = True
        # Null stands for no group at all and is seen by the unrestricted only.
        out[groups.is_null().to_numpy(zero_copy_only=False)] &= sets.is_null().to_numpy(zero_copy_only=False)
        return out


class _Chunk:
    """Documents of one task, by id, with what a search in them needs."""

    def __init__(self, table: pa.Table):
        table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_start"))
        self.table = table.combine_chunks()
        self.vectors = _matrix(self.table.column("vec"), None)
        self.longest = float(_lengths(self.vectors).max(initial=0))
        if GROUP in table.column_names:
            coded = table.column(GROUP).combine_chunks().dictionary_encode(null_encoding="encode")
            self.groups, self.group = coded.dictionary, coded.indices.to_numpy()
        else:
            self.groups, self.group = pa.nulls(1), np.zeros(len(table), np.int64)
        self.copy = _copy_numbers(self.vectors, self.group)
        self.value = table.column(VALUE).to_numpy() if VALUE in table.column_names else None

    def best(self, asked: _Questions) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``question, document, score, edge`` of the hits; ``edge`` orders the ends
        of the value, lowest first, and is NaN for searches among all."""
        parts = []
        plain = np.flatnonzero(asked.end == 0)
        parts.append((*self._among(asked, plain, None), np.nan))
        if self.value is not None and not np.isnan(self.value).all():
            for sign in (-1, 1):
                edge = np.nanmin(-sign * self.value)
                of_end = np.flatnonzero(asked.end == sign)
                parts.append((*self._among(asked, of_end, np.flatnonzero(-sign * self.value == edge)), edge))
        edges = np.concatenate([np.full(len(p[0]), p[3]) for p in parts])
        q, doc, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return q, doc, score, edges

    def _among(self, asked: _Questions, which: np.ndarray, rows: np.ndarray | None):
        """The best k of the documents ``rows`` for the questions ``which``."""
        hits = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if not len(which):
            return hits
        # Within a subset copies count anew.
        copy = self.copy if rows is None else _copy_numbers(self.vectors[rows], self.group[rows])
        rows = np.arange(len(self.copy)) if rows is None else rows
        ks = asked.ks[which]
        everywhere = asked.end[which[0]] == 0
        rows = rows[copy < ks.max()]
        floor = asked.floor[which].copy() if everywhere else np.full(len(which), -np.inf)
        allowed = asked.allowed(self.groups)
        questions = _scaled(asked.vectors[which], asked.length[which])
        # A slice is copied in double precision, so its numbers are bounded as its scores are.
        step = max(1, _CELLS // max(len(which), self.vectors.shape[1]))
        for at in range(0, len(rows), step):
            hits = self._slice(rows[at : at + step], asked, which, questions, ks, floor, allowed, hits)
        if everywhere:
            asked.floor[which] = floor
        return which[hits[0]], hits[1], hits[2]

    def _slice(self, rows, asked, which, questions, ks, floor, allowed, hits):
        """``hits`` with those of ``rows``; raises ``floor`` to the k-th best so far."""
        vectors = self.vectors[rows]
        rough = _scaled(vectors, np.float64(self.longest)) @ questions.T
        seen = None if allowed is None else allowed[self.group[rows]][:, which]
        if seen is not None:
            rough[~seen] = -np.inf
        error = PRODUCT_ERROR * (vectors.shape[1] + 8)
        scale = self.longest * asked.length[which]
        # Below the k-th best of what was seen, or of this slice, nothing counts.
        least = floor / np.where(scale == 0, 1, scale) - error
        for k in np.unique(ks):
            own = np.flatnonzero((ks == k) & np.isneginf(floor))
            if len(own) and k <= len(rows):
                kth = np.partition(np.ascontiguousarray(rough[:, own].T), len(rows) - k, axis=1)[:, len(rows) - k]
                least[own] = kth - 2 * error
        # A question or documents of length 0 score 0 under anything.
        least[scale == 0] = -np.inf
        near = rough >= np.nextafter(least.astype("float32"), np.float32(-np.inf))
        if seen is not None:
            near &= seen
        row, q = np.divmod(np.flatnonzero(near), len(which))
        if not len(row):
            return hits
        score = asked.scores(vectors, row, which[q])
        touched = np.zeros(len(which), bool)
        touched[q] = True
        # Only questions with something new are ranked again.
        again = touched[hits[0]]
        rest = tuple(h[~again] for h in hits)
        q, doc, score = (np.concatenate(p) for p in zip((h[again] for h in hits), (q, rows[row], score)))
        order = np.lexsort((doc, -score, q))
        q, doc, score = q[order], doc[order], score[order]
        starts = np.searchsorted(q, np.arange(len(ks)))
        place = np.arange(len(q)) - starts[q]
        full = np.flatnonzero(np.bincount(q, minlength=len(ks)) >= ks)
        floor[full] = np.maximum(floor[full], score[starts[full] + ks[full] - 1])
        kept = place < ks[q]
        return tuple(np.concatenate(p) for p in zip(rest, (q[kept], doc[kept], score[kept])))


def _files(folder: str) -> tuple[pyarrow.fs.FileSystem, list[str]]:
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    found = system.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
    return system, sorted(f.path for f in found if f.path.endswith(".parquet"))


def _batches(system: pyarrow.fs.FileSystem, paths: list[str]) -> Iterator[pa.RecordBatch]:
    for path in paths:
        with system.open_input_file(path) as source:
            yield from pyarrow.parquet.ParquetFile(source).iter_batches(BLOCK_ROWS)


def _read(system: pyarrow.fs.FileSystem, paths: list[str]) -> Iterator[_Questions]:
    """Blocks of the files' questions, always the same ones for the same files."""
    yield from map(_Questions, _gathered(_batches(system, paths), BLOCK_ROWS, CHUNK_BYTES))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.Table]:
    """Tables of at most ``rows`` rows and about ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    n = taken = 0
    for batch in batches:
        each = max(1, batch.nbytes // max(1, batch.num_rows))
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, max(1, min(rows - n, (size - taken) // each)))
            held.append(part)
            at, n, taken = at + part.num_rows, n + part.num_rows, taken + part.num_rows * each
            if n >= rows or taken + each > size:
                yield pa.Table.from_batches(held)
                held, n, taken = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _hits(chunk: _Chunk, asked: _Questions, schema: pa.Schema) -> pa.Table:
    q, doc, score, edge = chunk.best(asked)
    columns = {
        "question_id": asked.table.column("question_id").take(pa.array(q)),
        "score": pa.array(score),
        "k": pa.array(asked.ks[q].astype("int32")),
        "edge": pa.array(edge, mask=np.isnan(edge)),
    }
    held = chunk.table.take(pa.array(doc))
    found = (columns[f.name] if f.name in columns else held.column(f.name) for f in schema)
    return pa.table([c if c.type == f.type else c.cast(f.type) for c, f in zip(found, schema)], schema=schema)


def write_questions(questions: DataFrame, k: int, block_rows: int, merge: bool = True) -> tuple[str, T.DataType, int]:
    """Questions as files of at most ``block_rows`` rows; gives their folder, the
    type of their ids and the largest k. Without ``merge`` they are written as they
    come, with no shuffle, and small files are joined by their readers only."""
    spark = questions.sparkSession
    given = set(questions.columns)
    asked = questions.select(
        "question_id",
        "vec",
        (F.col("k") if "k" in given else F.lit(k)).cast("int").alias("k"),
        (F.col("end") if "end" in given else F.lit(0)).cast("int").alias("end"),
        (F.col("floor") if "floor" in given else F.lit(float("-inf"))).alias("floor"),
        *(["groups"] if "groups" in given else []),
        *(c for c in ("cell", OPENED, "n") if c in given),
    ).where(F.col("vec").isNotNull() & (F.col("k") > 0))
    folder = work_path(spark, "questions")
    # Merged to files of fair size, split where one cell is asked by very many.
    merged = asked.hint("rebalance", *([F.col("cell")] if "cell" in given else [])) if merge else asked
    writer = merged.write.option("maxRecordsPerFile", block_rows)
    (writer.partitionBy("cell") if "cell" in given else writer).parquet(folder)
    written = spark.read.schema(asked.schema).parquet(folder)
    most = written.agg(F.max("k")).first()[0] if "k" in given else k
    return qualified(spark, folder), asked.schema["question_id"].dataType, most or 0


def scan(
    docs: DataFrame, folder: str, question_type: T.DataType, carry: list[str], by_cell: bool = False,
    bits: dict[int, int] | None = None,
) -> DataFrame:
    """Hits of every chunk of ``docs``: question_id, doc_id, score, k, edge and the
    columns to ``carry``. With ``by_cell`` the questions of a document's cell are
    asked only, and a chunk has one cell: those in the cell's folder or, with ``bits``,
    those that have the cell's bit set in ``OPENED``."""
    fields = [T.StructField("question_id", question_type), docs.schema["doc_id"]]
    fields += [T.StructField(n, t) for n, t in (("score", T.DoubleType()), ("k", T.IntegerType()), ("edge", T.DoubleType()))]
    schema = T.StructType([*fields, *(docs.schema[c] for c in carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        floors: dict[tuple[int | None, int], np.ndarray] = {}
        for table in _gathered(batches, CHUNK_ROWS, CHUNK_BYTES):
            cells = pc.unique(table.column("cell")).to_pylist() if by_cell else [None]
            if bits is not None:
                yield from _by_bits({c: _Chunk(table.filter(pc.equal(table.column("cell"), c))) for c in cells}, floors, out)
                continue
            # Cells come in order, so those of earlier chunks are done with.
            floors = {at: floor for at, floor in floors.items() if at[0] in cells}
            for cell in cells:
                own = table if cell is None else table.filter(pc.equal(table.column("cell"), cell))
                system, files = _files(folder if cell is None else f"{folder}/cell={cell}")
                chunk = _Chunk(own) if files else None
                for i, asked in enumerate(_read(system, files)):
                    # What earlier chunks of the task found rules out more.
                    asked.floor = np.maximum(asked.floor, floors.get((cell, i), asked.floor))
                    yield from _hits(chunk, asked, out).to_batches()
                    floors[cell, i] = asked.floor
        pa.default_memory_pool().release_unused()

    def _by_bits(chunks: dict[int, _Chunk], floors: dict, out: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Each block of questions is read once for the cells of all ``chunks``."""
        for i, asked in enumerate(_read(*_files(folder))):
            # The blocks are the same for all cells, so each cell rules out more of the next.
            asked.floor = np.maximum(asked.floor, floors.get((None, i), asked.floor))
            for cell, chunk in chunks.items():
                rows = asked.opening(bits[cell])
                if len(rows):
                    some = asked.only(rows)
                    yield from _hits(chunk, some, out).to_batches()
                    asked.floor[rows] = some.floor
            floors[None, i] = asked.floor

    return docs.mapInArrow(run, schema)


def ranked(hits: DataFrame, most: int) -> DataFrame:
    """The best k hits per question among all, and the best one at its end of the
    value, with their ``rank``."""
    best_first = Window.partitionBy("question_id", F.col("edge").isNotNull()).orderBy(
        F.col("edge"), F.col("score").desc(), "doc_id"
    )
    numbered = hits.withColumn("rank", F.row_number().over(best_first))
    # A constant lets each task keep its best rows before the shuffle.
    return numbered.where(F.col("rank") <= most).where(F.col("rank") <= F.col("k"))


def searched(docs: DataFrame, carry: list[str], value: str | None, group: str | None) -> DataFrame:
    more = [F.col(value).cast("double").alias(VALUE)] if value else []
    more += [F.col(group).cast("string").alias(GROUP)] if group else []
    return docs.select("doc_id", "vec", *more, *carry).where(F.col("vec").isNotNull())


def knn_join(
    questions: DataFrame,
    docs: DataFrame,
    k: int = DEFAULT_K,
    carry: tuple[str, ...] = (),
    group: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(question_id, doc_id, score, rank) of the best documents per question, and
    the columns of ``docs`` to ``carry``.

    ``questions`` has question_id and vec; ``docs`` has doc_id and vec; ids are
    unique, all vectors of one length, rows without a vector are left out. Where
    there are fewer than k documents all are returned. A question may have its own
    ``k``, and ``groups``, the values of the documents' column ``group`` it may
    retrieve (null: all): the mask is applied before the cut at k, so every reader
    gets k hits where there are so many.
    """
    if "groups" in questions.columns and group is None:
        raise ValueError("questions have groups, so name the documents' column")
    folder, kind, most = write_questions(questions.drop("end", "floor", "cell"), k, block_rows)
    found = scan(searched(docs, list(carry), None, group), folder, kind, list(carry))
    return ranked(found, most).select("question_id", "doc_id", "score", "rank", *carry)


def knn_and_extremes(
    questions: DataFrame, docs: DataFrame, value: str, carry: tuple[str, ...] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Like ``knn_join``, in one scan with searches at the ends of a value.

    A question whose ``extreme`` is "lowest" or "highest" also gets the best hit
    among the documents of the lowest or highest ``value`` of all (nulls aside),
    marked by ``extreme`` in the result.
    """
    end = F.when(F.col("extreme") == LOWEST, -1).when(F.col("extreme") == HIGHEST, 1)
    plain = questions.drop("extreme", "end", "floor", "cell")
    # A second row asks about the end of the value.
    both = questions.select(*plain.columns, F.explode(F.when(end.isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), end))).alias("end"))
    both = both.withColumn("k", F.when(F.col("end") == 0, F.col("k")).otherwise(1))
    folder, kind, most = write_questions(both, DEFAULT_K, block_rows)
    columns = [c for c in carry]
    found = scan(searched(docs, columns, value, None), folder, kind, columns)
    return ranked(found, most).select(
        "question_id", "doc_id", "score", "rank", F.col("edge").isNotNull().alias("extreme"), *carry
    )
