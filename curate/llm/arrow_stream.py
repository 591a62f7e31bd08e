"""Token ids in Arrow stream files of fixed-size lists.

A shard is one stream file. Each row of it is a sequence of ``seq_len`` ids and a
mask of as many flags (false on the padding after the shard's last document);
every record batch but the last has ``batch_rows`` rows. Batches of one schema
and row count take the same number of bytes, so sequence i is found by
arithmetic and mapped without a copy. A second, smaller stream file beside it
says where each document starts.

Documents are laid end to end in ascending id order, within shards and across
them. A shard is written by one task and named by a fresh id; only names that
reach the manifest count, so a task that runs twice does no harm.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from curate.llm.flat import slices
from curate.llm.pretoken import TextEncoder, Vocabulary

MANIFEST = "shard int, path string, docs_path string, n_docs long, n_tokens long, n_sequences long"


@dataclass(frozen=True)
class Layout:
    seq_len: int = 2048
    batch_rows: int = 256
    end_id: int = 1
    pad_id: int = 0

    def schema(self, id_type: pa.DataType) -> pa.Schema:
        fields = {"input_ids": pa.list_(id_type, self.seq_len), "mask": pa.list_(pa.bool_(), self.seq_len)}
        return pa.schema(fields, {"batch_rows": str(self.batch_rows)})


DOCS = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})


def library_words(vocabulary: Vocabulary):
    """Ids of distinct words by the tokenizers library's own model."""
    from curate.llm.pretoken import byte_letters

    model, letters = vocabulary.library.model, byte_letters()
    table = {b: c for b, c in enumerate(letters)}

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [
            [t.id for t in model.tokenize(w.encode("utf-8", "surrogatepass").decode("latin-1").translate(table))]
            for w in words
        ]
        counts = np.array([len(x) for x in ids], np.int64)
        return np.array([i for x in ids for i in x], np.int32), counts

    return encode


class _ShardWriter:
    """Packs ids into sequences and writes a batch whenever one is full."""

    def __init__(self, sink, layout: Layout, id_type: pa.DataType):
        self.layout, self.schema, self.type = layout, layout.schema(id_type), id_type
        self.file = pa.ipc.new_stream(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.rows = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.type.to_pandas_dtype()))
        self.held += len(ids)
        self.total += len(ids)
        full = self.layout.seq_len * self.layout.batch_rows
        if self.held >= full:
            flat = np.concatenate(self.waiting)
            whole = self.held - self.held % full
            for lo in range(0, whole, full):
                self._write(flat[lo : lo + full], full)
            self.waiting, self.held = [flat[whole:].copy()], self.held - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        n = self.layout.seq_len
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), n) for x in (ids, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.rows += len(ids) // n

    def close(self) -> None:
        if self.held:
            real = self.held
            fill = np.full(-real % self.layout.seq_len, self.layout.pad_id, self.type.to_pandas_dtype())
            self._write(np.concatenate([*self.waiting, fill]), real)
        self.file.close()


def write_shards(
    docs: DataFrame, out: str, vocabulary_path: str, layout: Layout = Layout(),
    id_col: str = "doc_id", text_col: str = "text", shards: int | None = None,
) -> DataFrame:
    """Encode every whole text, end it with ``layout.end_id`` and write shards below
    ``out``, a folder all executors reach. Returns the manifest, stored beside them.

    Null text counts as empty: its document is the end id alone. Null ids come
    first; rows of one id are ordered by text, repeated rows all stay. Ids that
    do not exceed 65,535 are stored in two bytes, others in four. An empty table
    gives an empty manifest. Without ``shards`` the session's partition sizes apply.
    """
    files = f"{out}/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder = writer = None
        places: list[pa.RecordBatch] = []
        for batch in batches:
            for part in slices(batch, "text"):
                if writer is None:
                    vocabulary = Vocabulary.read(vocabulary_path)
                    encoder = TextEncoder(vocabulary, library_words(vocabulary))
                    top = max([layout.end_id, layout.pad_id, *vocabulary.ids.values(), *vocabulary.special.values()])
                    system, folder = pyarrow.fs.FileSystem.from_uri(files)
                    system.create_dir(folder, recursive=True)
                    name = uuid.uuid4().hex
                    sink = system.open_output_stream(f"{folder}/{name}.arrows")
                    writer = _ShardWriter(sink, layout, pa.uint16() if top < 2**16 else pa.uint32())
                ids, counts = encoder(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                starts = writer.total + np.arange(len(counts)) + ends - counts
                writer.add(np.insert(ids, ends, layout.end_id))
                columns = [part.column("id"), pa.array(starts), pa.array(counts + 1)]
                places.append(pa.RecordBatch.from_arrays(columns, schema=DOCS))
        if writer is None:
            return
        writer.close()
        sink.close()
        with system.open_output_stream(f"{folder}/{name}.docs") as sink, pa.ipc.new_stream(sink, DOCS) as index:
            for rows in places:
                index.write_batch(rows)
        row = {
            "shard": TaskContext.get().partitionId(), "path": f"{files}/{name}.arrows", "docs_path": f"{files}/{name}.docs",
            "n_docs": sum(p.num_rows for p in places), "n_tokens": writer.total, "n_sequences": writer.rows,
        }
        schema = {"shard": pa.int32(), "path": pa.string(), "docs_path": pa.string()}
        yield pa.RecordBatch.from_pylist([row], pa.schema({k: schema.get(k, pa.int64()) for k in row}))

    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The text's hash takes part in the ranges, so one id of many rows spans several.
    keys = [F.col("id"), F.xxhash64("text")]
    ordered = source.repartitionByRange(*([shards] if shards else []), *keys).sortWithinPartitions("id", F.xxhash64("text"), "text")
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{out}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per stored document: ``doc_id, start, n_tokens, ids_crc32``, all taken
    from the files. ``start`` counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                flat = read_ids(row["path"])
                system, path = pyarrow.fs.FileSystem.from_uri(row["docs_path"])
                with system.open_input_stream(path) as source, pa.ipc.open_stream(source) as index:
                    for docs in index:
                        starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                        sums = [zlib.crc32(flat[s : s + n].astype("<u4").tobytes()) for s, n in zip(starts, counts)]
                        yield pa.RecordBatch.from_arrays(
                            [docs.column("doc_id"), pa.array(starts + row["base"]), docs.column("n_tokens"), pa.array(sums, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    # One narrow row per shard, each standing for megabytes of ids.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = based.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _open(path: str) -> pa.NativeFile:
    system, name = pyarrow.fs.FileSystem.from_uri(path)
    local = isinstance(system, pyarrow.fs.LocalFileSystem)
    return pa.memory_map(name) if local else system.open_input_file(name)


def read_ids(path: str) -> np.ndarray:
    """All ids of a shard under its mask, in order."""
    with _open(path) as source:
        parts = []
        for batch in pa.ipc.open_stream(source):
            ids, mask = (batch.column(c).flatten() for c in ("input_ids", "mask"))
            real = mask.true_count
            parts.append(ids.to_numpy()[:real])
        return np.concatenate(parts) if parts else np.empty(0, np.uint16)


def read_sequence(path: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ``i`` of a shard and its mask, by one seek; the ids of a local file
    are a view of the mapped file."""
    source = _open(path)
    schema = pa.ipc.read_schema(source)
    first = source.tell()
    pa.ipc.read_message(source)
    size = source.tell() - first
    step = int(schema.metadata[b"batch_rows"])
    source.seek(first + i // step * size)
    batch = pa.ipc.read_record_batch(pa.ipc.read_message(source), schema)
    ids, mask = (batch.column(c).slice(i % step, 1).flatten() for c in ("input_ids", "mask"))
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)
