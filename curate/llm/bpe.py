"""Byte-pair encoding and decoding by batched merge rounds.

The symbols of many words lie in one flat array. In a round every word merges
all places of its lowest-ranked pair; ranks come from a binary search over the
sorted keys of the merge table. A merge only makes pairs of a higher rank, so
rounds give what merging one pair at a time gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curate.llm.flat import slices
from curate.llm.pretoken import TextEncoder, Vocabulary, byte_letters, token_names

NO_RANK = np.iinfo(np.int64).max
# Text that a task encodes at once, and ids that it decodes at once.
SLICE_BYTES = 2 << 20
DECODED_AT_ONCE = 1 << 18


class MergeTable:
    def __init__(self, vocabulary: Vocabulary):
        ids, letters = vocabulary.ids, byte_letters()
        self.width = max(ids.values()) + 1
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + vocabulary.word_end] for c in letters], np.int64)
        keys = np.array([ids[a] * self.width + ids[b] for a, b in vocabulary.merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in vocabulary.merges], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words in a row, and how many each word has."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(b) for b in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            pair = np.flatnonzero(word[1:] == word[:-1])
            rank = np.full(len(symbols), NO_RANK)
            rank[pair] = self.rank(symbols[pair], symbols[pair + 1])
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(first, len(word)))
            lowest = np.minimum.reduceat(rank, first)
            open_ = np.repeat(lowest < NO_RANK, lengths)
            done.append((word[~open_], symbols[~open_]))
            hit = np.flatnonzero((rank == np.repeat(lowest, lengths)) & open_)
            # Of overlapping places (x x x) every second one, from the left.
            fresh = np.append(True, np.diff(hit) > 1)[: len(hit)]
            run_start = np.flatnonzero(fresh)
            step = np.arange(len(hit)) - np.repeat(run_start, np.diff(np.append(run_start, len(hit))))
            hit = hit[step % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = open_
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        word = np.concatenate([w for w, _ in done]) if done else np.empty(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.empty(0, np.int64)
        order = np.argsort(word, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(word, minlength=len(words)).astype(np.int64)


def _encoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.read(path)
        encoder = TextEncoder(vocabulary, MergeTable(vocabulary).encode_words)
        del vocabulary
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, counts = encoder(part.column("text").to_pylist())
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "ids"])
        # What the batches took is not kept for the worker's next task.
        pa.default_memory_pool().release_unused()

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source, source.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` of every whole text under the vocabulary at ``path``.

    Null and empty texts have no ids. Rows are independent: repeated rows give
    repeated results, other columns are left out.
    """

    source, kind = _texts(docs, id_col, text_col)
    return source.mapInArrow(_encoding(path), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows that have about ``DECODED_AT_ONCE`` ids each."""
    sizes = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes, dtype=np.int64) // DECODED_AT_ONCE
    cuts = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _decoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(path)
        for batch in batches:
            # A row may be long, so slices are cut by ids, not by rows.
            for part in _id_slices(batch):
                texts = [
                    " ".join([names[i] for i in ids or () if i in names]) for ids in part.column("ids").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("ids"), pa.array(texts, pa.string())], ["id", "ids", "decoded"]
                )
        pa.default_memory_pool().release_unused()

    return run


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, ids, decoded)``: the tokens of each list, one space between them.

    The vocabulary names no decoder, so tokens are joined as they are, special
    ones too; ids it lacks are passed over. Null lists decode to empty text.
    """

    source = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_decoding(path), f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode`` of ``encode``, with one worker to a task, which passes on the ids of
    a slice at a time: of two, both would stay beside the stages that follow."""
    encoding, decoding = _encoding(path), _decoding(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from decoding(encoding(batches))

    source, kind = _texts(docs, id_col, text_col)
    return source.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 digests of the ids, in decimal, and of the decoded text."""
    return decoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
