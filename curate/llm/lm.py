"""Language-model scores from a weighted backoff automaton.

The model is an n-gram model of any order, smoothed towards add-one unigrams: with
counts c over the training texts, N tokens, V distinct ones and a constant k,

    p(w)   = (c(w) + 1) / (N + V + 1)
    p(w|h) = (c(hw) + k p(w|h')) / (c(h) + k),

where h' is h without its oldest word; a context that was never seen gives p(w|h').
That sums to one over all words and one unknown in every context. As an automaton:
every n-gram seen that is shorter than the order is a state, every seen continuation
an arc with weight log p(w|h), and a state's failure arc leads to the state of h'
with weight log k / (c(h) + k), down to the root, where the arc of w weighs log p(w).
One pass from left to right carries the state, the longest seen context, and adds up
the weights of the arcs and failure arcs it takes.

The automaton is as large as the corpus, so no task holds it. Texts are dealt to
blocks of bounded size. A block sends the hashes of its distinct n-grams of each
length, with their training counts, to buckets of the hash range; a bucket adds up what
all blocks sent and returns the totals in the order they came. A key reaches a
bucket once per block, however often it occurs, so no key makes a bucket hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curate.llm.flat import mix, slices, word_hashes
from curate.session import work_path

# Text of a block. Its tokens and n-grams take a task about 25 times as much, beside
# what the executor keeps for its shuffles.
BLOCK_BYTES = 4 << 20
# Blocks' keys that one bucket takes, in bytes of text.
BUCKET_BYTES = 16 << 20
K = 20.0
# Longer n-grams are a parameter; each length adds its keys to the exchange.
ORDER = 2
# Kinds of keys are lengths of n-grams.
WORD = 1
_END = np.uint64(0xD6E8FEB86659FD93)
_PREVIOUS = np.uint64(0xA0761D6478BD642F)


def _planes(values: np.ndarray) -> bytes:
    """Values as planes of bytes, so that the high, equal bytes compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _values(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


class _Block:
    """The tokens of a block's texts: hashes, an end after each text."""

    def __init__(self) -> None:
        self.tokens: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.train: list[np.ndarray] = []
        self.ids: list[pa.Array] = []

    def add(self, rows: pa.RecordBatch) -> None:
        for part in slices(rows, "text"):
            hashes, counts = word_hashes(part.column("text"), solid=True)
            self.tokens.append(np.insert(hashes, np.cumsum(counts), _END))
            self.sizes.append(counts + 1)
            self.train.append(part.column("train").to_numpy(zero_copy_only=False).astype(bool))
            self.ids.append(part.column("id"))

    def close(self, order: int) -> None:
        flat = np.concatenate(self.tokens)
        self.tokens = []
        self.per_text = np.concatenate(self.sizes)
        self.trained = np.repeat(np.concatenate(self.train), self.per_text)
        self.text = np.repeat(np.arange(len(self.per_text), dtype=np.int32), self.per_text)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.per_text) - self.per_text, self.per_text)
        # Of each length: where n-grams of one text end, the distinct ones, which one each is.
        self.ends: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.which: list[np.ndarray] = []
        gram, last = flat, mix(flat)
        for n in range(1, order + 1):
            if n > 1:
                gram = np.concatenate((gram[:1], mix(gram[:-1] * _PREVIOUS + last[1:])))
            ends = np.flatnonzero(place >= n - 1).astype(np.int32)
            keys, which = np.unique(gram[ends], return_inverse=True)
            self.ends.append(ends)
            self.keys.append(keys)
            self.which.append(which.astype(np.int32))

    def counted(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for n, (ends, keys, which) in enumerate(zip(self.ends, self.keys, self.which), 1):
            yield n, keys, np.bincount(which, self.trained[ends], len(keys)).astype(np.uint32)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut sorted batches where the block changes."""
    for batch in batches:
        block = batch.column("block").to_numpy()
        cuts = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(block)]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


COUNTS = "kind int, bucket int, block int, keys binary, counts binary"
TOTALS = "kind int, bucket int, block int, totals binary, tokens long, distinct_tokens long"


def _gather(buckets: int, order: int):
    """Blocks to one row per kind and bucket: sorted keys and their training counts."""

    def rows(number: int, block: _Block) -> Iterator[pa.RecordBatch]:
        block.close(order)
        for kind, keys, counts in block.counted():
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            edges = np.flatnonzero(np.diff(bucket)) + 1
            parts = [
                (int(bucket[lo]), _planes(np.diff(keys[lo:hi], prepend=np.uint64(0))), _planes(counts[lo:hi]))
                for lo, hi in zip([0, *edges], [*edges, len(keys)])
                if hi > lo
            ]
            columns = [
                pa.array([kind] * len(parts), pa.int32()), pa.array([b for b, _, _ in parts], pa.int32()),
                pa.array([number] * len(parts), pa.int32()), pa.array([k for _, k, _ in parts], pa.binary()),
                pa.array([c for _, _, c in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "block", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, None
        for part in _by_block(batches):
            if part.column("block")[0].as_py() != number:
                if block is not None:
                    yield from rows(number, block)
                number, block = part.column("block")[0].as_py(), _Block()
            block.add(part)
        if block is not None:
            yield from rows(number, block)
        del block
        pa.default_memory_pool().release_unused()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of a bucket's keys, given back to each block in its own order."""

    def rows(kind: int, bucket: int, blocks: list[int], keys: list[np.ndarray], counts: list[np.ndarray]):
        flat = np.concatenate(keys)
        distinct, at = np.unique(flat, return_inverse=True)
        totals = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.uint64)
        edges = np.cumsum([len(k) for k in keys])[:-1]
        given = [_planes(t) for t in np.split(totals[at], edges)]
        # The bucket's own figures ride on the first of its rows.
        rest = [0] * (len(blocks) - 1)
        n = len(blocks)
        columns = [
            pa.array([kind] * n, pa.int32()), pa.array([bucket] * n, pa.int32()), pa.array(blocks, pa.int32()),
            pa.array(given, pa.binary()), pa.array([int(totals.sum()), *rest], pa.int64()),
            pa.array([int((totals > 0).sum()), *rest], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "block", "totals", "tokens", "distinct_tokens"])

    key, blocks, keys, counts = None, [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            if key != (row["kind"], row["bucket"]):
                if blocks:
                    yield rows(*key, blocks, keys, counts)
                key, blocks, keys, counts = (row["kind"], row["bucket"]), [], [], []
            blocks.append(row["block"])
            keys.append(np.cumsum(_values(row["keys"], np.uint64), dtype=np.uint64))
            counts.append(_values(row["counts"], np.uint32))
    if blocks:
        yield rows(*key, blocks, keys, counts)
    del blocks, keys, counts
    pa.default_memory_pool().release_unused()


class Automaton:
    """The part of the automaton that a block's texts can reach: training counts of
    its n-grams, by length."""

    def __init__(self, counts: list[np.ndarray], tokens: int, distinct: int, k: float):
        self.counts, self.k = [c.astype(float) for c in counts], k
        self.root = (self.counts[0] + 1) / (tokens + distinct + 1)

    def walk(self, block: _Block) -> tuple[np.ndarray, np.ndarray]:
        """Log weights of each step at the root, and of the way from the longest seen
        context: along its arc where there is one, else by failure arcs to the first
        state that has one."""
        p = self.root[block.which[0]]
        base = weight = np.log10(p)
        context = self.counts[0][block.which[0]]
        weight = weight.copy()
        for ends, which, counts in zip(block.ends[1:], block.which[1:], self.counts[1:]):
            seen, state, lower = counts[which], context[ends - 1], p[ends]
            known = state > 0
            full = np.where(known, (seen + self.k * lower) / (state + self.k), lower)
            fail = np.where(known, np.log10(self.k / (state + self.k)), 0.0)
            weight[ends] = np.where(seen > 0, np.log10(full), fail + weight[ends])
            p[ends] = full
            context = np.zeros(len(p))
            context[ends] = seen
        return base, weight


def _score(tokens: int, distinct: int, k: float, order: int):
    def rows(block: _Block, totals: dict[int, list[tuple[int, bytes]]]) -> Iterator[pa.RecordBatch]:
        if not block.ids:
            return
        block.close(order)
        counts = [
            np.concatenate([np.empty(0, np.uint64), *(_values(raw, np.uint64) for _, raw in sorted(totals[kind]))])
            for kind in range(1, order + 1)
        ]
        base, weight = Automaton(counts, tokens, distinct, k).walk(block)
        n = len(block.per_text)
        known = np.bincount(block.text, counts[0][block.which[0]] > 0, n).astype(np.int64)
        base, score = np.bincount(block.text, base, n), np.bincount(block.text, weight, n)
        columns = [
            pa.concat_arrays(block.ids), pa.array(block.per_text), pa.array(known), pa.array(np.full(n, tokens)), pa.array(base), pa.array(score),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, totals = None, None, None
        for part in _by_block(batches):
            if part.column("block")[0].as_py() != number:
                if block is not None:
                    yield from rows(block, totals)
                number, block, totals = part.column("block")[0].as_py(), _Block(), {n: [] for n in range(1, order + 1)}
            is_text = part.column("kind").to_numpy() < 0
            for row in part.filter(pa.array(~is_text)).to_pylist():
                totals[row["kind"]].append((row["bucket"], row["totals"]))
            if is_text.any():
                block.add(part.filter(pa.array(is_text)))
        if block is not None:
            yield from rows(block, totals)
        del block, totals
        pa.default_memory_pool().release_unused()

    return run


def score(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", k: float = K, order: int = ORDER
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    ``train`` says which rows the model learns from (null: not). Tokens are runs of
    anything but white space, A-Z lower-cased, and one end per text, so null and
    empty texts have one token. ``base_score`` sums log10 p(w), ``score`` the weights
    of the automaton, whose n-grams have up to ``order`` words. N-grams are told apart by
    64-bit hashes. Without any
    training row all words are unknown. Repeated rows count and are scored each;
    an empty table gives no rows; other columns are left out.
    """
    if order < 1:
        raise ValueError("an n-gram has a word at least")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    blocks, buckets = int(size // BLOCK_BYTES) + 1, int(size // BUCKET_BYTES) + 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = source.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))

    blocked = dealt.repartition(min(parts, blocks), "block").sortWithinPartitions("block")
    counts = blocked.mapInArrow(_gather(buckets, order), COUNTS)
    path = work_path(spark, "lm-totals")
    merged = counts.repartition(min(parts, order * buckets), "kind", "bucket").sortWithinPartitions("kind", "bucket", "block")
    merged.mapInArrow(_merge, TOTALS).write.parquet(path)
    totals = spark.read.schema(TOTALS).parquet(path)
    tokens, distinct = totals.where(F.col("kind") == WORD).agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct_tokens"), F.lit(0))
    ).first()

    both = dealt.withColumns({"kind": F.lit(-1), "bucket": F.lit(0), "totals": F.lit(b"")}).unionByName(
        totals.select("kind", "bucket", "block", "totals"), allowMissingColumns=True
    )
    ready = both.repartition(min(parts, blocks), "block").sortWithinPartitions("block")
    kind = source.schema["id"].dataType.simpleString()
    scored = ready.mapInArrow(
        _score(int(tokens), int(distinct), k, order),
        f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumnRenamed("id", id_col)
