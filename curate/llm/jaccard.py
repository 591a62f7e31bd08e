"""Similarity join of texts on the Jaccard similarity of their word shingles, by
chosen paths.

A text is a set of shingles, embedded as ``COORDS`` minimum hashes; two texts agree
on a coordinate with a chance equal to their similarity. A run splits all texts on
a sampled coordinate; buckets still too large are split again on coordinates that
the bucket's own hash samples, 1 / threshold of them on average, so a similar pair
keeps meeting in one bucket per level on average. Small buckets are compared pair
by pair on their signatures. Runs are repeated until the recall asked for.

What is found are candidates. Their components are compared exactly, shingle by
shingle, so similarity and the count of links are exact; a candidate lost in
every run is still found where its component holds together through others.
Texts of the same words are one node from the start.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curate.llm.flat import mix, slices, word_hashes
from curate.llm.graph import components, stored

WORDS = 5
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
THRESHOLD = 0.8
COORDS = 64
RECALL = 0.999
# Buckets up to this size are compared pair by pair; larger ones are split on.
BUCKET = 128
DEPTH = 4
# Estimates of the similarity from COORDS coordinates err by 0.05; four times that.
MARGIN = 0.2
# A group of the exact comparison has at most two blocks of about so many texts and shingles.
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 1 << 19
# Text whose words and shingles a task holds at once.
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(11)
_FACTORS = _rng.integers(1, 2**63, COORDS, dtype=np.uint64) | np.uint64(1)
_STEPS = _rng.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)


def runs_for(recall: float, depth: int = DEPTH, threshold: float = THRESHOLD) -> int:
    """Runs until a pair at the threshold has met in a bucket of every depth up to
    ``depth`` with probability ``recall``: a critical branching process."""
    survive = 1.0
    for _ in range(depth - 1):
        survive = 1 - math.exp(-survive)
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold * survive))


def shingles(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and their number per text, shingle hashes and theirs. A text of
    fewer than ``WORDS`` words has one shingle, all its words; without words none."""
    words, counts = word_hashes(part.column("text"))
    padded = np.concatenate((words, np.zeros(WORDS, np.uint64)))
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    left = ends[text] - np.arange(len(words))
    grams = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        grams += np.where(left > k, mix(padded[k : k + len(words)] * _STEPS[k]), np.uint64(0))
    keep = (left >= WORDS) | ((counts[text] < WORDS) & (left == counts[text]))
    return words, counts, mix(grams[keep]), np.bincount(text[keep], minlength=len(counts))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            words, counts, grams, sizes = shingles(part)
            ends = np.cumsum(counts)
            print_ = [hashlib.blake2b(words[e - n : e].tobytes(), digest_size=16).digest() if n else None for e, n in zip(ends, counts)]
            full = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[full]
            signature = np.zeros((len(sizes), COORDS), np.uint32)
            if len(full):
                for c, factor in enumerate(_FACTORS):
                    hashed = ((grams * factor) >> np.uint64(32)).astype(np.uint32)
                    signature[full, c] = np.minimum.reduceat(hashed, starts)
            columns = [
                part.column("id"), part.column("text_hash"), pa.array(print_, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array([row.tobytes() for row in signature], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "print", "n_shingles", "signature"])
    # Idle workers stay beside the joins that follow, so they give back what they took.
    pa.default_memory_pool().release_unused()


def _split(choose: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]):
    """Rows of (print, signature, node) to rows of their next nodes. ``choose`` maps
    nodes to pairs of a row and a coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy().astype(np.int64).view(np.uint64)
            signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDS)
            row, coord = choose(nodes)
            value = signature[row, coord].astype(np.uint64)
            after = mix(mix(nodes[row] + coord.astype(np.uint64) * _FACTORS[0] + np.uint64(1)) ^ (value * _FACTORS[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("print").take(pa.array(row)), pa.array(after.view(np.int64))], ["print", "node"]
            )

    return run


def _first(runs: int, threshold: float):
    """Each run splits everything on one coordinate; every fourth on a second one, so
    that there are 1 / threshold of them on average."""
    per_run = round(runs / threshold)
    rng = np.random.default_rng(5)
    coords = np.concatenate([rng.permutation(COORDS) for _ in range(-(-per_run // COORDS))])[:per_run]

    def choose(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(nodes)), per_run), np.tile(coords, len(nodes))

    return choose


def _next(threshold: float):
    limit = np.uint64(int(2**32 / (threshold * COORDS)))

    def choose(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        drawn = mix(nodes[:, None] ^ (_FACTORS[None, :] * np.uint64(3))) >> np.uint64(32)
        row, coord = np.nonzero(drawn < limit)
        return row, coord

    return choose


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of sorted rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            changed |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            part = batch.slice(lo, hi - lo)
            if held and any(held[0].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if np.array_equal(least, root):
            return root
        root = least


def _compare(floor: float):
    """Small buckets to edges that hold their similar members together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[bytes, bytes]] = []
        for group in _groups(batches, ["node"]):
            prints = group.column("print").to_pylist()
            signature = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, COORDS)
            agree = sum((signature[:, c][:, None] == signature[:, c][None, :]).astype(np.uint8) for c in range(COORDS))
            a, b = np.nonzero(np.triu(agree >= floor * COORDS, 1))
            root = _forest(len(prints), a, b)
            pairs += [(prints[i], prints[r]) for i, r in enumerate(root) if i != r]
            if len(pairs) > 50_000:
                yield _edges(pairs)
                pairs = []
        yield _edges(pairs)
        pa.default_memory_pool().release_unused()

    return run


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])


def _candidates(nodes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges ``a, b`` between texts that met in a bucket and look similar."""
    rows = nodes.select("print", "signature", F.lit(0).cast("long").alias("node")).mapInArrow(
        _split(_first(runs_for(recall, DEPTH, threshold), threshold)), "print binary, node long"
    )
    found = None
    for depth in range(1, DEPTH + 1):
        rows = rows.distinct() if depth > 1 else rows
        sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("print").alias("least")).where("size > 1")
        met = stored(rows.join(sizes, "node"), f"bucket-{depth}")
        small = met.where(F.col("size") <= BUCKET).join(nodes.select("print", "signature"), "print")
        edges = small.select("node", "print", "signature").repartition("node").sortWithinPartitions("node").mapInArrow(
            _compare(threshold - MARGIN), "a binary, b binary"
        )
        large = met.where(F.col("size") > BUCKET)
        if depth == DEPTH:
            # They agree on DEPTH coordinates; all are candidates of each other.
            edges = edges.union(large.where("print <> least").select("print", "least"))
        found = edges if found is None else found.union(edges)
        if depth == DEPTH or large.isEmpty():
            return stored(found.distinct(), "candidates")
        rows = large.select("print", "node").join(nodes.select("print", "signature"), "print").mapInArrow(
            _split(_next(threshold)), "print binary, node long"
        )


def _common(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many shingles each pair has in common; of ``left`` with itself if alone."""
    sets = left + (right or [])
    m = len(left)
    sizes = np.array([len(s) for s in sets])
    member = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    many = count[column]
    common = np.zeros((m, len(right) if right is not None else m), np.int32)
    # Shingles of few texts pair by pair, the others by matrix products.
    for c in range(2, 9):
        rows = member[many == c].reshape(-1, c)
        for i in range(c):
            for j in range(i + 1, c):
                a, b = rows[:, i], rows[:, j]
                if right is not None:
                    across = (a < m) & (b >= m)
                    np.add.at(common, (a[across], b[across] - m), 1)
                else:
                    np.add.at(common, (a, b), 1)
                    np.add.at(common, (b, a), 1)
    rest = many > 8
    column, member = np.unique(column[rest], return_inverse=True)[1], member[rest]
    for lo in range(0, column.max(initial=-1) + 1, 1024):
        here = (column >= lo) & (column < lo + 1024)
        table = np.zeros((len(sets), 1024), np.float32)
        table[member[here], column[here] - lo] = 1
        # At most 1,024 each, so the product of floats is exact.
        common += (table[:m] @ (table[m:] if right is not None else table).T).astype(np.int32)
    return common


def _linked(common: np.ndarray, across: np.ndarray, threshold: float) -> np.ndarray:
    """Whether ``common`` of the shingles of two sets, ``across`` together, make them
    similar: in whole numbers, so that a similarity of exactly the threshold counts."""
    share = Fraction(threshold).limit_denominator(1_000_000)
    return common.astype(np.int64) * (share.numerator + share.denominator) >= share.numerator * across


def _verify(threshold: float):
    """Blocks of a component to each member's links and the root they lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "i", "j"]):
            first, second = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            kept: dict[bytes, tuple[int, int, np.ndarray]] = {}
            for row in group.select(["print", "block", "copies", "shingles"]).to_pylist():
                kept[row["print"]] = (row["block"], row["copies"], np.frombuffer(row["shingles"], np.uint64))
            names = sorted(kept, key=lambda p: (kept[p][0], p))
            left = [p for p in names if kept[p][0] == first]
            right = [p for p in names if kept[p][0] == second] if second != first else None
            if not left or right == []:
                continue
            copies = np.array([kept[p][1] for p in names])
            common = _common([kept[p][2] for p in left], [kept[p][2] for p in right] if right else None)
            sizes = np.array([len(kept[p][2]) for p in names])
            across = sizes[: len(left), None] + (sizes[len(left) :] if right else sizes)[None, :]
            linked = _linked(common, across, threshold)
            if not right:
                np.fill_diagonal(linked, False)
            a, b = np.nonzero(linked)
            shift = len(left) if right else 0
            texts, docs = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            np.add.at(texts, a, 1)
            np.add.at(docs, a, copies[b + shift])
            if right:
                np.add.at(texts, b + shift, 1)
                np.add.at(docs, b + shift, copies[a])
            root = _forest(len(names), a, b + shift)
            has = np.flatnonzero(texts)
            columns = [
                pa.array([names[k] for k in has], pa.binary()), pa.array(texts[has]), pa.array(docs[has]),
                pa.array([names[root[k]] for k in has], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["print", "text_links", "doc_links", "to"])
        pa.default_memory_pool().release_unused()

    return run


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            _, _, grams, sizes = shingles(part)
            sets = [np.unique(g).tobytes() for g in np.split(grams, np.cumsum(sizes)[:-1])]
            kept = part.drop_columns(["text"])
            yield kept.append_column("shingles", pa.array(sets, pa.binary()))
    pa.default_memory_pool().release_unused()


def similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, recall: float = RECALL,
) -> DataFrame:
    """``doc_id, text_hash, stays, class_id, n_links, n_text_links, n_copies`` per row of ``docs``.

    Two documents are linked if the Jaccard similarity of their shingles of ``WORDS``
    words is at least ``threshold``; classes are the components of the links and
    ``class_id`` the least id in one. ``n_links`` counts linked documents, copies
    among them, ``n_text_links`` different linked texts, ``n_copies`` the rows with
    the same words (itself too). ``stays`` marks the one text of a class that has its
    id; repeated rows of it are all marked. Case and punctuation do not count.

    Texts without words (null, empty) are linked to nothing and have ``n_copies`` 1;
    their class is their own id. Repeated rows are copies. Null ids are taken as any
    other and are never a ``class_id`` unless a class has no other. An empty table
    gives no rows; other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    sketches = stored(
        source.mapInArrow(_sketch, "id long, text_hash long, print binary, n_shingles long, signature binary"), "sketches"
    )
    worded = sketches.where(F.col("print").isNotNull())
    nodes = stored(
        worded.groupBy("print").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "n_shingles", "signature")).alias("m"), F.count("*").alias("copies")
        ).select("print", "m.id", "m.text_hash", "m.n_shingles", "m.signature", "copies"),
        "nodes",
    )
    grouped = components(_candidates(nodes, threshold, recall)).withColumnRenamed("node", "print")
    inside = nodes.drop("signature").join(grouped, "print")
    size = inside.groupBy("root").agg(F.sum("n_shingles").alias("weight"), F.count("*").alias("texts"))
    blocks = F.greatest(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.ceil(F.col("texts") / BLOCK_TEXTS)).cast("int")
    members = stored(
        inside.join(size, "root")
        .withColumn("blocks", blocks)
        .select("print", "root", "copies", "blocks", F.col("id").alias("rid"), F.col("text_hash").alias("rhash")),
        "members",
    )
    # Members grow with the corpus, so both sides are shuffled at every size.
    read = source.join(members.hint("merge"), F.col("id").eqNullSafe(F.col("rid")) & (F.col("text_hash") == F.col("rhash")))
    sets = read.select("print", "root", "copies", "blocks", "text").mapInArrow(
        _shingle_sets, "print binary, root binary, copies long, blocks int, shingles binary"
    )
    block = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "print", "root", "copies", "block", "shingles", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    keys = ["root", "i", "j"]
    links = stored(
        dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            _verify(threshold), "print binary, text_links long, doc_links long, to binary"
        ),
        "links",
    )
    final = components(links.select(F.col("print").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "print")
    counted = links.groupBy("print").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    classed = nodes.select("print", "id", "text_hash", "copies").join(final, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = classed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("least"))
    told = classed.select("print", "root", "copies").join(least, "root").join(counted, "print", "left")
    stays = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return sketches.select("id", "text_hash", "print").join(told, "print", "left").select(
        F.col("id").alias(id_col), "text_hash", (F.col("print").isNull() | stays).alias("stays"),
        F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("doc_links", F.lit(0))).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class of similar texts, with all its columns as they are: the
    one with the least id. Texts without words (null, empty) all stay.

    Of rows repeated in full one stays; of rows that share id and text but differ
    elsewhere any one. A null id is the last of its class. Columns of any name are
    kept as they are; an empty table gives no rows.
    """
    mark = uuid.uuid4().hex[:8]
    place, text_hash, first = (f"{name}_{mark}" for name in ("place", "text_hash", "first"))
    keys = [place, text_hash]
    found = similar(docs.select("doc_id", "text")).where("stays")
    placed = F.xxhash64(F.col("doc_id").cast("long"), F.col(text_hash))
    stay = found.withColumnRenamed("text_hash", text_hash).withColumn(place, placed).select(*keys).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn(text_hash, F.xxhash64(text)).withColumn(place, placed).join(stay, keys)
    # Rows repeated in full would all match. Rows without words are told apart by number.
    alone = F.when(~text.rlike(WORD), F.monotonically_increasing_id())
    among = Window.partitionBy(*keys, f"alone_{mark}").orderBy(F.lit(0))
    numbered = rows.withColumn(f"alone_{mark}", alone).withColumn(first, F.row_number().over(among))
    return numbered.where(F.col(first) == 1).drop(*keys, f"alone_{mark}", first)
