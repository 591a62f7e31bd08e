"""Alignment of two tokenizers over a corpus, with an identity map as fast path.

Both cut the same bytes, so cuts they share part a text into groups, and every
stretch between two neighbouring cuts of either is one link between a token of A
and one of B. A group of one token each that the identity map names is counted in
a vector as long as A's vocabulary; only links of other groups become id pairs
that are shuffled, and of those each block of texts sends each pair once.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from curate.llm.flat import ranges, slices
from curate.llm.pretoken import byte_letters
from curate.session import work_path

BLOCK_BYTES = 2 << 20
SPACE_MARK = "▁"
# How byte-level files split texts into words. Fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Rows of the table that the first pass writes: texts, a block's pairs, a task's vector.
TEXT, PAIR, SAME = 0, 1, 2
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
LINKS = (
    "kind int, block long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, pairs array<int>, place int, a int, b int, n long"
)


class ByteLevel:
    """A byte-level BPE file of the tokenizers library, on a space and the text.

    Where the file's ids rise with its merges, which makes them ranks, the same ids
    come from tiktoken in a third of the time; else from the library itself.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text.
        self.library.encode_special_tokens = True
        of_letter = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        special = self.library.get_added_tokens_decoder()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = token.encode() if i in special else b"".join(of_letter[c] for c in token)
        self.ranks = None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        merged = [vocabulary[m.replace(" ", "")] for m in merges]
        split = spec["pre_tokenizer"]
        plain = split == {**split, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True} and not spec["normalizer"]
        if plain and all(x < y for x, y in pairwise([255, *merged])) and len(merged) + 256 == len(vocabulary) - len(special):
            ranks = {t: i for i, t in enumerate(self.tokens) if i not in special}
            self.ranks = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranks:
            return [self.ranks.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece file, which puts a space before the text by itself."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self._bytes(i) for i in range(self.library.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class TokenBytes:
    """The bytes of all tokens of a vocabulary in one flat array."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def spells(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which texts' tokens, joined, are the bytes of the text."""
        sums = np.concatenate(([0], np.cumsum(self.size[ids])))[np.concatenate(([0], np.cumsum(counts)))]
        same = np.diff(sums) == sizes
        kept = ids[np.repeat(same, counts)]
        there = data[np.repeat(same, sizes)]
        differs = np.flatnonzero(self.flat[ranges(self.first[kept], self.size[kept])] != there)
        ends = np.cumsum(sizes[same])
        out = same.copy()
        out[np.flatnonzero(same)[np.searchsorted(ends, differs, "right")]] = False
        return out


@dataclass
class Alignment:
    """What a list of texts gives: figures per text, links in order with the text of each."""

    figures: dict[str, np.ndarray]
    groups_sha256: list[str]
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray
    one_to_one: np.ndarray


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_bytes, self.b_bytes = TokenBytes(self.a.tokens), TokenBytes(self.b.tokens)
        self.same = identity_map(self.a.tokens, self.b)
        # Ids in decimal with the mark that follows within a group, and at the end of its side.
        marks = ((self.a.tokens, ",|"), (self.b.tokens, ",;"))
        self.written = [f"{i}{mark}" for tokens, ends in marks for i in range(len(tokens)) for mark in ends]

    def __call__(self, texts: list[str]) -> Alignment:
        filled = np.array([bool(t) for t in texts], bool)
        live = [t for t in texts if t]
        raw = [b" " + t.encode() for t in live]
        data, sizes = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)
        (a, n_a), (b, n_b) = _flat(self.a.encode(live)), _flat(self.b.encode(live))
        good = self.a_bytes.spells(a, n_a, data, sizes) & self.b_bytes.spells(b, n_b, data, sizes)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        row = np.flatnonzero(filled)[good]
        text_end = np.cumsum(sizes[good])

        a_end, b_end = np.cumsum(self.a_bytes.size[a]), np.cumsum(self.b_bytes.size[b])
        # Marks at the byte places where tokens and texts end, and how many are before each.
        total = text_end[-1] if len(text_end) else 0
        (in_a, a_before), (in_b, b_before), (_, text_before) = (_marks(ends, total) for ends in (a_end, b_end, text_end))
        shared, cuts = np.flatnonzero(in_a & in_b), np.flatnonzero(in_a | in_b)
        _, shared_before = _marks(shared, total)
        a_group, b_group = shared_before[a_end], shared_before[b_end]
        a_size, b_size = np.bincount(a_group, minlength=len(shared)), np.bincount(b_group, minlength=len(shared))
        a_at, b_at = a_before[cuts], b_before[cuts]

        figures = {name: np.zeros(len(texts), np.int64) for name in FIGURES}
        for name, ends in zip(FIGURES, (a_end, b_end, shared, cuts)):
            figures[name][row] = np.bincount(text_before[ends], minlength=len(row))

        # A group is written as its A ids, then its B ids.
        order = np.empty(len(a) + len(b), np.int64)
        a_last, b_last = a_end == shared[a_group], b_end == shared[b_group]
        order[np.arange(len(a)) + (np.cumsum(b_size) - b_size)[a_group]] = 2 * a + a_last
        order[np.arange(len(b)) + np.cumsum(a_size)[b_group]] = 2 * (len(self.a.tokens) + b) + b_last
        digests = [""] * len(texts)
        stops = np.cumsum(figures["n_a"][row] + figures["n_b"][row])
        for i, lo, hi in zip(row, [0, *stops], stops):
            line = "".join(map(self.written.__getitem__, order[lo:hi].tolist()))
            digests[i] = hashlib.sha256(line[:-1].encode()).hexdigest()

        a_link, b_link = a[a_at], b[b_at]
        alone = ((a_size == 1) & (b_size == 1))[a_group[a_at]]
        text = row[text_before[cuts]]
        return Alignment(figures, digests, text, a_link, b_link, alone & (self.same[a_link] == b_link))


def _marks(ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places 0 to ``total`` are among the ``ends``, and how many of these
    lie before each place."""
    inside = np.zeros(total + 1, bool)
    inside[ends] = True
    return inside, np.cumsum(inside, dtype=np.int32) - inside


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, counts.sum()), counts


def identity_map(a_tokens: list[bytes], b: Pieces) -> np.ndarray:
    """For every A id the B id with the same bytes, -1 without one. Of several the
    first that is no byte piece."""
    by_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(b.tokens)), key=lambda i: (b.library.is_byte(i), i)):
        by_bytes.setdefault(b.tokens[i], i)
    return np.array([by_bytes.get(t, -1) for t in a_tokens], np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first pass: a row per text (kind 0) with its figures, the A ids of its
    one-to-one links and the places of its other links' pairs in its block; a row
    per block and pair (kind 1); a row per task and A id with one-to-one links (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(a_path, b_path)
        vector = np.zeros(len(aligner.same), np.int64)
        block = TaskContext.get().partitionId() << 32

        def rows(kind: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
            columns |= {"kind": pa.array(np.full(size, kind, np.int32)), "block": pa.array(np.full(size, block))}
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

        schema = None
        for batch in batches:
            schema = _schema(batch.schema.field("id").type)
            for part in slices(batch, "text", BLOCK_BYTES):
                found = aligner(part.column("text").to_pylist())
                size, regular = part.num_rows, found.one_to_one
                vector += np.bincount(found.a[regular], minlength=len(vector))
                codes, place, n = np.unique(
                    found.a[~regular] * len(aligner.b.tokens) + found.b[~regular], return_inverse=True, return_counts=True
                )
                yield rows(
                    TEXT, size, id=part.column("id"), **{c: pa.array(v) for c, v in found.figures.items()},
                    groups_sha256=pa.array(found.groups_sha256),
                    same=_lists(found.a[regular], np.bincount(found.text[regular], minlength=size)),
                    pairs=_lists(place, np.bincount(found.text[~regular], minlength=size)),
                )
                a, b = (x.astype(np.int32) for x in np.divmod(codes, len(aligner.b.tokens)))
                yield rows(PAIR, len(codes), place=pa.array(np.arange(len(codes), dtype=np.int32)), a=pa.array(a), b=pa.array(b), n=pa.array(n))
                block += 1
        used = np.flatnonzero(vector)
        if len(used):
            yield rows(SAME, len(used), a=pa.array(used.astype(np.int32)), n=pa.array(vector[used]))

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, LINKS.format(kind=source.schema["id"].dataType.simpleString()))


def _schema(id_type: pa.DataType) -> pa.Schema:
    of = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    names = (entry.split(" ") for entry in LINKS.format(kind="id").split(", "))
    return pa.schema([(name, id_type if kind == "id" else of[kind]) for name, kind in names])


def pair_counts(found: DataFrame, same: DataFrame) -> DataFrame:
    """``(a, b, n, best)``: corpus-wide links of every id pair, and whether no other
    pair of its B id has more. ``same`` is the identity map."""
    one_to_one = found.where(F.col("kind") == SAME).groupBy("a").agg(F.sum("n").alias("n")).join(F.broadcast(same), "a")
    others = found.where(F.col("kind") == PAIR).select("a", "b", "n")
    totals = others.unionByName(one_to_one.select("a", "b", "n")).groupBy("a", "b").agg(F.sum("n").alias("n"))
    # One row per id of B's vocabulary.
    top = totals.groupBy("b").agg(F.max("n").alias("top"))
    return totals.join(F.broadcast(top), "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row
    of ``docs``; see ``pair_counts`` for the counts that the last but one adds up.

    A null or empty text, and one that either tokenizer does not spell byte for
    byte (it normalises, or the text holds the piece file's own space mark), has no
    tokens: zeros and an empty digest. Repeated rows count as often as they stand
    there, null ids stay, other columns are left out, an empty table gives no rows.
    A text is encoded whole, so a task holds some hundred bytes per token of its
    longest text.

    Vocabulary-long tables go through the driver and to every task: the identity
    map's counts and the highest count of each B id. Pairs return to the blocks of
    texts that hold them, about 2 MB each, so no group grows with the corpus and a
    frequent pair arrives once per block.
    """
    spark = docs.sparkSession
    links_path, counts_path = work_path(spark, "links"), work_path(spark, "pair-counts")
    first = links(docs, a_path, b_path, id_col, text_col)
    first.write.parquet(links_path)

    def found() -> DataFrame:
        return spark.read.schema(first.schema).parquet(links_path)

    a_tokens, pieces = ByteLevel(a_path).tokens, Pieces(b_path)
    mapped = identity_map(a_tokens, pieces)
    held = np.flatnonzero(mapped >= 0)
    same = spark.createDataFrame(pa.table({"a": held.astype(np.int32), "b": mapped[held].astype(np.int32)}))
    counted = pair_counts(found(), same)
    counted.write.parquet(counts_path)
    counted = spark.read.schema(counted.schema).parquet(counts_path)

    one_to_one = counted.join(F.broadcast(same), ["a", "b"]).toArrow()
    same_n, same_best = np.zeros(len(mapped), np.int64), np.zeros(len(mapped), bool)
    at = one_to_one.column("a").to_numpy()
    same_n[at], same_best[at] = one_to_one.column("n").to_numpy(), one_to_one.column("best").to_numpy()

    texts = found().where(F.col("kind") == TEXT).select("block", "id", *FIGURES, "groups_sha256", "same", "pairs")
    wanted = found().where(F.col("kind") == PAIR).select("block", "place", "a", "b")
    answers = wanted.join(counted, ["a", "b"]).select("block", "place", "n", "best")

    def add(texts: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("place").to_numpy())
        n, best = answers.column("n").to_numpy()[order], answers.column("best").to_numpy()[order]
        sums = np.zeros((2, texts.num_rows), np.int64)
        for name, counts, bests in (("same", same_n, same_best), ("pairs", n, best)):
            column = texts.column(name).combine_chunks()
            values, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
            for k, what in enumerate((counts, bests.astype(np.int64))):
                sums[k] += np.diff(np.concatenate(([0], np.cumsum(what[values])))[np.concatenate(([0], ends))])
        out = texts.drop_columns(["block", "same", "pairs"])
        return out.append_column("n_best", pa.array(sums[1])).append_column("count_sum", pa.array(sums[0]))

    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add, schema)
    return done.select(F.col("id").alias(id_col), *FIGURES, "n_best", "count_sum", "groups_sha256")
