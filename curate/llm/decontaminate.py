"""Benchmark decontamination by spaced seeds.

A mask names the positions of a window that are hashed; the others may differ.
Masks of weight six over eight words are laid at every position of documents and
benchmark items. Equal hashes say at which offset an item may lie in a document;
there the two texts are compared word by word. An overlap counts when ``WINDOW``
aligned words in a row have at least ``SHARE`` of them equal.

The two masks find every such overlap: whichever two of thirteen words differ,
one of the masks fits between them (a test goes through all pairs).

Items of fewer words are compared whole. They have masks as long as themselves,
which leave out as many groups of words as words may differ; a place with an equal
seed is compared by the hashes of its words.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from curate.llm.words import normal_text, once, words_of

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
WINDOW = 13
SHARE = 0.8
# Seeds of at most so many items' words go to every task: 24 bytes each and mask.
MAX_SHARED_WORDS = 500_000


def may_differ(n: int) -> int:
    """How many of ``n`` aligned words may differ."""
    return n - math.ceil(n * SHARE)


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks for an item of ``n`` words: wherever as many differ as may, one is spared."""
    groups = may_differ(n) + 3
    return [tuple(k for k in range(n) if k % groups not in out) for out in combinations(range(groups), may_differ(n))]


def _seeds(df: DataFrame, keys: list[str]) -> DataFrame:
    """A row per position of ``words`` with a hash per mask, ``seed0``, ``seed1``...

    Words are hashed once per text; a row carries hashes, never the text.
    """
    hashed = df.select(*keys, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    n = F.greatest(F.size("h") - (SPAN - 1), F.lit(0))
    zipped = F.arrays_zip(*(F.slice("h", k + 1, n).alias(f"w{k}") for k in range(SPAN)))
    rows = hashed.select(*keys, F.posexplode(zipped).alias("pos", "w"))
    masks = [F.xxhash64(*(F.col("w")[f"w{o}"] for o in mask)).alias(f"seed{m}") for m, mask in enumerate(MASKS)]
    return rows.select(*keys, "pos", *masks)


def _offsets(doc_seeds: DataFrame, item_seeds: DataFrame, shared: bool) -> DataFrame:
    """Distinct (document, item, offset) with an equal seed."""
    keys = ["doc_id", "text_hash"]
    if shared:
        # One row per seed, so each lookup leaves a position one row.
        found = doc_seeds
        for m in range(len(MASKS)):
            places = item_seeds.groupBy(f"seed{m}").agg(F.collect_list(F.struct("item_id", F.col("pos").alias("at"))).alias(f"hit{m}"))
            found = found.join(F.broadcast(places), f"seed{m}", "left")
        hits = [F.coalesce(f"hit{m}", F.array().cast("array<struct<item_id:bigint,at:int>>")) for m in range(len(MASKS))]
        any_hit = F.coalesce(*(f"hit{m}" for m in range(len(MASKS)))).isNotNull()
        rows = found.where(any_hit).select(*keys, "pos", F.inline(F.concat(*hits)))
    else:
        def tall(df: DataFrame, keep: list[str]) -> DataFrame:
            each = F.array(*(F.struct(F.lit(m).alias("mask"), F.col(f"seed{m}").alias("seed")) for m in range(len(MASKS))))
            return df.select(*keep, F.inline(each))

        theirs = tall(item_seeds.withColumnRenamed("pos", "at"), ["item_id", "at"])
        rows = tall(doc_seeds, [*keys, "pos"]).join(theirs, ["mask", "seed"])
    return rows.select(*keys, "item_id", (F.col("pos") - F.col("at")).alias("offset")).distinct()


def _short_overlaps(docs: DataFrame, items: DataFrame, lengths: list[int], shared: bool) -> DataFrame:
    """``doc_id, item_id, offset, n, n_equal`` of every place of items of fewer than
    ``WINDOW`` words. An item may stand over either end of a document."""
    widest, edge = max(lengths), max(may_differ(n) for n in lengths)

    def seeds(n: int, word: Callable[[int], Column]) -> list[Column]:
        return [F.xxhash64(F.lit(n), F.lit(m), *(word(o) for o in mask)) for m, mask in enumerate(short_masks(n))]

    hashed = F.transform("words", lambda w: F.xxhash64(w))
    item_hashes = items.select("item_id", hashed.alias("h"))
    theirs = item_hashes.select(
        "item_id", "h",
        F.explode(F.array_compact(F.array(*(F.when(F.size("h") == n, s) for n in lengths for s in seeds(n, lambda o: F.get("h", F.lit(o))))))).alias("seed"),
    )

    def nothing(n: int) -> Column:
        return F.array_repeat(F.lit(0).cast("long"), n)

    padded = docs.where(F.size("words") > 0).select(
        "doc_id", (F.size("words") + edge).alias("places"), F.concat(nothing(edge), hashed, nothing(widest)).alias("h")
    )
    zipped = F.arrays_zip(*(F.slice("h", k + 1, F.col("places")).alias(f"w{k}") for k in range(widest)))
    windows = padded.select("doc_id", F.posexplode(zipped).alias("pos", "w"))
    each = F.array(*(s for n in lengths for s in seeds(n, lambda o: F.col("w")[f"w{o}"])))
    window = F.array(*(F.col("w")[f"w{k}"] for k in range(widest)))
    ours = windows.select("doc_id", "pos", window.alias("window"), F.explode(each).alias("seed"))
    n = F.size("h")
    equal = F.size(F.filter(F.zip_with("h", F.slice("window", 1, n), lambda a, b: a == b), lambda x: x))
    met = ours.join(F.broadcast(theirs) if shared else theirs, "seed").select(
        "doc_id", "item_id", (F.col("pos") - edge).alias("offset"), n.alias("n"), equal.alias("n_equal")
    )
    return met.where(F.col("n_equal") >= F.ceil(F.col("n") * SHARE))


def _best_window(equal: Column, n: Column) -> Column:
    """Most equal words in any ``WINDOW`` aligned words (in all, if there are fewer)."""
    width = F.least(F.lit(WINDOW), n)
    return F.array_max(
        F.transform(F.sequence(F.lit(1), n - width + 1), lambda s: F.size(F.filter(F.slice(equal, s, width), lambda x: x)))
    )


def overlaps(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, n_places, start_word, n_equal, item_words, similarity``: a row
    per document and item that overlap; the figures are those of the best place.

    Words are runs of ASCII letters, digits and non-ASCII characters without case.
    Items of any length are searched, one word too: what cannot be told from chance is
    for the caller to leave out. Null or empty texts match nothing. Rows that share an id count as one document (also
    those without one), repeated items as one place. Other columns are left out.
    """
    items = items.select(F.col(item_col).cast("long").alias("item_id"), words_of(normal_text(F.col(item_text_col))).alias("item_words"))
    items = items.where(F.size("item_words") > 0)
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    length = F.size("item_words")
    sizes = dict(map(tuple, items.groupBy(F.least(F.lit(WINDOW), length)).agg(F.sum(length)).collect()))
    size = sizes.pop(WINDOW, 0)
    short = items.where(length < WINDOW).withColumnRenamed("item_words", "words")
    items = items.where(length >= WINDOW)
    item_seeds = _seeds(items.withColumnRenamed("item_words", "words"), ["item_id"])
    doc_words = docs.withColumn("words", words_of(normal_text(F.col("text"))))
    doc_seeds = _seeds(doc_words, ["doc_id", "text_hash"])
    found = _offsets(doc_seeds, item_seeds, size <= MAX_SHARED_WORDS)

    # Few documents are found; only their texts are compared. The text's hash in
    # the key keeps rows without an id, or with one id, apart.
    near = F.broadcast(items) if size <= MAX_SHARED_WORDS else items
    found = found.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    pairs = docs.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).join(
        near.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i"))
    )
    n = F.size("item_words")

    def aligned(words: Column) -> Column:
        return F.transform("item_words", lambda w, k: F.coalesce(F.get(words, k + F.col("offset")) == w, F.lit(False)))

    equal = once(words_of(normal_text(F.col("text"))), aligned)
    compared = pairs.select("doc_id", "item_id", "offset", n.alias("n"), equal.alias("equal"))
    scored = compared.select(
        "doc_id", "item_id", "offset", "n", F.size(F.filter("equal", lambda x: x)).alias("n_equal"),
        _best_window(F.col("equal"), F.col("n")).alias("best"),
    )
    kept = scored.where(F.col("best") >= F.ceil(F.least(F.lit(WINDOW), F.col("n")) * SHARE)).drop("best")
    if sizes:
        kept = kept.unionByName(_short_overlaps(doc_words, short, sorted(sizes), sum(sizes.values()) <= MAX_SHARED_WORDS))
    kept = kept.distinct()
    best = F.max(F.struct("n_equal", (-F.col("offset")).alias("start"), "n")).alias("best")
    return kept.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_places"), best).select(
        "doc_id", "item_id", "n_places", (-F.col("best.start")).cast("long").alias("start_word"),
        F.col("best.n_equal").cast("long").alias("n_equal"), F.col("best.n").cast("long").alias("item_words"),
        (F.col("best.n_equal") / F.col("best.n")).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` overlaps no item, all columns as they are.

    Rows without an id are one document to ``overlaps``; here each is judged by
    the hash of its text instead. Null and empty texts stay, repeated rows stay or
    go together, columns may have any names, empty tables give what there is.
    """
    key = F.struct("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("h"))
    named = docs.select(F.to_json(key).alias("doc_id"), "text")
    name = f"found_{uuid.uuid4().hex[:8]}"
    found = overlaps(named, items).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, F.to_json(key) == F.col(name), "left_anti")
