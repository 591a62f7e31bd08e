"""Automaton scores against counting in plain Python."""

import collections
import math
import random
import re
import string
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curate.llm import lm

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def model(texts, order, k=lm.K):
    """``p(w, h)`` and the counts of n-grams by length, counted one by one."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for text in texts:
        t = tokens(text)
        for n in range(1, order + 1):
            counts[n].update(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
    n, v = sum(counts[1].values()), len(counts[1])

    def p(w, h):
        if not h:
            return (counts[1][w,] + 1) / (n + v + 1)
        lower = p(w, h[1:])
        state = counts[len(h)][h]
        return (counts[len(h) + 1][(*h, w)] + k * lower) / (state + k) if state else lower

    return p, counts, n


def by_hand(rows, order, k=lm.K):
    p, counts, n = model([text for _, text, train in rows if train], order, k)
    out = []
    for key, text, _ in rows:
        t = tokens(text)
        score = sum(math.log10(p(w, tuple(t[max(0, i - order + 1) : i]))) for i, w in enumerate(t))
        out.append((key, len(t), sum((w,) in counts[1] for w in t), n, sum(math.log10(p(w, ())) for w in t), score))
    return out


def check(spark, rows, order=lm.ORDER):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, train boolean, block int, score string")
    got = lm.score(docs.repartition(3), F.col("train"), order=order)
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    sort = lambda r: (str(r[0]), r[1], round(r[5], 6))
    got, want = sorted(map(tuple, got.collect()), key=sort), sorted(by_hand(rows, order), key=sort)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)


def sample():
    rng = random.Random(1)
    pool = ["the", "The", "of,", "a\tb", "ünder x", "\x1f", *(f"w{i}" for i in range(200))]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 60))), rng.random() < 0.8) for i in range(150)]
    return rows + [(None, "no id", True), (None, None, False), (500, None, True), (501, "", None), (502, "long one " * 40000, True), *rows[:9]]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_one_block(spark, order):
    check(spark, sample(), order)


def test_many_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 30_000)
    check(spark, sample())


def test_no_training_rows(spark):
    check(spark, [(1, "a b", False), (2, "", None)])


def test_probabilities_sum_to_one():
    p, counts, _ = model(["a b a c a b", "b a", "c a b a c"], 4)
    words = ["a", "b", "c", None, "unknown"]
    for h in [(), ("a",), ("a", "b"), ("b", "a", "c"), ("unknown", "a", "b"), ("c", "c", "c")]:
        assert math.isclose(sum(p(w, h) for w in words), 1), h


def test_a_longer_order_fits_what_it_has_seen(spark):
    text = "one two three one two four one two three"
    docs = spark.createDataFrame([(1, text, True), (2, "one two three", False)], "doc_id long, text string, train boolean")
    scores = [{r.doc_id: r.score for r in lm.score(docs, F.col("train"), order=n, k=0.1).collect()} for n in (1, 2, 3)]
    assert scores[0][1] < scores[1][1] < scores[2][1]
    with pytest.raises(ValueError):
        lm.score(docs, F.col("train"), order=0)


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(True)).collect() == []


def test_a_full_block_takes_little_beside_the_shuffles():
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(40_000)])
    texts = [" ".join(words[rng.zipf(1.3, 400) % len(words)]) for _ in range(lm.BLOCK_BYTES // 2800)]
    rows = pa.RecordBatch.from_pydict({"id": range(len(texts)), "text": texts, "train": [True] * len(texts)})
    block = lm._Block()
    tracemalloc.start()
    try:
        block.add(rows)
        block.close(lm.ORDER)
        counts = [c for _, _, c in block.counted()]
        lm.Automaton(counts, 10**6, 10**5, lm.K).walk(block)
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()
