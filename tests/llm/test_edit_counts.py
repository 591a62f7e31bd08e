"""Counts after edits against encoding the edited text anew."""

import os
import random

import public_tokenizers
import pytest

from curate.llm import edit_counts as ec
from curate.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def counter():
    return ec.Counter(PATH, PATTERN)


def apply(text, pos, removed, added):
    pos = min(max(pos, 0), len(text))
    return text[:pos] + added + text[min(pos + max(removed, 0), len(text)) :]


@pytest.mark.parametrize("seed", range(8))
def test_random_edits(counter, seed):
    rng = random.Random(seed)
    pool = ["word", "'", "s", "ll", "'ve", " ", "  ", "\n", "\t ", "123", "!?", "é", "日本", "x" * 70, "re", "\u0085", "a b "]
    for _ in range(60):
        text = "".join(rng.choices(pool, k=rng.choice([0, 1, 5, 60, 800])))
        counted = ec.CountedText(text, counter)
        for _ in range(25):
            pos, removed = rng.randint(-2, len(text) + 3), rng.choice([0, 0, 1, 2, 9, 300])
            added = "".join(rng.choices(pool, k=rng.choice([0, 1, 2, 6, 40])))
            text = apply(text, pos, removed, added)
            counted.edit(pos, removed, added)
            assert counted.pieces() == counter.split(text)
            assert counted.n_chars == len(text)
            assert counted.n_tokens == len(counter.encoding.encode_ordinary(text))


def test_small_edits_of_a_long_text_reencode_little(counter):
    text = "some words here, " * 20_000
    counted = ec.CountedText(text, counter)
    for pos in (0, 170_000, len(text)):
        counted.edit(pos, 3, "new")
    assert counted.reencoded < 200
    counted.edit(5, 0, "big insertion " * 9000)
    counted.edit(10, 400_000, "")
    assert counted.n_tokens == len(counter.encoding.encode_ordinary("".join(counted.pieces())))


def test_frames(spark):
    docs = spark.createDataFrame(
        [(1, "hello world", "x"), (2, None, "x"), (None, "no id", "x"), (3, "same", "x"), (3, "same", "x"), (4, "long text " * 20_000, "x")],
        "doc_id long, text string, counts string",
    )
    edits = spark.createDataFrame(
        [(1, 1, 0, 5, "bye"), (1, 0, None, None, "oh, "), (2, 0, 7, 7, "filled"), (3, 0, 99, 0, None), (8, 0, 0, 0, "none"), (4, 0, 10, 10, "x")],
        "doc_id long, seq int, pos long, removed long, added string",
    )
    got = ec.edited_counts(ec.attach_edits(docs, edits), PATH, PATTERN)
    rows = {(r.doc_id, r.n_chars): r for r in got.collect()}
    fresh = ec.Counter(PATH, PATTERN).encoding.encode_ordinary
    assert got.count() == 6
    texts = ["oh, hello world", apply("oh, hello world", 0, 5, "bye")]
    first = rows[1, len(texts[1])]
    assert first.counts == [len(fresh(t)) for t in texts] and first.n_tokens_before == len(fresh("hello world"))
    assert rows[2, 6].n_tokens == len(fresh("filled")) and rows[3, 4].n_tokens == rows[3, 4].n_tokens_before
    assert rows[None, 5].counts == []
    assert ec.edited_counts(ec.attach_edits(docs.limit(0), edits), PATH, PATTERN).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_gives_the_count_after_each_edit(spark, counter, monkeypatch):
    given = []
    real = ec.edited_counts
    monkeypatch.setattr(ec, "edited_counts", lambda docs, *args: given.append(docs) or real(docs, *args))
    got = {r.doc_id: r for r in QUERIES["op2_edit_counts"](spark, SF_DIR).collect()}
    for doc_id, text, edits in given[0].select("doc_id", "text", "edits").collect():
        want = []
        for e in edits:
            text = apply(text, e.pos, e.removed, e.added)
            want.append(len(counter.encoding.encode_ordinary(text)))
        assert got[doc_id].counts == want and len(want) == 3 and got[doc_id].n_tokens == want[-1]
