"""Pruned search against scoring every document."""

import collections
import math
import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest

from curate.llm import search

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(docs, queries, k):
    made = [(i, collections.Counter(words(t))) for i, t in docs]
    df = collections.Counter(w for _, c in made for w in c)
    n, mean = len(docs), sum(sum(c.values()) for _, c in made) / max(1, len(docs))
    asked = {}
    for key, text in queries:
        if key is not None:
            asked.setdefault(key, set()).update(words(text))
    out = []
    for key, terms in asked.items():
        scores = []
        for i, c in made:
            points = 0
            for w in terms & set(c):
                idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                tf = c[w] * (search.K1 + 1) / (c[w] + search.K1 * (1 - search.B + search.B * sum(c.values()) / mean))
                points += round(idf * tf * search.UNIT)
            if points:
                scores.append((-points / search.UNIT, i is None, i))
        scores.sort(key=lambda s: (round(s[0], 7), s[1], s[2] or 0))
        out += [(key, r + 1, i, -s) for r, (s, _, i) in enumerate(scores[:k])]
    return sorted(out)


def sample():
    rng = random.Random(2)
    common, rare = ["the", "of", "Und", "ünder"], [f"w{i}" for i in range(500)]
    text = lambda: " ".join(rng.choices(common, k=rng.randint(0, 30)) + rng.choices(rare, k=rng.randint(0, 40)))
    docs = [(i, text()) for i in range(600)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (None, None), (2000, ""), (2001, "w1 " * 40_000), docs[3], docs[3]]
    return docs, docs[::60] + [(7, docs[7][1]), (3000, "the"), (3001, "nowhere else"), (3002, None), (None, "the of"), (2001, "w2")]


@pytest.mark.parametrize("block,shard", [(64, 64 << 20), (4, 5_000), (1, 64 << 20)])
def test_against_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "SHARD_BYTES", shard)
    monkeypatch.setattr(search, "QUERIES_AT_ONCE", 5)
    monkeypatch.setattr(search, "TOGETHER", 3)
    monkeypatch.setattr(search, "COMMON", block)
    docs, queries = sample()
    frame = lambda rows: spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rank int, term string")
    got = sorted(map(tuple, search.search(frame(docs).repartition(3), frame(queries), 10).collect()))
    want = by_hand(docs, queries, 10)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-6)


def test_blocks_are_left_unopened(monkeypatch):
    rng = random.Random(0)
    texts = ["a rare " + "b " * 5 if i == 900 else "b " + " ".join(rng.choices([f"w{j}" for j in range(900)], k=20)) for i in range(3000)]
    part = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), pa.array(texts)], ["id", "text"])
    shard = search.Shard([part], 20.0)
    _, terms, _, _ = search._pairs(part.slice(900, 1))
    terms = np.unique(np.concatenate((terms, search._pairs(part.slice(5, 1))[1][:3])))
    opened = []
    monkeypatch.setattr(search.np, "partition", lambda x, k, f=np.partition: opened.append(len(x)) or f(x, k))
    ((_, docs, _),) = shard.answers(np.zeros(len(terms), np.int64), terms, np.full(len(terms), 4.0), 1)
    assert len(docs) == 1 and sum(opened) < 3000 / 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert search.search(docs.limit(0), docs).collect() == []
    assert search.search(docs, docs.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in search.search(docs, docs).collect()] == [(1, 1, 1)]


def test_like_documents_share_a_group_and_other_groups_stay_closed(monkeypatch):
    """Documents of four vocabularies in turn: a query opens those of its own only, and
    finds what adding up every document finds."""
    rng = random.Random(1)
    texts = [" ".join(f"{'abcd'[i % 4]}{rng.randrange(60)}" for _ in range(40)) + f" only{i}" for i in range(2400)]
    part = pa.RecordBatch.from_arrays([pa.array(range(2400), pa.int64()), pa.array(texts)], ["id", "text"])
    shard = search.Shard([part], 41.0)
    assert len(shard.groups) >= 4
    assert all(len({i % 4 for i in g.rows.tolist()}) == 1 for g in shard.groups)
    assert sorted(np.concatenate([g.rows for g in shard.groups])) == list(range(2400))
    opened = []
    real = search.Group._sums
    monkeypatch.setattr(search.Group, "_sums", lambda self, which, term, frequent, n: opened.append(n * len(self.rows)) or real(self, which, term, frequent, n))
    text, terms, _, lengths = search._pairs(part.slice(0, 200))
    found = [np.concatenate(c) for c in zip(*shard.answers(text, terms, np.full(len(terms), 4.0), 5))]
    assert sum(opened) <= 200 * 2400 / 3
    _, all_terms, count, length = search._pairs(part)
    doc = np.repeat(np.arange(2400), np.diff(np.append(np.flatnonzero(np.append(True, np.diff(search._pairs(part)[0]) > 0)), len(all_terms))))
    weight = np.rint(4.0 * count * (search.K1 + 1) / (count + search.K1 * (1 - search.B + search.B * length[doc] / 41.0)) * search.UNIT)
    for q in range(0, 200, 9):
        own = np.isin(all_terms, terms[text == q])
        score = np.bincount(doc[own], weight[own], 2400)
        kth = np.sort(score)[-5]
        got = {(d, s) for a, d, s in zip(*found) if a == q and s >= kth}
        assert got == {(d, score[d]) for d in np.flatnonzero(score >= kth)}


@pytest.mark.parametrize("postings,worth", [(1, 0), (7, 10**9), (65_536, 256)])
def test_sums_do_not_depend_on_how_they_are_made(monkeypatch, postings, worth):
    monkeypatch.setattr(search, "POSTINGS", postings)
    monkeypatch.setattr(search, "WORTH", worth)
    monkeypatch.setattr(search, "GROUP_DOCS", 100)
    docs, _ = sample()
    part = pa.RecordBatch.from_arrays([pa.array(range(len(docs)), pa.int64()), pa.array([t or "" for _, t in docs])], ["id", "text"])
    shard = search.Shard([part], 35.0)
    text, terms, _, _ = search._pairs(part.slice(0, 40))
    got = {(q, d, s) for c in shard.answers(text, terms, np.full(len(terms), 1.5), 1000) for q, d, s in zip(*c)}
    _, words, count, length = search._pairs(part)
    doc = search._pairs(part)[0]
    weight = np.rint(1.5 * count * (search.K1 + 1) / (count + search.K1 * (1 - search.B + search.B * length[doc] / 35.0)) * search.UNIT)
    want = set()
    for q in np.unique(text):
        own = np.isin(words, terms[text == q])
        score = np.bincount(doc[own], weight[own], len(docs))
        want |= {(q, d, score[d]) for d in np.flatnonzero(score)}
    assert got == want
