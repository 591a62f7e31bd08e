"""Resampling against a plain recount, and its cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from curate.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, percent, min_words, longest, buckets, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, longest)[1]) for texts in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for key, text in docs:
        words, runs = features(text, longest)
        weight = sum(gain(bucket(f)) for f in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(words), len(runs), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], -math.inf if r[0] is None else r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, rows), key=repr)


TEXTS = [
    "", None, " ", "One two THREE four", "naïve Ünïcode ÉCOLE Straße", "a\x00b", "x-y z_z 12 3.4", "été " * 40, "日本語 テキスト " * 30,
    *(f"w{i % 7} w{i % 5} common words here {i} " * (i % 9) for i in range(60)),
]


@pytest.mark.parametrize("longest, min_words, percent", [(1, 20, 10), (2, 3, 33), (3, 0, 100)])
def test_against_a_plain_recount(spark, longest, min_words, percent):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (None, TEXTS[40]), (5, TEXTS[40]), (40, TEXTS[40]), (40, TEXTS[40])]
    target = ["common words w1 w2", None, "", "Été four"]
    # Columns that clash with names used inside stay out of the way.
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, row string, n_words int")
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = resample.resample(frame, wanted, percent, min_words, longest, 50, 7)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, target, percent, min_words, longest, 50, 7)


@pytest.mark.parametrize("step", [1, 2, 5, 1 << 16])
def test_steps_do_not_change_the_runs(monkeypatch, step):
    monkeypatch.setattr(resample, "STEP", step)
    texts = ["a b c d e f", "", "g h", "i", "a b c d e f g h i j"]
    for longest in (1, 2, 4):
        got = Counter()
        for document, bucket, _ in resample.runs(pa.array(texts), longest, 1 << 31):
            got.update(zip(document.tolist(), bucket.tolist()))
        assert got == Counter((i, zlib.crc32(f.encode()) % (1 << 31)) for i, t in enumerate(texts) for f in features(t, longest)[1])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert resample.resample(docs, some).collect() == []
    assert [r["weight"] for r in resample.resample(some, docs, percent=100).collect()] == [
        math.floor(1000 * math.log(10040 / (21 * 10000)))
    ]


def test_ranks_hold_where_one_row_fills_the_table(spark):
    docs = spark.range(3000).selectExpr("if(id < 2000, 1L, id) AS doc_id", "repeat('same words ', 10) AS text")
    rows = resample.resample(docs, docs, percent=90).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 2701))
    drawn = [(-r["score"], r["doc_id"]) for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])]
    assert drawn == sorted(drawn) and max(drawn)[0] <= min(-r["score"] for r in rows if not r["rank"])


def test_a_long_text(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "repeat('alpha beta ', 200000) AS text")
    row = resample.resample(docs, docs, longest=2, percent=100).first()
    assert (row["n_words"], row["n_features"], row["rank"]) == (400_000, 799_999, 1)
    assert np.sign(row["weight"]) <= 0
