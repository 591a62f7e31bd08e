"""The network: covering, gradients, whole texts, held-out accuracy."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curate.llm import quality

SF_DIR = "/root/testdata/sf0.01"


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 464, 465, 5000])
def test_chunks_cover_the_whole_text(size):
    text = "".join(chr(33 + i % 90) for i in range(size))
    data, offsets = flat(["before", text, "after"])
    starts, ends, first = quality.cover(offsets)
    own = slice(first[1], first[2])
    covered = np.zeros(size, bool)
    for row, s, e in zip(quality.cut(data, starts[own], ends[own]), starts[own], ends[own]):
        real = data[s : min(s + quality.CHUNK, e)]
        assert np.array_equal(row[: len(real)], real) and not row[len(real) :].any()
        covered[s - 6 : s - 6 + len(real)] = True
    assert covered.all()


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = quality.Network.fresh(3)
    for part in net.parts():
        part += rng.standard_normal(part.shape).astype(np.float32) * 0.1
    chunks = [rng.integers(0, 256, (n, 40)).astype(np.uint8) for n in (1, 3, 2)]
    labels = np.array([1, 0, 1], np.float32)

    def loss():
        first = np.array([0, 1, 4])
        odds = net.combine(net.hidden(net.pooled(np.concatenate(chunks))[0]), first)[0].astype(float)
        return float(np.mean(np.log1p(np.exp(-odds)) * labels + np.log1p(np.exp(odds)) * (1 - labels)))

    for part, grad in zip(net.parts(), quality._gradients(net, chunks, labels)):
        for at in np.argsort(-np.abs(grad).ravel())[:3]:
            old = part.flat[at]
            values = []
            for step in (1e-2, -1e-2):
                part.flat[at] = old + step
                values.append(loss())
            part.flat[at] = old
            assert (values[0] - values[1]) / 2e-2 == pytest.approx(grad.flat[at], rel=0.1, abs=2e-3)


def test_the_end_of_a_long_text_counts():
    net = quality.Network.fresh(1)
    score = lambda t: net.score(*flat([t]))[0]
    assert score("a" * 100_000 + "!!?!") != score("a" * 100_004)
    assert np.allclose(net.score(*flat(["one", "", "three " * 900])), [score("one"), score(""), score("three " * 900)])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    from curate.llm.queries import QUERIES

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op5_quality"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) / len(judged) > 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x", 1.0), (None, "a", "y", 2.0), (2, "", "z", 3.0), (2, "", "z", 3.0), (3, "word " * 50_000, "w", 4.0)],
        "doc_id long, text string, label string, score double",
    )
    marks = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(docs, marks, F.lit(True))
    got = quality.scores(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and {r.label for r in got} == set("xyzw")
    assert quality.train(docs, marks.limit(0), F.lit(True)) == 0.5
    assert quality.scores(docs.limit(0), model).collect() == []
    assert quality.scores(docs, 0.25).select("score").distinct().collect()[0][0] == 0.25
