"""Counts against plain Python, verdicts against the library, and their cases."""

import random
import re
import string

import pytest
import zstandard

from curate.llm import bands

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(5)
NOISE = "".join(RNG.choices(string.ascii_letters + string.digits + "+/", k=9000))
PROSE = " ".join("".join(RNG.choices("etaoinshrdlu", k=RNG.randint(2, 9))) for _ in range(3000))
TEXTS = [
    "", None, " \n\t ", "one", "a b c d e f g h i j", "a a a a a a a a a a a a", "x y z\nx y z\n\n\n x y z\nx y z ", "#*$%&|<> ###", "naïve 日本 é b\x85c",
    "l1 one two\r\nl1 one two\r\n", "a b c d e a b c d e", "a b c d e f a b c d e g", "A b C D e a b c d e", "one two three four five " * 200,
    PROSE[:90], PROSE[:200], PROSE[:700], PROSE, PROSE[:4096] + "same words again " * 2000, NOISE, PROSE[:3000] + NOISE, "é" * 3000, "x" * 63, "x" * 64, "x" * 65,
]


def by_hand(text, rules=bands.Rules()):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(words) < 1500 else None
    lines = [line for line in text.split("\n") if WORD.search(line)]
    raw = text.encode()
    compressor = zstandard.ZstdCompressor(level=rules.level, write_checksum=False)

    def side(piece):
        if len(piece) < rules.least_bytes:
            return 0
        band = next(b for b in rules.bands if len(piece) <= b.max_bytes)
        ratio = len(compressor.compress(piece)) / len(piece)
        return -1 if ratio < band.low else 1 if ratio > band.high else 0

    pieces = [raw[i : i + rules.chunk_bytes] for i in range(0, len(raw), rules.chunk_bytes)]
    low, high = (sum(len(p) for p in pieces if side(p) == s) for s in (-1, 1))
    failure = None
    if side(raw) < 0 or low > rules.bad_share * len(raw):
        failure = "repetitive"
    elif side(raw) > 0 or high > rules.bad_share * len(raw):
        failure = "incompressible"
    ratio = len(compressor.compress(raw)) / len(raw) if raw else None
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": None if marked is None else len(marked),
        "ratio": ratio, "n_chunks": len(pieces), "low_bytes": low, "high_bytes": high, "failure": failure,
    }


def check(row, text):
    want = by_hand(text)
    for name, value in want.items():
        if not (name == "n_repeat_words" and value is None):
            assert row[name] == value, (name, text and text[:40])
    failed = row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"]
    assert row["base_failed"] == failed and row["kept"] == (not failed and row["failure"] is None)


def test_against_plain_python(spark):
    rows = [(i, t, 1, "z") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    got = {r["doc_id"]: r for r in bands.judge(docs.coalesce(1)).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        check(got[i], text)
    assert {r["failure"] for r in got.values()} == {None, "repetitive", "incompressible"}
    assert got[TEXTS.index(PROSE)]["kept"] and not got[TEXTS.index(NOISE)]["kept"]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    pool = ["a", "b", "cc", "#d", "é", "日本"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\t", " \n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    for row in bands.judge(docs).collect():
        check(row, texts[row["doc_id"]])


def test_limits_follow_the_length():
    compression = bands.Compression(bands.Rules(bands=(bands.Band(100, 0.0, 9.0), bands.Band(float("inf"), 0.5, 9.0))))
    assert compression(b"a" * 100)[4] is None and compression(b"a" * 101)[4] == "repetitive"
    chunked = bands.Rules(bands=(bands.Band(4096, 0.5, 9.0), bands.Band(float("inf"), 0.0, 9.0)))
    # The whole lies in its band; five of eight chunks do not.
    text = NOISE[:3072].encode() + b"b" * 5120
    assert bands.Compression(bands.Rules(chunked.bands, chunk_bytes=1024))(text)[4] == "repetitive"
    assert bands.Compression(bands.Rules(chunked.bands, chunk_bytes=1024, bad_share=0.7))(text)[4] is None


def test_nulls_repeats_and_an_empty_table(spark):
    docs = spark.createDataFrame([(None, None), (1, PROSE), (1, PROSE)], "doc_id long, text string")
    rows = sorted((str(r["doc_id"]), r["n_words"], r["kept"]) for r in bands.judge(docs).collect())
    assert rows == [("1", 3000, True), ("1", 3000, True), ("None", 0, False)]
    assert bands.judge(docs.where("false")).collect() == []


def test_a_text_longer_than_a_slice(spark):
    docs = spark.range(2).selectExpr("id AS doc_id", "repeat('many words of one text ', 500000) AS text")
    assert {(r["n_words"], r["n_repeat_words"], r["failure"]) for r in bands.judge(docs).collect()} == {(2_500_000, 2_500_000, "repetitive")}
