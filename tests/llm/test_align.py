"""Alignment against a recount by byte ranges, and its cases."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from curate.llm import align
from curate.llm.pretoken import byte_letters

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", None, " ", "x", "Hello world", "  two  spaces ", "naïve café Straße 日本語 😀", "a\nb\r\n\tc", "the the the", "<|endoftext|> </s> <0x41> <unk> <s>",
    "has ▁ mark", "aaaaaaa bbbb aa", "é combining", "null\x00byte", "1234567 3.14 x=y*2", "Don't we'll they've", "　wide space", "ab" * 500,
]


def tokens_of():
    spec = json.load(open(A_PATH, encoding="utf-8"))
    letters = {c: b for b, c in enumerate(byte_letters())}
    a = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    b = {}
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        b[i] = bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()
    return a, b, pieces


def expected(texts):
    a_bytes, b_bytes, pieces = tokens_of()
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    rows, pairs = [], Counter()
    for text in texts:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(size[i]), i))
                at += len(size[i])
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        shared = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, low = [], 0
        for end in shared:
            sides = [",".join(str(i) for s, e, i in side if low <= s and e <= end) for side in spans]
            groups.append("|".join(sides))
            low = end
        pairs.update(links)
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    top = defaultdict(int)
    for (_, b), n in pairs.items():
        top[b] = max(top[b], n)
    return [
        (n_a, n_b, groups, len(links), sum(pairs[p] == top[p[1]] for p in links), sum(pairs[p] for p in links), digest)
        for n_a, n_b, groups, links, digest in rows
    ], pairs


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [40, 2 << 20])
def test_against_byte_ranges(spark, monkeypatch, block_bytes):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "the world"), (None, "the world"), (4, TEXTS[4])]
    figures, pairs = expected([t for _, t in data])
    want = sorted(((key, *f) for (key, _), f in zip(data, figures)), key=repr)
    assert any(f[0] == 0 for f in figures[3:]) and sum(f[0] > 0 for f in figures) > 12
    docs = spark.createDataFrame([(*d, 1, "y") for d in data], "doc_id long, text string, block int, same string").repartition(3)
    monkeypatch.setattr(align, "BLOCK_BYTES", block_bytes)
    got = align.align(docs, A_PATH, B_PATH)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == want
    assert {len(p) for p in pairs} == {2}


def test_pair_counts(spark):
    texts = ["the the world", "naïve theworld 日本", "aaaaaaa aaa"]
    _, pairs = expected(texts)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    mapped = align.identity_map(align.ByteLevel(A_PATH).tokens, align.Pieces(B_PATH))
    same = spark.createDataFrame([(a, int(b)) for a, b in enumerate(mapped) if b >= 0], "a int, b int")
    got = align.pair_counts(align.links(docs, A_PATH, B_PATH), same).collect()
    assert {(r["a"], r["b"]): r["n"] for r in got} == pairs
    assert all(r["best"] == (r["n"] == max(n for (_, b), n in pairs.items() if b == r["b"])) for r in got)


def test_one_to_one_links_are_not_shuffled():
    aligner = align.Aligner(A_PATH, B_PATH)
    found = aligner(["the world", "日本語 naïve"])
    assert found.one_to_one.any() and not found.one_to_one.all()
    for a, b, regular in zip(found.a, found.b, found.one_to_one):
        if regular:
            assert aligner.a.tokens[a] == aligner.b.tokens[b]


def test_nothing_to_align(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(empty, A_PATH, B_PATH).collect() == []
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert rows(align.align(blank, A_PATH, B_PATH)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_long_text():
    aligner = align.Aligner(A_PATH, B_PATH)
    text = "some words again " * 40_000
    found = aligner([text])
    assert found.figures["n_links"][0] == len(found.a) >= found.figures["n_a"][0] > 100_000
    assert pa.array(found.groups_sha256)[0].as_py()


def test_ranks_give_the_ids_of_the_library():
    a = align.ByteLevel(A_PATH)
    assert a.ranks is not None
    texts = [t or "" for t in TEXTS] + [f"a{chr(c)}{chr(c)}b1{chr(c)}2 {chr(c)}x .{chr(c)}; " for c in range(0x20, 0xD800, 7)]
    texts += [" " * 50_000, "x" * 50_000, "\n" * 50_000 + "x", "!?" * 20_000]
    fast = a.encode(texts)
    a.ranks = None
    assert fast == a.encode(texts)
