"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curate.llm import bpe
from curate.llm.pretoken import TextEncoder, Vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello World", "don't we'll 've ''s 's't !!'s 'sfoo 'S I'M x'll", "a<|endoftext|>b <|startoftext|><|startoftext|>",
    "ΑΣ ΣΑΣ İstanbul ǅ ﬀ", "élève café", "１２3½ Ⅷ 12345", "日本語 テキスト 한국어", "a b c　d\u0085e\x1cf​g",
    "aaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "!!!!! ***&&& $$$### -- ---", "👩‍👩‍👧 🇫🇷", "\r\n\t x \n", "x" * 30000, "ab" * 9999, "null\x00byte", "new \U00010d50\U00010d41 \ua7cb\u1c89x \U000116d0\U000116d1",
]


@pytest.fixture(scope="module")
def encoder():
    vocabulary = Vocabulary.read(PATH)
    return TextEncoder(vocabulary, bpe.MergeTable(vocabulary).encode_words)


def expected(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def rows(encoder, texts):
    ids, counts = encoder(texts)
    return [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]


def test_fixed_texts(encoder):
    assert rows(encoder, TEXTS) == expected(TEXTS)
    assert [rows(encoder, [t])[0] for t in TEXTS] == expected(TEXTS)


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(encoder, seed):
    rng = random.Random(seed)
    pools = ["abcdefghij '", "'strevemlld xyz!", "".join(map(chr, range(0x20, 0x250))), "".join(map(chr, range(0x300, 0xD800)))]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 300))) for _ in range(300)]
    assert rows(encoder, texts) == expected(texts)


def test_frames(spark):
    library = Tokenizer.from_file(PATH)
    data = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (3, TEXTS[3], "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string")
    got = sorted(map(str, bpe.digests(bpe.decode(bpe.encode(docs, PATH), PATH)).toPandas().astype(object).where(lambda d: d.notna(), None).values.tolist()))
    want = []
    for key, text, _ in data:
        ids = library.encode(text or "", add_special_tokens=False).ids
        hashes = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append(str([float(key) if key is not None else None, len(ids), *hashes]))
    assert got == sorted(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.decode(bpe.encode(docs, PATH), PATH)).collect() == []


def test_decoding_needs_no_encoder(spark, monkeypatch):
    """Its worker keeps the tokens only, and works on a bounded number of ids."""
    docs = spark.createDataFrame([(i, "word and other " * n) for i, n in enumerate((0, 1, 400, 3, 0, 90, 2))], "doc_id long, text string")
    encoded = bpe.encode(docs, PATH)
    batch = encoded.toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(bpe, "DECODED_AT_ONCE", 100)
    sizes = [len(part.column("ids").flatten()) for part in bpe._id_slices(batch)]
    assert sum(sizes) == 3 * 496 and len(sizes) == 3 and sum(p.num_rows for p in bpe._id_slices(batch)) == 7

    def no_encoder(path):
        raise AssertionError("the encoder's tables are not for decoding")

    monkeypatch.setattr(Vocabulary, "read", no_encoder)
    library = Tokenizer.from_file(PATH)
    assert bpe.token_names(PATH) == {i: t for t, i in library.get_vocab(with_added_tokens=True).items()}


def test_round_trip_takes_one_worker_per_task(spark):
    from curate.llm.queries import QUERIES

    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x")], "doc_id long, text string, ids string")
    sort = lambda df: sorted(map(str, df.collect()))
    assert sort(bpe.round_trip(docs, PATH)) == sort(bpe.decode(bpe.encode(docs, PATH), PATH))
    plan = QUERIES["op8_bpe"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
