"""Stream files against the library's ids, laid end to end by hand."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curate.llm import arrow_stream
from curate.session import work_path

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = arrow_stream.Layout(seq_len=16, batch_rows=4)


def laid_out(rows):
    library = Tokenizer.from_file(PATH)
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark):
    rows = [(i * 7 % 101, f"word{i} and " * (i % 13) + "<|endoftext|>" * (i % 2)) for i in range(101)]
    rows += [(None, "no id"), (500, None), (501, ""), (502, "long " * 5000), (502, "long " * 5000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int").repartition(5)
    manifest = arrow_stream.write_shards(docs, work_path(spark, "stream"), PATH, SMALL, shards=4)
    assert manifest.count() > 1
    got = sorted((tuple(r) for r in arrow_stream.read_documents(spark, manifest).collect()), key=lambda r: r[1])
    assert got == laid_out(rows)


def test_random_access(spark):
    rows = [(i, f"text number {i} " * 5) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for shard in arrow_stream.write_shards(docs, work_path(spark, "stream"), PATH, SMALL).collect():
        flat = arrow_stream.read_ids(shard.path)
        assert len(flat) == shard.n_tokens
        found = [arrow_stream.read_sequence(shard.path, i) for i in range(shard.n_sequences)]
        assert all(len(ids) == 16 and not ids.flags.owndata for ids, _ in found)
        assert np.array_equal(np.concatenate([ids[mask] for ids, mask in found]), flat)
        assert all(mask.all() for _, mask in found[:-1])


def test_tied_ids(spark):
    docs = spark.createDataFrame([(1, "b b"), (1, "a"), (1, "b b")], "doc_id long, text string")
    got = arrow_stream.read_documents(spark, arrow_stream.write_shards(docs, work_path(spark, "stream"), PATH)).collect()
    assert sorted(r.n_tokens for r in got) == [2, 3, 3] and sorted(r.start for r in got)[0] == 0
    assert max(r.start + r.n_tokens for r in got) == 8


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = arrow_stream.write_shards(docs, work_path(spark, "stream"), PATH)
    assert arrow_stream.read_documents(spark, manifest).collect() == []


@pytest.mark.parametrize("word", ["Hello", "ß", "日本", "'ll", "a" * 300])
def test_words_as_the_library_does(word):
    from curate.llm.pretoken import TextEncoder, Vocabulary

    vocabulary = Vocabulary.read(PATH)
    encoder = TextEncoder(vocabulary, arrow_stream.library_words(vocabulary))
    assert encoder([word])[0].tolist() == vocabulary.library.encode(word, add_special_tokens=False).ids
