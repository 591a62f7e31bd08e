"""Each stage of the pipeline against a plain version, on rows with every oddity."""

import hashlib
import os

import public_tokenizers
import pytest
from test_decontaminate import by_hand as overlaps_by_hand
from test_jaccard import by_hand as classes_by_hand, grams
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from curate.llm import quality
from curate.llm.queries import quality_model, table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
# Names that the operators use inside, and names that need quoting.
SCHEMA = "doc_id long, text string, lang string, __place string, __found string, print int, `a.b` int, score double"


def oddities(spark):
    """Some documents with a few of their own: nulls, repeats, near copies, passages."""
    held = table(spark, SF_DIR, "documents").orderBy("doc_id").limit(60).select("doc_id", "text").collect()
    item = table(spark, SF_DIR, "benchmark").orderBy("item_id").first()["text"]
    base = " ".join(f"word{i} and more" for i in range(40))
    rows = [(r["doc_id"], r["text"]) for r in held]
    rows += [
        (None, None), (None, None), (None, base), (90_001, None), (90_002, ""), (90_003, "..."), (90_004, base), (90_004, base),
        (90_005, base.replace("word7 ", "other ")), (90_006, "before it " + item + " after it"), (None, item), (90_007, "tiny"), (90_007, "tiny"),
        (90_008, "long " * 30_000),
    ]
    return rows, spark.createDataFrame([(*r, "en", "p", "f", 1, 2, 0.25) for r in rows], SCHEMA)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def whole(df, docs):
    """All columns, of every row as they were."""
    assert df.columns == docs.columns
    assert {tuple(r)[2:] for r in df.collect()} <= {("en", "p", "f", 1, 2, 0.25)}
    return pairs(df)


def test_stages_are_the_four_in_order():
    assert [fn.__name__ for _, fn in pipeline.STAGES] == ["keep_quality", "drop_near_copies", "drop_benchmark", "encode"]


def test_quality_keeps_what_scores_a_half(spark):
    rows, docs = oddities(spark)
    # The labels and the training texts are those of the table; the rows are others.
    model = quality_model(spark, table(spark, SF_DIR, "documents"), SF_DIR)
    kept = pipeline.keep_quality(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    own = quality_model(spark, docs, SF_DIR)
    scored = quality.scores(docs.select("doc_id", "text"), own, score_col="q").collect()
    assert whole(kept, docs) == sorted(((r["doc_id"], r["text"]) for r in scored if r["q"] >= 0.5), key=str)
    assert isinstance(model, quality.Network) and len(scored) == len(rows)


def test_one_of_each_class_stays(spark):
    rows, docs = oddities(spark)
    got = whole(pipeline.drop_near_copies(spark, docs, SF_DIR), docs)
    least = {}
    for key, class_id, *_ in classes_by_hand(rows):
        least.setdefault(key, set()).add(class_id)
    blank = sorted((r for r in rows if not grams(r[1])[0]), key=str)
    assert sorted((r for r in got if not grams(r[1])[0]), key=str) == blank
    worded = [r for r in got if grams(r[1])[0]]
    assert len(set(worded)) == len(worded)
    # Every row left is the least of its class, and every class has one.
    assert all(key is None or key in least[key] for key, _ in worded)
    assert {c for k, c, *_ in classes_by_hand(rows) if c is not None and any(k == r[0] and grams(r[1])[0] for r in rows)} <= {k for k, _ in worded}


def test_documents_with_benchmark_passages_go(spark):
    rows, docs = oddities(spark)
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    numbered = list(enumerate(t for _, t in rows))
    found = {doc for doc, *_ in overlaps_by_hand([r for r in numbered if len(r[1] or "") < 50_000], items)}
    # Rows of one id are one document.
    gone = {rows[i][0] for i in found}
    expected = sorted((r for i, r in enumerate(rows) if (i not in found if r[0] is None else r[0] not in gone)), key=str)
    got = whole(pipeline.drop_benchmark(spark, docs, SF_DIR), docs)
    assert got == expected and 90_006 in gone and len(got) < len(rows)


def test_encoding_ends_the_pipeline(spark):
    rows, docs = oddities(spark)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        expected.append((key, len(ids), *digests))
    got = pipeline.encode(spark, docs, SF_DIR)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_empty_tables_stay_empty(spark):
    _, docs = oddities(spark)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF_DIR).collect() == []


def test_run_is_the_stages_one_after_another(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    got = sorted(map(tuple, pipeline.run(spark, SF_DIR).collect()), key=str)
    assert got == sorted(map(tuple, docs.collect()), key=str)
    assert 0 < len(got) < table(spark, SF_DIR, "documents").count()
