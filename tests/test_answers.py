import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curate import fixed_values as fixed
from curate.functions.text import intent
from curate.operators.answers import answer_all, calibrate
from curate.plans import medallion
from curate.plans.question_answering import attendance_questions, store_corpus
from curate.session import work_path


@pytest.fixture
def gold(sample):
    return medallion.gold_records(medallion.split(medallion.latest_records(sample))[0])


@pytest.fixture
def corpus(spark, gold):
    return store_corpus(spark, gold, work_path(spark, "vectors"))


def ask(spark, *rows):
    return spark.createDataFrame([(q, q, k) for q, k in rows], "question_id string, question string, k int")


def answers(df):
    return {r.question: r for r in df.collect()}


def test_intent(spark):
    texts = {
        "Which is the LOWEST?": "lowest", "the worst of the best": "lowest", "the most": "highest",
        "almost there": "highest", "at least one": "lowest", "how many days": "lookup",
    }
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    assert {r.q: r.i for r in df.select("q", intent("q").alias("i")).collect()} == texts
    assert df.where("q = 'almost there'").select(intent("q", whole_words=True)).first()[0] == "lookup"


def test_superlatives_over_the_whole_corpus(spark, corpus):
    low, high = "Which record has the lowest attendance rate?", "Which record has the highest attendance rate?"
    got = answers(answer_all(ask(spark, (low, None), (high, None)), corpus, threshold=0.1))
    assert got[low].answer == (
        "R-0068 has the lowest attendance rate at 0.00%. "
        "[attendance record: R-0068 — Growth @ East — 0.00% (0/2 days)]"
    )
    assert got[low].sources == ["R-0068"] and got[low].grounded
    assert got[high].answer.startswith("R-0088 has the highest attendance rate at 100.00%. ")


def test_superlative_among_the_retrieved_only(spark, corpus):
    question = "lowest attendance rate of R 0088 Export West"
    row = answers(answer_all(ask(spark, (question, 1)), corpus, threshold=0.0))[question]
    assert row.sources == ["R-0088"] and row.answer.startswith("R-0088 has the lowest attendance rate at 100.00%.")


def test_lookup_and_refusal(spark, corpus):
    known = "attendance record r 0012 growth course at the north branch"
    unknown = "zebra quagga xylophone"
    got = answers(answer_all(ask(spark, (known, 3), (unknown, 3)), corpus))
    assert got[known].answer == (
        "R-0012 — Growth at North: attendance rate 60.00%. "
        "[attendance record: R-0012 — Growth @ North — 60.00% (6/10 days)]"
    )
    refused = got[unknown]
    assert refused.answer == fixed.REFUSAL and not refused.grounded and refused.sources == []
    assert refused.top_score < 0.49


def test_threshold_is_strict(spark, corpus):
    question = "attendance record r 0012 growth course at the north branch"
    exact = answer_all(ask(spark, (question, 1)), corpus, threshold=0.0)
    from curate.operators.embed import embed
    from curate.operators.knn import knn_join

    score = knn_join(embed(ask(spark, (question, 1)), "question"), corpus, 1).first().score
    assert answers(answer_all(ask(spark, (question, 1)), corpus, threshold=score))[question].grounded
    assert not answers(answer_all(ask(spark, (question, 1)), corpus, threshold=np.nextafter(score, 2)))[question].grounded
    assert exact.first().top_score == round(score, 3)


def test_empty_corpus_refuses(spark, corpus):
    got = answers(answer_all(ask(spark, ("lowest rate?", None), ("any?", 3)), corpus.where("false")))
    assert {(r.answer, r.grounded, r.top_score) for r in got.values()} == {(fixed.REFUSAL, False, None)}


def test_unrated_documents(spark, records):
    raw = records([("k1", "Al", "30", "B", "C", "2024-01-01", "n/a", "1", "0")])
    gold = medallion.gold_records(medallion.split(medallion.latest_records(raw))[0])
    corpus = store_corpus(spark, gold, work_path(spark, "vectors"))
    got = answers(answer_all(ask(spark, ("lowest?", None), ("highest?", 3)), corpus, threshold=-1.0))
    for r in got.values():
        assert r.answer == "k1 — C at B: attendance rate not computable. [attendance record: k1 — C @ B — n/a (1/unknown days)]"


def composed_by_hand(question, k, docs, scores):
    """The answer to one question, from all documents in Python."""
    order = sorted(range(len(docs)), key=lambda j: (-scores[j], docs[j].doc_id))
    kept = [docs[j] for j in order][: k or len(docs)]
    rated = [d.metadata for d in kept if d.metadata.rate is not None]
    q = question.lower()
    if rated and any(w in q for w in fixed.LOWEST_WORDS):
        return min(rated, key=lambda m: m.rate).name
    if rated and any(w in q for w in fixed.HIGHEST_WORDS):
        return max(rated, key=lambda m: m.rate).name
    return kept[0].doc_id


def test_question_table_against_brute_force(spark, gold, corpus):
    from curate.operators.embed import embed

    questions = attendance_questions(gold)
    asked = embed(questions, "question").collect()
    docs = corpus.collect()
    matrix = np.array([d.vec for d in docs], dtype="float64")
    got = answers(answer_all(questions, corpus, threshold=0.0))
    assert len(got) == len(asked) == 3 * 4 + 3 + 4
    for row in asked:
        scores = [math.fsum(d * np.array(row.vec, dtype="float64")) for d in matrix]
        assert got[row.question].sources == [composed_by_hand(row.question, row.k, docs, scores)], row.question


def test_blocked_search_gives_the_same_answers(spark, gold, corpus):
    questions = attendance_questions(gold)
    shared = {tuple(map(str, r)) for r in answer_all(questions, corpus).collect()}
    assert {tuple(map(str, r)) for r in answer_all(questions, corpus, block_rows=2).collect()} == shared


def test_calibrate(spark):
    def bands(rows):
        return tuple(calibrate(spark.createDataFrame(rows, "top_score double, answerable boolean")).first())

    assert bands([(0.8, True), (0.6, True), (0.4, False)]) == (0.6, 0.4, False, 0.5)
    assert bands([(0.5, True), (0.642, False)]) == (0.5, 0.642, True, None)
    assert bands([(0.5, True)]) == (0.5, None, None, None)


def test_the_corpus_is_scanned_once(spark, gold, corpus):
    plan = answer_all(attendance_questions(gold), corpus)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "vec" in line and "metadata" in line]
    assert len(scans) == 1 and sum("metadata" in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_mean_of_rates_is_not_needed_for_extremes(spark, corpus):
    ends = corpus.agg(F.min("metadata.rate"), F.max("metadata.rate")).first()
    assert tuple(ends) == (0.0, 1.0)
