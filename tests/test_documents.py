import numpy as np
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from curate.operators.documents import build_documents, citation
from curate.operators.embed import WORD_PATTERN, embed
from curate.plans import medallion


def documents(raw):
    return build_documents(medallion.gold_records(medallion.split(medallion.latest_records(raw))[0]))


def test_text_of_a_document(sample):
    docs = {r.doc_id: r for r in documents(sample).collect()}
    assert docs["R-0007"].text == (
        "Attendance record R-0007: a participant aged 46 was enrolled in the 'Export' course at the "
        "West branch, starting 2024-05-20. The course was scheduled for 9 days; the participant "
        "attended 8 days and was absent 1 days, giving a record-level attendance rate of 88.89%. "
        "This record is classified in the Medium attendance band."
    )
    assert "a participant with no validated age on record was" in docs["R-0041"].text
    assert docs["R-0007"].metadata.rate == 8 / 9
    assert docs["R-0007"].metadata.asDict() == {
        "type": "attendance record", "name": "R-0007", "branch": "West", "course_name": "Export",
        "course_date": "2024-05-20", "scheduled": 9, "attended": 8, "absent": 1, "rate": 8 / 9,
        "age": 46, "attendance_band": "Medium",
    }


def test_missing_values_have_words(records):
    row = ("k", "Al", None, None, "C", "2024-01-01", "n/a", "1", None)
    doc = documents(records([row])).first()
    assert "scheduled for unknown days" in doc.text and "absent unknown days" in doc.text
    assert "rate of not computable (missing day counts)." in doc.text
    assert "at the unknown branch" in doc.text
    assert "in the Unknown attendance band." in doc.text
    assert doc.metadata.rate is None and doc.metadata.scheduled is None
    undated = documents(records([row])).sparkSession.createDataFrame(
        [("k", None, None, "B", "C", 0, 0, 0, None)],
        "fileno string, age_clean int, course_date date, branch string, course_name string, "
        "number_of_days int, days_attended int, days_absent int, attendance_band string",
    )
    text = build_documents(undated).first().text
    assert "starting an unrecorded date." in text and text.endswith("no attendance band classification.")


def test_no_name_reaches_a_document(sample):
    for r in documents(sample).select("text", F.to_json("metadata").alias("m")).collect():
        assert not any(n in r.text + r.m for n in ("Ada", "Ben", "Cem", "Dov", "Eva", "Fay", "Gus", "Hal", "Ida"))


def test_citation(sample, records):
    got = {r[0] for r in documents(sample).select(citation(F.col("metadata"))).collect()}
    assert "[attendance record: R-0012 — Growth @ North — 60.00% (6/10 days)]" in got
    row = ("k", "Al", None, "B", "C", "2024-01-01", "n/a", "1", None)
    assert documents(records([row])).select(citation(F.col("metadata"))).first()[0] == (
        "[attendance record: k — C @ B — n/a (1/unknown days)]"
    )


def test_default_vectors_have_unit_length_and_ignore_order_and_case(spark):
    texts = ["one two two", "TWO one, two!", "", None, "ärger ñandú 日本 x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    vec = {r.doc_id: np.array(r.vec) for r in embed(df).collect()}
    assert np.array_equal(vec[0], vec[1]) and len(vec[0]) == 256
    assert abs(np.linalg.norm(vec[0]) - 1) < 1e-6 and abs(np.linalg.norm(vec[4]) - 1) < 1e-6
    assert not vec[2].any() and not vec[3].any()
    assert sorted(v for v in vec[0] if v) == [np.float32(1 / 5**0.5), np.float32(2 / 5**0.5)]


def test_whole_text_counts(spark):
    long = " ".join(["a"] * 30_000 + ["last"])
    df = spark.createDataFrame([(1, long)], "doc_id int, text string")
    assert sum(1 for v in embed(df).first().vec if v) == 2


def test_other_encoder(spark):
    def lengths(texts):
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id int, text string")
    got = {r.doc_id: r.vec for r in embed(df, encoder=lengths).collect()}
    assert np.allclose(got[1], np.array([3, 1]) / 10**0.5) and not np.any(got[2])


def test_default_vectors_are_unit_counts_of_hashing_tf(spark):
    texts = ["", None, "a", "ab ab", "abc, abcd ABCDE", "Ünï ΑΣ 日本語 é ½ x_y", "x" * 999, "!!", "KK İstanbul", "a-1 B2"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0))
    words_of = df.withColumn("w", F.coalesce(found, F.array().cast("array<string>")))
    for dim in (256, 37):
        counts = HashingTF(numFeatures=dim, inputCol="w", outputCol="c").transform(words_of)
        unit = Normalizer(inputCol="c", outputCol="u").transform(counts).select("id", vector_to_array("u", "float32").alias("vec"))
        got = embed(df, dim=dim)
        assert sorted(got.select("id", "vec").collect()) == sorted(unit.collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "UDF(" not in plan  # no row-wise vector functions on the JVM
