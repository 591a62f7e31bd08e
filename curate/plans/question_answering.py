"""From gold records to a stored vector table and a table of answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curate.fixed_values import BRANCH_QUESTIONS, COURSE_QUESTIONS, GENERAL_QUESTIONS, SIMILARITY_THRESHOLD
from curate.operators.answers import answer_all, calibrate
from curate.operators.documents import build_documents
from curate.operators.embed import Encoder, embed
from curate.sources.tables import write_replace


def vector_table(gold: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    """(doc_id, text, metadata, vec), one row per gold record."""
    return embed(build_documents(gold), "text", encoder=encoder)


def store_corpus(
    spark: SparkSession, gold: DataFrame, path: str, encoder: Encoder | None = None
) -> DataFrame:
    """Write the vector table once; questions never embed documents again."""
    write_replace(vector_table(gold, encoder), path)
    return spark.read.parquet(path)


def _ask(values: DataFrame, templates: tuple) -> DataFrame:
    """Every template about every row's ``value``."""
    entries = []
    for text, k, answerable in templates:
        before, _, after = text.partition("{}")
        entries.append(
            F.struct(
                F.concat(F.lit(before), F.col("value"), F.lit(after)).alias("question"),
                F.lit(k).cast("int").alias("k"),
                F.lit(answerable).alias("answerable"),
            )
        )
    return values.select(F.inline(F.array(*entries)))


def attendance_questions(records: DataFrame) -> DataFrame:
    """A question table about ``records``: (question_id, question, k, answerable).

    Questions on each course and branch in the data, superlatives over the
    whole corpus (NULL k) and among three hits, and questions that the records
    cannot answer. Any table with branch and course_name will do.
    """

    def distinct_values(column: str) -> DataFrame:
        return records.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()

    one_row = records.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("value"))
    asked = (
        _ask(distinct_values("course_name"), COURSE_QUESTIONS)
        .unionByName(_ask(distinct_values("branch"), BRANCH_QUESTIONS))
        .unionByName(_ask(one_row, GENERAL_QUESTIONS))
    )
    # The question text is its own identity.
    return asked.select(F.col("question").alias("question_id"), "question", "k", "answerable")


def threshold_for(
    labelled: DataFrame, corpus: DataFrame, encoder: Encoder | None = None, default: float = SIMILARITY_THRESHOLD
) -> float:
    """The refusal threshold that belongs to ``encoder`` and ``corpus``: midway
    between the scores of the ``labelled`` questions (question_id, question, k,
    answerable) that the corpus can and cannot answer.

    ``default`` where the two overlap, or one kind is missing: then no threshold
    separates them. Scores of different encoders are on different scales, so the
    result is to be kept with the vectors, not with the questions.
    """
    scored = answer_all(labelled, corpus, threshold=float("-inf"), encoder=encoder).select("question_id", "top_score")
    row = calibrate(scored.join(labelled.select("question_id", "answerable"), "question_id")).first()
    return default if row["suggested_threshold"] is None else row["suggested_threshold"]
