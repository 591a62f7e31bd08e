"""Grounded answers to a table of questions, with a refusal path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curate import fixed_values as fixed
from curate.functions.rates import percent_text
from curate.functions.text import fill, intent
from curate.operators.documents import citation
from curate.operators.embed import Encoder, embed
from curate.operators.knn import BLOCK_ROWS, knn_and_extremes


def _fields(metadata: Column, rate_unknown: str) -> dict[str, Column]:
    values = {name: metadata[name] for name in ("name", "course_name", "branch")}
    values["rate_txt"] = F.coalesce(percent_text(metadata["rate"]), F.lit(rate_unknown))
    return values


def retrieved(hits: DataFrame) -> DataFrame:
    """Per question: best score, first document, and the rated documents with
    the lowest and highest rate (ties go to the better rank).

    Hits marked ``extreme`` are the answer to a superlative over the whole
    corpus and stand in for both. Hits bring their documents' metadata along.
    """
    among = ~F.col("extreme")
    rate = F.col("metadata.rate")
    worst = F.when(among & rate.isNotNull(), F.struct(rate, "rank"))
    best = F.when(among & rate.isNotNull(), F.struct(-rate, "rank"))
    whole = F.max(F.when(F.col("extreme"), F.col("metadata")))
    return hits.groupBy("question_id").agg(
        F.max(F.when(among, F.col("score"))).alias("score"),
        F.min_by("metadata", F.when(among, F.col("rank"))).alias("first"),
        F.coalesce(whole, F.min_by("metadata", worst)).alias("low"),
        F.coalesce(whole, F.min_by("metadata", best)).alias("high"),
    )


def compose(
    questions: DataFrame,
    found: DataFrame,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
    whole_words: bool = False,
) -> DataFrame:
    """(question_id, question, answer, grounded, top_score, sources).

    Every figure comes from document metadata. A question whose best score is
    below ``threshold``, or that found nothing, gets the refusal and no source.
    """
    wanted = intent("question", whole_words)
    lowest = (wanted == "lowest") & F.col("low").isNotNull()
    highest = (wanted == "highest") & F.col("high").isNotNull()
    target = F.when(lowest, F.col("low")).when(highest, F.col("high")).otherwise(F.col("first"))
    picked = questions.join(found, "question_id", "left").select(
        "question_id",
        "question",
        "score",
        target.alias("target"),
        F.when(lowest, "lowest").when(highest, "highest").otherwise("lookup").alias("kind"),
    )
    m = F.col("target")
    rated = _fields(m, fixed.LOOKUP_RATE_UNKNOWN)
    body = (
        F.when(F.col("kind") == "lowest", fill(fixed.LOWEST_BODY, rated))
        .when(F.col("kind") == "highest", fill(fixed.HIGHEST_BODY, rated))
        .otherwise(fill(fixed.LOOKUP_BODY, rated))
    )
    grounded = F.coalesce(F.col("score") >= threshold, F.lit(False))
    return picked.select(
        "question_id",
        "question",
        F.when(grounded, F.concat_ws(" ", body, citation(m)))
        .otherwise(fixed.REFUSAL)
        .alias("answer"),
        grounded.alias("grounded"),
        F.round("score", 3).alias("top_score"),
        F.when(grounded, F.array(m["name"]))
        .otherwise(F.array().cast("array<string>"))
        .alias("sources"),
    )


def answer_all(
    questions: DataFrame,
    corpus: DataFrame,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
    encoder: Encoder | None = None,
    whole_words: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Answer every row of ``questions`` (question_id, question, k) from
    ``corpus`` (doc_id, vec, metadata), the stored vector table.

    A NULL ``k`` asks for the whole corpus. Its lookup is still the best hit,
    but its superlative is the extreme of the rate, not a retrieval of everything:
    of the documents there the one that fits the question best.

    The corpus is scanned once, whatever is asked: each task hands on its best hits
    and, for superlatives, the best hit at its own extreme with the rate there, both
    with their metadata; ranking them per question gives those of the whole corpus.
    """
    asked = embed(questions, "question", encoder=encoder).select(
        "question_id",
        "vec",
        F.coalesce("k", F.lit(1)).cast("int").alias("k"),
        F.when(F.col("k").isNull(), intent("question", whole_words)).alias("extreme"),
    )
    rated = corpus.select("doc_id", "vec", "metadata", F.col("metadata.rate").alias("rate"))
    hits = knn_and_extremes(asked, rated, "rate", ("metadata",), block_rows)
    return compose(questions, retrieved(hits), threshold, whole_words)


def calibrate(scored: DataFrame, score: str = "top_score", answerable: str = "answerable") -> DataFrame:
    """Whether one threshold can separate answerable from unanswerable questions.

    ``suggested_threshold`` lies midway between the bands, NULL where they
    overlap. Run it again for every encoder.
    """
    bands = scored.agg(
        F.min(F.when(F.col(answerable), F.col(score))).alias("lowest_answerable"),
        F.max(F.when(~F.col(answerable), F.col(score))).alias("highest_unanswerable"),
    )
    low, high = F.col("lowest_answerable"), F.col("highest_unanswerable")
    return bands.select(
        low,
        high,
        (high >= low).alias("bands_overlap"),
        F.when(high < low, (low + high) / 2).alias("suggested_threshold"),
    )
