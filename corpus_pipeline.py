"""From raw documents to token ids: junk goes, one of each group of near copies
stays, texts that hold benchmark passages go, and the rest is encoded.

Each stage takes what the one before kept, with the columns of ``documents``; the
last gives token counts and digests. Every stage starts from a table, so a lost
executor costs no more than a part of one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from curate.llm import bpe, decontaminate, jaccard, quality
from curate.llm.queries import VOCABULARY, quality_model, table
from curate.session import work_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for label 1, all columns as they are.

    The model learns from the labels of rows that are not held out; null and empty
    texts are scored as padding, repeated rows stay or go together, an empty table
    stays empty.
    """
    score = f"quality_{uuid.uuid4().hex[:8]}"
    model = quality_model(spark, docs, sf_dir)
    return quality.scores(docs, model, score_col=score).where(F.col(score) >= 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts the row with the least id, once; texts without
    words all stay. See ``jaccard.one_of_each`` for nulls and repeated rows."""
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that overlap no benchmark item. See ``decontaminate.drop_contaminated``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text, one row per row; null and
    empty texts have no tokens."""
    return bpe.digests(bpe.round_trip(docs, VOCABULARY))


STAGES = [
    ("quality classifier", keep_quality),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("byte-pair encoding", encode),
]

# The classifier and the encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = work_path(spark, f"stage-{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
