"""One query per operator over the given tables, with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from curate.llm import (
    align, arrow_stream, bands, bpe, chat, decontaminate, edit_counts, jaccard, licenses, lm, quality, resample, search,
)
from curate.session import work_path

QUERIES = {}
COUNT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    """crc32 of the id as text, modulo n; null for rows without an id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query
def op1_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs, docs.where(F.col("doc_id") % 100 == 0))


@query
def op2_edit_counts(spark, sf_dir):
    """Three edits per document, their places and lengths drawn by hash, their text
    taken from elsewhere in the document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    drawn = lambda i, what, n: F.pmod(F.xxhash64("doc_id", F.lit(i), F.lit(what)), n)
    size = F.length("text") + F.lit(1)
    edits = F.array(*(
        F.struct(
            drawn(i, "pos", size).alias("pos"), drawn(i, "removed", F.lit(24)).alias("removed"),
            F.substring("text", drawn(i, "from", size).cast("int"), drawn(i, "added", F.lit(24)).cast("int")).alias("added"),
        )
        for i in range(3)
    ))
    return edit_counts.edited_counts(docs.withColumn("edits", edits), COUNT_VOCABULARY, public_tokenizers.PATTERN)


@query
def op3_chat(spark, sf_dir):
    text = "</s>[INST] ok [/INST]"
    added = spark.range(1).selectExpr("inline(array((-1L, 0L, 'user', {t}), (-1L, 1L, 'assistant', {t})))".format(t=f"'{text}'"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.expand(turns.union(added)))


@query
def op4_arrow_stream(spark, sf_dir):
    out = work_path(spark, "arrow-stream")
    manifest = arrow_stream.write_shards(table(spark, sf_dir, "documents"), out, VOCABULARY)
    return arrow_stream.read_documents(spark, manifest)


def quality_model(spark, docs, sf_dir):
    """Fitted to the labelled documents that are not held out."""
    return quality.train(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)


@query
def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.scores(docs, quality_model(spark, docs, sf_dir))
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_licenses(spark, sf_dir):
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents")))


@query
def op7_decontaminate(spark, sf_dir):
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_bpe(spark, sf_dir):
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY))


@query
def op10_lm(spark, sf_dir):
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    scored = lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_jaccard(spark, sf_dir):
    return jaccard.similar(table(spark, sf_dir, "documents")).drop("text_hash", "stays")


@query
def op11_resample(spark, sf_dir):
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_bands(spark, sf_dir):
    return bands.judge(table(spark, sf_dir, "documents"))


@query
def op13_align(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)
