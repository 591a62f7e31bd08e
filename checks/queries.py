"""One query per operator, over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from curate import fixed_values as fixed
from curate.functions.dates import parse_mixed_date
from curate.functions.rates import band, exact_rate, safe_rate
from curate.functions.sizes import checked_broadcast, spread_small
from curate.functions.text import intent
from curate.functions.vectors import cosine
from curate.operators import aggregate, answers, dedup, governance, headers, layout, quality, vector_index
from curate.operators.documents import build_documents, citation
from curate.operators.embed import embed
from curate.operators.knn import knn_join
from curate.operators.validate import flag_reconcile, validate_range
from curate.plans import medallion
from curate.plans.question_answering import attendance_questions, store_corpus, vector_table
from curate.session import work_path
from curate.sources import csv, tables
from curate.sources.attendance_feed import attendance_feed
from curate.streaming import ingest

RUN_ID = "run-1"
RUN_TS = datetime(2024, 9, 1, 12, 0, 0)
DATASET = "silver.training"
# Rows of a file of ``compact_packed`` before it is packed.
BULK_ROWS = 4_000_000

QUERIES = {}


def query(fn):
    """Register a query under its name, less the underscore of names in use."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread_small(spark.read.parquet(f"{sf}/{name}.parquet"))


def typed(spark, sf):
    return medallion.typed(attendance_feed(spark, sf))


def silver(spark, sf):
    return medallion.split(medallion.latest_records(attendance_feed(spark, sf)))[0]


def gold(spark, sf):
    return medallion.gold_records(silver(spark, sf))


def staged(spark, sf):
    return medallion.counted_records(attendance_feed(spark, sf))


def report(spark, sf):
    return quality.dq_report(staged(spark, sf), RUN_ID, RUN_TS, DATASET)


def two_runs(spark, sf):
    """The reports of a run a month ago and of this one, from one staged table."""
    path = work_path(spark, "staged")
    tables.write_replace(staged(spark, sf), path)
    rows = spark.read.parquet(path)
    earlier = quality.dq_report(rows, "run-0", datetime(2024, 8, 1, 12, 0, 0), DATASET)
    return earlier, quality.dq_report(rows, RUN_ID, RUN_TS, DATASET)


def ts_text(df: DataFrame) -> DataFrame:
    return df.withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss"))


def in_order(df: DataFrame) -> DataFrame:
    """Add the place of each row in the order ``df`` comes in. For reports of a few
    lines and groups: they are numbered in one task."""
    met = df.withColumn("_met", F.monotonically_increasing_id())
    return met.withColumn("place", F.row_number().over(Window.orderBy("_met"))).drop("_met")


def flat_metadata(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != "metadata"]
    return df.select(*others, "metadata.*")


def csv_copy(spark, sf, name="feed"):
    path = work_path(spark, name)
    attendance_feed(spark, sf).write.option("header", True).csv(path)
    return path


# --- sources and sinks ---------------------------------------------------------


@query
def src_csv(spark, sf):
    return headers.clean_headers(csv.read_bronze(spark, csv_copy(spark, sf)))


def _torn(feed: DataFrame) -> DataFrame:
    """The lines of the feed as text, some of them too long, too short or with an open
    quote. The one column has the header as its name."""
    columns = [F.col(f"`{c}`") for c in fixed.ATTENDANCE_HEADERS]
    number = F.substring(columns[0], 5, 20).cast("bigint")
    line = (
        F.when(number % 41 == 0, F.concat_ws(",", *columns, F.lit("tenth")))
        .when(number % 43 == 1, F.concat_ws(",", *columns[:4]))
        .when(number % 47 == 2, F.concat_ws(",", columns[0], F.concat(F.lit('"'), columns[1]), *columns[2:]))
        .otherwise(F.concat_ws(",", *columns))
    )
    return feed.select(line.alias(",".join(fixed.ATTENDANCE_HEADERS)))


def _write_lines(lines: DataFrame, path: str) -> None:
    """Text files that begin with the column's name, no value quoted."""
    writer = lines.write.mode("append").option("header", True).option("quote", "").option("sep", "\x01")
    writer.csv(path)


def _torn_layers(spark, sf):
    path = work_path(spark, "torn")
    _write_lines(_torn(attendance_feed(spark, sf)), path)
    return medallion.build_layers(spark, csv.read_lines(spark, path), work_path(spark, "layers"), RUN_ID, RUN_TS)


@query
def rejects_malformed(spark, sf):
    """Rejects of a feed with long, short and torn lines."""
    return spark.read.parquet(_torn_layers(spark, sf).rejects)


@query
def dq_malformed(spark, sf):
    log = tables.read_log(spark, _torn_layers(spark, sf).dq_log)
    return ts_text(log.drop(tables.LOG_DATE, "dataset"))


@query
def src_view(spark, sf):
    name = tables.as_view(headers.clean_headers(attendance_feed(spark, sf)), "bronze_feed")
    return spark.sql(f"SELECT fileno, branch, course_date_raw FROM {name}")


@query
def src_table(spark, sf):
    path = work_path(spark, "silver")
    tables.write_replace(silver(spark, sf), path)
    return tables.read_table(spark, path)


@query
def sink_replace(spark, sf):
    path = work_path(spark, "replaced")
    tables.write_replace(headers.clean_headers(attendance_feed(spark, sf)), path)
    tables.write_replace(silver(spark, sf), path)
    return tables.read_table(spark, path)


@query
def sink_append(spark, sf):
    """The earlier run's lines lack a column that the later run brings."""
    path = work_path(spark, "log")
    earlier, latest = two_runs(spark, sf)
    tables.append_log(earlier.drop("pass_rate"), path)
    tables.append_log(latest, path)
    return ts_text(tables.read_log(spark, path).drop(tables.LOG_DATE))


# --- projection, renaming, filters -----------------------------------------------


@query
def clean_headers(spark, sf):
    return headers.clean_headers(attendance_feed(spark, sf))


@query
def header_tags(spark, sf):
    return headers.header_tags(attendance_feed(spark, sf))


@query
def safe_cast(spark, sf):
    return typed(spark, sf).select("fileno", *medallion.DAY_COLUMNS)


@query
def star_except(spark, sf):
    return silver(spark, sf).drop("applicant")


@query
def split_quarantine(spark, sf):
    good, bad = medallion.split(medallion.latest_records(attendance_feed(spark, sf)))
    return good.select("fileno", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        bad.select("fileno", "reject_reason")
    )


@query
def rejects(spark, sf):
    return medallion.split(medallion.latest_records(attendance_feed(spark, sf)))[1]


@query
def pred_range(spark, sf):
    aged = validate_range(
        typed(spark, sf), "age_raw", fixed.AGE_MIN, fixed.AGE_MAX, "age_clean", "is_age_valid"
    )
    return aged.where("is_age_valid").select("fileno", "age_raw")


@query
def pred_null(spark, sf):
    return typed(spark, sf).select(
        "fileno",
        F.col("number_of_days").isNull().alias("days_missing"),
        F.col("days_attended").isNotNull().alias("attended_present"),
    )


@query
def pred_regex(spark, sf):
    serial = F.col("course_date_raw").rlike(fixed.SERIAL_DAY_PATTERN)
    return typed(spark, sf).where(serial).select("fileno", "course_date_raw")


# --- cleansing -------------------------------------------------------------------


@query
def parse_dates(spark, sf):
    return typed(spark, sf).select(
        "fileno", "course_date_raw", parse_mixed_date("course_date_raw").alias("course_date")
    )


@query
def validate_age(spark, sf):
    aged = validate_range(
        typed(spark, sf), "age_raw", fixed.AGE_MIN, fixed.AGE_MAX, "age_clean", "is_age_valid"
    )
    return aged.select("fileno", "age_raw", "age_clean", "is_age_valid")


@query
def flag_mismatch(spark, sf):
    parts = ("days_attended", "days_absent")
    marked = flag_reconcile(typed(spark, sf), parts, "number_of_days", "dq_days_mismatch")
    return marked.select("fileno", *medallion.DAY_COLUMNS, "dq_days_mismatch")


@query
def dedup_exact(spark, sf):
    return dedup.dedup_exact(typed(spark, sf))


@query
def dedup_latest(spark, sf):
    records = medallion.dated(typed(spark, sf))
    return dedup.dedup_latest(records, "fileno", "course_date", "applicant")


@query
def fold_versions(spark, sf):
    return staged(spark, sf)


@query
def silver_records(spark, sf):
    return silver(spark, sf)


# --- features and aggregates --------------------------------------------------------


@query
def rate(spark, sf):
    return silver(spark, sf).select(
        "fileno", safe_rate("days_attended", "number_of_days").alias("attendance_rate")
    )


@query
def band_(spark, sf):
    label = band(exact_rate("days_attended", "number_of_days"))
    return silver(spark, sf).select("fileno", label.alias("attendance_band"))


@query
def gold_records(spark, sf):
    return gold(spark, sf)


@query
def gold_by_branch(spark, sf):
    return aggregate.weighted_rate(silver(spark, sf), "branch")


@query
def gold_by_course(spark, sf):
    return aggregate.weighted_rate(silver(spark, sf), "course_name")


@query
def gold_by_branch_strict(spark, sf):
    return aggregate.weighted_rate(silver(spark, sf), "branch", exclude=F.col("dq_days_mismatch"))


@query
def q1_weighted(spark, sf):
    return in_order(aggregate.rank_groups(aggregate.weighted_rate(silver(spark, sf), "branch"), "branch"))


@query
def q1_simple_mean(spark, sf):
    return in_order(aggregate.simple_rate(gold(spark, sf), "branch"))


@query
def row_counts(spark, sf):
    return quality.row_counts(staged(spark, sf), F.col("course_date").isNotNull())


# --- data quality ---------------------------------------------------------------------


@query
def rule_catalogue(spark, sf):
    lines = quality.evaluate(medallion.latest_records(attendance_feed(spark, sf)))
    return lines.select("rule_name", "severity", "rule_note", (F.col("rows_evaluated") > 0).alias("used"))


@query
def dq_eval(spark, sf):
    lines = quality.evaluate(medallion.latest_records(attendance_feed(spark, sf)))
    return lines.select("rule_name", "rows_evaluated", "rows_passed", "rows_failed")


@query
def cond_agg(spark, sf):
    records = medallion.latest_records(attendance_feed(spark, sf))
    return records.agg(
        F.count_if("is_age_valid").alias("valid_ages"),
        F.count_if(~F.col("is_age_valid")).alias("other_ages"),
        F.count_if("dq_days_mismatch").alias("mismatches"),
    )


@query
def dq_clean(spark, sf):
    kept = quality.clean_rows(medallion.latest_records(attendance_feed(spark, sf)))
    return kept.select("fileno", "course_date", "age_clean")


@query
def dq_dedup_exact(spark, sf):
    return _rule_line(spark, sf, fixed.EXACT_RULE[0])


@query
def dq_dedup_key(spark, sf):
    return _rule_line(spark, sf, fixed.KEY_RULE[0])


def _rule_line(spark, sf, rule):
    line = report(spark, sf).where(F.col("rule_name") == rule)
    return line.select("rule_name", "rows_in", "rows_evaluated", "rows_passed", "rows_failed")


@query
def dq_report(spark, sf):
    return ts_text(report(spark, sf))


@query
def sort_report(spark, sf):
    return in_order(ts_text(quality.sort_report(report(spark, sf))))


@query
def pass_rate(spark, sf):
    return report(spark, sf).select("rule_name", "pass_rate")


@query
def dq_log(spark, sf):
    path = work_path(spark, "dq-log")
    for lines in two_runs(spark, sf):
        tables.append_log(lines, path)
    return ts_text(tables.read_log(spark, path).drop(tables.LOG_DATE))


@query
def dq_alerts(spark, sf):
    path = work_path(spark, "dq-log")
    for lines in two_runs(spark, sf):
        tables.append_log(lines, path)
    log = tables.read_log(spark, path)
    return in_order(ts_text(quality.alerts(log, now=datetime(2024, 9, 1, 18, 0, 0))))


def _expected(spark, sf):
    records = medallion.latest_records(attendance_feed(spark, sf))
    return quality.store_expectations(records, quality.ATTENDANCE_EXPECTATIONS, work_path(spark, "expected"))


@query
def expectations(spark, sf):
    return _expected(spark, sf)[1]


@query
def expectations_kept(spark, sf):
    return _expected(spark, sf)[0].select("fileno", "course_date", "is_age_valid")


# --- documents, vectors, answers ------------------------------------------------------------


@query
def build_docs(spark, sf):
    return flat_metadata(build_documents(gold(spark, sf)))


@query
def pii_exclude(spark, sf):
    """Documents that hold the name of their own applicant: none may."""
    docs = build_documents(gold(spark, sf)).select("doc_id", "text", F.to_json("metadata").alias("meta"))
    names = silver(spark, sf).select(F.col("fileno").alias("doc_id"), "applicant")
    joined = docs.join(names, "doc_id")
    leaked = F.col("text").contains(F.col("applicant")) | F.col("meta").contains(F.col("applicant"))
    return joined.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(leaked).alias("documents_with_name")
    )


@query
def cite(spark, sf):
    docs = build_documents(gold(spark, sf))
    return docs.select("doc_id", citation(F.col("metadata")).alias("citation"))


def _vector_text(vec: str):
    return F.array_join(F.transform(vec, lambda x: F.floor(x.cast("double") * 10000 + 0.5).cast("string")), ",")


@query
def embed_(spark, sf):
    vectors = embed(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return vectors.select("doc_id", _vector_text("vec").alias("vec_text"))


@query
def embed_gold(spark, sf):
    return vector_table(gold(spark, sf)).select("doc_id", _vector_text("vec").alias("vec_text"))


def _anchors(vectors: DataFrame) -> DataFrame:
    """The vector with the lowest id of each label."""
    return vectors.groupBy("label").agg(
        F.min("vec_id").alias("anchor_id"), F.min_by("embedding", "vec_id").alias("anchor")
    )


@query
def cosine_(spark, sf):
    vectors = table(spark, sf, "embeddings")
    pairs = vectors.join(checked_broadcast(_anchors(vectors)), "label")
    return pairs.select(
        "vec_id", "anchor_id", F.round(cosine("embedding", "anchor"), 4).alias("score")
    )


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 4))


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"), "label"
    )


@query
def topk(spark, sf):
    """Best three documents for the anchor of each label."""
    asked = _anchors(table(spark, sf, "embeddings")).select(
        F.col("anchor_id").alias("question_id"), F.col("anchor").alias("vec")
    )
    return _rounded(knn_join(asked, _vectors(spark, sf), k=3))


@query
def topk_blocks(spark, sf):
    """Best three documents for every vector: many files of questions and many
    chunks of documents."""
    docs = _vectors(spark, sf)
    asked = docs.withColumnRenamed("doc_id", "question_id")
    return _rounded(knn_join(asked, docs, k=3, block_rows=128))


def _indexed(spark, sf):
    docs = _vectors(spark, sf)
    index = vector_index.build_index(docs, work_path(spark, "index"))
    return vector_index.search_index(docs.withColumnRenamed("doc_id", "question_id"), index, k=3)


@query
def topk_ann(spark, sf):
    """Best three documents for every vector from an index, in its exact mode."""
    return _rounded(_indexed(spark, sf).hits)


@query
def retrieval_groups(spark, sf):
    """Every label's anchor asks for three readers at once, who may see the labels
    below 3, the even ones, and all."""
    docs = _vectors(spark, sf).withColumn("label", F.col("label").cast("string"))
    seen = (("few", ["0", "1", "2"]), ("even", ["0", "2", "4", "6", "8"]), ("all", None))
    readers = F.array(*(F.struct(F.lit(r).alias("reader"), F.lit(g).cast("array<string>").alias("groups")) for r, g in seen))
    asked = _anchors(table(spark, sf, "embeddings")).select("anchor_id", "anchor", F.inline(readers))
    questions = asked.select(
        F.concat_ws(":", "reader", F.col("anchor_id").cast("string")).alias("question_id"), F.col("anchor").alias("vec"), "groups"
    )
    return _rounded(knn_join(questions, docs, k=3, group="label"))


@query
def retrieval_acl(spark, sf):
    """Each label's anchor may only retrieve documents its readers may see:
    labels are granted to the regions with the same number."""
    granted = table(spark, sf, "region").select(F.col("r_regionkey").alias("label"))
    docs = _vectors(spark, sf).join(granted, "label", "left_semi")
    asked = _anchors(table(spark, sf, "embeddings")).select(
        F.col("anchor_id").alias("question_id"), F.col("anchor").alias("vec")
    )
    return _rounded(knn_join(asked, docs, k=3))


def _corpus(spark, sf):
    """The questions and the stored vector table they are about."""
    corpus = store_corpus(spark, gold(spark, sf), work_path(spark, "vectors"))
    asked = work_path(spark, "questions")
    tables.write_replace(attendance_questions(corpus.select("metadata.*")), asked)
    return spark.read.parquet(asked), corpus


def _answered(spark, sf, threshold=fixed.SIMILARITY_THRESHOLD):
    questions, corpus = _corpus(spark, sf)
    answered = answers.answer_all(questions, corpus, threshold)
    return answered.join(questions.select("question_id", "answerable"), "question_id")


@query
def intent_(spark, sf):
    asked = attendance_questions(gold(spark, sf))
    return asked.select("question", intent("question").alias("intent"))


@query
def qa_batch(spark, sf):
    return _answered(spark, sf).select(
        "question", "answer", "grounded", "top_score", F.array_join("sources", ",").alias("sources")
    )


@query
def refuse(spark, sf):
    refused = _answered(spark, sf).where(~F.col("grounded"))
    return refused.select("question", "answer", "top_score", F.size("sources").alias("n_sources"))


@query
def compose_lookup(spark, sf):
    return _of_kind(spark, sf, "lookup")


@query
def compose_min(spark, sf):
    return _of_kind(spark, sf, "lowest")


@query
def compose_max(spark, sf):
    return _of_kind(spark, sf, "highest")


def _of_kind(spark, sf, kind):
    """Answers of one kind with nothing refused."""
    answered = _answered(spark, sf, threshold=0.0).where(intent("question") == kind)
    return answered.select("question", "answer", F.array_join("sources", ",").alias("sources"))


@query
def answer_row(spark, sf):
    return _answered(spark, sf).select(
        "question", "grounded", "top_score", F.size("sources").alias("n_sources")
    )


@query
def superlative_full(spark, sf):
    questions, corpus = _corpus(spark, sf)
    whole = questions.where(F.col("k").isNull())
    return answers.answer_all(whole, corpus, threshold=0.0).select("question", "answer")


@query
def calibrate(spark, sf):
    return answers.calibrate(_answered(spark, sf))


# --- governance and layout ---------------------------------------------------------------------


@query
def mask_pii(spark, sf):
    return governance.mask_columns(silver(spark, sf), reader=False)


@query
def mask_view(spark, sf):
    """What a user whom nobody listed as a reader sees of the stored table."""
    path, readers = work_path(spark, "silver"), work_path(spark, "readers")
    tables.write_replace(silver(spark, sf), path)
    spark.createDataFrame([], "reader string").write.parquet(readers)
    governance.masked_view(spark, "masked_training", path, f"parquet.`{readers}`")
    return spark.table("masked_training")


@query
def mask_by_row(spark, sf):
    """Names stay readable for rows of one's own branch."""
    return governance.mask_columns(silver(spark, sf), reader=F.col("branch") == "NATION_2")


@query
def tag_columns(spark, sf):
    """Values under each classification after tagging a further column."""
    tagged = governance.tag_column(silver(spark, sf), "age_raw", classification="PII")
    names = governance.tagged_columns(tagged, ("PII", "CONFIDENTIAL"))
    counts = tagged.agg(*[F.count(F.col(n)).alias(n) for n in names])
    tags = governance.column_tags(tagged)
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        F.lit(tags[n]["classification"]).alias("tag"),
                        F.col(n).alias("filled_rows"),
                    )
                    for n in names
                ]
            )
        )
    )


@query
def layer_ns(spark, sf):
    out = medallion.build_layers(
        spark, attendance_feed(spark, sf), work_path(spark, "layers"), RUN_ID, RUN_TS
    )
    sizes = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        for name, path in (
            ("silver.training", out.silver),
            ("silver.training_rejects", out.rejects),
            ("gold.training_records", out.records),
            ("gold.attendance_by_branch", out.by_branch),
            ("gold.attendance_by_course", out.by_course),
            ("governance.dq_run_log", out.dq_log),
        )
    ]
    result = sizes[0]
    for other in sizes[1:]:
        result = result.unionByName(other)
    return result


@query
def cluster_write(spark, sf):
    path = work_path(spark, "clustered")
    layout.write_clustered(silver(spark, sf), path, ("branch", "course_date"))
    return spark.read.parquet(path)


@query
def compact(spark, sf):
    small, whole = work_path(spark, "small"), work_path(spark, "whole")
    table(spark, sf, "lineitem").repartition(64).write.parquet(small)
    layout.compact(spark, small, whole)
    return spark.read.parquet(whole)


@query
def compact_packed(spark, sf):
    """Folders of files of fair size, one where rows are few, and many small ones,
    packed where they lie."""
    path = work_path(spark, "packed")
    rows = table(spark, sf, "lineitem")
    bulk = F.col("l_orderkey") % 4 > 0
    # No file, and no task, has more than some millions of rows.
    parts = 1 + rows.count() // BULK_ROWS
    part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(parts))
    rows.where(bulk).repartition(parts, "l_returnflag", part).write.partitionBy("l_returnflag").parquet(path)
    rows.where(~bulk).repartition(24).write.mode("append").partitionBy("l_returnflag").parquet(path)
    layout.pack(spark, path, keys=("l_shipdate",))
    return spark.read.schema(rows.schema).parquet(path)


# --- streaming ------------------------------------------------------------------------------------


def _drops(spark, sf):
    """A folder that receives two files' worth of records, one after the other:
    the originals, then the repeats and conflicting versions."""
    folder = work_path(spark, "drops")
    feed = attendance_feed(spark, sf, with_version=True)
    parts = [feed.where(F.col("version") == 0), feed.where(F.col("version") > 0)]

    def drop(i):
        parts[i].drop("version").write.mode("append").option("header", True).csv(folder)

    return folder, drop


def _streamed(spark, sf, start):
    """Run ``start(stream)`` after each drop, to the end."""
    folder, drop = _drops(spark, sf)
    for i in range(2):
        drop(i)
        query = start(csv.stream_bronze(spark, folder))
        query.awaitTermination()


@query
def stream_bronze(spark, sf):
    out, checkpoint = work_path(spark, "bronze"), work_path(spark, "offsets")
    _streamed(spark, sf, lambda raw: ingest.ingest_bronze(raw, out, checkpoint))
    return spark.read.parquet(out)


def _stream_silver(spark, sf, merge=False):
    versions, log = work_path(spark, "versions"), work_path(spark, "dq-stream")
    checkpoint, merged = work_path(spark, "offsets"), work_path(spark, "merged") if merge else None
    _streamed(
        spark, sf, lambda raw: ingest.ingest_silver(raw, versions, log, checkpoint, "batch", RUN_TS, table=merged)
    )
    return versions, log, merged


@query
def stream_silver(spark, sf):
    versions, _, _ = _stream_silver(spark, sf)
    return medallion.split(ingest.current_records(spark, versions))[0]


@query
def stream_merged(spark, sf):
    """The same from the table that each batch was merged into."""
    _, _, merged = _stream_silver(spark, sf, merge=True)
    return medallion.split(ingest.merged_records(spark, merged))[0]


@query
def stream_dq(spark, sf):
    _, log, _ = _stream_silver(spark, sf)
    return tables.read_log(spark, log).select(
        "run_id", "rule_name", "rows_in", "rows_evaluated", "rows_passed", "rows_failed", "pass_rate"
    )


@query
def stream_malformed(spark, sf):
    """What two drops of torn lines leave in the rejects, and the count in each report."""
    folder, versions, log, rejects = (work_path(spark, n) for n in ("drops", "versions", "dq-stream", "rejects"))
    checkpoint = work_path(spark, "offsets")
    feed = attendance_feed(spark, sf, with_version=True)
    for part in (F.col("version") == 0, F.col("version") > 0):
        _write_lines(_torn(feed.where(part)), folder)
        lines = csv.stream_lines(spark, folder)
        ingest.ingest_silver(lines, versions, log, checkpoint, "batch", RUN_TS, rejects=rejects).awaitTermination()
    told = tables.read_log(spark, log).where(F.col("rule_name") == fixed.MALFORMED_RULE[0])
    kept = spark.read.parquet(rejects).withColumn("run_id", F.concat(F.lit("batch-"), F.col("batch_id").cast("string")))
    return kept.drop("batch_id").join(F.broadcast(told.select("run_id", "rows_in", "rows_failed")), "run_id")
