"""Importance resampling towards a target distribution over hashed word runs.

A batch's texts are joined with a sentinel between them; one pass of a regular
expression finds the words of all of them, and a binary search in the documents'
offsets tells which runs lie within one document before they are counted.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curate.llm.flat import offsets_of, slices
from curate.session import work_path

# A-Z are gone by then.
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SENTINEL = b"\x00"
# Words held at once, however long the texts are.
STEP = 1 << 16
# monotonically_increasing_id counts rows within a partition in the low bits.
PARTITION_BIT = 33


def runs(column: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(document, bucket, n)`` of all runs of n words, 1 to ``longest``, in steps.

    The documents of a run are places in ``column``; the bucket is the CRC-32 of
    the run's words, one space between them, modulo ``buckets``.
    """
    joined = SENTINEL.join(column.cast(pa.large_binary()).to_pylist()).translate(LOWER)
    first_byte = offsets_of(column)[:-1] + np.arange(len(column))
    found = WORD.finditer(joined)
    words: list[bytes] = []
    starts: list[int] = []
    old = 0
    while True:
        fresh = [(m.group(), m.start()) for m in islice(found, STEP)]
        if not fresh:
            return
        words += [w for w, _ in fresh]
        starts += [s for _, s in fresh]
        document = np.searchsorted(first_byte, np.array(starts), "right") - 1
        sums: list[int] = []
        for n in range(1, min(longest, len(words)) + 1):
            # The sum of a run goes on from that of the run one word shorter.
            sums = [zlib.crc32(w) for w in words] if n == 1 else [zlib.crc32(b" " + w, c) for w, c in zip(words[n - 1 :], sums)]
            # Runs that end in an old word were given out in the step before.
            lo = max(0, old - n + 1)
            head, tail = document[lo : len(words) - n + 1], document[lo + n - 1 :]
            inside = head == tail
            yield head[inside], np.array(sums[lo:], np.int64)[inside] % buckets, n
        old = min(longest - 1, len(words))
        words, starts = words[len(words) - old :], starts[len(starts) - old :]


def bucket_counts(texts: DataFrame, longest: int, buckets: int, text_col: str = "text") -> DataFrame:
    """``(bucket, n)``: features per bucket over all rows; buckets without any are
    left out. A task adds its rows up in one vector before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for _, bucket, _ in runs(part.column("text"), longest, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    source = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """What a feature of each bucket adds to a weight: floor(1000 ln of how much
    likelier the bucket is in ``target``, one added to every count)).

    The vector has ``buckets`` numbers, whatever the tables hold, so it may go
    through the driver and to every task.
    """
    counts = np.zeros((2, buckets), np.int64)
    both = [bucket_counts(t, longest, buckets).withColumn("of", F.lit(i)) for i, t in enumerate((docs, target))]
    for row in both[0].union(both[1]).collect():
        counts[row["of"], row["bucket"]] = row["n"]
    s, t = counts.astype("float64")
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """``docs`` (id, text) as ``(id, n_words, n_features, weight)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = part.num_rows
                n_words, n_features, total = (np.zeros(rows, np.int64) for _ in range(3))
                for document, bucket, n in runs(part.column("text"), longest, len(gain)):
                    count = np.bincount(document, minlength=rows)
                    n_features += count
                    n_words += count if n == 1 else 0
                    # Whole numbers far below 2**53, so the sums are exact.
                    total += np.bincount(document, gain[bucket], rows).astype(np.int64)
                weight = total // np.maximum(n_features, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, (n_words, n_features, weight))], ["id", "n_words", "n_features", "weight"]
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise times 1000, floored: -1000 ln(-ln u), u from the hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, longest: int = 1,
    buckets: int = 10_000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every row of ``docs``.

    The draw is without replacement, by the highest scores: weight plus noise. Of
    the N rows with at least ``min_words`` words ``percent`` of a hundred are drawn
    and have a ``rank`` from 1; ties go to the smaller id. ``target`` has a column
    ``text``.

    Null and empty texts have no feature, weight 0 and are not drawn unless
    ``min_words`` is 0; a null id counts as empty in the hash and comes first among ties.
    Repeated rows are rows of their own: equal scores, ranks one after another. An
    empty table gives no rows, an empty target leaves every count at the one that
    is added. Other columns are left out. A text of any length is read in steps of
    65,536 words.

    Ranks come from ranges, not from one window: the scored rows are written,
    dealt to ranges of (drawable, score, id), and numbered within each range; only
    the size of each range goes through the driver, one number per partition. A
    row number of the written table splits ranges even where ids and scores agree.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    gain = gains(named, target, longest, buckets)
    scored = weights(named, gain, longest).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = scored.withColumn("drawable", (F.col("n_words") >= min_words).cast("int"))
    scores_path, order_path = work_path(spark, "scores"), work_path(spark, "score-order")
    scored = scored.withColumn("row", F.monotonically_increasing_id())
    scored.write.parquet(scores_path)
    order = [F.desc("drawable"), F.desc("score"), F.asc("id"), F.asc("row")]
    ordered = spark.read.schema(scored.schema).parquet(scores_path).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("place", F.monotonically_increasing_id())
    ordered.write.parquet(order_path)

    ordered = spark.read.schema(ordered.schema).parquet(order_path).withColumn("part", F.shiftright("place", PARTITION_BIT))
    sizes = sorted(map(tuple, ordered.groupBy("part").agg(F.count(F.lit(1)), F.sum("drawable")).collect()))
    before = np.concatenate(([0], np.cumsum([n for _, n, _ in sizes]))).tolist()
    drawn = percent * sum(n for _, _, n in sizes) // 100
    bases = spark.createDataFrame([(part, before[i]) for i, (part, _, _) in enumerate(sizes)], "part long, base long")
    # One row per partition.
    placed = ordered.join(F.broadcast(bases), "part", "left")
    rank = F.col("base") + F.col("place").bitwiseAND(F.lit((1 << PARTITION_BIT) - 1)) + 1
    return placed.select(
        F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank")
    )
