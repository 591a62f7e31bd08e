"""Text to unit vectors, in batches, with an encoder of choice."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD_PATTERN = r"[\p{L}\p{M}\p{N}]+"
ASCII_WORD_PATTERN = "[a-z0-9]+"
DEFAULT_DIM = 256
# Rows and words that a task counts at once.
COUNTED_ROWS = 2_048
COUNTED_WORDS = 500_000

Encoder = Callable[[list[str]], np.ndarray]


def words(text: Column | str) -> Column:
    """Lower-case runs of letters, marks and digits. In ASCII, where bytes are as many
    as characters, these are a-z and 0-9, which Java finds in half the time."""
    found = lambda pattern: F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, found(ASCII_WORD_PATTERN)).otherwise(found(WORD_PATTERN))


def _rotated(h: np.ndarray, by: int) -> np.ndarray:
    return (h << np.uint32(by)) | (h >> np.uint32(32 - by))


def _mixed(k: np.ndarray) -> np.ndarray:
    return _rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)


def murmur3(texts: pa.Array) -> np.ndarray:
    """32-bit Murmur3 of each text's UTF-8 bytes under seed 42, as ``HashingTF`` takes it."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.empty(0, np.int32)
    start = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    # Four bytes more than there are, so that a word's last four can be read as one.
    data = np.concatenate((data[start[0] : start[-1]], np.zeros(4, np.uint8)))
    size = np.diff(start)
    order = np.argsort(-size, kind="stable")
    start, size = (start[:-1] - start[0])[order], size[order]
    h = np.full(len(size), 42, np.uint32)
    take = lambda at: np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4")[:, 0]
    for k in range(int(size[0]) // 4):
        n = np.searchsorted(-size, -4 * (k + 1), "right")
        h[:n] = _rotated(h[:n] ^ _mixed(take(start[:n] + 4 * k)), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = (size % 4).astype(np.uint32)
    tail = take(start + size - rest) & ((np.uint32(1) << (np.uint32(8) * rest)) - np.uint32(1))
    h ^= _mixed(tail) ^ size.astype(np.uint32)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    out = np.empty(len(h), np.uint32)
    out[order] = h ^ (h >> np.uint32(16))
    return out.view(np.int32)


def _counted(words: pa.ListArray, dim: int) -> np.ndarray:
    """Unit vectors of the counts of ``words`` by hash."""
    coded = words.flatten().dictionary_encode()
    place = murmur3(coded.dictionary).astype(np.int64) % dim
    row = pc.list_parent_indices(words).to_numpy().astype(np.int64)
    counts = np.bincount(row * dim + place[coded.indices.to_numpy()], minlength=len(words) * dim).reshape(-1, dim)
    length = np.sqrt((counts * counts).sum(1, keepdims=True))
    return (counts / np.where(length == 0, 1.0, length)).astype("float32")


def embed(
    df: DataFrame,
    text: str = "text",
    out: str = "vec",
    encoder: Encoder | None = None,
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    """Add ``out``, an array of float of unit length (all zero for no words).

    The default encoder hashes words into ``dim`` counts, those of ``HashingTF``, in
    one narrow pass over whole texts; words are found by Spark, counted by arrays. ``encoder`` plugs in a model instead: it maps
    a list of texts to a matrix, runs on Arrow batches, and is shipped once per
    task. Missing text gives zeros under any encoder.
    """
    if encoder is None:
        @F.arrow_udf("array<float>")
        def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in columns:
                met = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
                whole = np.flatnonzero(np.diff(met // COUNTED_WORDS)) + 1
                cuts = np.unique(np.concatenate(([0, len(column)], whole, np.arange(0, len(column), COUNTED_ROWS))))
                vectors = np.empty((len(column), dim), "float32")
                for lo, hi in zip(cuts, cuts[1:]):
                    vectors[lo:hi] = _counted(column.slice(lo, hi - lo), dim)
                starts = np.arange(len(column) + 1, dtype=np.int32) * dim
                yield pa.ListArray.from_arrays(pa.array(starts), pa.array(vectors.ravel()))
            pa.default_memory_pool().release_unused()

        return df.withColumn(out, count(F.coalesce(words(text), F.array().cast("array<string>"))))

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            matrix = np.array(encoder(batch.fillna("").tolist()), dtype="float64")
            matrix[batch.isna().to_numpy()] = 0.0
            length = np.linalg.norm(matrix, axis=1, keepdims=True)
            matrix = matrix / np.where(length == 0, 1.0, length)
            yield pd.Series(list(matrix.astype("float32")))

    return df.withColumn(out, encode(F.col(text)))
