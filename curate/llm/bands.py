"""Quality rules: word and line counts, and compression bands.

Text that says the same again and again shrinks too well, and noise hardly at
all. Whole documents and their fixed chunks are compressed, and the ratio of
compressed to raw bytes is held against limits for that length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from curate.llm.flat import _BYTE_VALUES, _SOLID, byte_spans, bytes_of, hash_spans, mix, slices

WINDOW = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
# All bytes but those that go on a code point.
_LEADS = np.ones(256, bool)
_LEADS[0x80:0xC0] = False
_NO_BREAK = np.ones(256, bool)
_NO_BREAK[0x0A] = False


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for pieces of up to ``max_bytes``; ends are allowed."""

    max_bytes: float
    low: float
    high: float


# Running text shrinks to 0.35 to 0.6 of its bytes, less the shorter it is; repeats to
# under a quarter of them, keys and encoded data hardly to 0.75.
BANDS = (
    Band(128, 0.45, 1.25),
    Band(256, 0.36, 1.00),
    Band(512, 0.33, 0.90),
    Band(1024, 0.30, 0.80),
    Band(4096, 0.26, 0.75),
    Band(float("inf"), 0.22, 0.70),
)


@dataclass(frozen=True)
class Rules:
    """``bands`` by rising length, the last without end. A document fails as
    repetitive (incompressible) if its whole ratio lies below (above) its band, or
    if pieces that do hold over ``bad_share`` of its bytes. Pieces under
    ``least_bytes`` say nothing and pass: the frame of the format outweighs them."""

    bands: tuple[Band, ...] = BANDS
    chunk_bytes: int = 4096
    bad_share: float = 0.5
    least_bytes: int = 64
    level: int = 3
    min_words: int = 10
    max_repeat_percent: int = 20


def _per_text(flags_at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted byte places lie in each text."""
    return np.diff(np.searchsorted(flags_at, offsets))


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """Words, their code points, symbols, repeated lines and repeated words of each text."""
    data, offsets = bytes_of(column)
    starts, ends = byte_spans(data, offsets, _SOLID)
    words = np.diff(np.searchsorted(starts, offsets))
    leads = np.flatnonzero(_LEADS[data] & _SOLID[data])
    return {
        "n_words": words,
        "word_chars": _per_text(leads, offsets),
        "n_symbols": _per_text(np.flatnonzero(_SYMBOLS[data]), offsets),
        "n_dup_lines": _repeated_lines(data, offsets, starts),
        "n_repeat_words": _repeated_words(hash_spans(_BYTE_VALUES, data, starts, ends), words),
    }


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier one of the text."""
    starts, ends = byte_spans(data, offsets, _NO_BREAK)
    holds = np.searchsorted(word_starts, starts) < np.searchsorted(word_starts, ends)
    starts, ends = starts[holds], ends[holds]
    text = np.searchsorted(offsets, starts, "right") - 1
    lines = mix(hash_spans(_BYTE_VALUES, data, starts, ends) + mix(text.astype(np.uint64)))
    first = np.zeros(len(lines), bool)
    first[np.unique(lines, return_index=True)[1]] = True
    return np.bincount(text[~first], minlength=len(offsets) - 1)


def _repeated_words(words: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Words within windows that stand in the text more than once."""
    edges = np.concatenate(([0], np.cumsum(per_text)))
    text = np.repeat(np.arange(len(per_text)), per_text)
    n = max(0, len(words) - WINDOW + 1)
    inside = np.flatnonzero(text[:n] == text[WINDOW - 1 :]) if n else np.empty(0, np.int64)
    window = mix(text[inside].astype(np.uint64))
    for k in range(WINDOW):
        window = mix(window * np.uint64(0x9E3779B97F4A7C15) + words[inside + k])
    _, of, times = np.unique(window, return_inverse=True, return_counts=True)
    again = inside[times[of] > 1] if len(inside) else inside
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    marked = np.concatenate(([0], np.cumsum(np.cumsum(cover)[:-1] > 0)))
    return np.diff(marked[edges])


class Compression:
    """Ratios of texts and their chunks, and what the bands say of them."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.compressor = zstandard.ZstdCompressor(level=rules.level, write_checksum=False)
        self.lengths = np.array([b.max_bytes for b in rules.bands])

    def _verdict(self, piece: bytes | memoryview) -> tuple[float | None, int]:
        """The ratio, and -1 below, 0 within, 1 above its band."""
        if not len(piece):
            return None, 0
        ratio = len(self.compressor.compress(piece)) / len(piece)
        if len(piece) < self.rules.least_bytes:
            return ratio, 0
        band = self.rules.bands[int(np.searchsorted(self.lengths, len(piece)))]
        return ratio, (ratio > band.high) - (ratio < band.low)

    def __call__(self, text: bytes) -> tuple[float | None, int, int, int, str | None]:
        """``ratio, n_chunks, low bytes, high bytes, failure`` of a whole text; the
        two in the middle are bytes in chunks below and above their band."""
        ratio, whole = self._verdict(text)
        step, low, high, chunks = self.rules.chunk_bytes, 0, 0, 0
        for at in range(0, len(text), step):
            piece = memoryview(text)[at : at + step]
            side = self._verdict(piece)[1]
            low += len(piece) * (side < 0)
            high += len(piece) * (side > 0)
            chunks += 1
        limit = self.rules.bad_share * len(text)
        failure = None
        if whole < 0 or low > limit:
            failure = "repetitive"
        elif whole > 0 or high > limit:
            failure = "incompressible"
        return ratio, chunks, low, high, failure


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (
    "id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, n_chunks long, low_bytes long, high_bytes long, base_failed boolean, failure string, kept boolean"
)


def judge(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The figures and the verdict of every row of ``docs``.

    ``n_words`` to ``n_repeat_words`` are counts over the whole text: words are runs
    without white space (space, 0x09 to 0x0D), a repeated line equals an earlier one
    and has a word, repeated words lie in a window of five words that the text has
    more than once. ``base_failed``: fewer than ``min_words`` words, or repeated
    words over ``max_repeat_percent`` of all. ``ratio`` is compressed to raw bytes of
    the whole text, ``low_bytes`` and ``high_bytes`` lie in chunks outside their band,
    ``failure`` is repetitive, incompressible or null; ``kept`` is true where
    neither rule fails.

    Null counts as empty: no words, a null ratio, not kept. Rows are independent, so
    repeated rows give repeated results; other columns are left out; an empty table
    gives no rows. Words, windows and lines are told apart by 64-bit hashes. A task
    holds a slice of about 8 MB, or one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compression = Compression(rules)
        for batch in batches:
            for part in slices(batch, "text"):
                figures = counts(part.column("text"))
                found = [compression(text) for text in part.column("text").cast(pa.binary()).to_pylist()]
                ratio, chunks, low, high, failure = zip(*found)
                words, repeated = figures["n_words"], figures["n_repeat_words"]
                failed = (words < rules.min_words) | (100 * repeated > rules.max_repeat_percent * words)
                kept = ~failed & np.array([f is None for f in failure])
                columns = [pa.array(figures[name]) for name in FIGURES]
                columns += [pa.array(ratio, pa.float64()), *(pa.array(c, pa.int64()) for c in (chunks, low, high))]
                columns += [pa.array(failed), pa.array(failure, pa.string()), pa.array(kept)]
                names = [entry.split(" ")[0] for entry in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names)

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, RESULT.format(kind=kind)).withColumnRenamed("id", id_col)
