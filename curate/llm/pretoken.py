"""Split texts into the words of a BPE vocabulary with word ends, and gather the
ids of all words of many texts at once.

The rules are those the vocabulary file states: NFC, white space ignored, lower
case, then contractions, runs of letters, single numerals, runs of other marks;
each word as its UTF-8 bytes. Special tokens are found in the raw text first.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from curate.llm.flat import hash_spans, ranges

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 4
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
# Characters with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
MAX_CACHED_WORDS = 1_000_000

_tables: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _tables:
        names = (unicodedata.category(chr(c)) for c in range(sys.maxunicode + 1))
        of = {"L": LETTER, "N": NUMBER}
        kinds = np.fromiter((UNKNOWN if n == "Cn" else of.get(n[0], OTHER) for n in names), np.int8)
        kinds[WHITE_SPACE] = SPACE
        values = np.random.default_rng(7).integers(1, 2**63, sys.maxunicode + 1, dtype=np.uint64)
        _tables[:] = [kinds, values, kinds == UNKNOWN]
    return _tables[0]


def normalise(text: str) -> str:
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Each character by itself: no word-final form of sigma.
        text = text.replace("Σ", "σ")
    return text.lower()


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)


def _by_library(library: Tokenizer, raw: list[str], texts: list[str], lacking: np.ndarray) -> list[str]:
    """``texts`` as ``library`` normalises them where they have characters that
    Python's Unicode tables lack; those are classed as it does."""
    marks = re.compile("[" + "".join(re.escape(chr(c)) for c in lacking) + "]")
    texts = [library.normalizer.normalize_str(r) if marks.search(r) else t for r, t in zip(raw, texts)]
    codes = _code_points(texts)
    for c in np.unique(codes[_classes()[codes] == UNKNOWN]):
        words = len(library.pre_tokenizer.pre_tokenize_str("a" + 2 * chr(c)))
        _tables[0][c] = {1: LETTER, 2: OTHER, 3: NUMBER}[words]
    return texts


def split_words(texts: list[str], library: Tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the normalised texts in a row, where words start and end,
    and how many words each text has. ``library`` is asked only about characters
    that are newer than Python's Unicode tables."""
    raw, texts = texts, [normalise(t) for t in texts]
    codes = _code_points(texts)
    _classes()
    lacking = codes[_tables[2][codes]]
    if len(lacking):
        texts = _by_library(library, raw, texts, np.unique(lacking))
        codes = _code_points(texts)
    edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
    kinds = np.full(len(codes) + 1, SPACE, np.int8)
    kinds[1:] = _classes()[codes]
    here, before = kinds[1:], kinds[:-1]
    start = (here != SPACE) & ((here != before) | (here == NUMBER))
    marks = np.flatnonzero(start & (codes == ord("'")))
    marks = marks[here[np.minimum(marks + 1, len(codes) - 1)] == LETTER]
    free = np.ones(len(marks), bool)
    for tail in CONTRACTIONS:
        hit = free.copy()
        for k, letter in enumerate(tail, 1):
            hit &= codes[np.minimum(marks + k, len(codes) - 1)] == ord(letter)
        free &= ~hit
        at = marks[hit]
        start[at + 1] = False
        after = at + 1 + len(tail)
        start[after[here[after] == LETTER]] = True
    starts = np.flatnonzero(start)
    # A word ends where the next one starts or white space does.
    stop = np.append(start | (here == SPACE), True)
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return codes, starts, ends, np.diff(np.searchsorted(starts, edges))


_DIRECT = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    letters = {b: chr(b) for b in _DIRECT}
    spare = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + k) for k, b in enumerate(spare)})
    return [letters[b] for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]
    merges: list[tuple[str, str]]
    word_end: str
    special: dict[str, int]
    library: Tokenizer

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        return cls(
            model["vocab"],
            [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]],
            model["end_of_word_suffix"] or "",
            {t["content"]: t["id"] for t in spec["added_tokens"]},
            Tokenizer.from_file(path),
        )


def token_names(path: str) -> dict[int, str]:
    """The token of each id, special ones too; the merges are not kept."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    names = {i: t for t, i in spec["model"]["vocab"].items()}
    names.update((t["id"], t["content"]) for t in spec["added_tokens"])
    return names


class TextEncoder:
    """Ids of whole texts. ``encode_words`` gives the ids of distinct words, in a
    row, and how many each has; words met before come from a bounded cache."""

    def __init__(self, vocabulary: Vocabulary, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.special, self.library = vocabulary.special, vocabulary.library
        self.pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.encode_words = encode_words
        self._clear()

    def _clear(self) -> None:
        self.known = pd.Index([], dtype="uint64")
        self.first = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def _places(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each word stands in the cache, after adding those it lacks."""
        which, distinct = pd.factorize(hashes)
        if len(self.known) + len(distinct) > MAX_CACHED_WORDS:
            self._clear()
        place = self.known.get_indexer(distinct)
        lacking = np.flatnonzero(place < 0)
        if len(lacking):
            example = np.empty(len(distinct), np.int64)
            example[which[::-1]] = np.arange(len(hashes))[::-1]
            words = [
                codes[s:e].tobytes().decode("utf-32-le", "surrogatepass")
                for s, e in zip(starts[example[lacking]], ends[example[lacking]])
            ]
            ids, counts = self.encode_words(words)
            place[lacking] = len(self.known) + np.arange(len(lacking))
            self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(counts) - counts))
            self.count = np.concatenate((self.count, counts))
            self.flat = np.concatenate((self.flat, ids))
            self.known = self.known.append(pd.Index(distinct[lacking]))
        return place[which]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        pieces, owner, fixed = texts, None, {}
        if self.pattern and any(name in t for name in self.special for t in texts):
            pieces, owner = [], []
            for i, text in enumerate(texts):
                for piece in self.pattern.split(text):
                    if piece in self.special:
                        fixed[len(pieces)] = self.special[piece]
                        piece = ""
                    pieces.append(piece)
                    owner.append(i)
        codes, starts, ends, words = split_words(pieces, self.library)
        place = self._places(hash_spans(_tables[1], codes, starts, ends), codes, starts, ends)
        sizes = self.count[place]
        ids = self.flat[ranges(self.first[place], sizes)]
        edges = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(words)))]
        if owner is None:
            return ids, np.diff(edges)
        at = sorted(fixed)
        ids = np.insert(ids, edges[at], [fixed[i] for i in at])
        counts = np.diff(edges)
        counts[at] = 1
        return ids, np.bincount(owner, counts, len(texts)).astype(np.int64)
