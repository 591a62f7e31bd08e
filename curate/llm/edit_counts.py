"""Token counts that follow edits, from a segment tree of pre-tokens per document.

A text is split into pre-tokens, which the encoder never merges across. Leaves
hold some pre-tokens each; the tree above them sums characters and tokens. An
edit finds its leaf by descending the character sums, splits again from the first
pre-token whose match could have seen the edit, goes on until a boundary falls on
an old one behind it, and updates the sums above the touched leaves. Everything
else keeps its counts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from curate.llm.flat import slices

LEAF = 64
# A match looks at most so many characters past its end.
AHEAD = 2
CONTEXT = 4
MAX_CACHED = 500_000
EDIT = "struct<pos:bigint,removed:bigint,added:string>"


class Counter:
    """Tokens per pre-token, remembered for those met before."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def count(self, pieces: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            if len(known) > MAX_CACHED:
                known.clear()
            for p in pieces:
                if p not in known:
                    known[p] = len(self.encoding.encode_ordinary(p))
            return [known[p] for p in pieces]


class CountedText:
    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.reencoded = 0
        self._build(counter.split(text))

    def _build(self, pieces: list[str]) -> None:
        self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        counts = self.counter.count(pieces)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.size + i] = sum(map(len, leaf))
            self.tokens[self.size + i] = sum(counts[i * LEAF : (i + 1) * LEAF])
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, and where the leaf starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return min(node - self.size, len(self.leaves) - 1), start

    def _update(self, leaf: int) -> None:
        node = self.size + leaf
        self.chars[node] = sum(map(len, self.leaves[leaf]))
        self.tokens[node] = sum(self.counter.count(self.leaves[leaf]))
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, pos: int, removed: int, added: str) -> None:
        """Put ``added`` in place of ``removed`` characters from ``pos`` on, both kept
        within the text."""
        pos = min(max(pos, 0), self.n_chars)
        stop = min(pos + max(removed, 0), self.n_chars)
        if stop == pos and not added:
            return
        leaf, start = self._find(min(max(pos - AHEAD, 0), max(self.n_chars - 1, 0)))
        keep = 0
        pieces = self.leaves[leaf]
        while keep < len(pieces) and start + len(pieces[keep]) + AHEAD <= pos:
            start += len(pieces[keep])
            keep += 1
        # Old pre-tokens from here on, read leaf by leaf as far as needed.
        old, last = pieces[keep:], leaf
        context = CONTEXT
        while True:
            ends, end = [], start
            for k, piece in enumerate(old):
                end += len(piece)
                ends.append(end)
            whole = last == len(self.leaves) - 1
            behind = next((k for k, e in enumerate(ends) if e >= stop), None)
            if not whole and (behind is None or len(old) <= behind + context):
                last += 1
                old = old + self.leaves[last]
                continue
            cut = len(old) if behind is None else min(len(old), behind + 1 + context)
            at_end = whole and cut == len(old)
            text = "".join(old[:cut])
            local = text[: pos - start] + added + text[stop - start :]
            shift = len(added) - (stop - pos)
            # Old boundaries behind the edit, in the new text.
            edges = {e - start + shift: k + 1 for k, e in enumerate(ends[:cut]) if e >= stop}
            if stop == start:
                edges[shift] = 0
            new, done, match = [], 0, None
            for piece in self.counter.split(local):
                if not at_end and done + len(piece) + AHEAD > len(local):
                    break
                new.append(piece)
                done += len(piece)
                if done in edges and done >= pos - start + len(added):
                    match = edges[done]
                    break
            if match is None and at_end:
                match = len(old)
            if match is not None:
                break
            context *= 2
        self.reencoded += sum(map(len, new))
        self._replace(leaf, keep, last, new, old[match:])

    def _replace(self, leaf: int, keep: int, last: int, new: list[str], rest: list[str]) -> None:
        """Leaves ``leaf`` to ``last`` hold what they held before ``keep``, ``new`` and ``rest``."""
        held = self.leaves[leaf][:keep] + new + rest
        room = (last - leaf + 1) * 4 * LEAF
        if len(held) > room:
            self._build([p for i, part in enumerate(self.leaves) if i < leaf for p in part] + held
                        + [p for part in self.leaves[last + 1 :] for p in part])
            return
        share = -(-len(held) // (last - leaf + 1)) or 1
        for k, i in enumerate(range(leaf, last + 1)):
            self.leaves[i] = held[k * share : (k + 1) * share]
            self._update(i)

    def pieces(self) -> list[str]:
        return [p for leaf in self.leaves for p in leaf]


def attach_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, text, edits`` from a table of edits ``id, seq, pos, removed, added``.

    The edits of a document are applied in order of ``seq``; a document without any
    has none, and edits of no document are left out.
    """
    per = edits.groupBy(F.col(id_col).alias("__id")).agg(F.sort_array(F.collect_list(F.struct("seq", "pos", "removed", "added"))).alias("e"))
    listed = F.transform("e", lambda x: F.struct(x["pos"].cast("long").alias("pos"), x["removed"].cast("long").alias("removed"), x["added"].alias("added")))
    return docs.select(F.col(id_col), "text").join(per, F.col(id_col) == F.col("__id"), "left").select(
        id_col, "text", F.coalesce(listed, F.array().cast(f"array<{EDIT}>")).alias("edits")
    )


def edited_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """``id, n_edits, n_tokens_before, n_tokens, counts, n_chars, reencoded_chars``.

    ``edits`` are (pos, removed, added) in characters of the text as the edits before
    left it. ``counts`` has the tokens after each edit; ``reencoded_chars`` says how
    much was split again. Null texts are empty, null lists have no edits, null edits
    do nothing, null numbers are 0, null strings empty, places beyond the text its
    end. Rows are independent; other columns are left out.
    """
    places = F.transform(
        F.coalesce(F.col(edits_col), F.array().cast(f"array<{EDIT}>")),
        lambda e: F.struct(
            F.coalesce(e["pos"], F.lit(0)).cast("long").alias("pos"), F.coalesce(e["removed"], F.lit(0)).cast("long").alias("removed"),
            F.coalesce(e["added"], F.lit("")).alias("added"),
        ),
    )
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), places.alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            for part in slices(batch, "text"):
                counter = counter or Counter(path, pattern)
                out = []
                for text, edits in zip(part.column("text").to_pylist(), part.column("edits").to_pylist()):
                    counted = CountedText(text, counter)
                    before, counts = counted.n_tokens, []
                    for e in edits:
                        counted.edit(e["pos"], e["removed"], e["added"])
                        counts.append(counted.n_tokens)
                    out.append((len(edits), before, counted.n_tokens, counts, counted.n_chars, counted.reencoded))
                columns = [list(c) for c in zip(*out)]
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], [f.name for f in out_schema]
                )

    numbers = StructType.fromDDL(
        "n_edits long, n_tokens_before long, n_tokens long, counts array<long>, n_chars long, reencoded_chars long"
    )
    out_schema = StructType([StructField("id", source.schema["id"].dataType), *numbers])
    return source.mapInArrow(run, out_schema).withColumnRenamed("id", id_col)
