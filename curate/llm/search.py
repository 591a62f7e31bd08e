"""Exact best-k search by BM25 with block-max pruning, shard by shard.

A shard is an inverted index over a bounded run of documents, dealt to groups that
share frequent words, such as those of one language. A group has its postings by term
and the most that each term adds to one of its documents. For a query these maxima add
up to a bound per group; the group of the highest bound is opened first, then only those
whose bound can still beat the k-th score found. An opened group is added up for many
queries at once: postings as they are, terms that many of its documents have as a product
of whole numbers. Then the best of each ``BLOCK`` documents rules out most blocks, and only
the others are looked into. Document frequencies and lengths are those of the whole corpus,
so the shards' lists merge to the exact result.

Queries lie in the shared folder in blocks of bounded size; every shard reads each
block once. Contributions are rounded to 2**-30 and added as whole numbers, so
scores do not depend on the order of addition and equal texts tie exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window, functions as F

from curate.llm.flat import ranges, slices, word_hashes
from curate.llm.graph import stored
from curate.session import work_path

K1 = 1.2
B = 0.75
UNIT = 2.0**30
BLOCK = 64
SHARD_BYTES = 64 << 20
QUERIES_AT_ONCE = 2048
# A shard ends at so many documents too. It has at most GROUPS groups, one for every
# GROUP_DOCS documents at most, fitted to SAMPLE of them in ROUNDS rounds; a centre that
# less than one of SMALL is nearest to makes no group.
SHARD_DOCS = 16384
GROUPS = 16
GROUP_DOCS = 256
SAMPLE = 2048
ROUNDS = 4
SMALL = 32
# Terms in more than one of RARE documents of a group, at most COMMON of them, may be
# added up as a product, for queries whose postings of them cost more: one posting costs
# as much as WORTH multiplications. Queries and postings that are added up at a time.
RARE = 16
COMMON = 512
WORTH = 256
TOGETHER = 128
POSTINGS = 65_536


def _pairs(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) of a slice with the term's count, and the texts' lengths."""
    words, lengths = word_hashes(part.column("text"))
    text = np.repeat(np.arange(len(lengths)), lengths)
    # By word, then by text, which keeps the words of a text in order; 16-bit keys sort fastest.
    order = np.argsort(words)
    order = order[np.argsort(text[order].astype(np.uint16 if len(lengths) <= 1 << 16 else np.int64), kind="stable")]
    words, text = words[order], text[order]
    first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (text[1:] != text[:-1]))[: len(words)])
    return text[first], words[first], np.diff(np.append(first, len(words))), lengths


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents per term; the row without a term has documents and words."""
    terms, counts, docs, words, held = [], [], 0, 0, 0

    def rows() -> pa.RecordBatch:
        distinct, at = np.unique(np.concatenate(terms), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        names = ["term", "n", "words"]
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(total), pa.array(np.zeros(len(total), np.int64))], names)

    for batch in batches:
        for part in slices(batch, "text"):
            _, word, _, lengths = _pairs(part)
            distinct, n = np.unique(word, return_counts=True)
            terms.append(distinct)
            counts.append(n)
            docs, words, held = docs + len(lengths), words + int(lengths.sum()), held + len(distinct)
            if held > 2_000_000:
                yield rows()
                terms, counts, held = [], [], 0
    if held:
        yield rows()
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs], pa.int64()), pa.array([words], pa.int64())], ["term", "n", "words"])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            text, word, _, _ = _pairs(part)
            yield pa.RecordBatch.from_arrays([part.column("qid").take(pa.array(text)), pa.array(word.view(np.int64))], ["qid", "term"])


def _write_queries(folder: str):
    """Rows sorted by block and query to files of whole blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        for block in table.column("block").unique():
            part = table.filter(pa.compute.equal(table.column("block"), block)).drop_columns(["block"])
            asked = Asked(*(part.column(c).to_numpy() for c in ("qid", "term", "idf")))
            system, path = pyarrow.fs.FileSystem.from_uri(folder)
            system.create_dir(path, recursive=True)
            name = uuid.uuid4().hex
            with system.open_output_stream(f"{path}/{name}") as sink:
                asked.write(sink)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])

    return run


class Asked:
    """The queries of a file: their ``numbers``, the distinct ``terms`` in order with their
    ``idf``, and rows of query by query that say which term (``of``) each has."""

    def __init__(self, query: np.ndarray, terms: np.ndarray, idf: np.ndarray):
        """From sorted rows (query, term, idf)."""
        self.terms, first, of = np.unique(terms.view(np.uint64), return_index=True, return_inverse=True)
        self.idf, self.of = idf[first], of.astype(np.int32)
        cuts = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
        self.numbers, self.size = query[cuts], np.diff(np.append(cuts, len(query)))
        self._count()

    def _count(self) -> None:
        self.start = np.cumsum(self.size) - self.size
        self.which = np.repeat(np.arange(len(self.size)), self.size)

    def write(self, sink) -> None:
        for columns in ((self.terms.view(np.int64), self.idf), (self.numbers, self.size), (self.of,)):
            part = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [str(i) for i in range(len(columns))])
            with pa.ipc.new_stream(sink, part.schema) as writer:
                writer.write_batch(part)

    @classmethod
    def read(cls, source) -> Asked:
        out = cls.__new__(cls)
        columns = []
        for _ in range(3):
            with pa.ipc.open_stream(source) as reader:
                columns += [c.to_numpy() for c in reader.read_all().combine_chunks().columns]
        terms, out.idf, out.numbers, out.size, out.of = columns
        out.terms = terms.view(np.uint64)
        out._count()
        return out


class Group:
    """Postings of like documents, in the order of terms; ``rows`` are their places in the shard."""

    def __init__(self, rows: np.ndarray, doc: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.rows, self.doc, self.weight = rows, doc, weight
        self.first = np.append(np.flatnonzero(np.append(True, term[1:] != term[:-1])[: len(term)]), len(term))
        self.terms = term[self.first[:-1]]
        self.size = np.diff(self.first)
        # The most that a term adds to any of these documents.
        self.most = np.maximum.reduceat(weight, self.first[:-1])
        self.width = -(-len(rows) // BLOCK) * BLOCK
        common = np.argsort(-self.size, kind="stable")[:COMMON]
        common = common[self.size[common] * RARE > len(rows)]
        self.column = np.full(len(self.terms), -1)
        self.column[common] = np.arange(len(common))
        self.of_common = ranges(self.first[common], self.size[common])
        self.place = np.repeat(np.arange(len(common)) * self.width, self.size[common]) + doc[self.of_common]
        self.n_common = len(common)

    def ask(self, asked: Asked) -> None:
        """Makes ready for the queries of a file; ``bound`` is what a document can score
        at most under each."""
        at = np.minimum(np.searchsorted(self.terms, asked.terms), len(self.terms) - 1)
        known = self.terms[at] == asked.terms
        factor = np.zeros(len(self.terms))
        factor[at[known]] = asked.idf[known]
        self.at = np.where(known, at, -1)
        self.points = np.repeat(factor, self.size)
        self.points *= self.weight
        self.points *= UNIT
        np.rint(self.points, out=self.points)
        most = np.where(known, np.rint(factor * self.most * UNIT)[at], 0)
        self.bound = np.bincount(asked.which, most[asked.of], len(asked.numbers))
        self.dense = None

    def best(self, asked: Asked, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of the ``queries`` the documents and scores, in units, at least as good as the
        ``floor``, which rises to what k documents here have at least."""
        n = asked.size[queries]
        term = self.at[asked.of[ranges(asked.start[queries], n)]]
        which = np.repeat(np.arange(len(queries)), n)[term >= 0]
        term = term[term >= 0]
        # By query: whether the frequent terms are worth a product.
        frequent = self.column[term] >= 0
        held = np.bincount(which[frequent], self.size[term[frequent]], len(queries))
        frequent &= (held * WORTH > self.n_common * self.width)[which]
        edges = np.searchsorted(which, np.arange(0, len(queries) + TOGETHER, TOGETHER))
        for i, lo in enumerate(range(0, len(queries), TOGETHER)):
            part = slice(edges[i], edges[i + 1])
            own = queries[lo : lo + TOGETHER]
            total = self._sums(which[part] - lo, term[part], frequent[part], len(own))
            q, doc, score = self._chosen(total, own, floor, k)
            yield own[q], self.rows[doc], score

    def _sums(self, which: np.ndarray, term: np.ndarray, frequent: np.ndarray, n: int) -> np.ndarray:
        """Scores of all documents under ``n`` queries. Whole numbers below 2**53: exact
        in whatever order they are added."""
        total = np.zeros((n, self.width))
        if frequent.any():
            if self.dense is None:
                self.dense = np.zeros((self.n_common, self.width))
                self.dense.ravel()[self.place] = self.points[self.of_common]
            asks = np.zeros((n, self.n_common))
            asks[which[frequent], self.column[term[frequent]]] = 1
            some = np.flatnonzero(asks.any(1))
            if len(some) == n:
                np.matmul(asks, self.dense, out=total)
            else:
                total[some] = asks[some] @ self.dense
        which, term = which[~frequent], term[~frequent]
        size = self.size[term]
        # Runs of whole queries with about so many postings.
        edges = np.searchsorted(which, np.arange(n + 1))
        ends = np.append(0, np.cumsum(size))[edges]
        lo = 0
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(ends, ends[lo] + POSTINGS, "right")) - 1))
            part = slice(edges[lo], edges[hi])
            posting = ranges(self.first[term[part]], size[part])
            to = np.repeat((which[part] - lo) * self.width, size[part])
            to += self.doc[posting]
            total[lo:hi] += np.bincount(to, self.points[posting], (hi - lo) * self.width).reshape(hi - lo, self.width)
            lo = hi
        return total

    def _chosen(self, total: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        blocks = total.reshape(len(total), -1, BLOCK)
        top = blocks.max(2)
        pool = top if top.shape[1] >= k else total
        if pool.shape[1] >= k:
            kth = np.partition(pool, pool.shape[1] - k)[:, pool.shape[1] - k]
            floor[queries] = np.maximum(floor[queries], kth)
        least = floor[queries]
        q, block = np.nonzero(top >= least[:, None])
        opened = blocks[q, block]
        hit, place = np.nonzero(opened >= least[q][:, None])
        return q[hit], block[hit] * BLOCK + place, opened[hit, place]


def _alike(doc: np.ndarray, first: np.ndarray, n_docs: int) -> np.ndarray:
    """A group per document, by the frequent terms that documents share. ``doc`` has the
    postings term by term, a term's from ``first`` on."""
    most = min(GROUPS, n_docs // GROUP_DOCS)
    if most < 2 or not len(doc):
        return np.zeros(n_docs, np.int64)
    n = np.diff(first)
    # Terms of a few documents tell too little of the others.
    common = np.argsort(-n, kind="stable")[:COMMON]
    common = common[n[common] * COMMON > n_docs]
    if not len(common):
        return np.zeros(n_docs, np.int64)
    held = np.zeros((n_docs, len(common)), np.float32)
    column = np.repeat(np.arange(len(common)), n[common])
    held[doc[ranges(first[common], n[common])], column] = np.repeat(np.log1p(n_docs / n[common]), n[common])
    length = np.sqrt((held * held).sum(1, keepdims=True))
    held /= np.where(length > 0, length, 1)
    sample = held[np.flatnonzero(length[:, 0] > 0)]
    sample = sample[np.random.default_rng(len(sample)).permutation(len(sample))[:SAMPLE]]
    # Far ones to begin with, then the means of those nearest to each.
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < min(most, len(sample)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    centres = sample[chosen]
    for _ in range(ROUNDS):
        own = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        share = np.bincount(own, minlength=len(centres))
        centres = sums[share > 0] / np.maximum(np.sqrt((sums[share > 0] ** 2).sum(1, keepdims=True)), 1e-9)
    own = (sample @ centres.T).argmax(1)
    share = np.bincount(own, minlength=len(centres))
    centres = centres[share * SMALL >= min(len(sample), share.max() * SMALL)]
    return (held @ centres.T).argmax(1)


class Shard:
    """An inverted index of some documents."""

    def __init__(self, parts: list[pa.RecordBatch], mean_length: float):
        texts, terms, counts, lengths, base = [], [], [], [], 0
        for part in parts:
            text, term, count, length = _pairs(part)
            texts.append(text.astype(np.int32) + np.int32(base))
            terms.append(term)
            counts.append(count)
            lengths.append(length)
            base += len(length)
        self.ids = pa.concat_arrays([p.column("id") for p in parts])
        length = np.concatenate(lengths)
        doc, term, count = np.concatenate(texts), np.concatenate(terms), np.concatenate(counts)
        del texts, terms, counts
        weight = count * (K1 + 1) / (count + K1 * (1 - B + B * length[doc] / mean_length))
        order = np.argsort(term, kind="stable")
        term, doc, weight = term[order], doc[order], weight[order]
        first = np.append(np.flatnonzero(np.append(True, term[1:] != term[:-1])[: len(term)]), len(term))
        group = _alike(doc, first, len(length))
        place = np.empty(len(length), np.int32)
        self.groups = []
        for g in np.unique(group[doc]):
            rows = np.flatnonzero(group == g)
            place[rows] = np.arange(len(rows))
            own = group[doc] == g
            self.groups.append(Group(rows, place[doc[own]], term[own], weight[own]))

    def answers(self, query: np.ndarray, terms: np.ndarray, idf: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For sorted rows (query, term, idf): queries, documents and scores, in units, with
        all that are at least as good as a query's k-th here; those without any term never."""
        if len(query):
            asked = Asked(query, terms, idf)
            for which, docs, scores in self.best(asked, np.zeros(len(asked.numbers)), k):
                yield asked.numbers[which], docs, scores

    def best(self, asked: Asked, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries by place, documents and scores; nothing below the ``floor``, which rises."""
        if not self.groups:
            return
        np.maximum(floor, 1, out=floor)
        for group in self.groups:
            group.ask(asked)
        bounds = np.stack([group.bound for group in self.groups])
        ahead = bounds.argmax(0)
        for turn in (True, False):
            for g, group in enumerate(self.groups):
                queries = np.flatnonzero(((ahead == g) == turn) & (bounds[g] >= floor))
                yield from group.best(asked, queries, floor, k)


def _search(paths: list[str], k: int, mean_length: float):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held, size, docs = [], 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                held.append(part)
                size += part.column("text").nbytes
                docs += part.num_rows
                if size >= SHARD_BYTES or docs >= SHARD_DOCS:
                    yield Shard(held, mean_length)
                    held, size, docs = [], 0, 0
        if held:
            yield Shard(held, mean_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What earlier shards of the task found rules out more: a number per query.
        floors: dict[str, np.ndarray] = {}
        for shard in shards(batches):
            for path in paths:
                system, name = pyarrow.fs.FileSystem.from_uri(path)
                with system.open_input_stream(name) as source:
                    asked = Asked.read(source)
                floor = floors.setdefault(path, np.zeros(len(asked.numbers)))
                found = list(shard.best(asked, floor, k))
                if not found:
                    continue
                which, docs, scores = (np.concatenate(c) for c in zip(*found))
                # Ties at the k-th place are cut by id here as in the merge.
                ids = shard.ids.take(pa.array(docs))
                order = pa.compute.sort_indices(
                    pa.table({"q": which, "s": scores, "i": ids}), [("q", "ascending"), ("s", "descending"), ("i", "ascending")]
                ).to_numpy()
                which, scores = which[order], scores[order]
                place = np.arange(len(which)) - np.searchsorted(which, which)
                last = place == k - 1
                floor[which[last]] = np.maximum(floor[which[last]], scores[last])
                kept = place < k
                if kept.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asked.numbers[which[kept]]), ids.take(pa.array(order[kept])), pa.array(scores[kept] / UNIT)],
                        ["query_id", "doc_id", "score"],
                    )

    return run


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``query_id, rank, doc_id, score``: for each row of ``queries`` (same columns) the
    ``k`` documents of the highest BM25 score, all distinct words of its text counting
    once each. Equal scores go by id, documents without an id last.

    Words are runs of ASCII letters, digits and non-ASCII, A-Z lower-cased, told apart
    by 64-bit hashes. Queries without an id are passed over, of repeated ones the words
    count together; queries without words, and null or empty documents, match nothing.
    Repeated documents are found each. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    asked = queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("qid"), text.alias("text"))
    figures = stored(
        source.mapInArrow(_frequencies, "term long, n long, words long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")),
        "frequencies",
    )
    total = figures.where("term is null").first()
    if total is None or not total.words:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    terms = asked.mapInArrow(_terms, "qid long, term long").distinct().join(figures.where("term is not null"), "term")
    idf = F.ln(F.lit(1.0) + (F.lit(float(total.n)) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    n_queries = asked.count()
    blocks = n_queries // QUERIES_AT_ONCE + 1
    dealt = terms.select("qid", "term", idf.alias("idf"), F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("block"))
    # A file per block; the names are all the driver holds of the queries.
    folder = work_path(spark, "queries")
    files = dealt.repartition(blocks, "block").sortWithinPartitions("block", "qid", "term").mapInArrow(_write_queries(folder), "path string")
    paths = sorted(r.path for r in stored(files, "query-files").collect())
    found = source.mapInArrow(_search(paths, k, total.words / total.n), "query_id long, doc_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
