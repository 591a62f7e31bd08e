import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curate.functions.vectors import cosine
from curate.operators import knn, vector_index
from curate.operators.knn import knn_and_extremes, knn_join
from curate.operators.vector_index import build_index, search_index
from curate.session import work_path


def vectors(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim))
    m[n // 3 : 2 * n // 3] = m[0]  # a third of all documents are copies
    return (m / np.linalg.norm(m, axis=1, keepdims=True)).astype("float32")


def frames(spark, n_docs=900, n_questions=12):
    docs, asked = vectors(n_docs), vectors(n_questions, seed=2)
    d = spark.createDataFrame([(f"d{i:04}", v.tolist()) for i, v in enumerate(docs)], "doc_id string, vec array<float>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "question_id int, vec array<float>")
    return q, d, asked, docs


def brute_force(asked, docs, k):
    expected = {}
    for i, q in enumerate(asked):
        scores = [math.fsum(d.astype("float64") * q.astype("float64")) for d in docs]
        order = sorted(range(len(docs)), key=lambda j: (-scores[j], f"d{j:04}"))[:k]
        expected[i] = [f"d{j:04}" for j in order]
    return expected


def got(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r.question_id, r.rank)):
        out.setdefault(r.question_id, []).append(r.doc_id)
    return out


@pytest.mark.parametrize("k", [1, 3, 350])
def test_search_agrees_with_brute_force_at_any_size_of_blocks(spark, k):
    q, d, asked, docs = frames(spark)
    expected = brute_force(asked, docs, k)
    assert got(knn_join(q, d.repartition(7), k)) == expected
    assert got(knn_join(q, d, k, block_rows=100)) == expected


def test_close_scores_rank_by_score_and_limit_each_task(spark):
    d = spark.createDataFrame([("a", [0.5, 0.0]), ("b", [0.5000004, 0.0]), ("c", [0.5000004, 0.0])], "doc_id string, vec array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 3)], "question_id int, vec array<double>, k int")
    hits = knn_join(q, d)
    assert got(hits) == {1: ["b"], 2: ["b", "c", "a"]}
    assert got(knn_join(q, d, block_rows=1)) == {1: ["b"], 2: ["b", "c", "a"]}
    assert "WindowGroupLimit" in hits._jdf.queryExecution().executedPlan().toString()


def test_small_slices_keep_all_hits(spark, monkeypatch):
    q, d, asked, docs = frames(spark)
    monkeypatch.setattr("curate.operators.knn._CELLS", 100)
    assert got(knn_join(q, d, 3)) == brute_force(asked, docs, 3)


def test_fewer_documents_than_k(spark):
    q, d, asked, docs = frames(spark, n_docs=5)
    hits = knn_join(q, d, 50)
    assert got(hits) == brute_force(asked, docs, 50)
    assert {r.rank for r in hits.collect()} == {1, 2, 3, 4, 5}


def test_each_question_has_its_own_k(spark):
    q, d, *_ = frames(spark)
    hits = knn_join(q.withColumn("k", F.col("question_id") + 1), d)
    assert {i: len(v) for i, v in got(hits).items()} == {i: i + 1 for i in range(12)}


def test_no_documents_or_no_questions(spark):
    q, d, *_ = frames(spark)
    assert knn_join(q, d.where("false")).count() == 0
    assert knn_join(q.where("false"), d).count() == 0
    assert knn_join(q, d.where("false"), block_rows=1).count() == 0


def test_rows_without_a_vector_are_left_out(spark):
    q, d, *_ = frames(spark)
    gap = spark.createDataFrame([("none", None)], d.schema)
    assert "none" not in {r.doc_id for r in knn_join(q, d.unionByName(gap), 1000).collect()}


def test_readers_retrieve_only_what_is_granted(spark):
    q, d, *_ = frames(spark)
    granted = spark.createDataFrame([("d0001",), ("d0002",)], "doc_id string")
    hits = knn_join(q, d.join(granted, "doc_id", "left_semi"))
    assert {r.doc_id for r in hits.collect()} == {"d0001", "d0002"}


def test_scores_and_cosine_agree(spark):
    q, d, *_ = frames(spark, n_docs=20)
    hits = knn_join(q, d, 20).join(q.withColumnRenamed("vec", "a"), "question_id").join(d, "doc_id")
    off = hits.where(F.abs(cosine("a", "vec") - F.col("score")) > 1e-12)
    assert off.count() == 0


def test_no_cross_join_in_the_plan(spark):
    q, d, *_ = frames(spark)
    for hits in (knn_join(q, d), knn_join(q, d, block_rows=1)):
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        # Documents are neither copied nor shuffled: the only exchange is of hits.
        assert "Generate" not in plan and plan.count("Exchange hashpartitioning(question_id") == plan.count("Exchange ")


def test_vectors_of_another_length_are_an_error(spark):
    q, d, *_ = frames(spark, n_docs=20)
    odd = spark.createDataFrame([("odd", [1.0, 0.0])], d.schema)
    with pytest.raises(Exception, match="different lengths|mismatch|size"):
        knn_join(q, d.unionByName(odd).coalesce(1)).collect()


def test_equal_vectors_are_scored_once(spark, monkeypatch):
    docs = np.repeat(vectors(5), 400, axis=0)
    d = spark.createDataFrame([(f"d{i:04}", v.tolist()) for i, v in enumerate(docs)], "doc_id string, vec array<float>").coalesce(1)
    q, _, asked, _ = frames(spark)
    assert got(knn_join(q, d, 3)) == brute_force(asked, docs, 3)
    chunk = knn._Chunk(d.select("doc_id", "vec").toArrow())
    assert (chunk.copy == 0).sum() == len(np.unique(docs, axis=0)) and chunk.copy.max() >= 399


def test_readers_share_one_search(spark):
    q, d, asked, docs = frames(spark)
    d = d.withColumn("team", F.when(F.col("doc_id") < "d0700", F.substring("doc_id", 5, 1)))
    groups = F.when(F.col("question_id") % 3 == 0, F.array(F.lit("1"), F.lit("no such"))).when(F.col("question_id") % 3 == 1, F.array(F.lit("2"), F.lit("3")))
    hits = knn_join(q.withColumn("groups", groups), d, 4, carry=("team",), group="team", block_rows=100)
    seen = {0: {"1"}, 1: {"2", "3"}}
    for i, ids in got(hits).items():
        allowed = [j for j in range(len(docs)) if i % 3 == 2 or (j < 700 and f"{j:04}"[3] in seen[i % 3])]
        scores = {j: math.fsum(docs[j].astype("float64") * asked[i].astype("float64")) for j in allowed}
        assert ids == [f"d{j:04}" for j in sorted(allowed, key=lambda j: (-scores[j], j))[:4]], i
    assert {r.question_id for r in hits.collect()} == set(range(12))
    with pytest.raises(ValueError, match="groups"):
        knn_join(q.withColumn("groups", groups), d)


def test_extremes_come_from_the_same_scan(spark):
    q, d, asked, docs = frames(spark)
    d = d.withColumn("value", F.when(F.col("doc_id") > "d0005", F.floor(F.substring("doc_id", 3, 1).cast("int") / 4)))
    ends = F.when(F.col("question_id") % 3 == 0, "lowest").when(F.col("question_id") % 3 == 1, "highest")
    hits = knn_and_extremes(q.withColumns({"extreme": ends, "k": F.lit(2)}), d.repartition(5), "value", ("value",), block_rows=50)
    rows = hits.collect()
    plain = brute_force(asked, docs, 2)
    assert {i: [r.doc_id for r in sorted(rows, key=lambda r: r.rank) if r.question_id == i and not r.extreme] for i in range(12)} == plain
    found = {r.question_id: (r.value, r.doc_id) for r in rows if r.extreme}
    value = {j: int(f"{j:04}"[1]) // 4 for j in range(6, 900)}
    assert set(found) == {i for i in range(12) if i % 3 < 2}
    for i, (v, doc) in found.items():
        end = (min, max)[i % 3](value.values())
        best = max((j for j in value if value[j] == end), key=lambda j: (math.fsum(docs[j].astype("float64") * asked[i].astype("float64")), -j))
        assert (v, doc) == (end, f"d{best:04}")


def clustered(n, dim=16, centres=12, seed=3):
    middle = np.random.default_rng(5).normal(size=(centres, dim))
    rng = np.random.default_rng(seed)
    m = middle[rng.integers(0, centres, n)] + 0.15 * rng.normal(size=(n, dim))
    m[: n // 3] = m[0]  # a hot cell
    return (m * rng.uniform(0.5, 2, size=(n, 1))).astype("float32")


def test_index_gives_the_exact_hits_and_opens_few_cells(spark):
    docs, asked = clustered(3000), clustered(40, seed=9)
    docs[7] = 0
    d = spark.createDataFrame([(f"d{i:04}", v.tolist(), str(i % 4)) for i, v in enumerate(docs)], "doc_id string, vec array<float>, team string")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "question_id int, vec array<float>")
    index = build_index(d, work_path(spark, "index"), pivots=16, rings=3, keep=("team",))
    assert index.cells["n"].sum() == 3000 and len(index.cells["n"]) <= 48
    for k in (1, 5):
        found = search_index(q, index, k)
        assert got(found.hits) == brute_force(asked, docs, k)
        shares = [r.scored / r.total for r in found.scored.collect()]
        assert len(shares) == 40 and sum(shares) / 40 < 0.5
    groups = q.withColumn("groups", F.array(F.lit("1")))
    of_team = search_index(groups, index, 3, group="team").hits
    assert got(of_team) == got(knn_join(groups, d, 3, group="team"))
    few = got(search_index(q, index, 5, probes=6).hits)
    exact = brute_force(asked, docs, 5)
    assert sum(len(set(few.get(i, [])) & set(exact[i])) for i in exact) >= 0.9 * 5 * 40


def test_index_of_odd_tables(spark):
    q, d, asked, docs = frames(spark, n_docs=4)
    index = build_index(d, work_path(spark, "index"), pivots=64)
    assert got(search_index(q, index, 50).hits) == brute_force(asked, docs, 50)
    assert search_index(q.where("false"), index).hits.count() == 0
    empty = build_index(d.where("false"), work_path(spark, "index"))
    assert search_index(q, empty).hits.count() == 0
    assert [r.scored for r in search_index(q, empty).scored.collect()] == [0] * 12


def test_bounds_hold_for_every_document(spark):
    docs, asked = clustered(800), clustered(30, seed=4).astype("float64")
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "doc_id int, vec array<float>")
    index = build_index(d, work_path(spark, "index"), pivots=8)
    bound = index.bounds(asked)
    place = {c: i for i, c in enumerate(index.cells["cell"].tolist())}
    for r in index.documents(spark).collect():
        assert (asked @ np.array(r.vec) <= bound[:, place[r.cell]]).all()


def test_small_files_of_questions_are_scored_together(spark, monkeypatch):
    q, d, asked, docs = frames(spark, n_questions=40)
    opened = []
    folder, _, _ = knn.write_questions(q, 3, 1)
    system, files = knn._files(folder)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 16)
    assert len(files) == 40 and [len(block.ks) for block in knn._read(system, files)] == [16, 16, 8]
    assert len({opened_id for block in knn._read(system, files) for opened_id in block.table.column("question_id").to_pylist()}) == 40
    monkeypatch.undo()
    # The size of the files does not cut the documents into more chunks.
    chunks = list(knn._gathered(d.coalesce(1).toArrow().to_batches(max_chunksize=7), knn.CHUNK_ROWS, knn.CHUNK_BYTES))
    assert [len(c) for c in chunks] == [900]
    assert got(knn_join(q, d, 3, block_rows=1)) == brute_force(asked, docs, 3)


@pytest.mark.parametrize("k", [1, 3, 350])
def test_many_chunks_of_documents(spark, monkeypatch, k):
    q, d, asked, docs = frames(spark)
    monkeypatch.setattr(knn, "CHUNK_ROWS", 50)
    assert got(knn_join(q, d, k, block_rows=5)) == brute_force(asked, docs, k)


@pytest.mark.parametrize("scale", [1e-30, 1e30])
def test_scores_beyond_single_precision_rank_as_they_are(spark, scale):
    docs = vectors(200).astype("float64") * scale
    docs[3] *= 1e-20
    docs[50:60] = docs[50] + np.arange(10)[:, None] * scale * 1e-13
    asked = np.concatenate([vectors(5, seed=2).astype("float64"), docs[50:51], np.zeros((1, 8))])
    d = spark.createDataFrame([(f"d{i:04}", v.tolist()) for i, v in enumerate(docs)], "doc_id string, vec array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "question_id int, vec array<double>")
    for k in (3, 12):
        assert got(knn_join(q, d, k)) == brute_force(asked, docs, k)


def test_sparse_questions_score_as_whole_ones():
    rng = np.random.default_rng(4)
    docs = rng.normal(size=(50, 64)).astype("float32")
    asked = np.zeros((6, 64))
    for i in range(5):
        asked[i, rng.integers(0, 64, i + 1)] = rng.normal(size=i + 1)
    table = pa.table({"vec": pa.array(asked.tolist()), "k": [1] * 6, "end": [0] * 6, "floor": [0.0] * 6})
    block = knn._Questions(table)
    assert block.support.shape[1] <= 5
    row, which = np.divmod(np.arange(300), 6)
    assert (block.scores(docs, row, which) == knn._dots(docs[row].astype("float64"), asked[which])).all()


def test_probes_are_made_in_batches_of_bounded_size(spark):
    q, d, _, _ = frames(spark, n_docs=600, n_questions=1)
    index = build_index(d, work_path(spark, "index"))
    made = []

    class Asked:
        schema = q.withColumns({"k": F.lit(3), "floor": F.lit(-2.0)}).schema

        def mapInArrow(self, run, schema):
            rows = vectors(4000)
            vec = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float32()))
            columns = [pa.array(range(len(rows)), pa.int32()), vec, pa.array([3] * len(rows), pa.int32()), pa.array([-2.0] * len(rows))]
            made.extend(run(iter([pa.RecordBatch.from_arrays(columns, self.schema.names)])))

    vector_index._probes(Asked(), index, False, None)
    assert sum(b.num_rows for b in made) > 10 * vector_index.PROBE_ROWS
    assert max(b.num_rows for b in made) <= vector_index.PROBE_ROWS


def test_few_questions_copy_few_documents_at_once():
    def table(n, **columns):
        rows = vectors(n, dim=256)
        vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 256), pa.array(rows.ravel()))
        return pa.table({"vec": vec, **{c: np.resize(v, n) for c, v in columns.items()}})

    chunk = knn._Chunk(table(32_768, doc_id=np.arange(32_768)))
    asked = knn._Questions(table(51, question_id=np.arange(51), k=np.int32(3), end=np.int32(0), floor=-np.inf))
    tracemalloc.start()
    try:
        chunk.best(asked)
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()


def test_questions_that_open_many_cells_are_written_once(spark):
    """On vectors without clusters nearly every question opens nearly every cell; what is
    kept does not grow with their number, and the hits are those of the scan."""
    docs = vectors(1500, dim=32)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "doc_id int, vec array<float>")
    q = d.withColumnRenamed("doc_id", "question_id")
    index = build_index(d, work_path(spark, "index"), pivots=16, rings=3)
    before = kept_bytes(spark)
    found = search_index(q, index, 3)
    written = kept_bytes(spark) - before
    assert sum(r.scored for r in found.scored.collect()) > 0.5 * 1500 * 1500
    assert got(found.hits) == got(knn_join(q, d, 3))
    assert written < 4 * docs.nbytes


def kept_bytes(spark):
    system = spark._jvm.org.apache.hadoop.fs.Path(work_path(spark, "x")).getParent()
    return system.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(system).getLength()


def test_cells_opened_by_bits():
    rows = vectors(20)
    held = np.random.default_rng(0).random((20, 11)) < 0.4
    bits = [b.tobytes() for b in np.packbits(held, axis=1)]
    vec = pa.array(rows.tolist(), pa.list_(pa.float32()))
    table = pa.table({"question_id": range(20), "vec": vec, "k": [1] * 20, "end": [0] * 20, "floor": [0.0] * 20, knn.OPENED: pa.array(bits, pa.binary())})
    for asked, own in ((knn._Questions(table), held), (knn._Questions(table.slice(7)), held[7:])):
        for bit in range(11):
            opening = asked.opening(bit)
            assert opening.tolist() == np.flatnonzero(own[:, bit]).tolist()
            some = asked.only(opening)
            assert some.table.column("question_id").to_pylist() == [asked.table.column("question_id")[i].as_py() for i in opening]
            assert (some.vectors == asked.vectors[opening]).all()
