import random

from pyspark.sql import functions as F

from curate.operators.dedup import dedup_exact, dedup_latest, exact_groups, fold_versions
from curate.plans import medallion

SCHEMA = "key string, name string, d date, note string, n int"


def messy(spark, rows=4000, seed=3):
    """A third of all rows share one key, and a third of those are one row."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        key = "hot" if rng.random() < 0.34 else rng.choice([None, *map(str, range(40))])
        if key == "hot" and rng.random() < 0.34:
            out.append(("hot", "same", "2024-01-01", "x", 1))
            continue
        out.append(
            (
                key,
                rng.choice([None, "a", "b", "é"]),
                rng.choice([None, "2023-12-31", "2024-01-01", "2024-01-02"]),
                rng.choice([None, "x", "y"]),
                rng.choice([None, 0, 1, -1]),
            )
        )
    text = spark.createDataFrame(out, SCHEMA.replace("date", "string"))
    return text.withColumn("d", F.col("d").cast("date"))


def expected_latest(rows):
    def first_null(value):
        return (value is not None, value if value is not None else 0)

    def order(r):
        recency = (r.d is None, -r.d.toordinal() if r.d else 0)
        return (recency, first_null(r.name), first_null(r.note), first_null(r.n))

    best = {}
    for r in sorted(rows, key=order):
        best.setdefault(r.key, r)
    return {tuple(r) for r in best.values()}


def test_exact_copies_collapse(spark):
    df = messy(spark)
    rows = df.collect()
    out = dedup_exact(df).collect()
    assert len(out) == len({tuple(r) for r in rows}) and {tuple(r) for r in out} == {tuple(r) for r in rows}


def test_latest_wins_against_brute_force(spark):
    df = messy(spark)
    out = dedup_latest(df, "key", "d", "name").collect()
    assert len(out) == len({r.key for r in out})
    assert {tuple(r) for r in out} == expected_latest(df.collect())


def test_fold_gives_the_same_winners_and_the_counts(spark):
    df = messy(spark)
    rows = df.collect()
    out = fold_versions(exact_groups(df), "key", "d", "name")
    assert out.columns == [*df.columns, "n_copies", "n_variants"]
    got = out.collect()
    assert {tuple(r)[:5] for r in got} == expected_latest(rows)
    for r in got:
        same = [tuple(x) for x in rows if x.key == r.key]
        assert (r.n_copies, r.n_variants) == (len(same), len(set(same)))


def test_winner_does_not_depend_on_partitioning(spark):
    df = messy(spark)
    results = [
        {tuple(r) for r in dedup_latest(df.repartition(n), "key", "d", "name").collect()} for n in (1, 3, 17)
    ]
    assert results[0] == results[1] == results[2]


def test_undated_never_beats_dated(spark):
    df = spark.createDataFrame(
        [("k", "a", None, "x", 1), ("k", "z", "2020-01-01", "x", 1)], SCHEMA.replace("date", "string")
    ).withColumn("d", F.col("d").cast("date"))
    assert dedup_latest(df, "key", "d", "name").first().name == "z"


def test_rows_of_a_key_are_limited_before_the_shuffle(spark):
    plan = dedup_latest(messy(spark), "key", "d", "name")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup_latest(empty, "key", "d", "name").count() == 0
    assert fold_versions(exact_groups(empty), "key", "d", "name").count() == 0


def test_one_shuffle_gives_the_same_records(spark, records):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = rng.choice([None, *[f"k{j}" for j in range(400)]])
        day = rng.choice(["2024-01-01", "02/01/2024", "2024-13-45", "45000"])
        rows.append((key, rng.choice("ab"), "30", "B", "C", day, rng.choice(["3", "x"]), "1", "2"))
    raw = records(rows)
    two, one = (medallion.counted_records(raw, even_keys=e) for e in (False, True))
    result = {tuple(r) for r in two.collect()}
    assert {tuple(r) for r in one.collect()} == result and len(result) == len({r[0] for r in rows})

    def shuffles(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("Initial Plan")[-1].count("Exchange hashpartitioning")

    assert (shuffles(one), shuffles(two)) == (1, 2)
    assert shuffles(medallion.counted_records(raw)) == 2


def test_building_the_plan_runs_nothing(spark, records):
    raw = records([("k", "a", "30", "B", "C", "2024-01-01", "3", "1", "2")]).repartition(3)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    medallion.counted_records(raw)
    assert len(tracker.getJobIdsForGroup(None)) == before
