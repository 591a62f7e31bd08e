"""Spaced seeds against comparing every item at every place."""

import itertools
import math
import random
import re
import string

import pytest

from curate.llm import decontaminate

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return SPLIT.findall((text or "").translate(LOWER))


def by_hand(docs, items):
    places = {}
    for (doc, text), (item, phrase) in itertools.product(docs, items):
        d, p = words(text), words(phrase)
        if len(p) < decontaminate.SPAN:
            continue
        width = min(decontaminate.WINDOW, len(p))
        for offset in range(-len(p), len(d)):
            equal = [0 <= k + offset < len(d) and d[k + offset] == w for k, w in enumerate(p)]
            best = max(sum(equal[s : s + width]) for s in range(len(p) - width + 1))
            if best >= math.ceil(width * decontaminate.SHARE):
                places.setdefault((doc, item), set()).add((sum(equal), -offset, len(p)))
    return {(*k, len(v), -max(v)[1], max(v)[0], max(v)[2]) for k, v in places.items()}


def test_masks_fit_between_any_two_differing_words():
    for differ in itertools.combinations(range(decontaminate.WINDOW), 2):
        assert any(
            not {s + o for o in mask} & set(differ)
            for mask in decontaminate.MASKS for s in range(decontaminate.WINDOW - decontaminate.SPAN + 1)
        )


@pytest.mark.parametrize("n", range(1, decontaminate.WINDOW + 1))
def test_masks_of_every_length_spare_what_may_differ(n):
    assert n - decontaminate.may_differ(n) == math.ceil(n * decontaminate.SHARE)
    if n < decontaminate.WINDOW:
        laid = [set(mask) for mask in decontaminate.short_masks(n)]
        assert all(mask and max(mask) < n for mask in laid)
    else:
        laid = [{s + o for o in mask} for mask in decontaminate.MASKS for s in range(n - decontaminate.SPAN + 1)]
    for differ in itertools.combinations(range(n), decontaminate.may_differ(n)):
        assert any(not mask & set(differ) for mask in laid)


@pytest.mark.parametrize("limit", [decontaminate.MAX_SHARED_WORDS, 0])
def test_short_items_with_every_allowed_change(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_SHARED_WORDS", limit)
    items, docs = [(99, "")], []
    for n in range(1, decontaminate.WINDOW + 2):
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        most = decontaminate.may_differ(min(n, decontaminate.WINDOW))
        for differ in itertools.chain.from_iterable(itertools.combinations(range(n), d) for d in range(most + 2)):
            changed = ["other" if k in differ else w for k, w in enumerate(item)]
            docs.append((len(docs), " ".join(["before"] * (n % 3) + changed + ["after"] * (n % 2))))
        # Items that stand over an end, and twice in one document.
        docs += [(len(docs) + k, " ".join(t)) for k, t in enumerate([item[1:], item[2:], item[:-1], item[:-2], item[1:-1], item + item])]
    monkeypatch.setattr(decontaminate, "SPAN", 1)  # for by_hand, which leaves out what is shorter
    want = by_hand(docs, items)
    monkeypatch.undo()
    monkeypatch.setattr(decontaminate, "MAX_SHARED_WORDS", limit)
    got = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {tuple(r)[:6] for r in got.collect()} == want and {k[1] for k in want} == set(range(1, decontaminate.WINDOW + 2))


def sample():
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(400)] + ["Ünï", "the", "of"]
    text = lambda n: " ".join(rng.choices(pool, k=n))
    items = [(i, text(rng.randint(8, 40))) for i in range(20)] + [(50, "too short an item"), (51, None), (52, ""), (3, None)]
    docs = [(i, text(rng.randint(0, 80))) for i in range(30)]
    for i, (_, phrase) in enumerate(items[:20]):
        changed = words(phrase)
        for k in rng.sample(range(len(changed)), min(len(changed), i % 5)):
            changed[k] = "changed"
        docs.append((100 + i, text(9) + ". " + ", ".join(changed).upper() + "! " + text(i)))
        docs.append((200 + i, " ".join(words(phrase)[: 4 + i])))
    docs += [(300, " ".join([items[0][1]] * 40)), (301, None), (None, items[1][1]), (None, items[2][1]), (302, "x " * 9000 + items[4][1])]
    return docs + docs[:35], items


@pytest.mark.parametrize("limit", [decontaminate.MAX_SHARED_WORDS, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_SHARED_WORDS", limit)
    docs, items = sample()
    got = decontaminate.overlaps(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, words string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    rows = {tuple(r)[:6] for r in got.collect()}
    assert rows == by_hand(docs, items) and len(rows) > 30
    if limit:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_drop(spark):
    items = [(1, "one two three four five six seven eight nine ten")]
    docs = [(1, "keep me", "a"), (2, items[0][1] + " more", "b"), (None, "also keep", "c"), (None, items[0][1], "d"), (3, None, "e")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    kept = decontaminate.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.item_id for r in kept.collect()) == ["a", "c", "e"] and kept.columns == frame.columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert decontaminate.overlaps(none, items).collect() == []
    assert decontaminate.overlaps(none, items.limit(0)).collect() == []
