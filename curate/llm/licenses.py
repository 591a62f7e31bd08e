"""License scans by ordered signature rules.

Texts pass a keyword gate first. In those that do, each place whose word starts
some rule is tried: the rules of that word whose keyword stands in the text from
there on, also glued to other letters, are matched, in order. Of matches over the same words the first rule's
stays; a match within another of the same or a better priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curate.llm.license_rules import GATES, rules
from curate.llm.words import count_words, normal_text, once, words_of

# Words from a place on that a rule may match.
REACH = 20


def _rule_table() -> tuple[Column, Column]:
    """The rules of every word that starts some, as one constant map, and these words."""
    of_word: dict[str, list[Column]] = {}
    for r in rules():
        of_word.setdefault(r.first, []).append(F.struct(
            F.lit(r.order).alias("order"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"),
            F.lit(r.keyword).alias("keyword"), F.lit(f"^(?:{r.pattern})(?= )").alias("pattern"),
            F.lit(r.confidence).alias("confidence"), F.lit(r.phrase).alias("phrase"),
        ))
    words = sorted(of_word)
    return F.create_map(*(c for w in words for c in (F.lit(w), F.array(*of_word[w])))), F.array(*map(F.lit, words))


def _matches(words: Column) -> Column:
    """Every match of every rule: rule fields, ``start`` and ``stop`` in words."""
    table, first = _rule_table()
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(first, F.get(words, i)))

    def at(i: Column) -> Column:
        text = F.concat(F.array_join(F.slice(words, i + 1, REACH), " "), F.lit(" "))

        def tried(here: Column) -> Column:
            hit = lambda r: F.contains(here, r["keyword"]) & F.regexp_like(here, r["pattern"])
            return F.transform(F.filter(F.element_at(table, F.get(words, i)), hit), lambda r: match(here, r))

        def match(here: Column, r: Column) -> Column:
            found = F.call_function("regexp_extract", here, r["pattern"], F.lit(0))
            stop = i + F.length(found) - F.length(F.replace(found, F.lit(" "), F.lit(""))) + 1
            return F.struct(
                i.alias("start"), (-stop).alias("back"), r["priority"].alias("priority"), r["order"].alias("order"),
                r["label"].alias("label"), r["confidence"].alias("confidence"), r["phrase"].alias("phrase"),
            )

        return once(text, tried)

    return F.array_sort(F.flatten(F.transform(places, at)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, matches, detections``: per row of ``docs``.

    ``matches`` has every match; ``detections`` those left after suppression. Both
    are arrays of (start, stop, priority, order, label, confidence, phrase), by start.
    Null and empty texts have no words and none of either; repeated rows give
    repeated results; other columns are left out. A match is at most ``REACH`` words
    long, so what contains it starts at most as far before it, and each text takes
    time in proportion to its length.
    """
    normal = docs.select(F.col(id_col).alias("doc_id"), normal_text(F.col(text_col)).alias("normal"))
    padded = F.concat(F.lit(" "), F.col("normal"), F.lit(" "))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(padded, F.lit(word))
    gated = normal.select("doc_id", count_words(F.col("normal")).alias("n_words"), F.when(gate, words_of(F.col("normal"))).alias("words"))
    found = gated.select("doc_id", "n_words", F.when(F.size("words") > 0, _matches(F.col("words"))).alias("found"))
    found = found.select("doc_id", "n_words", F.coalesce("found", F.slice("found", 1, 0)).alias("found"))

    # By start, longest first, best first: of matches over the same words the first stays.
    def same(i: Column, m: Column) -> Column:
        before = F.get(F.col("found"), i - 1)
        return (i > 0) & (before["start"] == m["start"]) & (before["back"] == m["back"])

    lead = found.withColumn("lead", F.filter("found", lambda m, i: ~F.coalesce(same(i, m), F.lit(False))))
    # A place has one match per length at most, so this many can reach it.
    reach = REACH * REACH

    def suppressed(m: Column, i: Column) -> Column:
        before = F.slice("lead", F.greatest(i - reach + 1, F.lit(1)), F.least(i, F.lit(reach)))
        return F.exists(before, lambda e: (e["back"] <= m["back"]) & (e["priority"] <= m["priority"]))

    left = lead.withColumn("left", F.filter("lead", lambda m, i: ~suppressed(m, i)))

    def shown(name: str) -> Column:
        return F.transform(
            name,
            lambda m: F.struct(m["start"].alias("start"), (-m["back"]).alias("stop"), *(m[c].alias(c) for c in ("priority", "order", "label", "confidence", "phrase"))),
        )

    return left.select("doc_id", "n_words", shown("found").alias("matches"), shown("left").alias("detections"))


def report(scanned: DataFrame) -> DataFrame:
    """Per document: places of the fixed phrases, labels of all kinds and a score, the
    highest confidence of a detection (0 without one)."""
    base = F.filter("matches", lambda m: m["phrase"])
    rows = scanned.select("doc_id", "n_words", base.alias("base"), "detections")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    none = F.array().cast("array<string>")
    base_labels, own = (F.coalesce(F.col(c)["label"], none) for c in ("base", "detections"))
    return rows.select(
        "doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.col("base")["start"]).cast("long").alias("first_word"),
        F.array_max(F.col("base")["start"]).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(F.concat(base_labels, own)).alias("labels"),
        F.coalesce(F.array_max(F.col("detections")["confidence"]), F.lit(0.0)).alias("score"),
    )
