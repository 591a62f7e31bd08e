"""DuckDB SQL for each query, written from the semantics, over the same tables.

Each statement is a chain of common table expressions: ``_with("silver")`` gives
the chain up to the table ``silver``.
"""

from __future__ import annotations

from curate import fixed_values as fixed

# The quality rules once more: name, severity, note, where they apply, what passes.
_DAYS = "(number_of_days + days_attended + days_absent) IS NOT NULL"
_RULES = tuple(
    (name, severity, note, applies, passes)
    for (name, severity, _, _, note), (applies, passes) in zip(
        fixed.ROW_RULES,
        (
            ("true", _DAYS),
            ("true", "course_date IS NOT NULL"),
            ("length(trim(coalesce(age_raw, ''))) > 0", "age_clean IS NOT NULL"),
            (_DAYS, "number_of_days - days_attended - days_absent = 0"),
        ),
    )
)

# Each step: name -> (names of the steps it needs, SQL).
_STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def _step(name: str, needs: tuple[str, ...], sql: str) -> None:
    _STEPS[name] = (needs, sql)


def _with(*names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        needs, _ = _STEPS[name]
        for n in needs:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS (\n{_STEPS[n][1].strip()}\n)" for n in ordered) + "\n"


def _int(text: str) -> str:
    """Cast to int of digits only; DuckDB alone would also take '46.5' and '1e2'."""
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]{{1,9}}') "
        f"THEN CAST(trim({text}) AS INTEGER) END"
    )


# --- the feed -----------------------------------------------------------------------

_step("feed", (), """
SELECT concat('TST-', ok) AS fileno, c_name AS applicant,
  CASE ok % 11 WHEN 0 THEN 'thirty' WHEN 1 THEN '150' WHEN 2 THEN '-5' WHEN 3 THEN ''
       ELSE CAST(14 + ok % 60 AS VARCHAR) END AS age_raw,
  n_name AS branch, pr AS course_name,
  CASE ok % 5 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d/%m/%Y')
       WHEN 2 THEN strftime(d, '%Y/%m/%d')
       WHEN 3 THEN CAST(date_diff('day', DATE '1899-12-30', d) AS VARCHAR)
       ELSE CASE WHEN ok % 10 = 4 THEN '2024-13-45' ELSE strftime(d, '%Y-%m-%d') END
  END AS course_date_raw,
  CASE WHEN ok % 97 = 0 THEN 'n/a' ELSE CAST(n AS VARCHAR) END AS number_of_days,
  CAST(a AS VARCHAR) AS days_attended,
  CAST(n - a + CASE WHEN ok % 13 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS days_absent,
  version
FROM (
  SELECT ok, CAST(d AS DATE) AS d, c_name, n_name, pr, version,
         1 + ok % 10 AS n, ok % (2 + ok % 10) AS a
  FROM (
    WITH k AS (
      SELECT o_orderkey AS ok, CAST(o_orderdate AS DATE) AS d, c_name, n_name, o_orderpriority AS pr
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT *, 0 AS version FROM k
    UNION ALL SELECT *, 1 FROM k WHERE ok % 50 = 0
    UNION ALL SELECT ok, d + INTERVAL 30 DAY, c_name, n_name, pr, 2 FROM k WHERE ok % 70 = 0))
""")

_RAW = ("fileno, applicant, age_raw, branch, course_name, course_date_raw, "
        "number_of_days, days_attended, days_absent")

_step("typed", ("feed",), f"""
SELECT fileno, applicant, age_raw, branch, course_name, course_date_raw,
  {_int('number_of_days')} AS number_of_days,
  {_int('days_attended')} AS days_attended,
  {_int('days_absent')} AS days_absent, version
FROM feed
""")

_DATE = """coalesce(
    CASE WHEN regexp_full_match(course_date_raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
         THEN CAST(try_strptime(course_date_raw, '%Y-%m-%d') AS DATE) END,
    CASE WHEN regexp_full_match(course_date_raw, '[0-9]{2}/[0-9]{2}/[0-9]{4}')
         THEN CAST(try_strptime(course_date_raw, '%d/%m/%Y') AS DATE) END,
    CASE WHEN regexp_full_match(course_date_raw, '[0-9]{4}/[0-9]{2}/[0-9]{2}')
         THEN CAST(try_strptime(course_date_raw, '%Y/%m/%d') AS DATE) END,
    CASE WHEN regexp_full_match(course_date_raw, '[0-9]{4,6}')
         THEN DATE '1899-12-30' + CAST(course_date_raw AS INTEGER) END)"""

_step("dated", ("typed",), f"SELECT *, {_DATE} AS course_date FROM typed")

_step("exact", ("dated",), f"""
SELECT {_RAW}, course_date, count(*) AS n_copies FROM dated GROUP BY ALL
""")

_step("staged", ("exact",), f"""
SELECT {_RAW}, course_date, n_copies, n_variants, coalesce(age BETWEEN 16 AND 100, false) AS is_age_valid,
  CASE WHEN age BETWEEN 16 AND 100 THEN age END AS age_clean,
  number_of_days IS NULL OR days_attended IS NULL OR days_absent IS NULL
    OR days_attended + days_absent <> number_of_days AS dq_days_mismatch
FROM (
  SELECT {_RAW}, course_date, {_int('age_raw')} AS age,
    CAST(sum(n_copies) OVER (PARTITION BY fileno) AS BIGINT) AS n_copies,
    count(*) OVER (PARTITION BY fileno) AS n_variants
  FROM exact
  QUALIFY row_number() OVER (PARTITION BY fileno ORDER BY course_date DESC NULLS LAST,
    applicant NULLS FIRST, age_raw NULLS FIRST, branch NULLS FIRST, course_name NULLS FIRST,
    course_date_raw NULLS FIRST, number_of_days NULLS FIRST, days_attended NULLS FIRST,
    days_absent NULLS FIRST) = 1)
""")

_step("silver", ("staged",), f"""
SELECT {', '.join(fixed.SILVER_COLUMNS)} FROM staged WHERE course_date IS NOT NULL
""")
_step("rejects", ("staged",), f"""
SELECT {', '.join(fixed.REJECT_COLUMNS)}, '{fixed.REJECT_REASON}' AS reject_reason
FROM staged WHERE course_date IS NULL
""")

_RATE = "days_attended / nullif(CAST(number_of_days AS DOUBLE), 0)"

_step("gold", ("silver",), f"""
SELECT * EXCLUDE (is_age_valid, dq_days_mismatch), round({_RATE}, 4) AS attendance_rate,
  CASE WHEN {_RATE} >= 0.9 THEN 'High' WHEN {_RATE} >= 0.6 THEN 'Medium'
       WHEN {_RATE} IS NOT NULL THEN 'Low' ELSE 'Unknown' END AS attendance_band
FROM silver
""")


def _weighted(key: str, where: str = "") -> str:
    return f"""
SELECT {key}, count(*) AS num_records,
  CAST(sum(number_of_days) AS BIGINT) AS total_scheduled_days,
  CAST(sum(days_attended) AS BIGINT) AS total_attended_days,
  round(sum(days_attended) / nullif(CAST(sum(number_of_days) AS DOUBLE), 0), 4) AS attendance_rate
FROM silver {where} GROUP BY {key}
"""


_step("by_branch", ("silver",), _weighted("branch"))
_step("by_course", ("silver",), _weighted("course_name"))

# --- quality -----------------------------------------------------------------------------


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_rows() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT {_quote(name)} AS rule_name, {_quote(severity)} AS severity,
  {_quote(note)} AS rule_note,
  count(*) FILTER (WHERE {applies}) AS rows_evaluated,
  count(*) FILTER (WHERE ({applies}) AND ({passes})) AS rows_passed FROM staged"""
        for name, severity, note, applies, passes in _RULES
    )


_step("rule_lines", ("staged",), _rule_rows())
_step("totals", ("staged",), """
SELECT CAST(sum(n_copies) AS BIGINT) AS rows_in, CAST(sum(n_variants) AS BIGINT) AS after_exact,
  count(*) AS after_key FROM staged
""")
_step("lines", ("rule_lines", "totals"), f"""
SELECT {_quote(fixed.EXACT_RULE[0])} AS rule_name, {_quote(fixed.EXACT_RULE[1])} AS severity,
  {_quote(fixed.EXACT_RULE[2])} AS rule_note, rows_in AS rows_evaluated, after_exact AS rows_passed
FROM totals
UNION ALL
SELECT {_quote(fixed.KEY_RULE[0])}, {_quote(fixed.KEY_RULE[1])}, {_quote(fixed.KEY_RULE[2])},
  after_exact, after_key FROM totals
UNION ALL SELECT * FROM rule_lines
""")
_step("report", ("lines",), """
SELECT 'run-1' AS run_id, '2024-09-01 12:00:00' AS run_ts, 'silver.training' AS dataset,
  rule_name, severity, (SELECT rows_in FROM totals) AS rows_in, rows_evaluated, rows_passed,
  rows_evaluated - rows_passed AS rows_failed, rule_note,
  round(rows_passed / nullif(CAST(rows_evaluated AS DOUBLE), 0), 4) AS pass_rate
FROM lines
""")

# --- documents ---------------------------------------------------------------------------------


def _filled(template: str, **values: str) -> str:
    """A sentence template as SQL concatenation."""
    parts, rest = [], template
    while "{" in rest:
        before, _, after = rest.partition("{")
        name, _, rest = after.partition("}")
        parts += [_quote(before), f"coalesce(CAST({values.get(name, name)} AS VARCHAR), 'unknown')"]
    parts.append(_quote(rest))
    return "concat(" + ", ".join(p for p in parts if p != "''") + ")"


def _percent(rate: str) -> str:
    return f"format('{{:.2f}}%', {rate} * 100)"


_step("docs", ("gold",), f"""
SELECT fileno AS doc_id, '{fixed.DOCUMENT_TYPE}' AS type, fileno AS name, branch, course_name,
  coalesce(CAST(course_date AS VARCHAR), '{fixed.DATE_UNKNOWN}') AS course_date,
  number_of_days AS scheduled, days_attended AS attended, days_absent AS absent,
  {_RATE} AS rate, age_clean AS age, attendance_band
FROM gold
""")
_DOC_TEXT = _filled(
    fixed.DOCUMENT_TEXT,
    age_txt=f"coalesce({_quote('aged ')} || age, {_quote(fixed.AGE_UNKNOWN)})",
    rate_txt=f"coalesce({_percent('rate')}, {_quote(fixed.RATE_UNKNOWN)})",
    band_txt="CASE WHEN attendance_band IS NULL THEN "
    + _quote(fixed.BAND_UNKNOWN_TEXT)
    + " ELSE "
    + _filled(fixed.BAND_KNOWN_TEXT)
    + " END",
)
_CITATION = _filled(
    fixed.CITATION, rate_txt=f"coalesce({_percent('rate')}, '{fixed.CITATION_RATE_UNKNOWN}')"
)
_step("doc_texts", ("docs",), f"SELECT *, {_DOC_TEXT} AS text FROM docs")

# --- word-hash vectors ----------------------------------------------------------------------------
# Murmur3 of a word's bytes with seed 42, modulo 256, in 32-bit arithmetic.

_M = "CAST(4294967296 AS UBIGINT)"


def _u(value: int) -> str:
    return f"CAST({value} AS UBIGINT)"


def _le(*offsets: str) -> str:
    """Bytes at these hex offsets, first byte lowest, as an integer."""
    digits = " || ".join(f"substr(hx, CAST({o} AS BIGINT), 2)" for o in reversed(offsets))
    return f"CAST('0x' || {digits} AS UBIGINT)"


def _mix_k(k: str) -> str:
    a = f"(({k}) * {_u(0xCC9E2D51)} % {_M})"
    return f"(({a} * {_u(1 << 15)} % {_M} + {a} // {_u(1 << 17)}) * {_u(0x1B873593)} % {_M})"


def _mix_h(h: str, k: str) -> str:
    x = f"xor({h}, {k})"
    return f"(({x} * {_u(1 << 13)} % {_M} + {x} // {_u(1 << 19)}) * {_u(5)} + {_u(0xE6546B64)}) % {_M}"


def _vectors(prefix: str, source: str) -> None:
    """Steps ``{prefix}_vec``: (doc_id, bucket, w) with non-zero weights of the
    texts in step ``source`` (doc_id, text)."""
    _step(f"{prefix}_words", (source,) if source in _STEPS else (), f"""
SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS word
FROM {source}
""")
    _step(f"{prefix}_bytes", (f"{prefix}_words",), f"""
SELECT word, lower(hex(encode(word))) AS hx, octet_length(encode(word)) AS n
FROM (SELECT DISTINCT word FROM {prefix}_words)
""")
    tail = (
        "CASE n % 4 WHEN 0 THEN " + _u(0)
        + " WHEN 1 THEN " + _le("n*2-1")
        + " WHEN 2 THEN " + _le("n*2-3", "n*2-1")
        + " ELSE " + _le("n*2-5", "n*2-3", "n*2-1") + " END"
    )
    block = _le("8*i+1", "8*i+3", "8*i+5", "8*i+7")
    _step(f"{prefix}_body", (f"{prefix}_bytes",), f"""
SELECT word, n, {_mix_k('tail')} AS tail,
  list_reduce([{_u(42)}] || list_transform(blocks, lambda k: {_mix_k('k')}),
              lambda h, k: {_mix_h('h', 'k')}) AS h
FROM (SELECT word, n, {tail} AS tail,
        list_transform(range(0, n // 4), lambda i: {block}) AS blocks FROM {prefix}_bytes)
""")
    _step(f"{prefix}_hash", (f"{prefix}_body",), f"""
SELECT word, CAST(xor(h, h // {_u(1 << 16)}) % {_u(256)} AS INTEGER) AS bucket
FROM (SELECT word, xor(h, h // {_u(1 << 13)}) * {_u(0xC2B2AE35)} % {_M} AS h
      FROM (SELECT word, xor(h, h // {_u(1 << 16)}) * {_u(0x85EBCA6B)} % {_M} AS h
            FROM (SELECT word, xor(xor(h, tail), CAST(n AS UBIGINT)) AS h FROM {prefix}_body)))
""")
    _step(f"{prefix}_vec", (f"{prefix}_words", f"{prefix}_hash"), f"""
SELECT doc_id, bucket, CAST(c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)) AS FLOAT) AS w
FROM (SELECT doc_id, bucket, count(*) AS c
      FROM {prefix}_words JOIN {prefix}_hash USING (word) GROUP BY ALL)
""")


_vectors("documents", "documents")
_vectors("gold", "doc_texts")


def _vec_text(prefix: str, source: str) -> str:
    return _with(f"{prefix}_vec") + f"""
SELECT doc_id, string_agg(CAST(CAST(floor(CAST(coalesce(w, 0) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS VARCHAR),
    ',' ORDER BY bucket) AS vec_text
FROM (SELECT doc_id, unnest(range(0, 256)) AS bucket FROM {source})
LEFT JOIN {prefix}_vec USING (doc_id, bucket)
GROUP BY doc_id
"""


# --- questions and answers ----------------------------------------------------------------------------

_step("questions", ("gold",), """
SELECT question, k, answerable FROM (
  SELECT 'What is the attendance rate for the ' || course_name || ' course?' AS question, 3 AS k, true AS answerable
  FROM (SELECT DISTINCT course_name FROM gold)
  UNION ALL SELECT 'How many days did the ' || course_name || ' participant attend?', 3, true
  FROM (SELECT DISTINCT course_name FROM gold)
  UNION ALL SELECT 'Which ' || course_name || ' attendance record has the ' || word || ' attendance rate?', 3, true
  FROM (SELECT DISTINCT course_name FROM gold), (VALUES ('lowest'), ('highest')) AS words(word)
  UNION ALL SELECT 'What courses are running in ' || branch || '?', 3, false
  FROM (SELECT DISTINCT branch FROM gold)
  UNION ALL VALUES
    ('Which attendance record has the lowest attendance rate?', NULL, true),
    ('Which attendance record has the highest attendance rate?', NULL, true),
    ('Average age of participants?', 3, false),
    ('What is the annual leave entitlement?', 3, false))
""")
_step("question_intents", ("questions",), """
SELECT *, CASE
  WHEN regexp_matches(lower(question), 'lowest|worst|minimum|least') THEN 'lowest'
  WHEN regexp_matches(lower(question), 'highest|best|maximum|most') THEN 'highest'
  ELSE 'lookup' END AS intent
FROM questions
""")
_step("question_texts", ("questions",), "SELECT question AS doc_id, question AS text FROM questions")
_vectors("question", "question_texts")

# Every pair of question and document that shares a word. Sums of decimals do not
# depend on their order, so equal similarities tie.
_step("scores", ("gold_vec", "question_vec"), """
SELECT q.doc_id AS question, d.doc_id, CAST(sum(CAST(CAST(q.w AS DOUBLE) * CAST(d.w AS DOUBLE) AS DECIMAL(38, 30))) AS DOUBLE) AS score
FROM question_vec q JOIN gold_vec d USING (bucket) GROUP BY ALL
""")
_step("ranked", ("scores", "question_intents", "docs"), """
SELECT s.question, i.k, i.answerable, i.intent, s.score, d.*,
  row_number() OVER (PARTITION BY s.question ORDER BY s.score DESC, s.doc_id) AS rank
FROM scores s JOIN question_intents i ON s.question = i.question JOIN docs d ON s.doc_id = d.doc_id
""")
# The record an answer is about: an extreme among the k retrieved (all for NULL
# k), else the best hit.
_step("targets", ("ranked",), """
SELECT * EXCLUDE (pick) FROM (
  SELECT *, max(score) OVER (PARTITION BY question) AS top,
    row_number() OVER (PARTITION BY question ORDER BY
      CASE WHEN intent <> 'lookup' AND rate IS NULL THEN 1 ELSE 0 END,
      CASE intent WHEN 'lowest' THEN rate WHEN 'highest' THEN -rate END NULLS LAST, rank) AS pick
  FROM ranked WHERE k IS NULL OR rank <= k)
WHERE pick = 1
""")


def _answer_sql(threshold: float) -> str:
    percent = _percent("rate")
    lookup = _filled(fixed.LOOKUP_BODY, rate_txt=f"coalesce({percent}, '{fixed.LOOKUP_RATE_UNKNOWN}')")
    return f"""
SELECT question, intent, k, answerable, top >= {threshold} AS grounded, round(top, 3) AS top_score,
  CASE WHEN top >= {threshold} THEN concat(
    CASE WHEN rate IS NOT NULL AND intent = 'lowest' THEN {_filled(fixed.LOWEST_BODY, rate_txt=percent)}
         WHEN rate IS NOT NULL AND intent = 'highest' THEN {_filled(fixed.HIGHEST_BODY, rate_txt=percent)}
         ELSE {lookup} END, ' ', {_CITATION})
  ELSE {_quote(fixed.REFUSAL)} END AS answer,
  CASE WHEN top >= {threshold} THEN name ELSE '' END AS sources
FROM targets
"""


_step("answers", ("targets",), _answer_sql(fixed.SIMILARITY_THRESHOLD))
_step("all_answers", ("targets",), _answer_sql(0.0))

# --- plain vectors ----------------------------------------------------------------------------------------

_step("anchors", (), """
SELECT label, min(vec_id) AS anchor_id, arg_min(embedding, vec_id) AS anchor FROM embeddings GROUP BY label
""")
_DOT = "list_dot_product(CAST({} AS DOUBLE[]), CAST({} AS DOUBLE[]))"


def _topk(questions: str, docs: str = "embeddings") -> str:
    score = _DOT.format("q.vec", "e.embedding")
    return f"""
SELECT question_id, doc_id, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT question_id, doc_id, score, row_number() OVER (
      PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT q.question_id, e.vec_id AS doc_id, {score} AS score FROM ({questions}) q, {docs} e))
WHERE rank <= 3
"""


_ANCHOR_QUESTIONS = "SELECT anchor_id AS question_id, anchor AS vec FROM anchors"

# Records as they come back from delimited files: blank text is no value.
_CSV_RAW = _RAW.replace("age_raw", "nullif(age_raw, '') AS age_raw")
_CSV_SILVER = ", ".join(fixed.SILVER_COLUMNS).replace("age_raw", "nullif(age_raw, '') AS age_raw")

_ALERTS = """((severity = 'blocking' AND rows_evaluated - rows_passed > 0)
  OR (severity = 'warn' AND pass_rate < 0.90))"""


def _tagged(*columns: tuple[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{tag}' AS tag, count({c}) AS filled_rows FROM silver"
        for c, tag in columns
    )


def _batch_lines() -> str:
    """The report of each of the two batches of the stream."""
    return "\nUNION ALL\n".join(
        f"""SELECT 'batch-{i}' AS run_id, * FROM (
{_with_renamed(i)}
SELECT rule_name, rows_in, rows_evaluated, rows_passed, rows_failed, pass_rate FROM report)"""
        for i in range(2)
    )


def _with_renamed(batch: int) -> str:
    """The chain up to the report, over one batch of the feed as read from files."""
    condition = "version = 0" if batch == 0 else "version > 0"
    return _with("report").replace(
        "FROM feed",
        "FROM (SELECT * REPLACE (nullif(age_raw, '') AS age_raw) FROM feed "
        f"WHERE {condition})",
    )


def _place(*order: str) -> str:
    """The place of a row in a report: lowest first, no value before all."""
    keys = ", ".join(f"{column} NULLS FIRST" for column in order)
    return f"CAST(row_number() OVER (ORDER BY {keys}) AS INTEGER) AS place"


_NUMBER = "CAST(substr(fileno, 5) AS BIGINT)"
_MALFORMED = f"({_NUMBER} % 41 = 0 OR {_NUMBER} % 43 = 1 OR {_NUMBER} % 47 = 2)"
_MALFORMED_LINE = f"""CASE WHEN {_NUMBER} % 41 = 0 THEN concat_ws(',', {_RAW}, 'tenth')
  WHEN {_NUMBER} % 43 = 1 THEN concat_ws(',', fileno, applicant, age_raw, branch)
  ELSE concat_ws(',', fileno, concat('"', applicant), {_RAW.split(", ", 2)[2]}) END"""


def _well_formed(step: str) -> str:
    """The chain up to ``step`` over the feed's records as read from files with
    malformed lines."""
    return _with(step).replace(
        "FROM feed",
        f"FROM (SELECT * REPLACE (nullif(age_raw, '') AS age_raw) FROM feed WHERE NOT {_MALFORMED})",
    )


ORACLE: dict[str, str] = {
    "src_csv": _with("feed") + f"SELECT {_CSV_RAW} FROM feed",
    "src_view": _with("feed") + "SELECT fileno, branch, course_date_raw FROM feed",
    "src_table": _with("silver") + "SELECT * FROM silver",
    "sink_replace": _with("silver") + "SELECT * FROM silver",
    "sink_append": _with("report")
    + "SELECT * FROM report UNION ALL SELECT * REPLACE ('run-0' AS run_id, '2024-08-01 12:00:00' AS run_ts, NULL AS pass_rate) FROM report",
    "clean_headers": _with("feed") + f"SELECT {_RAW} FROM feed",
    "header_tags": _with("feed")
    + "SELECT 'fileno' AS \"column\", 'CONFIDENTIAL' AS tag, count(fileno) AS filled_rows FROM feed "
    "UNION ALL SELECT 'applicant', 'PII', count(applicant) FROM feed",
    "safe_cast": _with("typed")
    + "SELECT fileno, number_of_days, days_attended, days_absent FROM typed",
    "star_except": _with("silver") + "SELECT * EXCLUDE (applicant) FROM silver",
    "split_quarantine": _with("silver", "rejects")
    + "SELECT fileno, CAST(NULL AS VARCHAR) AS reject_reason FROM silver "
    "UNION ALL SELECT fileno, reject_reason FROM rejects",
    "rejects": _with("rejects") + "SELECT * FROM rejects",
    "pred_range": _with("typed")
    + f"SELECT fileno, age_raw FROM typed WHERE {_int('age_raw')} BETWEEN 16 AND 100",
    "pred_null": _with("typed")
    + "SELECT fileno, number_of_days IS NULL AS days_missing, "
    "days_attended IS NOT NULL AS attended_present FROM typed",
    "pred_regex": _with("feed")
    + "SELECT fileno, course_date_raw FROM feed WHERE regexp_full_match(course_date_raw, '[0-9]{4,6}')",
    "parse_dates": _with("dated") + "SELECT fileno, course_date_raw, course_date FROM dated",
    "validate_age": _with("feed")
    + f"""SELECT fileno, age_raw, CASE WHEN age BETWEEN 16 AND 100 THEN age END AS age_clean,
  coalesce(age BETWEEN 16 AND 100, false) AS is_age_valid
FROM (SELECT *, {_int('age_raw')} AS age FROM feed)""",
    "flag_mismatch": _with("typed")
    + """SELECT fileno, number_of_days, days_attended, days_absent,
  number_of_days IS NULL OR days_attended IS NULL OR days_absent IS NULL
    OR days_attended + days_absent <> number_of_days AS dq_days_mismatch FROM typed""",
    "dedup_exact": _with("typed") + f"SELECT DISTINCT {_RAW} FROM typed",
    "dedup_latest": _with("staged") + f"SELECT {_RAW}, course_date FROM staged",
    "fold_versions": _with("staged") + "SELECT * FROM staged",
    "silver_records": _with("silver") + "SELECT * FROM silver",
    "rate": _with("gold") + "SELECT fileno, attendance_rate FROM gold",
    "band": _with("gold") + "SELECT fileno, attendance_band FROM gold",
    "gold_records": _with("gold") + "SELECT * FROM gold",
    "gold_by_branch": _with("by_branch") + "SELECT * FROM by_branch",
    "gold_by_course": _with("by_course") + "SELECT * FROM by_course",
    "gold_by_branch_strict": _with("silver") + _weighted("branch", "WHERE NOT dq_days_mismatch"),
    "q1_weighted": _with("by_branch")
    + f"SELECT branch, attendance_rate, num_records, {_place('attendance_rate', 'branch')} FROM by_branch",
    "q1_simple_mean": _with("gold")
    # The mean in ten-thousandths, rounded half up in integers.
    + f"""SELECT *, {_place('avg_attendance_rate', 'branch')} FROM (
SELECT branch, CASE WHEN n > 0 THEN ((2 * total + n) // (2 * n)) / 10000.0::DOUBLE END AS avg_attendance_rate,
  num_records
FROM (SELECT branch, count(*) AS num_records, count(attendance_rate) AS n,
        CAST(sum(CAST(round(attendance_rate * 10000) AS BIGINT)) AS BIGINT) AS total
      FROM gold GROUP BY branch))""",
    "row_counts": _with("totals")
    + """SELECT rows_in, after_exact AS rows_after_exact_dedup, after_key AS rows_after_key_dedup,
  (SELECT count(*) FROM staged WHERE course_date IS NOT NULL) AS rows_curated,
  (SELECT count(*) FROM staged WHERE course_date IS NULL) AS rows_quarantined FROM totals""",
    "cond_agg": _with("staged")
    + """SELECT count(*) FILTER (WHERE is_age_valid) AS valid_ages,
  count(*) FILTER (WHERE NOT is_age_valid) AS other_ages,
  count(*) FILTER (WHERE dq_days_mismatch) AS mismatches FROM staged""",
    "rule_catalogue": _with("rule_lines")
    + "SELECT rule_name, severity, rule_note, rows_evaluated > 0 AS used FROM rule_lines",
    "dq_eval": _with("rule_lines")
    + "SELECT rule_name, rows_evaluated, rows_passed, rows_evaluated - rows_passed AS rows_failed FROM rule_lines",
    "dq_clean": _with("staged")
    + "SELECT fileno, course_date, age_clean FROM staged WHERE "
    + " AND ".join(f"(NOT ({applies}) OR ({passes}))" for _, _, _, applies, passes in _RULES),
    "dq_dedup_exact": _with("report")
    + "SELECT rule_name, rows_in, rows_evaluated, rows_passed, rows_failed FROM report "
    f"WHERE rule_name = '{fixed.EXACT_RULE[0]}'",
    "dq_dedup_key": _with("report")
    + "SELECT rule_name, rows_in, rows_evaluated, rows_passed, rows_failed FROM report "
    f"WHERE rule_name = '{fixed.KEY_RULE[0]}'",
    "dq_report": _with("report") + "SELECT * FROM report",
    "sort_report": _with("report") + f"SELECT *, {_place('severity', 'rule_name')} FROM report",
    "pass_rate": _with("report") + "SELECT rule_name, pass_rate FROM report",
    "dq_log": _with("report")
    + "SELECT * FROM report UNION ALL "
    "SELECT * REPLACE ('run-0' AS run_id, '2024-08-01 12:00:00' AS run_ts) FROM report",
    "dq_alerts": _with("report")
    + "SELECT run_ts, rule_name, severity, rows_evaluated, rows_failed, pass_rate, "
    f"{_place('severity', 'pass_rate', 'rule_name')} FROM report WHERE {_ALERTS}",
    "expectations": _with("staged")
    + "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS expectation, '{action}' AS on_failure,
  count(*) FILTER (WHERE {cond}) AS passed_rows,
  count(*) - count(*) FILTER (WHERE {cond}) AS failed_rows FROM staged"""
        for name, action, cond in (
            ("course_date_parseable", "drop", "course_date IS NOT NULL"),
            ("days_reconcile", "keep", "days_attended + days_absent = number_of_days"),
            ("age_in_range_16_100", "keep", "is_age_valid"),
        )
    ),
    "expectations_kept": _with("staged")
    + "SELECT fileno, course_date, is_age_valid FROM staged WHERE course_date IS NOT NULL",
    "build_docs": _with("doc_texts") + "SELECT * FROM doc_texts",
    "pii_exclude": _with("doc_texts")
    + """SELECT count(*) AS documents,
  count(*) FILTER (WHERE contains(concat(text, to_json(t)), applicant)) AS documents_with_name
FROM doc_texts t JOIN (SELECT fileno, applicant FROM gold) ON doc_id = fileno""",
    "cite": _with("docs") + f"SELECT doc_id, {_CITATION} AS citation FROM docs",
    "embed": _vec_text("documents", "documents"),
    "embed_gold": _vec_text("gold", "docs"),
    "cosine": _with("anchors")
    + f"SELECT vec_id, anchor_id, round({_DOT.format('embedding', 'anchor')}, 4) AS score "
    "FROM embeddings JOIN anchors USING (label)",
    "topk": _with("anchors") + _topk(_ANCHOR_QUESTIONS),
    "topk_blocks": _topk("SELECT vec_id AS question_id, embedding AS vec FROM embeddings"),
    "topk_ann": _topk("SELECT vec_id AS question_id, embedding AS vec FROM embeddings"),
    "retrieval_groups": _with("anchors")
    + "\nUNION ALL\n".join(
        "SELECT * FROM (" + _topk(
            f"SELECT '{reader}:' || anchor_id AS question_id, anchor AS vec FROM anchors",
            f"(SELECT * FROM embeddings WHERE {seen})",
        ) + ")"
        for reader, seen in (("few", "label < 3"), ("even", "label IN (0, 2, 4, 6, 8)"), ("all", "true"))
    ),
    "retrieval_acl": _with("anchors")
    + _topk(
        _ANCHOR_QUESTIONS,
        "(SELECT * FROM embeddings WHERE label IN (SELECT r_regionkey FROM region))",
    ),
    "intent": _with("question_intents") + "SELECT question, intent FROM question_intents",
    "qa_batch": _with("answers") + "SELECT question, answer, grounded, top_score, sources FROM answers",
    "refuse": _with("answers")
    + "SELECT question, answer, top_score, CAST(0 AS INTEGER) AS n_sources FROM answers WHERE NOT grounded",
    "compose_lookup": _with("all_answers")
    + "SELECT question, answer, sources FROM all_answers WHERE intent = 'lookup'",
    "compose_min": _with("all_answers")
    + "SELECT question, answer, sources FROM all_answers WHERE intent = 'lowest'",
    "compose_max": _with("all_answers")
    + "SELECT question, answer, sources FROM all_answers WHERE intent = 'highest'",
    "answer_row": _with("answers")
    + "SELECT question, grounded, top_score, CAST(CASE WHEN grounded THEN 1 ELSE 0 END AS INTEGER) AS n_sources "
    "FROM answers",
    "superlative_full": _with("all_answers") + "SELECT question, answer FROM all_answers WHERE k IS NULL",
    "calibrate": _with("answers")
    + """SELECT low AS lowest_answerable, high AS highest_unanswerable, high >= low AS bands_overlap,
  CASE WHEN high < low THEN (low + high) / 2 END AS suggested_threshold
FROM (SELECT min(top_score) FILTER (WHERE answerable) AS low,
             max(top_score) FILTER (WHERE NOT answerable) AS high FROM answers)""",
    "mask_pii": _with("silver")
    + f"SELECT * REPLACE ('{fixed.MASK_TEXT}' AS applicant) FROM silver",
    "mask_view": _with("silver")
    + f"SELECT * REPLACE ('{fixed.MASK_TEXT}' AS applicant) FROM silver",
    "mask_by_row": _with("silver")
    + f"SELECT * REPLACE (CASE WHEN branch = 'NATION_2' THEN applicant ELSE '{fixed.MASK_TEXT}' END "
    "AS applicant) FROM silver",
    "tag_columns": _with("silver")
    + _tagged(("fileno", "CONFIDENTIAL"), ("applicant", "PII"), ("age_raw", "PII")),
    "layer_ns": _with("silver", "rejects", "by_branch", "by_course", "report")
    + """SELECT 'silver.training' AS "table", count(*) AS rows FROM silver
UNION ALL SELECT 'silver.training_rejects', count(*) FROM rejects
UNION ALL SELECT 'gold.training_records', count(*) FROM silver
UNION ALL SELECT 'gold.attendance_by_branch', count(*) FROM by_branch
UNION ALL SELECT 'gold.attendance_by_course', count(*) FROM by_course
UNION ALL SELECT 'governance.dq_run_log', count(*) FROM report""",
    "cluster_write": _with("silver") + "SELECT * FROM silver",
    "compact": "SELECT * FROM lineitem",
    "compact_packed": "SELECT * FROM lineitem",
    "stream_bronze": _with("feed") + f"SELECT {_CSV_RAW} FROM feed",
    "stream_silver": _with("silver") + f"SELECT {_CSV_SILVER} FROM silver",
    "stream_merged": _with("silver") + f"SELECT {_CSV_SILVER} FROM silver",
    "stream_dq": _batch_lines(),
    "rejects_malformed": _well_formed("rejects")
    + f"""SELECT *, CAST(NULL AS VARCHAR) AS record FROM rejects UNION ALL BY NAME
SELECT 'malformed_record' AS reject_reason, {_MALFORMED_LINE} AS record FROM feed WHERE {_MALFORMED}""",
    "dq_malformed": _well_formed("report")
    + f"""SELECT * EXCLUDE (dataset) REPLACE (rows_in + (SELECT count(*) FROM feed WHERE {_MALFORMED}) AS rows_in) FROM report
UNION ALL BY NAME SELECT *, round(rows_passed / rows_evaluated, 4) AS pass_rate FROM (
  SELECT '{fixed.MALFORMED_RULE[0]}' AS rule_name, '{fixed.MALFORMED_RULE[1]}' AS severity, '{fixed.MALFORMED_RULE[2]}' AS rule_note,
    (SELECT any_value(run_id) FROM report) AS run_id, (SELECT any_value(run_ts) FROM report) AS run_ts,
    count(*) AS rows_in, count(*) AS rows_evaluated,
    count(*) FILTER (WHERE NOT {_MALFORMED}) AS rows_passed, count(*) FILTER (WHERE {_MALFORMED}) AS rows_failed FROM feed)""",
    "stream_malformed": _with("feed")
    + f"""SELECT * EXCLUDE (bad) FROM (
  SELECT concat('batch-', least(version, 1)) AS run_id, 'malformed_record' AS reject_reason, {_MALFORMED_LINE} AS record,
    {_MALFORMED} AS bad, count(*) OVER (PARTITION BY least(version, 1)) AS rows_in,
    count(*) FILTER (WHERE {_MALFORMED}) OVER (PARTITION BY least(version, 1)) AS rows_failed FROM feed) WHERE bad""",
}
