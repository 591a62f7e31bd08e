"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# Turn by turn without the template: what is read back must equal what went in.
ORACLE["op3_chat"] = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
), marked AS (
  SELECT *, length(CASE role WHEN 'assistant' THEN '[REPLY]' ELSE '[INST]' || regexp_replace(role, '([\[<\\])', '\1\\', 'g') || '[SAYS]' END)
    + length(regexp_replace(text, '([\[<\\])', '\1\\', 'g')) + length(CASE role WHEN 'assistant' THEN '</s>' ELSE '[/INST]' END) AS size,
    row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), upto AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM marked
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(prefix) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (role = 'assistant') AS BIGINT) AS n_examples
FROM upto GROUP BY conv_id
"""

# CRC-32 byte by byte from its polynomial, once per distinct word.
ORACLE["op11_resample"] = r"""
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS tab
  FROM range(256) r(b)
), texts AS (
  SELECT 0 AS k, row_number() OVER () AS row_, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), features AS (
  SELECT k, row_, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts
), buckets AS (
  SELECT word, xor(4294967295, list_reduce(
      list_transform(range(length(hex(word)) // 2), lambda i: CAST(
        (strpos('0123456789ABCDEF', substr(hex(word), 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hex(word), 2 * i + 2, 1)) - 1 AS BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM features), crc_table
), counted AS (
  SELECT bucket, CAST(count(*) FILTER (k = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (k = 1) AS DOUBLE) AS t
  FROM features JOIN buckets USING (word) GROUP BY bucket
), sums AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counted), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM counted, sums
), weighed AS (
  SELECT row_, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total
  FROM features JOIN buckets USING (word) JOIN gains USING (bucket) WHERE k = 0 GROUP BY row_
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM texts LEFT JOIN weighed USING (row_) WHERE k = 0
), noisy AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM noisy
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM ranked
"""
