"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from rillflow.llm.quality_rules import RULES, STOP_WORDS

BLANK_CLASS = r"[\x20\x09-\x0D]"

OP6 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT CAST(-1 AS BIGINT), CAST(n AS BIGINT), r, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)
), marked AS (
  SELECT *, role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text)
    AND lag(turn) OVER w IS NOT NULL AS joined
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length(replace(text, '<|', '<||'))
    + CASE WHEN joined THEN length('<|im_sep|>')
      ELSE length('<|im_start|>') + length(replace(role, '<|', '<||')) + 1 + length('<|im_end|>') + 1 END)
    AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


def _rule(rule) -> str:
    top, scale = rule.numerator, 10_000
    bottom = "1" if rule.denominator is None else rule.denominator
    checks = []
    if rule.low is not None:
        checks.append(f"{top} * {scale} >= {bottom} * {round(rule.low * scale)}")
    if rule.high is not None:
        checks.append(f"{top} * {scale} <= {bottom} * {round(rule.high * scale)}")
    both = " AND ".join(checks)
    return f"({both})" if rule.denominator is None else f"({bottom} = 0 OR ({both}))"


_STOP = ", ".join(
    f"'{x}'" for x in sorted({w for s in STOP_WORDS.split() for w in (s, s.capitalize())})
)

OP8 = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT *, list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' ')) AS g
  FROM split
), twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY row, gram) AS n FROM (
      SELECT doc_id, row, unnest(g) AS gram, unnest(range(1, len(g) + 1)) AS i
      FROM (SELECT doc_id, g, row_number() OVER () AS row FROM grams)))
  WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n_repeat_words FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice)
  GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS n_capitals,
    len(list_filter(words, lambda w: w IN ({_STOP}))) AS n_stop_words
  FROM grams LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  {" AND ".join(_rule(r) for r in RULES)} AS kept
FROM measured
"""

OP11 = r"""
WITH table_of AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), target AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), own AS (
  SELECT row, f, count(*) AS n FROM (
    SELECT row, unnest(w) AS f FROM docs UNION ALL
    SELECT row, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM docs) GROUP BY ALL
), wanted AS (
  SELECT f, count(*) AS n FROM (
    SELECT unnest(w) AS f FROM target UNION ALL
    SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM target) GROUP BY ALL
), hexed AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM own UNION SELECT f FROM wanted)
), placed AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
      lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8))) % 10000 AS bucket
  FROM hexed, table_of
), s AS (SELECT bucket, sum(n) AS s FROM own JOIN placed USING (f) GROUP BY bucket
), t AS (SELECT bucket, sum(n) AS t FROM wanted JOIN placed USING (f) GROUP BY bucket
), gains AS (
  SELECT b AS bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
), sums AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS HUGEINT) AS total
  FROM own JOIN placed USING (f) JOIN gains USING (bucket) GROUP BY row
), scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features,
    CAST(CASE WHEN n_features IS NULL THEN 0
      ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS BIGINT) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:8] AS BIGINT) + 0.5)
      / 4294967296))) AS BIGINT) AS noise
  FROM docs LEFT JOIN sums USING (row)
), numbered AS (
  SELECT *, weight + noise AS score, row_number() OVER (ORDER BY words < 20, weight + noise DESC, doc_id) AS r,
    (count(*) FILTER (WHERE words >= 20) OVER ()) * 25 // 100 AS k FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank FROM numbered
"""

OP12 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), seen AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(w) AS term FROM texts) GROUP BY ALL
), kept AS (SELECT lang, term, sum(n) AS n FROM seen GROUP BY ALL HAVING count(*) >= 3
), v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (SELECT s.lang, source, term, sum(s.n) AS n FROM seen s JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(v, 0) AS v, coalesce(v.total, 0) AS all_total
  FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN totals t USING (lang, source) LEFT JOIN v ON v.lang = g.lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (g.all_total + g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM items)
WHERE part = 'pair' OR r <= 200
"""

ORACLES = {
    "op11_importance_resampling": OP11,
    "op12_source_divergence": OP12,
    "op6_chat_format": OP6,
    "op8_quality_rules": OP8,
}
