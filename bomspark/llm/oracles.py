"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from .quality import RULES, STOP_WORDS

_BLANKS = r"[\x20\x09-\x0D]"


def _rule_sql() -> str:
    tests = []
    for r in RULES:
        bottom = "1.0" if r.denominator == "one" else f"NULLIF({r.denominator}, 0)::DOUBLE"
        ratio = f"{r.numerator}::DOUBLE / {bottom}"
        own = [f"{ratio} >= {r.low}"] * (r.low is not None)
        own += [f"{ratio} <= {r.high}"] * (r.high is not None)
        tests.append(f"COALESCE({' AND '.join(own)}, TRUE)")
    return " AND ".join(tests)


QUALITY = rf"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS uid, COALESCE(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (
  SELECT uid, p, list_slice(words, p, p + 7) AS words8
  FROM (SELECT uid, words, unnest(range(1, len(words) - 6)) AS p FROM w WHERE len(words) >= 8)),
rep AS (
  SELECT uid, p FROM (SELECT uid, p, count(*) OVER (PARTITION BY uid, words8) AS n FROM win)
  WHERE n > 1),
cov AS (
  SELECT uid, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT uid, unnest(range(p, p + 8)) AS q FROM rep) GROUP BY uid),
s AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         COALESCE(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: x IN ({", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS)))})))
           ::BIGINT AS n_stop_words
  FROM w LEFT JOIN cov USING (uid)),
b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_rule_sql()} AS kept
FROM b
"""

URLS = """
WITH rules(host, path, action) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (
  SELECT page_id, row_number() OVER () AS uid,
         CASE WHEN strpos(url, '://') > 0
              THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id, uid,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
hit AS (
  SELECT uid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.action, length(r.host || r.path)) AS action
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host))
                     AND starts_with(u.path, r.path)
  GROUP BY uid)
SELECT page_id, host, path, rule, COALESCE(action, 'allow') AS verdict
FROM u LEFT JOIN hit USING (uid)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(COALESCE(html, ''))::BIGINT AS payload_bytes,
         sha256(COALESCE(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

ORACLE = {"op4_quality_rules": QUALITY, "op7_url_filters": URLS, "op10_warc": WARC}
