"""DuckDB SQL for the registered queries that SQL can express, written apart from the operators."""

from __future__ import annotations

OP3 = """
WITH rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parsed AS (
  SELECT page_id, url,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
urls AS (SELECT DISTINCT url, host, path FROM parsed),
best AS (
  SELECT u.url, max_by(struct_pack(rule := rhost || rpath, verdict := rules.verdict), length(rhost || rpath)) AS b
  FROM urls u JOIN rules ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)
  GROUP BY u.url)
SELECT p.page_id, p.host, p.path, b.rule AS rule,
  CASE WHEN b IS NOT NULL THEN b.verdict
    WHEN regexp_matches(p.host, '(^|[^a-z0-9])(ads|adult|bets|casino|gambling|pills|poker|porn|spam|tracker|viagra|xxx)([^a-z0-9]|$)')
    THEN 'block' ELSE 'allow' END AS verdict
FROM parsed p LEFT JOIN best ON p.url = best.url
"""

# The level of the fill-up is found by trying every number of full sources, not by running sums over an order.
OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat_ws('|', doc_id::VARCHAR, text)) AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM sources),
levels AS (
  SELECT a.source,
    (SELECT 1.5::DOUBLE * sum(source_size) FROM weighted) - coalesce(sum(2.0::DOUBLE * b.source_size) FILTER (2.0::DOUBLE * b.source_size / b.weight < 2.0::DOUBLE * a.source_size / a.weight), 0) AS words,
    (SELECT sum(weight) FROM weighted) - coalesce(sum(b.weight) FILTER (2.0::DOUBLE * b.source_size / b.weight < 2.0::DOUBLE * a.source_size / a.weight), 0) AS weights,
    2.0::DOUBLE * any_value(a.source_size) / any_value(a.weight) AS fill
  FROM weighted a CROSS JOIN weighted b GROUP BY a.source, a.source_size, a.weight),
level AS (SELECT min_by(words / weights, fill) AS l FROM levels WHERE fill > words / weights),
plans AS (
  SELECT source, source_size, weight, least(2.0::DOUBLE * source_size, weight * (SELECT l FROM level)) AS target FROM weighted),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.weight,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source),
taken AS (
  SELECT *, (CASE WHEN size > 0 AND ahead + size / 2.0::DOUBLE < target THEN 1 ELSE 0 END
    + CASE WHEN size > 0 AND source_size + ahead + size / 2.0::DOUBLE < target THEN 1 ELSE 0 END)::BIGINT AS copies,
    ahead / target AS x, (source_size + ahead) / target AS y FROM placed)
SELECT doc_id, size, source_size, target, size * copies AS taken,
  CASE WHEN copies > 0 THEN round(CASE weight WHEN 2 THEN x WHEN 5 THEN (sqrt(0.25 + 2 * x) - 0.5) ELSE 1.5 - sqrt(2.25 - 2 * x) END, 6) END AS first_position,
  CASE WHEN copies > 1 THEN round(CASE weight WHEN 2 THEN y WHEN 5 THEN (sqrt(0.25 + 2 * y) - 0.5) ELSE 1.5 - sqrt(2.25 - 2 * y) END, 6) END AS second_position
FROM taken
"""

SQL = {"op3_url_filter": OP3, "op7_mixing": OP7}
