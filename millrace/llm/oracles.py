"""DuckDB SQL for the queries of this folder that SQL can express, from their definitions."""

SQL: dict[str, str] = {}

SQL["op1_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, html,
         CASE WHEN contains(url, '://') THEN translate(
           regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN
           regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
),
listed AS (
  SELECT DISTINCT host || path AS key FROM parts
  WHERE contains(html, '###') OR contains(html, '***') OR contains(html, '%%%')
     OR contains(html, '$$$') OR contains(html, '&&&')
),
rules(rule, name, start, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'),
  ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'),
  ('net/fr/', 'net', '/fr/', 'block')
),
judged AS (
  SELECT p.*, (
    SELECT max_by(rule, length(rule)) FROM rules r
    WHERE (p.host = r.name OR ends_with(p.host, '.' || r.name)) AND starts_with(p.path, r.start)
  ) AS rule FROM parts p
)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(r.verdict, CASE WHEN l.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM judged j LEFT JOIN rules r ON j.rule = r.rule LEFT JOIN listed l ON l.key = j.host || j.path
"""

SQL["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, rn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM (SELECT doc_id, text, row_number() OVER () AS rn FROM documents WHERE text IS NOT NULL)
),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, rn ORDER BY place) AS nth
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
),
windows AS (
  SELECT doc_id, rn, nth, place AS first_place,
         lead(place, 2) OVER w AS last_place,
         [line, lead(line) OVER w, lead(line, 2) OVER w] AS three
  FROM counted WINDOW w AS (PARTITION BY doc_id, rn ORDER BY nth)
),
later AS (
  SELECT doc_id, rn, first_place, last_place FROM (
    SELECT *, rank() OVER (PARTITION BY three ORDER BY doc_id, nth) AS occurrence
    FROM windows WHERE last_place IS NOT NULL)
  WHERE occurrence > 1
),
left_over AS (
  SELECT l.doc_id, l.rn, l.place, l.line FROM lines l
  WHERE NOT EXISTS (SELECT 1 FROM later w WHERE w.doc_id = l.doc_id AND w.rn = l.rn
                    AND l.place BETWEEN w.first_place AND w.last_place)
),
texts AS (
  SELECT doc_id, rn, string_agg(line, chr(10) ORDER BY place) AS kept, count(*) AS n
  FROM left_over GROUP BY doc_id, rn
),
sizes AS (SELECT doc_id, rn, count(*) AS n FROM lines GROUP BY doc_id, rn)
SELECT s.doc_id, s.n AS n_lines, s.n - coalesce(t.n, 0) AS n_removed,
       sha256(coalesce(t.kept, '')) AS kept_sha256
FROM sizes s LEFT JOIN texts t USING (doc_id, rn)
UNION ALL
SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
