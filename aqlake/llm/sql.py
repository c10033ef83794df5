"""DuckDB SQL for the registered llm queries that SQL can express."""

LINE_DEDUP = r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM parts),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, pos, line, c.k IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN common c USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

DECONTAMINATE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bp AS (
  SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM bp),
dp AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s FROM dp),
hit AS (SELECT doc_id, dw.n, p, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

def _url_filter(levels: int = 3) -> str:
    steps = []
    for k in range(levels + 1):
        segment = f"segments[{k + 1}]"
        if k == levels:
            segment = f"CASE WHEN len(segments) > {k} THEN array_to_string(segments[{k + 1}:], '/') END"
        steps.append(f"""
g{k} AS (SELECT *, {segment} AS segment FROM t{k}),
b{k} AS (SELECT host, template, segment, sum(n) AS n, sum(blocked) AS blocked, sum(allowed) AS allowed
  FROM g{k} WHERE segment IS NOT NULL GROUP BY ALL),
n{k} AS (SELECT host, template, count(*) AS kinds, sum(n) AS all_n,
  (sum(blocked) + 1.0::DOUBLE) / (sum(blocked) + sum(allowed) + 2.0::DOUBLE) AS p FROM b{k} GROUP BY ALL),
d{k} AS (SELECT host, template, segment, CASE WHEN kinds >= 8 AND kinds * 2 >= all_n
    OR abs((blocked + 1.0::DOUBLE) / (blocked + allowed + 2.0::DOUBLE) - p)
      <= sqrt(p * (1.0::DOUBLE - p) / (blocked + allowed + 2.0::DOUBLE)) THEN '*' ELSE segment END AS name
  FROM b{k} JOIN n{k} USING (host, template)),
t{k + 1} AS (SELECT host, path, n, blocked, allowed, template || coalesce('/' || name, '') AS template, segments
  FROM g{k} LEFT JOIN d{k} USING (host, template, segment))""")
    return r"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM r),
u AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM h),
j AS (SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u),
t0 AS (SELECT host, path, count(*) AS n, count(*) FILTER (rule IN ('net/', 'example.com/de/')) AS blocked,
    count(*) FILTER (rule IN ('example.net/en/', 'org/fr/')) AS allowed, '' AS template,
    string_split(regexp_replace(path, '^/', ''), '/') AS segments FROM j GROUP BY host, path),""" + ",".join(steps) + f""",
pure AS (SELECT host, template, (sum(blocked) + 1.0::DOUBLE) / (sum(blocked) + sum(allowed) + 2.0::DOUBLE) AS purity
  FROM t{levels + 1} GROUP BY ALL)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN purity >= 0.9 THEN 'block' ELSE 'allow' END AS verdict
FROM j JOIN t{levels + 1} USING (host, path) JOIN pure USING (host, template)
"""

NEAR_TEXTS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT node, b FROM reach JOIN links ON other = a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN least ON doc_id = node
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id, CAST(list_inner_product(a.x, o.x) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


ORACLE = {
    "op3_url_filter": _url_filter(),
    "op5_line_dedup": LINE_DEDUP,
    "op6_decontaminate": DECONTAMINATE,
    "op11_minhash": NEAR_TEXTS,
    "op13_hard_negatives": HARD_NEGATIVES,
}
