"""SQL that says what a contract asks for, for DuckDB over the driver's tables."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_suffix_dedup"] = r"""
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents
), p AS (
  SELECT doc_id, unnest(range(octet_length(h) - 399)) AS pos, h FROM d WHERE octet_length(h) >= 400
), w AS (
  SELECT doc_id, pos, md5(h[pos + 1:pos + 400]) AS k FROM p
), twice AS (
  SELECT doc_id, pos FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)
), m AS (
  SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 400 THEN 0 ELSE 1 END AS new FROM twice
), i AS (
  SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM m
), r AS (
  SELECT doc_id, run, min(pos) AS a, max(pos) + 400 AS b FROM i GROUP BY 1, 2
), g AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r
), k AS (
  SELECT g.doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
    string_agg(hex(h[before + 1:a]), '' ORDER BY a) AS head
  FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY 1
)
SELECT d.doc_id, CAST(octet_length(h) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(CASE WHEN k.doc_id IS NULL THEN h ELSE unhex(head || hex(h[last + 1:octet_length(h)])) END) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

ORACLE_SQL["op4_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(encode(coalesce(html, ''))) AS h FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id,
  CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substring(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first OR page_id IS NULL THEN first END AS refers_to
FROM f
"""

ORACLE_SQL["op9_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), h AS (SELECT doc_id, md5_number(g) AS g FROM s
), n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY 1
), pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM h a JOIN h b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)
), sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (SELECT x, y FROM sym UNION SELECT r.x, b.y FROM reach r JOIN sym b ON r.y = b.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.x = d.doc_id
"""

ORACLE_SQL["op10_lattice"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / a.n / b.n >= 0.93
), reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY 1
), degree AS (SELECT x, count(*) AS k FROM links GROUP BY 1)
SELECT vec_id, coalesce(k, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id, vec_id <= coalesce(c, vec_id) AS kept
FROM v LEFT JOIN degree d ON d.x = vec_id LEFT JOIN comp m ON m.x = vec_id
"""

ORACLE_SQL["op11_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS no FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), s AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INT)) >= 3
), m AS (
  SELECT k.doc_id, no, line, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM top AS goes FROM k LEFT JOIN s ON s.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT goes), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

ORACLE_SQL["op12_fim"] = r"""
WITH x AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), g AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substring(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substring(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substring(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substring(h, 25, 8) AS BIGINT) AS h4 FROM x
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g
), p AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
