"""DuckDB SQL that gives the same rows as the queries that SQL can express.

There is none for op2 (approximate search), op4 (back-off weights), op6 and op7 (fitted models),
op9 (tagged expressions), op10 (label propagation), op11 (places of matches) and op13 (runs of any
period); tests hold these against plain versions.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_ALNUM = f"regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SOLID = f"regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+')"

ORACLES: dict[str, str] = {
    "op1_decontamination": f"""WITH items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + 9] AS k FROM
  (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
places AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
  FROM docs JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n),
hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows v ON p.n = v.n AND p.w[i:i + p.n - 1] = v.k),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)""",
    "op3_mixing": f"""WITH sized AS (SELECT doc_id, source, CAST(len({_SOLID}) AS BIGINT) AS size,
  md5(concat('mix', chr(31), doc_id, chr(31), md5(text))) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
  [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sized GROUP BY source),
-- The level of the shares if the sources that fill up first, as many as there are before, are full.
levels AS (SELECT *, 2 * source_size / weight AS fills_at,
  (sum(source_size) OVER () * 1.5 - coalesce(sum(2 * source_size) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY 2 * source_size / weight, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight *
  (SELECT level FROM levels WHERE fills_at >= level ORDER BY fills_at, source LIMIT 1)) AS target FROM levels),
placed AS (SELECT s.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
  coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed""",
    "op5_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS html,
  sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to FROM g""",
    "op8_jaccard": f"""WITH RECURSIVE docs AS (SELECT doc_id, {_SOLID} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, w[i:i + 4] AS k FROM
  (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.k = b.k AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, top) AS (SELECT doc_id, doc_id FROM docs UNION SELECT edges.b, top FROM reach JOIN edges ON edges.a = node)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(top) FROM reach WHERE node = docs.doc_id) AS component_id
FROM docs LEFT JOIN sizes ON sizes.doc_id = docs.doc_id""",
    "op12_infill": """WITH cut AS (SELECT doc_id, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
  sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, text, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS one,
  CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS other, CAST('0x' || h[17:24] AS BIGINT) % 100 AS rate,
  CAST('0x' || h[25:32] AS BIGINT) % 100 AS turn FROM cut),
parts AS (SELECT doc_id, text, n, array_to_string(u[1:least(one, other)], '') AS prefix,
  array_to_string(u[least(one, other) + 1:greatest(one, other)], '') AS middle,
  array_to_string(u[greatest(one, other) + 1:n], '') AS suffix,
  CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR rate >= 50 THEN 'plain'
    WHEN turn < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN concat('<S>', suffix, '<P>', prefix, '<M>', middle)
    ELSE concat('<P>', prefix, '<S>', suffix, '<M>', middle) END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts""",
}
