"""DuckDB SQL of the queries that SQL can express over whole tables."""

_WS = r"[\x20\x09-\x0D]"

ORACLE: dict[str, str] = {}

ORACLE["op2_exact_dedup"] = rf"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '{_WS}', '', 'g') AS k FROM documents
), g AS (
  SELECT doc_id, k, count(*) OVER (PARTITION BY k) AS group_size,
         first_value(doc_id) OVER (PARTITION BY k ORDER BY length(t) DESC, doc_id) AS keep_id FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM g
"""

ORACLE["op9_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.doc_id, k.pos, k.line, f.owner IS NOT NULL AND f.owner <> k.doc_id AS gone FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
ORACLE["op10_warc"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), d AS (
  SELECT page_id, h, list_aggregate(list_transform(range(32), lambda i: substr({_B32}, (
           (('0x' || substr(x, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)),
           'string_agg', '') AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS owner FROM p
)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM d
"""

def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds of assignment and replacement as a chain of common table expressions."""
    ctes = [f"""x AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, part,
         list_transform(embedding[part * len(embedding) // {parts} + 1 : (part + 1) * len(embedding) // {parts}],
                        lambda c: floor(1024 * c::DOUBLE)) AS v
  FROM embeddings, (SELECT unnest(range({parts})) AS part)
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)""", f"""e0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS i, v AS e FROM x
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries}
)"""]
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, label, x.part, v, arg_min({{'i': i, 'd': d}}, {{'d': d, 'i': i}}) AS b
  FROM (SELECT x.*, i, list_inner_product(v, v) - 2 * list_inner_product(v, e) + list_inner_product(e, e) AS d
        FROM x JOIN e{k} USING (part)) x GROUP BY ALL
)""")
        if k < rounds:
            ctes.append(f"""e{k + 1} AS MATERIALIZED (
  SELECT part, i, coalesce(n.e, o.e) AS e FROM e{k} o LEFT JOIN (
    SELECT part, i, list(floor(s / n) ORDER BY pos) AS e FROM (
      SELECT part, b.i AS i, pos, sum(v[pos]) AS s, count(*) AS n
      FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM x) + 1)) AS pos) GROUP BY ALL) GROUP BY ALL
  ) n USING (part, i)
)""")
    return f"""WITH {', '.join(ctes)}, c AS (
  SELECT vec_id, label, string_agg(printf('%02x', b.i), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id, label
), h AS (
  SELECT sha256(string_agg(array_to_string(list_transform(e, lambda z: z::BIGINT), ','), ',' ORDER BY part, i)) AS s
  FROM e{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
FROM c, h"""


ORACLE["op11_vector_codes"] = _vector_codes()

ORACLE["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS MATERIALIZED (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS MATERIALIZED (
  SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30
), g AS MATERIALIZED (
  SELECT lang, source FROM d GROUP BY ALL
), v AS (
  SELECT lang, count(*) AS v FROM k GROUP BY ALL
), c AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n
  FROM g JOIN k USING (lang) LEFT JOIN (
    SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) o USING (lang, source, term)
), p AS MATERIALIZED (
  SELECT lang, source, term, n,
         1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
         1 + (1000000000 * (sum(n) OVER (PARTITION BY lang, term) + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM c JOIN v USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(max(f), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source AS s, y.source AS t, sum(abs(x.p - y.p)) AS f
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) z
  ON z.lang = a.lang AND z.s = a.source AND z.t = b.source GROUP BY ALL
), u AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM u
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50
"""

ORACLE["op13_fingerprints"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), n AS (
  SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id, t), first_value(t) OVER (ORDER BY doc_id, t)) AS f FROM t
), e AS (
  SELECT doc_id, t, f, left(t, length(t) - length(t) // 2) || left(f, length(t) // 2) AS c FROM n
), h AS (
  SELECT doc_id, t, c, list_transform([t, c, f], lambda x: list_transform(
           [list_filter(string_split_regex(x, '[ 	-]+'), lambda y: y <> '')], lambda y: list_transform(
             CASE WHEN len(y) = 0 THEN [] ELSE range(1, greatest(len(y) - 4, 1) + 1) END,
             lambda i: md5(array_to_string(y[i:i + 4], ' '))))[1]) AS a FROM e
), s AS (
  SELECT doc_id, t, c, list_transform(a, lambda x: list_sort(list_distinct(list_transform(
           CASE WHEN len(list_filter(x, lambda y: y < '4000')) > 0 THEN list_filter(x, lambda y: y < '4000')
                WHEN len(x) > 0 THEN [list_min(x)] ELSE [] END, lambda y: left(y, 16))))) AS a FROM h
), l AS (
  SELECT *, len(list_intersect(a[1], a[2])) AS b2, len(list_intersect(a[1], a[3])) AS b3 FROM s
)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(c) AS edited_sha256, array_to_string(a[1], ' ') AS fingerprint,
       array_to_string(a[2], ' ') AS edited_fingerprint,
       CASE WHEN len(a[1]) + len(a[2]) = 0 THEN 1.0::DOUBLE ELSE b2::DOUBLE / (len(a[1]) + len(a[2]) - b2) END AS near_edited,
       CASE WHEN len(a[1]) + len(a[3]) = 0 THEN 1.0::DOUBLE ELSE b3::DOUBLE / (len(a[1]) + len(a[3]) - b3) END AS near_next,
       CASE WHEN len(a[1]) = 0 THEN 1.0::DOUBLE ELSE b2::DOUBLE / len(a[1]) END AS held_edited,
       CASE WHEN len(a[1]) = 0 THEN 1.0::DOUBLE ELSE b3::DOUBLE / len(a[1]) END AS held_next
FROM l
"""
