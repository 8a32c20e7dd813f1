"""SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op2_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

SQL["op7_source_mixture"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('7:' || CAST(doc_id AS VARCHAR) || ':' || coalesce(text, '')), 1, 15)
              AS BIGINT) AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
         (SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE AS total
  FROM s
), l AS (
  SELECT a.ratio,
         (max(a.total) - coalesce(sum(CASE WHEN b.ratio < a.ratio THEN 2.0::DOUBLE * b.source_size END), 0.0::DOUBLE))
         / sum(CASE WHEN b.ratio >= a.ratio THEN b.weight END) AS level
  FROM r a, r b GROUP BY a.ratio
), w AS (
  -- The first ratio whose level it doesn't fall below: all sources before it are clamped.
  SELECT coalesce((SELECT level FROM l WHERE level <= ratio ORDER BY ratio LIMIT 1), 1e300) AS level
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * level) AS target FROM r, w
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM t
), c AS (
  SELECT d.*, source_size, target, whole, target - whole * source_size AS part,
         sum(size) OVER (PARTITION BY d.source ORDER BY u) AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), e0 AS (
  SELECT source, CAST([] AS BIGINT[]) AS fillers, max(part) - coalesce(max(CASE WHEN upto <= part THEN upto END), 0) AS gap,
         coalesce(max(CASE WHEN upto <= part THEN u END), -1) AS edge
  FROM c WHERE size > 0 GROUP BY source
)@FILLERS@
SELECT c.doc_id, c.size, c.source_size, c.target,
       CAST(CASE WHEN c.size = 0 THEN 0
                 ELSE c.size * (c.whole + CASE WHEN c.u <= e.edge OR list_contains(e.fillers, c.u) THEN 1 ELSE 0 END)
            END AS BIGINT) AS taken
FROM c LEFT JOIN e5 e ON c.source IS NOT DISTINCT FROM e.source
"""

# One more document of the size nearest to what is missing, five times.
_FILLER = r""", n{k} AS (
  SELECT source, u, size FROM (
    SELECT c.source, c.u, c.size,
           row_number() OVER (PARTITION BY c.source ORDER BY abs(c.size - e.gap), c.u) AS k
    FROM c JOIN e{before} e ON c.source IS NOT DISTINCT FROM e.source
    WHERE c.size > 0 AND c.u > e.edge AND NOT list_contains(e.fillers, c.u)
      AND abs(c.size - e.gap) < e.gap
  ) WHERE k = 1
), e{k} AS (
  SELECT e.source, CASE WHEN n.u IS NULL THEN e.fillers ELSE list_append(e.fillers, n.u) END AS fillers,
         e.gap - coalesce(n.size, 0) AS gap, e.edge
  FROM e{before} e LEFT JOIN n{k} n ON e.source IS NOT DISTINCT FROM n.source
)"""
SQL["op7_source_mixture"] = SQL["op7_source_mixture"].replace(
    "@FILLERS@", "".join(_FILLER.format(k=k, before=k - 1) for k in range(1, 6))
)

# A line is boilerplate if at least 5 sites have it; the sketches only save work.
SQL["op4_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), l AS (
  SELECT doc_id, source, unnest(parts) AS raw, unnest(range(1, len(parts) + 1)) AS place FROM d
), t AS (
  SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM l
), b AS (
  SELECT line FROM t WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 5
), j AS (
  SELECT t.*, b.line IS NOT NULL AS cut FROM t LEFT JOIN b ON t.line = b.line
), g AS (
  SELECT doc_id, CAST(sum(CASE WHEN line <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n_lines,
         CAST(sum(CASE WHEN cut THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT cut), '') AS clean
  FROM j GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, CAST(length(clean) AS BIGINT) AS n_chars_left,
       sha256(clean) AS text_sha256
FROM g
"""


# Spans from the lengths of matches and of what lies between them. There is no look-behind here:
# runs are matched greedily from their start anyway, and what comes before an identifier is matched
# and taken off again. ``extra`` is what is measured or taken off.
_FOUND = r"""
  SELECT doc_id, {kind} AS kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m,
         unnest(list_slice(g, 1, len(m))) AS g, unnest(x) AS extra
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g,
               regexp_extract_all(t, '{pattern}', {group}) AS x FROM d)"""
_QUOTE = '["\'\']?'
_PATTERNS = (
    (rf"(?i)(password|passwd|secret|token|api_?key){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)", 2),
    ("AKIA[A-Z0-9]{12,}", 0),
    ("[0-9a-f]{32,}", 0),
    (
        rf"(?i)(^|[^a-z0-9])(?:client_id|account_id|account|key_id|access_key_id|user_?name|user|login)"
        rf"{_QUOTE}\x20*[:=]\x20*{_QUOTE}[a-z0-9@._+-]{{3,}}", 1,
    ),
    ("[A-Za-z0-9+/=_-]{20,}", 0),
    (r"""https?://[^\x20\x09-\x0D"''<>]+""", 0),
)
SQL["op6_secret_scan"] = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), raw AS ("
    + " UNION ALL ".join(
        _FOUND.format(kind=k, pattern=p, group=g) for k, (p, g) in enumerate(_PATTERNS)
    )
    + r"""
), placed AS (
  SELECT doc_id, kind, m, extra,
         sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) - length(m) AS s
  FROM raw
), spans AS (
  SELECT doc_id, kind, m, CAST(s + CASE WHEN kind = 3 THEN length(extra) ELSE 0 END AS BIGINT) AS s,
         CAST(s + length(m) AS BIGINT) AS e,
         CASE WHEN kind IN (1, 3) THEN 'identifier' WHEN kind = 5 THEN 'endpoint' ELSE 'secret' END AS role
  FROM placed
  WHERE (kind <> 0 OR length(extra) >= 8)
    AND (kind <> 4 OR (regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')))
), covered AS (
  SELECT DISTINCT k.doc_id, k.s FROM spans k JOIN spans o
    ON o.doc_id = k.doc_id AND o.kind <> 4 AND o.s < k.e AND k.s < o.e
  WHERE k.kind = 4
), parts AS (
  SELECT p.* FROM spans p LEFT JOIN covered c ON p.kind = 4 AND c.doc_id = p.doc_id AND c.s = p.s
  WHERE c.s IS NULL
), near AS (
  SELECT p.doc_id, p.kind, p.s, p.e, p.role,
         max(CASE WHEN o.role = 'identifier' THEN 1 ELSE 0 END) AS i,
         max(CASE WHEN o.role = 'secret' THEN 1 ELSE 0 END) AS k,
         max(CASE WHEN o.role = 'endpoint' THEN 1 ELSE 0 END) AS n
  FROM parts p JOIN parts o ON o.doc_id = p.doc_id AND o.role <> p.role
    AND p.s - o.e <= 200 AND o.s - p.e <= 200
  WHERE p.kind >= 3 GROUP BY p.doc_id, p.kind, p.s, p.e, p.role
), told AS (
  SELECT doc_id, kind, s, e FROM parts WHERE kind < 3
  UNION ALL
  SELECT doc_id, kind, s, e FROM near
  WHERE CASE role WHEN 'secret' THEN i + n > 0 WHEN 'identifier' THEN k > 0 ELSE i + k = 2 END
), named AS (
  SELECT *, list_extract(['assign', 'access', 'hex', 'ident', 'key', 'endpoint'], kind + 1)
            || ':' || s || ':' || e AS span
  FROM told
), per AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
         count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, kind, e) FILTER (WHERE kind < 3) AS base,
         string_agg(span, ',' ORDER BY s, kind, e) AS spans
  FROM named GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per ON per.doc_id = d.doc_id
"""
)


def _centroid_rounds(rounds: int) -> str:
    """Each round assigns all vectors (a0, a1, ...) and makes the centroids of the next one."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT row_no, arg_min(k, s * 100 + k) AS cluster, min(s) AS distance
  FROM (SELECT v.row_no, c.k, CAST(list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS BIGINT) AS s
        FROM v, c{r} c)
  GROUP BY row_no
)""")
        parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x
  FROM c{r} c LEFT JOIN (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS x
    FROM (SELECT a.cluster, i, CAST(sum(v.x[i]) AS BIGINT) AS total, count(*) AS n
          FROM a{r} a JOIN v USING (row_no), range(1, 65) AS t(i) GROUP BY a.cluster, i)
    GROUP BY cluster
  ) m ON m.cluster = c.k
)""")
    return ",\n".join(parts[:-1])


SQL["op11_centroid_clusters"] = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, x, row_number() OVER () AS row_no
  FROM (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64)
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY drawn NULLS LAST, x) - 1 AS k, x
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS drawn, x FROM v ORDER BY drawn NULLS LAST, x LIMIT 8)
), {_centroid_rounds(10)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform(c10.x, lambda e: CAST(e AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a10 JOIN v USING (row_no) JOIN c10 ON c10.k = cluster
"""
