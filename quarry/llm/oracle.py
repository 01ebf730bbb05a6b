"""DuckDB SQL for the queries of this package that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {}

ORACLE["op1_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.vec, c.vec)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10
"""

ORACLE["op4_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k, md5(coalesce(text, '')) AS tie
  FROM documents
), s AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][CAST((place - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM s
), l AS (
  SELECT *, cap / weight AS ratio,
         (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl,
         row_number() OVER (ORDER BY cap / weight, place) AS i
  FROM w
), f AS (
  SELECT min(i) AS i FROM l WHERE lvl <= ratio
), t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT lvl FROM l JOIN f USING (i)) * weight, cap)) AS target FROM l
), b AS (
  SELECT d.*, t.source_size, t.target, floor(t.target) AS budget,
         CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS passes,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, tie
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size,
       CAST(target AS DOUBLE) AS target,
       CAST(passes * size + greatest(0, least(size, budget - passes * source_size - start)) AS BIGINT) AS taken
FROM b
"""

ORACLE["op5_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
         row_number() OVER (PARTITION BY h, page_id) AS copy
  FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND (page_id > first OR copy > 1) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND (page_id > first OR copy > 1) THEN first END AS refers_to
FROM r
"""

ORACLE["op7_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)
), lens AS (
  SELECT DISTINCT n FROM iw
), dw AS (
  SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)
), hit AS (
  SELECT rid, s, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n
), pos AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid
), its AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

ORACLE["op8_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)
), z AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM p JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)
), r(id, c) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT e.y, r.c FROM r JOIN e ON e.x = r.id WHERE r.c < e.y
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM d LEFT JOIN z USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""

ORACLE["op13_secrets"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS owner, coalesce(text, '') AS t FROM documents
), kinds(k, kind, pat, v) AS (
  VALUES (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
), m AS (
  SELECT rid, owner, t, k, kind, string_split_regex(t, pat) AS p, regexp_extract_all(t, pat) AS m,
         regexp_extract_all(t, pat, v) AS v FROM d, kinds
  UNION ALL SELECT rid, owner, t, 1, 'access', string_split_regex(t, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT rid, owner, t, 2, 'hex', string_split_regex(t, '[0-9a-f]+'),
         regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d
  UNION ALL SELECT rid, owner, t, 3, 'key', string_split_regex(t, '[A-Za-z0-9+/_-]+'),
         regexp_extract_all(t, '[A-Za-z0-9+/_-]+'), regexp_extract_all(t, '[A-Za-z0-9+/_-]+') FROM d
), o AS (
  SELECT rid, owner, t, k, kind, i, length(p[i]) AS gap, m[i] AS m, v[i] AS v
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m)
), s AS (
  SELECT *, sum(gap + length(m)) OVER (PARTITION BY rid, k ORDER BY i) AS e FROM o
), f AS (
  SELECT rid, owner, t, k, kind, e - length(m) AS s, e, v FROM s
  WHERE CASE k WHEN 0 THEN length(v) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN length(m) >= 24
        ELSE length(m) >= 20 AND len(regexp_extract_all(m, '[0-9]')) >= 3 AND regexp_matches(m, '[A-Z]')
             AND regexp_matches(m, '[a-z]') AND NOT regexp_matches(m, '[a-z]{7}|[0-9]{9}|//')
             AND list_aggregate(string_split(m, ''), 'entropy') >= 3.3 END
), g AS (
  SELECT * FROM f WHERE k < 3 OR NOT EXISTS
    (SELECT 1 FROM f b WHERE b.rid = f.rid AND b.k < 3 AND b.s < f.e AND f.s < b.e)
), c AS (
  SELECT v, count(DISTINCT owner) <= 1 AS live FROM g GROUP BY v
), a AS (
  SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3 OR live) AS spans,
         count(*) FILTER (k < 3 AND live) AS n_live, count(*) FILTER (k < 3 AND NOT live) AS n_shared
  FROM (SELECT rid, k, kind, live, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM g JOIN c USING (v)) GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared
FROM d LEFT JOIN a USING (rid)
"""

ORACLE["op11_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS t
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM p
), tot AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, m, g, count(*) AS f
  FROM (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) r(m) WHERE len(w) >= m))
  GROUP BY lang, m, g HAVING count(*) >= 100
), c AS (
  SELECT lang, m, g, f AS a FROM f WHERE m >= 2
    AND NOT EXISTS (SELECT 1 FROM f o WHERE o.lang = f.lang AND o.m > f.m AND 100 * o.f >= 100 * f.f
                    AND contains(' ' || o.g || ' ', ' ' || f.g || ' '))
), k AS (
  SELECT *, string_split(g, ' ') AS w, unnest(range(1, m)) AS k FROM c
), s AS (
  SELECT k.lang, k.g, k.a, k.k, x.f AS l, y.f AS r, n,
         CAST((1000::HUGEINT * k.a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.g = array_to_string(k.w[1:k.k], ' ')
         JOIN f y ON y.lang = k.lang AND y.g = array_to_string(k.w[k.k + 1:k.m], ' ')
         JOIN tot ON tot.lang = k.lang
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000
"""
