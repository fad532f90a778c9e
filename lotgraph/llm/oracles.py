"""DuckDB SQL for the contract queries that SQL can express."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)
),
ls AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, ls WHERE len(w) >= n)
),
hits AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.gram = bw.gram),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""

#: No page of the driver's tables has a canonical link or a meta refresh, so the rules alone decide here.
OP6 = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
),
r(verdict, h, pre) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(verdict, length(h || pre)) AS said
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY 1
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""

OP7 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS i FROM d)),
g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM w),
m AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS n FROM g WHERE r > 1),
k AS (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM m),
r AS (SELECT doc_id, run, min(i) AS f, max(i) + 100 AS t FROM k GROUP BY 1, 2),
p AS (SELECT doc_id, f, t, coalesce(lag(t) OVER (PARTITION BY doc_id ORDER BY f), 0) AS prev FROM r),
q AS (SELECT p.doc_id, sum(t - f) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * prev + 1, 2 * (f - prev)), '' ORDER BY f) AS head, max(t) AS last FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN q USING (doc_id)
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('9:' || coalesce(doc_id::VARCHAR, '')) AS draw FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (
  SELECT *, 2.0 * source_size::DOUBLE AS cap, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight FROM s
),
f AS (
  SELECT *, cap / weight AS ratio,
         (1.5 * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
),
l AS (SELECT arg_min(level, ratio) FILTER (WHERE level <= ratio) AS level FROM f),
t AS (SELECT w.source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM w, l),
j AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       ((whole + (before + size / 2.0 < target - whole * source_size)::BIGINT) * size)::BIGINT AS taken
FROM j
"""

OP10 = r"""
WITH RECURSIVE t AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))
),
d AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT + 16 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (
  SELECT doc_id, size, list_prepend(4294967295::BIGINT, list_transform(range(size - 16), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)) AS bytes FROM d
),
k AS (
  SELECT doc_id, size, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, crc[1 + (xor(a, x) & 255)])), 4294967295::BIGINT) AS text_crc32 FROM b, t
),
c AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS total FROM k
),
s AS (SELECT *, least(39, ((2 * before + size) * 40) // (2 * total))::INT AS shard FROM c)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, NULL::INT AS grown_shard FROM s
"""

OP13 = r"""
WITH RECURSIVE f AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))
),
n AS (
  SELECT s, doc_id, t::INT AS t, s || ':' || doc_id || ':' || t AS x
  FROM (SELECT 'd' AS s, doc_id FROM documents UNION SELECT 'l', doc_id FROM labels) JOIN range(6) r(t) ON doc_id IS NOT NULL
),
c AS (
  SELECT s, doc_id, t, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x) + 1), lambda i: ord(substr(x, i::BIGINT, 1))::BIGINT)),
                                       lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)])), 4294967295::BIGINT) AS c
  FROM n, f
),
st AS (
  SELECT s, doc_id, t, c % 3 <> 0 AS here, 0 AS ups FROM c WHERE t = 0
  UNION ALL
  SELECT c.s, c.doc_id, c.t, CASE WHEN c % 11 = 0 THEN NOT here ELSE here END, ups + CASE WHEN c % 11 = 1 AND here THEN 1 ELSE 0 END
  FROM st JOIN c ON c.s = st.s AND c.doc_id = st.doc_id AND c.t = st.t + 1
),
d AS (
  SELECT t, doc_id // 2 + ups AS k, coalesce(lang, 'null') AS dp, count(*) AS n
  FROM documents JOIN st USING (doc_id) WHERE s = 'd' AND here GROUP BY 1, 2, 3
),
l AS (
  SELECT t, doc_id // 2 AS k, coalesce((CASE WHEN ups % 2 = 1 THEN 1 - quality ELSE quality END)::VARCHAR, 'null') || ',' || coalesce(toxic::VARCHAR, 'null') AS lp, count(*) AS n
  FROM labels JOIN st USING (doc_id) WHERE s = 'l' AND here GROUP BY 1, 2, 3
),
j AS (SELECT d.t, d.k, dp, coalesce(lp, '-') AS lp, d.n * coalesce(l.n, 1) AS n FROM d LEFT JOIN l ON l.t = d.t AND l.k = d.k)
SELECT coalesce(y.t, x.t + 1)::INT AS batch, coalesce(y.k, x.k)::BIGINT AS join_key, coalesce(y.dp, x.dp) AS doc_part, coalesce(y.lp, x.lp) AS label_part,
       (coalesce(y.n, 0) - coalesce(x.n, 0))::BIGINT AS weight, coalesce(y.n, 0)::BIGINT AS total
FROM (SELECT * FROM j WHERE t < 5) x FULL JOIN (SELECT * FROM j WHERE t > 0) y ON y.t = x.t + 1 AND y.k = x.k AND y.dp = x.dp AND y.lp = x.lp
WHERE coalesce(y.n, 0) <> coalesce(x.n, 0)
"""

ORACLES = {
    "op1_decontamination": OP1,
    "op5_jaccard_join": OP5,
    "op6_url_filters": OP6,
    "op7_suffix_dedup": OP7,
    "op9_mixing": OP9,
    "op10_sharding": OP10,
    "op13_incremental_join": OP13,
}
