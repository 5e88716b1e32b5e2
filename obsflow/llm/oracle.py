"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, n_lines, unnest(lines) AS line, unnest(range(1, n_lines + 1)) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, len(lines) AS n_lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), heavy AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), f AS (
  SELECT k.*, heavy.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN heavy USING (key)
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source
), w AS (
  SELECT *, rk % 3 + 1 AS w, sum(source_size) OVER () AS t_all, sum(rk % 3 + 1) OVER () AS w_all FROM s
), r AS (
  SELECT *, t_all - 3 * coalesce(sum(source_size) OVER o, 0) AS t_left, w_all - coalesce(sum(w) OVER o, 0) AS w_left
  FROM w WINDOW o AS (ORDER BY source_size / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (SELECT *, 3 * source_size * w_left <= t_left * w AS capped FROM r),
o AS (SELECT max(t_left) AS t, max(w_left) AS wl FROM c WHERE NOT capped),
t AS (
  SELECT rk, source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE
         ELSE (o.t * w)::DOUBLE / o.wl::DOUBLE END AS target
  FROM c, o
), b AS (
  SELECT *, greatest(1, (sum(source_size) OVER () + 1048575) // 1048576)::BIGINT AS b FROM t
), n AS (
  SELECT *, (source_size + b - 1) // b AS blocks,
         CASE WHEN source_size = 0 THEN 0 ELSE target * ((source_size + b - 1) // b)::DOUBLE / source_size::DOUBLE END AS slots FROM b
), c2 AS (
  SELECT *, sum(slots) OVER () AS n_slots,
         coalesce(sum(slots) OVER (ORDER BY rk), 0) / nullif(sum(slots) OVER (), 0) AS cum_hi FROM n
), v AS MATERIALIZED (SELECT *, coalesce(lag(cum_hi) OVER (ORDER BY rk), 0) AS cum_lo FROM c2),
g AS (
  SELECT k, ((k + 1) * 0.6180339887498949::DOUBLE) - floor((k + 1) * 0.6180339887498949::DOUBLE) AS u
  FROM (SELECT unnest(range(0, coalesce(ceil((SELECT max(n_slots) FROM v) - 1e-6), 0)::BIGINT)) AS k)
), q AS MATERIALIZED (
  SELECT rk, k, row_number() OVER (PARTITION BY rk ORDER BY k) - 1 AS r
  FROM g JOIN v ON u >= cum_lo AND u < cum_hi WHERE blocks > 0
), m AS (SELECT rk, count(*) AS m FROM q GROUP BY rk),
p AS (
  SELECT d.doc_id, d.size, v.*, coalesce(m.m, 0) AS m, coalesce(sum(d.size) OVER (PARTITION BY v.rk
           ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo
  FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source LEFT JOIN m ON m.rk = v.rk
)
SELECT doc_id, size, source_size, target,
       CASE WHEN blocks = 0 THEN 0 WHEN m >= 3 * blocks THEN 3 * size
         ELSE (m // blocks) * size + greatest(0, least(lo + size, (m % blocks) * b) - lo) END::BIGINT AS taken,
       CASE WHEN size > 0 THEN q.k END AS first_slot
FROM p LEFT JOIN q ON q.rk = p.rk AND q.r = lo // b
"""
NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4
           THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, b AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT node, min(other) AS other FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.other, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.other, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id
"""
CONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), b AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n,
         unnest(list_transform(range(1, greatest(len(ws) - 13, 0) + 2),
                lambda i: array_to_string(ws[i:i + least(len(ws), 13) - 1], ' '))) AS w
  FROM bw WHERE len(ws) > 0
), lens AS (SELECT DISTINCT n FROM b),
d AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS pos,
         unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS w
  FROM dw, lens WHERE len(ws) >= n
), hits AS (SELECT d.doc_id, d.pos, d.n, b.item_id FROM d JOIN b ON d.w = b.w AND d.n = b.n),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits)
  GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN its USING (doc_id)
"""
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT h, max(page_id) AS chosen FROM p GROUP BY h),
v AS (
  SELECT page_id, strlen(p.h)::BIGINT AS payload_bytes, chosen,
         list_transform(range(0, 8), lambda i: ('0x' || substr(x, 1 + 5 * i, 5))::INTEGER) AS v
  FROM p JOIN g USING (h)
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(v, lambda n: array_to_string(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM v
"""
VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), r AS (SELECT a AS node, b AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT node, min(other) AS other FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.other, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.other, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.node = e.vec_id
"""

_ASSIGN = """
a{r} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT x.vec_id, x.part, b.entry, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM x JOIN b{r} b USING (part)) GROUP BY vec_id, part
)"""
_REFINE = """,
b{n} AS MATERIALIZED (
  SELECT part, entry, list(c ORDER BY pos) AS v FROM (
    SELECT b.part, b.entry, p.pos, CASE WHEN s.n IS NULL THEN b.v[p.pos]
             ELSE s.t // s.n - CASE WHEN s.t % s.n < 0 THEN 1 ELSE 0 END END::BIGINT AS c
    FROM b{r} b CROSS JOIN (SELECT unnest(range(1, 5)) AS pos) p
    LEFT JOIN (SELECT a.part, a.entry, pos, sum(x.v[pos])::BIGINT AS t, count(*) AS n
               FROM a{r} a JOIN x USING (vec_id, part), (SELECT unnest(range(1, 5)) AS pos)
               GROUP BY a.part, a.entry, pos) s ON s.part = b.part AND s.entry = b.entry AND s.pos = p.pos)
  GROUP BY part, entry
),"""
#: For vectors of 64 components, 4 a part.
CODES = """
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS v FROM k, (SELECT unnest(range(0, 16)) AS part)
), b0 AS MATERIALIZED (
  SELECT part, entry, x.v FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 64) f USING (vec_id)
),""" + (_ASSIGN + _REFINE).format(r=0, n=1) + (_ASSIGN + _REFINE).format(r=1, n=2) + _ASSIGN.format(r=2) + """,
c AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a2 GROUP BY vec_id
)
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM c JOIN k USING (vec_id)
"""

def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text's UTF-8 bytes, four bits at a time."""
    # The CRC-32 of the sixteen nibbles.
    nibbles = ("([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
               "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::BIGINT[])")
    step = lambda c: f"xor({nibbles}[(({c}) & 15) + 1], ({c}) >> 4)"
    data = (f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex({text}), (2 * i + 1)::INTEGER, 2))::BIGINT)")
    return f"xor(4294967295::BIGINT, list_reduce({data}, lambda c, b: {step(step('xor(c, b)'))}, 4294967295::BIGINT))"


SPELLING = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, run, count(*) AS m FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run
), h AS (SELECT run, m, """ + _crc32("concat(coalesce(doc_id::VARCHAR, ''), ':', run)") + r""" AS h FROM r),
g AS MATERIALIZED (
  SELECT word, sum(m)::BIGINT AS n FROM (
    SELECT m, CASE WHEN h % 199 <> 0 THEN run
         ELSE substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run) + 2)::INTEGER) END AS word FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5
), c AS MATERIALIZED (
  SELECT word, pos, substr(word, 1, (pos - 1)::INTEGER) || substr(word, (pos + 1)::INTEGER) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM g)
), p AS (
  SELECT c.word AS a, g.word AS b FROM c JOIN g ON c.cut = g.word
  UNION SELECT g.word, c.word FROM c JOIN g ON c.cut = g.word
  UNION SELECT x.word, y.word FROM c x JOIN c y ON x.cut = y.cut AND x.pos = y.pos AND x.word <> y.word
), t AS (
  SELECT a, count(*) AS n_near, arg_min(b, (-g.n, b)) AS b, max(g.n) AS n FROM p JOIN g ON p.b = g.word GROUP BY a
), f AS MATERIALIZED (
  SELECT g.word, g.n, coalesce(t.n_near, 0)::BIGINT AS n_near, CASE WHEN t.n >= 5 * g.n THEN t.b END AS form,
         CASE WHEN t.n >= 5 * g.n THEN t.n END AS form_n
  FROM g LEFT JOIN t ON g.word = t.a
), w AS (
  SELECT word, word AS stop FROM f UNION ALL SELECT w.word, f.form FROM w JOIN f ON w.stop = f.word WHERE f.form IS NOT NULL
)
SELECT word, form, stop AS root, n, n_near, form_n
FROM f JOIN w USING (word) JOIN (SELECT word AS last FROM f WHERE form IS NULL) ON stop = last
"""

ORACLE: dict[str, str] = {
    "op2_near_vectors": VECTORS,
    "op3_line_dedup": LINE_DEDUP,
    "op4_mix_sources": MIX,
    "op5_warc": WARC,
    "op7_decontaminate": CONTAMINATION,
    "op9_minhash_dedup": NEAR,
    "op12_vector_codes": CODES,
    "op13_spelling_variants": SPELLING,
}
