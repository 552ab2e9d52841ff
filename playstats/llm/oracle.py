"""DuckDB SQL for the queries that SQL can express."""

# word shingles of white-space words, five at a time, and links over 75 percent
_OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END AS shs FROM w),
  unnest(shs) AS t(sh)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
digest AS (SELECT doc_id, md5(string_agg(sh, chr(10) ORDER BY sh)) AS h FROM s GROUP BY doc_id),
cls AS (SELECT h, min(doc_id) AS rep FROM digest GROUP BY h),
reps AS (SELECT s.* FROM s JOIN cls ON s.doc_id = cls.rep),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM reps a JOIN reps b
          ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS node, rep AS seen FROM cls UNION
          SELECT reach.node, e.b FROM reach JOIN e ON e.a = reach.seen),
comp AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       d.doc_id = coalesce(component, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN digest USING (doc_id)
LEFT JOIN cls USING (h) LEFT JOIN comp ON comp.node = cls.rep
"""

_OP3 = r"""
WITH r AS (
  SELECT page_id, 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>'
    || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html'
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) AS head,
    html AS body, left(sha256(page_id::VARCHAR), 2) AS draw FROM pages),
f AS (SELECT *, strlen(head || body)::BIGINT AS n_bytes, sha256(head || body) AS sha256 FROM r)
SELECT page_id, n_bytes, sha256, CASE WHEN draw < '04' THEN sha256(head || '~' || substr(body, 2))
    WHEN draw IN ('04', '05') THEN NULL WHEN draw = '06' THEN sha256(head || left(body, length(body) - 1))
    ELSE sha256 END AS found_sha256,
  CASE WHEN draw IN ('04', '05') THEN 'missing' WHEN draw < '04' AND left(body, 1) <> '~' THEN 'altered'
    WHEN draw = '06' THEN 'altered' ELSE 'ok' END AS status FROM f
UNION ALL SELECT page_id, n_bytes, NULL, sha256, 'extra' FROM f WHERE draw = '07'
"""

_OP4 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item, least(len(ws), 10) AS k, array_to_string(ws[i:i + 9], ' ') AS g
        FROM bw, unnest(range(1, greatest(len(ws) - 8, 2))) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT k FROM win),
occ AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
        FROM dw, sizes, unnest(range(1, greatest(len(ws) - k + 2, 1))) AS t(i)),
hit AS (SELECT occ.doc_id, occ.i, occ.k, win.item FROM occ JOIN win ON win.k = occ.k AND win.g = occ.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT DISTINCT doc_id, i, k FROM hit), unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

# every word is a token; Dirichlet prior 50 on add-one unigrams, scaled to the model's size
_OP9 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
seq AS (SELECT doc_id, i, ws[i] AS a, CASE WHEN i = 1 THEN '' ELSE ws[i - 1] END AS c
        FROM w, unnest(range(1, len(ws) + 1)) AS u(i)),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
m AS (SELECT 'background' AS m, c, a FROM seq UNION ALL SELECT 'target', c, a FROM seq SEMI JOIN good USING (doc_id)),
size AS (SELECT 256 + count(DISTINCT a) AS z FROM seq),
total AS (SELECT k.m, count(m.a) AS n FROM (VALUES ('background'), ('target')) k(m) LEFT JOIN m ON m.m = k.m GROUP BY 1),
prior AS (SELECT x.m, 50.0::DOUBLE * CASE WHEN x.m = 'background' AND y.n > 0 THEN x.n::DOUBLE / y.n ELSE 1 END AS d
          FROM total x, total y WHERE y.m = 'target'),
uni AS (SELECT m, a, count(*) AS n FROM m GROUP BY 1, 2),
ctx AS (SELECT m, c, count(*) AS n FROM m GROUP BY 1, 2),
bi AS (SELECT m, c, a, count(*) AS n FROM m GROUP BY 1, 2, 3),
cell AS (SELECT DISTINCT c, a FROM seq),
p AS (SELECT total.m, cell.c, cell.a,
        -ln((coalesce(bi.n, 0) + d * ((coalesce(uni.n, 0) + 1.0::DOUBLE) / (total.n + z)))
            / (coalesce(ctx.n, 0) + d)) AS loss
      FROM cell CROSS JOIN total JOIN prior ON prior.m = total.m CROSS JOIN size
      LEFT JOIN bi ON bi.m = total.m AND bi.c = cell.c AND bi.a = cell.a
      LEFT JOIN uni ON uni.m = total.m AND uni.a = cell.a LEFT JOIN ctx ON ctx.m = total.m AND ctx.c = cell.c),
each AS (SELECT doc_id, count(*) AS n, avg(x.loss) AS ct, avg(y.loss) AS cb
         FROM seq JOIN p x ON x.m = 'target' AND x.c = seq.c AND x.a = seq.a
         JOIN p y ON y.m = 'background' AND y.c = seq.c AND y.a = seq.a GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_tokens, round(coalesce(ct, 0), 6) AS ce_target,
       round(coalesce(cb, 0), 6) AS ce_background, round(coalesce(ct - cb, 0), 6) AS score
FROM documents d LEFT JOIN each USING (doc_id)
"""

# CRC-32, reflected polynomial EDB88320, byte by byte (the blob's hex digits, two a byte)
_CRC_TABLE = """crc_step(t) AS (SELECT list(c ORDER BY b) FROM (
    SELECT b, list_reduce(range(1, 9), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS c
    FROM range(256) r(b)))"""
_CRC = """xor(list_reduce(list_transform(range(0, length({hex}) // 2),
    lambda i: instr('0123456789ABCDEF', {hex}[2 * i + 1]) * 16 + instr('0123456789ABCDEF', {hex}[2 * i + 2]) - 17),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295)"""

# in the order of text digest and id; a row's shard is the sixteenth of all bytes that holds its middle
_OP12 = f"""
WITH {_CRC_TABLE},
r AS (SELECT doc_id, text, strlen(coalesce(text, ''))::BIGINT + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
o AS (SELECT *, sum(size) OVER all_ AS total, coalesce(sum(size) OVER before_, 0) AS start FROM r
  WINDOW all_ AS (), before_ AS (ORDER BY md5(coalesce(text, '')), text IS NOT NULL, doc_id NULLS FIRST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, ((16 * (2 * start + size)) // (2 * total))::INTEGER AS shard FROM o)
SELECT doc_id, size, {_CRC.format(hex="h")}::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY start) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s, crc_step
"""

_OP13 = rf"""
WITH {_CRC_TABLE},
o AS (SELECT conv_id, md5(strlen(r) || ':' || r || x) AS d, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || x)) - 1 AS pos
      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c0 AS (SELECT DISTINCT conv_id, hex(encode(conv_id::VARCHAR)) AS hx FROM o),
c AS (SELECT conv_id, conv_id - (conv_id % 20 + 20) % 20 AS source, {_CRC.format(hex="hx")} % 4 AS h FROM c0, crc_step),
b AS (SELECT c.conv_id, 0 AS part, o.pos, o.d, o.words FROM c JOIN o ON o.conv_id = c.source AND o.pos < c.h
      UNION ALL SELECT c.conv_id, 1, o.pos, o.d, o.words FROM c JOIN o USING (conv_id) WHERE o.pos >= c.h),
p AS (SELECT conv_id, words, row_number() OVER w AS depth, md5(string_agg(d, '') OVER w) AS k
      FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
m AS (SELECT conv_id, depth, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY depth), 'root') AS up, words FROM p
      UNION ALL SELECT conv_id, 0, 'root', NULL, 0 FROM c),
n AS (SELECT k, any_value(depth) AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(words) AS words FROM m GROUP BY k),
last AS (SELECT conv_id, arg_max(k, depth) AS k FROM m GROUP BY conv_id),
e AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM last GROUP BY k),
ch AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (k)),
t AS (SELECT m.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
      FROM f JOIN m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.k)
SELECT f.conv_id, f.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
  f.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM f JOIN t USING (k) LEFT JOIN e USING (k) LEFT JOIN n u ON u.k = f.up
"""

ORACLE_SQL = {
    "op2_minhash_dedup": _OP2,
    "op3_warc_fixity": _OP3,
    "op4_decontaminate": _OP4,
    "op9_lm_score": _OP9,
    "op12_histogram_shards": _OP12,
    "op13_prefix_trie": _OP13,
}
