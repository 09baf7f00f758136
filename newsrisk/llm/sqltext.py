"""DuckDB text of the operators that SQL can express, written from their definitions (the Spark side never runs it)."""

from __future__ import annotations

_DIGIT = "(instr('0123456789abcdef', substr(h, {at}, 1)) - 1)"
_BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"CAST(1 + ((({_DIGIT.format(at='i * 5 // 4 + 1')} * 16 + {_DIGIT.format(at='i * 5 // 4 + 2')}) >> (3 - i * 5 % 4)) & 31) AS INTEGER), 1)), '')"
)

WARC = f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS h FROM pages),
f AS (SELECT h, MIN(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, TRUE AS intact
FROM p JOIN f USING (h)
"""

DECONTAMINATE = """
WITH it AS (
  SELECT item_id, w, least(5, len(w)) AS k FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM benchmark
    WHERE item_id IS NOT NULL AND text IS NOT NULL) WHERE len(w) > 0),
ish AS (SELECT item_id, k, len(w) - k + 1 AS n,
               unnest(list_transform(range(len(w) - k + 1), lambda i: array_to_string(w[i + 1:i + k], ' '))) AS sh FROM it),
ic AS (SELECT item_id, k, n, sh, COUNT(*) AS c FROM ish GROUP BY ALL),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents
       WHERE doc_id IS NOT NULL AND text IS NOT NULL),
ds AS (SELECT doc_id, k, len(w) - k + 1 AS total, unnest(range(len(w) - k + 1)) AS pos,
              unnest(list_transform(range(len(w) - k + 1), lambda i: array_to_string(w[i + 1:i + k], ' '))) AS sh
       FROM dw, (SELECT DISTINCT k FROM it) WHERE len(w) >= k),
win AS (SELECT DISTINCT doc_id, item_id, k, n, total, greatest(0, least(pos, total - n)) AS st FROM ds JOIN ic USING (k, sh)),
wc AS (SELECT win.doc_id, item_id, win.k, n, win.total, st, sh, COUNT(*) AS c
       FROM win JOIN ds ON ds.doc_id = win.doc_id AND ds.k = win.k AND pos >= st AND pos < st + n GROUP BY ALL),
sim AS (SELECT doc_id, item_id, wc.k, wc.n, total, st, CAST(SUM(least(wc.c, ic.c)) AS BIGINT) AS common
        FROM wc JOIN ic USING (item_id, sh) GROUP BY ALL),
sc AS (SELECT *, common / (least(n, total) + n - common) AS similarity FROM sim)
SELECT doc_id, item_id, ROUND(similarity, 10) AS similarity, CAST(st AS INTEGER) AS start_word, CAST(n + k - 1 AS INTEGER) AS n_words
FROM sc WHERE similarity >= 0.8 - 1e-12
QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, st) = 1
"""

LINE_DEDUP = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS line FROM d),
t AS (SELECT doc_id, i, list_sort(list_distinct(list_filter(
        string_split(replace(replace(line, chr(9), ' '), chr(13), ' '), ' '), lambda x: x <> ''))) AS w FROM l),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY w ORDER BY doc_id, i) AS rn FROM t WHERE len(w) > 0),
c AS (SELECT doc_id, i, w, len(w) AS s FROM r WHERE rn = 1),
k AS (SELECT doc_id, i, s, unnest(w) AS tok FROM c),
f AS (SELECT tok, COUNT(*) AS df FROM k GROUP BY tok),
o AS (SELECT k.*, ROW_NUMBER() OVER (PARTITION BY doc_id, i ORDER BY df, tok) AS p FROM k JOIN f USING (tok)),
x AS (SELECT * FROM o WHERE p <= s - ceil(0.8 * s - 1e-9) + 1),
q AS (SELECT DISTINCT a.doc_id, a.i, b.doc_id AS doc2, b.i AS i2 FROM x a JOIN x b ON a.tok = b.tok
      AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.i < a.i) AND least(a.s, b.s) >= 0.8 * greatest(a.s, b.s) - 1e-9),
v AS (SELECT q.doc_id, q.i, len(list_intersect(a.w, b.w)) AS n, a.s + b.s AS s
      FROM q JOIN c a ON a.doc_id = q.doc_id AND a.i = q.i JOIN c b ON b.doc_id = doc2 AND b.i = i2),
g AS (SELECT doc_id, i FROM v WHERE n >= 0.8 * (s - n) - 1e-9 UNION SELECT doc_id, i FROM r WHERE rn > 1),
e AS (SELECT l.doc_id, COUNT(*) AS n_lines, COUNT(g.i) AS n_removed,
             string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY l.i) AS text
      FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT documents.doc_id, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_removed, 0) AS n_removed,
       CASE WHEN e.doc_id IS NULL THEN documents.text ELSE COALESCE(e.text, '') END AS text
FROM documents LEFT JOIN e ON e.doc_id = documents.doc_id
"""

FAIR_MIXING = r"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, source,
                  CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS ss, ROW_NUMBER() OVER (ORDER BY source IS NULL, source) AS rk FROM d GROUP BY source),
w AS (SELECT *, 3 * ss AS cap, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS wt FROM s),
b AS (SELECT SUM(ss) AS total, SUM(wt) AS wts FROM w),
o AS (SELECT w.*, total - COALESCE(SUM(cap) OVER q, 0) AS lft, wts - COALESCE(SUM(wt) OVER q, 0) AS opn FROM w, b
      WINDOW q AS (ORDER BY CAST(cap AS DOUBLE) / wt, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT total - COALESCE(SUM(cap) FILTER (WHERE cap < wt * CAST(lft AS DOUBLE) / CAST(opn AS DOUBLE)), 0) AS lft,
             wts - COALESCE(SUM(wt) FILTER (WHERE cap < wt * CAST(lft AS DOUBLE) / CAST(opn AS DOUBLE)), 0) AS opn FROM o, b GROUP BY total, wts),
t AS (SELECT source, rk, ss, LEAST(CAST(cap AS DOUBLE), wt * CAST(lft AS DOUBLE) / CAST(opn AS DOUBLE)) AS target FROM w, g),
p AS (SELECT d.*, rk, ss, target, SUM(size) OVER (PARTITION BY rk ORDER BY md5('42:' || COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || size)
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT r, rk, size, CAST(e.range * ss + upto AS BIGINT) AS place FROM p, range(3) e WHERE size > 0),
f AS (SELECT c.*, CAST(place AS DOUBLE) / target AS finish FROM c JOIN t USING (rk)),
u AS (SELECT r, size, SUM(size) OVER (ORDER BY finish, rk, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM f),
k AS (SELECT r, SUM(size) AS taken FROM u, b WHERE used <= total GROUP BY r)
SELECT doc_id, size, ss AS source_size, target, CAST(COALESCE(taken, 0) AS BIGINT) AS taken, source FROM p LEFT JOIN k USING (r)
"""


def _vector_codes(rounds: int = 6) -> str:
    """Product codes by comparing every part with every entry, a pair of CTEs per round."""
    finite = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    text = f"""
WITH v AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (ORDER BY vec_id) AS r FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings WHERE {finite})),
p AS MATERIALIZED (SELECT r, CAST(j.range AS BIGINT) AS j, q[CAST(j.range * (len(q) // 8) + 1 AS BIGINT) : CAST((j.range + 1) * (len(q) // 8) AS BIGINT)] AS x
  FROM v, range(8) j),
c0 AS MATERIALIZED (SELECT j, r - 1 AS e, x AS c FROM p WHERE r <= 16)"""
    near = "MIN(CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 256 + e)"
    for i in range(rounds + 1):
        text += f""",
a{i} AS MATERIALIZED (SELECT r, j, {near} AS k FROM p JOIN c{i} USING (j) GROUP BY r, j)"""
        if i < rounds:
            text += f""",
c{i + 1} AS MATERIALIZED (SELECT c.j, c.e, COALESCE(m.c, c.c) AS c FROM c{i} c LEFT JOIN (
  SELECT j, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS c FROM (
    SELECT j, e, d, CAST(SUM(y) AS BIGINT) AS s, COUNT(*) AS n FROM (
      SELECT p.j, k % 256 AS e, unnest(x) AS y, generate_subscripts(x, 1) AS d FROM p JOIN a{i} USING (r, j)) GROUP BY ALL) GROUP BY j, e) m
  ON m.j = c.j AND m.e = c.e)"""
    return text + f""",
o AS (SELECT r, string_agg(printf('%02x', CAST(k % 256 AS INTEGER)), '' ORDER BY j) AS code, CAST(SUM(k // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY j, e)) FROM c{rounds}) AS codebooks_sha256
FROM v JOIN o USING (r)
"""


VECTOR_CODES = _vector_codes()

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id,
        CAST(list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
       CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""
