"""DuckDB's SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from corvane.llm import mixing

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"
#: The alphabet of base32 (a fixed value).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP1 = """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'plain' END AS kind,
    CASE role WHEN 'user' THEN turn WHEN 'assistant' THEN turn - 1 END AS call_no FROM conversations),
c AS (SELECT conv_id, call_no, min(turn) AS t FROM m WHERE kind = 'call' GROUP BY ALL),
r AS (SELECT conv_id, call_no, min(turn) AS t FROM m WHERE kind = 'result' GROUP BY ALL),
e AS (
  SELECT r.conv_id, 'r' || r.call_no AS node, r.t, CASE WHEN c.t IS NOT NULL THEN 'c' || c.call_no END AS parent FROM r LEFT JOIN c USING (conv_id, call_no)
  UNION ALL
  SELECT c.conv_id, 'c' || c.call_no, c.t, CASE WHEN r.t IS NOT NULL THEN 'r' || r.call_no END FROM c LEFT JOIN r ON r.conv_id = c.conv_id AND r.call_no = c.call_no - 2),
d AS (
  SELECT conv_id, node, 0::BIGINT AS depth, t AS latest FROM e WHERE parent IS NULL
  UNION ALL
  SELECT e.conv_id, e.node, d.depth + 1, greatest(d.latest, e.t) FROM d JOIN e ON e.conv_id = d.conv_id AND e.parent = d.node),
o AS (
  SELECT m.*, c.t IS NOT NULL AND r.t IS NOT NULL AS linked, d.depth, greatest(coalesce(d.latest, turn), turn) AS place, CASE kind WHEN 'call' THEN c.t WHEN 'result' THEN r.t END AS first
  FROM m LEFT JOIN c ON c.conv_id = m.conv_id AND c.call_no = m.call_no LEFT JOIN r ON r.conv_id = m.conv_id AND r.call_no = m.call_no
  LEFT JOIN d ON d.conv_id = m.conv_id AND d.node = CASE kind WHEN 'call' THEN 'c' WHEN 'result' THEN 'r' END || m.call_no),
x AS (
  SELECT *, CASE WHEN kind = 'plain' THEN NULL WHEN turn <> first THEN 'duplicate' WHEN NOT linked AND kind = 'call' THEN 'no result' WHEN NOT linked THEN 'no call'
    WHEN kind = 'call' AND text IS NULL THEN 'chars is missing' END AS error FROM o),
y AS (SELECT conv_id, turn, role, kind, call_no::VARCHAR AS call_id, linked, coalesce(depth, 0) AS depth, error IS NULL AS valid, error,
  '{' || concat_ws(',', CASE WHEN kind = 'call' THEN '"arguments":{' || concat_ws(',', '"chars":' || length(text), '"text":' || to_json(text)) || '}' END,
    '"call_id":"' || call_no || '"', '"content":' || to_json(text), '"role":' || to_json(role), CASE WHEN kind = 'call' THEN '"tool":"ask"' END) || '}' AS json, place FROM x)
SELECT * EXCLUDE (place), row_number() OVER (PARTITION BY conv_id ORDER BY place, depth, turn, role, json) - 1 AS position FROM y
"""

OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS least FROM documents UNION SELECT e.b, r.least FROM r JOIN e ON e.a = r.node WHERE r.least < e.b)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, doc_id = c.component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(least) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, CASE WHEN len(l) = 0 AND text <> '' THEN [text] ELSE l END AS l
  FROM (SELECT *, regexp_extract_all(text, '[.!?\x20\x09-\x0D]*[^.!?\x20\x09-\x0D][^.!?\n]*(?:[.!?]+|\n|\z)[.!?\x20\x09-\x0D]*') AS l FROM d))),
q AS (SELECT *, regexp_extract_all({LOWER.replace("text", "x")}, '{WORD}') AS w, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS r FROM p),
c AS (SELECT DISTINCT doc_id, i, list_max(list_transform(range(a, a + 24), lambda j: {{'n': strlen(w[j]), 'w': w[j], 'j': j}})).j AS j
  FROM (SELECT doc_id, i, w, unnest(range(1, len(w) - 22)) AS a FROM q WHERE len(w) >= 24)),
e AS (SELECT doc_id, i, unnest(w) AS w, unnest(r) AS r, generate_subscripts(w, 1) AS j FROM q),
g AS (SELECT e.*, count(c.j) OVER (PARTITION BY e.doc_id, e.i ORDER BY e.j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM e LEFT JOIN c USING (doc_id, i, j)),
t AS (SELECT doc_id, i, k, list(w ORDER BY j) AS w, string_agg(r, '' ORDER BY j) AS raw FROM g GROUP BY ALL UNION ALL SELECT doc_id, i, 0, w, x FROM q WHERE len(w) = 0),
s AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1 AS i, raw, w FROM t),
o AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, array_to_string(w, ' ') || chr(10) || array_to_string(w1, ' ') || chr(10) || array_to_string(w2, ' ') AS h FROM o WHERE w2 IS NOT NULL),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM h),
z AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM f WHERE r > 1)
SELECT d.doc_id, count(s.i) AS n_sentences, count(z.i) AS n_removed, coalesce(sum(len(s.w)), 0)::BIGINT AS n_words, coalesce(sum(CASE WHEN z.i IS NOT NULL THEN len(s.w) END), 0)::BIGINT AS n_words_removed,
  sha256(coalesce(string_agg(CASE WHEN z.i IS NULL THEN s.raw END, '' ORDER BY s.i), '')) AS kept_sha256
FROM documents d LEFT JOIN s USING (doc_id) LEFT JOIN z ON z.doc_id = s.doc_id AND z.i = s.i GROUP BY d.doc_id
"""

_W4 = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4 = rf"""
WITH d AS (SELECT doc_id, {_W4} AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS k FROM (SELECT item_id, {_W4} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[a:a + k - 1], ' ') AS win FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM i)),
dw AS (SELECT doc_id, k, a, array_to_string(w[a:a + k - 1], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM d JOIN (SELECT DISTINCT k FROM iw) ON len(w) >= k)),
m AS (SELECT doc_id, item_id, a, k FROM dw JOIN iw USING (k, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) AS p FROM (SELECT DISTINCT doc_id, a, k FROM m)) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP6 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS s FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS main FROM q)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', ((('0x' || substr(s, (i // 4) * 5 + 1, 5))::BIGINT >> (5 * (3 - i % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = main THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> main THEN main END AS refers_to
FROM r
"""

OP7 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, c, substr(h, 1000 * c + 1, 1098) AS h FROM (SELECT doc_id, h, unnest(range(0, (len(h) // 2 - 49 + 499) // 500)) AS c FROM b WHERE len(h) >= 100)),
w AS (SELECT doc_id, 500 * c + i AS i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, c, h, unnest(range(0, least(500, len(h) // 2 - 49))) AS i FROM c)),
m AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)),
g AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM w JOIN m USING (s) WHERE doc_id > m),
n AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM n GROUP BY ALL),
k AS (
  SELECT doc_id, z AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1099511627776) AS z FROM r
  UNION ALL SELECT doc_id, 0, min(a) FROM r GROUP BY doc_id),
t AS (SELECT k.doc_id, string_agg(substr(h, (2 * a + 1)::BIGINT, (2 * (least(z, len(h) // 2) - a))::BIGINT), '' ORDER BY a) AS h FROM k JOIN b USING (doc_id) GROUP BY k.doc_id)
SELECT b.doc_id, (len(b.h) // 2)::BIGINT AS n_bytes, coalesce(x.n, 0)::BIGINT AS n_removed, coalesce(x.c, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(t.h, b.h))) AS kept_sha256
FROM b LEFT JOIN (SELECT doc_id, sum(z - a) AS n, count(*) AS c FROM r GROUP BY 1) x USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP9 = "WITH " + mixing.sql("documents") + "\nSELECT doc_id, _source AS source, _lang AS lang, _topic AS topic, _tokens AS n_tokens, weight, prob, kept FROM mixture"

#: CRC-32 of a text's bytes; the table of its 256 remainders comes from the polynomial (0xEDB88320, a fixed value).
_CRC_TABLE = "SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))"
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen(w)), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::INT + 1])), 4294967295)"
OP11 = rf"""
WITH d AS (SELECT doc_id, {_W4} AS w FROM documents),
f AS (SELECT doc_id, unnest(w) AS w FROM d),
g AS (SELECT unnest({_W4}) AS w FROM benchmark),
c AS ({_CRC_TABLE}),
k AS MATERIALIZED (SELECT w, ({_CRC} % 10000)::BIGINT AS b FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM f UNION SELECT w FROM g)), c),
s AS (SELECT b, count(*) AS n FROM f JOIN k USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM g JOIN k USING (w) GROUP BY b),
a AS (SELECT (SELECT count(*) FROM f) AS s, (SELECT count(*) FROM g) AS t),
v AS (SELECT x.b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (a.s + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * (a.t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT b FROM k) x LEFT JOIN s USING (b) LEFT JOIN t USING (b), a),
y AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM f JOIN k USING (w) JOIN v USING (b) GROUP BY doc_id),
z AS (SELECT doc_id, len(w)::BIGINT AS n, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN y USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n >= 20)
SELECT z.doc_id, n AS n_words, n AS n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM z WHERE n >= 20) THEN rank END AS rank
FROM z LEFT JOIN r USING (doc_id)
"""


def _op12(k: int = 40, dims: int = 64, rounds: int = 5) -> str:
    """One assignment and one move after another; sums and quotients are of integers."""
    out = [
        f"x AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, x AS c FROM x QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= {k})",
    ]
    for i in range(rounds + 1):
        out.append(f"a{i} AS MATERIALIZED (SELECT vec_id, x, k, d FROM (SELECT vec_id, x, k, list_sum(list_transform(range(1, {dims + 1}), lambda j: (x[j] - c[j]) * (x[j] - c[j])))::BIGINT AS d FROM x, c{i}) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)")
        if i < rounds:
            out.append(f"s{i} AS (SELECT k, j, sum(x[j]) AS s, count(*) AS n FROM a{i}, range(1, {dims + 1}) r(j) GROUP BY ALL)")
            out.append(f"m{i} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS c FROM s{i} GROUP BY k)")
            out.append(f"c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k))")
    columns = "vec_id, k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256"
    return f"WITH {', '.join(out)} SELECT {columns} FROM a{rounds} JOIN c{rounds} USING (k)"


OP12 = _op12()
