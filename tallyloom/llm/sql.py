"""DuckDB SQL for the corpus queries that SQL can express."""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_BIT = "list_reduce(list_prepend(i, generate_series(1::BIGINT, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"

SHARDS = f"""
WITH t AS (SELECT list({_BIT} ORDER BY i) AS t FROM (SELECT unnest(generate_series(0::BIGINT, 255)) AS i)),
b AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents),
d AS (SELECT doc_id, CAST(len(b) + 16 AS BIGINT) AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c // 256, t.t[xor(c, x) % 256 + 1])), 4294967295) AS text_crc32 FROM b, t),
p AS (SELECT *, coalesce(SUM(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, SUM(size) OVER () AS total, row_number() OVER o AS n
      FROM d WINDOW o AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)),
s AS (SELECT *, CAST((2 * start + size) * 40 // (2 * total) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

SUFFIXES = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
g AS (SELECT doc_id, i, substr(hx, 2 * i - 1, 100) AS k FROM (SELECT doc_id, hx, unnest(generate_series(1, length(hx) // 2 - 49)) AS i FROM h)),
f AS (SELECT doc_id, i, doc_id > MIN(doc_id) OVER (PARTITION BY k) AS again FROM g),
s AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM f WHERE again),
r AS (SELECT doc_id, part, MIN(i) AS a, MAX(i) + 49 AS b FROM (SELECT *, SUM(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS part FROM s) GROUP BY 1, 2),
q AS (SELECT r.doc_id, a, b, hx, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS z FROM r JOIN h USING (doc_id)),
o AS (SELECT doc_id, CAST(SUM(b - a + 1) AS BIGINT) AS n_removed, COUNT(*) AS n_spans, MAX(b) AS last, string_agg(substr(hx, 2 * z + 1, 2 * (a - 1 - z)), '' ORDER BY a) AS kept FROM q GROUP BY 1)
SELECT h.doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(from_hex(CASE WHEN last IS NULL THEN hx ELSE kept || substr(hx, 2 * last + 1) END)) AS kept_sha256 FROM h LEFT JOIN o USING (doc_id)
"""

WORD_WINDOWS = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM w)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM g),
x AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM f WHERE again),
o AS (SELECT doc_id, COUNT(*) AS gone FROM x GROUP BY 1),
k AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM w),
z AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM k ANTI JOIN x USING (doc_id, i) GROUP BY 1)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN o USING (doc_id) LEFT JOIN z USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, low) AS (SELECT a, a FROM e UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.node),
c AS (SELECT node, MIN(low) AS low FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.low, w.doc_id) AS component_id, coalesce(c.low, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.node = w.doc_id
"""

_FEATURE_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
RESAMPLED = f"""
WITH c AS (SELECT list({_BIT} ORDER BY i) AS t FROM (SELECT unnest(generate_series(0::BIGINT, 255)) AS i)),
d AS (SELECT 0 AS src, doc_id AS id, {_FEATURE_WORDS} AS w FROM documents UNION ALL SELECT 1, item_id, {_FEATURE_WORDS} FROM benchmark),
f AS (SELECT src, id, unnest(w) AS g FROM d UNION ALL
      SELECT src, id, w[i] || ' ' || w[i + 1] FROM (SELECT src, id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM d)),
n AS (SELECT src, id, g, COUNT(*) AS n FROM f GROUP BY ALL),
u AS (SELECT g, list_transform(regexp_extract_all(hex(encode(g)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM (SELECT DISTINCT g FROM n)),
k AS (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS bucket FROM u, c),
b AS (SELECT bucket, CAST(SUM(CASE WHEN src = 0 THEN n ELSE 0 END) AS BIGINT) AS s, CAST(SUM(CASE WHEN src = 1 THEN n ELSE 0 END) AS BIGINT) AS t FROM n JOIN k USING (g) GROUP BY 1),
a AS (SELECT CAST(SUM(s) AS BIGINT) AS sa, CAST(SUM(t) AS BIGINT) AS ta FROM b),
v AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sa + 10000)::DOUBLE / ((s + 1)::DOUBLE * (ta + 10000)::DOUBLE))) AS BIGINT) AS gain FROM b, a),
e AS (SELECT id, CAST(SUM(n) AS BIGINT) AS m, CAST(SUM(n * gain) AS BIGINT) AS z FROM n JOIN k USING (g) JOIN v USING (bucket) WHERE src = 0 GROUP BY 1),
w AS (SELECT d.id AS doc_id, len(w) AS words, coalesce(m, 0) AS n_features, CASE WHEN m IS NULL THEN 0 ELSE (z - ((z % m) + m) % m) // m END AS weight,
        CAST('0x' || substr(sha256('7:' || d.id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN e ON e.id = d.id WHERE src = 0),
x AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM w),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, COUNT(*) OVER () AS n FROM x WHERE words >= 20)
SELECT x.doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM x LEFT JOIN r ON r.doc_id = x.doc_id
"""

NEGATIVES = """
WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS n FROM s WHERE same) WHERE n <= 5),
g AS (SELECT p.a, p.b, p.s, s.b AS nb, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.s <= 100 * s.s AND 100 * s.s <= 90 * p.s)
SELECT a AS anchor_id, b AS positive_id, CAST(rank AS INTEGER) AS rank, nb AS negative_id, s AS positive_score, ns AS negative_score FROM g WHERE rank <= 10
"""

_FAILS = {"base": "failed", "symbols": "10 * n_symbols > n_words", "dup_lines": "10 * n_dup_lines > 3 * n_lines", "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words"}
_PRIOR = ", ".join(f"SUM(f_{r}) OVER () / SUM(n) OVER () AS m_{r}, SUM(f_{r} * f_{r} / n) OVER () AS q_{r}" for r in _FAILS)
_SPREAD = ", ".join(
    f"CASE WHEN m_{r} * (1 - m_{r}) > 0 AND room > 0 THEN ((q_{r} - total * m_{r} * m_{r}) / (m_{r} * (1 - m_{r})) - (hosts - 1)) / room ELSE 0 END AS s_{r}" for r in _FAILS)
_RATES = ", ".join(f"(f_{r} + m_{r} * (1 / least(1, greatest(1e-6, s_{r})) - 1)) / (n + 1 / least(1, greatest(1e-6, s_{r})) - 1)" for r in _FAILS)
HOST_RULES = f"""
WITH d AS (SELECT doc_id, lower(source) AS host, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
l AS (SELECT doc_id, COUNT(*) AS n, COUNT(*) - COUNT(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, COUNT(*) AS n FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 4)) AS i FROM t) GROUP BY 1),
c AS (SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        coalesce(l.n, 0) AS n_lines, coalesce(l.dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS failed FROM c),
h AS (SELECT host, COUNT(*)::DOUBLE AS n, {", ".join(f"SUM(CASE WHEN {v} THEN 1 ELSE 0 END)::DOUBLE AS f_{r}" for r, v in _FAILS.items())} FROM b WHERE host IS NOT NULL GROUP BY 1),
p AS (SELECT *, SUM(n) OVER () AS total, COUNT(*) OVER () AS hosts, SUM(n) OVER () - SUM(n * n) OVER () / SUM(n) OVER () - (COUNT(*) OVER () - 1) AS room, {_PRIOR} FROM h),
s AS (SELECT *, {_SPREAD} FROM p),
x AS (SELECT host FROM s WHERE greatest({_RATES}) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed, NOT failed AND x.host IS NULL AS kept, b.host FROM b LEFT JOIN x ON x.host = b.host
"""
