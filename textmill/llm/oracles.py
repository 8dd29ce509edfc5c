"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
WITH d AS (SELECT doc_id, sha256({LOWER}) AS text_sha256, {LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""

MIX = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS.format('text')})::BIGINT AS size, md5(doc_id::VARCHAR) AS ordinal FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS r
  FROM d GROUP BY source),
w AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][r + 1] AS weight, [-0.5::DOUBLE, 0.0, 0.5][r + 1] AS slope, 2 * source_size AS cap,
    sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
o AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS cap_before,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * weight_left <= weight * (budget - cap_before) AS closed FROM o),
t AS (
  SELECT source, source_size, slope, CASE WHEN closed THEN cap::DOUBLE
    ELSE (budget - coalesce(sum(cap) FILTER (closed) OVER (), 0)) * weight / sum(weight) FILTER (NOT closed) OVER () END AS target
  FROM c),
p AS (
  SELECT doc_id, size, source_size, target, slope, coalesce(sum(size) OVER (
    PARTITION BY d.source ORDER BY ordinal, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin_at
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, (least(greatest(floor(target) - begin_at, 0), size)
    + least(greatest(floor(target) - begin_at - source_size, 0), size))::BIGINT AS taken,
    least(begin_at / target, 1.0::DOUBLE) AS q, least((begin_at + source_size) / target, 1.0::DOUBLE) AS q2,
    floor(target) > begin_at + source_size AND size > 0 AS again FROM p)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN CASE WHEN slope = 0 THEN q
  ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * q) - (1 - slope)) / (2 * slope) END END AS position,
  CASE WHEN again THEN CASE WHEN slope = 0 THEN q2
  ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * q2) - (1 - slope)) / (2 * slope) END END AS second_position
FROM k
"""

BACKOFF = f"""
WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w, len(w) AS n FROM d),
g AS (SELECT doc_id, i, n, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS p FROM t),
u1 AS (SELECT doc_id, a, count(*) AS own FROM g GROUP BY doc_id, a),
u AS (SELECT doc_id, a, sum(own) OVER (PARTITION BY a) - own AS c FROM u1),
b1 AS (SELECT doc_id, p, a, count(*) AS own FROM g WHERE p IS NOT NULL GROUP BY doc_id, p, a),
b AS (SELECT doc_id, p, a, sum(own) OVER (PARTITION BY p, a) - own AS c FROM b1),
s AS (
  SELECT g.doc_id, CASE
    WHEN b.c > 0 THEN log10(b.c / v.c)
    ELSE (CASE WHEN i > 1 THEN log10(0.4::DOUBLE) ELSE 0 END)
      + CASE WHEN u.c > 0 THEN log10(u.c / (all_words - n)) ELSE -log10(all_words - n + 1.0::DOUBLE) END END AS x
  FROM g JOIN u ON u.doc_id = g.doc_id AND u.a = g.a
  LEFT JOIN b ON b.doc_id = g.doc_id AND b.p = g.p AND b.a = g.a
  LEFT JOIN u v ON v.doc_id = g.doc_id AND v.a = g.p, (SELECT count(*) AS all_words FROM g)),
x AS (SELECT doc_id, sum(x) AS x FROM s GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(x, 0), 4) AS log_score,
  CASE WHEN len(w) > 0 THEN round(coalesce(x, 0) / len(w), 4) END AS mean_log_score
FROM d LEFT JOIN x USING (doc_id)
"""

#: CRC-32 byte by byte with a table made by its rule; each feature is hashed once.
RESAMPLE = f"""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
w AS (
  SELECT 'd' AS side, doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
g AS (
  SELECT side, doc_id, unnest(flatten([list_transform(range(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k], ' '))
    FOR k IN [0, 1, 2]])) AS f FROM w),
n AS (SELECT side, doc_id, f, count(*) AS n FROM g GROUP BY ALL),
h AS (
  SELECT f, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(len(hex(f)) // 2), lambda i: ('0x' || hex(f)[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM n), crc),
c AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM n JOIN h USING (f) GROUP BY bucket),
a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM c),
i AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM c, a),
x AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM n JOIN h USING (f) JOIN i USING (bucket) WHERE side = 'd' GROUP BY doc_id),
r AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM w LEFT JOIN x USING (doc_id) WHERE side = 'd'),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS place FROM r)
SELECT doc_id, n_features, weight, weight + noise AS score,
  CASE WHEN n_words >= 20 AND place <= 5 * (SELECT count(*) FROM r WHERE n_words >= 20) // 100 THEN place END AS rank
FROM o
"""

#: Equal sets are one class; classes that share a shingle are compared by what they share.
JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM w WHERE len(w) > 0),
c AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM s GROUP BY s),
g AS (SELECT c, n, unnest(s) AS f FROM c),
p AS (
  SELECT a.c AS a, b.c AS b, count(*) AS k, any_value(a.n) AS n, any_value(b.n) AS m
  FROM g a JOIN g b ON a.f = b.f AND a.c < b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.c, b.c),
l AS MATERIALIZED (
  SELECT a, b FROM p WHERE 100 * k >= 80 * (n + m - k) UNION ALL SELECT b, a FROM p WHERE 100 * k >= 80 * (n + m - k)),
r AS (SELECT c AS a, c AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
k AS (SELECT a AS c, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN c ON c.s = s.s LEFT JOIN k USING (c)
"""
