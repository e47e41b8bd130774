"""SQL for DuckDB of the queries that it can express on whole tables."""

SPACE = r"\x20\x09-\x0D"

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
n AS (SELECT doc_id, t, w, lines, len(w) AS n_words, length(regexp_replace(t, '[{SPACE}]', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, list_filter(lines, lambda x: regexp_matches(x, '[^{SPACE}]')) AS full_lines FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, n_words - 6)) AS i FROM n WHERE n_words >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g) WHERE c > 1),
p AS (SELECT doc_id, count(DISTINCT j) AS n_repeat FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM r) GROUP BY doc_id),
m AS (SELECT doc_id, max(c) AS top FROM (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(w) AS x FROM n) GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT n.*, len(full_lines) - len(list_distinct(full_lines)) AS n_dup, coalesce(n_repeat, 0) AS n_rep, coalesce(top, 0) AS top,
  n_words < 20 OR 100 * coalesce(n_repeat, 0) > 30 * n_words AS base_failed,
  len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS letters,
  length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(t, '[^a-z]', '', 'g')) AS small, length(regexp_replace(t, '[^!]', '', 'g')) AS marks
  FROM n LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup AS n_dup_lines, n_rep AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR NOT (2 * n_words <= word_chars AND word_chars <= 20 * n_words) OR (len(lines) >= 4 AND 100 * n_dup > 30 * len(lines))
  OR 10 * letters < 7 * n_words OR capitals > small OR 3 * marks > n_words OR (10 * top > 3 * n_words AND n_words >= 20)
  OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[{SPACE}]*$'))) > 3 * len(lines)
  OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[{SPACE}]*[-*•]'))) > 9 * len(lines)) AS kept
FROM a"""

OP7 = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: cast(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v),
k AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
c AS (SELECT x, y FROM k UNION SELECT c.x, k.y FROM c JOIN k ON c.y = k.x),
n AS (SELECT x, count(*) AS links FROM k GROUP BY x), m AS (SELECT x, min(y) AS low FROM c GROUP BY x)
SELECT vec_id, coalesce(links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN m ON m.x = vec_id"""

OP8 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^{SPACE}]+')), 0) AS size,
  cast('0x' || substr(md5(coalesce(cast(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, cast(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM d GROUP BY source),
w AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM s),
f AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio FROM w),
l AS (SELECT *, sum(cap) OVER o + ratio * (sum(weight) OVER () - sum(weight) OVER o) <= sum(source_size) OVER () AS filled FROM f WINDOW o AS (ORDER BY ratio)),
t AS (SELECT source, source_size, CASE WHEN filled THEN cap ELSE weight * (sum(source_size) OVER () - coalesce(sum(cap) FILTER (filled) OVER (), 0)) / sum(weight) FILTER (NOT filled) OVER () END AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS base FROM t),
q AS (SELECT source, source_size, target, base, greatest(target - base * source_size, 0) AS rest FROM b),
c AS (SELECT source, h, sum(words) OVER (PARTITION BY source ORDER BY h) AS reach FROM (SELECT source, h, sum(size) AS words FROM d GROUP BY 1, 2)),
x AS (SELECT q.source, max(h) AS cut, max(reach) AS reach FROM q JOIN c ON q.source IS NOT DISTINCT FROM c.source AND reach <= rest GROUP BY 1),
z AS (SELECT q.*, coalesce(cut, -1) AS cut, rest - coalesce(reach, 0) AS gap FROM q LEFT JOIN x ON q.source IS NOT DISTINCT FROM x.source),
y AS (SELECT z.source, arg_min(h, (abs(size - gap), h)) AS fill FROM z JOIN d ON z.source IS NOT DISTINCT FROM d.source AND h > cut AND size > 0 AND size < 2 * gap GROUP BY 1)
SELECT d.doc_id, d.size, z.source_size, round(z.target, 6) AS target,
  cast(d.size * (z.base + CASE WHEN rest > 0 AND (d.h <= cut OR d.h = coalesce(fill, -1)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source LEFT JOIN y ON d.source IS NOT DISTINCT FROM y.source"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = rf"""
WITH q AS (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
qn AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
c AS (SELECT count(*) AS big_n, cast(sum(n) AS BIGINT) AS big_l FROM n),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) SEMI JOIN (SELECT DISTINCT term FROM q) USING (term) GROUP BY ALL),
w AS (SELECT term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), c),
s AS (SELECT item_id, p.r, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM qn JOIN p USING (term) JOIN w USING (term) JOIN n ON n.r = p.r, c GROUP BY ALL),
k AS (SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INT) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20"""

ORACLES = {"op3_quality_rules": OP3, "op7_vector_dedup": OP7, "op8_mix_sources": OP8, "op11_ranked_search": OP11}
