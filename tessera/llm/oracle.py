"""DuckDB SQL of the registered queries that SQL can express."""

_LOWER = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP9_WORDS = "regexp_extract_all(" + _LOWER.format(c="text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = f"""
WITH b AS (SELECT item_id, {_OP9_WORDS} AS w FROM benchmark),
bw AS (
  SELECT item_id, least(10, len(w)) AS k, w[i:i + least(10, len(w)) - 1] AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0
),
grams AS (SELECT k, array_to_string(g, ' ') AS g, list_distinct(list(item_id)) AS items FROM bw GROUP BY ALL),
sizes AS (SELECT DISTINCT k FROM grams),
d AS (SELECT row_number() OVER () AS r, doc_id, {_OP9_WORDS} AS w FROM documents),
dw AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS u(i) WHERE len(w) >= k
),
hit AS (SELECT dw.r, dw.i, dw.k, grams.items FROM dw JOIN grams ON dw.k = grams.k AND dw.g = grams.g),
hit_words AS (SELECT r, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + k)) AS u(p) GROUP BY r),
hit_items AS (SELECT r, list_sort(list_distinct(list(CAST(x AS VARCHAR)))) AS items FROM hit, unnest(items) AS u(x) WHERE x IS NOT NULL GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

OP1 = f"""
WITH lines AS (
  SELECT r, doc_id, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS line
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keyed AS (
  SELECT *, trim({_LOWER.format(c="line")}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM lines
),
repeated AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
),
marked AS (SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP3 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
t AS (SELECT k, vec_id, unnest(range(1, len(q) + 1)) AS d, unnest(q) AS w FROM v),
s AS (
  SELECT a.k AS q, a.vec_id AS query_id, b.k AS c, b.vec_id AS vec_id, CAST(sum(a.w * b.w) AS BIGINT) AS score
  FROM t a JOIN t b ON a.d = b.d AND a.k <> b.k WHERE a.vec_id % 50 = 0 GROUP BY ALL
),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

_OP5_WORDS = "regexp_extract_all(" + _LOWER.format(c="text") + r", '[^\x20\x09-\x0D]+')"

OP5 = f"""
WITH RECURSIVE d AS (SELECT DISTINCT doc_id, {_OP5_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(id, other) AS (SELECT a, b FROM l UNION SELECT reach.id, l.b FROM reach JOIN l ON l.a = reach.other)
SELECT documents.doc_id, coalesce(any_value(n.n), 0) AS n_shingles,
  least(documents.doc_id, coalesce(min(other), documents.doc_id)) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id LEFT JOIN reach ON reach.id = documents.doc_id
GROUP BY documents.doc_id
"""

_OP12_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_OP12_WORDS} AS w,
    length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS up
  FROM documents
),
c AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * up > 3 * length(d.t),
    regexp_matches(d.t, '[#$%&*|]'), coalesce(c.first_id < d.doc_id, false)] AS f
  FROM d JOIN c ON c.t = d.t LEFT JOIN l ON l.doc_id = d.doc_id
),
cells AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
o AS (
  SELECT [a, b, c, d, e] AS o
  FROM range(1, 6) x1(a), range(1, 6) x2(b), range(1, 6) x3(c), range(1, 6) x4(d), range(1, 6) x5(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
),
s AS (SELECT o, step, o[step] AS own, o[1:step - 1] AS before FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, array_to_string([substr('ABCDE', CAST(x AS BIGINT), 1) for x in o], '') AS filter_order, step, own,
    CASE WHEN len([x for x in before if f[x]]) = 0 THEN 1 ELSE 0 END AS alive,
    CAST(f[own] AS INT) AS fails, CASE WHEN len([x for x in f if x]) = 1 THEN 1 ELSE 0 END AS once, n, good, toxic
  FROM cells, s
),
g AS (
  SELECT part, filter_order, step, own, sum(n * alive * (1 - fails)) AS kept, sum(n * alive * fails) AS removed,
    sum(n * (1 - alive) * fails) AS redundant, sum(n * fails * once) AS unique_fails,
    sum(good * alive * fails) AS good_lost, sum(toxic * alive * fails) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""

OP13 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
k AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k
),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

SQL = {"op12_filter_audit": OP12, "op13_fill_middle": OP13, "op5_ngram_join": OP5, "op1_line_dedup": OP1, "op3_topk_search": OP3, "op9_decontaminate": OP9}
