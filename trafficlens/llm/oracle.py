"""DuckDB SQL for the corpus queries that SQL can express."""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN = r"[^\x20\x09-\x0D]+"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWERED}, '{WORDS}'), []) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM iw))),
h AS (SELECT doc_id, dw.n, i, item FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


def rules(metrics: dict[str, int], margins: dict[str, int], least_rows: int, reach: int, bits: int) -> str:
    shift = f"greatest(length(bin(v)) - {bits + 1}, 0)"
    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {m} AS v FROM r WHERE NOT base_failed" for m in metrics)
    margin = "CASE g.metric " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in margins.items()) + " END"

    def quart(name, keys):
        part = f"PARTITION BY {', '.join([*keys, 'metric'])}"
        cols = "".join(f"{k}, " for k in keys)
        return f"""
{name}_run AS (
  SELECT {cols}metric, bin, sum(n) OVER ({part} ORDER BY bin) AS upto, sum(n) OVER ({part}) AS total
  FROM (SELECT {cols}metric, bin, sum(n) AS n FROM sketch GROUP BY {cols}metric, bin)),
{name} AS (
  SELECT {cols}metric, max(total) AS n, min(CASE WHEN upto * 4 >= total THEN bin END) AS q1,
    min(CASE WHEN upto * 4 >= total * 3 THEN bin END) AS q3 FROM {name}_run GROUP BY {cols}metric)"""

    pick = lambda q: f"CASE WHEN g.n >= {least_rows} THEN g.{q} WHEN l.n >= {least_rows} THEN l.{q} ELSE c.{q} END"
    within = " AND ".join(f"coalesce({m} <= {m}_limit, true)" for m in metrics)
    limits = ", ".join(f"max(CASE WHEN metric = '{m}' THEN lim END) AS {m}_limit" for m in metrics)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{PLAIN}') AS w FROM documents),
win AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (
  SELECT k, count(DISTINCT pos) AS n FROM (
    SELECT k, unnest(range(i, i + 3)) AS pos FROM (SELECT k, i, count(*) OVER (PARTITION BY k, x) AS times FROM win) WHERE times >= 2) GROUP BY k),
dup AS (
  SELECT k, count(*) - count(DISTINCT line) AS n FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{PLAIN}') GROUP BY k),
counts AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.k = rep.k LEFT JOIN dup ON d.k = dup.k),
r AS (
  SELECT *, (n_symbols * 1000) // greatest(n_words, 1) AS symbols_pm, (n_dup_lines * 10000) // greatest(n_words, 1) AS dup_lines_pm,
    (n_repeat_words * 1000) // greatest(n_words, 1) AS repeats_pm, (word_chars * 100) // greatest(n_words, 1) AS word_len_c,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
sketch AS (
  SELECT lang, source, metric, (v >> CAST({shift} AS BIGINT)) << CAST({shift} AS BIGINT) AS bin, count(*) AS n
  FROM ({long}) GROUP BY ALL),{quart('g', ['lang', 'source'])},{quart('l', ['lang'])},{quart('c', [])},
limits AS (
  SELECT g.lang, g.source, g.metric, {pick('q3')} + greatest({reach} * ({pick('q3')} - {pick('q1')}), {margin}) AS lim
  FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang AND g.metric = l.metric JOIN c ON g.metric = c.metric),
wide AS (SELECT lang, source, {limits} FROM limits GROUP BY lang, source)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {within} AS kept
FROM r LEFT JOIN wide ON r.lang IS NOT DISTINCT FROM wide.lang AND r.source IS NOT DISTINCT FROM wide.source
"""


FILTER_AUDIT = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '{PLAIN}') AS w FROM t),
m AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
cells AS (
  SELECT part, a, b, c, d, e, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT p.f || q.f || r.f || s.f || u.f AS o FROM f p, f q, f r, f s, f u
  WHERE p.f <> q.f AND p.f <> r.f AND p.f <> s.f AND p.f <> u.f AND q.f <> r.f AND q.f <> s.f AND q.f <> u.f
    AND r.f <> s.f AND r.f <> u.f AND s.f <> u.f),
gone AS (
  SELECT part, o, n, good, toxic, a, b, c, d, e,
    least(CASE WHEN a THEN instr(o, 'A') ELSE 6 END, CASE WHEN b THEN instr(o, 'B') ELSE 6 END, CASE WHEN c THEN instr(o, 'C') ELSE 6 END,
          CASE WHEN d THEN instr(o, 'D') ELSE 6 END, CASE WHEN e THEN instr(o, 'E') ELSE 6 END) AS r
  FROM cells, orders),
steps AS (SELECT unnest(range(1, 6)) AS step),
seen AS (
  SELECT g.*, step, o[step] AS name, CASE o[step] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
    a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails
  FROM gone g, steps),
out AS (
  SELECT part, o, step, name, sum(CASE WHEN r > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN r = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND r < step THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN r = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN r = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY 1, 2, 3, 4)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, name) AS BIGINT) AS shapley
FROM out
"""

EXACT_DEDUP = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM t
"""


def centroids(k: int, rounds: int, dims: int) -> str:
    """Rounds unrolled over (vector, dimension, value) rows."""
    parts = [rf"""
e AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT r, vec_id, generate_subscripts(embedding, 1) AS i, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v FROM e),
s AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id), embedding) - 1 AS c FROM e WHERE vec_id IS NOT NULL
  ORDER BY c LIMIT {k}),
c0 AS (SELECT c, i, v FROM s JOIN x USING (r))"""]
    for n in range(rounds + 1):
        parts.append(f"""
a{n} AS (
  SELECT r, min(c) AS c, min(d) AS d FROM (
    SELECT r, c, d, min(d) OVER (PARTITION BY r) AS least FROM (
      SELECT r, c, CAST(sum((x.v - p.v) * (x.v - p.v)) AS BIGINT) AS d FROM x JOIN c{n} p USING (i) GROUP BY r, c)) WHERE d = least GROUP BY r)""")
        if n < rounds:
            parts.append(f"""
c{n + 1} AS (
  SELECT p.c, p.i, coalesce(q.v, p.v) AS v FROM c{n} p LEFT JOIN (
    SELECT c, i, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v FROM a{n} JOIN x USING (r) GROUP BY c, i) q
  ON p.c = q.c AND p.i = q.i)""")
    last = f"a{rounds}"
    return "WITH " + ",".join(parts) + f""",
h AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT e.vec_id, CAST({last}.c AS INTEGER) AS cluster, {last}.d AS distance, CAST(sum({last}.d) OVER (PARTITION BY {last}.c) AS BIGINT) AS cluster_inertia,
  CAST(sum({last}.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM {last} JOIN e USING (r) JOIN h ON h.c = {last}.c
"""
