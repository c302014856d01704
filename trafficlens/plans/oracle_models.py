"""DuckDB SQL of the fitted models: each text fits the model itself, by levels or
rounds written out, and applies it."""

from __future__ import annotations

from .oracle import B

F = ["edge_score", "event_velocity_per_sec", "session_duration_sec", "mouse_move_events"]
HEX = "CAST('0x' || substr({}, {}, 8) AS BIGINT)"


def isolation(trees: int, sample: int, seed: str, threshold: float) -> str:
    """Subsamples, growth by level and walk of every tree."""
    prime = (1 << 31) - 1
    depth = max(1, (sample - 1).bit_length())
    hexed = lambda x, at: HEX.format(x, at)
    parts = [f"""
x AS MATERIALIZED (
  SELECT client_id, session_id, md5(concat_ws('|', client_id, session_id)) AS h, """ + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(F)) + f""" FROM b),
t AS (SELECT unnest(range({trees})) AS tree),
ab AS (
  SELECT tree, 1 + {hexed(f"md5('{seed}|' || tree || '|a')", 1)} % {prime - 1} AS a, {hexed(f"md5('{seed}|' || tree || '|b')", 1)} % {prime} AS b FROM t),
p0 AS MATERIALIZED (
  SELECT tree, 1 AS node, f0, f1, f2, f3 FROM x, ab
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (({hexed('h', 1)} % {prime}) * a + b) % {prime}, h, f0, f1, f2, f3) <= {sample})"""]
    for d in range(depth + 1):
        lows = ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(4))
        able = "CASE WHEN hi0 > lo0 THEN [0] ELSE []::INTEGER[] END"
        for i in range(1, 4):
            able = f"list_concat({able}, CASE WHEN hi{i} > lo{i} THEN [{i}] ELSE []::INTEGER[] END)"
        pick = lambda side: "CASE feature " + " ".join(f"WHEN {i} THEN {side}{i}" for i in range(4)) + " END"
        stop = "" if d < depth else " AND false"
        parts.append(f"""
s{d} AS MATERIALIZED (
  SELECT tree, node, n, feature, {pick('lo')} + ({pick('hi')} - {pick('lo')}) * ({hexed('h', 9)} / 4294967296.0::DOUBLE) AS split FROM (
    SELECT *, CASE WHEN n > 1 AND len(able) > 0{stop} THEN able[1 + {hexed('h', 1)} % len(able)] END AS feature FROM (
      SELECT *, md5('{seed}|' || tree || '|' || node) AS h, {able} AS able FROM (SELECT tree, node, count(*) AS n, {lows} FROM p{d} GROUP BY tree, node))))""")
        if d < depth:
            parts.append(f"""
p{d + 1} AS MATERIALIZED (
  SELECT p.tree, 2 * p.node + CASE WHEN coalesce({pick('f')} < split, false) THEN 0 ELSE 1 END AS node, f0, f1, f2, f3
  FROM p{d} p JOIN s{d} s ON p.tree = s.tree AND p.node = s.node WHERE feature IS NOT NULL)""")
    parts.append("\nnodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM s{d}" for d in range(depth + 1)) + ")")
    parts.append("\nw0 AS (SELECT x.*, tree, 1 AS node FROM x, t)")
    for d in range(depth):
        pick = "CASE feature " + " ".join(f"WHEN {i} THEN f{i}" for i in range(4)) + " END"
        parts.append(f"""
w{d + 1} AS (
  SELECT client_id, session_id, h, f0, f1, f2, f3, w.tree,
    CASE WHEN feature IS NULL THEN w.node WHEN {pick} < split THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
  FROM w{d} w LEFT JOIN nodes s ON w.tree = s.tree AND w.node = s.node)""")
    mean = "CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0::DOUBLE * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * ({n} - 1) / {n} END"
    return "WITH " + B + "," + ",".join(parts) + f""",
norm AS (SELECT {mean.format(n='n')} AS c FROM (SELECT max(n) AS n FROM nodes)),
l AS (
  SELECT client_id, session_id, avg(length(bin(w.node)) - 1 + {mean.format(n='coalesce(n, 0)')}) AS len
  FROM w{depth} w LEFT JOIN nodes s ON w.tree = s.tree AND w.node = s.node GROUP BY 1, 2)
SELECT client_id, session_id, round(pow(2.0::DOUBLE, -len / c), 6) AS isolation_score, round(pow(2.0::DOUBLE, -len / c), 6) > {threshold} AS is_anomaly
FROM l, norm"""


def tree(depth: int, bins: int, sample: int, least: int, label: str = "raw_traffic_label") -> str:
    """A classification tree fitted level by level on the training slice."""
    labels = ["Human", "LLM_Scraper", "Ad_Fraud"]
    value = lambda n="f": "CASE " + n + " " + " ".join(f"WHEN {i} THEN f{i}" for i in range(4)) + " END"
    sq = lambda side: "(" + " + ".join(f"{side}{i} * {side}{i}" for i in range(3)) + ")"
    tot = lambda side: "(" + " + ".join(f"{side}{i}" for i in range(3)) + ")"
    parts = ["""
d AS MATERIALIZED (
  SELECT client_id, session_id, """ + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(F)) + """, """ + label + """ AS label
  FROM cls WHERE CAST(ts AS DATE) > DATE '2024-01-21' AND CAST(ts AS DATE) <= DATE '2024-01-28'),
fs AS (SELECT unnest(range(4)) AS f),
""" + f"""sm AS (SELECT * FROM d ORDER BY md5(concat_ws('|', client_id, session_id)), f0, f1, f2, f3 LIMIT {sample}),
rk AS (
  SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS pos, count(*) OVER (PARTITION BY f) AS n
  FROM (SELECT f, {value()} AS v FROM sm, fs) WHERE v IS NOT NULL),
cuts AS MATERIALIZED (
  SELECT DISTINCT f, v AS cut FROM rk WHERE floor(pos * {bins} / n) > floor((pos - 1) * {bins} / n) AND pos < n),
a0 AS MATERIALIZED (SELECT *, 1 AS node FROM d)"""]
    for k in range(depth):
        sums = ", ".join(f"count(*) FILTER (WHERE label = '{n}') AS t{i}, count(*) FILTER (WHERE label = '{n}' AND v <= cut) AS l{i}" for i, n in enumerate(labels))
        right = ", ".join(f"t{i} - l{i} AS r{i}" for i in range(3))
        parts.append(f"""
g{k} AS MATERIALIZED (
  SELECT node, f, cut FROM (
    SELECT *, CASE WHEN {tot('l')} > 0 THEN {sq('l')} / {tot('l')}::DOUBLE ELSE 0 END + CASE WHEN {tot('r')} > 0 THEN {sq('r')} / {tot('r')}::DOUBLE ELSE 0 END AS got,
      {sq('t')} / {tot('t')}::DOUBLE * {1 + 1e-9!r}::DOUBLE AS need
    FROM (SELECT *, {right} FROM (SELECT node, f, cut, {sums} FROM (SELECT a.*, c.f, cut, {value('c.f')} AS v FROM a{k} a, cuts c) GROUP BY node, f, cut)))
  WHERE got > need AND least({tot('l')}, {tot('r')}) >= {least}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY got DESC, f, cut) = 1)""")
        parts.append(f"""
a{k + 1} AS MATERIALIZED (
  SELECT a.* EXCLUDE (node), CASE WHEN g.f IS NULL THEN a.node WHEN {value('g.f')} <= cut THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
  FROM a{k} a LEFT JOIN g{k} g USING (node))""")
    parts.append("\nw0 AS (SELECT client_id, session_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(F)) + ", 1 AS node FROM cls)")
    for k in range(depth):
        parts.append(f"""
w{k + 1} AS (
  SELECT w.* EXCLUDE (node), CASE WHEN g.f IS NULL THEN w.node WHEN {value('g.f')} <= cut THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
  FROM w{k} w LEFT JOIN g{k} g USING (node))""")
    leaf = ", ".join(f"count(*) FILTER (WHERE label = '{n}') AS c{i}" for i, n in enumerate(labels))
    return "WITH " + B + "," + ",".join(parts) + f""",
leaves AS (SELECT node, count(*) AS n, {leaf} FROM a{depth} GROUP BY node)
SELECT client_id, session_id, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 'Human' WHEN c1 >= c2 THEN 'LLM_Scraper' ELSE 'Ad_Fraud' END AS predicted_class,
  round(c0 / n, 6) AS p_human, round(c1 / n, 6) AS p_llm_scraper, round(c2 / n, 6) AS p_ad_fraud
FROM w{depth} w JOIN leaves USING (node)"""


def _seeding(k: int, rounds: int, oversample: int, seed: str) -> list[str]:
    full = " AND ".join(f"{c} IS NOT NULL" for c in F)
    names = ", ".join(f"z{i}" for i in range(4))
    parts = ["""
st AS (SELECT """ + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 6) AS m{i}, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS s{i}" for i, c in enumerate(F)) + f""" FROM b WHERE {full}),
z AS MATERIALIZED (
  SELECT client_id, session_id, client_id || '|' || session_id AS key, """ + ", ".join(f"round((CAST({c} AS DOUBLE) - m{i}) / s{i}, 6) AS z{i}" for i, c in enumerate(F)) + f"""
  FROM b, st WHERE {full}),
k0 AS MATERIALIZED (SELECT 0 AS candidate, {names} FROM (SELECT * FROM z ORDER BY md5('{seed}|0|' || key), {names} LIMIT 1))"""]
    dist = "pow(z.z0 - c.z0, 2) + pow(z.z1 - c.z1, 2) + pow(z.z2 - c.z2, 2) + pow(z.z3 - c.z3, 2)"
    for r in range(1, rounds + 1):
        parts.append(f"""
d{r} AS MATERIALIZED (SELECT z.client_id, z.session_id, z.key, z.z0, z.z1, z.z2, z.z3, min({dist}) AS d FROM z, k{r - 1} c GROUP BY ALL),
k{r} AS MATERIALIZED (
  SELECT * FROM k{r - 1} UNION ALL
  SELECT (SELECT count(*) FROM k{r - 1}) + row_number() OVER (ORDER BY {names}) - 1, {names} FROM (
    SELECT DISTINCT {names} FROM (
      SELECT * FROM d{r} WHERE d > 0 ORDER BY -ln(({HEX.format(f"md5('{seed}|{r}|' || key)", 1)} + 1) / 4294967296.0::DOUBLE) / d, {names} LIMIT {oversample})))""")
    parts.append(f"""
near AS (SELECT z.client_id, z.session_id, arg_min(candidate, ({dist}, candidate)) AS candidate FROM z, k{rounds} c GROUP BY ALL),
wt AS MATERIALIZED (SELECT c.*, coalesce(n, 0) AS weight FROM k{rounds} c LEFT JOIN (SELECT candidate, count(*) AS n FROM near GROUP BY 1) USING (candidate)),
e0 AS MATERIALIZED (SELECT candidate FROM wt ORDER BY weight DESC, candidate LIMIT 1)""")
    for s in range(1, k):
        so_far = " UNION ALL ".join(f"SELECT candidate FROM e{i}" for i in range(s))
        parts.append(f"""
e{s} AS MATERIALIZED (
  SELECT candidate FROM (
    SELECT z.candidate, z.weight * min({dist}) AS far FROM wt z, wt c WHERE c.candidate IN ({so_far}) AND z.candidate NOT IN ({so_far}) GROUP BY z.candidate, z.weight)
  ORDER BY far DESC, candidate LIMIT 1)""")
    parts.append("\nsd AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT candidate, {s} AS seed FROM e{s}" for s in range(k)) + ")")
    return parts


def seeds(k: int, rounds: int, oversample: int, seed: str) -> str:
    return "WITH " + B + "," + ",".join(_seeding(k, rounds, oversample, seed)) + f"""
SELECT CAST(candidate AS INTEGER) AS candidate, {", ".join(f"z{i} AS {c}" for i, c in enumerate(F))}, weight, seed
FROM wt LEFT JOIN sd USING (candidate)"""


def seeded(k: int, rounds: int, oversample: int, seed: str, steps: int) -> str:
    dist = "pow(z.z0 - c.z0, 2) + pow(z.z1 - c.z1, 2) + pow(z.z2 - c.z2, 2) + pow(z.z3 - c.z3, 2)"
    parts = _seeding(k, rounds, oversample, seed) + ["\ng0 AS MATERIALIZED (SELECT seed AS c, z0, z1, z2, z3 FROM wt JOIN sd USING (candidate))"]
    for n in range(steps + 1):
        parts.append(f"""
a{n} AS MATERIALIZED (SELECT z.client_id, z.session_id, z.z0, z.z1, z.z2, z.z3, arg_min(c.c, ({dist}, c.c)) AS c FROM z, g{n} c GROUP BY ALL)""")
        if n < steps:
            parts.append(f"""
g{n + 1} AS MATERIALIZED (
  SELECT g.c, """ + ", ".join(f"coalesce(m.z{i}, g.z{i}) AS z{i}" for i in range(4)) + f""" FROM g{n} g
  LEFT JOIN (SELECT c, """ + ", ".join(f"round(avg(z{i}), 6) AS z{i}" for i in range(4)) + f""" FROM a{n} GROUP BY c) m ON m.c = g.c)""")
    return "WITH " + B + "," + ",".join(parts) + f"\nSELECT client_id, session_id, CAST(c AS INTEGER) AS cluster FROM a{steps}"


MODEL_SQL = {
    "kmeans_seeds": seeds(3, 3, 6, "seeds"),
    "kmeans_seeded": seeded(3, 3, 6, "seeds", 5),
    "fitted_model_scores": tree(4, 32, 10_000, 20),
    "isolation_scores": isolation(32, 256, "forest", 0.6),
}
