"""DuckDB SQL with the same results as the registered queries, over the same whole tables.

The SQL takes other routes than the Spark code where it can: cross joins with the centers,
two-pass sums of squares, unrolled search steps.
"""

from __future__ import annotations

from fairtally.functions.hashing import HashFamily
from fairtally.plans.inputs import (
    CENTERS,
    EVEN_HASHES,
    GRID,
    HASHES,
    START_PICKS,
    START_SEED,
    STREAM_CHUNKS,
    SYNTH_SEED,
    TOP_K,
    VECTOR_CENTERS,
)

ROUNDS = 3

POINTS = """p AS MATERIALIZED (
  SELECT row_number() OVER () AS pid, l_orderkey, l_linenumber, l_quantity AS x,
         l_extendedprice / 1000 AS y, CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END AS g
  FROM lineitem)"""


def _center_rows(name: str, centers) -> str:
    values = ", ".join(f"({i}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))" for i, (x, y) in enumerate(centers))
    return f"{name}(cluster_id, cx, cy) AS MATERIALIZED (VALUES {values})"


def _assigned(name: str, centers: str) -> str:
    """Nearest center of every point: least (distance, id) over the cross join."""
    return f"""{name} AS MATERIALIZED (
  SELECT pid, l_orderkey, l_linenumber, x, y, g, best.d AS dist, best.id AS cluster_id FROM (
    SELECT pid, any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber,
           any_value(x) AS x, any_value(y) AS y, any_value(g) AS g,
           min({{'d': (x - cx) * (x - cx) + (y - cy) * (y - cy), 'id': cluster_id}}) AS best
    FROM p CROSS JOIN {centers} GROUP BY pid))"""


FIXED = f"WITH {POINTS}, {_center_rows('c0', CENTERS)}, {_assigned('n0', 'c0')}"
GRIDDED = f"WITH {POINTS}, {_center_rows('c0', GRID)}, {_assigned('n0', 'c0')}"


def _stats(r: int) -> str:
    """Group statistics of round r from its assignment."""
    return f"""m{r} AS MATERIALIZED (
  SELECT cluster_id, count(*) FILTER (g = 'A') AS n_a, count(*) FILTER (g = 'B') AS n_b,
         coalesce(avg(x) FILTER (g = 'A'), avg(x) FILTER (g = 'B')) AS max_,
         coalesce(avg(y) FILTER (g = 'A'), avg(y) FILTER (g = 'B')) AS may_,
         coalesce(avg(x) FILTER (g = 'B'), avg(x) FILTER (g = 'A')) AS mbx_,
         coalesce(avg(y) FILTER (g = 'B'), avg(y) FILTER (g = 'A')) AS mby_
  FROM n{r} GROUP BY cluster_id),
k{r} AS MATERIALIZED (
  SELECT *, n_a / (SELECT sum(n_a) FROM m{r}) AS alpha, n_b / (SELECT sum(n_b) FROM m{r}) AS beta,
         sqrt((max_ - mbx_) * (max_ - mbx_) + (may_ - mby_) * (may_ - mby_)) AS ell FROM m{r}),
x{r} AS MATERIALIZED (
  SELECT sum((x - max_) * (x - max_) + (y - may_) * (y - may_)) FILTER (g = 'A') / count(*) FILTER (g = 'A') AS fixed_a,
         sum((x - mbx_) * (x - mbx_) + (y - mby_) * (y - mby_)) FILTER (g = 'B') / count(*) FILTER (g = 'B') AS fixed_b
  FROM n{r} JOIN m{r} USING (cluster_id))"""


def _search(r: int) -> str:
    """Ten weights, each from the outcome of the one before."""
    steps = [f"g{r}_1(gamma) AS (VALUES (CAST(0.5 AS DOUBLE)))"]
    for t in range(1, 11):
        steps.append(
            f"""v{r}_{t} AS MATERIALIZED (
  SELECT cluster_id, alpha, beta, ell, (1 - gamma) * beta * ell / (gamma * alpha + (1 - gamma) * beta) AS x
  FROM k{r} CROSS JOIN g{r}_{t}),
f{r}_{t} AS MATERIALIZED (
  SELECT any_value(fixed_a) + sum(alpha * x * x) AS fa, any_value(fixed_b) + sum(beta * (ell - x) * (ell - x)) AS fb
  FROM v{r}_{t} CROSS JOIN x{r})"""
        )
        if t < 10:
            steps.append(
                f"""g{r}_{t + 1} AS MATERIALIZED (
  SELECT CASE WHEN fa = fb THEN gamma WHEN fa > fb THEN gamma + {0.5 ** (t + 1)} ELSE gamma - {0.5 ** (t + 1)} END AS gamma
  FROM g{r}_{t} CROSS JOIN f{r}_{t})"""
            )
    return ",\n".join(steps)


def _move(r: int) -> str:
    return f"""c{r + 1} AS MATERIALIZED (
  SELECT cluster_id, CASE WHEN k.ell > 0 THEN ((k.ell - v.x) * max_ + v.x * mbx_) / k.ell ELSE max_ END AS cx,
         CASE WHEN k.ell > 0 THEN ((k.ell - v.x) * may_ + v.x * mby_) / k.ell ELSE may_ END AS cy
  FROM k{r} k JOIN v{r}_10 v USING (cluster_id)
  UNION ALL SELECT cluster_id, cx, cy FROM c{r} WHERE cluster_id NOT IN (SELECT cluster_id FROM k{r}))"""


def _lloyd(rounds: int, start: str = FIXED) -> str:
    parts = [start]
    for r in range(rounds):
        if r:
            parts.append(_assigned(f"n{r}", f"c{r}"))
        parts += [_stats(r), _search(r), _move(r)]
    return ",\n".join(parts)


def _phi(near: str) -> str:
    return f"(SELECT max(d) FROM (SELECT avg(dist) AS d FROM {near} GROUP BY g))"


def _means(r: int) -> str:
    """Centers after a plain Lloyd round: the means of the assigned points; centers without points stay."""
    return f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster_id, coalesce(m.x, c.cx) AS cx, coalesce(m.y, c.cy) AS cy
  FROM c{r} c LEFT JOIN (SELECT cluster_id, avg(x) AS x, avg(y) AS y FROM n{r} GROUP BY cluster_id) m USING (cluster_id))"""


def _registers(items: str, before: str = "WITH") -> str:
    """The highest rank per register: 12 bits of the hash name it, 40 give the rank."""
    start = before if before == "WITH" else f"{before},"
    return f"""{start} hashed AS (SELECT CAST('0x' || left(md5(CAST(item AS VARCHAR)), 13) AS BIGINT) AS h FROM ({items}) WHERE item IS NOT NULL),
g AS (SELECT CAST(h >> 40 AS INTEGER) AS register,
  CAST(max(41 - CASE WHEN h % 1099511627776 = 0 THEN 0 ELSE length(bin(h % 1099511627776)) END) AS INTEGER) AS rank FROM hashed GROUP BY 1)"""


# Separate groups: the nearest center of a row is that of its line number.
SEPARATE = """WITH p AS MATERIALIZED (
  SELECT 1000 * l_linenumber + l_quantity AS x, l_extendedprice / 1000 AS y, l_linenumber - 1 AS cluster_id,
         CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END AS g FROM lineitem),
u AS MATERIALIZED (SELECT cluster_id, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY cluster_id)"""
APART = f"{SEPARATE}, n0 AS MATERIALIZED (SELECT * FROM p), c0 AS (SELECT * FROM u), {_stats(0)}, {_search(0)}, {_move(0)}"


def _apart_phi(centers: str) -> str:
    return f"""(SELECT max(d) FROM (SELECT avg((x - cx) * (x - cx) + (y - cy) * (y - cy)) AS d
  FROM p JOIN {centers} USING (cluster_id) GROUP BY g))"""


# --- vectors ------------------------------------------------------------------------------

VECTORS = f"""WITH u AS MATERIALIZED (
  SELECT vec_id, label, unnest(range(len(embedding))) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
seeds AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS cluster_id
  FROM embeddings ORDER BY vec_id LIMIT {VECTOR_CENTERS}),
c AS MATERIALIZED (SELECT cluster_id, j, x AS cx FROM u JOIN seeds USING (vec_id)),
d AS MATERIALIZED (SELECT vec_id, cluster_id, sum((x - cx) * (x - cx)) AS dist FROM u JOIN c USING (j) GROUP BY ALL),
n AS MATERIALIZED (SELECT vec_id, CAST(arg_min(cluster_id, dist) AS INTEGER) AS cluster_id FROM d GROUP BY vec_id)"""

VECTOR_STATS = f"""{VECTORS},
q AS MATERIALIZED (SELECT cluster_id, CASE WHEN label < 8 THEN 'A' ELSE 'B' END AS g, j, x FROM u JOIN n USING (vec_id)),
m AS MATERIALIZED (SELECT cluster_id, g, j, avg(x) AS m, count(*) AS n FROM q GROUP BY ALL),
s AS (SELECT cluster_id, g, sum((x - m) * (x - m)) AS ss FROM q JOIN m USING (cluster_id, g, j) GROUP BY ALL),
e AS (SELECT cluster_id, j, max(m) FILTER (g = 'A') AS ma, max(m) FILTER (g = 'B') AS mb,
             max(n) FILTER (g = 'A') AS na, max(n) FILTER (g = 'B') AS nb FROM m GROUP BY ALL),
l AS (SELECT cluster_id, coalesce(max(na), 0) AS n_a, coalesce(max(nb), 0) AS n_b,
             sqrt(sum((coalesce(ma, mb) - coalesce(mb, ma)) * (coalesce(ma, mb) - coalesce(mb, ma)))) AS ell,
             round(max(coalesce(ma, mb)) FILTER (j = 0), 6) AS mean_a_first, round(sum(coalesce(ma, mb)), 6) AS mean_a_sum,
             round(max(coalesce(mb, ma)) FILTER (j = 0), 6) AS mean_b_first, round(sum(coalesce(mb, ma)), 6) AS mean_b_sum
      FROM e GROUP BY ALL)
SELECT l.cluster_id, n_a, n_b, mean_a_first, mean_a_sum, mean_b_first, mean_b_sum, round(coalesce(a.ss, 0), 6) AS ss_a, round(coalesce(b.ss, 0), 6) AS ss_b,
       round(ell, 6) AS ell
FROM l LEFT JOIN (SELECT * FROM s WHERE g = 'A') a USING (cluster_id)
       LEFT JOIN (SELECT * FROM s WHERE g = 'B') b USING (cluster_id)"""


# --- sketches -----------------------------------------------------------------------------


def _hash_rows(h: HashFamily) -> str:
    rows = ", ".join(f"({r}, {h.a[r]}, {h.b[r]}, {h.sign_a[r]}, {h.sign_b[r]})" for r in range(h.depth))
    return f"h(r, a, b, sa, sb) AS (VALUES {rows})"


def _sketch(h: HashFamily, items: str) -> str:
    """items must give (item, cnt)."""
    return f"""WITH {_hash_rows(h)}, freq AS MATERIALIZED ({items}),
probe AS MATERIALIZED (
  SELECT item, cnt, r, CAST(((a * item + b) % {h.p}) % {h.width} AS INTEGER) AS c,
         CASE WHEN ((sa * item + sb) % {h.p}) % 2 = 0 THEN -1 ELSE 1 END AS s
  FROM freq CROSS JOIN h),
cell AS MATERIALIZED (SELECT r, c, CAST(sum(cnt) AS BIGINT) AS cm, CAST(sum(s * cnt) AS BIGINT) AS cs FROM probe GROUP BY r, c),
est AS MATERIALIZED (
  SELECT item, any_value(cnt) AS cnt, min(cm) AS cm_est, list_sort(list(s * cs)) AS vals
  FROM probe JOIN cell USING (r, c) GROUP BY item),
hit AS MATERIALIZED (
  SELECT item, cnt, cm_est, vals[len(vals) // 2 + 1] AS cs_est FROM est
  WHERE cnt >= (SELECT min(cnt) FROM (SELECT cnt FROM est ORDER BY cnt DESC LIMIT {TOP_K})))"""


ALL_ITEMS = "SELECT user_id AS item, count(*) AS cnt FROM events GROUP BY user_id"

ARRIVING = f"""SELECT user_id AS item, count(*) AS cnt FROM (
    SELECT user_id, event_id * {STREAM_CHUNKS} // (SELECT max(event_id) + 1 FROM events) AS chunk
    FROM events) WHERE chunk IN (
    SELECT chunk FROM (
      SELECT chunk, coalesce(sum(n) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT event_id * {STREAM_CHUNKS} // (SELECT max(event_id) + 1 FROM events) AS chunk,
                   count(*) AS n FROM events GROUP BY 1))
    WHERE before < (SELECT greatest(1, count(*) * 11 // 20) FROM events))
  GROUP BY user_id"""

ERRORS = "round(avg(abs(cnt - cm_est) / cnt), 9) AS err_cm, round(avg(abs(cnt - cs_est) / cnt), 9) AS err_cs"
REPORT = f"""SELECT (SELECT CAST(sum(cnt) AS BIGINT) FROM freq) AS n, (SELECT count(*) FROM freq) AS n_distinct,
  count(*) AS n_topk, {ERRORS} FROM hit"""

CELLS = _sketch(HASHES, ALL_ITEMS)

RUNNING = """WITH r AS (SELECT event_id, user_id, row_number() OVER w - 1 AS place,
  CAST(sum(user_id) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
  FROM events WINDOW w AS (ORDER BY ts NULLS FIRST, event_id NULLS FIRST))"""


# --- words --------------------------------------------------------------------------------

TOKENS = """WITH t AS (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
  ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents)"""
COUNTED = f"{TOKENS} SELECT word, count(*) AS cnt FROM t GROUP BY word"


# --- generated points ---------------------------------------------------------------------

SIZES = """WITH s AS (SELECT (SELECT count(*) FROM nation) AS k,
  (SELECT count(*) FROM orders) // (SELECT count(*) FROM nation) AS size),
b AS (SELECT k, size, greatest(1, CAST(floor(size * 0.1 + 0.5) AS BIGINT)) AS nb FROM s)
SELECT CAST(unnest(range(k)) AS INTEGER) AS cluster_id, greatest(size - nb, 0) AS na, nb FROM b"""


def _noise(axis: int) -> str:
    digest = f"md5('{SYNTH_SEED}|' || id || '|{axis}')"
    uniform = lambda start: f"((CAST('0x' || substr({digest}, {start}, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"
    return f"sqrt(-2 * ln({uniform(1)})) * cos(2 * pi() * {uniform(17)})"


SYNTHETIC = f"""WITH s AS (SELECT (SELECT count(*) FROM nation) AS k,
  (SELECT count(*) FROM orders) // (SELECT count(*) FROM nation) AS size),
b AS (SELECT k, greatest(1, CAST(floor(size * 0.1 + 0.5) AS BIGINT)) AS nb, size FROM s),
c AS (SELECT k, greatest(size - nb, 0) AS na, greatest(size - nb, 0) + nb AS per FROM b),
r AS (SELECT o_orderkey AS id, o_orderkey // per AS cl, o_orderkey % per >= na AS is_b FROM orders CROSS JOIN c
  WHERE o_orderkey >= 0 AND o_orderkey < k * per),
q AS (SELECT *, 1000.0 + cl * 25000.0 + CASE WHEN is_b THEN 1050.0 ELSE 0.0 END AS reach FROM r)
SELECT CAST(printf('%.3f', [1, 1, -1, -1][cl % 4 + 1] * reach + {_noise(0)} * 5.0) AS DOUBLE) AS x,
  CAST(printf('%.3f', [1, -1, -1, 1][cl % 4 + 1] * reach + {_noise(1)} * 5.0) AS DOUBLE) AS y,
  CASE WHEN is_b THEN 'B' ELSE 'A' END AS grp FROM q"""


ORACLES: dict[str, str] = {
    "pt_parse": f"WITH {POINTS} SELECT l_orderkey, l_linenumber, x, y, g AS grp FROM p",
    "pt_parse_any_dim": """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, CAST(embedding[1] AS DOUBLE) AS first,
  CAST(embedding[len(embedding)] AS DOUBLE) AS last, CASE WHEN label < 8 THEN 'A' ELSE 'B' END AS grp FROM embeddings""",
    "pt_text_roundtrip": f"""WITH {POINTS} SELECT g AS grp, count(*) AS n,
  CAST(sum(round(CAST(x AS DECIMAL(18, 5)), 3)) AS DOUBLE) AS sum_x,
  CAST(sum(round(CAST(y AS DECIMAL(18, 5)), 3)) AS DOUBLE) AS sum_y FROM p GROUP BY g""",
    "pt_text_roundtrip_vec": """WITH u AS (SELECT vec_id, CASE WHEN label < 8 THEN 'A' ELSE 'B' END AS g, len(embedding) AS d,
    unnest(range(len(embedding))) AS j, CAST(printf('%.3f', CAST(unnest(embedding) AS DOUBLE)) AS DOUBLE) AS x FROM embeddings)
SELECT g AS grp, count(DISTINCT vec_id) AS n, CAST(min(d) AS INTEGER) AS dim, round(sum(x), 3) AS total,
  round(sum(x) FILTER (j = d - 1), 3) AS last FROM u GROUP BY g""",
    "pt_counts": """SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS na,
  count(*) FILTER (o_orderstatus = 'O') AS nb FROM orders""",
    "pt_dim": """SELECT CAST(min(len(embedding)) AS INTEGER) AS min_dim,
  CAST(max(len(embedding)) AS INTEGER) AS max_dim FROM embeddings""",
    "cl_assign": f"{FIXED} SELECT l_orderkey, l_linenumber, cluster_id, dist FROM n0",
    "cl_assign_grid": f"{GRIDDED} SELECT l_orderkey, l_linenumber, cluster_id, dist FROM n0",
    "cl_assign_vec": f"{VECTORS} SELECT vec_id, cluster_id FROM n",
    "cl_std_objective": f"{FIXED} SELECT round(avg(dist), 6) AS delta FROM n0",
    "cl_fair_objective": f"""{FIXED} SELECT round(greatest(a, b), 6) AS phi, round(a, 6) AS delta_a, round(b, 6) AS delta_b
FROM (SELECT avg(dist) FILTER (g = 'A') AS a, avg(dist) FILTER (g = 'B') AS b FROM n0)""",
    "cl_group_sizes": f"""{FIXED} SELECT cluster_id, count(pid) FILTER (g = 'A') AS na, count(pid) FILTER (g = 'B') AS nb
FROM c0 LEFT JOIN n0 USING (cluster_id) GROUP BY cluster_id""",
    "cl_group_sizes_grid": f"""{GRIDDED} SELECT cluster_id, count(pid) FILTER (g = 'A') AS na, count(pid) FILTER (g = 'B') AS nb
FROM c0 LEFT JOIN n0 USING (cluster_id) GROUP BY cluster_id""",
    "cl_report": f"""{FIXED} SELECT cluster_id AS i, cx, cy, count(pid) FILTER (g = 'A') AS na, count(pid) FILTER (g = 'B') AS nb
FROM c0 LEFT JOIN n0 USING (cluster_id) GROUP BY ALL""",
    "cl_report_totals": """WITH d AS (SELECT o_orderstatus AS s,
  list_min([(o_totalprice - c) * (o_totalprice - c) FOR c IN [100000.0::DOUBLE, 250000.0::DOUBLE, 400000.0::DOUBLE]]) AS dist FROM orders)
SELECT count(*) AS n, count(*) FILTER (s = 'F') AS na, count(*) FILTER (s = 'O') AS nb, round(avg(dist) / 1e6, 4) AS delta,
  round(greatest(avg(dist) FILTER (s = 'F'), avg(dist) FILTER (s = 'O')) / 1e6, 4) AS phi FROM d""",
    "cl_report_text": f"""{FIXED}, s AS (SELECT cluster_id AS i, any_value(cx) AS cx, any_value(cy) AS cy,
  count(pid) FILTER (g = 'A') AS na, count(pid) FILTER (g = 'B') AS nb FROM c0 LEFT JOIN n0 USING (cluster_id) GROUP BY 1)
SELECT CAST(0 AS INTEGER) AS line_no, printf('N = %d, NA = %d, NB = %d', count(*), count(*) FILTER (g = 'A'),
  count(*) FILTER (g = 'B')) AS line FROM n0
UNION ALL SELECT 1, printf('Delta(U,C) = %.6f', avg(dist)) FROM n0
UNION ALL SELECT 2, printf('Phi(A,B,C) = %.6f', {_phi('n0')})
UNION ALL SELECT i + 3, printf('i = %d, center = (%.6f,%.6f), NA%d = %d, NB%d = %d', i, cx, cy, i, na, i, nb) FROM s""",
    "cl_assign_table": f"""WITH {POINTS}, sup AS MATERIALIZED (SELECT s_suppkey AS cluster_id, CAST(s_suppkey * 7 % 51 AS DOUBLE) AS cx,
  (s_acctbal + 1000) / 100 AS cy FROM supplier), {_assigned('n0', 'sup')} SELECT l_orderkey, l_linenumber, cluster_id FROM n0""",
    "cl_bounded": f"""{GRIDDED}, {_means(0)}, {_assigned('n1', 'c1')}, {_means(1)}, {_assigned('n2', 'c2')}
SELECT cluster_id, round(any_value(cx), 6) AS cx, round(any_value(cy), 6) AS cy, count(*) AS n FROM n2 JOIN c2 USING (cluster_id) GROUP BY cluster_id""",
    "pt_rejected": """WITH r AS (SELECT CASE l_linenumber WHEN 6 THEN 'not a number' WHEN 7 THEN 'wrong number of fields' ELSE 'good' END AS reason FROM lineitem)
SELECT reason, count(*) AS n FROM r GROUP BY reason UNION ALL SELECT 'read', count(*) FROM r""",
    "fl_resumed": f"{_lloyd(ROUNDS)} SELECT cluster_id, round(cx, 6) AS cx, round(cy, 6) AS cy FROM c{ROUNDS}",
    "sk_registers": f"{_registers('SELECT user_id AS item FROM events')} SELECT register, rank FROM g",
    "st_registers": f"{_registers('SELECT user_id AS item FROM events')} SELECT register, rank FROM g",
    "sk_distinct_approx": f"""{_registers('SELECT word AS item FROM t', TOKENS)},
s AS (SELECT count(*) AS used, sum(2.0 ** -rank) AS mass FROM g),
e AS (SELECT 4096 - used AS empty, 0.7213 / (1 + 1.079 / 4096.0) * 4096.0 * 4096.0 / (mass + 4096 - used) AS mean FROM s)
SELECT round(CASE WHEN mean <= 2.5 * 4096 AND empty > 0 THEN 4096 * ln(4096.0 / empty) ELSE mean END, 4) AS n_distinct FROM e""",
    "cl_start_picks": f"""WITH {POINTS}, keyed AS (
  SELECT l_orderkey || '|' || l_linenumber AS key, x, y, (x - {CENTERS[0][0]!r}) ** 2 + (y - {CENTERS[0][1]!r}) ** 2 AS dist FROM p),
lucky AS (SELECT *, CAST('0x' || left(md5(key || ':{START_SEED}:1'), 13) AS BIGINT) / 4503599627370496.0 AS luck FROM keyed WHERE dist > 0)
SELECT key, x, y FROM lucky ORDER BY luck / dist, key LIMIT {START_PICKS}""",
    "cl_init": "SELECT count(DISTINCT l_linenumber) AS n_centers, count(DISTINCT l_linenumber) AS n_groups FROM lineitem",
    "cl_kmeans": f"""{SEPARATE} SELECT CAST(cluster_id AS INTEGER) AS cluster_id, round(any_value(cx), 6) AS cx, round(any_value(cy), 6) AS cy,
  count(*) FILTER (g = 'A') AS na, count(*) FILTER (g = 'B') AS nb FROM p JOIN u USING (cluster_id) GROUP BY cluster_id""",
    "cl_kmeans_gain": f"""{SEPARATE} SELECT round(avg((x - cx) * (x - cx) + (y - cy) * (y - cy)), 6) AS cost, TRUE AS not_worse
FROM p JOIN u USING (cluster_id)""",
    "cl_compare": f"{APART} SELECT round({_apart_phi('u')}, 6) AS phi_standard, round({_apart_phi('c1')}, 6) AS phi_fair",
    "cl_compare_fixed": f"""{_lloyd(ROUNDS)}, {_assigned('n_end', f'c{ROUNDS}')}
SELECT round({_phi('n0')}, 6) AS phi_standard, round({_phi('n_end')}, 6) AS phi_fair""",
    "fl_cluster_stats": f"""{FIXED}, {_stats(0)} SELECT cluster_id, n_a, n_b, round(max_, 6) AS mean_a_x,
  round(may_, 6) AS mean_a_y, round(mbx_, 6) AS mean_b_x, round(mby_, 6) AS mean_b_y, round(ell, 6) AS ell FROM k0""",
    "fl_cluster_stats_vec": VECTOR_STATS,
    "fl_fractions": f"{FIXED}, {_stats(0)} SELECT cluster_id, round(alpha, 9) AS alpha, round(beta, 9) AS beta FROM k0",
    "fl_fixed_terms": f"{FIXED}, {_stats(0)} SELECT round(fixed_a, 6) AS fixed_a, round(fixed_b, 6) AS fixed_b FROM x0",
    "fl_fixed_terms_grid": f"{GRIDDED}, {_stats(0)} SELECT round(fixed_a, 6) AS fixed_a, round(fixed_b, 6) AS fixed_b FROM x0",
    "fl_gamma": f"""{FIXED}, {_stats(0)}, {_search(0)}
SELECT gamma, round(fa, 6) AS fa, round(fb, 6) AS fb FROM g0_10 CROSS JOIN f0_10""",
    "fl_centers": f"{_lloyd(1)} SELECT cluster_id, round(cx, 6) AS cx, round(cy, 6) AS cy FROM c1",
    "fl_lloyd": f"{_lloyd(ROUNDS)} SELECT cluster_id, round(cx, 6) AS cx, round(cy, 6) AS cy FROM c{ROUNDS}",
    "fl_lloyd_grid": f"{_lloyd(ROUNDS, GRIDDED)} SELECT cluster_id, round(cx, 6) AS cx, round(cy, 6) AS cy FROM c{ROUNDS}",
    "sk_parse_items": """SELECT count(DISTINCT user_id) AS n_distinct, count(user_id) AS n,
  CAST(sum(user_id) AS BIGINT) AS total FROM events""",
    "sk_exact_freq": ALL_ITEMS,
    "sk_merge_freq": ALL_ITEMS,
    "sk_cm_table": f"{CELLS} SELECT r, c, cm AS cnt FROM cell",
    "sk_cs_table": f"{CELLS} SELECT r, c, cs AS cnt FROM cell",
    "sk_merge": f"{CELLS} SELECT r, c, cm AS cnt, cs AS signed FROM cell",
    "sk_cm_estimate": f"{CELLS} SELECT item, cm_est AS est FROM est",
    "sk_cs_estimate": f"{CELLS} SELECT item, vals[len(vals) // 2 + 1] AS est FROM est",
    "sk_even_estimate": f"""{_sketch(EVEN_HASHES, ALL_ITEMS)} SELECT item, cm_est,
  CAST(floor((vals[len(vals) // 2] + vals[len(vals) // 2 + 1]) / 2 + 0.5) AS BIGINT) AS cs_est FROM est""",
    "sk_topk": f"{CELLS} SELECT item, cnt, cm_est FROM hit",
    "sk_topk_error": f"{CELLS} SELECT {ERRORS} FROM hit",
    "sk_report": f"{CELLS} {REPORT}",
    "sk_report_text": f"""{CELLS}, t AS ({REPORT})
SELECT CAST(0 AS INTEGER) AS line_no, printf('Number of processed items = %d', n) AS line FROM t
UNION ALL SELECT 1, printf('Number of distinct items = %d', n_distinct) FROM t
UNION ALL SELECT 2, printf('Number of Top-K heavy hitters = %d', n_topk) FROM t
UNION ALL SELECT 3, printf('Avg Relative Error for Top-K Heavy Hitters with CM = %.6f', err_cm) FROM t
UNION ALL SELECT 4, printf('Avg Relative Error for Top-K Heavy Hitters with CS = %.6f', err_cs) FROM t
UNION ALL SELECT 5, printf('Item %d True Frequency = %d Estimated Frequency with CM = %d', item, cnt, cm_est) FROM hit""",
    "st_exact_freq": ALL_ITEMS,
    "st_sketch": f"{CELLS} SELECT r, c, cm, cs FROM cell",
    "st_threshold_prefix": f"SELECT item, CAST(cnt AS BIGINT) AS cnt FROM ({ARRIVING})",
    "st_until": f"SELECT item, CAST(cnt AS BIGINT) AS cnt FROM ({ARRIVING})",
    "st_report": f"{_sketch(HASHES, ARRIVING)} {REPORT}",
    "st_replay": ALL_ITEMS,
    "st_compacted": ALL_ITEMS,
    "wn_running": f"{RUNNING} SELECT event_id, place, running FROM r",
    "wn_prefix": f"""{RUNNING} SELECT event_id, place, running FROM r
WHERE running - coalesce(user_id, 0) < greatest(1, (SELECT coalesce(sum(user_id), 0) FROM events) // 2)""",
    "wc_num_docs": "SELECT count(*) AS n_docs FROM documents",
    "wc_counts": COUNTED,
    "wc_salted": COUNTED,
    "wc_partitioned": COUNTED,
    "wc_distinct": f"{TOKENS} SELECT count(DISTINCT word) AS n_words FROM t",
    # A character beyond the basic plane is two UTF-16 units.
    "wc_avg_len": f"""{TOKENS} SELECT round(sum(length(word) +
  length(regexp_replace(word, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))) / count(*), 9) AS avg_len
FROM (SELECT DISTINCT word FROM t)""",
    "syn_points": SYNTHETIC,
    "syn_counts": SIZES,
}
