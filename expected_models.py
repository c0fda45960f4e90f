"""SQL that fits the registered models on the supplied tables: parts and queries for ``expected_sql``.

Boosting is written out split by split for a few rounds of small trees: sums of whole
gradients by node, feature and bin, the split with the highest gain among all leaves, the
rows placed anew, and a step of the margins at the end of a round. The logistic fit
is Newton's method with Gauss-Jordan elimination on lists.
"""

from __future__ import annotations

import hashlib

from clickstrata import schema

ROUNDS, LEAVES = 2, 4
LEAST_ROWS = 20  # the smallest tables have too few sessions for leaves of 100
RATE, L2, BINS, COLUMNS, SEED, LEAST_HESSIAN = 0.05, 1.0, 255, 0.8, 42, 1e-3
UNIT = "CAST(16777216 AS DOUBLE)"
N = len(schema.FEATURES)
NEWTON_ROUNDS = 14
SINGLE = [f"CAST(CAST({name} AS FLOAT) AS DOUBLE)" for name in schema.FEATURES]

MODEL_PARTS: dict[str, str] = {
    "model_rows": """
      SELECT f.*, s.split FROM features_exact f JOIN (SELECT session_id AS id, split FROM split_sessions) s ON s.id = f.session_id""",
    "inputs": f"""
      SELECT session_id, split, label, unnest(range({N})) AS f, unnest([{", ".join(SINGLE)}]) AS x FROM model_rows""",
    "edge_rows": f"""
      SELECT f, CASE WHEN kinds <= {BINS} THEN k - 1 ELSE (c - 1) * {BINS} // total END AS bin, max(x) AS edge
      FROM (SELECT f, x, sum(n) OVER (PARTITION BY f ORDER BY x) AS c, row_number() OVER (PARTITION BY f ORDER BY x) AS k,
                   count(*) OVER (PARTITION BY f) AS kinds, sum(n) OVER (PARTITION BY f) AS total
            FROM (SELECT f, x, count(*) AS n FROM inputs WHERE split = 'train' GROUP BY f, x))
      GROUP BY f, bin""",
    "edge_lists": """
      SELECT f, list(edge ORDER BY edge) AS every FROM edge_rows GROUP BY f""",
    "binned": """
      SELECT session_id, split, label, f, len(list_filter(every[1:len(every) - 1], lambda e: e < x)) AS b
      FROM inputs JOIN edge_lists USING (f)""",
    "margins_0": """
      SELECT session_id, split, label, ln(positives / (n - positives)) AS margin, greatest((n - positives) / positives, 1) AS weight
      FROM model_rows CROSS JOIN
           (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS positives FROM model_rows WHERE split = 'train')""",
}


def _allowed(tree: int) -> str:
    digests = sorted(range(N), key=lambda f: hashlib.sha256(f"{SEED}:{tree}:{f}".encode()).digest())
    return ", ".join(map(str, sorted(digests[: max(1, round(COLUMNS * N))])))


def _strength(g: str, h: str) -> str:
    return f"(({g} / {UNIT}) * ({g} / {UNIT}) / ({h} / {UNIT} + {L2}))"


def _round(t: int) -> None:
    MODEL_PARTS[f"steep_{t}"] = f"""
      SELECT session_id, split, CAST(round_even(w * (p - label) * {UNIT}, 0) AS BIGINT) AS g,
             CAST(round_even(w * p * (1 - p) * {UNIT}, 0) AS BIGINT) AS h
      FROM (SELECT *, 1 / (1 + exp(-margin)) AS p, CASE WHEN label = 1 THEN weight ELSE 1 END AS w FROM margins_{t - 1})"""
    MODEL_PARTS[f"placed_{t}_0"] = f"SELECT session_id, CAST(1 AS BIGINT) AS node FROM margins_{t - 1}"
    for s in range(1, LEAVES):
        MODEL_PARTS[f"best_{t}_{s}"] = f"""
      SELECT node, f, b, gain, n FROM (
        SELECT node, f, b, n, nl, n - nl AS nr, hl, h - hl AS hr,
               {_strength("gl", "hl")} + {_strength("(g - gl)", "(h - hl)")} - {_strength("g", "h")} AS gain
        FROM (SELECT node, f, b, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(n) OVER up AS nl,
                     sum(g) OVER every AS g, sum(h) OVER every AS h, sum(n) OVER every AS n
              FROM (SELECT node, f, b, sum(g) AS g, sum(h) AS h, count(*) AS n
                    FROM placed_{t}_{s - 1} JOIN steep_{t} USING (session_id) JOIN (SELECT session_id, f, b FROM binned) USING (session_id)
                    WHERE split = 'train' GROUP BY node, f, b)
              WINDOW up AS (PARTITION BY node, f ORDER BY b), every AS (PARTITION BY node, f)))
      WHERE f IN ({_allowed(t)}) AND least(nl, nr) >= {LEAST_ROWS} AND least(hl, hr) >= {LEAST_HESSIAN} * {UNIT} AND gain > 0
      ORDER BY gain DESC, node, f, b LIMIT 1"""
        MODEL_PARTS[f"placed_{t}_{s}"] = f"""
      SELECT p.session_id, CASE WHEN c.f IS NULL THEN p.node ELSE 2 * p.node + CAST(c.b > c.last AS BIGINT) END AS node
      FROM placed_{t}_{s - 1} p
      LEFT JOIN (SELECT session_id, binned.b, binned.f, best_{t}_{s}.b AS last, node AS parent
                 FROM binned JOIN best_{t}_{s} USING (f)) c ON c.session_id = p.session_id AND c.parent = p.node"""
    MODEL_PARTS[f"leaves_{t}"] = f"""
      SELECT node, -CAST({RATE} AS DOUBLE) * (sum(g) / {UNIT}) / (sum(h) / {UNIT} + {L2}) AS value, count(*) AS n
      FROM placed_{t}_{LEAVES - 1} JOIN steep_{t} USING (session_id) WHERE split = 'train' GROUP BY node"""
    MODEL_PARTS[f"margins_{t}"] = f"""
      SELECT session_id, split, label, margin + value AS margin, weight
      FROM margins_{t - 1} JOIN placed_{t}_{LEAVES - 1} USING (session_id) JOIN leaves_{t} USING (node)"""


for _t in range(1, ROUNDS + 1):
    _round(_t)

_SPLITS = " UNION ALL ".join(
    f"SELECT {t} AS tree, node, f, b, gain, n FROM best_{t}_{s}" for t in range(1, ROUNDS + 1) for s in range(1, LEAVES)
)
_LEAF_ROWS = " UNION ALL ".join(f"SELECT {t} AS tree, node, value, n FROM leaves_{t}" for t in range(1, ROUNDS + 1))
_NAMES = f"[{', '.join(repr(name) for name in schema.FEATURES)}]"
BOOSTED = f"SELECT session_id, label, 1 / (1 + exp(-margin)) AS score FROM margins_{ROUNDS}"

# ---- Newton's method --------------------------------------------------------

MODEL_PARTS["sampled"] = """
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY sha256(session_id || '42'), session_id) AS place,
               count(*) FILTER (label = 1) OVER () AS positives, count(*) OVER () AS n
        FROM model_rows WHERE split = 'train')
      WHERE n <= 1000000 OR place <= CASE WHEN label = 1 THEN least(positives, 500000) ELSE 1000000 - least(positives, 500000) END"""
MODEL_PARTS["moments"] = f"""
      SELECT count(*) AS n, CAST(sum(label) AS DOUBLE) AS positives, [{", ".join(f"avg({f})" for f in schema.FEATURES)}] AS m,
             [{", ".join(f"coalesce(nullif(stddev_pop({f}), 0), 1)" for f in schema.FEATURES)}] AS s
      FROM sampled"""


def _scaled(rows: str) -> str:
    values = ", ".join(f"({f} - m[{k}]) / s[{k}]" for k, f in enumerate(schema.FEATURES, 1))
    return f"SELECT session_id, label, [{values}, CAST(1 AS DOUBLE)] AS z, n, positives FROM {rows} CROSS JOIN moments"


MODEL_PARTS["scaled"] = f"""
      SELECT session_id, label, z, CASE WHEN label = 1 THEN n / (2 * positives) ELSE n / (2 * (n - positives)) END AS w
      FROM ({_scaled("(SELECT session_id, label, " + ", ".join(schema.FEATURES) + " FROM sampled)")})"""
MODEL_PARTS["scaled_long"] = f"SELECT session_id, unnest(range(1, {N + 2})) AS i, unnest(z) AS v FROM scaled"
MODEL_PARTS["penalties"] = f"SELECT list_append(list_transform(s, lambda x: 1 / (x * x)), CAST(0 AS DOUBLE)) AS penalty FROM moments"
MODEL_PARTS["newton_0"] = f"SELECT list_transform(range(1, {N + 2}), lambda i: CAST(0 AS DOUBLE)) AS beta"
for _r in range(1, NEWTON_ROUNDS + 1):
    MODEL_PARTS[f"curve_{_r}"] = f"""
      SELECT session_id, w * (p - label) AS g, w * p * (1 - p) AS h
      FROM (SELECT *, 1 / (1 + exp(-list_dot_product(z, beta))) AS p FROM scaled CROSS JOIN newton_{_r - 1})"""
    MODEL_PARTS[f"system_{_r}"] = f"""
      SELECT list(list_append(across, g + penalty[i] * beta[i]) ORDER BY i) AS a
      FROM (SELECT i, list(total ORDER BY j) AS across FROM (
              SELECT x.i, y.i AS j, sum(h * x.v * y.v) + max(CASE WHEN x.i = y.i THEN penalty[x.i] ELSE 0 END) AS total
              FROM curve_{_r} JOIN scaled_long x USING (session_id) JOIN scaled_long y USING (session_id) CROSS JOIN penalties
              GROUP BY x.i, y.i) GROUP BY i)
      JOIN (SELECT i, sum(g * v) AS g FROM curve_{_r} JOIN scaled_long USING (session_id) GROUP BY i) USING (i)
           CROSS JOIN penalties CROSS JOIN newton_{_r - 1}"""
    _solved = f"SELECT a FROM system_{_r}"
    for _p in range(1, N + 2):
        _row = f"list_transform(range(1, {N + 3}), lambda j: a[i][j] - a[i][{_p}] * a[{_p}][j] / a[{_p}][{_p}])"
        _solved = f"""SELECT list_transform(range(1, {N + 2}), lambda i: CASE WHEN i = {_p}
                  THEN list_transform(a[{_p}], lambda v: v / a[{_p}][{_p}]) ELSE {_row} END) AS a FROM ({_solved})"""
    MODEL_PARTS[f"newton_{_r}"] = f"""
      SELECT list_transform(range(1, {N + 2}), lambda i: beta[i] - a[i][{N + 2}]) AS beta FROM ({_solved}) CROSS JOIN newton_{_r - 1}"""

MODEL_QUERIES = {
    "gbt_rounds_nodes": f"""
        SELECT tree, node, feature, round(cut, 6) AS cut, round(gain, 6) AS gain, round(value, 6) AS value, CAST(n AS BIGINT) AS rows FROM (
          SELECT CAST(tree AS INTEGER) AS tree, node, {_NAMES}[CAST(f AS INTEGER) + 1] AS feature, every[CAST(b AS INTEGER) + 1] AS cut,
                 gain, CAST(NULL AS DOUBLE) AS value, n
          FROM ({_SPLITS}) JOIN edge_lists USING (f)
          UNION ALL
          SELECT CAST(tree AS INTEGER), node, NULL, NULL, NULL, value, n FROM ({_LEAF_ROWS})
          UNION ALL
          SELECT 0, 1, NULL, NULL, NULL, max(margin), count(*) FROM margins_0 WHERE split = 'train')""",
    "gbt_rounds_scores": f"SELECT session_id, round(score, 6) AS prediction_score, label FROM ({BOOSTED})",
    "gbt_rounds_summary": f"SELECT count(*) AS rows, round(avg(score), 6) AS avg_prediction_score FROM ({BOOSTED})",
    "gbt_rounds_importance": f"""
        SELECT {_NAMES}[CAST(k.f AS INTEGER) + 1] AS feature, CAST(count(x.f) AS DOUBLE) AS importance,
               round(coalesce(sum(gain), 0), 6) AS gain
        FROM (SELECT unnest(range({N})) AS f) k LEFT JOIN ({_SPLITS}) x ON x.f = k.f GROUP BY k.f
        ORDER BY importance DESC, coalesce(sum(gain), 0) DESC, feature LIMIT 12""",
    "gbt_bin_edges": f"SELECT {_NAMES}[CAST(f AS INTEGER) + 1] AS feature, CAST(bin AS INTEGER) AS bin, round(edge, 6) AS edge FROM edge_rows",
    "logistic_scores": f"""
        SELECT session_id, round(1 / (1 + exp(-list_dot_product(z, beta))), 6) AS prediction_score, label
        FROM ({_scaled("model_rows")}) CROSS JOIN newton_{NEWTON_ROUNDS}""",
    "logistic_coefficients": f"""
        SELECT feature, round(coefficient, 6) AS coefficient FROM (
          SELECT unnest(list_append({_NAMES}, '(intercept)')) AS feature,
                 unnest(list_append(list_transform(range(1, {N + 1}), lambda k: beta[k] / s[k]),
                                    beta[{N + 1}] - list_sum(list_transform(range(1, {N + 1}), lambda k: beta[k] / s[k] * m[k])))) AS coefficient
          FROM newton_{NEWTON_ROUNDS} CROSS JOIN moments)""",
}
