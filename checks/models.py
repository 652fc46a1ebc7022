"""DuckDB texts for steps that fit or apply something: isolation forest, elimination, stored trees.

Each is a second way to the same numbers: a forest is grown level by level from the draws that its hashes give,
features are eliminated by a recursive query over the pairs above the threshold.
"""

from __future__ import annotations

import json
import os

from ebbtide.operators import outliers, trailing

from .oracle import HISTORY, ID, STEPS, _join

#: The 0/1 columns of the feature table in order: column, category, value in the test views.
ONE_HOT = [
    *(("CUSTOMER_SEGMENT", v, v) for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    *(("PROVINCE_REGION", v.replace(" ", "_"), v) for v in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "UNDEFINED")),
    *(("MARITAL_GROUP", v, v) for v in ("MARRIED", "OTHER", "SINGLE")),
    *(("COUNTRY_GROUP", v, v) for v in ("OTHER", "VIETNAM")),
    *(("OCCUPATION_GROUP", v, v) for v in ("FIELD", "OFFICE", "UNDEFINED")),
    ("GENDER", "FEMALE", "NU"), ("GENDER", "MALE", "NAM"),
    *(("AGE_GROUP", v, v) for v in ("Others", "boomers", "genX", "genZ", "millennials")),
]
TRAILING = [f"{c}_l{i}m_{a}" for i in range(1, HISTORY + 1) for c in trailing.TRAILING_COLUMNS for a in trailing.AGGREGATES]
ENCODED = [f"{c}_{name}" for c, name, _ in ONE_HOT]
STORED = os.path.join(os.path.dirname(__file__), "stored_trees.json")


def array(names: list[str]) -> str:
    """The columns as doubles, nulls as 0."""
    return f"[{_join(f'coalesce(CAST({n} AS DOUBLE), 0)' for n in names)}]"


def add_features(wide_sql: str) -> None:
    """Make the whole feature table a step, ``features_w``, from the text of the trailing columns."""
    encoded = _join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{name}" for c, name, v in ONE_HOT)
    STEPS["features_w"] = f"""
SELECT l.*, w.* EXCLUDE ({ID}) FROM (SELECT *, {encoded} FROM {{labelled_w}}) l LEFT JOIN ({wide_sql}) w ON w.{ID} = l.{ID}"""


def forest(rows: str, seed: int, trees: int = outliers.TREES, per_tree: int = outliers.ROWS_PER_TREE) -> str:
    """(id, score) of the rows (``id``, ``x``): a forest grown over them and walked by all of them."""
    prime, depth = outliers.PRIME, (per_tree - 1).bit_length()
    factors = ", ".join(f"({t}, {a}, {b})" for t, (a, b) in ((t, outliers.draw_factors(seed, t)) for t in range(trees)))

    def draw(kind: int) -> str:
        return f"CAST('0x' || md5(concat('{seed}:', tree, ':', place, ':{kind}'))[1:8] AS BIGINT)"

    path = ("CASE WHEN n > 2 THEN 2 * (ln(n - 1) + 0.57721566490153286061) - 2 * (n - 1)::DOUBLE / n "
            "WHEN n = 2 THEN 1.0 ELSE 0.0 END")
    steps = [f"""
given AS MATERIALIZED ({rows}),
size AS MATERIALIZED (SELECT count(*) AS n FROM given),
factors(tree, a, b) AS (VALUES {factors}),
drawn AS (SELECT tree, id, x, (a * (CAST('0x' || md5(concat('{seed}', id))[1:12] AS BIGINT) % {prime}) + b) % {prime} AS draw
          FROM given, factors),
chosen AS (SELECT tree, id, x, row_number() OVER (PARTITION BY tree ORDER BY draw, id) AS k FROM drawn, size
           WHERE draw <= least({prime}, CAST(floor((2 * {per_tree} + 100)::DOUBLE / greatest(n, 1) * {prime}) AS BIGINT) + 1)),
at_0 AS MATERIALIZED (SELECT tree, 1 AS place, id, x FROM chosen WHERE k <= {per_tree}),
limits AS MATERIALIZED (SELECT tree, CAST(ceil(log2(greatest(count(*), 2))) AS INT) AS most FROM at_0 GROUP BY tree),
go_0 AS MATERIALIZED (SELECT tree, 1 AS place, id, x FROM given, factors)"""]
    for d in range(depth + 1):
        steps.append(f"""
seen_{d} AS (SELECT tree, place, f, min(v) AS lo, max(v) AS hi, count(*) AS n FROM (
             SELECT tree, place, unnest(range(1, len(x) + 1)) AS f, unnest(x) AS v FROM at_{d}) GROUP BY tree, place, f),
open_{d} AS (SELECT tree, place, max(n) AS n, list({{'f': f, 'lo': lo, 'hi': hi}} ORDER BY f) FILTER (hi > lo) AS varying
             FROM seen_{d} GROUP BY tree, place),
cut_{d} AS MATERIALIZED (SELECT tree, place, {d} + {path} AS value, s.f AS f,
             s.lo + {draw(4)} / 4294967296.0::DOUBLE * (s.hi - s.lo) AS threshold FROM (
             SELECT tree, place, n, CASE WHEN {d} < most THEN varying[1 + (({draw(3)} * len(varying)) >> 32)] END AS s
             FROM open_{d} JOIN limits USING (tree))),
at_{d + 1} AS MATERIALIZED (SELECT tree, 2 * place + (x[f] > threshold)::INT AS place, id, x FROM at_{d} JOIN cut_{d} USING (tree, place)
             WHERE f IS NOT NULL),
go_{d + 1} AS MATERIALIZED (SELECT tree, 2 * place + (x[f] > threshold)::INT AS place, id, x FROM go_{d} JOIN cut_{d} USING (tree, place)
             WHERE f IS NOT NULL)""")
    leaves = " UNION ALL ".join(
        f"SELECT id, value FROM go_{d} JOIN cut_{d} USING (tree, place) WHERE f IS NULL" for d in range(depth + 1))
    mean = path.replace("n ", "m ").replace("(n ", "(m ").replace("/ n", "/ m")
    return (f"WITH {','.join(steps)} SELECT id, round(pow(2, -sum(value) / (max(greatest({mean}, 1.0)) * {trees})), {outliers.DIGITS}) AS score "
            f"FROM ({leaves}), (SELECT least({per_tree}, n) AS m FROM size) GROUP BY id")


def elimination(rows: str, names: list[str], threshold: float, always: dict[str, bool]) -> str:
    """(column_name, kept) from rows (``id``, ``x``), x the named columns and the target after them."""
    last = len(names)
    listed = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names, 1))
    fixed = ", ".join(f"('{n}', {str(kept).lower()})" for n, kept in always.items())
    return f"""
WITH RECURSIVE given AS MATERIALIZED ({rows}),
cells AS MATERIALIZED (SELECT id, unnest(range(1, len(x) + 1)) AS k, unnest(x) AS v FROM given),
varying AS (SELECT k FROM cells GROUP BY k HAVING min(v) < max(v)),
used AS MATERIALIZED (SELECT * FROM cells SEMI JOIN varying USING (k)),
related AS MATERIALIZED (SELECT a.k AS i, b.k AS j, round(corr(a.v, b.v), 9) AS r FROM used a JOIN used b ON a.id = b.id AND a.k < b.k GROUP BY 1, 2),
pairs AS MATERIALIZED (SELECT p.i, p.j, coalesce(f.r > s.r, false) AS first_stays FROM related p
  LEFT JOIN related f ON f.i = p.i AND f.j = {last + 1} LEFT JOIN related s ON s.i = p.j AND s.j = {last + 1}
  WHERE p.j <= {last} AND p.r >= {threshold}),
state(i, dropped) AS (SELECT 0, CAST([] AS BIGINT[]) UNION ALL
  SELECT s.i + 1, list_distinct(any_value(s.dropped) || coalesce(
    list(CASE WHEN p.first_stays THEN p.j ELSE p.i END) FILTER (WHERE p.j IS NOT NULL AND NOT list_contains(s.dropped, p.j)), []))
  FROM state s LEFT JOIN pairs p ON p.i = s.i + 1 WHERE s.i < {last} GROUP BY s.i),
names(k, column_name) AS (VALUES {listed})
SELECT column_name, NOT list_contains(dropped, k) AS kept FROM names, state WHERE i = {last}
UNION ALL SELECT * FROM (VALUES {fixed})"""


def stored_trees() -> list[tuple]:
    """The nodes of a small model of boosted trees, as ``stored_nodes`` lists them."""
    with open(STORED) as file:
        return [tuple(node) for node in json.load(file)]


STORED_FIELDS = "tree int, node int, feature int, threshold double, left_child int, right_child int, value double, gain double, n double"


def _node_values() -> str:
    rows = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in node) + ")" for node in stored_trees())
    names = STORED_FIELDS.replace(" int", "").replace(" double", "")
    return f"nodes({names}) AS (VALUES {rows})"


def walked(rows: str) -> str:
    """(id, margin) of rows (``id``, ``x``) by the stored trees."""
    return f"""
WITH RECURSIVE {_node_values()}, given AS MATERIALIZED ({rows}),
walk AS (SELECT id, x, tree, 0 AS node FROM given, (SELECT DISTINCT tree FROM nodes) UNION ALL
  SELECT w.id, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n.left_child ELSE n.right_child END
  FROM walk w JOIN nodes n USING (tree, node) WHERE n.feature >= 0)
SELECT id, sum(value) AS margin FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY id"""


def gains(names: list[str]) -> str:
    """(Feature, Value) of the stored trees' splits."""
    listed = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""
WITH {_node_values()}, names(k, name) AS (VALUES {listed}),
shares AS (SELECT feature, sum(gain * n) AS v FROM nodes WHERE feature >= 0 GROUP BY feature)
SELECT name AS "Feature", v / sum(v) OVER () AS "Value" FROM shares JOIN names ON k = feature"""
