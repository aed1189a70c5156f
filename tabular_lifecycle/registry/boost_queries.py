"""Second-order boosted trees against SQL that grows the same trees."""

from __future__ import annotations

from math import factorial

from pyspark.sql import functions as F

from ..operators import boosting
from ..operators.boosting import Settings, share_limit
from ..operators.path_attribution import path_shapley
from ..operators.sampling import fixed_sample
from ..plans.prepare import CATEGORICAL_INPUTS, LABEL, POSITIVE
from ..runtime import fresh_path, rounded
from . import fixtures as fx
from .book import query
from .model_queries import split_training
from .stump_queries import _SPLIT

NUMBERS = {"hours_per_week": [10.0, 20.0, 30.0, 40.0], "log_capital_gain": [2.0, 5.0, 7.0, 8.0]}
SETTINGS = Settings(rounds=3, depth=2)
_COLUMNS = (*NUMBERS, *CATEGORICAL_INPUTS)


def _draw(name: str, share: float) -> str:
    limit = share_limit(share)
    return "true" if limit is None else f"substr(md5({name}), 1, 8) < '{limit}'"


def _strength(g: str, h: str) -> str:
    return f"({g}) * ({g}) / (({h}) + {SETTINGS.penalty}::DOUBLE)"


def _down(rows: str, cuts: str) -> str:
    """The rows with the place below the cut of their node."""
    number = "CASE c.col " + " ".join(f"WHEN {i} THEN r.bin_{c}" for i, c in enumerate(_COLUMNS) if c in NUMBERS) + " END <= c.bin"
    text = "coalesce(CASE c.col " + " ".join(f"WHEN {i} THEN r.{c}" for i, c in enumerate(_COLUMNS) if c not in NUMBERS) + " END = c.v, false)"
    return f"""
  SELECT r.* REPLACE (CASE WHEN c.spot IS NULL THEN r.spot WHEN CASE WHEN c.bin IS NOT NULL THEN {number} ELSE {text} END
                      THEN 2 * r.spot ELSE 2 * r.spot + 1 END AS spot)
  FROM {rows} r LEFT JOIN {cuts} c ON c.spot = r.spot"""


def _level(tree: int, level: int) -> str:
    """CTEs from the rows before a level (t0_0 and so on) to the rows after it."""
    s, now = SETTINGS, f"t{tree}_{level}"
    cells = " UNION ALL ".join(
        f"SELECT spot, g, h, {i} AS col, " + (f"bin_{c} AS bin, NULL::VARCHAR AS v" if c in NUMBERS else f"NULL::BIGINT AS bin, {c} AS v")
        + f" FROM {now} WHERE trains AND drawn AND spot >= {2**level}" for i, c in enumerate(_COLUMNS))
    names = "CASE col " + " ".join(
        f"WHEN {i} THEN '{s.seed}|{tree}|{c}'" + ("" if c in NUMBERS else " || '=' || v") for i, c in enumerate(_COLUMNS)) + " END"
    return f"""
, cells_{now} AS MATERIALIZED (SELECT spot, col, bin, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM ({cells}) GROUP BY spot, col, bin, v)
, node_{now} AS MATERIALIZED (SELECT spot AS node, sum(g) AS ng, sum(h) AS nh, sum(n) AS nn FROM cells_{now} WHERE col = 0 GROUP BY spot)
, best_{now} AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY spot ORDER BY gain DESC, col, bin, v) AS place FROM (
      SELECT spot, col, bin, v, lh, nh - lh AS rh, ln, nn - ln AS rn,
        round({_strength('lg', 'lh')} + {_strength('ng - lg', 'nh - lh')} - {_strength('ng', 'nh')}, 9) AS gain
      FROM (SELECT spot, col, bin, v, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln FROM cells_{now}
            WINDOW w AS (PARTITION BY spot, col, v ORDER BY bin ROWS UNBOUNDED PRECEDING)) JOIN node_{now} ON node = spot
      WHERE (bin IS NOT NULL OR v IS NOT NULL) AND {_draw(names, s.column_share)})
    WHERE gain > {s.least_gain} AND ln > 0 AND rn > 0 AND lh >= {s.min_child_weight} AND rh >= {s.min_child_weight})
  WHERE place = 1)
, t{tree}_{level + 1} AS MATERIALIZED ({_down(now, f'best_{now}')})"""


def _tree(tree: int) -> str:
    s, last = SETTINGS, f"t{tree}_{SETTINGS.depth}"
    return f"""
, t{tree}_0 AS MATERIALIZED (
  SELECT *, 1 AS spot, p - y AS g, p * (1 - p) AS h, {_draw(f"'{tree}|' || ord", s.row_share)} AS drawn
  FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM m{tree}))""" + "".join(_level(tree, l) for l in range(s.depth)) + f"""
, leaf_{tree} AS MATERIALIZED (
  SELECT spot AS node, -{s.rate!r}::DOUBLE * sum(g) / (sum(h) + {s.penalty}) AS worth FROM {last} WHERE trains AND drawn GROUP BY spot)
, m{tree + 1} AS MATERIALIZED (
  SELECT * EXCLUDE (spot, g, h, drawn, p, node, worth) REPLACE (margin + worth AS margin) FROM {last} JOIN leaf_{tree} ON node = spot)"""


_BINS = ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN len(list_filter({cuts}::DOUBLE[], lambda x: x < {c})) END AS bin_{c}" for c, cuts in NUMBERS.items())
_GROWN = _SPLIT + f"""
, m0 AS MATERIALIZED (
  SELECT row_key, trains, (income = '{POSITIVE}')::INTEGER::DOUBLE AS y, md5('{SETTINGS.seed}|' || row_key) AS ord,
         {_BINS}, {', '.join(CATEGORICAL_INPUTS)}, {SETTINGS.base}::DOUBLE AS margin FROM tagged)""" + "".join(
    _tree(t) for t in range(SETTINGS.rounds))
_SQL = _GROWN + f"""
SELECT row_key, round(1 / (1 + exp(-margin)), 6) AS probability, 1 / (1 + exp(-margin)) > 0.5 AS predicted
FROM m{SETTINGS.rounds} WHERE NOT trains"""


@query("i1_second_order", fx.with_ctes(_SQL, "training"))
def second_order(spark, sf_dir):
    """Trees with drawn rows and columns, stored, and read again by the step that scores the validation rows."""
    train, validation = split_training(spark, sf_dir)
    model = boosting.fit(train, F.col(LABEL) == POSITIVE, list(NUMBERS), CATEGORICAL_INPUTS, fx.KEYS, SETTINGS, NUMBERS)
    path = fresh_path(spark, "boosted")
    model.save(spark, path)
    scored = boosting.load(spark, path).score(validation)
    return scored.select("row_key", rounded(F.col("probability")).alias("probability"), "predicted")


# What a row shows to the trees; a subset of these columns is a number from 0.
_SHOWN = [f"bin_{c}" if c in NUMBERS else c for c in _COLUMNS]
_FACTORIALS = "[" + ", ".join(f"{factorial(i)}" for i in range(len(_COLUMNS) + 1)) + "]::DOUBLE[]"


def _all_subsets() -> str:
    """Every subset of the columns put from the example into every kind of training row, through all trees."""
    mixed = ", ".join(f"CASE WHEN (s >> {i}) & 1 = 1 THEN e.{c} ELSE b.{c} END AS {c}" for i, c in enumerate(_SHOWN))
    sql = f"""
, kinds AS (SELECT {', '.join(_SHOWN)}, count(*) AS times FROM m0 WHERE trains GROUP BY ALL)
, example AS (SELECT * FROM m0 WHERE NOT trains ORDER BY md5('1|' || row_key), row_key LIMIT 1)
, x0 AS MATERIALIZED (
  SELECT e.row_key, s, times, 1 AS spot, 0.0::DOUBLE AS odds, {mixed}
  FROM example e, kinds b, (SELECT unnest(range(0, {2 ** len(_SHOWN)}))::INTEGER AS s))"""
    for tree in range(SETTINGS.rounds):
        rows = f"x{tree}"
        for level in range(SETTINGS.depth):
            sql += f"\n, {rows}_{level} AS MATERIALIZED ({_down(rows if not level else f'x{tree}_{level - 1}', f'best_t{tree}_{level}')})"
        sql += f"""
, x{tree + 1} AS MATERIALIZED (
  SELECT x.* REPLACE (odds + worth AS odds, 1 AS spot) FROM {rows}_{SETTINGS.depth - 1} x JOIN leaf_{tree} ON node = spot)"""
    return sql + f"""
, worth AS (SELECT row_key, s, bit_count(s)::INTEGER AS k, sum(times * odds) / sum(times) AS w FROM x{SETTINGS.rounds} GROUP BY row_key, s)
, facts AS (SELECT {_FACTORIALS} AS f)
""" + " UNION ALL ".join(f"""
SELECT row_key, '{c}' AS feature, round(sum(CASE WHEN (s >> {i}) & 1 = 1 THEN w * f[k] * f[{len(_COLUMNS) + 1} - k]
  ELSE -w * f[k + 1] * f[{len(_COLUMNS)} - k] END / f[{len(_COLUMNS) + 1}]), 6) + 0.0 AS "value" FROM worth, facts GROUP BY row_key"""
                         for i, c in enumerate(_COLUMNS))


@query("i6_path_attribution", fx.with_ctes(_GROWN + _all_subsets(), "training"))
def path_attribution(spark, sf_dir):
    """One validation row explained against all training rows, from the paths of the drawn trees."""
    train, validation = split_training(spark, sf_dir)
    model = boosting.fit(train, F.col(LABEL) == POSITIVE, list(NUMBERS), CATEGORICAL_INPUTS, fx.KEYS, SETTINGS, NUMBERS)
    example = fixed_sample(validation.select(*fx.KEYS, *_COLUMNS), 1, fx.KEYS, 1)
    values = path_shapley(example, train, model, fx.KEYS)
    return values.withColumn("value", rounded(F.col("value")))
