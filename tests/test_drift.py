import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import drift
from tabular_lifecycle.operators.ordered import distinct_ranks, exact_quantiles, measure


def gap(a, b):
    a, b = np.sort(a), np.sort(b)
    points = np.concatenate([a, b])
    return np.max(np.abs(np.searchsorted(a, points, side="right") / len(a)
                         - np.searchsorted(b, points, side="right") / len(b)))


def sides(spark, **columns):
    """Each column is a (training, comparison) pair of value lists; short ones are filled with NULL."""
    parts = []
    for side in (0, 1):
        length = max(len(pair[side]) for pair in columns.values())
        data = {c: [None if v is None else float(v) for v in pair[side]] + [None] * (length - len(pair[side]))
                for c, pair in columns.items()}
        parts += [(*values, bool(side)) for values in zip(*data.values())]
    return spark.createDataFrame(parts, ", ".join(f"{c} double" for c in columns) + ", compared boolean")


def ks_rows(df, columns, **options):
    return {r["column"]: r for r in drift.ks_two_sample(df, columns, **options).collect()}


def test_edge_samples(spark):
    df = sides(spark, same=([1, 2, 3], [1, 2, 3]), apart=([1, 2], [5, 6, 7]), empty=([1, 2], []),
               none=([], []), holes=([1, None, float("nan"), 2], [None, 2, 3]), ties=([0] * 9 + [1], [0] * 5 + [1] * 5))
    got = ks_rows(df, ["same", "apart", "empty", "none", "holes", "ties"])
    assert got["same"]["statistic"] == 0.0 and got["same"]["pvalue"] == 1.0
    assert got["apart"]["statistic"] == 1.0
    assert got["empty"]["statistic"] is None and got["empty"]["pvalue"] is None
    assert got["none"]["n_training"] == 0 and got["none"]["pvalue"] is None
    assert (got["holes"]["n_training"], got["holes"]["n_comparison"]) == (2, 2)
    assert got["holes"]["statistic"] == pytest.approx(0.5)
    assert got["ties"]["statistic"] == pytest.approx(0.4)


@pytest.mark.parametrize("rows_per_bucket", [10**9, 500, 40])
def test_against_brute_force_with_a_hot_value(spark, rows_per_bucket):
    rng = np.random.default_rng(3)
    smooth = (rng.normal(0, 1, 4000), rng.normal(0.15, 1, 3000))
    hot = tuple(np.where(rng.random(n) < 0.75, 0.0, rng.exponential(5, n)) for n in (4000, 3000))
    equal = (rng.random(4000), rng.random(3000))
    few = (rng.integers(0, 5, 4000), rng.integers(0, 6, 3000))
    columns = {"smooth": smooth, "hot": hot, "equal": equal, "few": few}
    frame = pd.concat([pd.DataFrame({c: np.asarray(p[s], dtype=float) for c, p in columns.items()}).assign(compared=bool(s))
                       for s in (0, 1)])
    got = ks_rows(spark.createDataFrame(frame).repartition(7), list(columns), rows_per_bucket=rows_per_bucket)
    for c, (a, b) in columns.items():
        assert got[c]["statistic"] == pytest.approx(gap(a, b), abs=1e-12), c


def exact_below(n, d):
    """P(D_n < d) by the Marsaglia-Tsang-Wang matrix power, for checking."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    matrix = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        matrix[i, 0] -= h ** (i + 1)
        matrix[m - 1, i] -= h ** (m - i)
    matrix[m - 1, 0] += max(2 * h - 1, 0) ** m
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                matrix[i, j] /= math.gamma(i - j + 2)
    power, scale = np.eye(m), 0.0
    for i in range(1, n + 1):
        power = power @ matrix * (i / n)
        top = power[k - 1, k - 1]
        if top < 1e-100:
            power, scale = power * 1e100, scale - 100
    return float(power[k - 1, k - 1] * 10.0 ** scale)


def test_pvalue_law(spark):
    rows = []
    for n in (150, 600):
        for z in (0.3, 0.6, 0.9, 1.2, 1.5, 1.9, 2.2):
            d = z / math.sqrt(n)
            rows.append((2 * n, 2 * n, d, 1 - exact_below(n, d)))
    df = spark.createDataFrame(rows, "n bigint, m bigint, d double, expected double")
    for r in drift.add_pvalue(df, "d", "n", "m").collect():
        assert r["pvalue"] == pytest.approx(r["expected"], abs=1e-5)
    for r in drift.add_pvalue(df, "d", "n", "m", law="limit").collect():
        assert r["pvalue"] == pytest.approx(r["expected"], abs=0.03)
    with pytest.raises(ValueError):
        drift.add_pvalue(df, "d", "n", "m", law="other")


def test_report_and_history(spark):
    base = spark.range(400).select(*[(F.col("id") * (i + 1)).cast("double").alias(c)
                                     for i, c in enumerate(drift.DRIFT_COLUMNS)], F.col("id").alias("key"))
    noisy = drift.perturb(base.withColumn("key", F.col("key").cast("string")), ["key"], seed=5)
    first = drift.drift_report(base, base, "original", "2000-01-01")
    second = drift.drift_report(base, noisy.withColumns({c: F.col(c) + 300 for c in drift.DRIFT_COLUMNS}),
                                "modified", "2010-01-01")
    assert [(f.name, f.dataType) for f in first.schema] == [(f.name, f.dataType) for f in drift.DRIFT_SCHEMA]
    history = drift.drift_history(first, second).collect()
    assert len(history) == 8
    assert {(r["date"], r["passed"]) for r in history} >= {(dt.date(2000, 1, 1), 1), (dt.date(2010, 1, 1), 0)}


def test_noise_moves_all_columns_alike(spark):
    base = spark.range(100).select(F.col("id").cast("string").alias("key"),
                                   *[F.col("id").cast("double").alias(c) for c in drift.DRIFT_COLUMNS])
    moved = drift.perturb(base, ["key"], seed=1)
    for r in moved.collect():
        shifts = {r[c] - float(r["key"]) for c in drift.DRIFT_COLUMNS}
        assert len(shifts) == 1 and 0 <= shifts.pop() <= 20


@pytest.mark.parametrize("rows_per_bucket", [10**9, 100])
def test_quantiles_and_ranks(spark, rows_per_bucket):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame({"x": rng.normal(size=3001), "hot": np.where(rng.random(3001) < 0.6, 0.0, rng.random(3001))})
    df = spark.createDataFrame(frame).repartition(6)
    got = {(r["column"], r["probability"]): r["value"]
           for r in exact_quantiles(df, ["x", "hot"], [0.0, 0.1, 0.5, 0.77, 1.0], rows_per_bucket).collect()}
    for (c, p), value in got.items():
        assert value == pytest.approx(np.quantile(frame[c], p), abs=1e-12)
    assert len(got) == 10
    ladder = measure(df, ["x", "hot"], rows_per_bucket=rows_per_bucket)
    assert len(ladder.borders["x"]) == (17 if rows_per_bucket == 10**9 else 32)
    ranks = {(r["column"], r["v"]): r["rank"] for r in distinct_ranks(df, ladder).collect()}
    for c in ("x", "hot"):
        expected = frame[c].rank(method="average")
        assert all(ranks[(c, v)] == e for v, e in zip(frame[c], expected))


def test_steps_inside_buckets(spark):
    """More rows than buckets can hold: each bucket is cut again by equal steps."""
    rng = np.random.default_rng(2)
    a, b = rng.lognormal(size=6000), rng.lognormal(0.05, 1, 6000)
    frame = pd.concat([pd.DataFrame({"x": a}).assign(compared=False), pd.DataFrame({"x": b}).assign(compared=True)])
    df = spark.createDataFrame(frame)
    assert measure(df, ["x"], rows_per_bucket=3).steps == 4
    assert ks_rows(df, ["x"], rows_per_bucket=3)["x"]["statistic"] == pytest.approx(gap(a, b), abs=1e-12)


@pytest.mark.parametrize("n, m", [(1, 1), (3, 4), (5, 5), (4, 7), (6, 3)])
def test_exact_law_counts_all_orders(spark, n, m):
    """Every order of the pooled values is as likely as any other."""
    from fractions import Fraction
    from itertools import combinations
    from math import comb

    gaps = []
    for places in combinations(range(n + m), n):
        i = top = 0
        for at in range(n + m):
            i += at in places
            top = max(top, abs(Fraction(i, n) - Fraction(at + 1 - i, m)))
        gaps.append(top)
    rows = [(n, m, float(d)) for d in sorted(set(gaps))] + [(n, m, None)]
    out = drift.add_pvalue(spark.createDataFrame(rows, "n long, m long, d double"), "d", "n", "m", law="exact").collect()
    for r in out[:-1]:
        want = sum(g >= Fraction(r["d"]).limit_denominator(n * m) for g in gaps) / comb(n + m, n)
        assert r["pvalue"] == pytest.approx(want, abs=1e-12)
    assert out[-1]["pvalue"] is None or math.isnan(out[-1]["pvalue"])
