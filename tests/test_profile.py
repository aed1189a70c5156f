import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import profile


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(8)
    x = rng.gamma(2.0, 3.0, 2000)
    hot = np.where(rng.random(2000) < 0.4, 0.0, np.round(x, 1))
    group = rng.choice(["a", "b", "c"], 2000, p=[0.6, 0.3, 0.1])
    data = pd.DataFrame({"x": x, "hot": hot, "y": 0.5 * x + rng.normal(size=2000), "g": group})
    data["h"] = np.where(rng.random(2000) < 0.8, data["g"], "z")
    data.loc[::10, "g"] = None
    return data


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(6)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_overview(df, frame):
    got = by(profile.overview(df), "column")
    for c in frame:
        assert got[c]["count"] == 2000 and got[c]["missing"] == frame[c].isna().sum()
        assert got[c]["distinct"] == frame[c].nunique()
    assert got["g"]["type"] == "string" and got["x"]["type"] == "double"
    rough = by(profile.overview(df, exact=False), "column")
    assert rough["x"]["distinct"] == pytest.approx(2000, rel=0.15)


@pytest.mark.parametrize("rows_per_bucket", [10**9, 100])
def test_numeric_detail(df, frame, rows_per_bucket):
    got = by(profile.numeric_detail(df, rows_per_bucket=rows_per_bucket), "column")
    for c in ("x", "hot", "y"):
        v = frame[c]
        for name, expected in (("mean", v.mean()), ("std", v.std()), ("skewness", v.skew()), ("kurtosis", v.kurt()),
                               ("p25", v.quantile(0.25)), ("p75", v.quantile(0.75)), ("zeros", (v == 0).sum())):
            assert got[c][name] == pytest.approx(expected, rel=1e-9, abs=1e-9), (c, name)


def test_summary_of_text_and_numbers(df):
    got = {(r["column"], r["stat"]): r["value"] for r in profile.summarize(df).collect()}
    assert got[("g", "missing")] == 200.0 and ("g", "mean") not in got
    assert got[("x", "p50")] == pytest.approx(float(df.agg(F.expr("percentile(x, 0.5)")).first()[0]))


def test_histogram(spark, df, frame):
    for c in ("x", "hot"):
        rows = profile.histogram(df, [c], bins=7).orderBy("bin").collect()
        counts, edges = np.histogram(frame[c], bins=7)
        assert [r["n"] for r in rows] == list(counts)
        assert [r["low"] for r in rows] == pytest.approx(list(edges[:-1]))
    odd = spark.createDataFrame([(None,), (2.0,), (2.0,), (float("inf"),), (float("nan"),)], "v double")
    assert sum(r["n"] for r in profile.histogram(odd, bins=4).collect()) == 2
    assert profile.histogram(odd.limit(0)).count() == 0


def test_frequent_values(df, frame):
    rows = profile.frequent_values(df, ["g", "hot"], 2).collect()
    top = {(r["column"], r["place"]): (r["value"], r["n"]) for r in rows}
    counts = frame["g"].value_counts()
    assert top[("g", 1)] == (counts.index[0], counts.iloc[0]) and top[("hot", 1)][0] == "0.0" and len(rows) == 4


@pytest.mark.parametrize("rows_per_bucket", [10**9, 100])
def test_correlations(df, frame, rows_per_bucket):
    columns = ["x", "hot", "y"]
    for got, expected in ((profile.correlations(df, columns), frame[columns].corr()),
                          (profile.rank_correlations(df, columns, rows_per_bucket), frame[columns].corr("spearman"))):
        for r in got.collect():
            assert r["correlation"] == pytest.approx(expected.loc[r["first"], r["second"]], abs=1e-9)


def test_rank_correlation_skips_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, None), (4.0, 9.0), (5.0, float("nan"))], "a double, b double")
    assert profile.rank_correlations(df).first()["correlation"] == pytest.approx(0.5)


def test_association(df, frame):
    got = profile.associations(df, ["g", "h"]).first()
    table = pd.crosstab(frame["g"], frame["h"]).to_numpy(dtype=float)
    n = table.sum()
    expected = np.outer(table.sum(1), table.sum(0)) / n
    phi2 = ((table - expected) ** 2 / expected).sum() / n
    r, c = table.shape
    assert got["cramers_v"] == pytest.approx(np.sqrt(phi2 / (min(r, c) - 1)))
    fixed = max(0, phi2 - (r - 1) * (c - 1) / (n - 1))
    bounds = min(r - (r - 1) ** 2 / (n - 1), c - (c - 1) ** 2 / (n - 1))
    assert got["cramers_v_corrected"] == pytest.approx(np.sqrt(fixed / (bounds - 1)))


def test_duplicates_ratio_and_advice(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("c", 3)], "x string, y int")
    assert sorted(map(str, map(tuple, profile.duplicate_rows(df).collect()))) == ["('a', 1, 2)", "('b', None, 2)"]
    ratio = {r["x"]: r["share"] for r in profile.class_ratio(df, "x").collect()}
    assert ratio == {"a": 0.4, "b": 0.4, "c": 0.2}
    close = spark.createDataFrame([("a", "b", -0.95), ("a", "c", 0.2)], "first string, second string, correlation double")
    tied = spark.createDataFrame([("p", "income", 0.01), ("q", "income", 0.5), ("p", "q", 0.95)],
                                 "first string, second string, cramers_v double")
    advice = profile.drop_advice(close, tied, "income")
    assert sorted(map(tuple, advice.collect())) == [("b", "correlated"), ("p", "weak"), ("q", "correlated")]
