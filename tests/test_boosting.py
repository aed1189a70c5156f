import math
import random

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import boosting
from tabular_lifecycle.operators.boosting import Settings
from tabular_lifecycle.runtime import fresh_path

PLAIN = Settings(rounds=4, depth=3, rate=0.3, row_share=1.0, column_share=1.0, min_child_weight=0.5)
DDL = "k string, a double, b double, c string, label boolean"


def made_rows(n=300):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        a = rng.choice([None, float("nan"), 1.0, 2.0, 3.0, 5.0])
        b = rng.choice([0.0, 1.0, 2.0, 4.0, 4.0])
        c = rng.choice(["x", "y", "z", "", None])
        odds = (a if a == a and a else 0) - b + (2 if c == "x" else 0)
        rows.append((str(i), a, b, c, rng.random() < 1 / (1 + math.exp(-odds))))
    return rows + rows[:10]


def plain_boosting(rows, settings, cuts):
    """The same trees row by row: (margin of each row, number of cuts)."""
    numbers = [[None if v is None or v != v else v for v in r[1:3]] for r in rows]
    margins, made = [settings.base] * len(rows), 0

    def strength(g, h):
        return g * g / (h + settings.penalty)

    def grow(held, g, h, depth):
        nonlocal made
        best = None
        if depth < settings.depth:
            options = [(i, cut, side) for i, name in enumerate("ab") for cut in [*cuts[name], math.inf] for side in (False, True)]
            options += [(2, v, False) for v in sorted({rows[i][3] for i in held if rows[i][3] is not None})]
            for order, (col, cut, side) in enumerate(options):
                def goes(i):
                    if col == 2:
                        return rows[i][3] == cut
                    return side if numbers[i][col] is None else numbers[i][col] <= cut
                left = [i for i in held if goes(i)]
                right = [i for i in held if not goes(i)]
                hl, hr = sum(h[i] for i in left), sum(h[i] for i in right)
                if not left or not right or min(hl, hr) < settings.min_child_weight:
                    continue
                gain = round(strength(sum(g[i] for i in left), hl) + strength(sum(g[i] for i in right), hr)
                             - strength(sum(g[i] for i in held), hl + hr), 9)
                if gain > settings.least_gain and (best is None or gain > best[0]):
                    best = (gain, left, right)
        if best:
            made += 1
            return grow(best[1], g, h, depth + 1) | grow(best[2], g, h, depth + 1)
        leaf = -settings.rate * sum(g[i] for i in held) / (sum(h[i] for i in held) + settings.penalty)
        return {i: leaf for i in held}

    for _ in range(settings.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g, h = [x - r[4] for x, r in zip(p, rows)], [x * (1 - x) for x in p]
        leaves = grow(list(range(len(rows))), g, h, 0)
        margins = [m + leaves[i] for i, m in enumerate(margins)]
    return margins, made


@pytest.mark.parametrize("settings", [PLAIN, Settings(rounds=7, depth=2, rate=0.5, row_share=1.0, column_share=1.0,
                                                      min_child_weight=4.0, penalty=0.0, least_gain=0.5, base=0.3)])
def test_equals_trees_row_by_row(spark, settings):
    rows, cuts = made_rows(), {"a": [1.0, 2.0, 3.0], "b": [0.0, 1.0, 2.0]}
    df = spark.createDataFrame(rows, DDL)
    model = boosting.fit(df, F.col("label"), ["a", "b"], ["c"], ["k"], settings, cuts)
    margins, made = plain_boosting(rows, settings, cuts)
    assert sum(n.column >= 0 for n in model.nodes) == made > settings.rounds
    got = {r["k"]: r["probability"] for r in model.score(df).collect()}
    for r, m in zip(rows, margins):
        assert got[r[0]] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-9)


def test_stored_model_scores_alike_and_keeps_columns(spark):
    df = spark.createDataFrame(made_rows(), DDL).withColumn("probability", F.lit("old"))
    model = boosting.fit(df, F.col("label"), ["a", "b"], ["c"], ["k"], Settings(rounds=3, depth=2, min_child_weight=1.0))
    path = fresh_path(spark, "boosted")
    model.save(spark, path)
    again = boosting.load(spark, path)
    assert again == model
    new = spark.createDataFrame([("n", None, 9.0, "unseen", None), ("m", float("nan"), -3.0, None, None)], DDL)
    scored = again.score(new)
    assert scored.columns == ["k", "a", "b", "c", "label", "probability", "predicted"]
    assert all(0 < r["probability"] < 1 for r in scored.collect())
    assert again.score(df).columns == ["k", "a", "b", "c", "label", "probability", "predicted"]


def test_draws_repeat_and_take_their_share(spark):
    df = spark.createDataFrame(made_rows(2000), DDL).repartition(5)
    settings = Settings(rounds=2, depth=2, row_share=0.5, column_share=0.6)
    first = boosting.fit(df, F.col("label"), ["a", "b"], ["c"], ["k"], settings)
    again = boosting.fit(df.repartition(3), F.col("label"), ["a", "b"], ["c"], ["k"], settings)
    assert [(n.tree, n.node, n.column, n.cut, n.value) for n in first.nodes] == [
        (n.tree, n.node, n.column, n.cut, n.value) for n in again.nodes]
    assert 0.4 * 2010 < first.nodes[0].cover * 4 < 0.6 * 2010


def test_nothing_to_cut(spark):
    df = spark.createDataFrame(made_rows(20), DDL)
    none = df.filter(F.lit(False))
    model = boosting.fit(none, F.col("label"), ["a"], ["c"], ["k"], PLAIN)
    assert {r["probability"] for r in model.score(df).collect()} == {0.5}
    missing = boosting.fit(df.withColumn("label", F.lit(None).cast("boolean")), F.col("label"), [], ["c"], ["k"], PLAIN)
    assert all(n.column < 0 and n.leaf == 0.0 for n in missing.nodes)


def test_many_categories_need_no_dictionary(spark):
    df = spark.range(20000).selectExpr("string(id) k", "string(id) c", "id % 2 = 0 label")
    model = boosting.fit(df.union(df.filter("false")), F.col("label"), [], ["c"], ["k"], Settings(rounds=1, depth=1, min_child_weight=0.1, row_share=1.0))
    assert len(model.nodes) in (1, 3)


def test_bins_are_the_same_one_by_one_and_in_a_loop(spark, monkeypatch):
    df = spark.createDataFrame(made_rows(60), DDL)
    bins = lambda: [tuple(r) for r in df.select("k", boosting._bin("a", [1.0, 2.5, 3.0]), boosting._bin("b", [0.0, 2.0])).collect()]
    plain = bins()
    monkeypatch.setattr(boosting, "_PLAIN_CUTS", 0)
    assert sorted(bins(), key=str) == sorted(plain, key=str)
    for k, a, b in plain:
        row = next(r for r in made_rows(60) if r[0] == k)
        assert a == (None if row[1] is None or row[1] != row[1] else sum(c < row[1] for c in (1.0, 2.5, 3.0)))
        assert b == sum(c < row[2] for c in (0.0, 2.0))
