import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import boosting
from tabular_lifecycle.operators.boosting import BoostedModel, Node, Settings
from tabular_lifecycle.operators.path_attribution import leaf_paths, path_shapley
from test_boosting import DDL, made_rows

NAMES = ["a", "b", "c"]


def by_subsets(spark, model, examples, background):
    """{(key, column): value} from every subset of every pair of rows, scored by the model itself."""
    mixed = [(f"{e}|{s}", *[x[i] if s >> (i - 1) & 1 else b[i] for i in (1, 2, 3)], None)
             for e, x in enumerate(examples) for b in background for s in range(8)]
    odds = model.score(spark.createDataFrame(mixed, DDL)).groupBy("k").agg(
        F.avg(F.log(F.col("probability") / (1 - F.col("probability")))).alias("w"))
    worth = {tuple(map(int, r["k"].split("|"))): r["w"] for r in odds.collect()}
    values = {}
    for e, x in enumerate(examples):
        for i, name in enumerate(NAMES):
            rest, total = [j for j in range(3) if j != i], 0.0
            for size in range(3):
                for chosen in combinations(rest, size):
                    s = sum(1 << j for j in chosen)
                    total += (worth[e, s | 1 << i] - worth[e, s]) * math.factorial(size) * math.factorial(2 - size) / 6
            values[x[0], name] = total
    return values


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(made_rows(), DDL)
    return boosting.fit(df, F.col("label"), ["a", "b"], ["c"], ["k"], Settings(
        rounds=4, depth=4, rate=0.5, row_share=1.0, column_share=1.0, min_child_weight=0.2))


def test_equals_all_subsets(spark, model):
    """Columns met twice on a path, missing and not-a-number values, unseen and NULL categories, repeated background rows."""
    assert any(len(p.steps) > len(p.columns) for p in leaf_paths(model))
    background = made_rows(40) + [("n", None, float("nan"), None, None)] * 3
    examples = [("e1", 1.0, 4.0, "x", None), ("e2", None, 0.0, "unseen", None), ("e3", float("nan"), None, None, None),
                ("e4", 5.0, 2.0, "", None)]
    wanted = by_subsets(spark, model, examples, background)
    rows = spark.createDataFrame(background, DDL).repartition(5)
    got = path_shapley(spark.createDataFrame(examples, DDL), rows, model, ["k"], silent=["race"]).collect()
    values = {(r["k"], r["feature"]): r["value"] for r in got}
    assert len(got) == len(values) == 16 and all(values[k, "race"] == 0.0 for k in ("e1", "e2", "e3", "e4"))
    for place, value in wanted.items():
        assert values[place] == pytest.approx(value, abs=1e-9)
    assert any(abs(v) > 0.1 for v in values.values())


def test_values_add_up_over_a_large_background(spark, model):
    df = spark.createDataFrame(made_rows(2000), DDL)
    odds = F.log(F.col("probability") / (1 - F.col("probability")))
    mean = model.score(df).agg(F.avg(odds)).first()[0]
    some = df.filter(F.col("k").cast("int") < 50).dropDuplicates(["k"])
    own = {r["k"]: r["odds"] for r in model.score(some).select("k", odds.alias("odds")).collect()}
    sums = {r["k"]: r["s"] for r in path_shapley(some, df, model, ["k"]).groupBy("k").agg(F.sum("value").alias("s")).collect()}
    assert sums.keys() == own.keys() and len(own) == 50
    assert all(sums[k] == pytest.approx(own[k] - mean, abs=1e-9) for k in own)


def test_equal_keys_no_cuts_and_empty_tables(spark, model):
    df = spark.createDataFrame(made_rows(20), DDL)
    twice = spark.createDataFrame([("e", 1.0, 4.0, "x", None), ("e", 5.0, 0.0, "y", None)], DDL)
    assert path_shapley(twice, df, model, ["k"]).count() == 6
    flat = BoostedModel(("a", "b"), ("c",), 2, 0.0, (Node(0, 1, leaf=0.3),))
    assert {r["value"] for r in path_shapley(twice, df, flat, ["k"]).collect()} == {0.0}
    assert path_shapley(twice.filter(F.lit(False)), df, model, ["k"]).count() == 0
    with pytest.raises(ValueError):
        path_shapley(twice, df.filter(F.lit(False)), model, ["k"])


def test_background_rows_are_counted_by_turns_of_groups(spark, model):
    """A row is one row a group of leaves and not one a leaf; the turns tell of every leaf which columns fit, in both forms."""
    from tabular_lifecycle.operators import path_attribution as pa

    paths = leaf_paths(model)
    groups = pa._groups(paths)
    assert [leaf for _, leaves in groups for leaf in leaves] == list(range(len(paths))) and 1 < len(groups) < len(paths) / 2
    assert all(len(places) <= pa._CUTS_AT_ONCE for places, _ in groups)
    rows = made_rows(30) + [("n", None, float("nan"), None, None), ("u", 7.0, 3.0, "unseen", None)]
    df = spark.createDataFrame(rows, DDL)
    nodes, width = {(n.tree, n.node): n for n in model.nodes}, 2 ** (model.depth + 1)

    def left(row, place):
        node = nodes[place // width, place % width]
        value = row[1 + node.column]
        if node.column == 2:
            return value == node.value
        return node.missing_left if value is None or value != value else value <= node.cut

    wanted = sorted((row[0], leaf, sum(1 << i for i in range(len(p.columns)) if all(left(row, place) == side for place, side, bit in p.steps if bit == i)))
                    for row in rows for leaf, p in enumerate(paths))
    for plain_cuts in (0, 1000):
        turned = df.select("k", F.posexplode(pa._turns(model, groups, plain_cuts)).alias("group", "turns"))
        assert turned.count() == len(rows) * len(groups)
        assert sorted(map(tuple, pa._fitting(turned, paths, groups, "mine").select("k", "leaf", "mine").collect())) == wanted


def test_long_paths_are_groups_of_their_own():
    from tabular_lifecycle.operators import path_attribution as pa

    paths = [pa.LeafPath(0.0, tuple((i * 100 + j, True, 0) for j in range(20)), ("a",)) for i in range(3)]
    assert [len(places) for places, _ in pa._groups(paths)] == [20, 20, 20]
