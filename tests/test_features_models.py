import math
from itertools import permutations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabular_lifecycle.operators import features, models
from tabular_lifecycle.operators.attribution import shapley_values
from tabular_lifecycle.operators.evaluate import METRICS, classification_metrics, metric_table, prefixed
from tabular_lifecycle.sources import RUN_LOG_SCHEMA


def test_imputation(spark):
    train = spark.createDataFrame([("1", 1.0), ("x", None), ("3", float("nan"))], "a string, b double")
    means = features.fit_means(train, ["a", "b"])
    assert means == {"a": 2.0, "b": 1.0}
    new = spark.createDataFrame([("bad", None), ("5", float("nan"))], "a string, b double")
    assert [tuple(r) for r in features.fill_means(new, means).collect()] == [(2.0, 1.0), (5.0, 1.0)]


def test_one_hot(spark):
    train = spark.createDataFrame([("x", "p"), ("y", None), ("x", "q")], "c string, d string")
    categories = features.fit_categories(train, ["c", "d"])
    assert categories == {"c": ["x", "y"], "d": ["p", "q"]}
    new = spark.createDataFrame([("x", "q"), ("unseen", None)], "c string, d string")
    wide = features.one_hot(new, categories)
    assert [tuple(r) for r in wide.select("c_x", "c_y", "d_p", "d_q").collect()] == [(1, 0, 0, 1), (0, 0, 0, 0)]
    stages = features.encoding_stages(train, [], ["c", "d"])[1:-1]
    made = Pipeline(stages=stages).fit(train).transform(new)
    hot = made.select(vector_to_array("c_hot"), vector_to_array("d_hot")).collect()
    assert [tuple(map(list, r)) for r in hot] == [([1, 0], [0, 1]), ([0, 0], [0, 0])]


def test_many_categories_stay_sparse(spark):
    train = spark.range(3000).select(F.col("id").cast("string").alias("c"), F.lit(1.0).alias("n"))
    row = features.fit_features(train, ["n"], ["c"]).transform(train).first()
    assert row["features"].size == 3001 and len(row["features"].indices) <= 2


def test_blank_category_and_clashing_names(spark):
    train = spark.createDataFrame([("", "b_c", "c"), ("(blank)", "x", "y"), ("z", None, "c")], "e string, a string, a_b string")
    hot = features.fit_features(train, [], ["e"]).transform(train).select(vector_to_array("features").alias("f")).collect()
    assert [sum(x != 0 for x in r["f"]) for r in hot] == [1, 1, 1] and len({tuple(r["f"]) for r in hot}) == 3
    wide = features.one_hot(train, {"a": ["b_c", "x"], "a_b": ["c", "y"]})
    assert wide.columns[3:] == ["a_b_c", "a_x", "a_b_c_2", "a_b_y"]
    assert [tuple(r)[3:] for r in wide.collect()] == [(1, 0, 1, 0), (0, 1, 0, 1), (0, 0, 1, 0)]


def test_undersample_leaves_out_missing_labels_and_cuts_evenly(spark):
    from tabular_lifecycle.operators.sampling import undersample

    rows = [("a", i % 20) for i in range(2000)] + [("b", i % 20) for i in range(600)] + [(None, 1)] * 3
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "label string, cell int, n int")
    kept = undersample(df, "label", sorted(df.columns), 1).groupBy("label", "cell").count().collect()
    assert {r["label"] for r in kept} == {"a", "b"} and sum(r["count"] for r in kept) == 1200
    assert all(10 < r["count"] < 55 for r in kept if r["label"] == "a")


def test_missing_probabilities_take_no_part(spark):
    rows = [("d", True, True, 0.9), ("d", False, False, 0.2), ("d", True, False, float("nan")), ("d", False, True, None)]
    df = spark.createDataFrame(rows, "dataset string, y boolean, predicted boolean, p double")
    got = classification_metrics(df, F.col("y"), F.col("predicted"), F.col("p")).first()
    assert got["accuracy_score"] == 1.0 and got["log_loss"] == pytest.approx(-(math.log(0.9) + math.log(0.8)) / 2)


def test_standardize_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = features.standardize(df, features.fit_scales(df, ["a", "b"]))
    assert [tuple(r) for r in scaled.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def brute_metrics(label, predicted, p):
    label, predicted, p = map(np.asarray, (label, predicted, p))
    scores = {}
    weights, precision, recall, f1 = [], [], [], []
    for c in (True, False):
        tp = np.sum((label == c) & (predicted == c))
        pp, rr = tp / max(np.sum(predicted == c), 1), tp / max(np.sum(label == c), 1)
        weights.append(np.mean(label == c))
        precision.append(pp), recall.append(rr), f1.append(2 * pp * rr / (pp + rr) if pp + rr else 0.0)
    scores["accuracy_score"] = np.mean(label == predicted)
    for name, values in (("precision_score", precision), ("recall_score", recall), ("f1_score", f1)):
        scores[name] = np.dot(weights, values)
    clipped = np.clip(p, 1e-15, 1 - 1e-15)
    scores["log_loss"] = -np.mean(np.where(label, np.log(clipped), np.log(1 - clipped)))
    wins = [(a > b) + 0.5 * (a == b) for a in p[label] for b in p[~label]]
    scores["roc_auc_score"] = np.mean(wins) if wins else None
    return scores


def metric_rows(spark, cases):
    rows = [(name, bool(y), bool(yy), float(pp)) for name, (l, pr, p) in cases.items() for y, yy, pp in zip(l, pr, p)]
    df = spark.createDataFrame(rows, "dataset string, y boolean, predicted boolean, p double").repartition(4)
    got = classification_metrics(df, F.col("y"), F.col("predicted"), F.col("p"))
    return {r["dataset"]: r for r in got.collect()}


def test_metrics_against_brute_force(spark):
    rng = np.random.default_rng(4)
    y = rng.random(600) < 0.3
    tied = np.round(np.clip(rng.normal(0.3 + 0.2 * y, 0.2), 0, 1), 1)
    tiny = 10.0 ** -rng.uniform(0, 18, 600)
    cases = {
        "perfect": ([1, 0, 1], [1, 0, 1], [1.0, 0.0, 1.0]), "wrong": ([1, 0], [0, 1], [0.0, 1.0]),
        "one": ([1, 1], [1, 0], [0.9, 0.2]), "tied": (y, tied >= 0.5, tied), "tiny": (y, tiny >= 0.5, tiny),
        "smooth": (y, tied >= 0.5, rng.random(600)),
    }
    got = metric_rows(spark, cases)
    for name, case in cases.items():
        expected = brute_metrics(*[np.asarray(x, dtype=bool if i < 2 else float) for i, x in enumerate(case)])
        for m, value in expected.items():
            if value is None:
                assert got[name][m] is None
            else:
                assert got[name][m] == pytest.approx(value, abs=1e-9), (name, m)


def test_metric_table_shape(spark):
    df = spark.createDataFrame([("d", *[0.5] * 6)], "dataset string, " + ", ".join(f"{m} double" for m in METRICS))
    assert metric_table(df).columns == [*METRICS, "dataset"]
    assert prefixed(df, "val_").columns[1] == "val_accuracy_score"


def people(spark, n=600):
    return spark.range(n).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 40).cast("double")).alias("hours"),
        F.concat(F.lit("job"), F.col("id") % 3).alias("job"), F.lit("one").alias("place"),
        F.when((F.col("id") % 40 > 28) | (F.col("id") % 11 == 0), ">50k").otherwise("<=50k").alias("income"),
        F.col("id").alias("extra"),
    )


INPUTS = models.Inputs(["hours"], ["job", "place"], "income", ">50k", ["key"])


def test_fit_score_save_load(spark, tmp_path):
    df = people(spark)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="target", maxDepth=4, seed=1)
    model = models.fit_stages(df.drop("extra"), INPUTS, tree)
    new = spark.createDataFrame([("n1", None, "unseen", "elsewhere", "<=50k", 1), ("n2", 35.0, None, "one", ">50k", 2)], df.schema)
    scored = models.score(model, df.unionByName(new).withColumn("dataset", F.lit("all")))
    assert scored.count() == 602 and "extra" in scored.columns
    assert models.evaluate(scored, INPUTS).first()["roc_auc_score"] > 0.8
    path = models.save_model(model, str(tmp_path), "income", 3)
    models.save_model(model, str(tmp_path), "income", 3)
    assert path.endswith("/income/3")
    again = models.score(models.load_model(str(tmp_path), "income", 3), df)
    before = {r["key"]: r["probability"] for r in scored.collect()}
    assert all(before[r["key"]] == r["probability"] for r in again.collect())


def test_boosting_settings():
    gbt = models.boosted_trees()
    assert (gbt.getMaxDepth(), gbt.getMaxIter(), gbt.getMinInstancesPerNode()) == (5, 30, 5)
    assert gbt.getStepSize() == 0.26571572922086373 and gbt.getSubsamplingRate() == 0.6859242756647854


def test_search_keeps_to_its_budget(spark):
    df = people(spark, 300)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="target", maxDepth=3, seed=1)
    log, best = models.search_models(df, df, INPUTS, "exp", [("a", tree, {"x": "1"}), ("b", tree, {})], budget_seconds=0)
    assert log.schema == RUN_LOG_SCHEMA and log.count() == 1
    row = log.first()
    assert row["params"] == {"model": "a", "x": "1"} and row["end_time"] >= row["start_time"]
    assert set(row["metrics"]) == {f"val_{m}" for m in METRICS}
    assert models.score(best, df).count() == 300


def test_halving_search_drops_and_grows(spark):
    df = people(spark)
    tree = lambda **o: DecisionTreeClassifier(featuresCol="features", labelCol="target", seed=1, **o)
    candidates = [("flat", tree(maxDepth=0), {}), ("deep", tree(maxDepth=4), {}), ("stump", tree(maxDepth=1), {}), ("flat", tree(maxDepth=0), {"again": "1"})]
    log, best = models.halving_search(df, df, INPUTS, "exp", candidates, shares=(0.25, 0.5, 1.0), budget_seconds=float("inf"))
    full, winner = models.search_models(df, df, INPUTS, "exp", candidates, budget_seconds=float("inf"))
    assert best.stages[-1].toDebugString.split("\n", 1)[1] == winner.stages[-1].toDebugString.split("\n", 1)[1]
    rungs = [(r["params"]["share"], r["params"]["model"]) for r in log.collect()]
    assert [sum(share == s for s, _ in rungs) for share in ("0.25", "0.5", "1.0")] == [4, 2, 1]
    assert rungs[-1] == ("1.0", "deep") and full.count() == 4
    short, _ = models.halving_search(df, df, INPUTS, "exp", candidates, budget_seconds=0)
    assert short.count() == 1
    with pytest.raises(ValueError):
        models.halving_search(df, df, INPUTS, "exp", candidates, shares=(0.5, 0.25))


def test_search_by_loss_and_without_the_metric(spark):
    df = people(spark, 300)
    tree = lambda depth: DecisionTreeClassifier(featuresCol="features", labelCol="target", maxDepth=depth, seed=1)
    candidates = [("flat", tree(0), {}), ("deep", tree(4), {})]
    log, best = models.search_models(df, df, INPUTS, "exp", candidates, budget_seconds=float("inf"), primary_metric="log_loss")
    losses = {r["params"]["model"]: r["metrics"]["val_log_loss"] for r in log.collect()}
    assert losses["deep"] < losses["flat"] and best.stages[-1].depth > 0
    one_class = df.filter(F.col("income") == df.first()["income"])
    log, best = models.search_models(df, one_class, INPUTS, "exp", candidates, budget_seconds=float("inf"), primary_metric="roc_auc_score")
    assert log.count() == 2 and best.stages[-1].depth == 0


def rule(df):
    odds = F.col("a") * 0.5 - F.col("b") + F.when(F.col("c") == "x", F.col("a")).otherwise(0.0)
    return df.withColumn("probability", 1 / (1 + F.exp(-odds)))


def test_shapley_against_permutations(spark):
    background = [(0.0, 1.0, "x"), (1.0, 0.5, "y"), (2.0, 0.0, "x")]
    examples = [("e1", 1.5, -1.0, "x"), ("e2", 0.0, 1.0, "y")]
    names = ["a", "b", "c"]

    def worth(example, subset):
        total = 0.0
        for row in background:
            a, b, c = (example[i] if i in subset else row[i] for i in range(3))
            total += 1 / (1 + math.exp(-(a * 0.5 - b + (a if c == "x" else 0.0))))
        mean = total / len(background)
        return math.log(mean / (1 - mean))

    got = shapley_values(
        spark.createDataFrame(examples, "key string, a double, b double, c string"),
        spark.createDataFrame(background, "a double, b double, c string"), names, ["key"], rule, silent=["race"])
    values = {(r["key"], r["feature"]): r["value"] for r in got.collect()}
    assert len(values) == 8 and values[("e1", "race")] == 0.0
    for key, *example in examples:
        for i, name in enumerate(names):
            shares = [worth(example, set(order[:order.index(i) + 1])) - worth(example, set(order[:order.index(i)]))
                      for order in permutations(range(3))]
            assert values[(key, name)] == pytest.approx(sum(shares) / 6, abs=1e-9)


def test_shapley_with_a_spread_background_and_equal_keys(spark):
    names = ["a", "b", "c"]
    rows = [(float(i % 5), float(i % 3), "xy"[i % 2]) for i in range(60)]
    background = spark.createDataFrame(rows, "a double, b double, c string").repartition(7)
    examples = [("e", 1.5, -1.0, "x"), ("e", 0.0, 1.0, "y")]
    schema = "key string, a double, b double, c string"
    both = shapley_values(spark.createDataFrame(examples, schema), background, names, ["key"], rule).collect()
    apart = [r for e in examples for r in shapley_values(spark.createDataFrame([e], schema), background, names, ["key"], rule).collect()]
    near = lambda rows: sorted((r["feature"], round(r["value"], 9)) for r in rows)
    assert near(both) == near(apart) and len(both) == 6


def test_rows_of_a_fit_are_dealt_evenly(spark):
    rows = spark.range(0, 4000, 1, 1).select((F.col("id") % 2).cast("double").alias("target"), "id")
    dealt = models.spread(rows, ["target", "id"], rows_per_task=250)
    held = [len(part) for part in dealt.rdd.glom().collect()]
    assert len(held) == 16 and max(held) <= 300 and sum(held) == 4000
    assert sorted(r.id for r in dealt.collect()) == list(range(4000))
    assert models.spread(rows, ["id"], rows_per_task=4000).rdd.getNumPartitions() == 1
