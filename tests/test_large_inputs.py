"""Work that grows with the rows is done once, and generated methods stay short."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabular_lifecycle.operators import evaluate, features, models, profile
from tabular_lifecycle.registry import model_queries, stump_queries


def _row(spark, columns, numbers=()):
    return spark.range(1).select(*[F.lit(1.0 if c in numbers else "a").alias(c) for c in columns])


def test_inference_and_its_perturbed_copy_come_from_one_writing(spark, monkeypatch):
    numbers, calls = (*model_queries.NUMERIC_INPUTS,), []
    rows = _row(spark, ["row_key", "income", *model_queries.INPUTS.columns], numbers)
    monkeypatch.setattr(model_queries.fx, "inference", lambda *a: calls.append(a) or rows)
    new, changed = model_queries.inference_sides(spark, "nowhere")
    assert len(calls) == 1 and new.inputFiles() == changed.inputFiles() and new.inputFiles()
    assert 0 <= changed.first()["fnlwgt"] - new.first()["fnlwgt"] <= 20


def test_standardized_one_hot_is_one_test_a_column(spark, capsys):
    rows = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    made = features.standardize(features.one_hot(rows, {"c": ["x", "y"]}), {"c_x": (0.25, 0.5), "c_y": (0.5, 0.25)})
    assert [tuple(r) for r in made.select("c_x", "c_y").collect()] == [(1.5, -2.0), (-0.5, 2.0), (-0.5, -2.0)]
    made.select("c_x", "c_y").explain()
    plan = capsys.readouterr().out
    assert " / " not in plan and "0.25" not in plan


def test_contingency_cells_are_counted_once(spark, capsys):
    rows = spark.createDataFrame([("a", "p"), ("b", "q"), ("a", "p")], "x string, y string")
    found = profile.associations(rows, ["x", "y"])
    found.explain()
    assert "Generate" not in capsys.readouterr().out
    assert abs(found.first()["cramers_v"] - 1.0) < 1e-9


def test_model_attribution_splits_once(spark, monkeypatch):
    calls, rows = [], _row(spark, ["row_key", *stump_queries.SUPPORTED])
    monkeypatch.setattr(stump_queries, "split_training", lambda *a: calls.append(a) or (rows, rows))
    monkeypatch.setattr(stump_queries.models, "fit_stages", lambda *a: None)
    monkeypatch.setattr(stump_queries, "fixed_sample", lambda df, *a: df)
    monkeypatch.setattr(stump_queries, "shapley_values", lambda *a, **k: rows.select(F.lit(0.0).alias("value")))
    assert stump_queries.model_attribution(spark, "nowhere").first()["value"] == 0.0
    assert len(calls) == 1


def test_metrics_score_every_row_once(spark, capsys):
    """No filter on the probability is pushed below the model; rows without one, or without a label, take no part."""
    rows = spark.createDataFrame([(True, 0.75), (False, 0.25), (True, 0.25), (None, 0.5), (False, float("nan"))], "y boolean, p double")
    rows = rows.unionByName(rows.limit(1).select("y", F.lit(None).cast("double").alias("p")))
    chance = vector_to_array(array_to_vector(F.array(F.coalesce("p", F.lit(float("nan"))))))[0]
    scored = rows.select("y", chance.alias("chance"), F.lit("d").alias("dataset"))
    made = evaluate.classification_metrics(scored, F.col("y"), F.col("chance") > 0.5, F.col("chance"))
    made.explain()
    plan = capsys.readouterr().out
    assert "UDF(" in plan and not [line for line in plan.splitlines() if "Filter" in line and "UDF(" in line]
    row = made.first()
    assert abs(row.accuracy_score - 2 / 3) < 1e-12 and row.roc_auc_score == 0.75


def test_metrics_of_a_group_without_scores(spark):
    rows = spark.createDataFrame([("a", True, 0.75), ("a", False, 0.25), ("b", True, None), ("c", None, 0.5)], "dataset string, y boolean, p double")
    made = evaluate.classification_metrics(rows, F.col("y"), F.col("p") > 0.5, F.col("p")).collect()
    assert [(r.dataset, r.accuracy_score) for r in made] == [("a", 1.0)]


def test_dealt_rows_are_shuffled_once(spark):
    rows = spark.range(1000, numPartitions=1).select("id", (F.col("id") % 2).cast("double").alias("target"))
    dealt = models.spread(rows, ["target", "id"], rows_per_task=250)
    plan = dealt.filter("id > 3").groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "Existing" in plan and "REPARTITION" not in plan
    fresh = rows.repartition(dealt.rdd.getNumPartitions()).sortWithinPartitions("target", "id")
    assert dealt.rdd.glom().collect() == fresh.rdd.glom().collect()


def test_all_candidates_of_a_search_read_one_dealing(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "ab"[i % 2], 0.5 * i, "yes" if i % 3 else "no") for i in range(60)], "k long, c string, x double, y string")
    inputs, calls, deal = models.Inputs(["x"], ["c"], "y", "yes", ["k"]), [], models.spread
    monkeypatch.setattr(models, "spread", lambda *a: calls.append(a) or deal(*a, rows_per_task=10))
    trees = [("tree", DecisionTreeClassifier(featuresCol="features", labelCol="target", maxDepth=d), {"depth": str(d)}) for d in (1, 2)]
    log, _ = models.search_models(rows, rows, inputs, "e", trees, budget_seconds=float("inf"))
    assert log.count() == 2 and len(calls) == 1
    calls.clear()
    log, _ = models.halving_search(rows, rows, inputs, "e", trees, shares=(0.5, 1.0), budget_seconds=float("inf"))
    assert log.count() == 3 and len(calls) == 2


def test_saved_model_writes_its_training_rows_once(spark, monkeypatch):
    rows, seen = _row(spark, ["row_key", "income", *model_queries.INPUTS.columns], (*model_queries.NUMERIC_INPUTS,)), []

    def fit(train, inputs):
        seen.append(train.inputFiles())
        raise LookupError

    monkeypatch.setattr(model_queries.fx, "training", lambda *a: rows)
    monkeypatch.setattr(model_queries.models, "fit_stages", fit)
    with pytest.raises(LookupError):
        model_queries.save_and_load(spark, "nowhere")
    assert seen == [[]]
