import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import relational as rel
from tabular_lifecycle.operators import runs
from tabular_lifecycle.plans import monitor
from tabular_lifecycle.sources import RUN_LOG_SCHEMA


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_select_supported(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    assert rel.select_supported(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing"):
        rel.select_supported(df, ["c"])


def test_strip_tokens_everywhere_in_the_name(spark):
    df = spark.createDataFrame([(1, 2)], "val_f1 int, interval_test_x int")
    assert rel.strip_tokens(df, ["val_", "test_"]).columns == ["f1", "interx"]


def test_means(spark):
    df = spark.createDataFrame([("a", 1, 1.5, "x"), ("a", 2, 2.5, "y"), ("b", 5, None, "z")],
                               "k string, n int, v double, t string")
    assert rows(rel.means_of_numbers(df, "k")) == [("a", 1.5, 2.0), ("b", 5.0, None)]
    assert rel.mean_by(df, "k", "n", "m").collect()[0] == ("b", 5.0)
    assert rel.mean_by(df, "k", "n", "m").collect()[1] == ("a", 2.0)  # 1.5 rounds away from zero
    tagged = rel.means_tagged(df, ["n"], "year", "2010")
    assert rows(tagged)[0][1] == "2010"
    assert rel.means_tagged(df.limit(0), ["n"], "year", "2010").count() == 0


def test_union_of_yearly_means(spark):
    columns = ["fnlwgt", "hours_per_week", "log_capital_gain", "log_capital_loss"]
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], ", ".join(f"{c} double" for c in columns))
    assert monitor.data_drift(df, df).count() == 2
    assert monitor.data_drift(df, df.limit(0)).count() == 1
    same = rel.means_tagged(df, columns, "year", "2010")
    assert rel.union_distinct(same, same).count() == 1
    chart = monitor.data_drift_charts(monitor.data_drift(df, df))
    assert rows(chart.select("year", "hours_per_week", "fnlwgt")) == [("2000", 2.0, 1.0), ("2010", 2.0, 1.0)]


def test_drop_incomplete_head_and_count(spark):
    df = spark.createDataFrame([(1, "?"), (None, "b"), (3, None)], "x int, y string")
    assert rows(rel.drop_incomplete(df)) == [(1, "?")]
    assert rel.head(df, 1, [F.desc("x")]).first()["x"] == 3
    assert rel.count_where(df, F.col("x") == 1, "n").first()[0] == 1
    assert rel.count_where(df.limit(0), F.col("x") == 1, "n").first()[0] is None
    features, label = rel.separate_label(df, "y")
    assert features.columns == ["x"] and label.columns == ["y"]


def log(spark, entries):
    start = dt.datetime(2022, 2, 18, 7, 7, 0)
    return spark.createDataFrame(
        [(r, "e", m, p, start, start + dt.timedelta(seconds=s)) for r, m, p, s in entries], RUN_LOG_SCHEMA)


def test_refine_runs(spark):
    df = log(spark, [
        ("r1", {"val_f1_score": 0.346821}, {"model": "Pipeline(...)", "depth": "5", "booster": "gbtree"}, 61),
        ("r2", {"val_f1_score": 0.5, "only_here": 2.0}, {"depth": "7"}, 0),
    ])
    wide = runs.refine_runs(df)
    assert set(wide.columns) == {"run_id", "experiment_id", "start_time", "end_time", "val_f1_score", "depth",
                                 "booster", "only_here", "trainingDuration"}
    got = {r["run_id"]: r for r in wide.collect()}
    assert got["r1"]["val_f1_score"] == pytest.approx(0.346821, abs=1e-7)
    assert got["r1"]["booster"] is None and got["r1"]["only_here"] is None and got["r1"]["depth"] == 5.0
    assert got["r1"]["trainingDuration"] == 61 and got["r2"]["trainingDuration"] == 0
    assert dict(wide.dtypes)["trainingDuration"] == "int"
    known = runs.refine_runs(df, keys=["depth"])
    assert known.columns == ["run_id", "experiment_id", "start_time", "end_time", "depth", "trainingDuration"]


def test_refine_no_runs(spark):
    assert runs.refine_runs(log(spark, [])).count() == 0


def test_monitor_queries(spark):
    history = spark.createDataFrame(
        [(dt.date(2000, 1, 1), "a", "x", 0.5, 0.01, 0), (dt.date(2010, 1, 1), "b", "x", 0.1, 0.4, 1)],
        "date date, dataset string, column string, statistic float, pvalue float, passed int")
    assert monitor.numerical_drift(history).columns == ["feature", "statistic", "pvalue", "passed"]
    assert monitor.numerical_drift(history).count() == 1
    assert monitor.total_failures(history).first()[0] == 1
    metrics = spark.createDataFrame([("m", 0.5), ("i", 0.75), ("t", 1.0)], "dataset string, roc_auc_score double")
    drifted = monitor.metric_drift(metrics, "m", "i")
    assert rows(drifted) == [("2000", 0.75), ("2010", 0.5)]
    assert rows(monitor.metric_drift_chart(drifted)) == [("2000", 0.75), ("2010", 0.5)]


def test_complete_rows_are_those_that_are_kept(spark):
    rows = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, 1.0, None), (None, 1.0, "e")],
                                 "n int, x double, s string")
    kept = rel.drop_incomplete(rows)
    assert sorted(map(tuple, rows.filter(rel.complete(rows)).collect())) == sorted(map(tuple, kept.collect())) == [(1, 1.0, "a")]
