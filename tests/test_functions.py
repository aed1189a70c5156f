import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle import functions as fn


def one(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], ddl).select(column).collect()]


def test_clean_category_strips_what_python_strips(spark):
    ends = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["\u200b", "\ufeff", "."]
    rows = [f"{e}{e}Ab c{e}" for e in ends]
    expected = [r.strip().lower().replace(".", "").replace(",", "").replace(" ", "-") for r in rows]
    assert one(spark, rows, "v string", fn.clean_category(F.col("v"))) == expected


def test_clean_category(spark):
    rows = [None, "", " ", "\tPrivate", " A. b,c d", "a  b", "US.", " Wide ", " <=50K."]
    got = one(spark, rows, "v string", fn.clean_category(F.col("v")))
    assert got == [None, "", "", "private", "a-bc-d", "a--b", "us", "wide", "<=50k"]


@pytest.mark.parametrize("ddl", ["v int", "v double"])
def test_age_band_whole(spark, ddl):
    ages = [19, 20, 29, 30, 39, 40, 49, 50, 59, 60, 99, 100, -1, None]
    rows = ages if ddl == "v int" else [None if a is None else float(a) for a in ages]
    assert one(spark, rows, ddl, fn.age_band(F.col("v"))) == [
        "teens", "20s", "20s", "30s", "30s", "40s", "40s", "50s", "50s", "60+", "60+", "other", "teens", "other"]


def test_age_band_fraction_and_nan(spark):
    assert one(spark, [20.5, 19.5, 18.5, float("nan")], "v double", fn.age_band(F.col("v"))) == [
        "other", "other", "teens", "other"]


def test_shifted_log(spark):
    got = one(spark, [0.0, -1.0, -2.0, None, float("nan"), 1e300], "v double", fn.shifted_log(F.col("v")))
    assert got[:5] == [0.0, float("-inf"), None, None, None]
    assert got[5] == pytest.approx(math.log(1e300))


def test_to_number_and_float(spark):
    rows = [" 12 ", "1e3", "abc", "", None, "12d", "1.5f", "-0.5", "inf"]
    assert one(spark, rows, "v string", fn.to_number(F.col("v"))) == [
        12.0, 1000.0, None, None, None, None, None, -0.5, float("inf")]
    assert one(spark, ["0.5", "x", None], "v string", fn.to_float(F.col("v"))) == [0.5, None, None]


def test_merge_maps(spark):
    df = spark.createDataFrame(
        [({"a": 0.5, "k": 1.0}, {"k": "text", "model": "xgb"}), (None, {"p": "1"}), ({"m": 2.0}, None)],
        "metrics map<string,double>, params map<string,string>")
    got = [r[0] for r in df.select(fn.merge_maps(F.col("metrics"), F.col("params"))).collect()]
    assert got == [{"a": "0.5", "k": "text", "model": "xgb"}, {"p": "1"}, {"m": "2.0"}]


def test_threshold_flag(spark):
    assert one(spark, [0.05, 0.049, None, 1.0], "v double", fn.threshold_flag(F.col("v"), 0.05)) == [1, 0, None, 1]


def test_dates_and_labels(spark):
    df = spark.createDataFrame(
        [(dt.date(2010, 1, 1), dt.datetime(2010, 1, 1, 23, 59)), (dt.date(2000, 1, 1), dt.datetime(2010, 1, 2))],
        "d date, t timestamp_ntz")
    assert df.filter(fn.on_date(F.col("d"), "2010-01-01")).count() == 1
    assert df.filter(fn.on_date(F.col("t"), "2010-01-01", timestamp=True)).count() == 1
    assert df.select(fn.fixed_date("2000-01-01")).first()[0] == dt.date(2000, 1, 1)
    label = fn.case_label(F.year("d").cast("string"), {"2010": "new"}, "old")
    assert [r[0] for r in df.select(label).collect()] == ["new", "old"]


def test_noise_is_repeatable_and_bounded(spark):
    df = spark.range(2000).withColumn("key", F.col("id").cast("string"))
    first = [r[0] for r in df.orderBy("id").select(fn.row_noise(["key"], 7)).collect()]
    again = [r[0] for r in df.repartition(5).orderBy("id").select(fn.row_noise(["key"], 7)).collect()]
    assert first == again and set(first) == set(range(21))
