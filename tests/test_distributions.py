import random

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import distributions, drift

COLUMNS = ("x", "y")


def sample(spark, seed, n, shift=0.0):
    """Ties, a value that a third of the rows share, NULL and NaN."""
    draw = random.Random(seed)
    rows = [(None if i % 17 == 0 else float("nan") if i % 19 == 0 else round(draw.gauss(shift, 1), 2), 0.0 if i % 3 else draw.random() + shift) for i in range(n)]
    return spark.createDataFrame(rows, "x double, y double")


def tagged(df, name):
    return df.withColumn("name", F.lit(name))


@pytest.mark.parametrize("rows_per_bucket", [5_000_000, 20])
def test_stored_test_equals_the_test_of_the_rows(spark, rows_per_bucket):
    base, near, far = sample(spark, 1, 900), sample(spark, 2, 500), sample(spark, 3, 400, 0.7)
    ladder = distributions.borders(base, COLUMNS, rows_per_bucket)
    ladder = distributions.read_borders(distributions.borders_table(spark, ladder))
    every = tagged(base, "base").unionByName(tagged(near, "near")).unionByName(tagged(far, "far"))
    stored = distributions.distribution(every, ladder, "name")
    got = {(r["dataset"], r["column"]): r for r in distributions.ks_stored(stored, "base", ["near", "far"], COLUMNS).collect()}
    assert len(got) == 4
    for name, other in (("near", near), ("far", far)):
        for r in drift.ks_two_sample(drift.two_sided(base, other, COLUMNS), COLUMNS).collect():
            mine = got[name, r["column"]]
            assert (mine["n_training"], mine["n_comparison"]) == (r["n_training"], r["n_comparison"])
            assert mine["statistic"] == pytest.approx(r["statistic"], abs=1e-12) and mine["pvalue"] == pytest.approx(r["pvalue"], abs=1e-9)


def test_distributions_merge(spark):
    base, one, two = sample(spark, 1, 300), sample(spark, 4, 200), sample(spark, 5, 150, 0.3)
    ladder = distributions.borders(base, COLUMNS, 50)
    part = lambda df: distributions.distribution(tagged(df, "d"), ladder, "name")
    merged = distributions.merge(part(one), part(two))
    whole = part(one.unionByName(two))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.select(*merged.columns).collect()))


def test_empty_sides_have_no_statistic(spark):
    base = sample(spark, 1, 50)
    ladder = distributions.borders(base, COLUMNS)
    none = base.withColumn("y", F.lit(None).cast("double"))
    stored = distributions.distribution(tagged(base, "base").unionByName(tagged(none, "none")), ladder, "name")
    got = {(r["dataset"], r["column"]): r for r in distributions.ks_stored(stored, "base", ["none", "absent"], COLUMNS).collect()}
    assert got["none", "x"]["statistic"] == 0.0 and got["none", "y"]["statistic"] is None and got["none", "y"]["n_comparison"] == 0
    assert got["absent", "x"]["pvalue"] is None and got["absent", "x"]["n_training"] > 0
    assert all(r["statistic"] is None for r in distributions.ks_stored(stored, "absent", ["base"], COLUMNS).collect())
    with pytest.raises(ValueError):
        distributions.ks_stored(stored, "base", [], COLUMNS)


def test_a_new_batch_reads_no_reference_rows(spark, tmp_path):
    base, new = sample(spark, 1, 300), sample(spark, 2, 200)
    ladder = distributions.borders(base, COLUMNS)
    path = str(tmp_path / "stored")
    distributions.distribution(tagged(base, "base"), ladder, "name").write.partitionBy("dataset", "column").parquet(path)
    distributions.distribution(tagged(new, "new"), ladder, "name").write.mode("append").partitionBy("dataset", "column").parquet(path)
    reports = distributions.drift_reports(spark.read.parquet(path), "base", {"new": "2020-05-01"}, COLUMNS)
    assert {(str(r["date"]), r["dataset"], r["column"]) for r in reports.collect()} == {("2020-05-01", "new", c) for c in COLUMNS}
