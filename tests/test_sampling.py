from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.operators import sampling
from tabular_lifecycle.operators.sampling import fixed_sample, stratified_split, undersample


def labelled(spark, counts):
    rows = [(f"{label}-{i}", label, i) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "key string, label string, x int").repartition(5)


def contents(df):
    return Counter(map(tuple, df.collect()))


def by_rank(df, label, seed):
    """The same order by brute force."""
    rows = df.withColumn("h", sampling.hash_order(["key"], seed)).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[label], []).append((r["h"], r["key"]))
    return {k: [key for _, key in sorted(v)] for k, v in groups.items()}


def test_split_counts_and_rows(spark):
    df = labelled(spark, {"a": 1003, "b": 57, None: 20, "single": 1})
    split = stratified_split(df, "label", ["key"], 7)
    assert contents(split.select(df.columns)) == contents(df)
    ranks = by_rank(df, "label", 7)
    train = {r["key"] for r in split.filter("split = 'train'").collect()}
    assert train == {k for keys in ranks.values() for k in keys[:len(keys) * 8 // 10]}
    assert contents(split) == contents(stratified_split(df.repartition(3), "label", ["key"], 7))


def test_undersample(spark):
    df = labelled(spark, {"a": 500, "b": 120, "c": 130})
    cut = undersample(df, "label", ["key"], 42)
    assert Counter(r["label"] for r in cut.collect()) == {"a": 120, "b": 120, "c": 120}
    ranks = by_rank(df, "label", 42)
    assert {r["key"] for r in cut.collect()} == {k for keys in ranks.values() for k in keys[:120]}
    assert contents(undersample(labelled(spark, {"a": 9}), "label", ["key"], 1)) == contents(labelled(spark, {"a": 9}))
    equal = labelled(spark, {"a": 5, "b": 5})
    assert contents(undersample(equal, "label", ["key"], 1)) == contents(equal)
    assert undersample(df.limit(0), "label", ["key"], 1).count() == 0


def test_copies_across_the_cut(spark, monkeypatch):
    """A third of all rows are copies of one row, and few enough others that the cut falls inside it."""
    monkeypatch.setattr(sampling, "_RUN", 64)
    one = [("same", "a", 1)] * 3000 + [("same", "a", 2)] * 40 + [(f"k{i}", "a", i) for i in range(500)]
    df = spark.createDataFrame(one, "key string, label string, x int").repartition(8)
    split = stratified_split(df, "label", ["key"], 3)
    assert contents(split.select(df.columns)) == contents(df)
    assert split.filter("split = 'train'").count() == 3540 * 8 // 10
    assert contents(split) == contents(stratified_split(df.repartition(3), "label", ["key"], 3))


def test_many_rows_in_one_hash_prefix(spark):
    df = labelled(spark, {"a": 4000, "b": 900})
    split = stratified_split(df, "label", ["key"], 11)
    assert contents(split) == contents(stratified_split(df.repartition(5), "label", ["key"], 11))
    assert split.filter("split = 'train'").count() == 3200 + 720


def test_fixed_sample(spark):
    df = labelled(spark, {"a": 300})
    expected = set(by_rank(df, "label", 5)["a"][:50])
    assert {r["key"] for r in fixed_sample(df, 50, ["key"], 5).collect()} == expected
    assert fixed_sample(df, 1000, ["key"], 5).count() == 300
    twice = df.unionByName(df).withColumn("x", F.lit(1))
    assert fixed_sample(twice, 51, ["key"], 5).count() == 51


def test_seeds_differ(spark):
    df = labelled(spark, {"a": 200})
    first, second = (contents(fixed_sample(df, 20, ["key"], seed)) for seed in (1, 2))
    assert first != second
