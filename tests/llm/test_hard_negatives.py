import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.llm import hard_negatives

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def rows():
    """Ties, repeated ids and rows, nulls in every column, two lengths, labels of one row, huge components."""
    vectors = [(i, [math.sin(i * j + j) for j in range(1, 9)], i % 3) for i in range(120)]
    vectors += [(200 + i, [math.sin(40 * j + j) for j in range(1, 9)], i % 3) for i in range(12)]
    vectors += [(100, [0.5] * 8, 1), (100, [0.5] * 8, 1), (100, [0.25] * 8, 2), (300, [1.0, 2.0], 0), (301, [1.0, 1.5], 0), (302, [2.0, 0.5], 1)]
    vectors += [(400, None, 1), (401, [0.1] * 8, None), (402, [0.1] * 7 + [None], 1), (403, [float("nan")] + [0.1] * 7, 1),
                (404, [float("inf")] + [0.1] * 7, 1), (None, [0.5] * 8, 1), (None, [0.5] * 8, 2), (405, [], 1), (500, [0.1] * 8, 99)]
    return vectors


def brute(table, positives=5, negatives=5):
    usable = [(n, i, [math.floor(256 * x) if abs(x) < 2**40 else 256 * int(x) for x in v], label) for n, (i, v, label) in enumerate(table)
              if label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for n, a, v, label in usable:
        if a is None or a % 100:
            continue
        scored = [(-min(max(sum(x * y for x, y in zip(v, w)), -2**63), 2**63 - 1), i is None, i or 0, m, l) for m, i, w, l in usable if m != n and len(w) == len(v)]
        scored.sort(key=lambda s: s[:4])
        for s, none, i, _, _ in [s for s in scored if s[4] == label][:positives]:
            fit = [x for x in scored if x[4] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            for rank, x in enumerate(fit, 1):
                out[a, None if none else i, rank, None if x[1] else x[2], -s, -x[0]] += 1
    return out


def run(spark, table, **sizes):
    # Names the operator uses itself stand beside the named columns.
    df = spark.createDataFrame([(*r, 7, "x") for r in table], "vec_id long, embedding array<double>, label int, row int, anchor string")
    out = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **sizes)
    assert out.columns == NAMES
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("sizes", [{}, {"block_anchors": 2, "block_vectors": 7}])
def test_equals_brute_force_whatever_the_blocks(spark, sizes):
    got = run(spark, rows(), **sizes)
    assert got == brute(rows()) and sum(got.values()) > 40


def test_products_beyond_doubles_are_exact(spark):
    table = [(i, [10.0**6 * (i + 1), 3.0**15 + i, 1e30 if i == 17 else 1.0], i % 2) for i in range(0, 20)] + [(100, [10.0**7, 3.0**15, 2.0], 0)]
    assert run(spark, table, block_vectors=6) == brute(table)


def test_empty_and_without_anchors(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == Counter()


def test_keys_sort_by_anchor_then_falling_score():
    import numpy as np
    import pyarrow as pa

    scores = np.array([5, -3, 5, 2**62, -2**63, 2**63 - 1])
    keys = hard_negatives.pack_keys(np.full(6, 7), np.zeros(6), scores, [1, 0, 0, 1, 1, 1], np.arange(6), [0] * 6, np.arange(6))
    ordered = pa.RecordBatch.from_arrays([pa.array(sorted(keys.to_pylist()), pa.binary())], names=["key"])
    assert [(k[2], k[3]) for k in hard_negatives.unpack_keys(ordered)] == [(2**63 - 1, 1), (2**62, 1), (5, 0), (5, 1), (-3, 0), (-2**63, 1)]


def test_a_window_takes_equal_scores_and_closes_below_its_share(spark):
    table = [(100, [1.0], 0), (1, [1.0], 0), (2, [1.0], 1), (3, [0.8], 1), (4, [0.796875], 1), (5, [1.00390625], 1)]
    got = run(spark, table)
    assert sorted((r[1], r[3]) for r in got) == [(1, 2)]
    assert got == brute(table)
