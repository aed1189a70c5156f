import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from pyspark.sql import functions as F

from tabular_lifecycle.llm import mixing, sharding, topk_search
from tabular_lifecycle.runtime import stage


@pytest.mark.parametrize("first", [0.02, 0.5])
def test_search_block_is_exact(first):
    random = np.random.default_rng(7)
    vectors = np.floor(256 * random.normal(size=(700, 12)))
    vectors[100:140] = vectors[3]
    queries, own = vectors[::50], np.arange(0, 700, 50)
    q, v, s, depths = topk_search.search_block(queries, vectors, own, 5, first)
    assert len(depths) == len(queries) and (depths > 0).all() and depths.max() <= 700
    every = queries @ vectors.T
    for i in range(len(queries)):
        mine = every[i].copy()
        mine[own[i]] = -np.inf
        best = set(np.flatnonzero(mine >= np.sort(mine)[-5]))
        assert best <= set(v[q == i]) and own[i] not in v[q == i]
        assert (s[q == i] == every[i, v[q == i]]).all()


def test_bounds_stop_early_where_few_stand_out():
    random = np.random.default_rng(9)
    vectors = np.floor(256 * random.normal(size=(2000, 6)) * 0.05)
    vectors[:8] += 4000
    queries = np.full((3, 6), 300.0)
    q, v, _, depths = topk_search.search_block(queries, vectors, np.array([0, -1, -1]), 5)
    assert depths.max() < 200 and set(v.tolist()) <= set(range(8)) and 0 not in v[q == 0]


def _brute_top(rows, k):
    usable = [(n, i, [int(np.floor(256 * c)) if abs(c) < 2**40 else 256 * int(c) for c in x]) for n, (i, x, _) in enumerate(rows)
              if x and all(c is not None and np.isfinite(c) for c in x)]
    out = []
    for n, q, v in usable:
        if q is None or q % 50:
            continue
        clip = lambda s: min(max(s, -2**63), 2**63 - 1)
        scored = sorted((-clip(sum(a * b for a, b in zip(v, x))), i is None, i or 0, m) for m, i, x in usable if m != n and len(x) == len(v))
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(scored[:k])]
    return Counter(out)


def _found(spark, rows, k=5, **sizes):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int")
    out = topk_search.top_k(frame, F.col("vec_id") % 50 == 0, k, **sizes)
    return Counter(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())


def test_top_k(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=8).tolist(), 0) for i in range(260)]
    rows += [(i, rows[100][1], 0) for i in range(300, 340)] + [rows[50], rows[50], rows[7], (None, rows[0][1], 0), (401, None, 0), (402, [], 0)]
    rows += [(450, [float("nan")] * 8, 0), (451, [None] * 8, 0), (452, [float("inf")] * 8, 0), (453, [1.0] * 3, 0), (500, [1.0] * 8, 0), (500, [2.0] * 8, 0)]
    rows += [(550, [1.0] * 3, 0), (551, [2.0] * 3, 0)]
    for sizes in ({}, {"block_vectors": 50, "block_queries": 3}):
        assert _found(spark, rows, **sizes) == _brute_top(rows, 5)
    assert _found(spark, rows[:3]) == _brute_top(rows[:3], 5)
    assert _found(spark, []) == Counter()
    huge = [(i, [1e30 if i == 3 else 1.0, 3.0**20 + i, -5.0 * i], 0) for i in range(0, 60)]
    assert _found(spark, huge) == _brute_top(huge, 5)


def test_shards(spark, docs, rows, no_docs):
    for shards in (1, 3, 40):
        out = sharding.shard(docs, shards).collect()
        assert len(out) == len(rows)
        assert Counter((r.doc_id, r["size"]) for r in out) == Counter((d, len((t or "").encode()) + 16) for d, t, *_ in rows)
        slots = defaultdict(list)
        for r in out:
            assert 0 <= r.shard < shards
            slots[r.shard].append(r.slot)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.shard(no_docs, 40).count() == 0


def test_shards_are_even_where_a_value_is_common(spark):
    frame = spark.range(6000).selectExpr("id AS doc_id", "repeat('x', int(id % 90)) AS text", "'one' AS source",
                                         "if(id % 3 = 0, 'hot', string(id)) AS lang", "id % 7 AS n_chars")
    out = sharding.shard(frame, 40)
    sizes = [r.s for r in out.groupBy("shard").sum("size").withColumnRenamed("sum(size)", "s").collect()]
    assert len(sizes) == 40 and max(sizes) < 1.1 * min(sizes)
    again = sharding.shard(frame, 40)
    assert out.exceptAll(again).count() == 0


def test_fit_counts():
    random = np.random.default_rng(1)
    for _ in range(60):
        lengths = np.unique(random.integers(1, 60, random.integers(1, 12)))
        counts = random.integers(0, 6, len(lengths))
        total = int((lengths * counts).sum())
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist()):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        for budget in random.integers(0, total + 1, 4).tolist():
            for window in (1 << 16, 1):
                take = mixing.fit_counts(lengths, counts, budget, window)
                assert (take >= 0).all() and (take <= counts).all()
                got = int((take * lengths).sum())
                assert abs(got - budget) <= int(lengths.max())
            whole = mixing.fit_counts(lengths, counts, total)
            assert (whole == counts).all()


def test_mix(spark, docs, rows, no_docs):
    sizes = Counter()
    for _, t, _, source, _ in rows:
        sizes[source] += len(brute.WORD.findall(t or ""))
    want, got = brute.targets(sizes), Counter()
    out = mixing.mix(docs, keep=("text", "n_chars")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["size"] == len(brute.WORD.findall(r.text or "")) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9) and 0 <= r.passes <= 3
        got[r.source] += r["size"] * r.passes
    for source, target in want.items():
        longest = max(len(brute.WORD.findall(t or "")) for _, t, _, s, _ in rows if s == source)
        assert abs(got[source] - target) <= longest
    again = mixing.mix(docs, keep=("text", "n_chars")).collect()
    assert Counter((r.doc_id, r.text, r.passes) for r in out) == Counter((r.doc_id, r.text, r.passes) for r in again)
    assert mixing.mix(no_docs).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, keep=("size",))


def test_shard_checksums_and_sources(spark, docs, rows):
    out = sharding.shard(docs, 3).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in out) == Counter((d, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    many = spark.range(4000).selectExpr(
        "id AS doc_id", "repeat('x', 50 + int(id % 7)) AS text", "concat('source_00', id % 4) AS source", "'en' AS lang", "int(id % 90) AS n_chars")
    placed = sharding.shard(many, 4).select("doc_id", "shard").collect()
    held = defaultdict(set)
    for r in placed:
        held[r.shard].add(r.doc_id % 4)
    assert sorted(map(len, held.values())) == [2, 2, 2, 2]


def _plain_shard(keys, size, leaves, first=0):
    """{row: shard} of rows with integer keys, by sorting each node along its widest axis."""
    rows = list(keys)
    if leaves == 1 or not rows:
        return {r: first for r in rows}
    spans = [max(keys[r][i] for r in rows) - min(keys[r][i] for r in rows) for i in range(len(keys[rows[0]]))]
    axis = max(range(len(spans)), key=lambda i: (spans[i], -i))
    want, before, cut = sum(size[r] for r in rows) * (leaves // 2) / leaves, 0, None
    weights = Counter()
    for r in rows:
        weights[keys[r][axis]] += size[r]
    for key, s in sorted(weights.items()):
        if before + s > want or key == max(weights):
            cut = key + 1 if want - before > before + s - want else key
            break
        before += s
    left = {r: keys[r] for r in rows if keys[r][axis] < cut}
    right = {r: keys[r] for r in rows if keys[r][axis] >= cut}
    return _plain_shard(left, size, leaves // 2, first) | _plain_shard(right, size, leaves - leaves // 2, first + leaves // 2)


def test_tree_equals_plain_cuts(spark):
    frame = spark.range(700).selectExpr(
        "id", "10 + (id * id) % 91 AS size", "concat('host-', (id * 7) % 13) AS a", "IF(id % 9 = 0, null, double(id % 50)) AS b")
    numbered = stage(sharding.number_texts(frame, ["a"]), "numbered")
    names = sorted({f"host-{i * 7 % 13}" for i in range(700)})
    assert {(r.id, r.a) for r in numbered.collect()} == {(i, names.index(f"host-{i * 7 % 13}")) for i in range(700)}
    for shards in (5,):
        tree = sharding.fit_tree(numbered, "size", shards, ["a", "b"], ["id"], tolerance=0.0)
        out = numbered.select("id", "size", tree.keys().alias("k")).select("id", "size", "k", tree.shard(F.col("k")).alias("shard")).collect()
        assert {r.id: r.shard for r in out} == _plain_shard({r.id: list(r.k) for r in out}, {r.id: r["size"] for r in out}, shards)
