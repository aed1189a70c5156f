"""Mixing sources to target weights: whole passes, and a knapsack over token lengths for what is left."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import stage
from .common import SPACE_CLASS


def source_targets(sizes: DataFrame, weights: list[int], max_passes: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, have the weights in turn and share the total of all sizes. A target stops at
    ``max_passes`` times its source's size; the excess is shared again by weight. The level at which that ends is
    found in one pass over the sources in the order in which they reach their stop. One row a source.
    """
    table = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.select("*", F.expr("row_number() OVER (ORDER BY source ASC NULLS LAST) - 1").alias("_n"))
    weighed = ranked.withColumn("_w", F.get(table, F.pmod(F.col("_n"), F.lit(len(weights))).cast("int")).cast("double"))
    capped = weighed.withColumn("_cap", F.col("source_size") * max_passes).withColumn("_at", F.col("_cap") / F.col("_w"))
    run = capped.selectExpr(
        "*", "sum(source_size) OVER () AS _all", "sum(_w) OVER () AS _ws",
        "coalesce(sum(_cap) OVER (ORDER BY _at, _n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _full",
        "coalesce(sum(_w) OVER (ORDER BY _at, _n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _gone")
    level = run.withColumn("_level", (F.col("_all") - F.col("_full")) / (F.col("_ws") - F.col("_gone")))
    # The level if all sources before this one have stopped. The first that does not stop below it has the level that
    # holds; after it the levels fall, so it is the largest.
    first = level.selectExpr("*", "max(CASE WHEN _level <= _at THEN _level END) OVER () AS _end")
    target = F.when(F.col("_end").isNull(), F.col("_cap")).otherwise(F.least(F.col("_w") * F.col("_end"), F.col("_cap")))
    return first.select("source", "source_size", target.cast("double").alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 1 << 16) -> np.ndarray:
    """How many documents of each length to take, so that the lengths sum to ``budget`` as nearly as may be.

    Every length first gives its share of the budget, rounded down. Then long lengths fill up while more than
    ``window`` (or twice the longest length) is left. The rest is a bounded knapsack: counts are split into powers of
    two, sums within the window are marked as reachable item by item, and the nearest reachable sum is traced back.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    take = np.minimum(counts, (counts.astype(object) * budget // total).astype(np.int64))
    rest = budget - int((take * lengths).sum())
    window = max(window, 2 * int(lengths.max()))
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= window:
            break
        if lengths[i] > 0:
            more = min(int(counts[i] - take[i]), max(0, -(-(rest - window) // int(lengths[i]))), rest // int(lengths[i]))
            take[i] += more
            rest -= more * int(lengths[i])
    span = min(rest + int(lengths.max()), 2 * window + int(lengths.max()))
    by = np.full(span + 1, -1, np.int32)
    by[0] = 0
    items: list[tuple[int, int]] = [(-1, 0)]
    for i in np.argsort(-lengths, kind="stable"):
        left, part = int(counts[i] - take[i]), 1
        while left > 0 and lengths[i] > 0 and part * int(lengths[i]) <= span:
            part = min(part, left)
            step = part * int(lengths[i])
            if step > span:
                break
            reached = np.flatnonzero((by[:span + 1 - step] >= 0) & (by[step:] < 0)) + step
            by[reached] = len(items)
            items.append((int(i), part))
            left, part = left - part, part * 2
        if (by >= 0).all():
            break
    sums = np.flatnonzero(by >= 0)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at > 0:
        i, part = items[by[at]]
        take[i] += part
        at -= part * int(lengths[i])
    return take


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = 3, seed: str = "mix",
        text: str = "text", doc_id: str = "doc_id", source: str = "source", buckets: int = 4096,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep`` columns, source, size, source_size, target, passes): how often the mix takes every document.

    1. Documents are counted by source and exact size (words); sources get their targets.
    2. A source's whole passes are floor(target / size); what is left of its target is fitted by ``fit_counts`` on its
       table of lengths, which is as long as there are distinct lengths, however many documents there are.
    3. Of each source and length the wanted number of documents of smallest seeded hash get one pass more. The hash
       is cut into ``buckets`` whose counts are summed, so a length that a third of the rows have is many short
       groups, and only ranks inside a bucket are taken.

    Null text has size 0; size 0 is taken by whole passes only. A null source is a source. Repeated rows are told
    apart by their rank alone, so counts hold for them too. Reruns agree: order is by hash of seed, id and text.
    Empty table: empty result. Only named columns are returned; ``keep`` names of the result's own are refused.
    """
    if {c.lower() for c in keep} & {doc_id.lower(), "source", "size", "source_size", "target", "passes"}:
        raise ValueError("a kept column has the name of a result column")
    value = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(doc_id).alias("_id"), F.col(source).alias("source"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
        F.regexp_count(value, F.lit(f"[^{SPACE_CLASS}]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), value).alias("_h"))
    sized = stage(sized, "sized")
    b = F.shiftrightunsigned("_h", 52).cast("int") % buckets
    counts = sized.groupBy("source", "size", b.alias("_b")).agg(F.count("*").alias("n"))
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), list(weights), max_passes)

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        all_, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        passes = min(max_passes, int(target // all_)) if all_ else 0
        rest = round(target) - passes * all_ if passes < max_passes else 0
        group["passes"] = passes
        group["more"] = fit_counts(group["size"].to_numpy(), group["n"].to_numpy(), rest)
        return group[["source", "source_size", "target", "size", "passes", "more"]]

    a, t = lengths.alias("a"), targets.alias("t")
    plan = (a.join(t, F.col("a.source").eqNullSafe(F.col("t.source")))
            .select("a.source", "a.size", "a.n", "t.source_size", "t.target")
            .groupBy("source").applyInPandas(fitted, "source string, source_size long, target double, size long, passes int, more long"))
    plan = plan.withColumnsRenamed({"source": "_s", "size": "_z"})
    before = counts.selectExpr("source AS _cs", "size AS _cz", "_b AS _cb", "n AS _cn",
                               "sum(n) OVER (PARTITION BY source, size ORDER BY _b) - n AS _before")
    # (source, length, bucket): all of it, none of it, or its first _quota documents.
    # Tables of lengths and buckets grow with the corpus and are not broadcast.
    quota = before.join(plan.hint("merge"), F.expr("_cs <=> _s AND _cz = _z")).select(
        "_cs", "_cz", "_cb", "_cn", "source_size", "target", "passes", F.greatest(F.lit(0), F.col("more") - F.col("_before")).alias("_quota"))
    ranked = sized.withColumn("_b", b)
    placed = ranked.join(quota.hint("merge"), F.expr("source <=> _cs AND size = _cz AND _b = _cb"))
    split = F.expr("_quota > 0 AND _quota < _cn")
    whole = placed.where(~split).withColumn("_more", (F.col("_quota") > 0).cast("int"))
    part = placed.where(split).withColumn(
        "_more", (F.expr("row_number() OVER (PARTITION BY source, size, _b ORDER BY _h, _id)") <= F.col("_quota")).cast("int"))
    return whole.unionByName(part).select(F.col("_id").alias(doc_id), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "source", "size", "source_size", "target",
                                          (F.col("passes") + F.col("_more")).alias("passes"))
