"""Splits and samples with exact counts, repeatable and without one task per class.

Rows are ordered by a hash of seed and key. Instead of numbering them, the hash value at the wanted
count is found per class by counting hash prefixes; each row is then compared with it. Counting
shuffles a few thousand numbers per class, and the rows themselves do not move.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hash_order
from ..runtime import settle
from .ordered import before

_HEX_DIGITS = 32
_FIRST_DIGITS = 3
# Equal rows are written out in runs of this many.
_RUN = 100_000

Quota = Callable[[Column, Column], Column]


def _cut_level(df: DataFrame, digits: int, upper: DataFrame | None = None, upper_digits: int = 0) -> DataFrame:
    """Rows per class and hash prefix, inside the prefixes chosen one level above."""
    prefix = F.substring("hash", 1, digits)
    if upper is not None:
        parent = upper.select(F.col("class").alias("parent_class"), F.col("prefix").alias("parent"),
                              "quota", "below")
        df = df.join(parent, df["class"].eqNullSafe(F.col("parent_class"))
                     & (F.substring("hash", 1, upper_digits) == F.col("parent")))
    else:
        df = df.withColumns({"quota": F.lit(None).cast("bigint"), "below": F.lit(0).cast("bigint")})
    return df.groupBy("class", prefix.alias("prefix")).agg(
        F.count("*").alias("held"), F.max("quota").alias("quota"), F.max("below").alias("below")
    )


def _reach(counts: DataFrame) -> DataFrame:
    """Per class, the prefix at which the running count reaches the quota."""
    running = F.col("below") + F.sum("held").over(before(["class"], "prefix", inclusive=True))
    steps = counts.withColumn("running", running)
    return settle(
        steps.filter((F.col("running") >= F.col("quota")) & (F.col("running") - F.col("held") < F.col("quota")))
        .select("class", "prefix", "quota", (F.col("running") - F.col("held")).alias("below"), "held"),
        "cuts",
    )


def _find_cuts(df: DataFrame, quota: Quota) -> DataFrame:
    """(``class``, ``cut``, ``surplus``): rows with hash <= cut are taken; of those equal to the cut,
    ``surplus`` are too many. A quota of zero gives an empty cut, which no hash reaches."""
    counts = settle(_cut_level(df, _FIRST_DIGITS), "hash-counts")
    totals = settle(counts.groupBy("class").agg(F.sum("held").alias("total")), "classes")
    least = totals.agg(F.min("total")).first()[0] or 0
    quotas = totals.select(F.col("class").alias("of"),
                           quota(F.col("total"), F.lit(least)).cast("bigint").alias("wanted"))
    counts = counts.join(quotas, counts["class"].eqNullSafe(quotas["of"])).withColumn(
        "quota", F.least(F.col("wanted"), F.sum("held").over(Window.partitionBy("class")))
    ).drop("of", "wanted")
    level = _reach(_cut_level(df, 2 * _FIRST_DIGITS, _reach(counts), _FIRST_DIGITS))
    exact = _reach(_cut_level(df, _HEX_DIGITS, level, 2 * _FIRST_DIGITS))
    cuts = exact.select(
        "class", F.col("prefix").alias("cut"),
        (F.col("below") + F.col("held") - F.col("quota")).alias("surplus"),
    )
    return settle(cuts, "cuts")


def _repeat(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times; long runs are spread over the tasks before they are written out."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / _RUN))
    runs = df.filter(F.col(copies) > 0).withColumn("__run", F.explode(starts))
    length = F.least(F.lit(_RUN).cast("bigint"), F.col(copies) - F.col("__run") * _RUN)
    runs = runs.withColumn("__length", length).repartition("__run")
    return runs.withColumn("__one", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__length")))).drop(
        copies, "__run", "__length", "__one"
    )


def _take(df: DataFrame, group: Column, keys: Sequence[str], seed: int, quota: Quota) -> DataFrame:
    """``df`` with a boolean ``__taken``, true for exactly the quota of rows in each class."""
    columns = df.columns
    hashed = df.withColumns({"__class": group, "__hash": hash_order(keys, seed)})
    cuts = _find_cuts(hashed.select(F.col("__class").alias("class"), F.col("__hash").alias("hash")), quota)
    chosen = cuts.select(*[F.col(c).alias(f"__cut_{c}") for c in ("class", "cut", "surplus")])
    matched = hashed.join(chosen, F.col("__class").eqNullSafe(F.col("__cut_class")), "left")
    taken = F.coalesce(F.col("__hash") <= F.col("__cut_cut"), F.lit(False)).alias("__taken")
    if not cuts.filter(F.col("surplus") > 0).count():
        return matched.select(*columns, taken)

    # Copies of one key lie across a cut. Only they are counted, equal rows together, and shared out.
    surplus = F.col("__cut_surplus")
    at_cut = F.coalesce((F.col("__hash") == F.col("__cut_cut")) & (surplus > 0), F.lit(False))
    clear = matched.filter(~at_cut).select(*columns, taken)
    copies = matched.filter(at_cut).groupBy("__class", "__cut_surplus", *columns).agg(
        F.count("*").alias("__copies")
    )
    order = Window.partitionBy("__class").orderBy(*[F.col(c).desc() for c in columns])
    earlier = F.sum("__copies").over(order) - F.col("__copies")
    left_out = F.least(F.greatest(surplus - earlier, F.lit(0)), F.col("__copies"))
    shared = copies.withColumn("__out", left_out).withColumn("__in", F.col("__copies") - F.col("__out"))
    kept = _repeat(shared.select(*columns, "__in"), "__in").withColumn("__taken", F.lit(True))
    dropped = _repeat(shared.select(*columns, "__out"), "__out").withColumn("__taken", F.lit(False))
    return clear.unionByName(kept).unionByName(dropped)


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int,
    train_tenths: int = 8,
    column: str = "split",
) -> DataFrame:
    """Tag rows ``train`` or ``validation``; floor(n * train_tenths / 10) rows of each label train."""
    share = _take(df, F.col(label), keys, seed,
                  lambda total, _: F.floor(total * F.lit(train_tenths) / F.lit(10)))
    return share.select(*df.columns, F.when(F.col("__taken"), "train").otherwise("validation").alias(column))


def undersample(df: DataFrame, label: str, keys: Sequence[str], seed: int) -> DataFrame:
    """Cut every class to the size of the smallest one, without replacement. A NULL label is no class; its rows go."""
    df = df.filter(F.col(label).isNotNull())
    return _take(df, F.col(label), keys, seed, lambda _, least: least).filter("__taken").select(*df.columns)


def fixed_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int) -> DataFrame:
    """Exactly ``n`` rows, or all of them when there are fewer."""
    return _take(df, F.lit("all"), keys, seed, lambda total, _: F.lit(n)).filter("__taken").select(*df.columns)
