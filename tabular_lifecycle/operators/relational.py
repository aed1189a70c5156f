"""Projection, filters, generators, aggregation, sort and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_seconds, mean_rounded


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def select_supported(df: DataFrame, supported: Sequence[str]) -> DataFrame:
    """Keep the model inputs in their order; scoring data may carry more columns, not fewer."""
    missing = [c for c in supported if c not in df.columns]
    if missing:
        raise ValueError(f"input columns are missing: {missing}")
    return df.select(*supported)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def head(df: DataFrame, n: int, order: Sequence[str | Column] = ()) -> DataFrame:
    """The first rows; with an order this is a top-k, not a full sort."""
    return (df.orderBy(*order) if order else df).limit(n)


def exclude_value(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) != F.lit(value))


def any_of(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def tag(df: DataFrame, **literals) -> DataFrame:
    """Add columns that hold one literal each."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def strip_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Rename columns by deleting each token wherever it occurs in the name."""
    def clean(name: str) -> str:
        return reduce(lambda text, token: text.replace(token, ""), tokens, name)

    return df.withColumnsRenamed({c: clean(c) for c in df.columns if clean(c) != c})


def add_duration(df: DataFrame, start: str, end: str, name: str = "trainingDuration") -> DataFrame:
    """Whole seconds between two moments, as an integer."""
    seconds = epoch_seconds(F.col(end)) - epoch_seconds(F.col(start))
    return df.withColumn(name, seconds.cast("int"))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows without any NULL."""
    return df.dropna("any", subset=list(columns) if columns else None)


def complete(df: DataFrame) -> Column:
    """Whether ``drop_incomplete`` keeps the row: no column is NULL or NaN."""
    return reduce(lambda x, y: x & y, [
        F.col(c).isNotNull() & ~F.isnan(c) if kind in ("double", "float") else F.col(c).isNotNull() for c, kind in df.dtypes])


def separate_label(df: DataFrame, label: str, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Features without the label, and the label alone; ``keys`` stay on both sides."""
    return df.drop(label), df.select(*keys, label)


def mean_by(df: DataFrame, key: str, value: str, alias: str, digits: int = 0) -> DataFrame:
    """Rounded mean per key, largest first."""
    return df.groupBy(key).agg(mean_rounded(F.col(value), digits).alias(alias)).orderBy(F.desc(alias), key)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def means_of_numbers(df: DataFrame, key: str, digits: int | None = None) -> DataFrame:
    """Mean of every numeric column per key; other columns are left out."""
    means = {c: F.avg(c) for c in numeric_columns(df) if c != key}
    return df.groupBy(key).agg(*[
        (m if digits is None else F.round(m, digits)).alias(c) for c, m in means.items()
    ])


def means_tagged(df: DataFrame, columns: Sequence[str], tag_name: str, tag_value: str) -> DataFrame:
    """One row of means under a constant tag, and no row at all for an empty input."""
    return df.groupBy(F.lit(tag_value).alias(tag_name)).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in columns]
    ).select(*[f"avg_{c}" for c in columns], tag_name)


def count_where(df: DataFrame, condition: Column, alias: str) -> DataFrame:
    """Sum of a 0/1 case; NULL for an empty input, as SUM gives."""
    return df.agg(F.sum(F.when(condition, 1).otherwise(0)).alias(alias))


def pivot_sum(
    df: DataFrame, keys: Sequence[str], pivot: str, value: str, values: Sequence[str] | None = None
) -> DataFrame:
    """One column per pivot value. Known ``values`` save the job that looks for them."""
    grouped = df.groupBy(*keys)
    return (grouped.pivot(pivot, list(values)) if values else grouped.pivot(pivot)).sum(value)


def chart(df: DataFrame, group: str, aggregates: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Chart aggregation: alias -> (``sum`` or ``avg``, column), per group value."""
    functions = {"sum": F.sum, "avg": F.avg}
    return df.groupBy(group).agg(*[
        functions[name](F.col(f"`{column}`")).alias(alias) for alias, (name, column) in aggregates.items()
    ])


def sort_descending(df: DataFrame, column: str, *then: str) -> DataFrame:
    return df.orderBy(F.desc(column), *then)


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by position; equal rows collapse."""
    return reduce(DataFrame.union, others, first).distinct()


def union_history(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; every row stays."""
    return reduce(DataFrame.unionByName, others, first)
