"""Small scalar expressions used across the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_rounded(value: Column, digits: int = 0) -> Column:
    return F.round(F.avg(value), digits)


def to_float(value: Column) -> Column:
    """32-bit float in the text, NULL where there is none."""
    return value.try_cast("float")


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970-01-01 in the session time zone."""
    return F.unix_timestamp(moment.cast("timestamp"))


def merge_maps(metrics: Column, params: Column) -> Column:
    """Both maps as one text map.

    Metric values become text first: left alone, the mix of number and text would be read as
    numbers and fail on the first text parameter. A key in both maps takes the parameter.
    """
    as_text = F.transform_values(F.coalesce(metrics, F.map_from_arrays(F.array(), F.array()).cast("map<string,double>")),
                                 lambda _, v: v.cast("string"))
    texts = F.coalesce(params, F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))
    only_metrics = F.map_filter(as_text, lambda k, _: ~F.map_contains_key(texts, k))
    return F.map_concat(only_metrics, texts)


def fixed_date(text: str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.lit(text), pattern)


def on_date(column: Column, day: str, *, timestamp: bool = False) -> Column:
    """Rows of one day. The literal is typed, so the test reaches the file scan.

    For a timestamp column the day is written as a half-open range instead of a cast of the column.
    """
    if not timestamp:
        return column == F.lit(day).cast("date")
    start = dt.date.fromisoformat(day)
    end = start + dt.timedelta(days=1)
    return (column >= F.lit(start.isoformat()).cast("timestamp_ntz")) & (
        column < F.lit(end.isoformat()).cast("timestamp_ntz")
    )


def threshold_flag(pvalue: Column, alpha: float) -> Column:
    """0 when the p-value is strictly below ``alpha``, else 1; NULL stays NULL."""
    return F.when(pvalue.isNotNull(), F.when(pvalue < F.lit(alpha), 0).otherwise(1))


def case_label(value: Column, labels: Mapping[str, str], otherwise: str) -> Column:
    """Label per value, one default for the rest."""
    result = F
    for match, label in labels.items():
        result = result.when(value == F.lit(match), F.lit(label))
    return result.otherwise(F.lit(otherwise)) if labels else F.lit(otherwise)
