"""Feature preparation: imputation, one-hot columns, composition, standardization.

Each step comes as column expressions fitted by one aggregation, and as Spark ML stages.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_number


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numbers as doubles; text that is no number becomes missing."""
    kinds = dict(df.dtypes)
    return df.withColumns({
        c: to_number(F.col(c)) if kinds[c] == "string" else F.col(c).cast("double") for c in columns
    })


def _usable(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))


def fit_means(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = coerce_numbers(train.select(*columns), columns).agg(*[F.avg(_usable(c)).alias(c) for c in columns]).first()
    return row.asDict()


def fill_means(df: DataFrame, means: Mapping[str, float]) -> DataFrame:
    """Missing numbers take the training mean."""
    numbers = coerce_numbers(df, list(means))
    return numbers.withColumns({c: F.coalesce(_usable(c), F.lit(mean)) for c, mean in means.items()})


def fit_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Training values of each column, sorted; all columns in one scan. The labels are part of the model, so the
    distinct values (not the rows) pass through the driver."""
    values = train.select(*columns).unpivot([], list(columns), "column", "value")
    rows = values.filter(F.col("value").isNotNull()).distinct().collect()
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per training value; unseen values and NULL are all zeros.

    Where two such names meet (columns ``a`` and ``a_b``), the later one has a number added.
    """
    ones: dict[str, Column] = {}
    for c, values in categories.items():
        for v in values:
            name, n = f"{c}_{v}", 2
            while name in ones:
                name, n = f"{c}_{v}_{n}", n + 1
            # Spark takes arithmetic with constants into the branches, so what is made of a 0/1 column stays one test.
            ones[name] = F.when(F.col(c) == F.lit(v), 1).otherwise(0)
    return df.withColumns(ones)


def fit_scales(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column keeps the scale one."""
    row = train.agg(*[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)],
                    *[F.stddev_pop(c).alias(f"std_{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"mean_{i}"], row[f"std_{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, scales: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in scales.items()})


def _hot_stages(train: DataFrame, categorical: Sequence[str]) -> tuple[list, list[str]]:
    """Indexers and one-hot vectors, and the vectors' names.

    Spark ML knows no empty label, so a blank category is written under a label that no value has. With unseen
    values kept as the last index and that index dropped, each training value has one column, and unseen
    values and NULL have none. All vectors are sparse.
    """
    if not categorical:
        return [], []
    categories, texts, indexers = fit_categories(train, categorical), [], []
    for c in categorical:
        blank = "(blank)"
        while blank in categories[c]:
            blank = f"({blank})"
        texts.append(f"CASE WHEN `{c}` = '' THEN '{blank}' ELSE `{c}` END AS `{c}_text`")
        indexers.append(StringIndexerModel.from_labels(
            [v or blank for v in categories[c]], inputCol=f"{c}_text", outputCol=f"{c}_index", handleInvalid="keep"))
    hot = [f"{c}_hot" for c in categorical]
    named = SQLTransformer(statement=f"SELECT *, {', '.join(texts)} FROM __THIS__")
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=hot, dropLast=True)
    return [named, *indexers, encoder], hot


def _imputer(numeric: Sequence[str]) -> Imputer:
    return Imputer(strategy="mean", inputCols=list(numeric), outputCols=[f"{c}_filled" for c in numeric])


def encoding_stages(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Imputer, indexers, one-hot vectors and their composition into ``assembled``."""
    encoding, hot = _hot_stages(train, categorical)
    return [_imputer(numeric), *encoding,
            VectorAssembler(inputCols=[*[f"{c}_filled" for c in numeric], *hot], outputCol="assembled")]


def fit_features(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """All feature stages, scaled into ``features``.

    Numbers are centred and scaled; one-hot columns are scaled only, since a shift of every column would fill
    the sparse vectors, and moves no split of a tree and only the intercept of a linear model.
    """
    rows = train.select(*numeric, *categorical)
    encoding, hot = _hot_stages(rows, categorical)
    stages, parts = [*([_imputer(numeric)] if numeric else []), *encoding], []
    for columns, name, centred in (([f"{c}_filled" for c in numeric], "numbers", True), (hot, "categories", False)):
        if columns:
            stages += [VectorAssembler(inputCols=columns, outputCol=name),
                       StandardScaler(inputCol=name, outputCol=f"{name}_scaled", withMean=centred, withStd=True)]
            parts.append(f"{name}_scaled")
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")]).fit(rows)
