"""CSV scan under a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The census record, in file order.
CENSUS_SCHEMA = T.StructType([
    T.StructField("age", T.IntegerType(), True),
    T.StructField("workclass", T.StringType(), True),
    T.StructField("fnlwgt", T.DoubleType(), True),
    T.StructField("education", T.StringType(), True),
    T.StructField("education_num", T.DoubleType(), True),
    T.StructField("marital_status", T.StringType(), True),
    T.StructField("occupation", T.StringType(), True),
    T.StructField("relationship", T.StringType(), True),
    T.StructField("race", T.StringType(), True),
    T.StructField("sex", T.StringType(), True),
    T.StructField("capital_gain", T.DoubleType(), True),
    T.StructField("capital_loss", T.DoubleType(), True),
    T.StructField("hours_per_week", T.DoubleType(), True),
    T.StructField("native_country", T.StringType(), True),
    T.StructField("income", T.StringType(), True),
])
CENSUS_COLUMNS = CENSUS_SCHEMA.fieldNames()


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = CENSUS_SCHEMA,
    *,
    delimiter: str = ",",
    header: bool = False,
    mode: str = "PERMISSIVE",
    trim: bool = False,
    corrupt_column: str | None = None,
    null_tokens: Sequence[str] = (),
) -> DataFrame:
    """Read delimited text under ``schema``; nothing is inferred, so no extra pass is made.

    In the default permissive mode a bad or missing field is NULL and its row is kept.
    ``corrupt_column`` adds the raw text of such rows. ``null_tokens`` turns those texts, compared
    without surrounding blanks, into NULL in every string column.
    """
    read_schema = schema
    if corrupt_column:
        read_schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    reader = (
        spark.read.schema(read_schema)
        .option("header", header)
        .option("delimiter", delimiter)
        .option("mode", mode)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.csv(path)
    if null_tokens:
        texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({
            name: F.when(~F.trim(F.col(name)).isin(*null_tokens), F.col(name)) for name in texts
        })
    return df
