"""Census preparation: cleaned categories, age bands, logs of the skewed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import age_band, clean_category, shifted_log
from ..operators.relational import drop_incomplete

# The cleaned categories, the replaced columns and the model inputs.
CATEGORICAL = (
    "workclass", "education", "marital_status", "occupation", "relationship",
    "race", "sex", "native_country", "income",
)
REPLACED = ("age", "capital_gain", "capital_loss")
NUMERIC_INPUTS = ("fnlwgt", "hours_per_week", "log_capital_gain", "log_capital_loss")
CATEGORICAL_INPUTS = (
    "age_by_decade", "education", "occupation", "relationship", "workclass", "native_country",
)
SUPPORTED = (
    "age_by_decade", "fnlwgt", "education", "occupation", "hours_per_week", "relationship",
    "workclass", "log_capital_gain", "log_capital_loss", "native_country",
)
LABEL = "income"
POSITIVE = ">50k"


def prepare(df: DataFrame) -> DataFrame:
    """One projection over the scan; rows with NULLs stay, extra columns pass through."""
    return df.withColumns({
        **{c: clean_category(F.col(c)) for c in CATEGORICAL},
        "age_by_decade": age_band(F.col("age")),
        "log_capital_gain": shifted_log(F.col("capital_gain")),
        "log_capital_loss": shifted_log(F.col("capital_loss")),
    }).drop(*REPLACED)


def prepare_training(df: DataFrame) -> DataFrame:
    """The training path leaves out rows with any NULL first."""
    return prepare(drop_incomplete(df))
