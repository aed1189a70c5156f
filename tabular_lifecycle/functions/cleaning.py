"""Cleaning expressions. All are JVM-side, so a chain of them is one generated projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as a blank at the ends of a text.
_BLANKS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Java reads "12d" and "12f" as numbers; here they are text.
_SUFFIXED = r"^\s*[+-]?[0-9.].*[dDfF]\s*$"


def clean_category(value: Column) -> Column:
    """Strip, lower-case, drop full stops and commas, turn each inner blank into a dash."""
    return F.translate(F.lower(F.btrim(value, F.lit(_BLANKS))), " .,", "-")


def age_band(age: Column) -> Column:
    """Decade band of an age. Bands hold whole ages only; anything else, NULL too, is ``other``."""
    whole = age == F.floor(age)

    def within(low: int, high: int) -> Column:
        return whole & (age >= low) & (age <= high)

    return (
        F.when(age <= 19, "teens")
        .when(within(20, 29), "20s")
        .when(within(30, 39), "30s")
        .when(within(40, 49), "40s")
        .when(within(50, 59), "50s")
        .when(within(60, 99), "60+")
        .otherwise("other")
    )


def shifted_log(value: Column) -> Column:
    """ln(value + 1): minus infinity at -1, NULL below it and for NaN."""
    shifted = value + F.lit(1.0)
    return (
        F.when(F.isnan(shifted), F.lit(None).cast("double"))
        .when(shifted == 0, F.lit(float("-inf")))
        .otherwise(F.log(shifted))
    )


def to_number(value: Column) -> Column:
    """Number in the text, NULL where there is none."""
    text = value.cast("string")
    return F.when(~text.rlike(_SUFFIXED), text.try_cast("double"))
