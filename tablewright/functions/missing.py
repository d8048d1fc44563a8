"""Missing-value tokens and number parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The missing-value markers of the pandas text reader.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"
INTEGER = r"^[+-]?[0-9]+$"


def is_missing(token: Column) -> Column:
    return token.isNull() | token.isin(*NA_TOKENS)


def is_number(token: Column) -> Column:
    """True for a token a text reader turns into a float, or for a missing one."""
    return is_missing(token) | token.rlike(NUMBER) | token.rlike(INFINITE)


def parse_number(token: Column) -> Column:
    """DOUBLE, with every missing marker (and anything unparsable) as null."""
    return F.when(is_missing(token) | ~is_number(token), F.lit(None)).otherwise(token.try_cast("double"))


def nan_to_null(x: Column) -> Column:
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def missing_number(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def is_integral(x: Column) -> Column:
    """x % 1 == 0; NaN, infinities and null are not integral."""
    return F.coalesce((x % F.lit(1.0)) == F.lit(0.0), F.lit(False))
