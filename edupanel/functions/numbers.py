"""Missing values, parsing, rounding and number labels as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from edupanel.config import DASH_NA_TOKENS, DEFAULT_NA_TOKENS

ALL_NA_TOKENS = DEFAULT_NA_TOKENS + DASH_NA_TOKENS


def na_map(text: Column, tokens: Sequence[str] = ALL_NA_TOKENS) -> Column:
    """Null where the whole field equals a missing-value token."""
    return F.when(~text.isin(*tokens), text)


def coerce_numeric(text: Column) -> Column:
    """Parse to double; whatever is not a plain decimal number becomes null."""
    # Java also reads '1.5d', '2f' and hexadecimal floats as numbers
    java_only = text.rlike(r"[0-9.][dDfF]\s*$|[xX]")
    number = F.when(~java_only, text.try_cast("double"))
    return nan_to_null(number)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def parse_number(text: Column, name: str) -> Column:
    """Parse to double; a field that is neither missing nor a number fails the job."""
    number = coerce_numeric(text)
    broken = F.raise_error(F.concat(F.lit(f"{name} is not a number: "), text))
    return F.when(text.isNotNull() & number.isNull(), broken.cast("double")).otherwise(number)


def parse_key(text: Column) -> Column:
    """Whole-number key as LONG, also from '3550308.0'; other text fails the job."""
    key = text.try_cast("decimal(38,4)").cast("long")
    broken = F.raise_error(F.concat(F.lit("not a key: "), text)).cast("long")
    return F.when(text.isNotNull() & key.isNull(), broken).otherwise(key)


def ratio(numerator: Column, denominator: Column) -> Column:
    """IEEE division with 0/0 as null: x/0 is a signed infinity, null stays null."""
    infinity = F.lit(float("inf"))
    by_zero = F.when(numerator > 0, infinity).when(numerator < 0, -infinity)
    return F.when(denominator == 0, by_zero).otherwise(numerator / denominator)


def round_half_even(number: Column, digits: int = 2) -> Column:
    """Round the scaled binary value, ties to even (5.015 -> 5.01, 0.125 -> 0.12)."""
    scale = float(10**digits)
    return F.rint(number * scale) / scale


def thousands(number: Column) -> Column:
    """1234567 -> '1.234.567'."""
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))


def fixed_decimals(number: Column) -> Column:
    """Two-decimal label, rounded from the exact binary value (1.005 -> '1.00').

    ``x * 100`` is taken with its rounding error (split into halves whose products with
    100 are exact), so the comparison with the tie is exact.
    """
    hundred = F.lit(100.0)
    product = number * hundred
    spread = number * 134217729.0
    high = spread - (spread - number)
    error = (high * hundred - product) + (number - high) * hundred
    # cast keeps whole-number steps in double; values here are far below 2^53
    below = F.floor(product).cast("double")
    over_tie = (product - below - 0.5) + error
    up = (over_tie > 0) | ((over_tie == 0) & (F.pmod(below, F.lit(2.0)) == 1.0))
    cents = F.when(up, below + 1).otherwise(below)
    return F.when(number.isNotNull(), F.format_string("%.2f", cents / hundred))


def plain_number(number: Column) -> Column:
    """Text of a double without exponent up to 1e16, as CSV readers expect it."""
    text = number.cast("string")

    def long_form(decimals: int) -> Column:
        digits = number.try_cast(f"decimal(38,{decimals})").cast("string")
        return F.regexp_replace(digits, r"(\.[0-9]+?)0+$", "$1")

    size = F.abs(number)
    return (
        F.when(size == float("inf"), F.when(number > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size >= 1e7) & (size < 1e16), long_form(18))
        # four zeros and up to 17 digits
        .when((size >= 1e-4) & (size < 1e-3), long_form(24))
        .otherwise(text)
    )
