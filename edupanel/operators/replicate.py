"""Rows of the last year, and their replication to years without data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def at_last_year(df: DataFrame, year: str = "ano") -> DataFrame:
    """Rows at the highest year; the year reaches the filter as a scalar subquery."""
    return df.where(F.col(year) == df.agg(F.max(year)).scalar())


def replicate_forward(
    df: DataFrame,
    year: str = "ano",
    target_years: Sequence[int] | None = None,
    until: int | None = None,
) -> DataFrame:
    """All rows, plus one copy of each last-year row per target year.

    ``target_years`` lists the years literally. ``until`` instead fills every year after the
    last one, so newer data never doubles a year. Each row generates its own copies: no
    join, no shuffle and no second read for the copies.
    """
    if (target_years is None) == (until is None):
        raise ValueError("give either target_years or until")
    last = df.agg(F.max(year)).scalar()
    own = F.array(F.col(year))
    if target_years is not None:
        extra = F.array(*[F.lit(y).cast("int") for y in target_years]) if target_years else None
    else:
        following = F.sequence(F.col(year) + 1, F.lit(until))
        extra = F.when(F.col(year) < until, following).otherwise(F.array().cast("array<int>"))
    if extra is None:
        return df
    years = F.when(F.col(year) == last, F.concat(own, extra)).otherwise(own)
    others = [F.col(c) for c in df.columns if c != year]
    return df.select(*others, F.explode(years).alias(year)).select(*df.columns)
