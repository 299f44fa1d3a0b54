"""Wide to long, long to wide, and filling of absent cells."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupanel.functions.text import year_suffix


def wide_to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per (row, value column); null cells stay."""
    return df.unpivot(list(ids), list(values), name, value)


def unpivot_years(
    df: DataFrame, ids: Sequence[str], prefix: str, years: Sequence[int], value: str
) -> DataFrame:
    """Yearly columns ``<prefix><year>`` to rows (ids, ano, value); null cells stay."""
    long = wide_to_long(df, ids, [f"{prefix}{y}" for y in years], "_name", value)
    return long.withColumn("ano", year_suffix(F.col("_name"), prefix)).drop("_name")


def wide_by_value(
    df: DataFrame,
    ids: Sequence[str],
    by: str,
    names: Mapping[object, str],
    cell: Callable[[Column], Column],
    value: Column,
) -> DataFrame:
    """One column per listed value of ``by`` holding ``cell`` of its rows.

    ``names`` maps the value to its output column. A conditional aggregate needs one
    shuffle and no job to find the values; a combination without rows is null.
    """
    cells = [cell(F.when(F.col(by) == key, value)).alias(out) for key, out in names.items()]
    return df.groupBy(*ids).agg(*cells)


def densify(df: DataFrame, dims: Mapping[str, Sequence[object]]) -> DataFrame:
    """Add a row with null measures for every combination of the listed labels not in ``df``.

    ``dims`` are short fixed label lists, spelled out from one row, never read from data.
    """
    grid = df.sparkSession.range(1)
    for name, labels in dims.items():
        options = F.array(*[F.lit(v) for v in labels]).cast(f"array<{dict(df.dtypes)[name]}>")
        grid = grid.withColumn(name, F.explode(options))
    return grid.drop("id").join(df, list(dims), "left").select(*df.columns)
