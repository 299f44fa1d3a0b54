"""Keys: keep-first de-duplication, null keys, uniqueness report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; null keys count as equal.

    Spark keeps only the first row per key in every task before it shuffles
    (WindowGroupLimit), so a key that holds a third of all rows costs one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grouping on a null key yields no group, so such rows leave before the shuffle."""
    return df.na.drop("any", subset=list(keys))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once and how many rows they hold.

    Left joins are not validated, a duplicate right key multiplies rows; run this on the
    right side first where that matters.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.count_if(F.col("n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        )
    )


def assert_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``df`` as it is; a key that occurs more than once fails the job that reads it, with ``label`` in the error.

    The count is a window over the keys. A join on the same keys needs the rows in the same place and order, so
    the check adds neither a shuffle nor a job to it. Null keys match nothing in a join and are not counted.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    twice = F.concat(F.lit(f"{label}: key more than once: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    counted = df.withColumn("_rows", rows)
    # part of the filter, so that it runs whichever columns are wanted
    return counted.where(F.when(known & (F.col("_rows") > 1), F.raise_error(twice).cast("boolean")).otherwise(True)).drop("_rows")
