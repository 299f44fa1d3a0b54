"""Fingerprints of rows, whatever their order and however they are cut into files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # a null leaves the hash as it is, so its place has to be told
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def fingerprint(df: DataFrame, by: str | None = None) -> DataFrame:
    """(``by``, rows, mark): how many rows, and a mark of what they hold, for each value of ``by`` or in all.

    The mark joins sums of two 64-bit hashes of every row, so it does not depend on the rows' order and does count
    equal rows. Tasks add up before anything is shuffled.
    """
    sums = [F.sum(_row_hash(df.columns, seed).cast("decimal(20,0)")) for seed in (1, 2)]
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws("/", *[F.coalesce(s, F.lit(0)).cast("string") for s in sums]).alias("mark"))
