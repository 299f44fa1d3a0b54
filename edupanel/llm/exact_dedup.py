"""Exact deduplication in three combining stages, each on digest and full content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edupanel.session import stage

from .common import SPACES, text_of

SALTS = 64


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), SPACES, " ")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    row_col: str | None = None, salts: int = SALTS,
) -> DataFrame:
    """Decide for every row whether it stays among the rows of equal normalised text.

    1. Each task combines its own rows by (digest, text): the map side of stage 2.
    2. What the tasks found meets in (digest, text, salt) groups. The salt is the task's
       number, so a text that fills a third of the table is spread over ``salts`` groups.
    3. The winners of the salts, at most ``salts`` per text, are combined globally.

    The text itself is a grouping key in all stages, so equal digests of different texts never
    merge. Rows then find their winner by digest, length and a second hash.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256, and the row's
    ``row`` number. ``row_col`` names a column that numbers the rows uniquely; without it they
    are numbered here. Other columns are not read, so their names can't clash.
    Null text equals empty text; texts of white space only equal one space, not the empty text.
    Null ids lose against any id. Of rows that repeat text and smallest id exactly one is kept.
    An empty table gives an empty result.
    """
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    keys = ["digest", "chars", "check"]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), number.cast("long").alias("row"),
        normalised(text_col).alias("norm"),
    ).withColumn("digest", F.unhex(F.sha2("norm", 256)))
    salted = rows.groupBy("digest", "norm", (F.spark_partition_id() % salts).alias("salt")).agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    winners = salted.groupBy("digest", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    named = [F.length("norm").alias("chars"), F.xxhash64("norm").alias("check")]
    winners = winners.select("digest", *named, "keep_id", "group_size")
    members = rows.select("doc_id", "row", "digest", *named)
    found = stage(members.join(winners, keys).select(
        "doc_id", "row", *keys, "keep_id", "group_size"), "exact")
    # one row per group, also where rows repeat the smallest id
    first = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy(*keys).agg(
        F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    return found.join(first, "row", "left").select(
        "doc_id", "keep_id", "group_size", F.coalesce("first", F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row")
