"""What several operators share: white space, words, staged tables and link components."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from edupanel.session import drop_staged, stage

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame) -> DataFrame:
    """Whole rows as ``doc`` with a number ``row``, written once.

    The number depends on how Spark cuts the files, which can change between two reads, for one when executors
    come or go. All who join by it must read this one table, which holds it. It is packed tightly, as it is as large as
    the input.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"))
    return stage(rows, "numbered", compression="zstd")


def tidied(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over a task's batches, at the end of which the worker gives back the memory that it has freed.

    Spark keeps workers for later stages, where what they hold on to is missing.
    """

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            trim()

    return run


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What is run within passes at most so many rows at a time between the JVM and Python, for rows with long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def trim() -> None:
    """Give back the memory that this process has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if release:
        release(0)


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold_of(doc_id: str, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; splits at bytes 0x20 and 0x09-0x0D only."""
    return text.lower().split() if text else []


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link.

    Alternates large-star and small-star steps until the links no longer change. Each step is
    a minimum per node, combined before the shuffle, and an equi-join whose skew Spark splits.
    Every round is written to the shared folder, so no lineage builds up and lost executors
    cost one round. Links of a node with itself and null nodes are ignored.
    """
    low, high = F.least(a, b).alias("v"), F.greatest(a, b).alias("u")
    edges, sums = _stored(links.where(F.col(a) != F.col(b)).select(high, low).distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, was = edges, sums
        edges, sums = _stored(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        drop_staged(before)
        if sums == was:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links in the shared folder, with their number and a sum of hashes observed while they are written."""
    watch = Observation()
    hashed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hashed")
    stored = stage(edges.observe(watch, F.count(F.lit(1)).alias("n"), hashed), "links")
    return stored, (watch.get["n"], watch.get["hashed"])
