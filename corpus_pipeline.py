"""A training corpus in five stages: quality, exact copies, near copies, mixing, packing."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from edupanel.llm import crf_quality, exact_dedup, mixing, ngram_join, packing
from edupanel.llm.common import numbered
from edupanel.llm.queries import tokenizer_file
from edupanel.session import drop_paths, new_path, staged_paths

#: The fitted models and tokenisation have no SQL; tests compare all stages with plain Python.
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_staged: list[str] = []


def _lean(function: Stage) -> Stage:
    """A stage that begins by deleting what the stage before has staged, unless its ``docs`` still read from there.

    A stage's result is lazy, so its staged tables are needed until the result is written, which it is when the next stage begins.
    """

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _staged else []
        drop_paths(spark, [path for path in _staged if not any(path in name for name in read)])
        with staged_paths() as paths:
            result = function(spark, docs, sf_dir)
        _staged[:] = paths
        return result

    return run_stage


@_lean
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the line field does not reject."""
    return crf_quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_lean
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts, one with the smallest id."""
    rows = numbered(docs)
    narrow = rows.select("row", "doc.doc_id", "doc.text")
    kept = exact_dedup.exact_dedup(narrow, row_col="row").where("kept").select("row")
    return rows.join(kept, "row", "left_semi").select("doc.*")


@_lean
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of near copies, one with the smallest id."""
    rows = numbered(docs)
    found = ngram_join.ngram_join(rows.select("row", "doc.text"), id_col="row")
    found = found.select(F.col("doc_id").alias("row"), "component_id")
    ids = found.join(rows.select("row", "doc.doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))
    kept = ids.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select("doc.*")


@_lean
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix begins it, in training order."""
    return mixing.repeat(docs)


@_lean
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
