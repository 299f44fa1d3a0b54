"""Removal of lines that stand on many distinct sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of

MIN_SITES = 10
LG_K = 10
SALTS = 16


def _meet(lines: DataFrame, wanted: DataFrame, spread_by: Column) -> DataFrame:
    """``lines`` whose line is in ``wanted``, which holds each once: every such line meets its rows in SALTS places."""
    salted = lines.withColumn("_salt", F.pmod(spread_by, F.lit(SALTS)).cast("int"))
    copies = wanted.select("line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return salted.join(copies, ["line", "_salt"]).drop("_salt")


def spread_lines(
    docs: DataFrame, text_col: str = "text", site_col: str = "source",
    min_sites: int = MIN_SITES, lg_k: int = LG_K,
) -> DataFrame:
    """(line, sites): MD5 of every line that stands on at least ``min_sites`` distinct sites.

    A HyperLogLog sketch of the sites per line is built in each task and merged by the
    aggregation. Lines whose estimate lies within five standard errors and one site of the
    threshold are counted exactly; beyond that the estimate decides.
    """
    lines = docs.select(
        F.explode(F.split(text_of(text_col), "\n")).alias("line"),
        F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("n")).alias("site"),
    ).where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        F.unhex(F.md5(F.col("line").cast("binary"))).alias("line"), "site")
    margin = 1 + 5 * min_sites * 1.04 / 2 ** (lg_k / 2)
    counted = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites")
    ).where(F.col("sites") >= min_sites - margin)
    near = counted.where(F.col("sites") <= min_sites + margin).select("line")
    exact = _meet(lines, near, F.xxhash64("site")).distinct().groupBy("line").agg(
        F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return counted.where(F.col("sites") > min_sites + margin).union(exact)


def remove_lines(docs: DataFrame, spread: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, text) with the lines of ``spread`` taken out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "check", F.unhex(F.md5(F.col("text").cast("binary"))))
    lines = rows.select("doc_id", "check", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(
        F.col("line").rlike(r"[^\x20\x09-\x0D]")
    ).select("doc_id", "check", "pos", F.unhex(F.md5(F.col("line").cast("binary"))).alias("line"))
    # text and id name a row: rows that repeat both lose the same lines
    hits = _meet(lines, spread.select("line"), F.xxhash64("check", "pos")).groupBy("doc_id", "check").agg(
        F.sort_array(F.collect_set("pos")).alias("gone"))
    hits = hits.withColumnsRenamed({"doc_id": "_id", "check": "_check"})
    joined = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("check") == F.col("_check")), "left")
    # what lies between removed lines, cut out piece by piece: linear in the number of lines
    kept = F.expr(
        "array_join(flatten(transform(sequence(0, size(gone)), k -> slice(lines,"
        " if(k = 0, 1, gone[greatest(k - 1, 0)] + 2),"
        " if(k = size(gone), size(lines), gone[least(k, size(gone) - 1)])"
        " - if(k = 0, 0, gone[greatest(k - 1, 0)] + 1)))), '\n')")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return joined.withColumn("lines", F.split("text", "\n")).withColumn("gone", gone).select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("text"))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    min_sites: int = MIN_SITES, lg_k: int = LG_K,
) -> DataFrame:
    """Every document without the lines that stand on ``min_sites`` or more distinct sites.

    Lines end at line feeds and are compared as they are. Lines of white space only always stay.
    Returns doc_id, n_lines, n_removed and the cleaned text, one row per input row. Null text is
    empty text (one empty line); null sites are one site. Equal lines of one document go or stay
    together. Repeated rows are repeated in the result. An empty table gives an empty result.
    Other columns are not read.
    """
    spread = spread_lines(docs, text_col, site_col, min_sites, lg_k)
    return remove_lines(docs, spread, id_col, text_col)
