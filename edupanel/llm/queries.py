"""Registered queries of the operators, with their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bm25, crf_quality, exact_dedup, fp_tree, lattice_lm, line_dedup, mixing, ngram_join, packing, secret_scan,
    token_alignment, url_filter, warc,
)
from .common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document gives to the mix, in training order."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "position")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all URLs."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies."""
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op6_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every 50th document."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.where(F.col("doc_id") % 50 == 0).withColumnRenamed("doc_id", "query")
    return bm25.search(docs, asked)


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all texts."""
    return lattice_lm.score(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all texts."""
    return crf_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines of ten or more sites, their text as a digest."""
    cleaned = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op11_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return fp_tree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies lie over each other in all documents."""
    return token_alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    counts = [F.size(secret_scan.of_kinds("spans", kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS]
    base = secret_scan.as_text(secret_scan.of_kinds("spans", *secret_scan.BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.as_text("spans").alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_warc, op3_mixing, op4_url_filter, op5_ngram_join, op6_bm25, op7_lattice_lm,
    op8_crf_quality, op9_packing, op10_line_dedup, op11_fp_tree, op12_token_alignment, op13_secret_scan)}

_SPACES = r"[\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MIX_WEIGHT = "(CASE rank % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE"

ORACLE = {
    "op1_exact_dedup": f"""
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
          row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY norm)""",
    "op2_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes
          FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
          CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op3_mixing": f"""
        WITH d AS (
          SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
        w AS (SELECT *, {_MIX_WEIGHT} AS weight, (3 * source_size)::DOUBLE AS cap FROM r),
        l AS (
          SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
          FROM w WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, rank, least(cap, max(level) OVER () * weight) AS target FROM l),
        p AS (
          SELECT d.doc_id, size, source_size, target, rank, coalesce(sum(size) OVER (
            PARTITION BY d.source ORDER BY key, d.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            ), 0)::BIGINT AS start
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (
          SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole FROM p),
        x AS (
          SELECT *, whole * size + greatest(0, least(size, floor(target)::BIGINT - whole * source_size - start))
            AS taken, start / target AS share FROM k)
        SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
          CASE WHEN taken > 0 THEN CASE rank % 3
            WHEN 0 THEN 2.0 * share / (0.5 + sqrt(0.25 + 2.0 * share))
            WHEN 1 THEN 2.0 * share / (1.0 + sqrt(1.0 + 0.0 * share))
            ELSE 2.0 * share / (1.5 + sqrt(2.25 + -2.0 * share)) END END AS position
        FROM x""",
    "op10_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        m AS (
          SELECT line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
          HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(m.line) AS n_removed,
          sha256(coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE m.line IS NULL), '')) AS text_sha256
        FROM l LEFT JOIN m USING (line) GROUP BY doc_id""",
    "op11_fp_tree": rf"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLDED}, '{_TERM}') AS terms FROM documents),
        s AS (SELECT count(*) FILTER (len(terms) > 0) AS nd, sum(len(terms))::BIGINT AS total FROM d),
        t AS (
          SELECT r, doc_id, term, n, count(*) AS tf
          FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY r, doc_id, term, n),
        w AS (
          SELECT term, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term),
        q AS (
          SELECT i, item_id, term, count(*) AS times FROM (
            SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all({_FOLDED}, '{_TERM}')) AS term FROM benchmark)
          GROUP BY i, item_id, term),
        x AS (
          SELECT i, item_id, r, doc_id,
            sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // total))))::BIGINT AS score
          FROM q JOIN t USING (term) JOIN w USING (term), s GROUP BY i, item_id, r, doc_id),
        k AS (
          SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
          FROM x WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
}
