"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest

from edupanel.llm import (
    bm25, crf_quality, exact_dedup, lattice_lm, line_dedup, mixing, ngram_join, packing, url_filter, warc,
)
from edupanel.llm import queries as Q

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
DOCS = [
    (1, "a b  c", "s"), (2, "a b\tc", "t"), (2, "a b\tc", "t"), (3, None, None), (4, "", "s"), (5, "\x0b", "t"),
    (None, "a b c", "s"), (6, LONG, "s"), (7, LONG + " end", "s"), (8, "one two three four five six seven", None),
]
EXTRA = ["'x' as row", "1 as size", "2 as node", "'y' as digest", "3 as keep_id", "4 as grp", "5 as position", "6 as length"]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    frame.selectExpr("*", *EXTRA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_exact_dedup(docs):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == len(DOCS)
    copies = [r for r in rows if r.group_size == 4]
    assert sorted((r.doc_id or 0, r.keep_id, r.kept) for r in copies) == [
        (0, 1, False), (1, 1, True), (2, 1, False), (2, 1, False)]
    empty = [r for r in rows if r.doc_id in (3, 4)]
    assert [(r.keep_id, r.group_size) for r in empty] == [(3, 2)] * 2
    assert [r.group_size for r in rows if r.doc_id == 5] == [1]


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    rows = exact_dedup.exact_dedup(spark.createDataFrame([(1, "x")] * 3, "doc_id long, text string")).collect()
    assert sorted(r.kept for r in rows) == [False, False, True]


def test_ngram_join(docs):
    rows = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.ngram_join(docs).collect()}
    assert rows[1, 1] == rows[2, 1] == rows[None, 1] == 1
    assert rows[3, 0] == 3 and rows[4, 0] == 4 and rows[5, 0] == 5
    assert rows[6, 29_996] == rows[7, 29_997] == 6 and rows[8, 3] == 8


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(DOCS)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    by_source = {r.source_size: r.target for r in rows}
    assert sum(by_source.values()) == pytest.approx(sum(r.size for r in rows))
    for size, target in by_source.items():
        assert sum(r.taken for r in rows if r.source_size == size) == int(target)
    again = {(r.doc_id, r.size): r.taken for r in mixing.mix(docs).collect()}
    assert again == {(r.doc_id, r.size): r.taken for r in rows}
    mixed = mixing.repeat(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.passes for r in rows)


def test_line_dedup(spark):
    data = [(i, f"common\nown {i}\n\ncommon", f"s{i}") for i in range(12)] + [(None, None, None), (90, "common\nx", "s1")]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "1 as pos", "'l' as line")
    rows = {r.doc_id: r for r in line_dedup.line_dedup(frame).collect()}
    assert rows[3].text == "own 3\n" and (rows[3].n_lines, rows[3].n_removed) == (4, 2)
    assert rows[90].text == "x" and rows[None].text == "" and rows[None].n_lines == 1


def test_packing_and_scores(spark, docs):
    packed = packing.pack_documents(docs, Q.tokenizer_file("word_bpe_49k.json")).collect()
    assert len({(r.doc_id, r.piece) for r in packed}) <= len(packed) and max(r.length for r in packed) == 2048
    assert sum(r.start == 0 for r in packed) == len(DOCS)
    scores = lattice_lm.score(docs, Q.tokenizer_file("piece_bpe_32k.model")).collect()
    assert len(scores) == len(DOCS) and {r.n_tokens for r in scores if r.doc_id in (3, 4, 5)} == {1}
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    judged = crf_quality.score(docs, labels).collect()
    assert len(judged) == len(DOCS) and all(0 <= r.score <= 1 for r in judged)
    assert crf_quality.keep(docs, labels.limit(0)).count() == len(DOCS)


def test_crf_draws_short_documents_once(spark, monkeypatch):
    """Most documents are too long to train, and many rows carry one id."""
    fitted = []
    monkeypatch.setattr(crf_quality, "fit", lambda chains, marked: fitted.append((chains, marked)))
    rows = [(i, f"line {i}\n" * (2 if i % 10 < 2 else 9)) for i in range(200)] + [(0, f"copy {i}\nx") for i in range(60)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    marks = spark.createDataFrame([(i, i % 2) for i in range(200)], "id long, label int")
    crf_quality.train(docs, marks, sample_docs=20, sample_lines=3)
    chains, marked = fitted[0]
    assert sorted(marked) == [0] * 20 + [1] * 20 and {len(c) for c in chains} <= {2, 3}
    assert crf_quality.train(docs, marks, sample_docs=20, sample_lines=1) is None


def test_bm25(docs):
    asked = docs.selectExpr("doc_id as query", "text")
    found = bm25.search(docs, asked, k=2).collect()
    assert [(r.rank, r.doc_id) for r in found if r.query_id == 8] == [(1, 8)]
    assert not [r for r in found if r.query_id in (3, 4, 5)]
    assert sorted(r.rank for r in found if r.query_id == 1) == [1, 2]


def test_bm25_in_blocks(spark, monkeypatch):
    texts = [" ".join(f"w{(i * j * j + j) % (5 + i % 40)}" for j in range(1 + i % 60)) for i in range(150)]
    texts += texts[:20] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    asked = docs.selectExpr("doc_id as query", "text")
    whole = sorted(map(tuple, bm25.search(docs, asked).collect()))
    for name, value in {
        "FREQUENT": 7, "BLOCK_DOCS": 4, "SHARD_DOCS": 13, "CHUNK_QUERIES": 3, "CHUNK_POSTINGS": 50, "CHUNK_CANDIDATES": 9, "SHARDS_A_FILE": 1,
    }.items():
        monkeypatch.setattr(bm25, name, value)
    found = bm25.search(docs, asked, query_postings=500)
    assert [r[:3] for r in sorted(map(tuple, found.collect()))] == [r[:3] for r in whole]
    assert [r[3] for r in sorted(map(tuple, found.collect()))] == pytest.approx([r[3] for r in whole], rel=1e-12)


def test_bm25_reads_its_index_as_it_lies(docs, monkeypatch):
    searched = []
    search_block = bm25._search_block
    monkeypatch.setattr(bm25, "_search_block", lambda *args: searched.append(search_block(*args)) or searched[-1])
    bm25.search(docs, docs.selectExpr("doc_id as query", "text"), query_postings=25_000)
    assert len(searched) > 1
    assert not [hits for hits, _ in searched if "Exchange" in hits._jdf.queryExecution().executedPlan().toString()]


def test_urls_and_warc(spark):
    pages = [(1, "HTTPS://Blog.Example.ORG/en/1?q", "x" * 100), (2, "nothing", "x" * 100), (2, None, "x" * 100),
             (3, "http://a.net", "y"), (None, "", "x" * 100), (4, "://b.com/de/#f", None), (5, "u", "y")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'a' as host", "'b' as digest", "1 as first")
    found = {(r.page_id, r.host): r for r in url_filter.filter_urls(frame).collect()}
    assert found[1, "blog.example.org"].rule == "example.org/en/1" and found[4, "b.com"].verdict == "block"
    assert found[2, ""].path == "" and len(found) >= 6
    read = warc.round_trip(frame).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in read if r.payload_bytes == 100) == [
        (0, "revisit", 1), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1)]
    assert {(r.page_id, r.payload_bytes, r.record_type) for r in read} >= {(3, 1, "response"), (5, 1, "response"), (4, 0, "response")}


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for frame in (
        exact_dedup.exact_dedup(none), mixing.mix(none), mixing.repeat(none), line_dedup.line_dedup(none),
        ngram_join.ngram_join(none), crf_quality.score(none, labels), url_filter.filter_urls(pages),
        packing.pack_documents(none, Q.tokenizer_file("word_bpe_49k.json")), warc.round_trip(pages),
        lattice_lm.score(none, Q.tokenizer_file("piece_bpe_32k.model")),
        bm25.search(none, none.selectExpr("doc_id as query", "text")),
    ):
        assert frame.count() == 0
