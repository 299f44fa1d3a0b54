"""Operators without SQL against plain Python over whole test tables and small fixtures."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from edupanel.llm import lattice_lm as LM, ngram_join, queries as Q

SF = "/root/testdata/sf0.001"
BOTH = [SF, "/root/testdata/sf0.01"]


def rows_of(sf, table, columns):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf}/{table}.parquet'").fetchall()


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def crc5(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def components(sets):
    """{id: smallest id reachable}, comparing all pairs that share a shingle."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    pairs = {(a, b) for ids in by_shingle.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def shingle_set(text):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


@pytest.mark.parametrize("sf", BOTH)
def test_ngram_join(spark, sf):
    sets = {i: shingle_set(t) for i, t in rows_of(sf, "documents", "doc_id, text")}
    expected = components(sets)
    got = Q.op5_ngram_join(spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {
        i: (len(s), expected[i]) for i, s in sets.items()}
    assert len(got) == len(sets) and len(set(expected.values())) < len(sets)


def test_variants_around_the_similarity(spark):
    """Variants of a few texts, most with similarities close to the one asked for, some of other lengths."""
    draw, texts = np.random.default_rng(5), {}
    for base in range(3):
        words_ = [f"b{base}w{i}" for i in range(90 + 40 * base)]
        for v in range(70):
            changed = list(words_)
            for at in draw.choice(len(words_), draw.integers(1, 4 + 2 * base), replace=False):
                changed[at] = f"x{draw.integers(6)}"
            texts[len(texts)] = " ".join(changed[:len(changed) - int(draw.integers(0, 25)) * (v % 3 == 0)])
    sets = {i: shingle_set(t) for i, t in texts.items()}
    expected = components(sets)
    got = ngram_join.ngram_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert 3 < len(set(expected.values())) < len(texts)


def _thue_morse(bits, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(1 << bits))


def test_self_similar_texts_stay_apart(spark):
    """Words and word sequences that all polynomial hashes modulo a power of two take for equal."""
    texts = [_thue_morse(10, "ab"), _thue_morse(10, "ba")]
    texts += [" ".join(_thue_morse(11, letters)) for letters in ("xy", "yx")]
    texts += [" ".join(_thue_morse(11, letters).replace("p", "pp ").split()) for letters in ("pq", "qp")]
    texts += ["w" * n for n in (7, 8, 9, 63, 64, 65, 72, 73)] + ["w" * 64 + "v", "w" * 63 + "v", "w" * 72 + "v"]
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    got = ngram_join.ngram_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in got} == components(sets)
    assert [r.component_id for r in got if r.doc_id < 2 or r.doc_id > 5] == [r.doc_id for r in got if r.doc_id < 2 or r.doc_id > 5]


def test_ngram_join_some_members_first(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]

    def edited(times):
        text = list(base)
        for _ in range(times):
            text[draw.randrange(len(text))] = f"x{draw.randrange(10**9)}"
        return " ".join(text)

    texts = [edited(1) for _ in range(80)] + [edited(draw.choice([2, 3])) for _ in range(40)]
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    verified, compared = ngram_join._verified, []
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *args: compared.append(pairs.count()) or verified(pairs, *args))
    monkeypatch.setattr(ngram_join, "GROUP_ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "LEADERS", ngram_join.LEADERS[:1])
    pairs = {}
    for many in (1 << 40, 8):
        monkeypatch.setattr(ngram_join, "MANY", many)
        monkeypatch.setattr(ngram_join, "FIRST", 6)
        compared.clear()
        got = {r.doc_id: r.component_id for r in ngram_join.ngram_join(docs).collect()}
        assert got == components(sets)
        pairs[many] = sum(compared)
    assert pairs[8] < pairs[1 << 40]


def test_repeated_tokens_across_batches():
    tokens = [1, 2, 2, 3, 4, 4, 4, 5, 6, 6, 7]
    rows = pa.RecordBatch.from_arrays([pa.array(range(11), pa.int64()), pa.array(tokens, pa.int64())], ["row", "token"])
    for cut in range(1, 12):
        batches = [rows.slice(i, cut) for i in range(0, 11, cut)] + [rows.slice(0, 0)]
        got = [t for b in ngram_join._repeated(iter(batches)) for t in b.column(1).to_pylist()]
        assert got == [2, 2, 4, 4, 4, 6, 6]
    assert not list(ngram_join._repeated(iter([])))


@pytest.mark.parametrize("sf", BOTH)
def test_bm25(spark, sf):
    docs = {i: Counter(words(t)) for i, t in rows_of(sf, "documents", "doc_id, text")}
    lengths = {i: sum(c.values()) for i, c in docs.items()}
    mean, df = sum(lengths.values()) / len(docs), Counter(w for c in docs.values() for w in c)
    got = defaultdict(list)
    for r in Q.op6_bm25(spark, sf).collect():
        got[r.query_id].append((r.rank, r.doc_id, r.score))
    assert set(got) == {i for i in docs if i % 50 == 0 and docs[i]}
    for q, found in got.items():
        scores = {}
        for i, c in docs.items():
            s = 0.0
            for w, times in docs[q].items():
                if c[w]:
                    idf = math.log1p((len(docs) - df[w] + 0.5) / (df[w] + 0.5))
                    s += times * idf * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * lengths[i] / mean))
            if s:
                scores[i] = s
        best = sorted(scores.values(), reverse=True)[:10]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert [s for _, _, s in found] == pytest.approx(best, rel=1e-9)
        assert all(s == pytest.approx(scores[i], rel=1e-9) for _, i, s in found)


@pytest.mark.parametrize("sf", BOTH)
def test_lattice_lm(spark, sf):
    docs = rows_of(sf, "documents", "doc_id, text")
    counts = Counter()
    for i, t in docs:
        if crc5(i) != 1:
            counts.update(words(t) + [None])
    total, kinds = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in Q.op7_lattice_lm(spark, sf).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        tokens, r = words(t) + [None], got[i]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc5(i) == 1, len(tokens), total)
        assert r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_crf_held_out(spark):
    sf = BOTH[1]
    truth = dict(rows_of(sf, "labels", "doc_id, quality"))
    rows = Q.op8_crf_quality(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (crc5(r.doc_id) == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    for label in (0, 1):
        right = [r.predicted == label for r in held if truth[r.doc_id] == label]
        assert right and sum(right) / len(right) >= 0.95


@pytest.mark.parametrize("sf", BOTH)
def test_packing(spark, sf):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(Q.tokenizer_file("word_bpe_49k.json"))
    docs = rows_of(sf, "documents", "doc_id, coalesce(text, '')")
    expected = {}
    for (i, _), found in zip(docs, tokenizer.encode_batch([t for _, t in docs], add_special_tokens=False)):
        ids = found.ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            expected[i, piece] = start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    rows = Q.op9_packing(spark, sf).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= math.ceil(sum(v[1] for v in expected.values()) / 2048) * 1.01 + 1


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def ruled(host, path):
    fits = []
    for rule, verdict in RULES:
        site, start = rule.split("/", 1)
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


@pytest.mark.parametrize("sf", BOTH)
def test_url_rules(spark, sf):
    urls = dict(rows_of(sf, "pages", "page_id, url"))
    rows = Q.op4_url_filter(spark, sf).collect()
    assert len(rows) == len(urls)
    kinds = set()
    for r in rows:
        assert (r.host, r.path) == parts(urls[r.page_id])
        rule, verdict = ruled(r.host, r.path)
        assert r.rule == rule and (verdict is None or r.verdict == verdict)
        assert rule or r.verdict == ("block" if r.reject_probability > 0.5 else "allow")
        kinds.add((rule is None, r.verdict))
    assert {(False, "allow"), (False, "block")} <= kinds


def test_lattice_sums_all_segmentations():
    log_p = {f"<0x{b:02X}>": math.log(0.0005) for b in range(256)}
    log_p |= {p: math.log(w) for p, w in {"▁": 0.1, "a": 0.2, "ab": 0.15, "b": 0.05, "▁a": 0.07, "</s>": 0.1}.items()}
    lattice = LM.Lattice(log_p)

    def ways(text):
        """(probability, pieces) of every segmentation."""
        if not text:
            return [(1.0, ())]
        heads = [(math.exp(log_p[text[:n]]), (text[:n],), n) for n in range(1, len(text) + 1) if text[:n] in log_p]
        if text[0] not in log_p:
            spelt = tuple(f"<0x{b:02X}>" for b in text[0].encode())
            heads.append((0.0005 ** len(spelt), spelt, 1))
        return [(p * q, x + y) for p, x, n in heads for q, y in ways(text[n:])]

    found = [b"", b"a", b"abab", "aéb".encode(), b"</s>", b"<0x0A>a", "日".encode() * 3]
    counts = [2, 1, 3, 1, 1, 2, 1]
    expected, totals = Counter(), []
    for word, count in zip(found, counts):
        mine = [(p, x) for p, x in ways("▁" + word.decode()) if "</s>" not in x]
        if b"<0x" in word:  # byte pieces spell bytes, not their own names
            mine = [(p, x) for p, x in mine if "<0x0A>" not in x]
        totals.append(sum(p for p, _ in mine))
        for p, pieces in mine:
            for piece in pieces:
                expected[piece] += count * p / totals[-1]
    assert lattice.score(found) == pytest.approx([math.log10(p) for p in totals], rel=1e-12)
    seen = np.zeros(len(log_p))
    lattice.expect(found, np.array(counts), seen)
    assert dict(zip(lattice.pieces, seen)) == pytest.approx({p: expected[p] for p in log_p}, abs=1e-9)


def test_lattice_scores_of_whole_texts(spark):
    """Scores are sums over the words and the end, most of the words met in the join of the tail."""
    path = Q.tokenizer_file("piece_bpe_32k.model")
    docs = {i: words(t) for i, t in rows_of(SF, "documents", "doc_id, text")}
    counts = Counter(w for i, ws in docs.items() if crc5(i) != 1 for w in ws)
    first = LM.vocabulary(path)
    lattice, seen = LM.Lattice(first), np.zeros(len(first))
    lattice.expect([w.encode() for w in counts], np.array(list(counts.values())), seen)
    seen = dict(zip(lattice.pieces, seen))
    seen[LM.END] = sum(crc5(i) != 1 for i in docs)
    total = sum(seen.values()) + len(first) / 2
    log_p = {piece: math.log((seen[piece] + 0.5) / total) for piece in first}
    kinds = sorted({w for ws in docs.values() for w in ws})
    each = dict(zip(kinds, LM.Lattice(log_p).score([w.encode() for w in kinds]).tolist()))
    found = LM.score(spark.read.parquet(f"{SF}/documents.parquet"), path, head_words=20).collect()
    assert len(found) == len(docs) and len(kinds) > 1000
    for r in found:
        expected = math.fsum(each[w] for w in docs[r.doc_id]) + log_p[LM.END] / math.log(10)
        assert r.score == pytest.approx(expected, rel=1e-9)
