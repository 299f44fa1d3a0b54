"""The first stages of the corpus pipeline against plain Python, each on what its predecessor kept."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline as P
from edupanel.llm import crf_quality as C, queries as Q

from test_bruteforce import SF, components, crc5, rows_of, shingle_set


def test_stages_keep_one_of_each_group(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in P.STAGES[:3]:
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for i, text in sorted(kept["quality"].items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), i)
    assert set(kept["exact"]) == set(first.values())
    roots = components({i: shingle_set(t) for i, t in kept["exact"].items()})
    assert set(kept["near"]) == set(roots.values())
    assert len(kept["near"]) < len(kept["exact"]) < len(kept["quality"])


@pytest.mark.parametrize("name", ["exact", "near", "mixing"])
def test_rows_keep_their_numbers_when_files_are_cut_anew(spark, tmp_path, name):
    """Files are packed into other tasks once the stage's first actions have run, as when executors are lost."""
    texts = [" ".join(f"w{i // 2}x{j}" for j in range(20 + i // 2)) for i in range(120)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(40, "doc_id").write.parquet(path)
    stage = dict(P.STAGES)[name]
    setting = "spark.sql.files.maxPartitionBytes"
    whole = spark.conf.get(setting)
    try:
        expected = Counter(map(tuple, stage(spark, spark.read.parquet(path), "").collect()))
        later = stage(spark, spark.read.parquet(path), "")
        spark.conf.set(setting, "1k")
        found = Counter(map(tuple, later.collect()))
    finally:
        spark.conf.set(setting, whole)
    assert found == expected
    if name == "mixing":
        assert {r[0] for r in found} <= set(range(120)) and len(found) > 60
    else:
        assert sorted(found.elements()) == rows[::2]


def good(docs):
    """Ids whose text the line field, fitted on all marked texts here, does not reject."""
    marks = sorted((quality, i) for i, quality in rows_of(SF, "labels", "doc_id, quality") if crc5(i) != 0 and i in docs)
    marks = [(label, i) for label, i in marks if label in (0, 1) and docs[i].count("\n") < C.SAMPLE_LINES]
    assert 0 < len(marks) <= C.SAMPLE_DOCS
    model = C.fit([C.features(docs[i])[0].astype("<f4").astype(float) for _, i in marks], [label for label, _ in marks])
    return {i for i, text in docs.items() if model.quality(text) >= C.THRESHOLD}


def mixed(docs, sources):
    """(position, md5, id) of every time a document is begun."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in docs.items()}
    total = Counter()
    for i in docs:
        total[sources[i]] += size[i]
    names = sorted(total)
    weight = {s: (5.0, 2.0, 1.0)[r % 3] for r, s in enumerate(names)}
    left, open_, level = float(sum(total.values())), sum(weight.values()), 0.0
    for s in sorted(names, key=lambda s: 3.0 * total[s] / weight[s]):
        level = max(level, left / open_)
        left, open_ = left - 3.0 * total[s], open_ - weight[s]
    found = []
    for rank, s in enumerate(names):
        target = min(3.0 * total[s], level * weight[s])
        first = (0.5, 1.0, 1.5)[rank % 3]
        slope = 2 * (1 - first)
        own = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i in docs if sources[i] == s)
        start = 0
        while start < math.floor(target):
            for key, i in own:
                if size[i] and start < math.floor(target):
                    share = start / target
                    position = 2 * share / (first + math.sqrt(first * first + 2 * slope * share))
                    found.append((position, key, i))
                start += size[i]
    return sorted(found)


def test_run_against_plain_python(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(P, "new_path", lambda _, name: str(tmp_path / name))
    rows = P.run(spark, SF).collect()
    tables = {name: [i for f in sorted((tmp_path / f"pipeline-{name}").glob("*.parquet"))
                     for i, in duckdb.connect().execute("SELECT doc_id FROM read_parquet(?)", [str(f)]).fetchall()]
              for name, _ in P.STAGES[:4]}
    source = {i: (t or "", s) for i, t, s in rows_of(SF, "documents", "doc_id, text, source")}
    texts, sources = {i: t for i, (t, _) in source.items()}, {i: s for i, (_, s) in source.items()}
    expected = good(texts)
    assert sorted(tables["quality"]) == sorted(expected) and len(expected) < len(texts)
    first = {}
    for i in sorted(expected):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    assert sorted(tables["exact"]) == sorted(first.values())
    roots = set(components({i: shingle_set(texts[i]) for i in first.values()}).values())
    assert sorted(tables["near"]) == sorted(roots)
    mix = mixed({i: texts[i] for i in roots}, sources)
    begun = Counter(i for _, _, i in mix)
    assert Counter(tables["mixing"]) == begun and max(begun.values()) > 1
    # the n-th time an id comes is its n-th pass; rounding may swap equal positions
    due, seen = defaultdict(list), Counter()
    for position, _, i in mix:
        due[i].append(position)
    order = []
    for i in tables["mixing"]:
        order.append(due[i][seen[i]])
        seen[i] += 1
    assert np.all(np.diff(order) >= -1e-9)
    tokenizer, pieces = Tokenizer.from_file(Q.tokenizer_file("word_bpe_49k.json")), Counter()
    for i, times in begun.items():
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            pieces[i, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += times
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= math.ceil(sum(k[3] * n for k, n in pieces.items()) / 2048) * 1.01 + 1
