"""The methods' own arithmetic against enumeration and plain Python, native operators against their SQL, and their plans."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import check_oracle
from edupanel.llm import crf_quality as C, queries as Q, url_filter as U

SF = "/root/testdata/sf0.001"


# the line field


def scores(gain, moves):
    """Score of every labelling of a chain."""
    out = {}
    for labels in itertools.product((0, 1), repeat=len(gain)):
        own = sum(g for g, k in zip(gain, labels) if k)
        out[labels] = own + sum(moves[a][b] for a, b in zip(labels, labels[1:]))
    return out


def enumerated(gain, moves):
    """(marginals of label 1, expected moves, log of the sum over all labellings)."""
    all_ = scores(gain, moves)
    top = max(all_.values())
    total = sum(math.exp(s - top) for s in all_.values())
    marginals, expected = np.zeros(len(gain)), np.zeros((2, 2))
    for labels, s in all_.items():
        p = math.exp(s - top) / total
        marginals += p * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            expected[a, b] += p
    return marginals, expected, top + math.log(total)


def field(weights, moves):
    return C.LineCrf(np.zeros(len(weights)), np.ones(len(weights)), np.array(weights), np.array(moves))


@pytest.mark.parametrize("length", range(1, 11))
def test_marginals_of_short_chains(length):
    rng = np.random.default_rng(length)
    for spread in (0.1, 2.0, 30.0):
        moves = rng.normal(0, spread, (2, 2))
        x = rng.normal(0, spread, (length, 3))
        crf = field(rng.normal(0, 1, 3), moves)
        wanted, _, _ = enumerated((x @ crf.weights).tolist(), moves)
        assert crf.marginals(x) == pytest.approx(wanted, abs=1e-9)


def test_chains_of_all_lengths_at_once():
    rng = np.random.default_rng(7)
    for moves in (np.diag([0.7, 1.9]), rng.normal(0, 1, (2, 2)), np.zeros((2, 2))):
        gains = [rng.normal(0, 2, n) for n in (3, 1, 10, 7, 3, 2, 9, 1)]
        emissions = [np.stack([np.zeros(len(g)), g], axis=1) for g in gains]
        found, expected = C._chains(emissions, moves)
        wanted = [enumerated(g.tolist(), moves) for g in gains]
        for a, (b, _, _) in zip(found, wanted):
            assert a == pytest.approx(b, abs=1e-10)
        assert expected == pytest.approx(sum(w[1] for w in wanted), abs=1e-9)


def test_gradient_is_that_of_the_likelihood():
    """Differences of enumerated likelihoods, with the weighting of classes, lines and moves that the docstring states."""
    rng = np.random.default_rng(11)
    lengths, y = np.array([4, 1, 6, 3, 5]), np.array([1.0, 0.0, 0.0, 1.0, 0.0])
    flat = rng.normal(0, 1, (lengths.sum(), 3))
    params = np.concatenate([rng.normal(0, 1, 3), [0.4, 1.1]])
    chains = np.split(flat, np.cumsum(lengths)[:-1])

    def loss(p, of_weights):
        moves, total = np.diag(p[-2:]), 0.0
        for label in (0, 1):
            own = [i for i in range(len(y)) if y[i] == label]
            moved = sum(lengths[i] - 1 for i in own)
            for i in own:
                gain = (chains[i] @ p[:-2]).tolist()
                log_likelihood = scores(gain, moves)[(label,) * lengths[i]] - enumerated(gain, moves)[2]
                total -= log_likelihood * (0.5 / len(own) / lengths[i] if of_weights else 0.25 / moved)
        return total

    found = C.gradient_of(flat, lengths, y, params)
    for k in range(len(params)):
        step = np.zeros(len(params))
        step[k] = 1e-5
        slope = (loss(params + step, k < 3) - loss(params - step, k < 3)) / 2e-5
        assert found[k] == pytest.approx(slope, abs=1e-6)


def test_quality_weighs_lines_by_length():
    crf = C.fit([C.features("a good line of words.\nanother one.")[0], C.features("### $$ %%\n@@ !!")[0]], [1, 0], steps=30)
    text = "some words here.\n$$$\n\nmore words, and more."
    x, weight = C.features(text)
    gain = crf.emissions(x)[:, 1].tolist()
    wanted, _, _ = enumerated(gain, crf.moves)
    lines = text.split("\n")
    assert weight.tolist() == [max(1, len(line)) for line in lines]
    assert crf.quality(text) == pytest.approx(float(wanted @ weight / weight.sum()), abs=1e-9)


def test_drawn_lines_are_bounded_in_total(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(C, "fit", lambda chains, marked: fitted.append((chains, marked)))
    docs = spark.createDataFrame([(i, "line\n" * 9 + "line") for i in range(100)], "id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(100)], "id long, label int")
    C.train(docs, marks, sample_total=125)
    chains, marked = fitted[0]
    assert Counter(marked) == {0: 12, 1: 12} and sum(map(len, chains)) == 240
    C.train(docs, marks)
    assert Counter(fitted[1][1]) == {0: 50, 1: 50}


# the URL models


class Plain:
    """Witten-Bell probabilities from dictionaries, one character after the other."""

    def __init__(self, urls, order):
        self.order, self.after = order, defaultdict(Counter)
        for url in urls:
            text = b"\x02" * order + url + b"\x03"
            for i in range(order, len(text)):
                for n in range(order + 1):
                    self.after[n, text[i - n:i]][text[i]] += 1

    def log_prob(self, url):
        text, total = b"\x02" * self.order + url + b"\x03", 0.0
        for i in range(self.order, len(text)):
            p = 1 / 256
            for n in range(self.order + 1):
                seen = self.after.get((n, text[i - n:i]))
                if seen:
                    size, kinds = sum(seen.values()), len(seen)
                    p = (seen[text[i]] + kinds * p) / (size + kinds)
            total += math.log(p)
        return total


def urls(seed, words, n):
    rng = random.Random(seed)
    return [("http://" + rng.choice("abc") + ".net/" + "/".join(rng.choices(words, k=rng.randint(0, 3)))).encode() for _ in range(n)]


GOOD, BAD = urls(1, ["news", "page", "library"], 300), urls(2, ["win", "casino99", "xx"], 200)


@pytest.mark.parametrize("order", [0, 1, 3, 5])
def test_markov_probabilities(order):
    model, plain = U.MarkovModel.fit(GOOD, order), Plain(GOOD, order)
    for url in [*GOOD[:20], *BAD[:20], b"", b"\xff\x00", b"http://new", b"z" * 300]:
        grams, owner = U._grams([url], order)
        assert model.log_prob(grams).sum() == pytest.approx(plain.log_prob(url), rel=1e-12)
        assert len(owner) == len(url) + 1


def test_probabilities_of_all_next_characters_sum_to_one():
    model = U.MarkovModel.fit(GOOD, 3)
    total = 0.0
    for c in range(256):
        values = [np.array([sum(b << 8 * k for k, b in enumerate(reversed((b"a.n" + bytes([c]))[-(n + 1):])))], np.uint64) for n in range(4)]
        total += math.exp(model.log_prob(values)[0])
    assert total == pytest.approx(1.0, rel=1e-9)


def test_ratio_is_length_normalised_and_calibrated():
    model = U.fit_ratio(GOOD, BAD, 3)
    held = [a[::5] for a in (GOOD, BAD)]
    rest = [Plain([u for i, u in enumerate(a) if i % 5], 3) for a in (GOOD, BAD)]

    def ratio(url):
        return (rest[1].log_prob(url) - rest[0].log_prob(url)) / (len(url) + 1)

    some = [*GOOD[:10], *BAD[:10], b"", b"x"]
    assert model.ratio(some) == pytest.approx([ratio(u) for u in some], rel=1e-9)
    x, y = [ratio(u) for h in held for u in h], [0.0] * len(held[0]) + [1.0] * len(held[1])
    weight = [0.5 / len(held[int(k)]) for k in y]

    def loss(slope, offset):
        total = 5e-5 * (slope * slope + offset * offset)
        for a, k, w in zip(x, y, weight):
            z = slope * a + offset
            total += w * (math.log1p(math.exp(-abs(z))) + max(z, 0.0) - k * z)
        return total

    best = loss(model.slope, model.offset)
    for step in (1e-3, 1e-1, 1.0):
        assert all(loss(model.slope + a * step, model.offset + b * step) >= best - 1e-12 for a in (-1, 0, 1) for b in (-1, 0, 1))
    p = model.reject_probability(some)
    assert p == pytest.approx([1 / (1 + math.exp(-(model.slope * ratio(u) + model.offset))) for u in some], rel=1e-6)


def test_long_urls_are_judged_in_pieces(monkeypatch):
    model = U.fit_ratio(GOOD, BAD, 5)
    rng = random.Random(3)
    some = [bytes(rng.choices(b"abc/.casinonews9", k=n)) for n in (0, 1, 49, 50, 51, 99, 100, 101, 102, 1000, 7)]
    whole = model.ratio(some)
    monkeypatch.setattr(U, "BYTES_AT_ONCE", 50)
    assert model.ratio(some) == pytest.approx(whole, rel=1e-12)
    assert model.ratio([some[-2]] * 3) == pytest.approx([whole[-2]] * 3, rel=1e-12)


def test_very_long_url(spark):
    long = "http://a.net/" + "seg/" * 300_000
    pages = [(1, long), (2, long), (3, "http://x.org/"), (4, "http://example.org/es/"), (5, "http://y.org/a"), (6, "http://b.com/de/q")]
    found = U.filter_urls(spark.createDataFrame(pages, "page_id long, url string")).collect()
    by_id = {r.page_id: r for r in found}
    assert by_id[1].reject_probability == by_id[2].reject_probability and 0 <= by_id[1].reject_probability <= 1


# native operators


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_against_its_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.connect(SF), SF, name) == ""


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op3_mixing", "op10_line_dedup"])
def test_native_queries_have_no_python_and_no_cross_join(spark, name):
    from edupanel.llm import exact_dedup, line_dedup, mixing

    plans = []
    for module in (exact_dedup, line_dedup, mixing):
        if hasattr(module, "stage"):
            keep = module.stage

            def seen(df, label, keep=keep):
                plans.append(df._jdf.queryExecution().executedPlan().toString())
                return keep(df, label)

            module.stage, module._stage = seen, keep
    try:
        frame = Q.QUERIES[name](spark, SF)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
    finally:
        for module in (exact_dedup, line_dedup, mixing):
            if hasattr(module, "_stage"):
                module.stage = module._stage
                del module._stage
    for plan in plans:
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


# repeated rows and clashing columns


def test_values_of_repeated_rows(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["one two three", "four five", "one two three", None, "### @@"])]
    labels = spark.createDataFrame([(0, 1), (4, 0), (1, 1)], "doc_id long, quality int")
    for copies in (1, 2):
        path = str(tmp_path / f"d{copies}")
        spark.createDataFrame(rows * copies, "doc_id long, text string").write.parquet(path)
    once, twice = (spark.read.parquet(str(tmp_path / f"d{n}")) for n in (1, 2))
    for judge in (lambda df: C.score(df, labels), lambda df: U.filter_urls(df.withColumnsRenamed({"doc_id": "page_id", "text": "url"}))):
        one, two = (Counter(map(tuple, judge(df).collect())) for df in (once, twice))
        assert two == Counter({k: 2 * n for k, n in one.items()})


def test_pipeline_stages_with_clashing_columns(spark, tmp_path):
    import corpus_pipeline as P

    names = ["row", "doc", "digest", "node", "component_id", "kept", "first", "n", "h1", "text_sha256"]
    path = str(tmp_path / "d")
    rows = [(i, " ".join(f"w{i // 3}x{j}" for j in range(30))) for i in range(12)]
    base = spark.createDataFrame(rows, "doc_id long, text string")
    base.selectExpr("*", *[f"'{n}' as {n}" for n in names]).write.parquet(path)
    docs = spark.read.parquet(path)
    for name in ("exact", "near"):
        kept = dict(P.STAGES)[name](spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 6, 9]
        assert all(r[n] == n for r in kept.collect() for n in names)


# a third of the rows on one key


def taken_in_order(rows):
    """Words taken of each document, when all sources stand in the order of MD5, id and size."""
    import hashlib

    size = [(s, hashlib.md5(str(i).encode()).hexdigest(), i, len((t or "").split())) for i, t, s in rows]
    total = Counter()
    for s, _, _, n in size:
        total[s] += n
    (source,) = total  # one source: its target is all of its words
    return Counter((i, n, n) for _, _, i, n in size if source)


def test_mixing_where_one_id_has_a_third_of_the_rows(spark):
    from edupanel.llm import mixing

    rng = random.Random(1)
    rows = [(7 if i % 3 == 0 else i, " ".join(["w"] * rng.randint(0, 5)), f"s{i % 4 if i % 3 else 0}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = mixing.mix(frame).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len(t.split())) for i, t, _ in rows)
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source_size, r.target].append(r)
    for (size, target), group in by_source.items():
        assert sum(r.taken for r in group) == math.floor(target) and all(r.taken <= 3 * r.size for r in group)
        # starts are gapless: the positions of the first words are those of consecutive words
        assert len({r.position for r in group if r.taken}) == sum(r.taken > 0 for r in group)
    one = [(i, t, "s") for i, t, _ in rows]
    found = mixing.mix(spark.createDataFrame(one, "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in found) == taken_in_order(one)
    ordered = sorted((r.position, r.size) for r in found if r.taken)
    first, words = 0.5, sum(r.size for r in found)
    start = 0
    for position, n in ordered:
        share = start / words
        assert position == pytest.approx(2 * share / (first + math.sqrt(first * first + 2 * share)), abs=1e-9)
        start += n


def test_lines_where_one_has_a_third_of_the_rows(spark):
    from edupanel.llm import line_dedup

    rows = [(i, "hot\n" + f"own {i}" + ("\nnine" if i % 3 == 0 else "") + ("\nfew" if i < 5 else ""), f"s{i % 12 if i % 3 else i % 9}")
            for i in range(900)]
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in text.split("\n"):
            sites[line].add(site)
    assert len(sites["hot"]) >= 10 > len(sites["nine"])
    found = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for i, text, _ in rows:
        kept = [line for line in text.split("\n") if len(sites[line]) < 10]
        assert found[i].text == "\n".join(kept) and found[i].n_removed == len(text.split("\n")) - len(kept)


def packed_ids(tokenizer, texts):
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [np.array(f.ids, dtype="<u4").tobytes() for f in found]


def test_packing_tokenises_letters_once_for_all_marks_and_cases():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from edupanel.llm import packing

    path = Q.tokenizer_file("word_bpe_49k.json")
    draw = random.Random(3)
    stems = {"".join(draw.choices("abcdeéñö", k=draw.randint(4, 12))) for _ in range(300)}
    forms = [f"{word}{marks}" for stem in stems for word in (stem, stem.title(), stem[0].upper() + stem[1:])
             for marks in ("", ",", ".", "###", "&&&", "!?")]
    tokens = packing.WordTokens(path)
    assert list(tokens(pa.array(forms))) == packed_ids(Tokenizer.from_file(path), forms)
    assert len(tokens.known) <= len(stems) + 6


def test_packing_tokens_of_odd_words(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from edupanel.llm import packing

    path = Q.tokenizer_file("word_bpe_49k.json")
    draw = random.Random(4)
    bits = [*"abAZéÉßÿÀ×÷ºªµİıΣσς'<|>!?.,;:-#$%&*()[]{}~`^_=+@/\\\"019", "\n", "\t", " ", "  ",
            "\u00a0", "\u2003", "e\u0301", "=\u0338", "\u0301", "<|startoftext|>", "<|STARTOFTEXT|>", "<|endoftext|>",
            "'s", "'LL", "</w>", "\ufb01", "日本", "\U0001f389", "\0", "\r\n", "\v"]
    texts = ["", " "] + ["".join(draw.choices(bits, k=draw.randint(0, 25))) for _ in range(5000)]
    expected = packed_ids(Tokenizer.from_file(path), texts)
    tokens = packing.WordTokens(path)
    assert list(tokens(pa.array(texts))) == expected
    assert list(tokens(pa.array([], pa.string()))) == []
    monkeypatch.setattr(packing, "CACHED_WORDS", 300)
    tokens = packing.WordTokens(path)
    assert [ids for i in range(0, len(texts), 50) for ids in tokens(pa.array(texts[i:i + 50]))] == expected


def test_packing_with_other_vocabularies(tmp_path):
    """With cases apart, with marks that stay with their letters, with an added token of letters, without a normaliser."""
    import pyarrow as pa
    from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

    from edupanel.llm import packing

    vocabulary = {c: i for i, c in enumerate([*"abAB!?é", "ab", "AB", "b!", "ab!"])}
    merges = [("a", "b"), ("A", "B"), ("b", "!"), ("ab", "!")]
    parted = pre_tokenizers.Split(Regex(r"[\p{L}]+|[^\s\p{L}]+"), "removed", invert=True)
    texts = ["ab! AB!", "aB?ab", "ab", "!ab é! ?", "aab!!AB abab Ab"]
    for i, (splitter, normalizer, added) in enumerate(itertools.product(
            (parted, pre_tokenizers.WhitespaceSplit()), (None, normalizers.Lowercase()), ([], ["ab"]))):
        tokenizer = Tokenizer(models.BPE(vocabulary, merges))
        tokenizer.add_tokens(added)
        tokenizer.pre_tokenizer = splitter
        if normalizer:
            tokenizer.normalizer = normalizer
        tokenizer.save(str(tmp_path / f"{i}.json"))
        assert list(packing.WordTokens(str(tmp_path / f"{i}.json"))(pa.array(texts))) == packed_ids(tokenizer, texts)


def test_packing_where_one_row_comes_a_third_of_the_time(spark):
    from edupanel.llm import packing

    rows = [(5, "same words")] * 600 + [(i, "word " * (i % 50)) for i in range(1200)]
    placed = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), Q.tokenizer_file("word_bpe_49k.json"))
    assert set(placed.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    found = placed.collect()
    assert len(found) == 1800 and sum(r.doc_id == 5 for r in found) == 601
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
