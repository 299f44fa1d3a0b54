"""Ranked lexical search: branch and bound over tries of frequency-ordered term vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from edupanel.session import stage

TOP = 10
TERMS_AT_ONCE = 200_000
SHARD_POSTINGS = 1_000_000
LEAF = 32

_NO_TERM = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_NO_TERM, b" " * len(_NO_TERM))
_FOLD = bytes(_FOLD[b] + 32 if 65 <= b <= 90 else _FOLD[b] for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all non-ASCII characters of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


def impact(tf, m):
    """What a term adds before it is weighed; grows with tf and falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


@dataclass
class Tree:
    """A path-compressed trie of documents' term vectors.

    Documents stand in the order of their vectors, so a node is a range of documents that share a path. Nodes of
    up to LEAF documents are leaves; small neighbours below one node share a leaf. ``node_term`` lists, term by
    term, the nodes below which the term occurs and its largest tf there.
    """

    ids: np.ndarray
    null: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[range]
    least_m: np.ndarray
    least_id: np.ndarray
    term_starts: np.ndarray
    term_nodes: np.ndarray
    term_most: np.ndarray

    @classmethod
    def build(cls, ids: list[int | None], ms: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int,
              leaf: int = LEAF) -> Tree:
        """``vectors`` holds, for each document, its term numbers (most frequent term first, ascending) and their tf."""
        order = sorted(range(len(ids)), key=lambda i: vectors[i][0].astype(">u4").tobytes())
        held = [vectors[i][0] for i in order]
        starts = np.concatenate([[0], np.cumsum([len(v) for v in held])]).astype(np.int64)
        terms = np.concatenate(held).astype(np.int64)
        times = np.concatenate([vectors[i][1] for i in order]).astype(np.int64)
        m = np.array([ms[i] for i in order], dtype=np.int64)
        null = np.array([ids[i] is None for i in order])
        doc_ids = np.array([0 if ids[i] is None else ids[i] for i in order], dtype=np.int64)
        low, high, children, levels = _split(_shared_path(held), leaf)

        parent = np.full(len(low), -1)
        for node, below in enumerate(children):
            parent[below.start:below.stop] = node
        leaves = np.array([not below for below in children])
        leaf_of = np.zeros(len(held), dtype=np.int64)
        for node in np.flatnonzero(leaves).tolist():
            leaf_of[low[node]:high[node]] = node
        # tf maxima of the leaves, then level by level of the nodes above
        entries: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(levels.max() + 1)]
        keys, most = _maxima(np.repeat(leaf_of, np.diff(starts)) * n_terms + terms, times)
        at = levels[keys // n_terms]
        for level in range(len(entries)):
            entries[level].append((keys[at == level], most[at == level]))
        done = []
        for level in reversed(range(len(entries))):
            keys, most = _maxima(*(np.concatenate(part) for part in zip(*entries[level])))
            done.append((keys, most))
            if level:
                entries[level - 1].append((parent[keys // n_terms] * n_terms + keys % n_terms, most))
        keys, most = (np.concatenate(part) for part in zip(*done))
        by_term = np.lexsort((keys // n_terms, keys % n_terms))
        keys, most = keys[by_term], most[by_term]
        counts = np.bincount(keys % n_terms, minlength=n_terms)
        # a null id comes after all others
        order_ids = np.where(null, np.iinfo(np.int64).max, doc_ids)
        return cls(
            doc_ids, null, starts, terms, impact(times, np.repeat(m, np.diff(starts))), low, high, children,
            np.array([m[a:b].min() for a, b in zip(low, high)]),
            np.array([order_ids[a:b].min() for a, b in zip(low, high)]),
            np.concatenate([[0], np.cumsum(counts)]), keys // n_terms, most)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per node, what no document below it can exceed."""
        total = np.zeros(len(self.low), dtype=np.int64)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            part = slice(self.term_starts[term], self.term_starts[term + 1])
            nodes = self.term_nodes[part]
            total[nodes] += weight * impact(self.term_most[part], self.least_m[nodes])
        return total

    def best(self, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, found: Best, k: int) -> Best:
        """The ``k`` best of ``found`` and of this tree, which is walked depth first, promising children first.

        ``weight_of`` is an array of zeros as long as the vocabulary, and is left so.
        """
        bounds = self.bounds(terms, weights)
        weight_of[terms] = weights
        stack = [0]
        while stack:
            node = stack.pop()
            if not found.beaten_by(bounds[node], self.least_id[node], k):
                continue
            below = self.children[node]
            if below:
                order = np.argsort(bounds[below.start:below.stop], kind="stable")
                stack.extend((order + below.start).tolist())
                continue
            low, high = self.low[node], self.high[node]
            first, last = self.starts[low], self.starts[high]
            gains = weight_of[self.terms[first:last]] * self.impacts[first:last]
            scores = np.add.reduceat(gains, self.starts[low:high] - first)
            found = found.merged(scores, self.ids[low:high], self.null[low:high], k)
        weight_of[terms] = 0
        return found


@dataclass
class Best:
    """The best documents so far: highest score, then smallest id, null ids last."""

    scores: np.ndarray
    ids: np.ndarray
    null: np.ndarray

    @classmethod
    def none(cls) -> Best:
        return cls(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))

    def beaten_by(self, score: int, least_id: int, k: int) -> bool:
        """Whether a document of that score, and of that id or a larger one, could be among the best."""
        if score <= 0 or len(self.scores) < k:
            return score > 0
        return score > self.scores[-1] or score == self.scores[-1] and (self.null[-1] or least_id < self.ids[-1])

    def merged(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> Best:
        able = scores >= (self.scores[-1] if len(self.scores) >= k else 1)
        if not able.any():
            return self
        scores, ids, null = (np.concatenate([a, b[able]]) for a, b in (
            (self.scores, scores), (self.ids, ids), (self.null, null)))
        keep = np.lexsort((ids, null, -scores))[:k]
        return Best(scores[keep], ids[keep], null[keep])


def _shared_path(vectors: list[np.ndarray]) -> np.ndarray:
    """Per document the number of first terms that it shares with the one before."""
    shared = np.zeros(len(vectors), dtype=np.int64)
    for i in range(1, len(vectors)):
        a, b = vectors[i - 1], vectors[i]
        size = min(len(a), len(b))
        differ = a[:size] != b[:size]
        shared[i] = differ.argmax() if differ.any() else size
    return shared


def _split(shared: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, list[range], np.ndarray]:
    """(low, high, children, level) of all nodes; node 0 is the root."""
    low, high, level, children = [0], [len(shared)], [0], [range(0)]
    node = 0
    while node < len(low):
        a, b = low[node], high[node]
        if b - a > leaf:
            inside = shared[a + 1:b]
            cuts = [a, *(np.flatnonzero(inside == inside.min()) + a + 1).tolist(), b]
            first, begin = len(low), a
            for start, end in zip(cuts[:-1], cuts[1:]):
                # small neighbours stand together
                if end - begin > leaf and start > begin:
                    low.append(begin), high.append(start)
                    begin = start
                if end - start > leaf or end == b:
                    low.append(begin), high.append(end)
                    begin = end
            children[node] = range(first, len(low))
            level.extend([level[node] + 1] * (len(low) - first))
            children.extend([range(0)] * (len(low) - first))
        node += 1
    return np.array(low), np.array(high), children, np.array(level)


def _maxima(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their largest value."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[new], np.maximum.reduceat(values, new) if len(new) else values


VECTORS = "doc_id long, n long, terms binary, times binary"


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times) of the documents with a term: how many terms they have, and those of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                if words:
                    held = np.array([i for i in map(known.get, words) if i is not None], dtype=np.int32)
                    terms, times = np.unique(held, return_counts=True)
                    for column, value in zip(out, (doc_id, len(words), terms.tobytes(), times.astype(np.int32).tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                ["doc_id", "n", "terms", "times"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(vectors, VECTORS)


def _document_counts(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            held = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(held, np.int32), minlength=n_terms)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(total[terms])], ["term", "df"])

    counted = vectors.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(n_terms, dtype=np.int64)
    for row in counted.collect():  # one row a term of the vocabulary at most
        df[row.term] = row.df
    return df


def rank(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", k: int = TOP, terms_at_once: int = TERMS_AT_ONCE, shard_postings: int = SHARD_POSTINGS,
    leaf: int = LEAF,
) -> DataFrame:
    """The ``k`` documents with the highest score for every item: item_id, rank, doc_id, score.

    1. Every document's whole text is cut into terms once per block of items; what the items ask for stays as a vector of
       term numbers and tf. N, L and the df of the block's terms are sums over all documents.
    2. Terms are renumbered by descending df. Tasks put the vectors of about ``shard_postings`` postings at a time in
       a trie, where documents that share their most frequent terms share a path. Every node knows the largest
       tf of each term below it and the smallest m, and so bounds the score of any document below.
    3. For every item the trie is walked depth first, the child with the highest bound first; what can't get
       among the best is left out, the ``k`` best so far go on to the task's next trie.
    4. The best of every task meet per item.

    Items go in blocks of about ``terms_at_once`` terms, which bounds what is broadcast and gathered on the driver; each
    block's result is stored before the next begins. All arithmetic but the weight's logarithm is on integers, so the
    result does not depend on how documents are dealt out.

    Null, empty and termless texts are found by nothing and ask nothing, and count neither for N nor for L. Rows that
    repeat a document are ranked each; rows that repeat an item are asked each, so ranks come twice under that
    item_id. Null document ids come last in ties, null item ids are kept. Empty tables give an empty result.
    Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    asked = stage(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    # no item has more terms than half its bytes and one
    size = int(asked.agg(F.coalesce(F.sum(F.length("text") / 2 + 1), F.lit(0))).first()[0])
    blocks = max(1, math.ceil(size / terms_at_once))
    found = []
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        held = [(r.item, r.item_id, terms_of(bytes(r.text) if r.text else None)) for r in part.collect()]
        result = _rank_block(rows, held, k, shard_postings, leaf)
        if blocks > 1:
            result = stage(result, "ranked")
        found.append(result)
    ranked = found[0]
    for part in found[1:]:
        ranked = ranked.union(part)
    return ranked


def _rank_block(docs: DataFrame, items: list, k: int, shard_postings: int, leaf: int) -> DataFrame:
    vocabulary = {term: i for i, term in enumerate(sorted({t for _, _, terms in items for t in terms}))}
    vectors = stage(term_vectors(docs, vocabulary), "vectors")
    n_terms = max(1, len(vocabulary))
    df = _document_counts(vectors, n_terms)
    total = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    n_docs, length = int(total.n), int(total.length)
    by_df = np.lexsort((np.arange(n_terms), -df))
    place = np.empty(n_terms, dtype=np.int64)
    place[by_df] = np.arange(n_terms)
    asked = []
    for item, item_id, terms in items:
        numbers, times = np.unique([vocabulary[t] for t in terms] or np.empty(0, np.int64), return_counts=True)
        numbers, times = numbers[df[numbers] > 0], times[df[numbers] > 0]
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df[numbers]]
        asked.append((item, item_id, place[numbers], times * np.array(weights, dtype=np.int64)))
    sent = docs.sparkSession.sparkContext.broadcast((place, asked))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, asked = sent.value
        best = [Best.none() for _ in asked]
        weight_of = np.zeros(n_terms, dtype=np.int64)
        ids, ms, held, postings = [], [], [], 0

        def ask() -> None:
            tree = Tree.build(ids, ms, held, n_terms, leaf)
            for i, (_, _, terms, weights) in enumerate(asked):
                best[i] = tree.best(terms, weights, weight_of, best[i], k)

        for batch in batches:
            for doc_id, n, terms, times in zip(*(column.to_pylist() for column in batch.columns)):
                numbers = place[np.frombuffer(terms, np.int32)]
                order = np.argsort(numbers)
                ids.append(doc_id)
                ms.append(25 + 75 * n * n_docs // length)
                held.append((numbers[order], np.frombuffer(times, np.int32)[order]))
                postings += len(numbers)
                if postings >= shard_postings:
                    ask()
                    ids, ms, held, postings = [], [], [], 0
        if ids:
            ask()
        for (item, item_id, _, _), top in zip(asked, best):
            n = len(top.scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * n, pa.int64()), pa.array([item_id] * n, pa.int64()),
                 pa.array(top.ids, mask=top.null), pa.array(top.scores)], ["item", "item_id", "doc_id", "score"])

    # a vector without terms of the items scores nothing
    hits = vectors.where(F.length("terms") > 0).mapInArrow(search, "item long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
