"""Language-model scores: a subword lattice whose unigram pieces weigh all segmentations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edupanel.session import stage

from .common import fold_of, words_of

HEAD_WORDS = 131_072
ROUNDS = 1
BATCH_WORDS = 400_000
_MARK = "▁"


class Lattice:
    """log probability of words, many at a time: the sum over all segmentations into pieces.

    A word is the mark and its characters. A character that no piece spells is spelt by its
    bytes. ``log_p`` maps pieces to natural logarithms. The pieces form a trie in sorted arrays;
    words lie one after the other, and every place of every word walks the trie at once.
    """

    def __init__(self, log_p: dict[str, float]) -> None:
        self.pieces, self.weights = list(log_p), np.array(list(log_p.values()))
        self.bytes = np.array([self.pieces.index(f"<0x{b:02X}>") for b in range(256)])
        apart = {self.pieces[i] for i in self.bytes} | {END}
        states, steps, ends = {"": 0}, [], [-1]
        for number, piece in enumerate(self.pieces):
            if piece in apart:
                continue
            for size in range(1, len(piece) + 1):
                if piece[:size] not in states:
                    steps.append((states[piece[:size - 1]] << 21 | ord(piece[size - 1]), len(states)))
                    states[piece[:size]] = len(states)
                    ends.append(-1)
            ends[states[piece]] = number
        steps.sort()
        self.steps = np.array([key for key, _ in steps] + [np.iinfo(np.int64).max])
        self.states = np.array([state for _, state in steps] + [0])
        self.ends = np.array(ends)

    def segment(self, words: list[bytes]) -> Segments:
        """All pieces at all places of the words."""
        # no word holds a space, so the space after a word is the place of its end
        text = "".join(_MARK + w.decode("utf-8", "replace") + " " for w in words)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        stops = np.flatnonzero(chars == 32)
        starts, ends, pieces = [], [], []
        inner = at = np.flatnonzero(chars != 32)
        state, size, single = np.zeros(len(at), np.int64), 0, np.zeros(len(chars), bool)
        while len(at):
            key = state << 21 | chars[at + size]
            place = np.searchsorted(self.steps, key)
            hit = self.steps[place] == key
            at, state, size = at[hit], self.states[place[hit]], size + 1
            whole = self.ends[state] >= 0
            starts.append(at[whole])
            ends.append(at[whole] + size)
            pieces.append(self.ends[state[whole]])
            if size == 1:
                single[at[whole]] = True
        spelt = inner[~single[inner]]
        kinds, which = np.unique(chars[spelt], return_inverse=True)
        spellings = [self.bytes[list(chr(c).encode("utf-8"))] for c in kinds.tolist()]
        costs = np.array([self.weights[s].sum() for s in spellings])
        starts.append(spelt)
        ends.append(spelt + 1)
        weights = np.concatenate([self.weights[np.concatenate(pieces)], costs[which]]) if spellings else (
            self.weights[np.concatenate(pieces)])
        return Segments(np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces), weights, stops, spellings, which)

    def score(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of every word."""
        found = self.segment(words)
        return found.forward()[found.stops] / math.log(10)

    def expect(self, words: list[bytes], counts: np.ndarray, into: np.ndarray) -> None:
        """Add the expected number of each piece in so many of each word."""
        found = self.segment(words)
        alpha, beta = found.forward(), found.backward()
        word = np.searchsorted(found.stops, found.starts)
        total = alpha[found.stops[word]]
        parts = counts[word] * np.exp(alpha[found.starts] + found.weights + beta[found.ends] - total)
        n = len(found.pieces)
        into += np.bincount(found.pieces, parts[:n], minlength=len(into))
        for spelling, times in zip(found.spellings, np.bincount(found.which, parts[n:])):
            np.add.at(into, spelling, times)


@dataclass
class Segments:
    """Pieces at places of words: first the vocabulary's, then characters spelt by bytes."""

    starts: np.ndarray
    ends: np.ndarray
    pieces: np.ndarray
    weights: np.ndarray
    stops: np.ndarray
    spellings: list[np.ndarray]
    which: np.ndarray

    def forward(self) -> np.ndarray:
        """Log probability of the beginning before every place."""
        firsts = np.concatenate([[0], self.stops[:-1] + 1])
        return self._sum(self.starts, self.ends, self.ends - firsts[np.searchsorted(self.stops, self.ends)])

    def backward(self) -> np.ndarray:
        """Log probability of the rest from every place."""
        return self._sum(self.ends, self.starts, self.stops[np.searchsorted(self.stops, self.starts)] - self.starts)

    def _sum(self, source: np.ndarray, target: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Log sums over the pieces that reach each place; places equally far in their words go together."""
        out = np.zeros(int(self.stops[-1]) + 1)
        order = np.argsort(level * len(out) + target)
        source, target, level, weights = source[order], target[order], level[order], self.weights[order]
        heads = np.flatnonzero(np.diff(target, prepend=-1))
        cuts = np.flatnonzero(np.diff(level, prepend=0))
        head_cuts = np.append(np.searchsorted(heads, cuts), len(heads))
        cuts = np.append(cuts, len(target))
        for a, b, i, j in zip(cuts[:-1], cuts[1:], head_cuts[:-1], head_cuts[1:]):
            here = heads[i:j] - a
            terms = out[source[a:b]] + weights[a:b]
            top = np.maximum.reduceat(terms, here)
            terms = np.exp(terms - np.repeat(top, np.diff(here, append=b - a)))
            out[target[heads[i:j]]] = top + np.log(np.add.reduceat(terms, here))
        return out


END = "</s>"


def vocabulary(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece vocabulary with log weights from its scores.

    A merge vocabulary's score is minus the rank of the piece; by Zipf's law its frequency goes with
    one over its rank. Pieces with an inner mark or of marks only can't occur in a word.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weights: dict[str, float] = {}
    last = model.get_piece_size()
    for i in range(last):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or _MARK in piece[1:]:
            continue
        weights[piece] = 1 / (2 + (last if model.is_byte(i) else min(last, abs(model.get_score(i)))))
    weights[END] = 1 / 10
    total = math.log(sum(weights.values()))
    return {k: math.log(w) - total for k, w in weights.items()}


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) of all words of ``text``; words of rows that are ``held_out`` count 0.

    Each task adds up the words of several batches before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                found.update(dict.fromkeys(words, 0) if held else words)
                if len(found) > BATCH_WORDS:
                    yield _rows(found)
                    found = Counter()
        yield _rows(found)

    def _rows(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "count"])

    read = docs.select(F.col("text").cast("binary"), "held_out").mapInArrow(count, "word binary, count long")
    return read.groupBy("word").agg(F.sum("count").alias("count"))


def refine(log_p: dict[str, float], counts: DataFrame, ends: int) -> dict[str, float]:
    """New piece weights from the expected number of each piece in all counted words, plus a half each."""
    sent = counts.sparkSession.sparkContext.broadcast(Lattice(log_p))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = sent.value
        found = np.zeros(len(lattice.pieces))
        for batch in batches:
            if batch.num_rows:
                lattice.expect(batch.column(0).to_pylist(), batch.column(1).to_numpy(), found)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([lattice.pieces[i] for i in some], pa.string()), pa.array(found[some])], ["piece", "n"])

    sums = counts.where("count > 0").select("word", "count").mapInArrow(
        expect, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    seen = {r.piece: r.n for r in sums.collect()}  # at most one row per piece of the vocabulary
    seen[END] = ends
    total = math.log(sum(seen.values()) + len(log_p) / 2)
    return {piece: math.log(seen.get(piece, 0.0) + 0.5) - total for piece in log_p}


def word_scores(log_p: dict[str, float], counts: DataFrame) -> DataFrame:
    """(word, count, score) with the log10 probability of every word."""
    sent = counts.sparkSession.sparkContext.broadcast(Lattice(log_p))

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = sent.value.score(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], ["word", "count", "score"])

    return counts.select("word", "count").mapInArrow(score_words, "word binary, count long, score double")


def score(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
    folds: int = 5, held_out: int = 1, rounds: int = ROUNDS, head_words: int = HEAD_WORDS,
) -> DataFrame:
    """Score every whole text, learning from the documents whose fold isn't ``held_out``.

    The vocabulary is given; its scores are the first weights, and each of ``rounds`` rounds replaces
    them by what a forward-backward pass over all training words expects. The probability of a text is
    that of its words and one end; that of a word is the sum over its segmentations. Pieces start
    with a mark where a word starts, so the lattice of a text falls apart into those of its words.

    Every distinct word of the corpus is scored once. The counts and scores of the ``head_words`` most
    frequent words are sent to all tasks, a fixed number; other words meet theirs in a join.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10), one row
    per input row. Null text is empty: one end token. A null id counts as the fold of the empty text.
    Without training rows all counts are 0 and the pieces keep the weights of the vocabulary's
    scores. Repeated rows are scored each and, outside the held-out fold, count each. An empty table
    gives an empty result. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        (fold_of(id_col, folds) == held_out).alias("held_out"))
    ends = rows.where(~F.col("held_out")).count()
    counts = stage(word_counts(rows), "words")
    known = counts.where("count > 0").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, kinds = int(known.n) + ends, int(known.v) + (ends > 0)
    log_p = vocabulary(vocabulary_path)
    for _ in range(rounds if total else 0):
        log_p = refine(log_p, counts, ends)
    scored_words = stage(word_scores(log_p, counts), "word-scores")
    below = total + 0.5 * (kinds + 1)
    most = scored_words.orderBy(F.desc("count"), "word").limit(head_words)
    head = {bytes(r.word): (r["count"] > 0, math.log10((r["count"] + 0.5) / below), r.score) for r in most.collect()}
    sent = docs.sparkSession.sparkContext.broadcast(head)
    end, last = math.log10((ends + 0.5) / below), log_p[END] / math.log(10)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            columns = [batch.column(i).to_pylist() for i in (0, 2)]
            for doc_id, text, held in zip(columns[0], batch.column(1), columns[1]):
                words, base, model, n_known = Counter(words_of(text.as_py())), [end], [last], int(ends > 0)
                tail: list[bytes] = []
                times: list[int] = []
                for word, n in words.items():
                    if (found := head.get(word)) is None:
                        tail.append(word)
                        times.append(n)
                    else:
                        n_known += n * found[0]
                        base.append(n * found[1])
                        model.append(n * found[2])
                row = (doc_id, held, sum(words.values()) + 1, n_known, math.fsum(base), math.fsum(model), tail, times)
                for column, value in zip(out, row):
                    column.append(value)
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.binary()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    names = ["doc_id", "held_out", "n_tokens", "known", "base", "model", "tail", "times"]
    read_rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"), "held_out").mapInArrow(
        read, "doc_id long, held_out boolean, n_tokens long, known long, base double, model double,"
        " tail array<binary>, times array<long>")
    scored = stage(read_rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "row", F.col("t.tail").alias("word"), F.col("t.times").alias("n"))
    hits = tail.join(scored_words, "word").groupBy("row").agg(
        F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * F.log10((F.col("count") + 0.5) / below)).alias("tail_base"),
        F.sum(F.col("n") * F.col("score")).alias("tail_model"))
    return scored.drop("tail", "times").join(hits, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("tail_model", F.lit(0.0))).alias("score"))
