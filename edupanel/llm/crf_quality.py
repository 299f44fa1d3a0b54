"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import fold_of, text_of, tidied

SAMPLE_DOCS = 1_000
SAMPLE_LINES = 400
SAMPLE_TOTAL = 50_000
STEPS = 120
THRESHOLD = 0.3

_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_DIGIT = re.compile(r"\d")
_ENDS = (".", "!", "?", '"', "'", ")", ":", ";")
N_OWN = 16


def line_features(line: str, words: list[str], times: int) -> list[float]:
    """Of one line: shape, symbols, repetition, how its words end, how often the document has it."""
    n = len(words)
    if not n:
        return [1.0] + [0.0] * (N_OWN - 1)
    lower = [w.lower() for w in words]
    common = Counter(lower)
    bare = sum(1 for w in words if not any(map(str.isalnum, w)))
    odd_end = sum(1 for w in words if len(w) > 2 and not w[-1].isalnum() and w[-1] not in ".,;:!?'\")")
    short = sum(1 for w in words if len(w) <= 3)
    return [
        0.0, min(n, 200) ** 0.5 / 5, float(n <= 2), min(5.0, len(_SYMBOL.findall(line)) / n),
        min(5.0, len(_DIGIT.findall(line)) / n), sum(1 for w in words if w[0].isupper()) / n,
        bare / n, odd_end / n, short / n,
        sum(a == b for a, b in zip(lower, lower[1:])) / n,
        len(common) / n, max(common.values()) / n, min(20.0, sum(map(len, words)) / n) / 10,
        float(line.rstrip().endswith(_ENDS)), float(line[:1].isupper()), min(times - 1, 5) / 5,
    ]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of every line with those of its neighbours, weight of every line).

    Lines end at line feeds; the weight is the number of characters, at least one. Own features come
    also as squares and as one or zero; before the first and after the last line all are zero.
    """
    lines = text.split("\n")
    times = Counter(lines)
    own = np.array([line_features(x, x.split(), times[x]) for x in lines])
    edge = np.zeros((1, N_OWN))
    before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    all_ = np.hstack([np.ones((len(lines), 1)), own, own ** 2, own > 0, before, after])
    return all_, np.array([max(1, len(x)) for x in lines], dtype=float)


def _log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class LineCrf:
    """Labels 0 (bad) and 1 (good). ``weights``: one score for good per feature; ``moves``: label to label."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, x: np.ndarray) -> np.ndarray:
        good = ((x - self.mean) / self.scale) @ self.weights
        return np.stack([np.zeros(len(x)), good], axis=1)

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Probability that each line is good, by forward and backward sums of one chain's log odds."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        gain = self.emissions(x)[:, 1].tolist()
        ahead = [gain[0]]
        for g in gain[1:]:
            odds = ahead[-1]
            ahead.append(g + _log_add(odds + m11, m01) - _log_add(odds + m10, m00))
        back = [0.0]
        for g in reversed(gain[1:]):
            odds = back[-1] + g
            back.append(_log_add(m10, m11 + odds) - _log_add(m00, m01 + odds))
        odds = np.array(ahead) + np.array(back[::-1])
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))

    def quality(self, text: str) -> float:
        """Mean of the lines' marginals, weighted by their length."""
        x, weight = features(text)
        return float(np.clip(weight @ self.marginals(x) / weight.sum(), 0.0, 1.0))


def _chains(emissions: Sequence[np.ndarray], moves: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Marginals of label 1 per chain, and the expected number of each move over all chains.

    All chains advance together, longest first, so those that have ended drop off the end.
    """
    order = sorted(range(len(emissions)), key=lambda i: -len(emissions[i]))
    lengths = np.array([len(emissions[i]) for i in order])
    depth = int(lengths[0])
    padded = np.zeros((len(order), depth, 2))
    for row, i in enumerate(order):
        padded[row, :len(emissions[i])] = emissions[i]
    live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(depth)]
    alpha, beta = np.zeros_like(padded), np.zeros_like(padded)
    alpha[:, 0] = padded[:, 0]
    for t in range(1, depth):
        k = live[t]
        alpha[:k, t] = _log_sum(alpha[:k, t - 1, :, None] + moves, 1) + padded[:k, t]
    total = _log_sum(alpha[np.arange(len(order)), lengths - 1], 1)
    expected = np.zeros((2, 2))
    for t in range(depth - 1, 0, -1):
        k = live[t]
        ahead = padded[:k, t] + beta[:k, t]
        beta[:k, t - 1] = _log_sum(moves + ahead[:, None, :], 2)
        pair = alpha[:k, t - 1, :, None] + moves + ahead[:, None, :] - total[:k, None, None]
        expected += np.exp(pair).sum(axis=0)
    good = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None])
    out: list[np.ndarray] = [np.empty(0)] * len(order)
    for row, i in enumerate(order):
        out[i] = np.clip(good[row, :lengths[row]], 0.0, 1.0)
    return out, expected


def gradient_of(flat: np.ndarray, lengths: np.ndarray, y: np.ndarray, params: np.ndarray) -> np.ndarray:
    """How the loss rises with the weights and the two stays.

    Of the weights that is the chains' negative log likelihood divided by their lines, each class weighing a half; of the
    stays a quarter of each class's negative log likelihood divided by its moves.
    """
    weights, moves = params[:-2], np.diag(params[-2:])
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    good = flat @ weights
    emissions = np.split(np.stack([np.zeros(len(good)), good], axis=1), ends[:-1])
    line_gap, stay = np.zeros(len(flat)), np.zeros(2)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        if not len(own):
            continue
        marginals, expected = _chains([emissions[i] for i in own], moves)
        for i, p in zip(own, marginals):
            line_gap[ends[i] - lengths[i]:ends[i]] = p
        moved = max(1, int((lengths[own] - 1).sum()))
        # a class of single lines has no moves to learn from
        stay += np.diag(expected) / moved - (np.arange(2) == label)
    return np.concatenate([flat.T @ ((line_gap - y[doc]) * (share / lengths)[doc]), 0.25 * stay])


def fit(chains: Sequence[np.ndarray], labels: Sequence[int], steps: int = STEPS, ridge: float = 1e-2) -> LineCrf:
    """Maximise the likelihood of the labels; all lines of a document have its label.

    A document counts as much as one of its lines would on average, so long documents don't
    drown the short ones; both classes weigh the same. Adam on the whole sample.
    """
    lengths = np.array([len(c) for c in chains])
    flat = np.vstack(chains).astype(float, copy=False)  # the one copy of all lines, scaled in place
    mean, scale = flat.mean(axis=0), flat.std(axis=0) + 1e-6
    mean[0], scale[0] = 0.0, 1.0
    flat -= mean
    flat /= scale
    y = np.array(labels, dtype=float)
    params = np.zeros(flat.shape[1] + 2)  # the two stays; the two changes are fixed at 0
    weights, moves = params[:-2], np.zeros((2, 2))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        gradient = gradient_of(flat, lengths, y, params) + ridge * params / 10
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
        params = params - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
        params[-2:] = np.clip(params[-2:], 0.0, 2.0)
        weights, moves = params[:-2], np.diag(params[-2:])
    return LineCrf(mean, scale, weights, moves)


def train(
    docs: DataFrame, marks: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES,
    sample_total: int = SAMPLE_TOTAL,
) -> LineCrf | None:
    """Fit on texts (id, text) of ``sample_docs`` marked ids (id, label) of each label, in the order of a hash.

    Documents of over ``sample_lines`` lines don't train and are left out before ids are drawn. At most twice
    ``sample_docs`` ids are broadcast to pick the texts, and of the rows that repeat an id one trains, that
    with the smallest hash of its text. Of each label the first documents train that have ``sample_total`` lines
    together, which bounds the driver's share. Features are computed on the executors. None without rows, so
    also where all marked documents are longer.
    """
    short = docs.where(F.regexp_count("text", F.lit("\n")) < sample_lines)
    there = marks.join(short.select("id").distinct(), "id")
    drawn = [there.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample_docs) for label in (0, 1)]
    # combined per task before the shuffle, so an id that many rows carry is no large group
    first = F.min(F.struct(F.xxhash64("text"), "text")).alias("first")
    picked = short.join(F.broadcast(drawn[0].union(drawn[1])), "id").groupBy("label", "id").agg(first).select(
        "label", "id", "first.text")
    # of at most sample_docs rows a label
    so_far = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    lines = F.regexp_count("text", F.lit("\n")) + 1
    picked = picked.withColumn("lines", F.sum(lines).over(so_far)).where(F.col("lines") <= sample_total)

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t)[0].astype("<f4").tobytes())

    # one small column of features per document comes to the driver
    rows = picked.select("label", "id", packed("text").alias("x")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.label, r.id, bytes(r.x)))
    width = len(features("")[0][0])
    chains = [np.frombuffer(r.x, "<f4").reshape(-1, width) for r in rows]
    return fit(chains, [r.label for r in rows])


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", folds: int = 5, held_out: int = 0, threshold: float = THRESHOLD,
) -> DataFrame:
    """Quality of every whole text: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Every line is labelled good or bad by a field whose features are the line's and its neighbours';
    the score is the length-weighted mean of the lines' marginals of being good. Learns from the
    bounded sample of ``train`` among labelled rows outside the fold ``held_out``; a score depends on
    the text only.

    One row per input row. Null text is empty: one empty line. Null or other labels than 0 and 1
    don't train; without any label every score is 1. Repeated rows are scored each. Null ids are in the
    fold of the empty text and don't train. An empty table gives an empty result. Other columns are
    not read.
    """
    model = learn(docs, labels, id_col, text_col, label_col, folds, held_out)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
        (fold_of(id_col, folds) == held_out).alias("held_out"))
    return rows.withColumn("score", _quality(model)("text")).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", folds: int = 5, held_out: int = 0, threshold: float = THRESHOLD,
) -> DataFrame:
    """The whole rows of ``docs`` whose text ``score`` does not reject, in their own columns."""
    model = learn(docs, labels, id_col, text_col, label_col, folds, held_out)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), text_of(text_col).alias("text"))
    return rows.where(_quality(model)("text") >= threshold).select("doc.*")


def learn(docs, labels, id_col, text_col, label_col, folds, held_out) -> LineCrf | None:
    """The model of ``train`` from labelled rows outside the fold ``held_out``."""
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.where((fold_of("id", folds) != held_out) & F.col("label").isin(0, 1) & F.col("id").isNotNull())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return train(rows, marks.groupBy("id").agg(F.min("label").alias("label")))


def _quality(model: LineCrf | None):
    @F.pandas_udf("double")
    @tidied
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(model.quality if model else lambda _: 1.0).astype(float)

    return quality
