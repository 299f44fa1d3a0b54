"""URL filter: host and path rules, then a ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
ORDER = 5
SAMPLE = 20_000
BYTES_AT_ONCE = 200_000
_PAD = 2


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: str, path: str, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, site, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col(host) == site) | F.col(host).endswith("." + site)) & F.col(path).startswith(start)
        rule = F.when(fits, F.lit(site + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(urls: Sequence[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per length n up to ``order`` + 1 the last n bytes at every place, as one number; the URL of each place."""
    lengths = np.array([len(u) + 1 for u in urls], dtype=np.int64)
    pad = bytes([_PAD]) * order
    flat = np.frombuffer(b"".join(pad + u + b"\x03" for u in urls), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(urls)), lengths)
    starts = np.cumsum(lengths + order) - lengths
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    grams, value = [], np.zeros(len(place), dtype=np.uint64)
    for n in range(order + 1):
        value = value | (flat[place - n] << np.uint64(8 * n))
        grams.append(value)
    return grams, owner


def _piece(url: bytes, start: int, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """``_grams`` at BYTES_AT_ONCE places of one URL from ``start`` on, which the bytes before stand behind."""
    ended = bytes([_PAD]) * order + url + b"\x03"
    flat = np.frombuffer(ended[start:start + order + BYTES_AT_ONCE], dtype=np.uint8).astype(np.uint64)
    place = np.arange(order, len(flat))
    grams, value = [], np.zeros(len(place), dtype=np.uint64)
    for n in range(order + 1):
        value = value | (flat[place - n] << np.uint64(8 * n))
        grams.append(value)
    return grams, np.zeros(len(place), dtype=np.int64)


@dataclass
class MarkovModel:
    """Variable-order character model: each order backs off to the next shorter one.

    p(c | context) = (n(context c) + t(context) p(c | shorter)) / (n(context) + t(context)), with
    t the number of distinct characters seen after the context (Witten-Bell); below order 0
    all 256 bytes are equally likely.
    """

    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def fit(cls, urls: Sequence[bytes], order: int) -> MarkovModel:
        found, _ = _grams(urls, order)
        grams, contexts = [], []
        for values in found:
            keys, counts = np.unique(values, return_counts=True)
            before, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            grams.append((keys, counts.astype(float)))
            contexts.append((before, np.bincount(at, counts), np.bincount(at).astype(float)))
        return cls(order, grams, contexts)

    def log_prob(self, grams: list[np.ndarray]) -> np.ndarray:
        p = np.full(len(grams[0]), 1 / 256)
        for (keys, counts), (before, total, kinds), values in zip(self.grams, self.contexts, grams):
            n = _look(keys, counts, values)
            at = values >> np.uint64(8)
            all_n, t = _look(before, total, at), _look(before, kinds, at)
            p = np.where(all_n > 0, (n + t * p) / np.maximum(all_n + t, 1), p)
        return np.log(p)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


@dataclass
class RatioModel:
    """Mean log-likelihood difference per character, and the threshold calibrated for it."""

    accepted: MarkovModel | None
    rejected: MarkovModel | None
    slope: float = 1.0
    offset: float = 0.0

    def ratio(self, urls: Sequence[bytes]) -> np.ndarray:
        if not urls or self.accepted is None or self.rejected is None:
            return np.zeros(len(urls))
        gaps, lengths = np.zeros(len(urls)), np.array([len(u) + 1 for u in urls])
        # about 100 bytes of arrays a character, so URLs are taken by their characters, long ones in pieces
        pieces = [(i, start) for i, n in enumerate(lengths.tolist()) for start in range(0, n, BYTES_AT_ONCE)]
        first = 0
        while first < len(pieces):
            last, size = first, 0
            while last < len(pieces) and (last == first or size + min(BYTES_AT_ONCE, lengths[pieces[last][0]]) <= BYTES_AT_ONCE):
                size += min(BYTES_AT_ONCE, lengths[pieces[last][0]])
                last += 1
            part = pieces[first:last]
            order = self.accepted.order
            whole = [urls[i] if lengths[i] <= BYTES_AT_ONCE else None for i, _ in part]
            if None in whole:
                grams, owner = _piece(urls[part[0][0]], part[0][1], order)
                part = part[:1]
                last = first + 1
            else:
                grams, owner = _grams(whole, order)
            gap = self.rejected.log_prob(grams) - self.accepted.log_prob(grams)
            np.add.at(gaps, [i for i, _ in part], np.bincount(owner, gap, len(part)))
            first = last
        return gaps / lengths

    def reject_probability(self, urls: Sequence[bytes]) -> np.ndarray:
        if self.accepted is None or self.rejected is None:
            return np.full(len(urls), 0.0 if self.rejected is None else 1.0)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.ratio(urls) + self.offset, -50, 50)))


def fit_ratio(accepted: Sequence[bytes], rejected: Sequence[bytes], order: int = ORDER) -> RatioModel:
    """Both models from four fifths of their URLs; a logistic curve on the rest calibrates the ratio.

    Each class weighs a half in the calibration. With one class only, all URLs belong to it;
    with none, all are accepted.
    """
    if not accepted or not rejected:
        return RatioModel(
            MarkovModel.fit(accepted, order) if accepted else None,
            MarkovModel.fit(rejected, order) if rejected else None)
    held = [a[::5] for a in (accepted, rejected)]
    rest = [[u for i, u in enumerate(a) if i % 5] or list(a) for a in (accepted, rejected)]
    model = RatioModel(MarkovModel.fit(rest[0], order), MarkovModel.fit(rest[1], order))
    x = np.concatenate([model.ratio(h) for h in held])
    y = np.repeat([0.0, 1.0], [len(h) for h in held])
    weight = np.repeat([0.5 / len(h) for h in held], [len(h) for h in held])
    slope, offset = 0.0, 0.0
    for _ in range(50):  # Newton steps, kept finite by a small ridge
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -50, 50)))
        g, h = weight * (p - y), weight * p * (1 - p)
        gradient = np.array([(g * x).sum() + 1e-4 * slope, g.sum() + 1e-4 * offset])
        hessian = np.array([[(h * x * x).sum() + 1e-4, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-4]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - step[0], offset - step[1]
    model.slope, model.offset = float(max(slope, 1e-6)), float(offset)
    return model


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER, sample: int = SAMPLE,
    threshold: float = 0.5,
) -> DataFrame:
    """Verdict on every URL: by the longest rule that fits, else by the calibrated ratio.

    URLs that a rule allows are the accepted ones, those it blocks the rejected ones. ``sample``
    distinct URLs of each class, in the order of a hash, train the two models; this bound also
    bounds what the driver and each task hold. A URL without a rule is blocked when its calibrated
    probability of rejection is over ``threshold``.

    Returns page_id, host, path, rule, verdict and reject_probability (null under a rule), one
    row per input row. A null URL, or one without ``://``, has empty host and path and is judged by
    the models on its text (null: empty). Repeated rows are repeated. An empty table gives an
    empty result. Without trained classes every URL is allowed. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    rows = rows.withColumn("host", host_of("url")).withColumn("path", path_of("url"))
    rule, verdict = rule_of("host", "path", rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)

    def class_of(kind: str) -> list[bytes]:
        urls = rows.where(F.col("ruled") == kind).select("url").distinct()
        first = urls.orderBy(F.xxhash64("url"), "url").limit(sample).collect()
        return [r.url.encode() for r in first]

    model = fit_ratio(class_of("allow"), class_of("block"), order)

    @F.pandas_udf("double")
    def rejection(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for urls in batches:
            found = np.full(len(urls), np.nan)
            open_ = urls.notna().to_numpy()
            found[open_] = model.reject_probability([u.encode() for u in urls[open_]])
            yield pd.Series(found)

    judged = rows.withColumn("reject_probability", F.nanvl(
        rejection(F.when(F.col("ruled").isNull(), F.col("url"))), F.lit(None).cast("double")))
    by_model = F.when(F.col("reject_probability") > threshold, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "reject_probability")
