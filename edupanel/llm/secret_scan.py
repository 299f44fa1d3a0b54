"""Secret scans: patterns of known forms, and windows of high entropy with an allow-list."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Fixed forms of the base; a match counts from that many characters of the group on.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))
BASE_KINDS = tuple(kind for kind, *_ in BASE)

#: Any match holds one of these runs, which are faster to look for than all matches of HEX.
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")

_SCALE = 1 << 32


@dataclass(frozen=True)
class EntropyClass:
    """Candidates are runs of ``characters``; a window is suspect from ``bits`` of entropy a character on."""

    kind: str
    characters: str
    window: int
    bits: float

    def runs(self) -> re.Pattern[str]:
        return re.compile(f"[{self.characters}]{{{self.window},}}")


CLASSES = (EntropyClass("entropy16", "0-9A-Fa-f", 16, 2.9), EntropyClass("entropy64", r"A-Za-z0-9+/=_-", 24, 4.0))

#: Candidates that match one of these as a whole are no secrets: numbers, words alone or joined, identifiers of the UUID form.
ALLOWED = (
    r"[0-9]+",
    r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}|(?:[A-Z][a-z]{2,})+)(?:[-_/+=]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}|(?:[A-Z][a-z]{2,})+))*[-_/+=]*",
    r"[-_/+=]+[A-Za-z]*[-_/+=]*",
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
)


def suspect_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Ranges of ``text`` covered by windows whose Shannon entropy reaches ``bits``.

    The entropy of a window of w characters is log2(w) less the sum of c log2(c) over its characters' counts, divided by w. One
    character comes and one goes at each step, so only two counts change. Sums are whole numbers, so they
    don't drift.
    """
    part = [0] + [round(_SCALE * c * math.log2(c)) for c in range(1, window + 1)]
    most = round(_SCALE * window * (math.log2(window) - bits))
    counts: Counter[str] = Counter()
    total, found = 0, []
    for i, new in enumerate(text):
        n = counts[new]
        total += part[n + 1] - part[n] if n < window else 0
        counts[new] = n + 1
        if i >= window:
            old = text[i - window]
            n = counts[old]
            total += part[n - 1] - part[n] if n <= window else 0
            counts[old] = n - 1
        start = i - window + 1
        if start >= 0 and total <= most:
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


class Scanner:
    """All spans (kind, start, end) of a text, in code points, the end exclusive, in the order of start and kind."""

    def __init__(self, classes: Sequence[EntropyClass] = CLASSES, allowed: Sequence[str] = ALLOWED) -> None:
        self.classes = [(c, c.runs()) for c in classes]
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None
        self.order = {kind: i for i, kind in enumerate([*BASE_KINDS, *(c.kind for c in classes)])}

    def base(self, text: str) -> list[tuple[str, int, int]]:
        spans = []
        for kind, pattern, group, least in BASE:
            pattern = _LONG_HEX if pattern is HEX else pattern
            for found in pattern.finditer(text):
                if len(found[group]) >= least:
                    spans.append((kind, found.start(), found.end()))
        return spans

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        spans = self.base(text)
        taken = sorted((start, end) for _, start, end in spans)
        for form, runs in self.classes:
            for found in runs.finditer(text):
                run = found[0]
                if self.allowed and self.allowed.fullmatch(run):
                    continue
                added = [(a + found.start(), b + found.start()) for a, b in suspect_windows(run, form.window, form.bits)]
                for start, end in added:
                    if not any(a < end and start < b for a, b in taken):
                        spans.append((form.kind, start, end))
                        taken.append((start, end))
        return sorted(spans, key=lambda s: (s[1], self.order[s[0]]))


SPANS = "array<struct<kind string, start long, end long>>"


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    classes: Sequence[EntropyClass] = CLASSES, allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """(doc_id, spans): where every whole text seems to hold secrets.

    The base patterns come first: ``assign`` is a key word, a sign and a value of at least 12 characters, ``access``
    an access key id, ``hex`` a run of hexadecimal digits. A span is the whole match. A match that is too short
    is dropped, but what it covers is not looked at again for its kind.

    Then each class of characters gives candidates, its maximal runs of at least a window. Windows slide over them, and those
    of high entropy together are a span. An allow-list of patterns takes out candidates that are plainly
    something else. Spans that overlap one of the base, or of an earlier class, are left out; base spans always
    stay, allowed or not.

    Every row is scanned by itself, without a shuffle. Null texts are empty and have no spans. Rows that repeat an id
    are scanned each, null ids are kept. An empty table gives an empty result. Other columns are not read.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [
                [dict(zip(("kind", "start", "end"), span)) for span in scanner(text.as_py() or "")]
                for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, spans_type)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(find, f"doc_id long, spans {SPANS}")


def of_kinds(spans: str, *kinds: str) -> Column:
    """The spans of these kinds."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def as_text(spans: Column | str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
