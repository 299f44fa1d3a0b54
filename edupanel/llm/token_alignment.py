"""Cross-tokenizer alignment: two tokenisers' tokens of one text, by byte offsets."""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from edupanel.session import stage

CACHED_UNITS = 250_000
UNITS_AT_ONCE = 2_000
TEXTS_AT_ONCE = 200
PAIRS_AT_ONCE = 2_000_000
FLUSH_PAIRS = 2_000_000

#: White space and invisible characters, more than any of the tokenisers takes for white space, and the pieces' own space.
_BLANK = [(0, 0x20), (0x7F, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F), (0x2028, 0x202F),
          (0x205F, 0x206F), (0x2581, 0x2581), (0x3000, 0x3000), (0xFEFF, 0xFEFF)]
#: A unit begins at a space that stands behind another character than a space (the text itself is taken to have one in front)
#: and before a character that is sure not to be white space: there a new pre-token begins, and so does a piece where no piece holds a space behind another character.
_BLANKS = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in _BLANK)
_UNIT = re.compile(f"(?<=[^ ]) (?=[^{_BLANKS}])")
_BLANK_FIRST = re.compile(f"[{_BLANKS}]")
_SPACE = "\u2581"


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones stand for themselves, others for 256 and up."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligner:
    """Aligns texts. ``path_a`` is a byte-level vocabulary, ``path_b`` one of pieces that adds a space.

    Texts are cut into units at spaces where both tokenisers begin a token whatever comes before, so a unit's tokens are
    those that it has in the text, groups and links never cross units, and units can be tokenised many at a time, one behind
    the other. The last CACHED_UNITS to twice as many units are kept. Vocabularies that don't allow it get whole
    texts as units.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.size_a, self.size_b = max(vocabulary.values()) + 1, self.b.get_piece_size()
        self.sizes_a = np.zeros(self.size_a, dtype=np.int64)
        for token, i in vocabulary.items():
            self.sizes_a[i] = len(bytes(letters[c] for c in token))
        self.bytes_b = [self._piece(i) for i in range(self.size_b)]
        self.sizes_b = np.array([len(p) for p in self.bytes_b])
        # an id and what may follow it: another of its side, the other side or the next group, the next unit
        self.written = [
            np.array([[f"{i}{mark}" for mark in marks] for i in range(size)], dtype=object)
            for size, marks in ((self.size_a, ",|"), (self.size_b, ",;\n"))]
        with open(path_a, encoding="utf-8") as file:
            splitter = json.load(file).get("pre_tokenizer") or {}
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.cut = (
            splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
            and not any(_SPACE in p.lstrip(_SPACE) for p in pieces))
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(_SPACE, " ").encode("utf-8")

    def __call__(self, texts: list[str]) -> list[tuple | None]:
        """Per text (n_a, n_b, n_groups, keys of all links, groups); None for texts without tokens."""
        # the first unit's space is the one that stands before every text
        split = [(_UNIT.split(t) if self.cut else [t]) if t else [] for t in texts]
        wanted = set().union(*split)
        if len(self.known) + len(wanted) > CACHED_UNITS:
            self.older, self.known = self.known, {}
        known = self.known
        new = wanted.difference(known)
        back = new.intersection(self.older)
        known.update(zip(back, map(self.older.__getitem__, back)))
        self._learn(list(new.difference(back)))
        out = []
        for units in split:
            held = list(map(known.__getitem__, units))
            if not held or None in held:
                out.append(None)
                continue
            keys, groups, n_a, n_b = zip(*held)
            groups = ";".join(groups)
            out.append((sum(n_a), sum(n_b), groups.count(";") + 1, np.frombuffer(b"".join(keys), np.int64), groups))
        return out

    def _learn(self, units: list[str]) -> None:
        plain = [u for u in units if self.cut and u and u[-1] != " " and not _BLANK_FIRST.match(u)]
        for i in range(0, len(plain), UNITS_AT_ONCE):
            part = plain[i:i + UNITS_AT_ONCE]
            if not self._together(part):
                for unit in part:
                    self._singly(unit)
        if len(plain) < len(units):
            for unit in set(units).difference(plain):
                self._singly(unit)

    def _singly(self, unit: str) -> None:
        if not self._together([unit]):
            self.known[unit] = None

    def _together(self, units: list[str]) -> bool:
        """Learn units that follow each other, in arrays; False if what B's tokens spell is not the text."""
        text = " ".join(units)
        raw = (" " + text).encode("utf-8")
        ids_b = self.b.encode(text, num_threads=1) if text else []
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return False
        (found,) = self.a.encode_batch_fast([" " + text], add_special_tokens=False)
        a, b = np.array(found.ids, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        if not len(a) or ends_a[-1] != len(raw):
            return False
        unit_ends = np.cumsum([len(u.encode("utf-8")) + 1 for u in units])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # the tokens of b that begin before a's token ends and end behind its begin
        first = np.searchsorted(ends_b, ends_a - self.sizes_a[a], side="right")
        each = np.searchsorted(ends_b, ends_a, side="left") - first + 1
        links = np.repeat(first - np.cumsum(each) + each, each) + np.arange(each.sum())
        keys = (np.repeat(a, each) * self.size_b + b[links]).tobytes()
        of_a, of_b = (np.concatenate([[0], np.searchsorted(ends, unit_ends) + 1]) for ends in (ends_a, ends_b))
        key_ends = (8 * np.concatenate([[0], np.cumsum(each)])[of_a]).tolist()
        # each side's tokens end their group, and b's also the unit, or not
        last_a = np.append(group_a[1:] != group_a[:-1], True).astype(np.int64)
        last_b = np.append(group_b[1:] != group_b[:-1], True).astype(np.int64)
        last_b[of_b[1:] - 1] = 2
        marked = np.concatenate([self.written[0][a, last_a], self.written[1][b, last_b]])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        groups = "".join(marked[order].tolist()).split("\n")
        rows = zip([keys[i:j] for i, j in zip(key_ends, key_ends[1:])], groups, np.diff(of_a).tolist(), np.diff(of_b).tolist())
        self.known.update(zip(units, rows))
        return True


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker; Spark uses a worker for many tasks."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


ALIGNED = (
    "digest string, times long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs binary, occurrences binary")


def align_texts(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """One row per distinct text that has tokens, with how many rows hold it and its linked id pairs.

    Rows meet by their full text, counted in each task first, so a text that many rows hold is tokenised once. ``pairs`` holds the
    distinct links as 64-bit numbers, a * size of b + b, in order, and ``occurrences`` how often each occurs.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(first, TEXTS_AT_ONCE)
                rows = []
                for digest, times, found in zip(
                        part.column(0).to_pylist(), part.column(1).to_pylist(), both(part.column(2).to_pylist())):
                    if found:
                        n_a, n_b, n_groups, keys, groups = found
                        pairs, often = np.unique(keys, return_counts=True)
                        row = [digest, times, n_a, n_b, n_groups, len(keys), hashlib.sha256(groups.encode()).hexdigest(),
                               pairs.tobytes(), often.astype(np.int64).tobytes()]
                        rows.append(row + [groups] if with_groups else row)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], [name for name, _ in fields])

    schema = ALIGNED + (", groups string" if with_groups else "")
    fields = [field.strip().split(" ") for field in schema.split(",")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind] for _, kind in fields]
    texts = docs.where("text != ''").groupBy("text").agg(F.count("*").alias("times"))
    return texts.select(F.sha2("text", 256).alias("digest"), "times", "text").mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many rows of the corpus hold each id pair linked; tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        held = distinct = 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            flat, weights = np.concatenate(keys), np.concatenate(sums)
            order = np.argsort(flat, kind="stable")
            flat, weights = flat[order], weights[order]
            new = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
            return flat[new], np.add.reduceat(weights, new) if len(new) else weights

        def rows(flat: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(flat), pa.array(total)], ["pair", "n"])

        for batch in batches:
            for times, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(np.frombuffer(pairs, np.int64))
                sums.append(np.full(len(keys[-1]), times, np.int64))
                held += len(keys[-1])
                if held > FLUSH_PAIRS + distinct:
                    flat, total = added()
                    if len(flat) > FLUSH_PAIRS:
                        yield rows(flat, total)
                        flat, total = flat[:0], total[:0]
                    keys, sums, held = [flat], [total], len(flat)
                    distinct = len(flat)
        yield rows(*added())

    found = aligned.select("times", "pairs").mapInArrow(count, "pair long, n long")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def _measured(aligned: DataFrame, counts: DataFrame, at_once: int) -> DataFrame:
    """(digest, n_best, count_sum): sums over each text's links of what ``counts`` (pair, n, best) says.

    The pairs' table depends on the vocabularies and grows slowly with the corpus. It is sent in blocks of about ``at_once`` pairs,
    each of which is gone before the next is sent, so what is broadcast and what the driver holds does not grow.
    """
    context = aligned.sparkSession.sparkContext
    blocks = max(1, math.ceil(counts.count() / at_once))
    parts = []
    for block in range(blocks):
        part = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).toArrow().sort_by("pair")
        table = [part.column(name).to_numpy() for name in ("pair", "n", "best")]
        sent = context.broadcast(table)

        def measure(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known, n, best = sent.value
            for batch in batches:
                n_best, count_sum = [], []
                for pairs, often in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    keys, often = np.frombuffer(pairs, np.int64), np.frombuffer(often, np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                        here = known[at] == keys
                        at, often = at[here], often[here]
                    else:
                        at, often = np.empty(0, np.int64), often[:0]
                    n_best.append(int(often[best[at]].sum()))
                    count_sum.append(int((often * n[at]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                    ["digest", "n_best", "count_sum"])

        found = aligned.select("digest", "pairs", "occurrences").mapInArrow(
            measure, "digest string, n_best long, count_sum long")
        if blocks == 1:
            return found
        parts.append(stage(found, "measured"))
        sent.destroy()
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    with_groups: bool = False, pairs_at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """How the tokens of A and B lie over each other in every whole text.

    A reads a space and the text, B the text, to which it adds the space. Offsets at which a token of both ends cut the text into
    groups; a link is a pair of tokens, one of each, whose byte ranges overlap. The count of an id pair is the number of
    documents that hold it linked, over all documents.

    Returns per row doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their A id,
    ties included), count_sum (over all links) and groups_sha256; ``with_groups`` adds the groups themselves, as
    ``a1,a2|b1;a3|b2,b3``.

    1. Rows meet by their full text; every distinct text is tokenised and aligned once.
    2. Pair counts are weighed by how many rows hold the text.
    3. Measures go back to the rows by the text's SHA-256, a join whose hot keys Spark splits.

    Null and empty texts, and texts that the joined tokens of A or B don't spell, have zeros, an empty groups_sha256 and empty
    groups. Repeated rows and copies count each for the pair counts. Null ids are kept. An empty table gives an
    empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aligned = stage(align_texts(rows, path_a, path_b, with_groups), "aligned")
    size_b = aligner(path_a, path_b).size_b
    counts = pair_counts(aligned)
    # an A id has no more pairs than B has ids
    same_a = Window.partitionBy(F.expr(f"pair div {size_b}"))
    counts = stage(counts.withColumn("best", F.col("n") == F.max("n").over(same_a)), "pairs")
    measures = aligned.drop("pairs", "occurrences", "times").join(_measured(aligned, counts, pairs_at_once), "digest")
    joined = rows.select("doc_id", F.when(F.col("text") != "", F.sha2("text", 256)).alias("digest")).join(measures, "digest", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ["groups_sha256"] + ["groups"] * with_groups]
    return joined.select("doc_id", *numbers, *texts)
