"""Best-fit packing of token sequences after dominance reduction on the table of lengths."""

from __future__ import annotations

import os
import re
import string
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from edupanel.session import stage

from .common import text_of, tidied

CAPACITY = 2048
SALTS = 256
CACHED_WORDS = 1_000_000
SHORT = 7
BYTES_AT_ONCE = 8_000_000
_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


class WordTokens:
    """Token ids of texts' words as little-endian 32-bit numbers; about CACHED_WORDS words are kept.

    The different words of some texts are looked up once. One of Latin letters with marks behind them is taken apart
    into the letters, in lower case, and the marks, which are pre-tokens of their own. Letters are spelled as the
    vocabulary's normaliser and pre-tokeniser spell each of them and go to its model, all else goes to the tokeniser as
    a whole. For a vocabulary that does not spell or part them so, or whose added tokens could lie within, that is every word.
    """

    def __init__(self, path: str) -> None:
        # tasks already use all cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        letters = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
        self.spelling = {ord(c): "".join(self._parts(c)) for c in letters}
        spelled = letters.translate(self.spelling)
        self.lower = spelled == letters.lower().translate(self.spelling)
        # the two left out begin an elision or an added token
        marks = "".join(c for c in string.punctuation if c not in "'<" and self._parts(letters + c) == [spelled, *self._parts(c)])
        if self._parts(letters) != [spelled] or any("<" not in a.content for a in self.tokenizer.get_added_tokens_decoder().values()):
            letters = marks = ""
        self.letters, self.marks = letters, marks
        self.plain = re.compile(f"[{letters}]+" if letters else "(?!)").fullmatch

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = np.cumsum(pc.list_value_length(words).to_numpy())
        coded = words.flatten().dictionary_encode()
        packed = self._of_words(coded.dictionary).take(coded.indices)
        _, offsets, data = packed.buffers()
        cuts = np.frombuffer(offsets, "<i8")[[0, *ends]].tolist()
        held = memoryview(data) if data else b""
        for start, end in zip(cuts, cuts[1:]):
            yield bytes(held[start:end])

    def _of_words(self, words: pa.Array) -> pa.Array:
        stems, marks = pc.utf8_rtrim(words, self.marks), pc.utf8_ltrim(words, self.letters)
        apart = pc.equal(pc.add(pc.binary_length(stems), pc.binary_length(marks)), pc.binary_length(words))
        stems = pc.if_else(apart, pc.utf8_lower(stems) if self.lower else stems, words)
        marks = pc.if_else(apart, marks, "")
        return pc.binary_join_element_wise(self._found(stems), self._found(marks), pa.scalar(b"", pa.large_binary()))

    def _found(self, words: pa.Array) -> pa.Array:
        coded = words.dictionary_encode()
        ids = self.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return pa.array(ids, pa.large_binary()).take(coded.indices)

    def ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word, which holds no white space that the texts are split at."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHED_WORDS:
            # short words come most often
            self.known = known = {w: ids for w, ids in known.items() if len(w) <= SHORT}
            if len(known) > CACHED_WORDS // 2:
                known.clear()
            new = [w for w in words if w not in known]
        plain = [w for w in new if self.plain(w)]
        for word, spelled in zip(plain, " ".join(plain).translate(self.spelling).split(" ")):
            known[word] = _packed([token.id for token in self.model.tokenize(spelled)])
        self._singly([w for w in new if w not in known] if len(plain) < len(new) else [])
        return [known[w] for w in words]

    def _parts(self, text: str) -> list[str]:
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [part for part, _ in splitter.pre_tokenize_str(text)] if splitter else [text]

    def _singly(self, words: list[str]) -> None:
        for i in range(0, len(words), 10_000):
            part = words[i:i + 10_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[word] = _packed(found.ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_tokens: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One cache per vocabulary and Python worker; Spark uses a worker for many tasks."""
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = 0,
) -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's tokens and an end, cut at ``capacity``.

    ``ids`` holds little-endian unsigned 32-bit numbers. The vocabulary's normaliser and
    pre-tokeniser never look across white space, so a text's tokens are those of its words. Null text
    is empty.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
            cuts = (np.flatnonzero(np.diff(sizes // BYTES_AT_ONCE)) + 1).tolist()
            for first, last in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(first, last - first)
                for doc_id, packed in zip(part.column(0).to_pylist(), tokens(part.column(1))):
                    packed += end
                    for piece, start in enumerate(range(0, len(packed), step)):
                        ids = packed[start:start + step]
                        for column, value in zip(columns, (doc_id, piece, start // 4, len(ids) // 4, ids)):
                            column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(tidied(encode), _SCHEMA)


class _Lengths:
    """Number of open items by length."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.n = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self.n[length] = count

    def largest(self, limit: int, without: tuple[int, ...] = ()) -> int:
        """The largest open length up to ``limit``, 0 if there is none."""
        if limit <= 0:
            return 0
        for length in np.flatnonzero(self.n[:limit + 1])[::-1]:
            if self.n[length] > without.count(int(length)):
                return int(length)
        return 0

    def smallest_two(self, without: int) -> list[int]:
        found: list[int] = []
        for length in np.flatnonzero(self.n):
            found += [int(length)] * int(min(2, self.n[length] - (length == without)))
            if len(found) >= 2:
                break
        return found[:2]


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed sequences with their number, what is left), after Martello and Toth.

    A set of items dominates another if the other's items can be shared out among its items
    without any share being larger than the item that takes it. If one set with item j dominates all
    sets with j that fit, some optimal packing holds it, and it is fixed:

    - j alone, if nothing fits beside it;
    - j and the largest item that fits beside it, if that fills the sequence, if no two items
      fit beside j, or if it is at least as long as any two that do;
    - j with that item and the largest third one, if two items at most fit beside j and each
      other such pair is dominated by these two.

    Equal items are taken together, as many times as both lengths allow.
    """
    open_ = _Lengths(counts, capacity)
    fixed: list[tuple[tuple[int, ...], int]] = []
    for j in range(capacity, 0, -1):
        while open_.n[j]:
            choice = _dominating(open_, j, capacity)
            if choice is None:
                break
            uses = {length: choice.count(length) for length in choice}
            times = int(min(open_.n[length] // k for length, k in uses.items()))
            fixed.append((choice, times))
            for length, k in uses.items():
                open_.n[length] -= k * times
    return fixed, {int(i): int(open_.n[i]) for i in np.flatnonzero(open_.n)}


def _dominating(open_: _Lengths, j: int, capacity: int) -> tuple[int, ...] | None:
    room = capacity - j
    partner = open_.largest(room, (j,))
    if not partner:
        return (j,)
    small = open_.smallest_two(j)
    if partner == room or len(small) < 2 or sum(small) > room:
        return (j, partner)
    lengths = np.flatnonzero(open_.n[:room + 1]).tolist()
    best = max((a + b for a in lengths if (b := open_.largest(min(a, room - a), (j, a)))), default=0)
    if len(open_three := _smallest(open_, j, 3)) == 3 and sum(open_three) <= room:
        return None  # more than two fit beside j
    if best <= partner:
        return (j, partner)
    third = open_.largest(room - partner, (j, partner))
    if not third:
        return None
    for y in lengths:
        # a pair (x, y), y the shorter, that neither fits item by item nor whole under the partner
        if y > third and any(x >= y and partner < x + y <= room for x in lengths):
            return None
    return (j, partner, third)


def _smallest(open_: _Lengths, without: int, k: int) -> list[int]:
    found: list[int] = []
    for length in np.flatnonzero(open_.n):
        found += [int(length)] * int(min(k, open_.n[length] - (length == without)))
        if len(found) >= k:
            break
    return found[:k]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on lengths with multiplicity: (sequence of lengths, number of such sequences)."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, held in by_room.items() if r >= length and held), default=None)
            if room is None:
                fit = capacity // length
                if left // fit:
                    _add(by_room, capacity - fit * length, (length,) * fit, left // fit)
                if left % fit:
                    _add(by_room, capacity - left % fit * length, (length,) * (left % fit), 1)
                break
            held = by_room[room]
            items, number = held.popitem()
            fit = room // length  # best fit goes on with the sequence that it has just made tighter
            whole = min(number, left // fit)
            if whole:
                _add(by_room, room - fit * length, items + (length,) * fit, whole)
                left -= whole * fit
                number -= whole
            if number and left and left < fit:
                _add(by_room, room - left * length, items + (length,) * left, 1)
                left, number = 0, number - 1
            if number:
                held[items] = number
    return [(items, n) for held in by_room.values() for items, n in held.items()]


def _add(by_room, room: int, items: tuple[int, ...], number: int) -> None:
    held = by_room[room]
    held[items] = held.get(items, 0) + number


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first, offset): where the n-th item of a length goes."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for items, number in [*fixed, *best_fit(rest, capacity)]:
        offset = 0
        for length in items:
            first = ranks[length]
            rows.append((length, first, first + number - 1, sequence, offset))
            ranks[length] = first + number
            offset += length
        sequence += number
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS, salt_col: str | None = None) -> DataFrame:
    """Add sequence_id and offset to items with a ``length`` of 1 to ``capacity``.

    The lengths' table has at most ``capacity`` rows whatever the size of the data. The driver plans
    on it: first sets that dominate all others are fixed, then the rest is packed best fit, longest
    first. The plan says where the n-th item of a length goes; its size also depends on ``capacity``
    only, so it is broadcast. Items are numbered within a length by a sum over salts and a row
    number within one salt, so a length that a third of all items share is no single group. The salt is a hash of the
    item, or where equal items may be many the stored column ``salt_col``, which is left out of the result.

    All other columns are kept, and may not be named sequence_id or offset. Equal lengths are
    numbered in the order of the items' columns. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    salt = F.col(salt_col) if salt_col else F.pmod(F.xxhash64(*pieces.columns), F.lit(salts))
    salted = pieces.withColumn("_salt", salt)
    pieces = pieces.drop(salt_col) if salt_col else pieces
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    counted = {int(r.length): int(r.n) for r in groups.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    if any(not 1 <= length <= capacity for length in counted):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    rows = plan(counted, capacity)
    steps = spark.createDataFrame(rows or [(0, 0, -1, 0, 0)], "length long, _from long, _to long, _sequence long, offset long")
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy(*pieces.columns)
    ranked = salted.withColumn("_rank", F.row_number().over(inside) - 1).join(starts, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    placed = ranked.join(
        F.broadcast(steps.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_from"), F.col("_to")))
    return placed.select(
        *pieces.columns, (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = 0,
) -> DataFrame:
    """Every document's pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only the ids' checksum goes through the shuffles; ``token_pieces`` and ``pack`` carry the ids
    themselves where they are wanted. Null and empty texts are one end token. Repeated rows are
    packed each, null ids are kept. An empty table gives an empty result. Other columns are not read.
    """
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    # by the row's number, which the file then holds, so that rows that repeat are dealt out too
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))
    return pack(stage(pieces.withColumn("_dealt", dealt), "pieces"), capacity, salt_col="_dealt")
