"""Search in names by an index of trigrams: few folders are read, and the pattern decides on what they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edupanel.functions import matches

BUCKETS = 64
SIZE = 3
#: Letters that a search without regard to case takes for a letter of the alphabet, besides its two cases.
_ALSO = {chr(0x130): "I", chr(0x131): "I", chr(0x17F): "S", chr(0x212A): "K"}
_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: What may follow a backslash and stands for one character or for a place; all else ends the search for literals.
_CLASSES = "dDwWsSbBAzZGhHvVRXtnrfae"


def literals(pattern: str) -> list[str]:
    """Runs of plain characters that are part of every match of a regular expression; none where that is not sure."""
    runs, run, i = [], "", 0
    repeated = False  # the last thing was a quantifier, which a ? or + may follow

    def end() -> None:
        nonlocal run
        runs.append(run)
        run = ""

    while i < len(pattern):
        ch = pattern[i]
        was_repeated, repeated = repeated, False
        if ch == "|":
            return []
        if ch == "(":
            i = _group_end(pattern, i)
            if i < 0:
                return []
            end()
        elif ch == "[":
            i = _class_end(pattern, i)
            if i < 0:
                return []
            end()
        elif ch == "\\":
            i += 1
            follow = pattern[i:i + 1]
            if not follow or follow.isalnum() and follow not in _CLASSES:
                return []
            if follow in _CLASSES or ord(follow) > 127:
                end()
            else:
                run += follow
        elif ch in "*?{":
            if not (was_repeated and ch == "?"):
                run = run[:-1]  # the character before need not be there
            end()
            if ch == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return []
            repeated = True
        elif ch == "+":
            end()
            repeated = True
        elif ch in ".^$" or ord(ch) > 127:
            end()
        elif ch in ")]}":
            return []
        else:
            run += ch
        i += 1
    end()
    return [r for r in runs if r]


def _class_end(pattern: str, start: int) -> int:
    """Place of the bracket that ends a character class, -1 for classes within classes."""
    i = start + 1
    if pattern[i:i + 1] == "^":
        i += 1
    if pattern[i:i + 1] == "]":
        return -1
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
            if pattern[i:i + 1] in ("Q", "E"):
                return -1
        elif pattern[i] == "[":
            return -1
        elif pattern[i] == "]":
            return i
        i += 1
    return -1


def _group_end(pattern: str, start: int) -> int:
    """Place of the parenthesis that ends a group, -1 where a group sets flags or can't be followed."""
    if pattern[start + 1:start + 2] == "?" and pattern[start + 2:start + 3] not in (":", "=", "!", "<", ">"):
        return -1
    depth, i = 0, start
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
            if pattern[i:i + 1] in ("Q", "E"):
                return -1
        elif pattern[i] == "[":
            i = _class_end(pattern, i)
            if i < 0:
                return -1
        elif pattern[i] == "(":
            if i > start and pattern[i + 1:i + 2] == "?" and pattern[i + 2:i + 3] not in (":", "=", "!", "<", ">"):
                return -1
            depth += 1
        elif pattern[i] == ")":
            depth -= 1
            if not depth:
                return i
        i += 1
    return -1


def _fold(text: Column) -> Column:
    return F.translate(text, "".join(_ALSO) + _LOWER, "".join(_ALSO.values()) + _LOWER.upper())


def _grams(text: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(text) - SIZE + 1)
    grams = F.transform(places, lambda i: F.substring(text, i, F.lit(SIZE)))
    return F.when(F.length(text) >= SIZE, grams).otherwise(F.array().cast("array<string>"))


def _bucket(gram: str) -> int:
    a, b, c = map(ord, gram)
    return (a * 31 + b * 7 + c) % BUCKETS


class SearchIndex:
    """Distinct names below ``root``: the names themselves, and the names by trigram in folders by bucket of trigrams."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def build(cls, names: DataFrame, column: str, root: str) -> SearchIndex:
        """Index the distinct names of a column; a null name is never found.

        Trigrams are those of the name in capitals and of the name as its letters stand, so they serve searches that turn a
        letter into two and searches that compare letter by letter.
        """
        index = cls(names.sparkSession, root)
        distinct = names.select(F.col(column).alias("name")).na.drop().distinct()
        distinct.write.parquet(f"{index.root}/names")
        stored = index.names()
        grams = F.array_distinct(F.concat(_grams(_fold(F.col("name"))), _grams(_fold(F.upper("name")))))
        postings = stored.select("name", F.explode(grams).alias("gram"))
        codes = [F.ascii(F.substring("gram", k, 1)) for k in (1, 2, 3)]
        bucket = F.pmod(codes[0] * 31 + codes[1] * 7 + codes[2], F.lit(BUCKETS))
        postings = postings.withColumn("bucket", bucket.cast("int")).hint("rebalance", "bucket")
        # sorted files let Parquet skip the row groups of other trigrams
        postings.sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{index.root}/grams")
        return index

    def names(self) -> DataFrame:
        return self.spark.read.schema("name string").parquet(f"{self.root}/names")

    def candidates(self, query: str, literal: bool = False) -> DataFrame:
        """Names that hold all trigrams of the query's literal parts; all names if it has none."""
        parts = [run for run in _runs(query)] if literal else literals(query)
        grams = sorted({
            run[i:i + SIZE] for run in (part.upper() for part in parts) for i in range(len(run) - SIZE + 1)})
        if not grams:
            return self.names()
        postings = self.spark.read.schema("name string, gram string, bucket int").parquet(f"{self.root}/grams")
        held = postings.where(F.col("bucket").isin(*sorted({_bucket(g) for g in grams})) & F.col("gram").isin(*grams))
        return held.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).select("name")

    def search(self, query: str, literal: bool = False) -> DataFrame:
        """The names that ``matches`` finds, as a column ``name``."""
        return self.candidates(query, literal).where(matches(F.col("name"), query, literal))


def _runs(text: str) -> list[str]:
    """The parts of a text without characters beyond ASCII, which capitals may change."""
    return "".join(ch if ord(ch) < 128 else "\n" for ch in text).split("\n")
