"""Text functions; every one is a Column expression that stays in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from edupanel.config import NAME_NOISE, NAME_PUNCTUATION, UNICODE_SPACES

NON_ASCII = r"[^\x00-\x7F]"


@lru_cache(maxsize=1)
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition holds ASCII: to one and to many letters."""
    single, several = {}, {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        folded = unicodedata.normalize("NFKD", char)
        if folded == char:
            continue
        kept = "".join(c for c in folded if c < "\x80")
        if len(kept) == 1:
            single[char] = kept
        elif kept:
            several[char] = kept
    return single, several


def ascii_fold(text: Column) -> Column:
    """Compatibility-decompose and drop what is not ASCII ('São' -> 'Sao', '½' -> '12').

    ASCII texts pass through. One translation folds the others and marks characters that
    fold to more than one letter; only texts with a mark are spelled out by character.
    """
    single, several = _ascii_folds()
    mark = "\x01"
    folds = "".join(single.values())
    marked = F.translate(text, "".join(single) + "".join(several), folds + mark * len(several))
    # one foldable literal, not a thousand
    pairs = "\x01".join(f"{char}\x02{spelling}" for char, spelling in several.items())
    lookup = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    spelled = F.array_join(
        F.transform(
            F.regexp_extract_all(F.translate(text, "".join(single), folds), F.lit("(?s)."), F.lit(0)),
            lambda ch: F.when(ch < "\x80", ch).otherwise(F.coalesce(lookup[ch], ch)),
        ),
        "",
    )
    folded = F.when(F.contains(marked, F.lit(mark)), spelled).otherwise(marked)
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, text).otherwise(F.regexp_replace(folded, NON_ASCII, ""))


def normalize_name(name: Column) -> Column:
    """Upper-case ASCII spelling used to match place names across sources.

    The order of the steps is part of the result: doubled blanks are merged once, after
    trimming and before folding, so three blanks leave two.
    """
    cleaned = F.replace(F.upper(name), F.lit(NAME_NOISE), F.lit(""))
    cleaned = F.regexp_replace(cleaned, f"[{NAME_PUNCTUATION}]", "")
    cleaned = F.btrim(cleaned, F.lit(UNICODE_SPACES))
    cleaned = F.replace(cleaned, F.lit("  "), F.lit(" "))
    return ascii_fold(cleaned)


def matches(text: Column, query: str, literal: bool = False) -> Column:
    """Case-insensitive search; null text never matches, an empty query always does."""
    if not query:
        return F.lit(True)
    if literal:
        found = F.contains(F.upper(text), F.upper(F.lit(query)))
    else:
        found = text.rlike("(?iu)" + query)
    return F.coalesce(found, F.lit(False))


def year_suffix(name: Column, prefix: str) -> Column:
    """'ideb_2019' -> 2019."""
    return F.replace(name, F.lit(prefix), F.lit("")).cast("int")
