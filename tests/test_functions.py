import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from edupanel.functions import (
    coerce_numeric,
    fixed_decimals,
    matches,
    na_map,
    normalize_name,
    parse_key,
    plain_number,
    ratio,
    round_half_even,
    thousands,
    year_suffix,
)
from edupanel.functions.numbers import parse_number
from edupanel.functions.text import ascii_fold

NAMES = {
    "São João d'Água": "SAO JOAO D'AGUA",
    "SÃO PAULO - MIXING CENTER": "SAO PAULO",
    "Mixing Center": "",
    "Guarda-Mirim": "GUARDAMIRIM",
    "A   B": "A  B",
    "A  B": "A B",
    " Olinda　": "OLINDA",
    "\x1cOlinda\x85": "OLINDA",
    "Nº 1ª": "No 1a",
    "½": "12",
    "straße": "STRASSE",
    "Caruaru –": "CARUARU ",
    "São": "SAO",
    "(Olinda) *?": "OLINDA",
    "": "",
    None: None,
}


def test_normalize_name_by_hand(values):
    assert values(normalize_name, list(NAMES)) == list(NAMES.values())


def test_ascii_fold_equals_unicode_decomposition(values):
    rng = random.Random(7)
    blocks = [
        (0x20, 0x250), (0x300, 0x370), (0x1E00, 0x2190), (0x2460, 0x2500), (0x3000, 0x3400),
        (0xFB00, 0xFB10), (0xFF00, 0xFFEF), (0x1D400, 0x1D800), (0x1F100, 0x1F200),
    ]
    pool = [chr(c) for low, high in blocks for c in range(low, high)]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(1500)]
    expected = [
        unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts
    ]
    assert values(ascii_fold, texts) == expected


def test_search_is_a_regular_expression_and_null_never_matches(values):
    names = ["OLINDA", "PAULISTA", None, "Água"]
    assert values(lambda c: matches(c, "oli|aul"), names) == [True, True, False, False]
    assert values(lambda c: matches(c, "água"), names) == [False, False, False, True]
    assert values(lambda c: matches(c, ""), names) == [True] * 4
    assert values(lambda c: matches(c, "O.I", literal=True), names) == [False] * 4
    assert values(lambda c: matches(c, "lind", literal=True), names) == [True, False, False, False]


def test_year_suffix(values):
    assert values(lambda c: year_suffix(c, "ideb_"), ["ideb_2005", "ideb_2023"]) == [2005, 2023]


def test_na_tokens_match_whole_fields_only(values):
    fields = ["-", "--", "", "NA", "null", " - ", "---", "Nulo", "0", None]
    expected = [None] * 5 + [" - ", "---", "Nulo", "0", None]
    assert values(na_map, fields) == expected
    assert values(lambda c: na_map(c, ("NA",)), ["-", "NA"]) == ["-", None]


def test_coerce_numeric(values):
    fields = ["1.5", " 2 ", "3e2", "1,5", "1.5d", "2F", "-", "NaN", "0x10", "0x1p3", "1_000", None]
    expected = [1.5, 2.0, 300.0] + [None] * 9
    assert values(coerce_numeric, fields) == expected
    assert values(coerce_numeric, ["inf", "-inf"]) == [float("inf"), float("-inf")]


def test_parse_number_fails_on_text(spark, values):
    assert values(lambda c: parse_number(c, "x"), ["4.5", None]) == [4.5, None]
    with pytest.raises(Exception, match="x is not a number: abc"):
        values(lambda c: parse_number(c, "x"), ["abc"])


def test_parse_key(values):
    keys = ["3550308", "3550308.0", "9007199254740993", None]
    assert values(parse_key, keys) == [3550308, 3550308, 9007199254740993, None]
    with pytest.raises(Exception, match="not a key: Fonte"):
        values(parse_key, ["Fonte: censo"])


def test_ratio(spark):
    rows = [(6.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, None), (None, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    result = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert result == [3.0, float("inf"), float("-inf"), None, None, None]


def test_rounding_half_even_on_the_binary_product(values):
    numbers = [0.125, 1.005, 2.665, 5.015, None]
    assert values(round_half_even, numbers, "double") == [0.12, 1.0, 2.66, 5.01, None]


def test_two_decimal_labels_round_the_exact_value(values):
    rng = random.Random(3)
    numbers = [5.125, 2.665, 1.005, 5.015, 0.125, -1.005, 0.0, 7.0, 123456.785]
    numbers += [rng.randint(0, 10**6) / 1000 for _ in range(2000)]
    assert values(fixed_decimals, numbers, "double") == [f"{x:.2f}" for x in numbers]
    assert values(fixed_decimals, [None], "double") == [None]


def test_thousands(values):
    assert values(thousands, [1234567, 999, 0], "long") == ["1.234.567", "999", "0"]


def test_plain_number_reads_like_a_csv_export(values):
    numbers = [0.0, 1.5, 12345678.9, 1e7, 123456789012345.0, 0.00025, -2.5e9, 1e16]
    expected = [repr(x) for x in numbers[:-1]] + ["1.0E16"]
    assert values(plain_number, numbers, "double") == expected
    assert values(plain_number, [float("inf"), None], "double") == ["inf", None]
