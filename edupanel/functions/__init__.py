from edupanel.functions.numbers import (
    coerce_numeric,
    fixed_decimals,
    na_map,
    parse_key,
    plain_number,
    ratio,
    round_half_even,
    thousands,
)
from edupanel.functions.text import matches, normalize_name, year_suffix

__all__ = [
    "coerce_numeric", "fixed_decimals", "matches", "na_map", "normalize_name", "parse_key",
    "plain_number", "ratio", "round_half_even", "thousands", "year_suffix",
]
