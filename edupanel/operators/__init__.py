from edupanel.operators.fingerprint import fingerprint
from edupanel.operators.keys import assert_unique, check_unique, dedup_keep_first, drop_null_keys
from edupanel.operators.profile import ObservedProfile, profile
from edupanel.operators.quantiles import (
    ChangedInputError,
    DuplicateEdgesError,
    approximate_quantiles,
    bracketed_quantiles,
    exact_quantiles,
    quantile_bands,
)
from edupanel.operators.replicate import at_last_year, replicate_forward
from edupanel.operators.reshape import densify, unpivot_years, wide_by_value, wide_to_long
from edupanel.operators.segment import fixed_bands

__all__ = [
    "ChangedInputError", "DuplicateEdgesError", "ObservedProfile", "approximate_quantiles", "assert_unique", "at_last_year",
    "bracketed_quantiles", "check_unique",
    "dedup_keep_first", "densify", "drop_null_keys", "exact_quantiles", "fingerprint", "fixed_bands",
    "profile", "quantile_bands", "replicate_forward", "unpivot_years", "wide_by_value",
    "wide_to_long",
]
