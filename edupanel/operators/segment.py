"""Bands with fixed limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_bands(
    value: Column, limits: Sequence[float], labels: Sequence[str], undefined: str
) -> Column:
    """First label up to and including the first limit, and so on; missing is ``undefined``."""
    if len(labels) != len(limits) + 1:
        raise ValueError("one more label than limits is needed")
    band = F.when(value <= limits[0], labels[0])
    for limit, label in zip(limits[1:], labels[1:-1]):
        band = band.when(value <= limit, label)
    return band.when(value > limits[-1], labels[-1]).otherwise(undefined)
