"""Doubles as 64-bit integers in the same order."""

from __future__ import annotations

import sys

from pyspark.sql import Column, functions as F

from marketlens.functions.columns import ColumnLike, as_column

_FRACTION = 51
_LEAST_EXPONENT = -1075


def order_key(value: ColumnLike) -> Column:
    """A long for a double: of two doubles, the larger never has the smaller one.

    The whole part of the logarithm stands above 51 bits of what is left, so only a few
    neighbouring doubles share a key. The logarithm may be rounded up next to a power of two;
    as it never falls where the value rises, the order stays. Infinity and NaN share the key
    of the largest double.
    """
    x = as_column(value).cast("double")
    size = F.least(F.abs(x), F.lit(sys.float_info.max))
    exponent = F.floor(F.log2(size))
    rest = (size / F.pow(F.lit(2.0), exponent) - 1) * 2.0**_FRACTION
    key = (exponent - _LEAST_EXPONENT) * F.lit(1 << _FRACTION) + F.floor(rest)
    # There is no logarithm of zero.
    key = F.coalesce(key, F.when(x == 0, F.lit(0).cast("long")))
    return F.when(x < 0, -key).otherwise(key)
