"""Cleaning rules for dirty string columns.

Every rule yields NULL for text it cannot read, also under ANSI mode, and stays
free of lambdas so that the projection keeps whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from marketlens.functions.columns import ColumnLike, as_column

# The date shapes, in matching order, and the noise inside lists.
DATE_SHAPES = (
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}$", "yyyy/M"),
)
LIST_NOISE = r"\([^)]*\)|[;*]"
TRADE_MARKS = "®™"
INTEGER_TEXT = r"^-?\d+$"


def is_integer_text(text: ColumnLike) -> Column:
    return as_column(text).rlike(INTEGER_TEXT)


def cents_to_units(cents: ColumnLike) -> Column:
    """Integer text of cents -> double amount."""
    return as_column(cents).try_cast("bigint") / 100


def parse_date_shapes(text: ColumnLike, shapes: Sequence[tuple[str, str]] = DATE_SHAPES) -> Column:
    """Parse with the format of the first shape that matches; NULL when none does."""
    text = as_column(text)
    # Each pattern is anchored, so a row meets one branch at most.
    return F.coalesce(*[F.when(text.rlike(shape), F.try_to_date(text, fmt)) for shape, fmt in shapes])


def split_list(text: ColumnLike, separator: str = ",", noise: str = LIST_NOISE) -> Column:
    """Separated text -> array of trimmed, non-empty labels in order of first appearance."""
    bare = F.trim(F.regexp_replace(as_column(text), noise, ""))
    # Blanks around a separator belong to it: labels come out trimmed without a per-element lambda.
    labels = F.split(bare, f" *{re.escape(separator)} *")
    return F.array_distinct(F.array_remove(labels, ""))


def normalise_name(text: ColumnLike, marks: str = TRADE_MARKS) -> Column:
    """Drop trade-mark signs, squeeze white space, blank -> NULL. Names are never merged or split."""
    unmarked = F.translate(as_column(text), marks, "")
    return F.nullif(F.trim(F.regexp_replace(unmarked, r"\s+", " ")), F.lit(""))


def parse_bracket(text: ColumnLike) -> tuple[Column, Column, Column]:
    """``"20,000 .. 50,000"`` -> lower bound, upper bound, midpoint."""
    digits = F.translate(as_column(text), ",", "")
    low = F.regexp_extract(digits, r"^(\d+)", 1).try_cast("long")
    high = F.regexp_extract(digits, r"\.\.\s*(\d+)$", 1).try_cast("long")
    return low, high, (low + high) / 2


def parse_bounded_int(text: ColumnLike, low: int, high: int) -> Column:
    """First integer inside the text, NULL when it lies outside ``low..high``."""
    number = F.regexp_extract(as_column(text), r"(\d+)", 1).try_cast("int")
    return F.when(number.between(low, high), number)


def json_to_map(text: ColumnLike, value_type: str = "bigint") -> Column:
    """JSON object with an open key set -> map column."""
    return F.from_json(as_column(text), f"map<string,{value_type}>")


def flags_from_struct(struct: str, names: Sequence[str], total: str) -> dict[str, Column]:
    """One boolean column per struct field plus the number of true ones, for ``withColumns``."""
    flags = {name: F.col(f"{struct}.{name}") for name in names}
    ones = [flag.cast("int") for flag in flags.values()]
    return {**flags, total: sum(ones[1:], ones[0])}
