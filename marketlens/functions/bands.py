"""Bands over a measure.

Group by ``rank`` (a small integer) and call ``label`` on the aggregated rows: the
shuffle then carries no label text and the rank is the sort key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from marketlens.functions.columns import ColumnLike, as_column


@dataclass(frozen=True)
class Bands:
    """``edges`` are exclusive upper limits; ``labels`` holds one label more.

    ``first`` names a band taken by a predicate before any edge is looked at.
    ``missing`` names a band for NULL; without it NULL falls into the last band.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    first: str | None = None
    missing: str | None = None

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("bands need one label more than edges")

    @property
    def all_labels(self) -> tuple[str, ...]:
        head = () if self.first is None else (self.first,)
        tail = () if self.missing is None else (self.missing,)
        return head + self.labels + tail

    def rank(self, value: ColumnLike, first: Column | None = None) -> Column:
        value = as_column(value)
        if (first is None) != (self.first is None):
            raise ValueError("a first band needs both its label and its predicate")
        branches = [] if first is None else [first]
        branches += [value < edge for edge in self.edges]
        if self.missing is not None:
            branches.append(value.isNotNull())
        chain = F.when(branches[0], 0)
        for position, branch in enumerate(branches[1:], start=1):
            chain = chain.when(branch, position)
        return chain.otherwise(len(branches))

    def label(self, rank: ColumnLike) -> Column:
        return F.element_at(F.array(*[F.lit(text) for text in self.all_labels]), as_column(rank) + 1)


# The bands of the market study.
PRICE_BANDS = Bands(
    (5, 10, 20, 40), ("under $5", "$5-10", "$10-20", "$20-40", "$40+"), first="free", missing="unknown"
)
GROUP_SIZE_BANDS = Bands((2, 6, 21), ("1 game", "2-5 games", "6-20 games", "21+ games"))
LIST_LENGTH_BANDS = Bands(
    (2, 5, 10, 15, 21), ("1", "2-4", "5-9", "10-14", "15-20", "21+"), missing="unknown"
)
REVIEW_BANDS = Bands(
    (10, 100, 1000, 10000), ("1-9", "10-99", "100-999", "1 000-9 999", "10 000+")
)
AGE_BANDS = Bands((1, 16), ("none declared", "1-15", "16+"), missing="unparsed")
