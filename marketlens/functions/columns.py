from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_column(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column
