from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c
