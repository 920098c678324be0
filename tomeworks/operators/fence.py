"""Keeping costly expressions from being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, others: list[str], **columns: Column) -> DataFrame:
    """``df.select(others, columns)`` with the columns computed once per row.

    A later filter on a computed column is normally pushed below the projection,
    where the whole expression is evaluated a second time.  Passing the columns
    through a one-element array that is taken apart again stops that, while
    filters on ``others`` still reach the scan.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select(*others, F.inline_outer(packed))
