"""One-row frames as values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame) -> Column:
    """The row of a one-row frame as a struct for use in any expression: a scalar subquery, so the plan stays lazy and
    nothing is joined."""
    return df.select(F.struct(*df.columns)).scalar()
