"""Wide measures to long indicator rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def measures_to_rows(df: DataFrame, measures: Mapping[str, tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """One row per measure the frame has; ``measures`` maps a column to its indicator and unit.

    One pass over the input. Null measures give no row.
    """
    present = [m for m in measures if m in df.columns]
    cells = F.array(*[
        F.struct(F.lit(measures[m][0]).alias("indicador"), F.lit(measures[m][1]).alias("unidad"),
                 F.col(m).try_cast("double").alias("valor")) for m in present])
    return df.select(*keep, F.inline(cells)).filter(F.col("valor").isNotNull())
