"""Output normalisation shared by registered queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE_PLACES = 6


def round_doubles(df: DataFrame, places: int = DOUBLE_PLACES) -> DataFrame:
    """Round every double column to ``places`` decimals.

    Sums and averages of doubles depend on the order of addition, which
    differs between engines and partitionings; rounding both sides the same
    way makes results comparable (the oracle SQL rounds identically).
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
