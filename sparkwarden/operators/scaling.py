"""Min-max scaling over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: keeps the denominator above zero.
EPSILON = 1e-9


def min_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """Scale to [0, 1]. The bounds come from one aggregate over the table, so ``df`` is read twice."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("bounds")).scalar()
    low, high = bounds["lo"], bounds["hi"]
    return df.withColumn(out, (F.col(column) - low) / (high - low + F.lit(EPSILON)))
