"""Group sums and distinct rows; both combine within each task before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sum(
    df: DataFrame, keys: Sequence[str | Column], measure: str, out: str, label: Column | None = None
) -> DataFrame:
    """Sum of ``measure`` per group (NULL for a group without values); ``label`` is computed once per group."""
    summed = df.groupBy(*keys).agg(F.sum(measure).alias(out))
    return summed if label is None else summed.withColumn("phase", label)


def distinct_rows(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Distinct combinations of ``columns``, which may be computed ones."""
    return df.select(*columns).distinct()
