"""Value of a measure on one day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_at(
    df: DataFrame,
    key: str,
    day_col: str,
    day: int,
    value: str,
    out: str,
    scale: float | None = None,
    label: str | None = None,
) -> DataFrame:
    """``key`` and ``value`` (times ``scale``) of the rows measured on ``day``, with a constant ``phase`` label."""
    measure = F.col(value) if scale is None else F.col(value) * scale
    columns = [F.col(key), measure.alias(out)]
    if label is not None:
        columns.append(F.lit(label).alias("phase"))
    return df.where(F.col(day_col) == day).select(*columns)
