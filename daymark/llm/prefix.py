"""Running totals over frames of any size, in two passes: totals of ordered ranges, then rows within a range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.session import stored


def prefix_sums(df: DataFrame, within: Sequence[str], by: Sequence[str], measure: str, name: str) -> DataFrame:
    """``df`` with the sum of ``measure`` over the rows before this one, as ``name``: per value of ``within``, in the order ``by``.

    Rows are dealt out by ranges of ``within`` and ``by``, so that a value of ``within`` with very many rows covers many
    ranges, and stored, which fixes who lies where. The first pass sums each range; a range's start is the sum of those
    before it, a window over as many rows as there are ranges. The second pass runs within the ranges. ``within`` must
    not be NULL. Rows that are equal in ``within`` and ``by`` may swap their sums.
    """
    ranged = df.repartitionByRange(*within, *by).withColumn("_range", F.spark_partition_id())
    placed = stored(ranged)
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*within, "_range").agg(F.sum(measure).alias("_total"))
    starts = totals.select(*within, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    before = Window.partitionBy(*within, "_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.coalesce(F.sum(measure).over(before), F.lit(0)))
    joined = inside.join(starts, [*within, "_range"])
    return joined.select(*df.columns, (F.col("_start") + F.col("_inside")).alias(name))
