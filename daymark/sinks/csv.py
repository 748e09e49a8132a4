"""CSV output with a running row number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.session import ensure_checkpoint_dir

INDEX_COLUMN = "_c0"
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position in the partition below


def with_row_index(df: DataFrame, order_by: Sequence[Column | str], index: str = INDEX_COLUMN) -> DataFrame:
    """``df`` in the given order, led by a gapless row number from 0.

    The sort leaves ordered ranges, one per partition. They are checkpointed, which fixes which row is where; a range's
    first number is then the number of rows in the ranges before it, a running sum over one row per partition.
    ``order_by`` should decide between any two rows that differ, both for a stable numbering and to keep ranges even.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    placed = df.orderBy(*order_by).checkpoint().withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumns(
        {
            "_range": F.shiftright("_place", _POSITION_BITS).cast("int"),
            "_position": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    starts = placed.groupBy("_range").count().select("_range", start)
    numbered = placed.join(F.broadcast(starts), "_range")  # one row per partition
    return numbered.select((F.col("_start") + F.col("_position")).alias(index), *df.columns)


def write_csv_indexed(df: DataFrame, path: str, order_by: Sequence[Column | str], index: str = INDEX_COLUMN) -> None:
    """CSV files with a header and a leading row number; file names follow the order of the rows."""
    with_row_index(df, order_by, index).write.mode("overwrite").option("header", True).csv(path)
