"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """One row per distinct ``keys`` (NULL is a key of its own): the one with the highest ``order_col``.

    ``where`` acts before the pick. Ties are settled by ``tie_breakers``, descending, so the pick does not depend on
    how the rows are spread. A NULL ``order_col`` counts as the highest value, as in the dialect the query comes from.

    ``row_number`` filtered to 1 becomes a group limit on both sides of the shuffle: each task sends at most one row
    per key, so a key that holds a third of the rows costs no more to move than any other.
    """
    if not tie_breakers:
        raise ValueError("latest_per_key needs tie breakers, else the picked row is not determined")
    rows = df if where is None else df.where(where)
    newest_first = Window.partitionBy(*keys).orderBy(
        F.desc_nulls_first(order_col), *[F.desc_nulls_last(c) for c in tie_breakers]
    )
    return rows.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") == 1).drop("_rank")


class Group(NamedTuple):
    """Rows that meet ``where``, picked per ``key``."""

    where: Column
    key: str


def latest_per_group(
    df: DataFrame, groups: Sequence[Group], order_col: str, tie_breakers: Sequence[str]
) -> list[DataFrame]:
    """``latest_per_key`` for several groups of rows that exclude each other, from one scan and one shuffle.

    A row is tagged with the first group whose condition it meets, and with its key there; rows of no group are dropped.
    The frames that come back read the same pick, and Spark runs an exchange that occurs twice in a plan once. To keep it
    the same in all of them, a filter on the group, or one that a join infers for the key, must not sink below the pick,
    where it would make two scans of one: the pick goes by copies of both. For the same reason every group orders by the
    same columns, the key last, where it decides nothing but is read by all. Frames hold the key, under the name of the
    group's, and the columns ordered by.
    """
    if not tie_breakers:
        raise ValueError("latest_per_group needs tie breakers, else the picked row is not determined")
    tag = key = None
    for number, group in enumerate(groups):
        tag = F.when(group.where, number) if tag is None else tag.when(group.where, number)
        key = F.when(group.where, F.col(group.key)) if key is None else key.when(group.where, F.col(group.key))
    columns = list(dict.fromkeys([order_col, *tie_breakers]))
    tagged = df.where(reduce(or_, [group.where for group in groups])).select(
        tag.alias("_group"), tag.alias("_group_copy"), key.alias("_key"), key.alias("_key_copy"), *columns
    )
    picked = latest_per_key(tagged, ["_group_copy", "_key_copy"], order_col, [*tie_breakers, "_key"])
    return [
        picked.where(F.col("_group") == number).select(F.col("_key").alias(group.key), *[c for c in columns if c != group.key])
        for number, group in enumerate(groups)
    ]
