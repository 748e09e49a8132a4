"""Left joins of one base with a list of sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MET = "_has_partner"
_RIGHT = "_right_"


class Side(NamedTuple):
    """A source to join: ``left_keys[i]`` of the base must equal ``right_keys[i]`` of ``df``.

    ``unique`` says that ``df`` has at most one row per key, so it cannot multiply the base and is joined as it is.
    """

    df: DataFrame
    left_keys: Sequence[str]
    right_keys: Sequence[str]
    unique: bool = False

    def renamed(self) -> DataFrame:
        return self.df.withColumnsRenamed(dict(zip(self.right_keys, self.left_keys, strict=True)))


def split_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], known: DataFrame | None = None, number: int = 0
) -> DataFrame:
    """``left.join(right, keys, 'left')`` in a form that AQE can split on both sides.

    AQE splits the left side of a skewed left join, never the right one, but either side of an inner join. So keys without
    partner get a row of NULLs on the right, and the join becomes an inner one. They are found by one aggregate over the
    keys of both sides, which combines before its shuffle, so that it moves a heavy key once per task.

    ``known`` holds all keys of ``left``, if a smaller frame than ``left`` does. ``number`` tells joins by the same keys
    apart: the hash in the join condition makes Spark shuffle both sides for this join, and only then can AQE split them.
    """
    partners = right.dropna(subset=list(keys))
    known = left if known is None else known
    marks = known.select(*keys, F.lit(False).alias(_MET)).union(partners.select(*keys, F.lit(True)))
    alone = marks.groupBy(*keys).agg(F.max(_MET).alias(_MET)).where(~F.col(_MET)).drop(_MET)
    padded = partners.unionByName(alone, allowMissingColumns=True)
    padded = padded.withColumnsRenamed({key: _RIGHT + key for key in keys})
    names = [_RIGHT + key for key in keys]
    conditions = [F.xxhash64(F.lit(number), *keys) == F.xxhash64(F.lit(number), *names)]
    conditions += [F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, names, strict=True)]
    return left.join(padded, reduce(and_, conditions)).drop(*names)


def join_sources(base: DataFrame, sides: Sequence[Side]) -> DataFrame:
    """``base`` left-joined with every side; right keys are dropped, so no name is ambiguous.

    Sides with one row per key come first: those that share a key then need one shuffle of the base, and rows of a heavy
    key, or of none, are the left side's, which AQE splits. The others follow through ``split_left_join``. Broadcasts
    are the planner's, by measured size. There is one lazy plan for all sizes; nothing runs while it is built.
    """
    taken = set(base.columns)
    for side in sides:
        added = set(side.df.columns) - set(side.right_keys)
        if taken & added:
            raise ValueError(f"ambiguous columns in the join: {sorted(taken & added)}")
        taken |= added
    if reserved := [name for name in taken if name == _MET or name.startswith(_RIGHT)]:
        raise ValueError(f"columns with names that the join uses itself: {sorted(reserved)}")
    joined = base
    for side in sides:
        if side.unique:
            joined = joined.join(side.renamed(), list(side.left_keys), "left")
    for number, side in enumerate(sides):
        if not side.unique:
            joined = split_left_join(joined, side.renamed(), list(side.left_keys), base, number)
    added = [c for side in sides for c in side.df.columns if c not in side.right_keys]
    return joined.select(*base.columns, *added)
