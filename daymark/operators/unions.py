"""Stacking of result sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def stack(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both frames under each other, copies kept, after a check that names and types agree."""
    top, bottom = first.select(*columns), second.select(*columns)
    for a, b in zip(top.schema, bottom.schema, strict=True):
        if a.dataType != b.dataType:
            raise TypeError(f"{a.name} is {a.dataType.simpleString()} above and {b.dataType.simpleString()} below")
    return top.unionByName(bottom)


def union_distinct(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both frames under each other, every row once, NULLs equal to each other.

    Copies collapse within each task before the shuffle, and the shuffle key is the whole row, so neither a large
    group of copies nor a frequent value of one column ends up in a single task.
    """
    return stack(first, second, columns).distinct()
