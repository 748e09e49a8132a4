"""Looking at physical plans."""

from __future__ import annotations

import re
from contextlib import contextmanager


@contextmanager
def settings(spark, **values):
    """SQL settings for the length of a block; ``__`` stands for a dot."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    """Text of the physical plan, before anything has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_plan(df_of, spark):
    """Plan as it is when no side is small enough to broadcast."""
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"
    ):
        return plan_of(df_of())


def count(plan, operator):
    return len(re.findall(rf"(?:^|[ )]){re.escape(operator)}(?= |\(|$)", plan, re.MULTILINE))


def scans(plan):
    """Columns read and filters pushed down, per scan."""
    found = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            columns = re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line).group(1)
            found.append(({c.split("#")[0] for c in columns.split(",") if c}, pushed))
    return found
