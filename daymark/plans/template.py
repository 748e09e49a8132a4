"""Parametrised SQL text."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from daymark.functions import lowercase_columns


def run_template(spark: SparkSession, text: str, /, **args: Any) -> DataFrame:
    """Result of a statement with named parameters, ``:day`` for a value, ``IDENTIFIER(:table)`` for a name.

    Parameters are bound, not pasted into the text. Column names come back in lower case.
    """
    return lowercase_columns(spark.sql(text, args=args))


def run_file(spark: SparkSession, path: str | Path, /, **args: Any) -> DataFrame:
    """``run_template`` on a statement kept in a file."""
    return run_template(spark, Path(path).read_text(encoding="utf-8"), **args)
