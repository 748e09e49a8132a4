"""Run time of one query."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame

logger = logging.getLogger(__name__)


def elapsed(df: DataFrame, name: str = "query") -> float:
    """Seconds to compute every row and column of ``df`` without storing any."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - started
    logger.info("%s ran for %.3f seconds", name, seconds)
    return seconds
