"""Build the endpoint and publish it: ``python -m daymark.job --inputs <folder> --root <folder> --view <name>``."""

from __future__ import annotations

import argparse
import logging
import time

from pyspark.sql import DataFrame, SparkSession

from daymark import constants as C
from daymark.plans import build_endpoint
from daymark.session import apply_unless_set, folder_bytes, fresh_folder, remove_folder, shuffle_settings
from daymark.sinks import by_start_date, publish_version, swap_table
from daymark.sources import SCHEMAS, from_catalog, from_parquet


def parse(argv: list[str] | None) -> argparse.Namespace:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--inputs", help="folder with one Parquet file or folder per input; default: catalog tables")
    options.add_argument("--table", action="append", default=[], metavar="INPUT=NAME", help="catalog name of an input")
    options.add_argument("--root", required=True, help="folder that holds the versions of the result")
    target = options.add_mutually_exclusive_group()
    target.add_argument("--view", default="endpoint_metrics", help="view to point at the new version")
    target.add_argument("--replace", metavar="TABLE", help="external table to replace under its own name instead")
    options.add_argument("--horizon", type=int, default=C.HORIZON_DAY, help="day of the measured and forecast values")
    options.add_argument("--title-delimiters", default=C.WORD_ENDS, help="characters that end a word in title case")
    options.add_argument("--unsorted", action="store_true", help="publish the rows in the order they come")
    chosen = options.parse_args(argv)
    if chosen.inputs and chosen.table:
        options.error("--inputs and --table exclude each other")
    names = {}
    for pair in chosen.table:
        name, sign, table = pair.partition("=")
        if not sign or not table or name not in SCHEMAS:
            options.error(f"--table {pair}: expected INPUT=NAME with one of {', '.join(SCHEMAS)}")
        if name in names:
            options.error(f"--table {pair}: {name} is given twice")
        names[name] = table
    chosen.table = names
    return chosen


def main(argv: list[str] | None = None) -> str:
    chosen = parse(argv)
    spark = SparkSession.builder.appName("endpoint_metrics").getOrCreate()
    if chosen.inputs:
        tables = from_parquet(spark, chosen.inputs)
        size = folder_bytes(spark, chosen.inputs)
        apply_unless_set(spark, shuffle_settings(size, spark.sparkContext.defaultParallelism))
    else:  # the size of catalog tables is not known without statistics; the session's settings hold
        tables = from_catalog(spark, chosen.table)
    started = time.monotonic()
    endpoint = build_endpoint(tables, chosen.horizon, chosen.title_delimiters)

    def publish(rows: DataFrame) -> str:
        if chosen.replace:
            return swap_table(rows, chosen.replace, chosen.root)
        return publish_version(rows, chosen.root, chosen.view)

    if chosen.unsorted:
        path = publish(endpoint)
    else:
        # A range sort reads its input twice, so the joins are stored first.
        stage = fresh_folder(spark, "endpoint")
        try:
            endpoint.write.parquet(stage)
            rows = spark.read.schema(endpoint.schema).parquet(stage)
            path = publish(by_start_date(rows))
        finally:
            remove_folder(spark, stage)
    logging.getLogger(__name__).info("published %s after %.1f seconds", path, time.monotonic() - started)
    return path


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
