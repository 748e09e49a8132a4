"""Run a statement kept in a file and publish its rows: ``python -m daymark.statement day.sql --root <folder> --view <name>``.

Parameters are given as ``--arg day=28``; a value that reads as a whole number or a decimal one is bound as a number, any
other as text. ``--text name=007`` binds text as it stands. In the statement they are ``:day``, and ``IDENTIFIER(:table)``
for a name. ``--input name=<folder>`` makes a Parquet folder readable under a name.
"""

from __future__ import annotations

import argparse
import logging
import re
import time
from pathlib import Path

from pyspark.sql import SparkSession

from daymark.plans import run_file
from daymark.sinks import publish_version, swap_table

_NUMBER = re.compile(r"[+-]?\d+(\.\d+)?")


def _pair(text: str) -> tuple[str, str]:
    name, sign, value = text.partition("=")
    if not sign or not name.isidentifier():
        raise argparse.ArgumentTypeError(f"{text}: expected NAME=VALUE")
    return name, value


def _value(text: str) -> int | float | str:
    if not _NUMBER.fullmatch(text):
        return text
    return float(text) if "." in text else int(text)


def parse(argv: list[str] | None) -> argparse.Namespace:
    options = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    options.add_argument("statement", type=Path, help="file that holds one statement")
    options.add_argument("--arg", action="append", default=[], type=_pair, metavar="NAME=VALUE")
    options.add_argument("--text", action="append", default=[], type=_pair, metavar="NAME=VALUE")
    options.add_argument("--input", action="append", default=[], type=_pair, metavar="NAME=FOLDER")
    options.add_argument("--root", required=True, help="folder that holds the versions of the result")
    target = options.add_mutually_exclusive_group(required=True)
    target.add_argument("--view", help="view to point at the new version")
    target.add_argument("--replace", metavar="TABLE", help="external table to replace under its own name")
    chosen = options.parse_args(argv)
    names = [name for name, _ in chosen.arg + chosen.text]
    if twice := sorted({name for name in names if names.count(name) > 1}):
        options.error(f"given twice: {', '.join(twice)}")
    return chosen


def main(argv: list[str] | None = None) -> str:
    chosen = parse(argv)
    spark = SparkSession.builder.appName(chosen.statement.stem).getOrCreate()
    for name, folder in chosen.input:
        spark.read.parquet(folder).createOrReplaceTempView(name)
    bound = {name: _value(text) for name, text in chosen.arg} | dict(chosen.text)
    started = time.monotonic()
    rows = run_file(spark, chosen.statement, **bound)
    if chosen.replace:
        path = swap_table(rows, chosen.replace, chosen.root)
    else:
        path = publish_version(rows, chosen.root, chosen.view)
    logging.getLogger(__name__).info("%s: %s after %.1f seconds", chosen.statement, path, time.monotonic() - started)
    return path


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
