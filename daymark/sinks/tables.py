"""Storing a result as a table that replaces the previous one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def by_start_date(df: DataFrame) -> DataFrame:
    """Rows by start date, rows without one last.

    The other columns only settle ties: Spark cuts a sort into ranges of the sort key, and with the date alone all rows
    of a frequent date (or of none) would fall into one range and so into one task.
    """
    rest = [F.asc_nulls_last(c) for c in df.columns if c != "effective_start_date"]
    return df.orderBy(F.asc_nulls_last("effective_start_date"), *rest)


def replace_table(
    df: DataFrame,
    name: str,
    sort: Sequence[Column | str] | None = None,
    path: str | None = None,
    atomic: bool = False,
) -> None:
    """Replace a table of the session catalog (managed, or stored at ``path``) by the rows of ``df``.

    ``atomic`` asks the table's catalog to replace it under its own name, all or nothing; readers see the old rows until
    the new ones are whole. Catalogs that cannot do that refuse. Without it ``df`` must not read the table it replaces,
    and readers may see the table missing; ``swap_table`` and ``publish_version`` have neither limit.
    """
    rows = df if sort is None else df.orderBy(*sort)
    if atomic:
        if path is not None:
            raise ValueError("a catalog that replaces tables whole chooses their place")
        rows.writeTo(name).createOrReplace()
        return
    writer = rows.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def swap_table(df: DataFrame, name: str, root: str) -> str:
    """Replace the rows of the external Parquet table ``name`` by those of ``df``, under its own name, in one metadata step.

    The rows are written to a new folder below ``root`` first; then the table's place is set to it. Readers that start
    before that step see the old rows, later ones the new, and none finds the table missing. A job that fails leaves the
    table as it was, and the plan may read the table it replaces. The table is made if there is none. Its columns must be
    those of ``df``, in this order; it may be neither managed, since the catalog owns the folder of such a table, nor
    partitioned. Returns the new folder; the old one is left to the storage's retention rules.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    old = _external_place(spark, name, df) if exists else None
    path = _new_version(root, name.replace("`", "").rpartition(".")[2])
    df.write.mode("errorifexists").parquet(path)
    if not exists:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)}")
        return path
    try:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(name)
    except Exception:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(old)}")
        spark.catalog.refreshTable(name)
        raise
    return path


def _external_place(spark: SparkSession, name: str, df: DataFrame) -> str:
    """Where the table lies, after a check that it can be pointed at rows like those of ``df``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()  # a row per column and property
    about = {row["col_name"]: row["data_type"] for row in described}
    if about.get("Type") != "EXTERNAL" or about.get("Provider", "").lower() != "parquet":
        raise ValueError(f"{name} is no external Parquet table: {about.get('Type')}, {about.get('Provider')}")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        raise ValueError(f"{name} is partitioned: its partitions have places of their own")
    held = [(field.name, field.dataType) for field in spark.table(name).schema]
    if held != [(field.name, field.dataType) for field in df.schema]:
        raise ValueError(f"{name} has other columns than the rows that are to replace its own")
    return about["Location"]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _new_version(root: str, name: str) -> str:
    now = datetime.now(UTC).strftime("%Y%m%dT%H%M%S")
    return f"{root}/{name}/version={now}-{uuid.uuid4().hex[:12]}"


def publish_version(df: DataFrame, root: str, view: str) -> str:
    """Write ``df`` as a new version below ``root`` and only then point ``view`` at it; returns the version's path.

    A job that fails leaves the view on the version before, and the plan may read that version. The version's name begins
    with its time (UTC); the live one is the one the view's definition names, which need not be the newest folder.
    """
    path = _new_version(root, view)
    df.write.mode("errorifexists").parquet(path)
    columns = ", ".join(f"`{column}`" for column in df.columns)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{path}`")
    return path
