"""Stored results: replaced whole, numbered without gaps, ordered."""

from __future__ import annotations

import csv
import random
import threading
import time
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daymark.job import main
from daymark.plans import build_endpoint
from daymark.queries import SNAPSHOT_SQL
from daymark.session import fresh_folder, scratch, shared_folder, shuffle_settings, stored
from daymark.sinks import by_start_date, publish_version, replace_table, swap_table, write_csv_indexed
from daymark.sinks.csv import with_row_index
from daymark.sources import SCHEMAS, from_catalog, from_parquet, from_values
from daymark.statement import main as run_statement
from daymark.timing import elapsed
from tests import golden
from tests.plans import settings


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def lines_of(path):
    """Data lines of the part files in name order, each file without its header."""
    found, headers = [], set()
    for part in sorted(Path(path).glob("part-*.csv")):
        with part.open() as file:
            header, *lines = csv.reader(file)
        headers.add(tuple(header))
        found += [tuple(line) for line in lines]
    return headers, found


def test_csv_of_a_literal_table(spark, tmp_path):
    df = from_values(spark, [1, 2, 3, 4, 5], "a")
    write_csv_indexed(df, str(tmp_path / "out"), ["a"])
    headers, lines = lines_of(tmp_path / "out")
    assert headers == {("_c0", "a")}
    assert lines == [("0", "1"), ("1", "2"), ("2", "3"), ("3", "4"), ("4", "5")]


def test_csv_indexed_over_many_partitions(spark, tmp_path):
    numbers = list(range(5000))
    random.Random(3).shuffle(numbers)
    df = spark.createDataFrame([(n // 2, n) for n in numbers], "half int, n int").repartition(13)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        assert with_row_index(df, ["n"]).rdd.getNumPartitions() > 1
        write_csv_indexed(df, str(tmp_path / "out"), ["n"])
    assert len(list((tmp_path / "out").glob("part-*.csv"))) > 1
    headers, lines = lines_of(tmp_path / "out")
    assert headers == {("_c0", "half", "n")}
    assert lines == [(str(n), str(n // 2), str(n)) for n in range(5000)]


def test_row_index_of_nothing(spark):
    empty = spark.createDataFrame([], "a bigint")
    assert rows_of(with_row_index(empty, ["a"])) == []


def test_replace_table(spark, tmp_path):
    result = build_endpoint(golden.in_memory(spark))
    for round_number in (1, 2):
        path = str(tmp_path / f"table-{round_number}")
        replace_table(by_start_date(result), "replaced_endpoint", path=path)
        assert set(rows_of(spark.table("replaced_endpoint"))) == golden.EXPECTED
    replace_table(result.limit(0), "replaced_endpoint", path=str(tmp_path / "table-3"))
    assert spark.table("replaced_endpoint").count() == 0
    spark.sql("DROP TABLE replaced_endpoint")


def place_of(spark, table):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row["col_name"]: row["data_type"] for row in described}["Location"]


def test_swap_table_is_never_missing_and_never_half(spark, tmp_path):
    """A reader in a loop meets whole versions only, while the table is replaced under its own name."""
    name, root = "swapped_numbers", str(tmp_path / "it's here")
    swap_table(spark.range(1000).select(F.lit(0).alias("version"), F.col("id")), name, root)
    seen, failures, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                (row,) = spark.table(name).agg(F.min("version"), F.max("version"), F.count("*")).collect()
                seen.add(tuple(row))
            except Exception as error:
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for version in range(1, 5):
        rows = spark.range(1000 + version).select(F.lit(version).alias("version"), F.col("id"))
        path = swap_table(rows, name, root)
        assert place_of(spark, name).removeprefix("file:").rstrip("/") == path
    time.sleep(0.5)
    done.set()
    reader.join()
    spark.sql(f"DROP TABLE {name}")
    assert not failures
    assert len(seen) > 1 and seen <= {(version, version, 1000 + version) for version in range(5)}


def test_swap_table_keeps_the_old_rows_of_a_failed_job(spark, tmp_path, monkeypatch):
    name, root = "swapped_or_not", str(tmp_path / "versions")
    swap_table(spark.range(3).toDF("n"), name, root)
    swap_table(spark.table(name).withColumn("n", F.col("n") + 10), name, root)  # may read what it replaces
    old = place_of(spark, name)
    broken = spark.table(name).withColumn("n", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        swap_table(broken, name, root)
    with monkeypatch.context() as patch:  # the metadata step goes through, the refresh does not, once
        refresh, calls = type(spark.catalog).refreshTable, []

        def fail_once(catalog, table):
            calls.append(table)
            if len(calls) == 1:
                raise RuntimeError("no refresh")
            return refresh(catalog, table)

        patch.setattr(type(spark.catalog), "refreshTable", fail_once)
        with pytest.raises(RuntimeError, match="no refresh"):
            swap_table(spark.range(7).toDF("n"), name, root)
        assert len(calls) == 2
    assert place_of(spark, name) == old
    assert sorted(rows_of(spark.table(name))) == [(10,), (11,), (12,)]
    spark.sql(f"DROP TABLE {name}")


def test_swap_table_refuses_tables_it_cannot_point_elsewhere(spark, tmp_path):
    rows, root = spark.range(3).toDF("n"), str(tmp_path / "versions")
    swap_table(rows, "swap_external", root)
    with pytest.raises(ValueError, match="other columns"):
        swap_table(rows.withColumn("m", F.lit(1)), "swap_external", root)
    with pytest.raises(ValueError, match="other columns"):
        swap_table(rows.select(F.col("n").cast("int")), "swap_external", root)
    by_part = spark.range(3).select("id", (F.col("id") % 2).alias("part"))
    by_part.write.partitionBy("part").option("path", str(tmp_path / "parts")).saveAsTable("swap_parts")
    with pytest.raises(ValueError, match="partitioned"):
        swap_table(by_part, "swap_parts", root)
    rows.write.format("json").option("path", str(tmp_path / "json")).saveAsTable("swap_json")
    with pytest.raises(ValueError, match="no external Parquet table"):
        swap_table(rows, "swap_json", root)
    for table in ["swap_external", "swap_parts", "swap_json"]:
        spark.sql(f"DROP TABLE {table}")


def test_job_replaces_a_table_under_its_own_name(spark, tmp_path, unchanged_settings):
    golden.write_inputs(spark, str(tmp_path / "in"))
    arguments = ["--inputs", str(tmp_path / "in"), "--root", str(tmp_path / "out"), "--replace", "job_table"]
    places = {main(arguments), main([*arguments, "--unsorted"])}
    assert len(places) == 2 and place_of(spark, "job_table").removeprefix("file:") in places
    assert set(rows_of(spark.table("job_table"))) == golden.EXPECTED
    spark.sql("DROP TABLE job_table")


def test_statement_file_becomes_a_table(spark, tmp_path, caplog):
    golden.write_inputs(spark, str(tmp_path / "in"))
    common = [str(SNAPSHOT_SQL), "--input", f"snapshot={tmp_path}/in/active_snapshot", "--text", "snapshot=snapshot"]
    common += ["--root", str(tmp_path / "out")]
    wanted = rows_of(spark.read.parquet(f"{tmp_path}/in/active_snapshot").where("days_on_platform = 28"))
    with caplog.at_level("INFO", "daymark.statement"):
        run_statement([*common, "--arg", "day=28", "--replace", "statement_table"])
    assert "seconds" in caplog.text
    assert spark.table("statement_table").columns == ["match_id", "activepct"]
    assert len(wanted) and sorted(rows_of(spark.table("statement_table")), key=str) == sorted(
        [row[:2] for row in wanted], key=str
    )
    run_statement([*common, "--arg", "day=-1", "--view", "statement_view"])
    assert rows_of(spark.table("statement_view")) == []
    spark.sql("DROP TABLE statement_table")
    spark.sql("DROP VIEW statement_view")
    for wrong in [["--arg", "day"], ["--arg", "day=1", "--text", "day=1"]]:
        with pytest.raises(SystemExit):
            run_statement([*common, *wrong, "--view", "statement_view"])


def test_publish_version_keeps_the_old_one_until_the_new_one_is_whole(spark, tmp_path):
    root, view = str(tmp_path / "versions"), "published_numbers"
    publish_version(spark.range(3).toDF("n"), root, view)
    # a plan may read the version it replaces
    publish_version(spark.table(view).withColumn("n", F.col("n") + 10), root, view)
    assert sorted(rows_of(spark.table(view))) == [(10,), (11,), (12,)]
    broken = spark.table(view).withColumn("n", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        publish_version(broken, root, view)
    assert sorted(rows_of(spark.table(view))) == [(10,), (11,), (12,)]
    spark.sql(f"DROP VIEW {view}")


def test_by_start_date(spark):
    result = by_start_date(build_endpoint(golden.in_memory(spark)))
    dates = [row["effective_start_date"] for row in result.collect()]
    known = [d for d in dates if d is not None]
    assert known == sorted(known)
    assert dates == [*known, None, None]


def test_sort_spreads_a_frequent_date(spark):
    frequent = spark.range(4000).select(F.lit(date(2024, 1, 1)).alias("effective_start_date"), F.col("id").alias("title_id"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        tasks = by_start_date(frequent).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    sizes = [row["count"] for row in tasks]
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 2


@pytest.fixture
def unchanged_settings(spark):
    before = {key: spark.conf.get(key, None) for key in shuffle_settings(0, 1)}
    made = set(spark.conf.getAll)
    yield before
    for key, value in before.items():
        spark.conf.set(key, value) if key in made else spark.conf.unset(key)


def test_job(spark, tmp_path, unchanged_settings):
    golden.write_inputs(spark, str(tmp_path / "in"))
    stages = Path(shared_folder(spark).removeprefix("file:"))
    before = set(stages.iterdir())
    path = main(["--inputs", str(tmp_path / "in"), "--root", str(tmp_path / "out"), "--view", "job_endpoint"])
    assert set(rows_of(spark.table("job_endpoint"))) == golden.EXPECTED
    assert set(stages.iterdir()) == before, "the job leaves no stage folder"
    assert Path(path).name.startswith("version=2")
    # shuffle.partitions was set by the session's builder and is kept
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    main(["--inputs", str(tmp_path / "in"), "--root", str(tmp_path / "out"), "--view", "job_endpoint", "--unsorted"])
    assert set(rows_of(spark.table("job_endpoint"))) == golden.EXPECTED
    spark.sql("DROP VIEW job_endpoint")


def test_job_over_partitioned_catalog_tables_keeps_the_settings(spark, tmp_path, unchanged_settings):
    """Such tables have no size without statistics."""
    tables = golden.in_memory(spark)
    names = []
    for name in SCHEMAS:
        table = f"catalog_{name}"
        writer = getattr(tables, name).write.option("path", str(tmp_path / name))
        if name.endswith("_forecast") and "phase" in SCHEMAS[name].names:
            writer = writer.partitionBy("phase")
        writer.saveAsTable(table)
        names += ["--table", f"{name}={table}"]
    main([*names, "--root", str(tmp_path / "out"), "--view", "catalog_endpoint", "--title-delimiters", " ", "--horizon", "28"])
    assert set(rows_of(spark.table("catalog_endpoint"))) == golden.EXPECTED
    assert {key: spark.conf.get(key, None) for key in unchanged_settings} == unchanged_settings
    spark.sql("DROP VIEW catalog_endpoint")
    for name in SCHEMAS:
        spark.sql(f"DROP TABLE catalog_{name}")


@pytest.mark.parametrize(
    "arguments",
    [
        ["--table", "entity_bse=db.titles"],
        ["--table", "entity_base"],
        ["--table", "entity_base="],
        ["--table", "entity_base=a", "--table", "entity_base=b"],
        ["--inputs", "folder", "--table", "entity_base=a"],
    ],
)
def test_job_refuses_inputs_it_would_not_read(arguments, capsys):
    with pytest.raises(SystemExit):
        main([*arguments, "--root", "out"])
    assert "--table" in capsys.readouterr().err


def test_catalog_refuses_unknown_inputs(spark):
    with pytest.raises(ValueError, match="entity_bse"):
        from_catalog(spark, {"entity_bse": "x"})


def test_last_join_stage_of_the_job_runs_once(spark, tmp_path):
    """A range sort samples its input; sorted after storing, the joins are not run for that."""
    golden.write_inputs(spark, str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)

    def note(value):
        seen.add(1)
        return value

    counted = F.udf(note, "string")
    result = build_endpoint(from_parquet(spark, str(tmp_path / "in"))).withColumn("title_name", counted("title_name"))
    stage = str(tmp_path / "stage")
    result.write.parquet(stage)
    rows = by_start_date(spark.read.parquet(stage)).collect()
    assert seen.value == len(rows) == len(golden.EXPECTED)


def test_atomic_replace_is_the_catalogs_choice(spark, tmp_path):
    """The session catalog cannot replace a Parquet table whole: it refuses instead of falling back."""
    with pytest.raises(Exception, match="(?i)not supported|unsupported|replace"):
        replace_table(spark.range(3).toDF("n"), "replaced_whole", atomic=True)
    assert not spark.catalog.tableExists("replaced_whole")
    with pytest.raises(ValueError):
        replace_table(spark.range(3).toDF("n"), "replaced_whole", path=str(tmp_path), atomic=True)


def test_shuffle_settings_keep_the_size_per_task():
    partitions, split = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    for size, cores, wanted in [(10 << 20, 8, 16), (1 << 40, 800, 8192), (100 << 40, 8000, 819_200)]:
        settings_ = shuffle_settings(size, cores)
        assert (int(settings_[partitions]), int(settings_[split])) == (wanted, 128 << 20)


def test_shared_folder_is_the_one_the_session_names():
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://folder"}

    assert fresh_folder(Session, "x").startswith("hdfs://folder/x-")


def test_scratch_removes_what_was_stored_within(spark, tmp_path):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with scratch(spark):
        kept = stored(spark.range(5))
        assert len(set(folder.iterdir()) - before) == 1
        kept.write.parquet(str(tmp_path / "kept"))
    assert set(folder.iterdir()) == before
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 5
    with pytest.raises(RuntimeError), scratch(spark):
        stored(spark.range(5))
        raise RuntimeError
    assert set(folder.iterdir()) == before


def test_a_cluster_without_a_shared_folder_is_refused():
    class Session:
        conf = {}

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        fresh_folder(Session, "x")


def test_elapsed(spark):
    assert elapsed(spark.range(10)) > 0
