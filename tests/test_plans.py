"""Physical plans: what is shuffled, what reaches the scans, and that nothing runs outside the JVM."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from daymark.operators import Side, join_sources, latest_per_key, union_distinct
from daymark.plans import build_endpoint, future, launched
from daymark.plans import endpoint as stages
from daymark.queries import registered
from daymark.sinks import by_start_date
from daymark.sources import RESULT_SCHEMA, SCHEMAS, conform, from_parquet, write_forecasts
from tests import golden
from tests.plans import count, plan_of, scans, settings, shuffled_plan


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "inputs")
    golden.write_inputs(spark, root)
    with settings(spark, spark__sql__debug__maxToStringFields="200", spark__sql__maxMetadataStringLength="2000"):
        yield from_parquet(spark, root)


def test_pick_limits_groups_before_the_shuffle(spark, tables):
    plan = shuffled_plan(lambda: stages.forecast_launched(tables.active_forecast, "activepct"), spark)
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert [("Final" in line, "Exchange" in line, "Partial" in line) for line in lines] == [
        (True, False, False),
        (False, True, False),
        (False, False, True),
    ]


def test_picks_reuse_their_partitioning_in_the_join(spark, tables):
    """Both picks and the base, shuffled once each, meet in two joins by the same key."""
    base = stages.base_entities(tables.entity_base)
    sides = [
        Side(stages.forecast_launched(tables.active_forecast, "a").drop("phase"), ["match_id"], ["match_id"], unique=True),
        Side(stages.forecast_launched(tables.view_forecast, "v"), ["match_id"], ["match_id"], unique=True),
    ]
    plan = shuffled_plan(lambda: join_sources(base, sides), spark)
    assert count(plan, "SortMergeJoin") == 2
    assert count(plan, "Exchange hashpartitioning") == 2 + 1 + 1  # base: distinct and join; a shuffle per pick


def test_building_the_plan_starts_no_job(spark, tables):
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        build_endpoint(tables)
        union_distinct(launched(tables), future(tables), RESULT_SCHEMA.names)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_endpoint_adds_no_shuffle_for_the_union(spark, tables):
    picks = stages.shared_picks(tables)
    both = [launched(tables, picks=picks), future(tables, picks=picks)]
    arms = "".join(shuffled_plan(lambda: arm.select("*"), spark) for arm in both)
    whole = shuffled_plan(lambda: build_endpoint(tables), spark)
    generic = shuffled_plan(lambda: union_distinct(*both, RESULT_SCHEMA.names), spark)
    assert count(whole, "Exchange hashpartitioning") == count(arms, "Exchange hashpartitioning")
    assert count(generic, "Exchange hashpartitioning") == count(arms, "Exchange hashpartitioning") + 1


def test_no_python_no_single_partition_no_cross_join_no_sort_below_the_union(spark, tables):
    plan = shuffled_plan(lambda: build_endpoint(tables), spark)
    for operator in ["Python", "SinglePartition", "Cartesian", "BroadcastNestedLoop", "rangepartitioning"]:
        assert operator not in plan


def test_sorted_output_is_cut_into_ranges_of_the_whole_row(spark, tables):
    plan = shuffled_plan(lambda: by_start_date(build_endpoint(tables)), spark)
    (ranges,) = [line for line in plan.splitlines() if "rangepartitioning" in line]
    assert ranges.index("effective_start_date") < ranges.index("title_id")
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("whole", ["int", "bigint", "decimal(38,0)"])
def test_filters_and_columns_reach_the_scans(spark, tables, tmp_path, whole):
    """Whole numbers of any width: a warehouse export often writes wide ones."""
    if whole != "int":
        for name in SCHEMAS:
            df = getattr(tables, name)
            wide = {c: df[c].cast(whole) for c in df.columns if df.schema[c].dataType.simpleString() == "int"}
            df.withColumns(wide).write.parquet(str(tmp_path / name))
        tables = from_parquet(spark, str(tmp_path))
        assert {tuple(row) for row in build_endpoint(tables).collect()} == golden.EXPECTED
    read = scans(shuffled_plan(lambda: build_endpoint(tables), spark))
    # Sides that can multiply rows are read once more, for the counts of their keys; there the key must not be NULL either.
    read = {(frozenset(columns), re.sub(r"(, )?IsNotNull\(\w+\)(, )?", "", pushed)) for columns, pushed in read}
    assert len(read) >= 7
    by_columns = {frozenset(columns): pushed for columns, pushed in read}
    assert "EqualTo(days_on_platform,28)" in by_columns[frozenset({"match_id", "pct_actives", "days_on_platform"})]
    forecasts = [(columns, pushed) for columns, pushed in read if "pred_day" in columns]
    assert len(forecasts) == 2  # one scan per table, for the picks of both arms
    for columns, pushed in forecasts:
        assert "EqualTo(target_day,28)" in pushed
        assert "effective_start_date" not in columns
        assert "Or(And(EqualTo(phase,Post-Launch),LessThanOrEqual(pred_day,28))" in pushed
        assert "Not(EqualTo(phase,Post-Launch))" in pushed
    assert sum("LessThanOrEqual(pred_day,0)" in pushed for _, pushed in forecasts) == 1
    for columns, pushed in read:
        if "schedule_label" in columns:
            assert "EqualTo(schedule_label," in pushed


def test_each_forecast_table_is_scanned_once_for_both_arms(spark, tables):
    plan = shuffled_plan(lambda: build_endpoint(tables), spark)
    assert sum("pred_day" in columns for columns, _ in scans(plan)) == 2
    apart = shuffled_plan(lambda: launched(tables), spark) + shuffled_plan(lambda: future(tables), spark)
    assert sum("pred_day" in columns for columns, _ in scans(apart)) > 2


def test_forecasts_laid_out_by_day_and_phase_open_the_folders_of_the_day(spark, tables, tmp_path):
    root = str(tmp_path / "inputs")
    for name in SCHEMAS:
        table = getattr(tables, name)
        if "phase" not in table.columns:
            table.write.parquet(f"{root}/{name}")
            continue
        other_days = table.withColumn("target_day", (table.target_day + 1).cast("int"))
        write_forecasts(table.union(other_days), f"{root}/{name}")
    laid_out = from_parquet(spark, root)
    assert {tuple(row) for row in build_endpoint(laid_out).collect()} == golden.EXPECTED
    picked = stages.forecast_launched(laid_out.active_forecast, "activepct")
    (line,) = [line for line in plan_of(picked).splitlines() if "FileScan parquet" in line]
    pruned = line[line.index("PartitionFilters") : line.index("PushedFilters")]
    assert "target_day" in pruned and "= 28" in pruned and "Post-Launch" in pruned
    wanted = laid_out.active_forecast.where("target_day = 28 AND phase = 'Post-Launch'")
    opened = {row[0] for row in wanted.select(F.input_file_name()).distinct().collect()}
    assert opened and all("target_day=28/phase=Post-Launch" in file for file in opened)


def test_forecasts_of_launched_titles_do_not_read_names(spark, tables):
    (read,) = scans(shuffled_plan(lambda: stages.forecast_launched(tables.view_forecast, "viewpct"), spark))
    assert read[0] == {"match_id", "prediction", "phase", "target_day", "pred_day"}


def test_sums_and_distinct_combine_before_the_shuffle(spark, tables):
    sums = shuffled_plan(lambda: stages.views_launched(tables), spark)
    assert "partial_sum" in sums and count(sums, "Exchange hashpartitioning") == 1
    distinct = shuffled_plan(lambda: stages.base_entities(tables.entity_base), spark)
    assert count(distinct, "HashAggregate") == 2 and count(distinct, "Exchange hashpartitioning") == 1


def test_inputs_bucketed_by_the_join_key_are_not_shuffled(spark, tables, tmp_path):
    name = "bucketed_forecast"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = tables.active_forecast.write.bucketBy(4, "match_id").option("path", str(tmp_path / name))
    writer.saveAsTable(name)
    try:
        bucketed = conform(spark.table(name), "active_forecast")
        plan = shuffled_plan(lambda: stages.forecast_launched(bucketed, "activepct"), spark)
        assert "Exchange" not in plan and "WindowGroupLimit" in plan
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_tie_breakers_are_required(tables):
    with pytest.raises(ValueError):
        latest_per_key(tables.active_forecast, ["match_id"], "pred_day", [])


@pytest.mark.parametrize("name", sorted(set(registered()) - {"replace_and_read_back", "csv_indexed"}))
def test_registered_queries_stay_in_the_jvm(spark, name):
    plan = plan_of(registered()[name](spark, "/root/testdata/sf0.001"))
    for operator in ["Python", "Cartesian", "BroadcastNestedLoop"]:
        assert operator not in plan
