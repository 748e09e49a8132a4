"""The registered queries: each operator on its own, then the arms and the whole endpoint, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import constants as C
from daymark.functions import entity_key, initcap, lowercase_columns, phase_label, title_season_name
from daymark.operators import Side, join_sources, union_distinct
from daymark.plans import build_endpoint, future, launched, run_file
from daymark.plans import endpoint as stages
from daymark.session import fresh_folder
from daymark.sinks import by_start_date, swap_table, write_csv_indexed
from daymark.sources import RESULT_SCHEMA, Tables
from daymark.sources.driver_tables import DriverTables, driver_tables

SNAPSHOT_SQL = Path(__file__).parent / "plans" / "sql" / "snapshot.sql"

ON_KEY = (["match_id"], ["match_id"])
ON_TITLE = (["title_name_season"], ["title_name"])
ON_SEASON = (["title_id", "season_number"], ["title_id", "season_number"])


def _base(t: Tables) -> DataFrame:
    return stages.base_entities(t.entity_base)


# --- sources, projections, filters -----------------------------------------------------------------------------------


def scan_entity_base(t: Tables) -> DataFrame:
    return t.entity_base


def entity_keys(t: Tables) -> DataFrame:
    return t.entity_base.select("title_id", "content_category", "season_number", entity_key().alias("match_id"))


def title_season_names(t: Tables) -> DataFrame:
    name = title_season_name().alias("title_name_season")
    return t.entity_base.select("title_id", "title_name", "season_number", name)


def concat_null_propagation(t: Tables) -> DataFrame:
    key = F.concat(F.col("title_id"), F.lit(C.KEY_SEPARATOR), F.col("season_number").cast("string"))
    return t.entity_base.select("title_id", "season_number", key.alias("season_key"))


def initcap_title(t: Tables) -> DataFrame:
    return t.entity_base.select("title_id", "title_name", initcap("title_name").alias("display_name"))


def label_constant(t: Tables) -> DataFrame:
    return t.active_snapshot.select("match_id", "pct_actives", F.lit(C.LABEL_ACTUAL).alias("phase"))


def label_phase(t: Tables) -> DataFrame:
    return t.active_forecast.select("match_id", "phase", phase_label().alias("label"))


def filter_phase_not_equal(t: Tables) -> DataFrame:
    return t.active_forecast.where(F.col("phase") != C.PHASE_POST_LAUNCH)


def filter_conjunction(t: Tables) -> DataFrame:
    return t.active_forecast.where(
        (F.col("phase") == C.PHASE_POST_LAUNCH)
        & (F.col("target_day") == C.HORIZON_DAY)
        & (F.col("pred_day") <= C.HORIZON_DAY)
    )


# --- joins -----------------------------------------------------------------------------------------------------------


def left_join_measured_active(t: Tables) -> DataFrame:
    return join_sources(_base(t), [Side(stages.measured_active(t), *ON_KEY)])


def left_join_measured_view(t: Tables) -> DataFrame:
    return join_sources(_base(t), [Side(stages.measured_view(t), *ON_KEY)])


def left_join_forecast_active(t: Tables) -> DataFrame:
    forecast = stages.forecast_launched(t.active_forecast, "activepct")
    return join_sources(_base(t), [Side(forecast, *ON_KEY, unique=True)])


def left_join_forecast_view(t: Tables) -> DataFrame:
    forecast = stages.forecast_launched(t.view_forecast, "viewpct")
    return join_sources(_base(t), [Side(forecast, *ON_KEY, unique=True)])


def left_join_composite_key(t: Tables) -> DataFrame:
    return join_sources(_base(t), [Side(stages.views_launched(t).drop("title_name"), *ON_SEASON)])


def left_join_future_active(t: Tables) -> DataFrame:
    return join_sources(stages.views_future(t), [Side(stages.active_future(t), *ON_TITLE, unique=True)])


def left_join_future_fanout(t: Tables) -> DataFrame:
    """Equal rows of the fan-out come as one row with their number, ``n_rows``, instead of being written out."""
    values = stages.view_future(t, dated=False).groupBy("title_name", "viewpct").agg(F.count(F.lit(1)).alias("n_rows"))
    joined = join_sources(stages.views_future(t), [Side(values, *ON_TITLE)])
    return joined.withColumn("n_rows", F.coalesce("n_rows", F.lit(1).cast("bigint")))


def coalesce_measured_forecast(t: Tables) -> DataFrame:
    """Measured view share, else the forecast, with the label of the one taken."""
    measured = stages.measured_view(t).withColumnsRenamed({"viewpct": "measured", "phase": "phase_measured"})
    forecast = stages.forecast_launched(t.view_forecast, "forecast").withColumnRenamed("phase", "phase_forecast")
    joined = join_sources(_base(t), [Side(measured, *ON_KEY), Side(forecast, *ON_KEY, unique=True)])
    return joined.select(
        "title_id",
        "match_id",
        F.coalesce("measured", "forecast").alias("viewpct"),
        F.coalesce("phase_measured", "phase_forecast").alias("phase"),
    )


# --- union, sort, sinks, templates -----------------------------------------------------------------------------------


def union_distinct_null_padded(t: Tables) -> DataFrame:
    return union_distinct(launched(t), future(t), RESULT_SCHEMA.names)


def order_by_start_date(t: Tables) -> DataFrame:
    return by_start_date(build_endpoint(t))


def lowercase(t: Tables) -> DataFrame:
    shouted = t.entity_base.toDF(*[name.upper() for name in t.entity_base.columns])
    return lowercase_columns(shouted)


def parametrised_query(t: Tables) -> DataFrame:
    t.active_snapshot.createOrReplaceTempView("snapshot_input")
    spark = t.active_snapshot.sparkSession
    return run_file(spark, SNAPSHOT_SQL, snapshot="snapshot_input", day=C.HORIZON_DAY)


def replace_and_read_back(t: Tables) -> DataFrame:
    """The table first holds the future arm, then is replaced under its own name by the whole endpoint."""
    spark = t.entity_base.sparkSession
    name = "daymark_endpoint_metrics"
    root = fresh_folder(spark, "endpoint")
    swap_table(future(t), name, root)
    swap_table(by_start_date(build_endpoint(t)), name, root)
    return spark.table(name)


def csv_indexed(t: Tables) -> DataFrame:
    spark = t.entity_base.sparkSession
    path = fresh_folder(spark, "csv")
    write_csv_indexed(t.entity_base.select("title_id", "title_name", "season_number"), path, ["title_id"])
    return spark.read.csv(path, header=True, schema="_c0 bigint, title_id string, title_name string, season_number int")


ON_TABLES: dict[str, Callable[[DriverTables], DataFrame]] = {
    "scan_entity_base": scan_entity_base,
    "entity_key": entity_keys,
    "title_season_name": title_season_names,
    "concat_null_propagation": concat_null_propagation,
    "initcap_title": initcap_title,
    "label_constant": label_constant,
    "label_phase": label_phase,
    "filter_phase_not_equal": filter_phase_not_equal,
    "filter_conjunction": filter_conjunction,
    "distinct_base": lambda t: stages.base_entities(t.entity_base_per_line),
    "snapshot_active": stages.measured_active,
    "snapshot_view_scaled": stages.measured_view,
    "latest_active_launched": lambda t: stages.forecast_launched(t.active_forecast, "activepct"),
    "latest_view_launched": lambda t: stages.forecast_launched(t.view_forecast, "viewpct"),
    "latest_active_future": stages.active_future,
    "latest_view_future": stages.view_future,
    "sum_launched": stages.views_launched,
    "sum_future": stages.views_future,
    "left_join_measured_active": left_join_measured_active,
    "left_join_measured_view": left_join_measured_view,
    "left_join_forecast_active": left_join_forecast_active,
    "left_join_forecast_view": left_join_forecast_view,
    "left_join_composite_key": left_join_composite_key,
    "left_join_future_active": left_join_future_active,
    "left_join_future_fanout": left_join_future_fanout,
    "coalesce_measured_forecast": coalesce_measured_forecast,
    "launched_arm": launched,
    "future_arm": future,
    "union_distinct_null_padded": union_distinct_null_padded,
    "order_by_start_date": order_by_start_date,
    "endpoint_metrics": build_endpoint,
    "lowercase_columns": lowercase,
    "parametrised_query": parametrised_query,
    "replace_and_read_back": replace_and_read_back,
    "csv_indexed": csv_indexed,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_folder(query: Callable[[DriverTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(driver_tables(spark, folder))

    return {name: over_folder(query) for name, query in ON_TABLES.items()}
