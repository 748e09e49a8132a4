"""The endpoint: launched titles and future titles in one table of measured and forecast values.

Every stage is a lazy frame. A stage reduces its source to the few columns and the one day or pick the result needs
before anything is joined.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark import constants as C
from daymark.functions import entity_key, finished_label, initcap, phase_label, title_season_name
from daymark.operators import (
    Group,
    Side,
    distinct_rows,
    join_sources,
    labelled_sum,
    latest_per_group,
    latest_per_key,
    snapshot_at,
    stack,
)
from daymark.sources import RESULT_SCHEMA, SCHEMAS, Tables

# prediction and phase settle ties on the forecast day
TIE_BREAKERS = ["prediction", "phase"]


# --- launched titles ---------------------------------------------------------------------------------------------


def base_entities(entity_base: DataFrame) -> DataFrame:
    """Distinct titles and seasons with their key."""
    return distinct_rows(entity_base, [*SCHEMAS["entity_base"].names, entity_key().alias("match_id")])


def measured_active(tables: Tables, day: int = C.HORIZON_DAY) -> DataFrame:
    return snapshot_at(
        tables.active_snapshot, "match_id", "days_on_platform", day, "pct_actives", "activepct", label=C.LABEL_ACTUAL
    )


def measured_view(tables: Tables, day: int = C.HORIZON_DAY) -> DataFrame:
    """The measured share is a fraction and is scaled; view forecasts are stored as percentages and are not."""
    return snapshot_at(
        tables.funnel_metrics,
        "match_id",
        "days_since_first_offered",
        day,
        "retail_viewed_count_percent",
        "viewpct",
        scale=C.PERCENT,
        label=C.LABEL_ACTUAL,
    )


def forecast_launched(forecast: DataFrame, out: str, day: int = C.HORIZON_DAY) -> DataFrame:
    """Newest post-launch forecast per key, made up to the day it is for."""
    return _launched_columns(
        latest_per_key(forecast, ["match_id"], "pred_day", TIE_BREAKERS, _after_launch(day)), out
    )


def _after_launch(day: int) -> Column:
    return (F.col("phase") == C.PHASE_POST_LAUNCH) & (F.col("target_day") == day) & (F.col("pred_day") <= day)


def _launched_columns(picked: DataFrame, out: str) -> DataFrame:
    return picked.select("match_id", F.col("prediction").alias(out), F.lit(C.LABEL_POSTLAUNCH).alias("phase"))


def views_launched(tables: Tables) -> DataFrame:
    """90-day first views per title, season and state of the window."""
    return labelled_sum(
        tables.daily_forecast.where(F.col("schedule_label") == C.SCHEDULE_PAST),
        ["title_id", "title_name", "season_number", "finished_window_flag"],
        "predicted_first_views",
        "firstview_90d",
        finished_label(),
    )


def launched(
    tables: Tables,
    horizon: int = C.HORIZON_DAY,
    title_delimiters: str | None = C.WORD_ENDS,
    picks: Picks | None = None,
) -> DataFrame:
    """Launched titles, each row once: the measured value if there is one, else the forecast.

    The label of the 28-day values follows the view metric. A season with actual and forecast 90-day figures has two
    rows.
    """
    # Copies of a measured value would only multiply rows that the result holds once, so they go before the join.
    actives = measured_active(tables, horizon).drop("phase").withColumnRenamed("activepct", "active_measured")
    views = measured_view(tables, horizon).withColumnsRenamed({"viewpct": "view_measured", "phase": "phase_measured"})
    picks = picks or separate_picks(tables, horizon)
    active_forecast = picks.active_launched.drop("phase")
    view_forecast = picks.view_launched
    sums = views_launched(tables).drop("title_name", "finished_window_flag").withColumnRenamed("phase", "phase_90d")
    by_season = ["title_id", "season_number"]
    joined = join_sources(
        base_entities(tables.entity_base),
        [
            Side(actives.distinct(), ["match_id"], ["match_id"]),
            Side(views.distinct(), ["match_id"], ["match_id"]),
            Side(active_forecast, ["match_id"], ["match_id"], unique=True),
            Side(view_forecast.withColumnRenamed("phase", "phase_forecast"), ["match_id"], ["match_id"], unique=True),
            Side(sums, by_season, by_season),
        ],
    )
    rows = joined.withColumns(
        {
            "title_name_season": title_season_name(),
            f"activepct_{horizon}d": F.coalesce("active_measured", "active_forecast"),
            f"viewpct_retail_{horizon}d": F.coalesce("view_measured", "view_forecast"),
            f"phase_{horizon}d": F.coalesce("phase_measured", "phase_forecast"),
        }
    )
    # The suffixed name and the season tell stored names apart, so casing the name after the distinct gives the same rows.
    return rows.select(*result_columns(horizon)).distinct().withColumn("title_name", initcap("title_name", title_delimiters))


# --- future titles -----------------------------------------------------------------------------------------------


def views_future(tables: Tables) -> DataFrame:
    """90-day first-view forecast per future title."""
    return labelled_sum(
        tables.future_forecast.where(F.col("schedule_label") == C.SCHEDULE_ALPHA),
        [
            "title_name",
            "season_number",
            title_season_name().alias("title_name_season"),
            F.col("premiere_date").alias("effective_start_date"),
            "tier",
            "content_category",
            "category",
        ],
        "first_views_pred",
        "firstview_90d",
    )


def active_future(tables: Tables, day: int = C.HORIZON_DAY) -> DataFrame:
    """Newest active forecast per title made up to launch; rows without a phase are left out."""
    wanted = _before_launch(day) & (F.col("pred_day") <= C.LAUNCH_DAY)
    return _active_future_columns(
        latest_per_key(tables.active_forecast, ["title_name"], "pred_day", TIE_BREAKERS, wanted)
    )


def _before_launch(day: int) -> Column:
    return (F.col("phase") != C.PHASE_POST_LAUNCH) & (F.col("target_day") == day)


def _active_future_columns(picked: DataFrame) -> DataFrame:
    return picked.select("title_name", F.col("prediction").alias("activepct"), phase_label().alias("phase"))


def view_future(tables: Tables, day: int = C.HORIZON_DAY, dated: bool = True) -> DataFrame:
    """Newest view forecast per key, not per title, and without a bound on its day: a title may have several.

    The endpoint does not use the date; without it (``dated=False``) the scan leaves that column out.
    """
    date = ["effective_start_date"] if dated else []
    return latest_per_key(
        tables.view_forecast, ["match_id"], "pred_day", [*TIE_BREAKERS, "title_name", *date], _before_launch(day)
    ).select("title_name", *date, F.col("prediction").alias("viewpct"), F.lit(C.LABEL_PRELAUNCH).alias("phase"))


def future(
    tables: Tables,
    horizon: int = C.HORIZON_DAY,
    title_delimiters: str | None = C.WORD_ENDS,
    picks: Picks | None = None,
) -> DataFrame:
    """Future titles, each row once, joined to their forecasts by the suffixed name as stored."""
    picks = picks or separate_picks(tables, horizon)
    active = picks.active_future.withColumnRenamed("phase", "phase_active")
    # One row per value: the join otherwise repeats a title's rows once per key that forecasts the same value, which
    # grows with the square of the keys per title.
    view = picks.view_future.select("title_name", "viewpct").distinct()
    joined = join_sources(
        views_future(tables),
        [
            Side(active, ["title_name_season"], ["title_name"], unique=True),
            Side(view, ["title_name_season"], ["title_name"]),
        ],
    )
    # No distinct: the group keys of views_future make its rows unique, they survive in the result (the stored name in
    # title_name_season), and the sides add at most one row per distinct value.
    return joined.withColumns(
        {
            "title_id": F.lit(None).cast("string"),
            "match_id": F.lit(None).cast("string"),
            "title_name": initcap("title_name", title_delimiters),
            f"activepct_{horizon}d": F.col("activepct"),
            f"viewpct_retail_{horizon}d": F.col("viewpct"),
            f"phase_{horizon}d": F.col("phase_active"),
            "phase_90d": F.lit(C.LABEL_POSTGREENLIGHT),
        }
    ).select(*result_columns(horizon))


# --- picks of both arms ---------------------------------------------------------------------------------------------


class Picks(NamedTuple):
    """The newest forecasts of launched and of future titles."""

    active_launched: DataFrame
    view_launched: DataFrame
    active_future: DataFrame
    view_future: DataFrame


def separate_picks(tables: Tables, day: int = C.HORIZON_DAY) -> Picks:
    """Each pick by itself, as an arm needs it that is computed without the other."""
    return Picks(
        forecast_launched(tables.active_forecast, "active_forecast", day),
        forecast_launched(tables.view_forecast, "view_forecast", day),
        active_future(tables, day),
        view_future(tables, day, dated=False),
    )


def shared_picks(tables: Tables, day: int = C.HORIZON_DAY) -> Picks:
    """The same picks, from one scan and one shuffle per forecast table: a forecast belongs to one of the arms."""
    launched_titles = Group(_after_launch(day), "match_id")
    active = latest_per_group(
        tables.active_forecast,
        [launched_titles, Group(_before_launch(day) & (F.col("pred_day") <= C.LAUNCH_DAY), "title_name")],
        "pred_day",
        TIE_BREAKERS,
    )
    # The name breaks ties for both, after the columns a launched title's values come from.
    view = latest_per_group(
        tables.view_forecast,
        [launched_titles, Group(_before_launch(day), "match_id")],
        "pred_day",
        [*TIE_BREAKERS, "title_name"],
    )
    return Picks(
        _launched_columns(active[0], "active_forecast"),
        _launched_columns(view[0], "view_forecast"),
        _active_future_columns(active[1]),
        view[1].select("title_name", F.col("prediction").alias("viewpct")),
    )


# --- both ----------------------------------------------------------------------------------------------------------


def result_columns(horizon: int = C.HORIZON_DAY) -> list[str]:
    if horizon == 90:
        raise ValueError("a horizon of 90 days would give the columns of the 90-day figures a second meaning")
    return [name.replace(f"_{C.HORIZON_DAY}d", f"_{horizon}d") for name in RESULT_SCHEMA.names]


def build_endpoint(
    tables: Tables, horizon: int = C.HORIZON_DAY, title_delimiters: str | None = C.WORD_ENDS
) -> DataFrame:
    """The result table, every row once, unsorted.

    The arms hold each of their rows once and share none: ``phase_90d`` of a future title is a label no launched title
    has. Stacking them is therefore the de-duplicating union, without its shuffle of the whole result.
    """
    picks = shared_picks(tables, horizon)
    return stack(
        launched(tables, horizon, title_delimiters, picks),
        future(tables, horizon, title_delimiters, picks),
        result_columns(horizon),
    )
