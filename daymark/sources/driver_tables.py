"""The seven inputs derived from the ``part`` and ``lineitem`` test tables.

A part stands for a title (every fourth one a future title), a line item for one measurement or forecast of it. Some
names get punctuation, and some dates, phases, forecast days and whole groups of measures are NULL.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import constants as C
from daymark.functions import entity_key, title_season_name
from daymark.sources.tables import conform

SERIES_TYPES = ["ECONOMY", "PROMO", "SMALL"]
FIRST_START = "1995-01-01"
FIRST_PREMIERE = "2002-01-01"


def _input(name: str, rows: DataFrame, where: Column, **computed: Column) -> DataFrame:
    return conform(rows.where(where), name, **computed)


class DriverTables:
    """The inputs, each planned when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    @cached_property
    def titles(self) -> DataFrame:
        """Parts with the attributes of a title."""
        part = self._spark.read.parquet(f"{self._folder}/part.parquet")
        is_series = F.col("p_type").isin(SERIES_TYPES)
        described = part.select(
            "p_partkey",
            F.col("p_partkey").cast("string").alias("title_id"),
            F.when(F.col("p_partkey") % 5 == 0, F.concat_ws("-", "p_name", "p_type"))
            .when(F.col("p_partkey") % 5 == 1, F.concat_ws(": ", "p_type", "p_name"))
            .otherwise(F.col("p_name"))
            .alias("title_name"),
            F.col("p_brand").alias("tier"),
            F.col("p_type").alias("category"),
            F.when(is_series, C.CATEGORY_SERIES).otherwise("movie").alias("content_category"),
            F.when(F.col("p_size") != 50, F.when(is_series, F.col("p_size") % 5).otherwise(0)).alias("season_number"),
            F.when(F.col("p_size") != 7, F.date_add(F.lit(FIRST_START).cast("date"), F.col("p_size") * 40)).alias(
                "effective_start_date"
            ),
            F.when(F.col("p_size") % 10 != 9, F.date_add(F.lit(FIRST_PREMIERE).cast("date"), F.col("p_size"))).alias(
                "premiere_date"
            ),
            (F.col("p_partkey") % 4 == 0).alias("is_future"),
            (F.col("p_partkey") % 7 != 3).alias("has_daily"),
            (F.col("p_size") != 11).alias("has_future"),
        )
        return described.withColumns({"match_id": entity_key(), "title_season": title_season_name()})

    @cached_property
    def records(self) -> DataFrame:
        """Line items with the title they belong to."""
        lines = self._spark.read.parquet(f"{self._folder}/lineitem.parquet")
        days = F.datediff(F.col("l_shipdate").cast("date"), F.lit(FIRST_START).cast("date"))
        dated = lines.withColumns(
            {
                "pred_day": F.when(F.col("l_quantity") != 13, days % 60 - 30),
                "target_day": F.when(F.col("l_quantity") <= 25, C.HORIZON_DAY).otherwise(7),
                "day_n": F.col("l_linenumber") * 7,
            }
        )
        return dated.join(self.titles, F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def entity_base(self) -> DataFrame:
        return _input("entity_base", self.titles, ~F.col("is_future"))

    @cached_property
    def entity_base_per_line(self) -> DataFrame:
        """``entity_base`` with one copy of a title per line item, so that there is something to de-duplicate."""
        return _input("entity_base", self.records, ~F.col("is_future"))

    @cached_property
    def active_snapshot(self) -> DataFrame:
        return _input(
            "active_snapshot",
            self.records,
            F.expr("NOT is_future AND l_returnflag = 'A' AND l_linestatus = 'F'"),
            pct_actives=F.col("l_discount"),
            days_on_platform=F.col("day_n"),
        )

    @cached_property
    def funnel_metrics(self) -> DataFrame:
        return _input(
            "funnel_metrics",
            self.records,
            F.expr("NOT is_future AND l_returnflag = 'A' AND l_linestatus = 'O'"),
            retail_viewed_count_percent=F.col("l_discount"),
            days_since_first_offered=F.col("day_n"),
        )

    def _forecast(self, name: str, status: str) -> DataFrame:
        early = F.when(F.col("l_linenumber") % 2 == 1, C.PHASE_PRE_LAUNCH).otherwise("Post-Greenlight")
        return _input(
            name,
            self.records,
            (F.col("l_returnflag") != "A") & (F.col("l_linestatus") == status),
            phase=F.when(F.col("l_linenumber") != 7, F.when(F.col("is_future"), early).otherwise(C.PHASE_POST_LAUNCH)),
            title_name=F.col("title_season"),
            prediction=F.col("l_tax"),
        )

    @cached_property
    def active_forecast(self) -> DataFrame:
        return self._forecast("active_forecast", "F")

    @cached_property
    def view_forecast(self) -> DataFrame:
        return self._forecast("view_forecast", "O")

    @cached_property
    def daily_forecast(self) -> DataFrame:
        return _input(
            "daily_forecast",
            self.records,
            ~F.col("is_future"),
            finished_window_flag=(F.col("l_returnflag") == "A").cast("int"),
            predicted_first_views=F.when(F.col("has_daily"), F.col("l_quantity")),
            schedule_label=F.when(F.col("l_linestatus") == "F", C.SCHEDULE_PAST).otherwise(C.SCHEDULE_ALPHA),
        )

    @cached_property
    def future_forecast(self) -> DataFrame:
        return _input(
            "future_forecast",
            self.records,
            F.col("is_future"),
            first_views_pred=F.when(F.col("has_future"), F.col("l_quantity")),
            schedule_label=F.when(F.col("l_linestatus") == "O", C.SCHEDULE_ALPHA).otherwise("beta"),
        )


@lru_cache(maxsize=16)
def driver_tables(spark: SparkSession, folder: str) -> DriverTables:
    """The inputs of a folder, opened once per session as catalog tables would be."""
    return DriverTables(spark, folder)
