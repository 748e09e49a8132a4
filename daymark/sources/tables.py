"""The seven inputs: their schemas and how to read them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    IntegralType,
    StringType,
    StructField,
    StructType,
)

STRING, INT, DOUBLE, DATE = StringType(), IntegerType(), DoubleType(), DateType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Columns that are compared and never reach a result: they may keep the whole-number type of their source.
COMPARED = frozenset({"days_on_platform", "days_since_first_offered", "target_day", "pred_day"})

# The column lists below are fixed: names and order of the inputs and of the result.
_FORECAST = dict(
    match_id=STRING, title_name=STRING, prediction=DOUBLE, phase=STRING, target_day=INT, pred_day=INT
)

SCHEMAS: dict[str, StructType] = {
    "entity_base": _schema(
        title_id=STRING,
        title_name=STRING,
        tier=STRING,
        season_number=INT,
        content_category=STRING,
        category=STRING,
        effective_start_date=DATE,
    ),
    "active_snapshot": _schema(match_id=STRING, pct_actives=DOUBLE, days_on_platform=INT),
    "funnel_metrics": _schema(match_id=STRING, retail_viewed_count_percent=DOUBLE, days_since_first_offered=INT),
    "active_forecast": _schema(**_FORECAST),
    "view_forecast": _schema(**_FORECAST, effective_start_date=DATE),
    "daily_forecast": _schema(
        title_id=STRING,
        title_name=STRING,
        season_number=INT,
        finished_window_flag=INT,
        predicted_first_views=DOUBLE,
        schedule_label=STRING,
    ),
    "future_forecast": _schema(
        title_name=STRING,
        season_number=INT,
        premiere_date=DATE,
        tier=STRING,
        content_category=STRING,
        category=STRING,
        first_views_pred=DOUBLE,
        schedule_label=STRING,
    ),
}

RESULT_SCHEMA = _schema(
    title_id=STRING,
    match_id=STRING,
    title_name=STRING,
    title_name_season=STRING,
    effective_start_date=DATE,
    tier=STRING,
    season_number=INT,
    category=STRING,
    content_category=STRING,
    activepct_28d=DOUBLE,
    viewpct_retail_28d=DOUBLE,
    firstview_90d=DOUBLE,
    phase_28d=STRING,
    phase_90d=STRING,
)


@dataclass(frozen=True)
class Tables:
    """Lazy handles on the inputs; nothing is read until a plan built from them runs."""

    entity_base: DataFrame
    active_snapshot: DataFrame
    funnel_metrics: DataFrame
    active_forecast: DataFrame
    view_forecast: DataFrame
    daily_forecast: DataFrame
    future_forecast: DataFrame


def conform(df: DataFrame, name: str, **computed: Column) -> DataFrame:
    """The declared columns of an input, taken from ``df`` or ``computed``, in their declared types.

    A cast to the type a column already has is dropped by the optimizer, so filters still reach the files. Columns that
    are only compared are not cast if the source holds whole numbers of another width, because a filter on a cast column
    would not.
    """

    def column(field: StructField) -> Column:
        if field.name in computed:
            return computed[field.name].cast(field.dataType)
        if field.name in COMPARED and _is_whole(df.schema[field.name].dataType):
            return F.col(field.name)
        return F.col(field.name).cast(field.dataType)

    return df.select(*[column(field).alias(field.name) for field in SCHEMAS[name]])


def _is_whole(kind: DataType) -> bool:
    return isinstance(kind, IntegralType) or (isinstance(kind, DecimalType) and kind.scale == 0)


def from_parquet(spark: SparkSession, root: str) -> Tables:
    """Inputs stored as ``<root>/<table>``, one Parquet file or folder each."""
    return Tables(**{name: conform(spark.read.parquet(f"{root}/{name}"), name) for name in SCHEMAS})


# What forecasts are laid out by: the endpoint needs one target day, and each of its picks some phases.
FORECAST_LAYOUT = ["target_day", "phase"]


def write_forecasts(df: DataFrame, path: str) -> None:
    """A forecast table in folders by target day and phase, so that the endpoint opens those of its day only.

    Rows are rebalanced by both, not shuffled to a task per folder: AQE splits a folder that holds much into several tasks
    and puts several small ones into one. NULLs get folders of their own and come back as NULL.
    """
    df.hint("rebalance", *[F.col(c) for c in FORECAST_LAYOUT]).write.partitionBy(*FORECAST_LAYOUT).parquet(path)


def from_catalog(spark: SparkSession, names: Mapping[str, str]) -> Tables:
    """Inputs held in the session's catalog; ``names`` maps an input to its (one- to three-part) table name."""
    if unknown := set(names) - set(SCHEMAS):
        raise ValueError(f"no such input: {sorted(unknown)}; inputs are {sorted(SCHEMAS)}")
    return Tables(**{name: conform(spark.table(names.get(name, name)), name) for name in SCHEMAS})


def from_values(spark: SparkSession, values: Sequence[int], column: str) -> DataFrame:
    """A one-column table of numbers written in the program."""
    return spark.createDataFrame([(value,) for value in values], f"`{column}` bigint")
