"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.functions.calendar import day_attributes, monday_of, month_label
from skyloom.operators.merge import number_rows, upsert

SEASON_COLUMNS = (
    "season_id int, name string, hemisphere string, season_type string, start_month int, "
    "end_month int, precipitation_type string, is_growing_season boolean, color_code string, "
    "description string"
)
LAYER_COLUMNS = (
    "layer_id int, name string, medium string, vertical_level_m double, pressure_hpa double, "
    "is_standard_wmo boolean, layer_category string, description string"
)
SEVERITY_COLUMNS = "severity_id int, severity_level string, color_code string, description string"
CITY_COLUMNS = (
    "city_id int, city_code string, city_name string, latitude decimal(9,6), "
    "longitude decimal(9,6), country_code string, is_coastal int, created_at timestamp_ntz"
)
STATION_COLUMNS = (
    "id int, station_id string, station_name string, province string, altitude decimal(7,2), "
    "latitude decimal(9,6), longitude decimal(9,6), synop_code string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)
CITY_UPDATES = ["city_name", "latitude", "longitude", "country_code", "is_coastal"]
STATION_UPDATES = ["station_name", "province", "altitude", "latitude", "longitude"]


# -- calendar ---------------------------------------------------------------


def dim_date(bounds: DataFrame, week_rule: str = "iso") -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of the one-row ``bounds``."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    attributes = day_attributes(F.col("day"), week_rule)
    return days.select(*[value.alias(name) for name, value in attributes.items()])


def default_bounds(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit(fixed.CALENDAR_FIRST_DAY).cast("date").alias("first_day"),
        F.lit(fixed.CALENDAR_LAST_DAY).cast("date").alias("last_day"),
    )


def dim_week(dates: DataFrame, week_rule: str = "iso") -> DataFrame:
    """One row per week of ``dim_date``."""
    number = F.lpad(F.col("id_week").cast("string"), 2, "0")
    if week_rule == "iso":
        weeks = dates.groupBy("id_calendar_week").agg(F.min("dt_date").alias("first_day"))
        monday = monday_of(F.col("first_day"))
        sunday = F.date_add(monday, 6)
        weeks = weeks.select(
            "id_calendar_week",
            F.floor(F.col("id_calendar_week") / 100).cast("int").alias("id_year"),
            (F.col("id_calendar_week") % 100).alias("id_week"),
            monday.alias("dt_monday_of_week"),
            sunday.alias("dt_sunday_of_week"),
        )
        label = F.concat(F.lit("W"), number, F.lit(" "), F.col("id_year"))
        span = F.concat(
            F.date_format("dt_monday_of_week", "dd/MM"), F.lit(" - "),
            F.date_format("dt_sunday_of_week", "dd/MM"),
        )
    else:
        weeks = dates.groupBy("id_calendar_week", "id_year", "id_week").agg(
            F.min("dt_date").alias("dt_monday_of_week"),
            F.max("dt_date").alias("dt_sunday_of_week"),
        )
        label = F.concat(F.lit("W"), number, F.lit("-"), F.col("id_year"))
        span = F.concat(
            F.col("dt_monday_of_week").cast("string"), F.lit(" / "),
            F.col("dt_sunday_of_week").cast("string"),
        )
    return weeks.select(
        "id_calendar_week", "id_year", "id_week",
        label.alias("ds_calendar_week"), span.alias("ds_week_from_to"),
        "dt_monday_of_week", "dt_sunday_of_week",
    )


def dim_month(dates: DataFrame, week_rule: str = "iso") -> DataFrame:
    """One row per month of ``dim_date``; the label is padded under the calendar rule."""
    keys = ["id_calendar_month", "id_month", "id_year", "id_quarter",
            "id_calendar_quarter", "id_calendar_semester"]
    first = F.min("dt_date")
    if week_rule == "iso":
        first = F.trunc(first, "month")
    months = dates.groupBy(*keys).agg(first.alias("dt_month_first_day"))
    label = month_label(F.col("dt_month_first_day"), padded=week_rule != "iso")
    return months.select(*keys, label.alias("ds_calendar_month"), "dt_month_first_day")


# -- reference rows ---------------------------------------------------------


def _seeded(spark: SparkSession, base: list, local: list, columns: str, key: str, both: bool):
    first = spark.createDataFrame(base, columns)
    if not both:
        return first
    second = spark.createDataFrame(local, columns)
    return upsert(first, second, [key], [c for c in first.columns if c != key])


def dim_seasons(spark: SparkSession, both: bool = True) -> DataFrame:
    """Base rows, with the local rows merged over them when ``both``."""
    return _seeded(spark, fixed.SEASONS_BASE, fixed.SEASONS_LOCAL, SEASON_COLUMNS, "season_id", both)


def dim_layers(spark: SparkSession, both: bool = True) -> DataFrame:
    return _seeded(spark, fixed.LAYERS_BASE, fixed.LAYERS_LOCAL, LAYER_COLUMNS, "layer_id", both)


def dim_severity(spark: SparkSession, both: bool = True) -> DataFrame:
    return _seeded(
        spark, fixed.SEVERITY_BASE, fixed.SEVERITY_LOCAL, SEVERITY_COLUMNS, "severity_id", both
    )


def season_months(seasons: DataFrame) -> DataFrame:
    """One row per season and month, so that a season lookup is an equi-join.

    A season that starts late in the year runs on into the next one.
    """
    span = (F.col("end_month") - F.col("start_month") + 12) % 12
    month = (F.col("start_month") - 1 + F.col("step")) % 12 + 1
    return seasons.withColumn("step", F.explode(F.sequence(F.lit(0), span))).select(
        "season_id", "name", "hemisphere", month.alias("month")
    )


# -- cities and stations ----------------------------------------------------


def empty_table(spark: SparkSession, columns: str) -> DataFrame:
    return spark.createDataFrame([], columns)


def upsert_cities(
    dim: DataFrame, cities: DataFrame, as_of: Column, order: list[str] | None = None
) -> DataFrame:
    """``dim_city`` after merging city rows on ``city_code``."""
    return upsert(dim, cities, ["city_code"], CITY_UPDATES,
                  on_insert={"created_at": as_of}, ident="city_id", order=order)


def upsert_stations(
    dim: DataFrame, feed: DataFrame, as_of: Column, order: list[str] | None = None
) -> DataFrame:
    """``dim_stations`` after merging an inventory on ``station_id``."""
    updates = STATION_UPDATES + [c for c in ("synop_code",) if c in feed.columns]
    return upsert(dim, feed, ["station_id"], updates, on_update={"updated_at": as_of},
                  on_insert={"created_at": as_of, "updated_at": as_of}, ident="id", order=order)


def default_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed.DEFAULT_STATIONS,
        "station_id string, station_name string, province string, altitude double, "
        "latitude double, longitude double",
    )


def load_stations(dim: DataFrame, feed: DataFrame | None, as_of: Column) -> DataFrame:
    """Merge the inventory, or the default stations when there is none."""
    if feed is None or feed.isEmpty():
        return upsert_stations(dim, default_stations(dim.sparkSession), as_of)
    placed = [c for c in ("_src", "_pos") if c in feed.columns]
    return upsert_stations(dim, feed, as_of, placed or None)


def ensure_stations(dim: DataFrame, as_of: Column) -> DataFrame:
    """``dim`` itself, or the default stations when it is empty."""
    return upsert_stations(dim, default_stations(dim.sparkSession), as_of) if dim.isEmpty() else dim


def surrogate_keys(dim: DataFrame, names: DataFrame, key: str, ident: str) -> DataFrame:
    """Ids for the keys of ``names`` that ``dim`` lacks, continuing its last id."""
    new = names.select(key).distinct().join(dim.select(key), key, "left_anti")
    start = dim.agg(F.max(ident)).first()[0] or 0
    numbered = number_rows(new, [key], ident, start)
    return numbered.withColumn(ident, F.col(ident).cast(dict(dim.dtypes)[ident]))


def dims_all(
    spark: SparkSession, cities: DataFrame, week_rule: str, as_of: Column, bounds: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All dimensions; the calendar first, as week and month derive from it."""
    dates = dim_date(bounds if bounds is not None else default_bounds(spark), week_rule)
    return {
        "dim_date": dates,
        "dim_week": dim_week(dates, week_rule),
        "dim_month": dim_month(dates, week_rule),
        "dim_city": upsert_cities(empty_table(spark, CITY_COLUMNS), cities, as_of),
        "dim_seasons": dim_seasons(spark),
        "dim_layers": dim_layers(spark),
        "dim_severity": dim_severity(spark),
        "dim_aemet_stations": upsert_stations(
            empty_table(spark, STATION_COLUMNS), default_stations(spark), as_of
        ),
    }
