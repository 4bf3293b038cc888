"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog.registry import query, table
from skyloom.catalog.shapes import view, with_views
from skyloom.functions import clean

_READABLE = "CASE WHEN {c} IN ('Ip', 'Acum', '') THEN NULL ELSE cast(replace({c}, ',', '.') as double) END"


@query(
    "locale_number",
    with_views(
        "v_clim_raw",
        "SELECT o_orderkey, "
        + ", ".join(f"{_READABLE.format(c=c)} AS {c}" for c in ("tmed", "prec", "sol", "presMax"))
        + " FROM v_clim_raw",
    ),
)
def locale_number(spark, sf_dir):
    rows = view(spark, sf_dir, "v_clim_raw")
    names = ["tmed", "prec", "sol", "presMax"]
    return rows.select("o_orderkey", *[clean.locale_number(F.col(c)).alias(c) for c in names])


def dms_sql(column: str) -> str:
    body, side = f"substr({column}, 1, length({column}) - 1)", f"upper(right({column}, 1))"
    width = f"(length({column}) - 5)"
    value = (
        f"(cast(substr({body}, 1, {width}) as int) + cast(substr({body}, {width} + 1, 2) as int) / 60.0e0"
        f" + cast(substr({body}, {width} + 3, 2) as int) / 3600.0e0)"
    )
    signed = f"CASE WHEN {side} IN ('S', 'W') THEN 0 - {value} ELSE {value} END"
    return f"CASE WHEN length({column}) < 6 THEN NULL ELSE round({signed}, 6) END"


@query(
    "dms_to_decimal",
    with_views(
        "v_station_raw",
        f"SELECT s_suppkey, {dms_sql('latitud')} AS latitude, {dms_sql('longitud')} AS longitude FROM v_station_raw",
    ),
)
def dms_to_decimal(spark, sf_dir):
    rows = view(spark, sf_dir, "v_station_raw")
    return rows.select(
        "s_suppkey",
        clean.dms_to_decimal(F.col("latitud")).alias("latitude"),
        clean.dms_to_decimal(F.col("longitud")).alias("longitude"),
    )


@query(
    "date_id",
    """SELECT event_id, cast(strftime(ts, '%Y%m%d') as int) AS from_timestamp,
  cast(strftime(ts, '%Y%m%d') as int) AS from_text, cast(NULL as int) AS from_word
FROM events""",
)
def date_id(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        clean.date_id(F.col("ts")).alias("from_timestamp"),
        clean.date_id(F.col("ts").cast("date").cast("string")).alias("from_text"),
        clean.date_id(F.col("event_type")).alias("from_word"),
    )


@query(
    "clean_nan",
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, event_type FROM events",
)
def clean_nan(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    broken = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return clean.normalise_nan(events.select("event_id", broken.alias("value"), "event_type"))


@query(
    "epoch_to_ts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS observed_at FROM events""",
)
def epoch_to_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    moment = clean.epoch_to_ts(clean.ts_to_epoch(F.col("ts")))
    return events.select("event_id", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("observed_at"))


@query(
    "iso_to_ts",
    with_views(
        "v_hourly",
        """SELECT event_id, strftime(cast(replace(time, 'T', ' ') || ':00' as timestamp), '%Y-%m-%d %H:%M:%S') AS moment,
  cast(extraction_date as varchar) || ' 00:00:00' AS day_start, cast(NULL as varchar) AS unreadable
FROM v_hourly""",
    ),
)
def iso_to_ts(spark, sf_dir):
    rows = view(spark, sf_dir, "v_hourly")

    def shown(column):
        return F.date_format(clean.iso_to_ts(column), "yyyy-MM-dd HH:mm:ss")

    return rows.select(
        "event_id",
        shown(F.col("time")).alias("moment"),
        shown(F.col("extraction_date")).alias("day_start"),
        shown(F.col("city_name")).alias("unreadable"),
    )


@query(
    "time_of_day",
    with_views(
        "v_daily",
        """SELECT event_id, substr(sunrise, 12, 5) || ':00' AS sunrise, substr(sunset, 12, 5) || ':00' AS sunset
FROM v_daily""",
    ),
)
def time_of_day(spark, sf_dir):
    rows = view(spark, sf_dir, "v_daily")
    return rows.select(
        "event_id", *[clean.time_of_day(F.col(c)).alias(c) for c in ("sunrise", "sunset")]
    )


@query(
    "map_marine",
    with_views(
        "v_marine",
        """SELECT event_id, cast(trunc(wave_direction_dominant) as int) AS wave_direction_dominant,
  cast(round(wave_direction_dominant) as int) AS rounded_direction,
  cast(cast(wave_height_max as decimal(5,2)) as double) AS wave_height_max
FROM v_marine""",
    ),
)
def map_marine(spark, sf_dir):
    rows = view(spark, sf_dir, "v_marine")
    direction = F.col("wave_direction_dominant")
    return rows.select(
        "event_id",
        clean.truncated_number(direction).alias("wave_direction_dominant"),
        clean.whole_number(direction).alias("rounded_direction"),
        clean.typed(F.col("wave_height_max"), "decimal(5,2)").cast("double").alias("wave_height_max"),
    )
