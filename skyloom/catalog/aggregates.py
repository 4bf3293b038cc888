"""Deduplication, uniqueness and counting."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog.registry import as_of, query, rounded, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import dedupe
from skyloom.plans import facts
from skyloom.quality import metrics

_FIRST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


@query(
    "dedupe_first",
    with_views(
        "v_hourly",
        "SELECT city_name, time, event_id, temperature_2m, weather_code FROM v_hourly "
        + _FIRST.format(key="city_name, time", order="event_id"),
    ),
)
def dedupe_first(spark, sf_dir):
    rows = view(spark, sf_dir, "v_hourly").select("city_name", "time", "event_id", "temperature_2m", "weather_code")
    return dedupe.keep_first(rows, ["city_name", "time"], ["event_id"])


@query(
    "dedupe_station_day",
    with_views(
        "v_clim",
        "SELECT station_id, date, o_orderkey, temp_avg FROM v_clim "
        + _FIRST.format(key="station_id, date", order="o_orderkey"),
    ),
)
def dedupe_station_day(spark, sf_dir):
    rows = view(spark, sf_dir, "v_clim").select("station_id", "date", "o_orderkey", "temp_avg")
    return dedupe.keep_first(rows, ["station_id", "date"], ["o_orderkey"])


@query(
    "uniqueness_score",
    """WITH k AS (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS o, l_linenumber AS l FROM lineitem)
SELECT (SELECT count(*) FROM k) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT o, l FROM k)) AS distinct_keys,
  round((SELECT count(*) FROM (SELECT DISTINCT o, l FROM k)) / (SELECT count(*) FROM k), 6) AS uniqueness""",
)
def uniqueness_score(spark, sf_dir):
    """Nulls in the key count as values."""
    order = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    rows = table(spark, sf_dir, "lineitem").select(order.alias("o"), F.col("l_linenumber").alias("l"))
    return rounded(metrics.uniqueness_score(rows, ["o", "l"]), "uniqueness")


@query(
    "duplicate_members",
    """WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 AS is_unique,
  cast(coalesce(sum(n) FILTER (WHERE n > 1), 0) as bigint) AS duplicate_rows FROM g""",
)
def duplicate_members(spark, sf_dir):
    return dedupe.duplicate_members(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "load_accounting",
    with_views(
        "v_marine v_city",
        """, k AS (SELECT event_type, time, extraction_date, c.city_id, CASE
    WHEN coalesce(wave_height_max, wave_direction_dominant, wave_period_max, wind_wave_height_max,
      swell_wave_height_max) IS NULL THEN 'all_null'
    WHEN c.city_id IS NULL THEN 'unknown_city' ELSE 'ok' END AS r
  FROM v_marine LEFT JOIN v_city c USING (city_name)),
t AS (SELECT DISTINCT city_id, time, extraction_date FROM k WHERE r = 'ok' AND event_type = 'click'),
f AS (SELECT DISTINCT city_id, time, extraction_date FROM k WHERE r = 'ok'),
n AS (SELECT (SELECT count(*) FROM k WHERE r = 'ok') AS keyed, (SELECT count(*) FROM f) AS firsts,
  (SELECT count(*) FROM t) AS known)
SELECT r AS outcome, count(*) AS n_rows FROM k WHERE r <> 'ok' GROUP BY r
UNION ALL SELECT 'duplicate', keyed - firsts FROM n
UNION ALL SELECT 'conflict', known FROM n
UNION ALL SELECT 'loaded', firsts - known FROM n""",
    ),
)
def load_accounting(spark, sf_dir):
    """What came with clicks is loaded already when the feed arrives."""
    marine, cities = view(spark, sf_dir, "v_marine"), view(spark, sf_dir, "v_city")
    spec = facts.FACTS["marine"]
    known = facts.key_rows(marine.filter(F.col("event_type") == "click"), spec, cities)
    known = known.filter(F.col("reject_reason").isNull()).select(*spec.key)
    return facts.load_accounting(marine, spec, cities, as_of(), ["event_id"], known)
