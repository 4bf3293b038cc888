"""Fact loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog import shapes
from skyloom.catalog.registry import AS_OF, as_of, plain, query
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import flatten
from skyloom.operators.flatten import FEEDS
from skyloom.plans import facts
from skyloom.plans.facts import FACTS


def _value_sql(source: str, rule: str) -> str:
    if rule == "int":
        return f"cast(round({source}) as int)"
    if rule == "truncated int":
        return f"cast(trunc({source}) as int)"
    if rule == "time":
        return f"substr({source}, 12, 5) || ':00'"
    if rule == "string":
        return source
    return f"cast(cast({source} as {rule}) as double)"


_MOMENT_SQL = {
    "date": "cast(replace({0}, '-', '') as int)",
    "iso": "replace({0}, 'T', ' ') || ':00'",
    "epoch": "strftime(make_timestamp(cast({0} * 1000000 as bigint)), '%Y-%m-%d %H:%M:%S')",
}


def load_sql(feed: str, where: str = "true", absent: str = "true") -> str:
    """Look up, keep the first row per key, type; ``absent`` removes loaded keys."""
    spec = FACTS[feed]
    source, order = ("v_clim", "o_orderkey") if feed == "station_day" else (f"v_{feed.replace('observation', 'obs')}", "event_id")
    dim, ident, name = ("v_station", "id", "station_id") if spec.entity == "station" else ("v_city", "city_id", "city_name")
    moment = _MOMENT_SQL[spec.moment_rule].format(f"f.{spec.moment_from}")
    run_day = f"cast(replace(f.{spec.run_date}, '-', '') as int)"
    data = f"f.{spec.sources[0]}" if not spec.drop_all_null else f"coalesce({', '.join('f.' + s for s in spec.sources)})"
    kept = f"{data} IS NOT NULL" if spec.drop_all_null else "true"
    values = ",\n  ".join(f"{_value_sql(s, rule)} AS {t}" for s, t, rule in spec.columns)
    label = f"'{fixed.DATA_SOURCE[feed]}' AS data_source, " if feed in fixed.DATA_SOURCE else ""
    return with_views(
        f"{source} {dim}",
        f""", s AS (SELECT f.* EXCLUDE ({spec.run_date}), d.{ident} AS key_1, {moment} AS key_2, {run_day} AS key_3
  FROM {source} f JOIN {dim} d ON d.{name} = f.{spec.entity_from}
  WHERE ({where}) AND {kept} AND {moment} IS NOT NULL),
k AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY key_1, key_2, key_3 ORDER BY {order}) = 1)
SELECT key_1 AS {spec.entity_id}, key_2 AS {spec.moment}, key_3 AS {spec.run_date_id},
  {values}, {label}'{AS_OF}' AS created_at
FROM k WHERE {absent}""",
    )


def _load(spark, sf_dir, feed, target=None):
    rows = view(spark, sf_dir, "v_obs" if feed == "observation" else f"v_{feed}")
    cities = view(spark, sf_dir, "v_city")
    return plain(facts.build_fact(rows, FACTS[feed], cities, as_of(), ["event_id"], target))


def _register(name, feed):
    @query(name, load_sql(feed))
    def run(spark, sf_dir):
        return _load(spark, sf_dir, feed)


_register("load_observation", "observation")
_register("load_forecast_daily", "daily")
_register("load_air_quality", "air_quality")
_register("load_pollen", "pollen")
_register("load_marine", "marine")


@query("load_forecast_hourly", load_sql("hourly", where="floor(event_id / 64) % 17 <> 0"))
def load_forecast_hourly(spark, sf_dir):
    """From documents to fact rows; documents without a city are refused."""
    docs = shapes.feed_documents(spark, sf_dir, "hourly")
    silver = flatten.explode_columnar(docs, FEEDS["hourly"])
    cities = view(spark, sf_dir, "v_city")
    return plain(facts.build_fact(silver, FACTS["hourly"], cities, as_of(), ["_src", "_pos"]))


@query(
    "load_generic",
    load_sql(
        "hourly",
        absent="""NOT EXISTS (SELECT 1 FROM s t WHERE t.event_type = 'click' AND t.key_1 = k.key_1
  AND t.key_2 = k.key_2 AND t.key_3 = k.key_3)""",
    ),
)
def load_generic(spark, sf_dir):
    """What came with clicks is in the table already."""
    hourly, cities = view(spark, sf_dir, "v_hourly"), view(spark, sf_dir, "v_city")
    spec = FACTS["hourly"]
    loaded = facts.key_rows(hourly.filter(F.col("event_type") == "click"), spec, cities)
    target = loaded.filter(F.col("reject_reason").isNull()).select(*spec.key).distinct()
    return _load(spark, sf_dir, "hourly", target)


@query("load_station_daily", load_sql("station_day"))
def load_station_daily(spark, sf_dir):
    rows, stations = view(spark, sf_dir, "v_clim"), view(spark, sf_dir, "v_station")
    return plain(facts.build_fact(rows, FACTS["station_day"], stations, as_of(), ["o_orderkey"]))


@query("load_station_historical", load_sql("station_day"))
def load_station_historical(spark, sf_dir):
    """All historical documents in one pass, first record per key in file order."""
    silver = flatten.flatten_climatology(shapes.climatology_documents(spark, sf_dir), with_year=True)
    stations = view(spark, sf_dir, "v_station")
    return plain(facts.build_fact(silver, FACTS["station_day"], stations, as_of(), ["_src", "_pos"]))
