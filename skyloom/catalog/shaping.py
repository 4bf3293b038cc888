"""Flattening of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog import shapes
from skyloom.catalog.registry import query
from skyloom.catalog.scalars import dms_sql
from skyloom.catalog.shapes import feed_rows_sql, view, with_views
from skyloom.operators import flatten
from skyloom.operators.flatten import FEEDS
from skyloom.session import scratch_path


def _exploded(spark, sf_dir, feed, section=None):
    docs = shapes.feed_documents(spark, sf_dir, feed, section)
    return flatten.explode_columnar(docs, FEEDS[feed]).drop("_src", "_pos")


@query(
    "flatten_observation",
    with_views(
        "v_obs",
        """SELECT * EXCLUDE (event_id), 'current/' || date || '/weather_' || event_id || '.json' AS bronze_source
FROM v_obs""",
    ),
)
def flatten_observation(spark, sf_dir):
    return flatten.flatten_observations(shapes.observation_documents(spark, sf_dir))


def _register(name, feed):
    @query(name, feed_rows_sql(feed))
    def run(spark, sf_dir):
        return _exploded(spark, sf_dir, feed)

    run.__name__ = name


for _name, _feed in (
    ("explode_daily", "daily"), ("explode_hourly", "hourly"), ("explode_air_quality", "air_quality"),
    ("explode_pollen", "pollen"), ("explode_marine", "marine"),
):
    _register(_name, _feed)


def _stored_variant(spark, docs):
    """Documents written as VARIANT and read back."""
    path = scratch_path(spark, "variant")
    flatten.as_variant(docs).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "flatten_observation_variant",
    with_views(
        "v_obs",
        """SELECT * EXCLUDE (event_id), 'current/' || date || '/weather_' || event_id || '.json' AS bronze_source
FROM v_obs""",
    ),
)
def flatten_observation_variant(spark, sf_dir):
    """From documents stored as VARIANT: parsed once, absent and null members told apart without the text."""
    return flatten.flatten_observations(_stored_variant(spark, shapes.observation_documents(spark, sf_dir)))


@query("explode_hourly_variant", feed_rows_sql("hourly"))
def explode_hourly_variant(spark, sf_dir):
    docs = _stored_variant(spark, shapes.feed_documents(spark, sf_dir, "hourly"))
    return flatten.explode_columnar(docs, FEEDS["hourly"]).drop("_src", "_pos")


@query(
    "explode_columnar",
    with_views(
        "v_pollen",
        """, p AS (SELECT *, floor(event_id / 64) AS chunk FROM v_pollen)
SELECT 'pollen/' || extraction_date || '/' || lower(city_name) || '_' || lpad(cast(cast(chunk as bigint) as varchar), 12, '0') || '.json' AS _src,
  cast(row_number() OVER (PARTITION BY city_name, extraction_date, chunk ORDER BY event_id) - 1 as int) AS _pos,
  time, alder_pollen, ragweed_pollen
FROM p""",
    ),
)
def explode_columnar(spark, sf_dir):
    docs = shapes.feed_documents(spark, sf_dir, "pollen")
    rows = flatten.explode_columnar(docs, FEEDS["pollen"])
    return rows.select("_src", "_pos", "time", "alder_pollen", "ragweed_pollen")


@query("section_fallback", feed_rows_sql("air_quality"))
def section_fallback(spark, sf_dir):
    """The hourly feed sent under ``daily``: the other section stands in."""
    return _exploded(spark, sf_dir, "air_quality", section="daily")


_FLAT_CLIMATE = [name for _, name in flatten.CLIMATOLOGY]


@query(
    "flatten_stations",
    with_views(
        "v_station_raw",
        f"""SELECT indicativo AS station_id, nombre AS station_name, provincia AS province,
  CASE WHEN altitud = 'Ip' THEN NULL ELSE cast(replace(altitud, ',', '.') as double) END AS altitude,
  {dms_sql('latitud')} AS latitude, {dms_sql('longitud')} AS longitude,
  indsinop AS synop_code, '2024-01-31' AS extraction_date
FROM v_station_raw""",
    ),
)
def flatten_stations(spark, sf_dir):
    return flatten.flatten_stations(shapes.station_documents(spark, sf_dir)).drop("_src", "_pos")


@query(
    "flatten_climatology",
    with_views(
        "v_clim",
        f"SELECT station_id, station_name, province, date, {', '.join(_FLAT_CLIMATE)}, extraction_date FROM v_clim",
    ),
)
def flatten_climatology(spark, sf_dir):
    docs = shapes.climatology_documents(spark, sf_dir)
    return flatten.flatten_climatology(docs).drop("_src", "_pos")


@query(
    "flatten_historical",
    with_views(
        "v_clim",
        f"SELECT station_id, station_name, province, date, year, {', '.join(_FLAT_CLIMATE)}, extraction_date FROM v_clim",
    ),
)
def flatten_historical(spark, sf_dir):
    docs = shapes.climatology_documents(spark, sf_dir)
    return flatten.flatten_climatology(docs, with_year=True).drop("_src", "_pos")


@query(
    "union_by_name",
    with_views(
        "v_air_quality v_pollen",
        """SELECT event_id, time, city_name, pm10, ozone, NULL::double AS grass_pollen FROM v_air_quality
UNION ALL
SELECT event_id, time, city_name, NULL, NULL, grass_pollen FROM v_pollen""",
    ),
)
def union_by_name(spark, sf_dir):
    air = view(spark, sf_dir, "v_air_quality").select("event_id", "time", "city_name", "pm10", "ozone")
    pollen = view(spark, sf_dir, "v_pollen").select("event_id", "time", "city_name", "grass_pollen")
    return flatten.union_by_name(air, pollen)


@query(
    "reject_split",
    with_views(
        "v_pollen",
        """, d AS (SELECT DISTINCT extraction_date, city_name, cast(floor(event_id / 64) as bigint) AS chunk FROM v_pollen)
SELECT 'pollen/' || extraction_date || '/' || lower(city_name) || '_' || lpad(cast(chunk as varchar), 12, '0') || '.json' AS path,
  CASE chunk % 5 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'no_time' WHEN 3 THEN 'ragged_arrays'
    WHEN 4 THEN 'null_section' END AS reject_reason
FROM d WHERE chunk % 5 <> 0""",
    ),
)
def reject_split(spark, sf_dir):
    """Four of five document groups are broken on purpose, each in another way."""
    rows = shapes.packed(spark, sf_dir, "pollen")
    kind = F.col("chunk") % 5
    time = F.transform("items", lambda x: x["time"])
    grass = F.transform("items", lambda x: x["grass_pollen"])
    body = F.to_json(
        F.struct(
            "city_code",
            F.struct(
                F.when(kind != 2, time).alias("time"),
                F.when(kind == 3, F.array_append(grass, F.lit(1.0))).otherwise(grass).alias("grass_pollen"),
            ).alias("hourly"),
            F.struct(F.col("extraction_date").alias("execution_date")).alias("_metadata"),
        )
    )
    null_meta = F.regexp_replace(body, r'"_metadata":\{[^}]*\}', '"_metadata":null')
    text = (
        F.when(kind == 1, F.substr(body, F.lit(1), F.length(body) - 5))
        .when(kind == 4, null_meta)
        .otherwise(body)
    )
    docs = shapes.documents(rows, shapes.document_path("pollen"), text)
    return flatten.rejects(flatten.parse_columnar(docs, FEEDS["pollen"]))


@query(
    "city_projection",
    with_views(
        "v_city_file",
        """SELECT city_code, city_name AS municipio_nombre, latitud AS latitude, longitud AS longitude
FROM v_city_file""",
    ),
)
def city_projection(spark, sf_dir):
    return flatten.city_projection(view(spark, sf_dir, "v_city_file"))
