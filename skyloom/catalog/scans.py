"""Sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog import shapes
from skyloom.catalog.registry import plain, query, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators.flatten import FEEDS
from skyloom.session import scratch_path
from skyloom.sources import lake

_DOCS_PER_DAY = """
SELECT extraction_date AS execution_date, cast(count(*) as bigint) AS n_documents,
  cast(sum(points) as bigint) AS n_points, cast(sum(present) as bigint) AS n_present
FROM (SELECT city_name, extraction_date, floor(event_id / 64) AS chunk, count(*) AS points,
        count(pm10) AS present
      FROM v_air_quality GROUP BY ALL)
GROUP BY extraction_date"""


@query("bronze_json_scan", with_views("v_air_quality", _DOCS_PER_DAY))
def bronze_json_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    shapes.feed_documents(spark, sf_dir, "air_quality").select("text").write.text(path)
    docs = lake.read_json(spark, path, FEEDS["air_quality"].schema(), multi_line=False)
    present = F.size(F.filter("hourly.pm10", lambda x: x.isNotNull()))
    return docs.groupBy(F.col("_metadata.execution_date").alias("execution_date")).agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size("hourly.time")).cast("long").alias("n_points"),
        F.sum(present).cast("long").alias("n_present"),
    )


@query(
    "silver_parquet_scan",
    """SELECT event_id, user_id, value FROM events
WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-10 00:00:00'""",
)
def silver_parquet_scan(spark, sf_dir):
    rows = lake.read_table(spark, f"{sf_dir}/events.parquet")
    late = F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return rows.filter((F.col("event_type") != "error") & late).select("event_id", "user_id", "value")


@query(
    "prefix_scan",
    with_views(
        "v_pollen",
        """SELECT extraction_date AS date, count(*) AS n_rows, true AS has_files
FROM v_pollen GROUP BY extraction_date""",
    ),
)
def prefix_scan(spark, sf_dir):
    root = scratch_path(spark, "silver")
    rows = view(spark, sf_dir, "v_pollen").withColumn("day", F.col("extraction_date"))
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(f"{root}/pollen")
    day = r"day=(\d{4}-\d{2}-\d{2})"
    files = lake.list_objects(spark, root, "pollen", ".parquet")
    listed = files.groupBy(F.regexp_extract("path", day, 1).alias("date")).agg(
        (F.sum("length") > 0).alias("has_files")
    )
    scanned = lake.read_table(spark, f"{root}/pollen")
    counts = scanned.groupBy(
        F.regexp_extract(F.col("_metadata.file_path"), day, 1).alias("date")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(listed, "date").select("date", "n_rows", "has_files")


def _snapshot_rows(spark, sf_dir):
    rows = view(spark, sf_dir, "v_hourly").select("event_id", "time", "extraction_date")
    stamp = F.concat(
        F.replace("extraction_date", F.lit("-"), F.lit("")), F.lit("_"),
        F.substring("time", 12, 2), F.lit("0000"),
    )
    path = lake.render_path(fixed.SILVER_PATHS["hourly"], date=F.col("extraction_date"), timestamp=stamp)
    return rows.select("event_id", path.alias("path")).withColumn(
        "prefix", F.regexp_extract("path", "^(.*/)", 1)
    )


@query(
    "latest_snapshot",
    with_views(
        "v_hourly",
        """, p AS (SELECT event_id, 'forecast/hourly/' || extraction_date || '/' AS prefix,
  'forecast/hourly/' || extraction_date || '/hourly_forecast_' || replace(extraction_date, '-', '')
  || '_' || substr(time, 12, 2) || '0000.parquet' AS path FROM v_hourly)
SELECT event_id, prefix, path FROM p
QUALIFY path = max(path) OVER (PARTITION BY prefix)""",
    ),
)
def latest_snapshot(spark, sf_dir):
    return lake.latest_snapshot(_snapshot_rows(spark, sf_dir)).select("event_id", "prefix", "path")


@query(
    "historical_scan",
    with_views(
        "v_clim",
        """SELECT station_id, count(*) AS n_rows, count(temp_avg) AS n_temperatures,
  min(date) AS first_date, max(date) AS last_date FROM v_clim GROUP BY station_id""",
    ),
)
def historical_scan(spark, sf_dir):
    root = scratch_path(spark, "historical")
    rows = view(spark, sf_dir, "v_clim").select("station_id", "date", "temp_avg", "year")
    rows.hint("rebalance", "year").write.partitionBy("year").parquet(root)
    columns = "station_id string, date string, temp_avg double"
    read = lake.read_table(spark, f"{root}/year=*", columns, skip_bad_files=True)
    return read.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("temp_avg").alias("n_temperatures"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


@query("city_csv_scan", with_views("v_city_file", "SELECT * FROM v_city_file"))
def city_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "cities")
    view(spark, sf_dir, "v_city_file").write.option("header", "true").csv(path)
    return lake.read_city_csv(spark, path)


@query(
    "path_partition_parse",
    """SELECT event_id, cast(cast(ts as date) as varchar) AS date,
  'nation_' || (user_id % 27) AS city,
  strftime(ts, '%Y%m%d_%H%M%S') AS timestamp
FROM events""",
)
def path_partition_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = lake.render_path(
        fixed.BRONZE_PATHS["observation"],
        date=F.col("ts").cast("date").cast("string"),
        city=F.lower(F.concat(F.lit("NATION_"), (F.col("user_id") % 27).cast("string"))),
        timestamp=F.date_format("ts", "yyyyMMdd_HHmmss"),
    )
    parts = lake.parse_path(F.col("path"), fixed.BRONZE_PATHS["observation"])
    return events.select("event_id", F.concat(F.lit("lake/"), path).alias("path")).select(
        "event_id", *[value.alias(name) for name, value in parts.items()]
    )


@query(
    "period_chunks",
    """WITH b AS (SELECT cast(max(o_orderdate) as date) AS as_of, year(min(o_orderdate)) AS y1,
  year(max(o_orderdate)) AS y2 FROM orders),
q AS (SELECT as_of, cast(s as date) AS s FROM b,
  unnest(generate_series(make_date(y1, 1, 1)::timestamp, make_date(y2, 10, 1)::timestamp, interval 3 month)) u(s))
SELECT s_suppkey, cast(year(s) as int) AS year, cast(quarter(s) as int) AS quarter, cast(s as varchar) AS start_date,
  cast(least(cast(s + interval 3 month - interval 1 day as date), as_of) as varchar) AS end_date
FROM supplier, q WHERE s <= as_of""",
)
def period_chunks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    span = orders.agg(F.struct(F.year(F.min(day)).alias("y1"), F.year(F.max(day)).alias("y2"),
                               F.max(day).cast("date").alias("as_of")).alias("span"))
    stations = table(spark, sf_dir, "supplier").select("s_suppkey", span.scalar().alias("span"))
    chunks = lake.period_chunks(
        stations, F.col("span.y1"), F.col("span.y2"), F.col("span.as_of")
    )
    return plain(chunks.drop("span"))


@query(
    "lookback_window",
    """SELECT o_orderkey, cast(cast(o_orderdate as date) as varchar) AS order_date FROM orders
WHERE cast(o_orderdate as date) BETWEEN (SELECT cast(max(o_orderdate) as date) - 30 FROM orders)
  AND (SELECT cast(max(o_orderdate) as date) FROM orders)""",
)
def lookback_window(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderdate")).scalar()
    start, end = lake.lookback(last)
    day = F.col("o_orderdate").cast("date")
    kept = orders.filter((day >= start) & (day <= end))
    return kept.select("o_orderkey", day.cast("string").alias("order_date"))


@query(
    "bronze_envelope",
    """SELECT '{"event_id":' || event_id || ',"city_name":"NATION_' || (user_id % 27)
  || '","_metadata":{"extraction_timestamp":"20240131_060000","execution_date":"'
  || cast(cast(ts as date) as varchar) || '","record_count":1}}' AS text
FROM events""",
)
def bronze_envelope(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    payload = events.select(
        "event_id", F.concat(F.lit("NATION_"), (F.col("user_id") % 27).cast("string")).alias("city_name"),
        F.col("ts").cast("date").cast("string").alias("_day"),
    )
    run_at = F.lit("2024-01-31 06:00:00").cast("timestamp_ntz")
    return lake.bronze_envelope(
        payload, run_at, F.col("_day"), payload=["event_id", "city_name"], record_count=F.lit(1)
    )

