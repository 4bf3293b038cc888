"""Weather-shaped views over the given tables.

Each view is one SELECT that Spark and DuckDB both accept, so both sides of a
comparison start from the same rows.  ``{epoch}`` is the only part that is
spelled differently.  All views keep every row of their table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog.registry import table
from skyloom.operators.flatten import FEEDS, DocSpec, evaluated_once
from skyloom.plans.facts import FACTS

RUN_STAMP = "20240131_060000"
CHUNK = 64

_DAY = "cast(cast(ts as date) as string)"
_HOUR = f"{_DAY} || 'T' || substr(cast(ts as string), 12, 2) || ':00'"
_CITY = "'NATION_' || cast(user_id % 27 as string)"


def _metric(i: int, rule: str) -> str:
    value = f"value + {i}"
    if rule == "int":
        value = "(cast(floor(value) as int) % 101) + 0.5e0"
    elif rule == "truncated int":
        value = "(value % 359e0) + 0.9e0"
    elif rule == "decimal(4,2)":
        value = "value % 16e0"
    elif rule == "decimal(6,4)":
        value = "value % 6e0"
    elif rule == "time":
        value = f"{_DAY} || 'T07:' || lpad(cast((event_id + {i}) % 60 as string), 2, '0')"
    return f"CASE WHEN (event_id + {i}) % 13 = 0 THEN NULL ELSE {value} END"


def _feed_view(feed: str) -> str:
    columns = ",\n  ".join(
        f"{_metric(i, rule)} AS {source}" for i, (source, _, rule) in enumerate(FACTS[feed].columns)
    )
    if feed == "marine":
        columns = columns.replace("CASE WHEN", "CASE WHEN event_type = 'error' THEN NULL WHEN")
    time = _DAY if FEEDS[feed].section == "daily" else _HOUR
    return f"""SELECT event_id, {time} AS time,
  {columns},
  lpad(cast(user_id % 27 as string), 5, '0') AS city_code, {_CITY} AS city_name,
  {_DAY} AS extraction_date, '{RUN_STAMP}' AS extraction_timestamp, event_type
FROM events"""


_CLIMATE = [line.split() for line in fixed.CLIMATOLOGY_NUMBERS.strip().splitlines()]
_SMALL = {"sunshine_hours": 24}


def _raw_number(i: int, name: str) -> str:
    top = _SMALL.get(name, 900)
    return f"""CASE WHEN (o_orderkey + {i}) % 23 = 0 THEN 'Ip' WHEN (o_orderkey + {i}) % 29 = 0 THEN 'Acum'
    WHEN (o_orderkey + {i}) % 31 = 0 THEN ''
    ELSE cast((o_orderkey + {i}) % {top} as string) || ',' || cast((o_custkey + {i}) % 10 as string) END"""


def _number(i: int, name: str) -> str:
    top = _SMALL.get(name, 900)
    return f"""CASE WHEN (o_orderkey + {i}) % 23 = 0 OR (o_orderkey + {i}) % 29 = 0 OR (o_orderkey + {i}) % 31 = 0
    THEN NULL ELSE cast(cast((o_orderkey + {i}) % {top} as string) || '.'
    || cast((o_custkey + {i}) % 10 as string) as double) END"""


_STATION_OF_ORDER = "'S' || lpad(cast(o_custkey % 103 as string), 5, '0')"
_ORDER_DAY = "cast(cast(o_orderdate as date) as string)"
_TASK = (
    "CASE o_custkey % 8 "
    + " ".join(f"WHEN {i} THEN '{task}'" for i, task in enumerate(fixed.EXPECTED_TASKS))
    + " END"
)

VIEWS = {
    "v_city": """SELECT n_nationkey + 1 AS city_id, lpad(cast(n_nationkey as string), 5, '0') AS city_code,
  n_name AS city_name, n_nationkey * 1.5e0 - 10 AS latitude, n_nationkey * 2.25e0 AS longitude,
  'ES' AS country_code, n_nationkey % 2 AS is_coastal
FROM nation""",
    # customers as a cities file: the row count grows with the data
    "v_city_file": """SELECT lpad(cast(c_custkey as string), 8, '0') AS city_code, c_name AS city_name,
  c_acctbal AS latitud, c_nationkey * 1.5e0 AS longitud, 'ES' AS country_code,
  cast(c_custkey % 2 as int) AS is_coastal
FROM customer""",
    "v_obs": f"""SELECT event_id, {_CITY} AS city,
  CASE WHEN event_id % 5 = 0 THEN 'ES' ELSE 'C' || cast(user_id % 3 as string) END AS country,
  (user_id % 27) * 1.5e0 - 10 AS latitude, (user_id % 27) * 2.25e0 AS longitude,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE cast({{epoch}} as double) END AS dt,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value - 40 END AS temperature,
  value - 42 AS feels_like, value - 45 AS temp_min, value - 35 AS temp_max,
  870 + floor(value) + 0.5e0 AS pressure,
  cast(cast(floor(value) as int) % 110 as double) AS humidity,
  cast(200 + event_id % 5 as double) AS weather_id,
  CASE WHEN event_id % 7 = 0 THEN 'Unknown' ELSE event_type END AS weather_main,
  CASE WHEN event_id % 7 = 0 THEN 'No description' ELSE 'about ' || event_type END AS weather_description,
  value % 40e0 AS wind_speed, cast(event_id % 360 as double) AS wind_deg,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value % 60e0 END AS wind_gust,
  cast(event_id % 101 as double) AS clouds, cast(event_id % 10001 as double) AS visibility,
  CASE WHEN event_id % 4 = 0 THEN value % 9e0 ELSE NULL END AS rain_1h,
  CASE WHEN event_id % 8 = 0 THEN value % 9e0 ELSE NULL END AS rain_3h,
  CASE WHEN event_id % 9 = 0 THEN value % 3e0 ELSE NULL END AS snow_1h,
  CASE WHEN event_id % 18 = 0 THEN value % 3e0 ELSE NULL END AS snow_3h,
  {_DAY} AS date
FROM events""",
    **{f"v_{feed}": _feed_view(feed) for feed in FEEDS},
    "v_station_raw": """SELECT s_suppkey, 'S' || lpad(cast(s_suppkey as string), 5, '0') AS indicativo,
  s_name AS nombre, 'P' || cast(s_nationkey as string) AS provincia,
  CASE WHEN s_suppkey % 19 = 0 THEN 'Ip' ELSE cast(s_suppkey % 3000 as string) || ',5' END AS altitud,
  CASE WHEN s_suppkey % 17 = 0 THEN 'abc' ELSE lpad(cast(s_suppkey % 90 as string), 2, '0')
    || lpad(cast(s_suppkey % 60 as string), 2, '0') || lpad(cast(s_suppkey * 7 % 60 as string), 2, '0')
    || CASE WHEN s_suppkey % 2 = 0 THEN 'N' ELSE 's' END END AS latitud,
  cast(s_suppkey % 10 as string) || lpad(cast(s_suppkey * 3 % 60 as string), 2, '0')
    || lpad(cast(s_suppkey * 11 % 60 as string), 2, '0')
    || CASE WHEN s_suppkey % 3 = 0 THEN 'W' ELSE 'E' END AS longitud,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE lpad(cast(s_suppkey as string), 6, '0') END AS indsinop
FROM supplier""",
    "v_station": """SELECT s_suppkey, s_suppkey + 1 AS id,
  'S' || lpad(cast(s_suppkey as string), 5, '0') AS station_id
FROM supplier""",
    "v_clim_raw": f"""SELECT o_orderkey, {_STATION_OF_ORDER} AS station_id, {_ORDER_DAY} AS fecha,
  'Station ' || cast(o_custkey % 103 as string) AS nombre, 'P' || cast(o_custkey % 7 as string) AS provincia,
  {", ".join(f"{_raw_number(i, name)} AS {raw}" for i, (raw, name) in enumerate(_CLIMATE))}
FROM orders""",
    "v_clim": f"""SELECT o_orderkey, {_STATION_OF_ORDER} AS station_id,
  'Station ' || cast(o_custkey % 103 as string) AS station_name,
  'P' || cast(o_custkey % 7 as string) AS province, {_ORDER_DAY} AS date,
  cast(year(o_orderdate) as int) AS year,
  {", ".join(f"{_number(i, name)} AS {name}" for i, (_, name) in enumerate(_CLIMATE))},
  cast(year(o_orderdate) as string) || '-12-31' AS extraction_date
FROM orders""",
    # every order as one logged attempt of a task on its day
    "v_attempt": f"""SELECT o_orderkey, o_orderkey + 1 AS id, '{fixed.EXTRACTION_DAG}' AS dag_id,
  {_TASK} AS task_id, cast(o_orderdate as date) AS execution_date,
  CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'running' END AS status,
  cast(floor(o_totalprice) as bigint) AS records_processed
FROM orders""",
    "v_metric": """SELECT event_type AS target_table, 'mean_value' AS metric_name,
  cast(cast(ts as date) as string) AS measured_on,
  cast(sum(cast(round(value * 100) as bigint)) as double) / count(*) AS value, 'validity' AS dimension
FROM events GROUP BY event_type, cast(cast(ts as date) as string)""",
}

_SPARK = {"epoch": "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"}
_DUCK = {"epoch": "floor(epoch(ts))"}
_SOURCE = {"nation", "customer", "events", "supplier", "orders"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    text = VIEWS[name]
    source = next(s for s in _SOURCE if f"FROM {s}" in text)
    text = text.replace("{epoch}", _SPARK["epoch"]).replace(f"FROM {source}", "FROM {source}")
    return spark.sql(text, source=table(spark, sf_dir, source))


def duck(name: str) -> str:
    """The same view as a named subquery for DuckDB."""
    return f"{name} AS ({VIEWS[name].replace('{epoch}', _DUCK['epoch'])})"


def with_views(names: str, body: str) -> str:
    """``body`` with the named views in front of it."""
    return "WITH " + ",\n".join(duck(name) for name in names.split()) + "\n" + body.strip()


# -- documents --------------------------------------------------------------


def _arrays(spec: DocSpec, items: Column) -> list[Column]:
    return [items.getField(n).alias(n) for n in spec.fields]


def packed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed view as ``city_name, extraction_date, chunk, items``.

    A chunk covers 64 consecutive event ids, so no list is longer than that,
    however many events one city has.
    """
    spec = FEEDS[feed]
    rows = view(spark, sf_dir, f"v_{feed}").withColumn(
        "chunk", F.floor(F.col("event_id") / CHUNK).cast("long")
    )
    keys = ["city_name", "city_code", "extraction_date", "chunk"]
    items = F.sort_array(F.collect_list(F.struct("event_id", *spec.fields)))
    return rows.groupBy(*keys).agg(items.alias("items"))


def feed_documents(
    spark: SparkSession, sf_dir: str, feed: str, section: str | None = None
) -> DataFrame:
    """Columnar JSON documents of a feed; every seventeenth chunk names no city."""
    spec = FEEDS[feed]
    rows = packed(spark, sf_dir, feed)
    body = F.struct(
        F.col("city_code"),
        F.when(F.col("chunk") % 17 != 0, F.col("city_name")).alias("municipio_nombre"),
        F.struct(*_arrays(spec, F.col("items"))).alias(section or spec.section),
        F.struct(
            F.lit(RUN_STAMP).alias("extraction_timestamp"),
            F.col("extraction_date").alias("execution_date"),
        ).alias("_metadata"),
    )
    return documents(rows, document_path(feed), F.to_json(body))


def documents(rows: DataFrame, path: Column, text: Column) -> DataFrame:
    """``path, text`` as a scan of document files would give them."""
    return evaluated_once(rows.select(path.alias("path"), text.alias("_text")), text=F.col("_text")).drop("_text")


def document_path(feed: str) -> Column:
    return F.concat_ws(
        "/", F.lit(feed), "extraction_date",
        F.concat(F.lower("city_name"), F.lit("_"), F.lpad(F.col("chunk").cast("string"), 12, "0"),
                 F.lit(".json")),
    )


def feed_rows_sql(feed: str) -> str:
    """The rows those documents unpack to, in DuckDB."""
    spec = FEEDS[feed]
    return with_views(
        f"v_{feed}",
        f"""SELECT {", ".join(spec.fields)}, city_code,
  CASE WHEN floor(event_id / {CHUNK}) % 17 = 0 THEN 'Unknown' ELSE city_name END AS city_name,
  extraction_date, extraction_timestamp
FROM v_{feed}""",
    )


def observation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON document per event; defaults are left out of the text."""
    rows = view(spark, sf_dir, "v_obs")
    known = F.col("event_id") % 7 != 0
    body = F.struct(
        F.struct(F.col("city").alias("city_name"), F.col("date").alias("execution_date")).alias("_metadata"),
        F.struct(F.when(F.col("event_id") % 5 != 0, F.col("country")).alias("country")).alias("sys"),
        F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("coord"),
        F.col("dt"),
        F.struct(F.col("temperature").alias("temp"), "feels_like", "temp_min", "temp_max",
                 "pressure", "humidity").alias("main"),
        F.array(F.struct(
            F.col("weather_id").alias("id"),
            F.when(known, F.col("weather_main")).alias("main"),
            F.when(known, F.col("weather_description")).alias("description"),
        )).alias("weather"),
        F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg"),
                 F.col("wind_gust").alias("gust")).alias("wind"),
        F.struct(F.col("clouds").alias("all")).alias("clouds"),
        F.col("visibility"),
        F.struct(F.col("rain_1h").alias("1h"), F.col("rain_3h").alias("3h")).alias("rain"),
        F.struct(F.col("snow_1h").alias("1h"), F.col("snow_3h").alias("3h")).alias("snow"),
    )
    path = F.concat(F.lit("current/"), F.col("date"), F.lit("/weather_"), F.col("event_id"), F.lit(".json"))
    return documents(rows, path, F.to_json(body))


def station_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory as documents of 64 consecutive suppliers."""
    rows = view(spark, sf_dir, "v_station_raw")
    names = [c for c in rows.columns if c != "s_suppkey"]
    packed_rows = rows.groupBy(F.floor(F.col("s_suppkey") / CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("s_suppkey", *names))).alias("items")
    )
    body = F.struct(
        F.transform("items", lambda r: F.struct(*[r[n].alias(n) for n in names])).alias("stations"),
        F.struct(F.lit("2024-01-31").alias("execution_date"),
                 F.size("items").alias("station_count")).alias("_metadata"),
    )
    path = F.concat(F.lit("stations/"), F.lpad(F.col("chunk").cast("string"), 12, "0"), F.lit(".json"))
    return documents(packed_rows, path, F.to_json(body))


def climatology_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-day records as documents per station, year and 4,096 consecutive orders."""
    rows = view(spark, sf_dir, "v_clim_raw")
    names = [c for c in rows.columns if c not in ("o_orderkey", "station_id")]
    keys = ["station_id", F.left("fecha", F.lit(4)).cast("int").alias("year"),
            F.floor(F.col("o_orderkey") / 4096).alias("chunk")]
    packed_rows = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", *names))).alias("items")
    )
    body = F.struct(
        "station_id",
        "year",
        F.transform("items", lambda r: F.struct(*[r[n].alias(n) for n in names])).alias("records"),
        F.struct(F.concat(F.col("year").cast("string"), F.lit("-12-31")).alias("execution_date")).alias("_metadata"),
    )
    path = F.concat_ws("/", F.lit("historical"), F.col("year").cast("string"), "station_id",
                       F.lpad(F.col("chunk").cast("string"), 12, "0"))
    return documents(packed_rows, path, F.to_json(body))
