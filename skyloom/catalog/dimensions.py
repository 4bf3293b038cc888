"""Calendar, reference, city and station dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog import shapes
from skyloom.catalog.registry import as_of, plain, query, table
from skyloom.catalog.scalars import dms_sql
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import flatten
from skyloom.plans import dims

_OLD = "2024-01-01 00:00:00"


def _bounds(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def _day_sql(rule: str) -> str:
    iso = rule == "iso"
    week_year = "isoyear(d)" if iso else "year(d)"
    half = "CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END"
    semester = f"year(d) * 10 + {half}" if iso else half
    text = "strftime(d, '%A, %d %B %Y')" if iso else "cast(d as varchar)"
    return f"""b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
days AS (SELECT cast(s as date) AS d FROM b, unnest(generate_series(lo, hi, interval 1 day)) u(s)),
dim_date AS (SELECT cast(strftime(d, '%Y%m%d') as int) AS id_calendar_day, d AS dt_date, cast(year(d) as int) AS id_year,
  cast(year(d) * 100 + month(d) as int) AS id_calendar_month, cast(month(d) as int) AS id_month,
  cast({week_year} * 100 + week(d) as int) AS id_calendar_week, cast(week(d) as int) AS id_week,
  cast(isodow(d) as int) AS id_weekday, cast(quarter(d) as int) AS id_quarter,
  cast(year(d) * 10 + quarter(d) as int) AS id_calendar_quarter, cast({semester} as int) AS id_calendar_semester,
  dayname(d) AS nm_day, {text} AS ds_calendar_day FROM days)"""


def _register_date(rule):
    @query(
        f"dim_date_{rule}",
        f"""WITH {_day_sql(rule)}
SELECT dim_date.* REPLACE (cast(dt_date as varchar) AS dt_date), coalesce(n, 0) AS n_orders
FROM dim_date LEFT JOIN (SELECT cast(o_orderdate as date) AS day, count(*) AS n FROM orders GROUP BY 1) ON day = dt_date""",
    )
    def run(spark, sf_dir):
        dates = dims.dim_date(_bounds(spark, sf_dir), rule)
        orders = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("dt_date"))
        counts = orders.agg(F.count(F.lit(1)).alias("n_orders"))
        return plain(dates.join(counts, "dt_date", "left").fillna(0, ["n_orders"]))


def _register_week(rule):
    iso = rule == "iso"
    year = "cast(floor(id_calendar_week / 100) as int)" if iso else "id_year"
    label = "'W' || lpad(cast(id_week as varchar), 2, '0') || '{0}' || y".format(" " if iso else "-")
    monday, sunday = ("date_trunc('week', first)", "cast(date_trunc('week', first) as date) + 6") if iso else ("first", "last")
    span = (
        "strftime(cast(mo as date), '%d/%m') || ' - ' || strftime(cast(su as date), '%d/%m')" if iso
        else "cast(mo as varchar) || ' / ' || cast(su as varchar)"
    )
    keys = "id_calendar_week, id_week" if iso else "id_calendar_week, id_year, id_week"

    @query(
        f"dim_week_{rule}",
        f"""WITH {_day_sql(rule)},
w AS (SELECT {keys}, {year} AS y, min(dt_date) AS first, max(dt_date) AS last FROM dim_date GROUP BY {keys}),
x AS (SELECT *, cast({monday} as date) AS mo, cast(({sunday}) as date) AS su FROM w)
SELECT id_calendar_week, y AS id_year, id_week, {label} AS ds_calendar_week, {span} AS ds_week_from_to,
  cast(mo as varchar) AS dt_monday_of_week, cast(su as varchar) AS dt_sunday_of_week FROM x""",
    )
    def run(spark, sf_dir):
        return plain(dims.dim_week(dims.dim_date(_bounds(spark, sf_dir), rule), rule))


def _register_month(rule):
    iso = rule == "iso"
    name = "strftime(first, '%B')" if iso else "rpad(strftime(first, '%B'), 9, ' ')"
    first = "date_trunc('month', min(dt_date))" if iso else "min(dt_date)"
    keys = "id_calendar_month, id_month, id_year, id_quarter, id_calendar_quarter, id_calendar_semester"

    @query(
        f"dim_month_{rule}",
        f"""WITH {_day_sql(rule)},
m AS (SELECT {keys}, cast({first} as date) AS first FROM dim_date GROUP BY {keys})
SELECT {keys}, {name} || ' ' || strftime(first, '%Y') AS ds_calendar_month, cast(first as varchar) AS dt_month_first_day FROM m""",
    )
    def run(spark, sf_dir):
        return plain(dims.dim_month(dims.dim_date(_bounds(spark, sf_dir), rule), rule))


for _rule in ("iso", "calendar"):
    _register_date(_rule)
    _register_week(_rule)
    _register_month(_rule)


# -- reference rows, with how often the data uses each -----------------------


def _values(base, local) -> str:
    """The rows left after the second list is laid over the first, as SQL."""
    merged = {row[0]: row for row in base}
    merged.update({row[0]: row for row in local})

    def text(value):
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return f"{value}e0" if isinstance(value, float) else str(value)

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in merged.values())


@query(
    "dim_seasons",
    f"""WITH s(season_id, name, hemisphere, season_type, start_month, end_month, precipitation_type, is_growing_season,
  color_code, description) AS (VALUES {_values(fixed.SEASONS_BASE, fixed.SEASONS_LOCAL)})
SELECT s.*, count(l_orderkey) AS n_lines FROM s LEFT JOIN lineitem ON CASE WHEN start_month <= end_month
  THEN month(l_shipdate) BETWEEN start_month AND end_month
  ELSE month(l_shipdate) >= start_month OR month(l_shipdate) <= end_month END GROUP BY ALL""",
)
def dim_seasons(spark, sf_dir):
    seasons = dims.dim_seasons(spark)
    by_month = table(spark, sf_dir, "lineitem").groupBy(F.month("l_shipdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    used = dims.season_months(seasons).join(by_month, "month").groupBy("season_id").agg(F.sum("n").alias("n_lines"))
    return seasons.join(used, "season_id", "left").fillna(0, ["n_lines"])


@query(
    "dim_layers",
    f"""WITH l(layer_id, name, medium, vertical_level_m, pressure_hpa, is_standard_wmo, layer_category, description)
  AS (VALUES {_values(fixed.LAYERS_BASE, fixed.LAYERS_LOCAL)})
SELECT l.*, count(event_id) AS n_readings FROM l LEFT JOIN events ON event_id % 25 = layer_id GROUP BY ALL""",
)
def dim_layers(spark, sf_dir):
    used = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 25).cast("int").alias("layer_id")).agg(
        F.count(F.lit(1)).alias("n_readings")
    )
    return dims.dim_layers(spark).join(used, "layer_id", "left").fillna(0, ["n_readings"])


@query(
    "dim_severity",
    f"""WITH s(severity_id, severity_level, color_code, description)
  AS (VALUES {_values(fixed.SEVERITY_BASE, fixed.SEVERITY_LOCAL)})
SELECT s.*, count(event_id) AS n_warnings FROM s LEFT JOIN events
  ON least(cast(floor(value / 50) as int) + 1, 5) = severity_id GROUP BY ALL""",
)
def dim_severity(spark, sf_dir):
    level = F.least(F.floor(F.col("value") / 50).cast("int") + 1, F.lit(5))
    used = table(spark, sf_dir, "events").groupBy(level.alias("severity_id")).agg(
        F.count(F.lit(1)).alias("n_warnings")
    )
    return dims.dim_severity(spark).join(used, "severity_id", "left").fillna(0, ["n_warnings"])


# -- cities and stations ----------------------------------------------------

_CITY_SOURCE = """SELECT lpad(cast(c_custkey % 40 as varchar), 5, '0') AS city_code, c_name AS city_name,
  round(c_acctbal / 1000, 6) AS latitude, c_nationkey * 1.5e0 AS longitude, 'PT' AS country_code,
  cast(c_custkey % 2 as int) AS is_coastal FROM customer
  QUALIFY row_number() OVER (PARTITION BY city_code ORDER BY c_custkey DESC) = 1"""


@query(
    "dim_city_upsert",
    with_views(
        "v_city",
        f""", s AS ({_CITY_SOURCE})
SELECT v.city_id, v.city_code, coalesce(s.city_name, v.city_name) AS city_name,
  CASE WHEN s.city_code IS NULL THEN v.latitude ELSE s.latitude END AS latitude,
  CASE WHEN s.city_code IS NULL THEN v.longitude ELSE s.longitude END AS longitude,
  coalesce(s.country_code, v.country_code) AS country_code, coalesce(s.is_coastal, v.is_coastal) AS is_coastal,
  '{_OLD}' AS created_at
FROM v_city v LEFT JOIN s USING (city_code)
UNION ALL
SELECT cast((SELECT max(city_id) FROM v_city) + row_number() OVER (ORDER BY city_code) as int), city_code, city_name,
  latitude, longitude, country_code, is_coastal, '2024-01-31 06:00:00'
FROM s WHERE city_code NOT IN (SELECT city_code FROM v_city)""",
    ),
)
def dim_city_upsert(spark, sf_dir):
    dim = view(spark, sf_dir, "v_city").withColumns(
        {"latitude": F.col("latitude").cast("decimal(9,6)"), "longitude": F.col("longitude").cast("decimal(9,6)"),
         "created_at": F.lit(_OLD).cast("timestamp_ntz")}
    )
    code = F.lpad((F.col("c_custkey") % 40).cast("string"), 5, "0")
    source = table(spark, sf_dir, "customer").select(
        code.alias("city_code"), F.col("c_name").alias("city_name"), (F.col("c_acctbal") / 1000).alias("latitude"),
        (F.col("c_nationkey") * 1.5).alias("longitude"), F.lit("PT").alias("country_code"),
        (F.col("c_custkey") % 2).cast("int").alias("is_coastal"), "c_custkey",
    )
    return plain(dims.upsert_cities(dim, source, as_of(), order=["c_custkey"]))


@query(
    "dim_stations_upsert",
    with_views(
        "v_station_raw v_station",
        f""", f AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'X' || substr(indicativo, 2) ELSE indicativo END AS station_id,
  nombre AS station_name, provincia AS province,
  CASE WHEN altitud = 'Ip' THEN NULL ELSE cast(replace(altitud, ',', '.') as double) END AS altitude,
  {dms_sql('latitud')} AS latitude, {dms_sql('longitud')} AS longitude, indsinop AS synop_code FROM v_station_raw)
SELECT s.id, s.station_id, coalesce(f.station_name, 'old') AS station_name, f.province,
  CASE WHEN f.station_id IS NULL THEN 1.0e0 ELSE f.altitude END AS altitude, f.latitude, f.longitude, f.synop_code,
  '{_OLD}' AS created_at, CASE WHEN f.station_id IS NULL THEN '{_OLD}' ELSE '2024-01-31 06:00:00' END AS updated_at
FROM v_station s LEFT JOIN f USING (station_id)
UNION ALL
SELECT (SELECT max(id) FROM v_station) + row_number() OVER (ORDER BY station_id), station_id, station_name,
  province, altitude, latitude, longitude, synop_code, '2024-01-31 06:00:00', '2024-01-31 06:00:00'
FROM f WHERE station_id LIKE 'X%'""",
    ),
)
def dim_stations_upsert(spark, sf_dir):
    old = F.lit(_OLD).cast("timestamp_ntz")
    coordinate = F.lit(None).cast("decimal(9,6)")
    text = F.lit(None).cast("string")
    dim = view(spark, sf_dir, "v_station").select(
        "id", "station_id", F.lit("old").alias("station_name"), text.alias("province"),
        F.lit(1).cast("decimal(7,2)").alias("altitude"), coordinate.alias("latitude"), coordinate.alias("longitude"),
        text.alias("synop_code"), old.alias("created_at"), old.alias("updated_at"),
    )
    feed = flatten.flatten_stations(shapes.station_documents(spark, sf_dir))
    third = F.substring("station_id", 2, 99).cast("long") % 3 == 0
    feed = feed.withColumn(
        "station_id",
        F.when(third, F.concat(F.lit("X"), F.substring("station_id", 2, 99))).otherwise(F.col("station_id")),
    )
    return plain(dims.upsert_stations(dim, feed, as_of()))


@query(
    "stations_bootstrap",
    f"""WITH s(station_id, station_name, province, altitude, latitude, longitude)
  AS (VALUES {_values(fixed.DEFAULT_STATIONS, [])}),
d AS (SELECT row_number() OVER (ORDER BY station_id) AS id, * FROM s)
SELECT cast(id as int) AS id, station_id, station_name, altitude, latitude, longitude, count(o_orderkey) AS n_days
FROM d LEFT JOIN orders ON o_custkey % 15 + 1 = id GROUP BY ALL""",
)
def stations_bootstrap(spark, sf_dir):
    """No inventory has come in yet: the default stations take the orders."""
    stations = dims.ensure_stations(dims.empty_table(spark, dims.STATION_COLUMNS), as_of())
    days = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 15 + 1).cast("int").alias("id")).agg(
        F.count(F.lit(1)).alias("n_days")
    )
    kept = stations.select("id", "station_id", "station_name", "altitude", "latitude", "longitude")
    return plain(kept.join(days, "id", "left").fillna(0, ["n_days"]))


@query(
    "surrogate_keys",
    """WITH k AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS code FROM lineitem),
n AS (SELECT code FROM k WHERE code NOT IN (SELECT o_orderkey FROM orders))
SELECT code, (SELECT max(o_orderkey) + 1 FROM orders) + row_number() OVER (ORDER BY code) AS id FROM n""",
)
def surrogate_keys(spark, sf_dir):
    dim = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("code"), (F.col("o_orderkey") + 1).alias("id")
    )
    names = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("code"))
    return dims.surrogate_keys(dim, names, "code", "id")


@query(
    "dims_all",
    f"""WITH {_day_sql('iso')}
SELECT 'dim_date' AS name, count(*) AS n_rows FROM dim_date
UNION ALL SELECT 'dim_week', count(DISTINCT id_calendar_week) FROM dim_date
UNION ALL SELECT 'dim_month', count(DISTINCT id_calendar_month) FROM dim_date
UNION ALL SELECT 'dim_city', count(*) FROM customer
UNION ALL SELECT * FROM (VALUES ('dim_seasons', 8), ('dim_layers', 15), ('dim_severity', 5), ('dim_aemet_stations', 15))""",
)
def dims_all(spark, sf_dir):
    cities = view(spark, sf_dir, "v_city_file").withColumnsRenamed({"latitud": "latitude", "longitud": "longitude"})
    built = dims.dims_all(spark, cities, "iso", as_of(), _bounds(spark, sf_dir))
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows")) for name, df in built.items()]
    return flatten.union_by_name(*counts)
