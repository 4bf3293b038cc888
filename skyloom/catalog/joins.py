"""Lookups against dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog.registry import query, rounded, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import lookup
from skyloom.plans import dims


@query(
    "city_lookup",
    with_views(
        "v_obs v_city",
        """SELECT event_id, city, c.city_id FROM v_obs JOIN v_city c ON c.city_name = v_obs.city""",
    ),
)
def city_lookup(spark, sf_dir):
    obs = view(spark, sf_dir, "v_obs").select("event_id", "city")
    return lookup.city_lookup(obs, view(spark, sf_dir, "v_city"), "city", how="inner")


@query(
    "city_lookup_fallback",
    with_views(
        "v_city",
        """, e AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 'NATION_' || (user_id % 27) END AS city_name,
  'NATION_' || (event_id % 26) AS city FROM events)
SELECT event_id, e.city_name, e.city, coalesce(a.city_id, b.city_id) AS city_id
FROM e LEFT JOIN v_city a ON a.city_name = e.city_name LEFT JOIN v_city b ON b.city_name = e.city""",
    ),
)
def city_lookup_fallback(spark, sf_dir):
    def city(number):
        return F.concat(F.lit("NATION_"), number.cast("string"))

    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 4 != 0, city(F.col("user_id") % 27)).alias("city_name"),
        city(F.col("event_id") % 26).alias("city"),
    )
    return lookup.city_lookup(events, view(spark, sf_dir, "v_city"), "city_name", fallback="city")


@query(
    "station_lookup",
    with_views(
        "v_clim v_station",
        """SELECT o_orderkey, station_id, s.id AS station_key FROM v_clim JOIN v_station s USING (station_id)""",
    ),
)
def station_lookup(spark, sf_dir):
    days = view(spark, sf_dir, "v_clim").select("o_orderkey", "station_id")
    return lookup.station_lookup(days, view(spark, sf_dir, "v_station"), how="inner")


@query(
    "unknown_stations",
    """SELECT 'S' || lpad(cast(l_partkey % 1003 as varchar), 5, '0') AS key, count(*) AS n_rows FROM lineitem
WHERE l_partkey % 1003 NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""",
)
def unknown_stations(spark, sf_dir):
    code = F.lpad((F.col("l_partkey") % 1003).cast("string"), 5, "0")
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), code).alias("station_id"))
    return lookup.unknown_keys(rows, view(spark, sf_dir, "v_station"), "station_id", "station_id")


@query(
    "fk_orphans",
    """SELECT 'part_id' AS fk_column, cast(l_partkey + 7 as varchar) AS fk_value, count(*) AS n_rows FROM lineitem
WHERE l_partkey + 7 NOT IN (SELECT p_partkey FROM part) GROUP BY l_partkey
UNION ALL
SELECT 'supplier_id', cast(l_suppkey * 2 as varchar), count(*) FROM lineitem
WHERE l_suppkey * 2 NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_suppkey""",
)
def fk_orphans(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 7).alias("part_id"), (F.col("l_suppkey") * 2).alias("supplier_id")
    )
    return lookup.fk_orphans(
        rows,
        {"part_id": (table(spark, sf_dir, "part"), "p_partkey"),
         "supplier_id": (table(spark, sf_dir, "supplier"), "s_suppkey")},
    )


@query(
    "season_lookup",
    """WITH s(season, hemisphere, first, last) AS (VALUES ('Invierno', 'North', 12, 2), ('Primavera', 'North', 3, 5),
  ('Verano', 'North', 6, 8), ('Otoño', 'North', 9, 11), ('Verano', 'South', 12, 2), ('Otoño', 'South', 3, 5),
  ('Invierno', 'South', 6, 8), ('Primavera', 'South', 9, 11)),
l AS (SELECT l_shipdate, l_quantity, CASE WHEN l_suppkey % 2 = 0 THEN 'North' ELSE 'South' END AS hemisphere FROM lineitem)
SELECT s.hemisphere, season, cast(month(l_shipdate) as int) AS month, count(*) AS n_rows,
  cast(sum(cast(l_quantity as bigint)) as bigint) AS quantity
FROM l JOIN s ON s.hemisphere = l.hemisphere AND CASE WHEN first <= last
  THEN month(l_shipdate) BETWEEN first AND last ELSE month(l_shipdate) >= first OR month(l_shipdate) <= last END
GROUP BY ALL""",
)
def season_lookup(spark, sf_dir):
    """Rows are reduced per hemisphere and month before they meet the seasons."""
    side = F.when(F.col("l_suppkey") % 2 == 0, "North").otherwise("South")
    rows = table(spark, sf_dir, "lineitem").groupBy(
        side.alias("hemisphere"), F.month("l_shipdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    seasons = dims.season_months(dims.dim_seasons(spark)).withColumnRenamed("name", "season")
    joined = rows.join(seasons, ["hemisphere", "month"])
    return joined.select("hemisphere", "season", "month", "n_rows", "quantity")


@query(
    "star_rollup",
    """SELECT n_name AS city_name, cast(year(o_orderdate) * 100 + month(o_orderdate) as int) AS id_calendar_month,
  count(*) AS n_rows, round(avg(l_quantity), 6) AS avg_quantity, max(l_extendedprice) AS max_price
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""",
)
def star_rollup(spark, sf_dir):
    """Fact by city and month.  The city of a line comes through two small
    dimensions, joined to each other first; its month through the orders."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city_name"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cities = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice")
    located = lookup.dim_join(lines, cities, "l_suppkey", "s_suppkey", {"city_name": "city_name"}, how="inner")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("id_calendar_month")
    )
    month = {"id_calendar_month": "id_calendar_month"}
    joined = lookup.dim_join(located, orders, "l_orderkey", "o_orderkey", month, how="inner")
    return rounded(
        joined.groupBy("city_name", "id_calendar_month").agg(
            F.count(F.lit(1)).alias("n_rows"), F.avg("l_quantity").alias("avg_quantity"),
            F.max("l_extendedprice").alias("max_price"),
        ),
        "avg_quantity",
    )
