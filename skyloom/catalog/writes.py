"""Merges and partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog.registry import as_of, plain, query, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import merge, partitions

_KEY = ["city_name", "time", "extraction_date"]


@query(
    "insert_if_absent",
    with_views(
        "v_hourly",
        """, t AS (SELECT DISTINCT 'NATION_' || (user_id % 27) AS city_name, strftime(ts, '%Y-%m-%dT%H:00') AS time,
  cast(cast(ts as date) as varchar) AS extraction_date FROM events WHERE event_type IN ('click', 'view'))
SELECT city_name, time, extraction_date, event_id, temperature_2m FROM v_hourly h
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.city_name = h.city_name AND t.time = h.time
  AND t.extraction_date = h.extraction_date)
QUALIFY row_number() OVER (PARTITION BY city_name, time, extraction_date ORDER BY event_id) = 1""",
    ),
)
def insert_if_absent(spark, sf_dir):
    """What came with two kinds of events is in the table already."""
    rows = view(spark, sf_dir, "v_hourly")
    target = rows.filter(F.col("event_type").isin("click", "view")).select(*_KEY).distinct()
    batch = rows.select(*_KEY, "event_id", "temperature_2m")
    return merge.insert_if_absent(batch, target, _KEY, ["event_id"])


@query(
    "upsert_dim",
    """WITH s AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS code,
    o_orderpriority AS name FROM orders
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY o_orderkey DESC) = 1),
m AS (SELECT max(c_custkey) + 1 AS top FROM customer)
SELECT c_custkey + 1 AS id, c_custkey AS code, coalesce(s.name, c_mktsegment) AS name,
  CASE WHEN s.code IS NULL THEN '2024-01-01 00:00:00' ELSE '2024-01-31 06:00:00' END AS updated_at,
  '2024-01-01 00:00:00' AS created_at
FROM customer LEFT JOIN s ON s.code = c_custkey
UNION ALL
SELECT top + row_number() OVER (ORDER BY code), code, name, '2024-01-31 06:00:00', '2024-01-31 06:00:00'
FROM s, m WHERE code NOT IN (SELECT c_custkey FROM customer)""",
)
def upsert_dim(spark, sf_dir):
    old = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    target = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("id"), F.col("c_custkey").alias("code"),
        F.col("c_mktsegment").alias("name"), old.alias("updated_at"), old.alias("created_at"),
    )
    moved = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey") + 10000000)
    source = table(spark, sf_dir, "orders").select(
        F.coalesce(moved, F.col("o_custkey")).alias("code"), F.col("o_orderpriority").alias("name"), "o_orderkey"
    )
    merged = merge.upsert(
        target, source, ["code"], ["name"], on_update={"updated_at": as_of()},
        on_insert={"updated_at": as_of(), "created_at": as_of()}, ident="id", order=["o_orderkey"],
    )
    return plain(merged)


# order dates, 28 years later: 2023 to 2029, so both sides of the declared months
_SHIFTED = "(cast(year(o_orderdate) as int) + 28) * 10000 + cast(month(o_orderdate) as int) * 100 + cast(day(o_orderdate) as int)"
_MONTH = """CASE WHEN date_id BETWEEN 20240101 AND 20271231
  THEN cast(cast(floor(date_id / 100) as int) as varchar) ELSE 'default' END"""


def _dated(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SHIFTED).alias("date_id"))


@query(
    "month_partition",
    f"""WITH d AS (SELECT o_orderkey, {_SHIFTED} AS date_id FROM orders)
SELECT o_orderkey, date_id, {_MONTH} AS p_month FROM d""",
)
def month_partition(spark, sf_dir):
    rows = _dated(spark, sf_dir)
    return rows.withColumn("p_month", partitions.month_partition(F.col("date_id")))


@query(
    "repartition_default",
    f"""WITH d AS (SELECT {_SHIFTED} AS date_id FROM orders),
p AS (SELECT {_MONTH} AS before, CASE WHEN floor(date_id / 100) IN (202801, 202802, 202312)
  THEN cast(cast(floor(date_id / 100) as int) as varchar) ELSE {_MONTH} END AS after FROM d)
SELECT before, after, count(*) AS n_rows FROM p GROUP BY before, after""",
)
def repartition_default(spark, sf_dir):
    rows = _dated(spark, sf_dir)
    added = [202801, 202802, 202312]
    return (
        rows.select(
            partitions.month_partition(F.col("date_id")).alias("before"),
            partitions.month_partition(F.col("date_id"), added).alias("after"),
        )
        .groupBy("before", "after")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
