"""Row filters and constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog.registry import query, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import flatten, rules
from skyloom.operators.flatten import FEEDS
from skyloom.plans import facts

_MARINE = list(FEEDS["marine"].numbers)


@query(
    "drop_all_null",
    with_views(
        "v_marine",
        f"SELECT event_id, {', '.join(_MARINE)} FROM v_marine WHERE coalesce({', '.join(_MARINE)}) IS NOT NULL",
    ),
)
def drop_all_null(spark, sf_dir):
    return rules.drop_all_null(view(spark, sf_dir, "v_marine").select("event_id", *_MARINE), _MARINE)


@query(
    "require_timestamp",
    with_views(
        "v_obs v_city",
        """SELECT event_id, CASE WHEN c.city_id IS NULL THEN 'unknown_city' ELSE 'missing_timestamp' END AS reject_reason
FROM v_obs LEFT JOIN v_city c ON c.city_name = v_obs.city
WHERE c.city_id IS NULL OR dt IS NULL""",
    ),
)
def require_timestamp(spark, sf_dir):
    obs = view(spark, sf_dir, "v_obs").withColumn("bronze_source", F.lit("obs"))
    keyed = facts.key_rows(obs, facts.FACTS["observation"], view(spark, sf_dir, "v_city"))
    return keyed.filter(F.col("reject_reason").isNotNull()).select("event_id", "reject_reason")


@query(
    "coastal_cities",
    with_views(
        "v_city_file",
        """SELECT city_name AS name, latitud AS lat, longitud AS lon, city_code AS code
FROM v_city_file WHERE is_coastal = 1""",
    ),
)
def coastal_cities(spark, sf_dir):
    return flatten.coastal_cities(view(spark, sf_dir, "v_city_file"))


@query(
    "check_constraints",
    """SELECT 'status_known' AS rule, count(*) FILTER (WHERE o_orderstatus = 'P') AS violations FROM orders
UNION ALL SELECT 'start_month_valid', count(*) FILTER (WHERE o_orderkey % 14 NOT BETWEEN 1 AND 12) FROM orders
UNION ALL SELECT 'end_month_valid', count(*) FILTER (WHERE month(o_orderdate) NOT BETWEEN 1 AND 12) FROM orders
UNION ALL SELECT 'hemisphere_known', count(*) FILTER (WHERE o_custkey % 3 = 2) FROM orders
UNION ALL SELECT 'medium_known', count(*) FILTER (WHERE o_custkey % 4 = 3) FROM orders""",
)
def check_constraints(spark, sf_dir):
    """Orders as rows to check; a null hemisphere breaks no rule."""
    orders = table(spark, sf_dir, "orders")
    pick = F.col("o_custkey")
    rows = orders.select(
        F.expr("CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'lost' END").alias("status"),
        (F.col("o_orderkey") % 14).alias("start_month"),
        F.month("o_orderdate").alias("end_month"),
        F.when(pick % 3 == 0, "North").when(pick % 3 == 2, "West").alias("hemisphere"),
        F.when(pick % 4 == 0, "Air").when(pick % 4 == 1, "Soil").when(pick % 4 == 2, "Surface")
        .otherwise("Fire").alias("medium"),
    )
    known = {**rules.run_log_rules(), **rules.season_rules(), **rules.layer_rules()}
    return rules.check_constraints(rows, known)


@query(
    "null_key_rejects",
    with_views(
        "v_hourly v_city",
        """SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'null_key:forecast_datetime'
  ELSE 'null_key:extraction_date_id' END AS reject_reason
FROM v_hourly JOIN v_city USING (city_name) WHERE event_id % 10 = 3 OR event_id % 25 = 4""",
    ),
)
def null_key_rejects(spark, sf_dir):
    hourly = view(spark, sf_dir, "v_hourly").withColumns(
        {
            "time": F.when(F.col("event_id") % 10 != 3, F.col("time")).otherwise("soon"),
            "extraction_date": F.when(F.col("event_id") % 25 != 4, F.col("extraction_date")),
        }
    )
    keyed = facts.key_rows(hourly, facts.FACTS["hourly"], view(spark, sf_dir, "v_city"))
    bad = keyed.filter(F.col("reject_reason").startswith("null_key"))
    return bad.select("event_id", "reject_reason")


