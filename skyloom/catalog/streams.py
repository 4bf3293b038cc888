"""Streams over files that arrive in parts: windowed metrics, keyed deduplication, recovery of a load."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from skyloom.catalog import shapes
from skyloom.catalog.facts import load_sql
from skyloom.catalog.registry import as_of, plain, query, rounded, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import partitions
from skyloom.plans import facts
from skyloom.quality.checks import Suite
from skyloom.quality.metrics import metric_anomalies, read_history
from skyloom.session import scratch_path
from skyloom.sources import lake, sinks
from skyloom.streaming import incremental, windows

#: Files per delivery, and the weeks of a month.
FILES, WEEKS = 2, range(5)
_SUITE = Suite("events", required=("value", "user_id"), ranges={"value": (0.0, 400.0)}, critical=("user_id",), mostly=0.999)


def _delivered(rows, root, number, moment="ts"):
    """The rows of a week as a delivery of ``FILES`` files; weeks are written one after the other."""
    week = F.floor((F.dayofmonth(F.to_timestamp(moment)) - 1) / 7) == number % len(WEEKS)
    sinks.append_snapshot(rows.filter(week).repartition(FILES), root, f"delivery_{number:02d}")


def _columns(df):
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


_METRICS_SQL = """d AS (SELECT event_type AS target_table, cast(date_trunc('day', ts) as timestamp) + INTERVAL 1 DAY AS measured_at,
  count(*) AS n, count(user_id) AS n_user, count(value) AS n_value, count(*) FILTER (value < 0 OR value > 400) AS bad
  FROM events GROUP BY 1, 2),
m AS (
  SELECT target_table, measured_at, 'row_count' AS metric_name, cast(n as double) AS value, 'volume' AS dimension FROM d
  UNION ALL SELECT target_table, measured_at, 'completeness_user_id', n_user / n, 'completeness' FROM d
  UNION ALL SELECT target_table, measured_at, 'completeness_value', n_value / n, 'completeness' FROM d
  UNION ALL SELECT target_table, measured_at, 'validity_score',
    (1 + cast((CASE WHEN n_value > 0 THEN 1.0e0 - bad / n_value ELSE 1.0e0 END) >= 0.999e0 as int)
       + cast(1.0e0 - (n - n_user) / n >= 0.9e0 as int)) / 3.0e0, 'validity' FROM d)"""
_FINISHED = "measured_at <= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"


def _window_history(spark, sf_dir):
    """Weeks of events streamed into a metric history, with one week that comes again too late."""
    root = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").select("ts", "event_type", "user_id", "value")
    history, mark = f"{root}/history", f"{root}/mark"

    def run():
        rows = windows.table_stream(spark, f"{root}/in", _columns(events), FILES)
        metrics = windows.window_metrics(rows, _SUITE, "ts", "1 day", "7 days", F.col("event_type"), ["user_id", "value"])
        windows.store_stream(metrics, history, mark, "events").awaitTermination()

    for number in WEEKS:
        _delivered(events, f"{root}/in", number)
    run()
    _delivered(events, f"{root}/in", len(WEEKS))  # the first week again: older than the watermark
    run()
    return read_history(spark, history)


@query(
    "stream_window_metrics",
    f"""WITH {_METRICS_SQL}
SELECT target_table, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at, metric_name, round(value, 6) AS value, dimension
FROM m WHERE {_FINISHED}""",
)
def stream_window_metrics(spark, sf_dir):
    """Quality of every finished day, once, whatever comes late."""
    return rounded(plain(_window_history(spark, sf_dir)), "value")


@query(
    "stream_window_anomalies",
    f"""WITH {_METRICS_SQL}, f AS (SELECT * FROM m WHERE {_FINISHED}),
s AS (SELECT target_table, metric_name, avg(value) AS mean, stddev_pop(value) AS std FROM f GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT target_table, metric_name, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at, round(value, 6) AS value,
  round(abs(value - mean) / std, 6) AS z_score
FROM f JOIN s USING (target_table, metric_name) WHERE std > 0 AND abs(value - mean) / std > 1.5""",
)
def stream_window_anomalies(spark, sf_dir):
    """Anomalies of the streamed history."""
    found = metric_anomalies(_window_history(spark, sf_dir), threshold=1.5)
    return rounded(plain(found.select("target_table", "metric_name", "measured_at", "value", "z_score")), "value", "z_score")


@query(
    "stream_first_arrivals",
    with_views("v_pollen", "SELECT DISTINCT city_name, time, extraction_date FROM v_pollen"),
)
def stream_first_arrivals(spark, sf_dir):
    """Every week of a feed delivered twice, in batches of their own: one row per key."""
    root = scratch_path(spark, "arrivals")
    rows = view(spark, sf_dir, "v_pollen").select("city_name", "time", "extraction_date", "event_id", "birch_pollen")
    for number in WEEKS:
        for again in (0, 1):
            week = F.floor((F.dayofmonth(F.to_date("extraction_date")) - 1) / 7) == number
            sinks.append_snapshot(rows.filter(week).repartition(FILES), f"{root}/in", f"delivery_{number}_{again}")
    stream = windows.table_stream(spark, f"{root}/in", _columns(rows), FILES)
    fresh = windows.first_arrivals(stream, ["city_name", "time", "extraction_date"], "time", "10 days")
    windows.store_stream(fresh, f"{root}/out", f"{root}/mark", "feed").awaitTermination()
    stored = spark.read.schema(_columns(rows)).option("recursiveFileLookup", "true").parquet(f"{root}/out")
    return stored.select("city_name", "time", "extraction_date")


@query("stream_load_recovered", load_sql("pollen", where="floor(event_id / 64) % 17 <> 0"))
def stream_load_recovered(spark, sf_dir):
    """Documents loaded in two batches; each batch fails once after its rows were appended and is run again."""
    root, spec = scratch_path(spark, "stream"), facts.FACTS["pollen"]
    store, cities = facts.fact_table(spec, f"{root}/fact"), view(spark, sf_dir, "v_city")
    store.create(spark)
    # grouped and written as text once; the two deliveries and the middle are taken from there
    sinks.append_snapshot(shapes.feed_documents(spark, sf_dir, "pollen"), root, "all")
    docs = lake.read_table(spark, f"{root}/all", "path string, text string")
    chunk = F.regexp_extract("path", r"_(\d+)\.json$", 1).cast("long")
    middle = chunk >= docs.agg(F.max(chunk)).first()[0] // 2
    for late in (False, True):
        part = docs.filter(middle if late else ~middle).repartition(FILES)
        sinks.append_snapshot(part, f"{root}/docs", f"part_{int(late)}")
    failed = set()

    def fail_once(number, counts):
        if number not in failed:
            failed.add(number)
            raise RuntimeError(f"lost after batch {number} appended {counts['rows_loaded']} rows")

    def run():
        stream = windows.table_stream(spark, f"{root}/docs", "path string, text string", FILES)
        incremental.load_new_documents(
            stream, "pollen", cities, store, f"{root}/mark", as_of(), on_loaded=fail_once
        ).awaitTermination()

    for _ in range(2):
        try:
            run()
        except StreamingQueryException:
            continue
    run()
    return plain(store.open(spark).drop(partitions.PARTITION))
