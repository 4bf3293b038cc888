"""Run log, lineage and backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog.registry import AS_OF, as_of, plain, query, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import backfill, dedupe, lineage
from skyloom.session import scratch_path
from skyloom.sources import lake

_LOG_SQL = """, log AS (SELECT id, dag_id, task_id, execution_date, execution_date + interval 6 hour AS start_time,
    CASE WHEN status <> 'running' THEN execution_date + interval 7 hour END AS end_time, status, records_processed
  FROM v_attempt QUALIFY row_number() OVER (PARTITION BY dag_id, task_id, execution_date ORDER BY o_orderkey DESC) = 1)"""
_FMT = "'%Y-%m-%d %H:%M:%S'"


def _log(spark, sf_dir):
    """The last attempt of each task and day, as a run log."""
    rows = dedupe.keep_last(view(spark, sf_dir, "v_attempt"), lineage.RUN_KEY, ["o_orderkey"])
    day = F.col("execution_date").cast("timestamp_ntz")
    early, late = day + F.expr("interval 6 hours"), day + F.expr("interval 7 hours")
    text, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    return rows.select(
        "id", "dag_id", "task_id", "execution_date", early.alias("start_time"),
        F.when(F.col("status") != "running", late).alias("end_time"), "status", "records_processed",
        text.alias("error_message"), number.alias("duration_seconds"),
        early.alias("created_at"), early.alias("updated_at"),
    )


_RUN_COLUMNS = ["id", "task_id", "execution_date", "start_time", "end_time", "status", "records_processed"]
_TASK_OF_LINE = (
    "CASE l_suppkey % 8 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(fixed.EXPECTED_TASKS)) + " END"
)


@query(
    "run_log_start",
    with_views(
        "v_attempt",
        _LOG_SQL + f""", n AS (SELECT DISTINCT {_TASK_OF_LINE} AS task_id, cast(l_shipdate as date) AS execution_date FROM lineitem),
s AS (SELECT *, execution_date + interval 9 hour AS start_time FROM n)
SELECT log.id, log.task_id, cast(log.execution_date as varchar) AS execution_date,
  strftime(coalesce(s.start_time, log.start_time), {_FMT}) AS start_time,
  CASE WHEN s.task_id IS NULL THEN strftime(log.end_time, {_FMT}) END AS end_time,
  CASE WHEN s.task_id IS NULL THEN log.status ELSE 'running' END AS status, log.records_processed
FROM log LEFT JOIN s ON s.task_id = log.task_id AND s.execution_date = log.execution_date
UNION ALL
SELECT (SELECT max(id) FROM log) + row_number() OVER (ORDER BY task_id, execution_date), task_id,
  cast(execution_date as varchar), strftime(start_time, {_FMT}), NULL, 'running', NULL
FROM s ANTI JOIN log USING (task_id, execution_date)""",
    ),
)
def run_log_start(spark, sf_dir):
    """Shipping days start runs; some are logged already, some are new."""
    day = F.col("l_shipdate").cast("date")
    starts = table(spark, sf_dir, "lineitem").select(
        F.lit(fixed.EXTRACTION_DAG).alias("dag_id"), F.expr(_TASK_OF_LINE).alias("task_id"),
        day.alias("execution_date"),
    ).distinct()
    starts = starts.withColumn("start_time", F.col("execution_date").cast("timestamp_ntz") + F.expr("interval 9 hours"))
    return plain(lineage.start_runs(_log(spark, sf_dir), starts, as_of()).select(*_RUN_COLUMNS))


@query(
    "run_log_end",
    with_views(
        "v_attempt",
        _LOG_SQL + f"""
SELECT id, task_id, cast(execution_date as varchar) AS execution_date, strftime(start_time, {_FMT}) AS start_time,
  CASE WHEN status <> 'running' THEN strftime(end_time, {_FMT}) ELSE strftime(start_time + to_seconds(id % 5000), {_FMT}) END AS end_time,
  CASE WHEN status <> 'running' THEN status WHEN id % 4 = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN status <> 'running' THEN records_processed ELSE id * 2 END AS records_processed,
  CASE WHEN status = 'running' AND id % 4 = 0 THEN 'broke' END AS error_message,
  CASE WHEN status = 'running' THEN cast(id % 5000 as int) END AS duration_seconds FROM log""",
    ),
)
def run_log_end(spark, sf_dir):
    """Every run still under way ends."""
    log = _log(spark, sf_dir)
    broke = F.col("id") % 4 == 0
    ends = log.filter(F.col("status") == "running").select(
        "id",
        (F.col("start_time") + F.make_dt_interval(secs=(F.col("id") % 5000).cast("decimal(18,6)"))).alias("end_time"),
        F.when(broke, "failed").otherwise("success").alias("status"),
        (F.col("id").cast("long") * 2).alias("records_processed"),
        F.when(broke, "broke").alias("error_message"),
    )
    ended = lineage.end_runs(log, ends, as_of())
    return plain(ended.select(*_RUN_COLUMNS, "error_message", "duration_seconds"))


@query(
    "lake_metadata",
    with_views(
        "v_pollen",
        f"""SELECT cast(CASE WHEN day(cast(extraction_date as date)) <= 10 THEN day(cast(extraction_date as date))
    ELSE 10 + row_number() OVER (PARTITION BY extraction_date > '2024-01-10' ORDER BY extraction_date) END as int) AS id,
  'pollen/day=' || extraction_date AS object_path, count(*) AS record_count, 'success' AS status,
  '{AS_OF}' AS load_timestamp FROM v_pollen GROUP BY extraction_date""",
    ),
)
def lake_metadata(spark, sf_dir):
    """Silver folders just written; those of the first ten days were logged before."""
    root = scratch_path(spark, "silver")
    rows = view(spark, sf_dir, "v_pollen").withColumn("day", F.col("extraction_date"))
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(f"{root}/pollen")
    files = lineage.file_records(lake.read_table(spark, f"{root}/pollen"))
    folder = F.regexp_extract("object_path", r"(pollen/day=[0-9-]+)/", 1)
    folders = files.groupBy(folder.alias("object_path")).agg(
        F.sum("record_count").alias("record_count"), F.sum("file_size_bytes").alias("file_size_bytes")
    ).withColumns({"status": F.lit("success"), "bucket_name": F.lit("silver"), "layer": F.lit("silver"),
                   "data_source": F.lit("openmeteo")})
    day = F.to_date(F.right("object_path", F.lit(10)))
    text = F.lit("old")
    before = folders.filter(F.dayofmonth(day) <= 10).select(
        F.dayofmonth(day).alias("id"), text.alias("bucket_name"), "object_path", text.alias("layer"),
        text.alias("data_source"), F.lit(0).cast("long").alias("record_count"), F.lit(0).cast("long").alias("file_size_bytes"),
        text.alias("status"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("load_timestamp"),
    )
    logged = lineage.log_files(before, folders, as_of())
    return plain(logged.select("id", "object_path", "record_count", "status", "load_timestamp"))


@query(
    "etl_metrics",
    f"""WITH m AS (SELECT cast(user_id as int) AS etl_run_id, event_type AS target_table, count(*) AS rows_input,
    count(*) FILTER (WHERE value < 100) AS rows_loaded, count(*) FILTER (WHERE value >= 100) AS rows_rejected,
    cast(cast(count(*) FILTER (WHERE value < 100) / count(*) as decimal(5,4)) as double) AS validity_score
  FROM events GROUP BY ALL),
o AS (SELECT *, row_number() OVER (ORDER BY etl_run_id, target_table) AS id FROM m WHERE target_table IN ('click', 'view'))
SELECT cast(CASE WHEN o.id IS NOT NULL THEN o.id ELSE (SELECT count(*) FROM o) + row_number() OVER (
    PARTITION BY o.id IS NULL ORDER BY etl_run_id, target_table) END as int) AS id,
  etl_run_id, target_table, m.rows_input, m.rows_loaded, m.rows_rejected, m.validity_score,
  CASE WHEN o.id IS NOT NULL THEN 'old' ELSE 'new' END AS data_source, '{AS_OF}' AS measured_at
FROM m LEFT JOIN o USING (etl_run_id, target_table)""",
)
def etl_metrics(spark, sf_dir):
    """Load metrics per run and table; two tables were measured once before."""
    good = F.col("value") < 100
    measured = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").cast("int").alias("etl_run_id"), F.col("event_type").alias("target_table")
    ).agg(
        F.count(F.lit(1)).alias("rows_input"), F.count_if(good).alias("rows_loaded"),
        F.count_if(~good).alias("rows_rejected"),
    )
    none = F.lit(None).cast("double")
    measured = measured.withColumns(
        {"validity_score": F.col("rows_loaded") / F.col("rows_input"), "completeness_score": none,
         "uniqueness_score": none, "freshness_score": none, "overall_quality_score": none,
         "quality_details": F.lit(None).cast("string"), "data_source": F.lit("new"),
         "execution_date": F.lit("2024-01-31").cast("date")}
    )
    known = measured.filter(F.col("target_table").isin("click", "view"))
    empty = spark.createDataFrame([], lineage.METRIC_COLUMNS)
    earlier = lineage.log_metrics(empty, known.withColumn("data_source", F.lit("old")), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    logged = lineage.log_metrics(earlier, measured, as_of())
    return plain(logged.select(
        "id", "etl_run_id", "target_table", "rows_input", "rows_loaded", "rows_rejected", "validity_score",
        "data_source", "measured_at",
    ))


# -- backfill ---------------------------------------------------------------

_TASKS = ", ".join(f"('{t}')" for t in fixed.EXPECTED_TASKS)
_GAPS_SQL = _LOG_SQL + f""", b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
e AS (SELECT cast(s as date) AS day, t AS task_id FROM b, unnest(generate_series(lo, hi, interval 1 day)) u(s), (VALUES {_TASKS}) v(t)),
g AS (SELECT cast(day as varchar) AS execution_date, '{fixed.EXTRACTION_DAG}' AS dag_id, e.task_id, coalesce(status, 'missing') AS status
  FROM e LEFT JOIN log ON log.execution_date = day AND log.task_id = e.task_id WHERE status IS NULL OR status = 'failed')"""


def _gaps_sql(body: str) -> str:
    return with_views("v_attempt", _GAPS_SQL + "\n" + body)


def _bounds(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def _gaps(spark, sf_dir, source="all"):
    return backfill.gaps(_log(spark, sf_dir), _bounds(spark, sf_dir), source)


@query("gap_detect", _gaps_sql("SELECT * FROM g"))
def gap_detect(spark, sf_dir):
    return _gaps(spark, sf_dir).orderBy("execution_date", "task_id")


@query("gap_detect_source", _gaps_sql("SELECT * FROM g WHERE task_id LIKE '%openmeteo%'"))
def gap_detect_source(spark, sf_dir):
    return _gaps(spark, sf_dir, "openmeteo")


# the same attempts before they were reduced to the last one of each day
_DONE_SQL = "SELECT cast(execution_date as varchar) AS execution_date, task_id FROM v_attempt WHERE status = 'success'"


@query(
    "backfill_todo",
    _gaps_sql(f"SELECT g.* FROM g ANTI JOIN ({_DONE_SQL}) USING (execution_date, task_id)"),
)
def backfill_todo(spark, sf_dir):
    return backfill.to_do(_gaps(spark, sf_dir), view(spark, sf_dir, "v_attempt"))


@query(
    "gaps_by_date",
    _gaps_sql("SELECT execution_date, string_agg(task_id, ',' ORDER BY task_id) AS tasks FROM g GROUP BY execution_date"),
)
def gaps_by_date(spark, sf_dir):
    grouped = backfill.gaps_by_date(_gaps(spark, sf_dir))
    return grouped.select("execution_date", F.array_join("tasks", ",").alias("tasks"))


@query(
    "backfill_plan",
    _gaps_sql(
        f"""SELECT execution_date, task_id, status, CASE WHEN (execution_date, task_id) IN ({_DONE_SQL}) THEN 'skip' ELSE 'run' END AS action,
  replace(task_id, 'extract_', 'transform_') AS transform_step,
  CASE WHEN task_id <> 'extract_aemet_stations' THEN replace(task_id, 'extract_', 'load_') END AS load_step FROM g"""
    ),
)
def backfill_plan(spark, sf_dir):
    """Gaps of the reduced log, checked against every attempt."""
    found = _gaps(spark, sf_dir)
    attempts = view(spark, sf_dir, "v_attempt")
    return backfill.with_steps(backfill.with_action(found, attempts))


@query(
    "backfill_summary",
    _gaps_sql(
        f"""SELECT count(*) FILTER (WHERE NOT done AND status = 'missing') AS success,
  count(*) FILTER (WHERE NOT done AND status = 'failed') AS failed, count(*) FILTER (WHERE done) AS skipped
FROM (SELECT *, (execution_date, task_id) IN ({_DONE_SQL}) AS done FROM g)"""
    ),
)
def backfill_summary(spark, sf_dir):
    """Outcome counts, with the failed runs failing again."""
    found = backfill.with_action(_gaps(spark, sf_dir), view(spark, sf_dir, "v_attempt"))
    outcome = F.when(F.col("action") == "skip", "skipped").when(F.col("status") == "failed", "failed").otherwise("success")
    return backfill.backfill_summary(found.withColumn("outcome", outcome))


