import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skyloom.operators import backfill, diagnostics, lineage


def moment(text):
    return F.lit(text).cast("timestamp_ntz")


def starts(spark, *keys):
    df = spark.createDataFrame(keys, "dag_id string, task_id string, day string, at string")
    return df.select("dag_id", "task_id", F.col("day").cast("date").alias("execution_date"),
                     F.col("at").cast("timestamp_ntz").alias("start_time"))


def test_run_log_life(spark):
    log = spark.createDataFrame([], lineage.RUN_LOG_COLUMNS)
    log = lineage.start_runs(log, starts(spark, ("d", "b", "2026-01-01", "2026-01-01 06:00:00"),
                                         ("d", "a", "2026-01-01", "2026-01-01 06:00:00")), moment("2026-01-01 06:00:00"))
    assert sorted(rows(log.select("id", "task_id", "status"))) == [(1, "a", "running"), (2, "b", "running")]
    ends = spark.createDataFrame([(1, "failed", 5, "boom")], "id int, status string, records_processed long, error_message string")
    ends = ends.withColumn("end_time", moment("2026-01-01 06:01:30"))
    log = lineage.end_runs(log, ends, moment("2026-01-01 06:01:30"))
    first = log.filter("id = 1").first()
    assert (first.status, first.duration_seconds, first.error_message, first.records_processed) == ("failed", 90, "boom", 5)
    assert log.filter("id = 2").first().status == "running"
    log = lineage.start_runs(log, starts(spark, ("d", "a", "2026-01-01", "2026-01-02 06:00:00")), moment("2026-01-02 06:00:00"))
    again = log.filter("id = 1").first()
    assert (again.status, again.end_time, again.error_message, again.records_processed) == ("running", None, None, 5)
    assert log.count() == 2


def test_file_lineage(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "x"))
    files = lineage.file_records(spark.read.parquet(str(tmp_path / "x")))
    found = files.first()
    assert found.record_count == 5 and found.file_size_bytes > 0
    files = files.withColumns({c: F.lit("silver") for c in ("bucket_name", "layer", "data_source", "status")})
    empty = spark.createDataFrame([], lineage.LAKE_COLUMNS)
    once = lineage.log_files(empty, files, moment("2026-01-01"))
    twice = lineage.log_files(once, files.withColumn("record_count", F.lit(7)), moment("2026-01-02"))
    row = twice.first()
    assert (twice.count(), row.id, row.record_count, str(row.load_timestamp)) == (1, 1, 7, "2026-01-02 00:00:00")


def run_log(spark, *entries):
    df = spark.createDataFrame(entries, "day string, task_id string, status string")
    return df.select(F.col("day").cast("date").alias("execution_date"), F.lit("extraction_pipeline").alias("dag_id"),
                     "task_id", "status")


def bounds(spark, low, high):
    return spark.sql(f"select date'{low}' first_day, date'{high}' last_day")


def test_gaps(spark):
    log = run_log(spark, ("2026-01-01", "extract_openweather", "success"), ("2026-01-01", "extract_openmeteo_daily", "failed"),
                  ("2026-01-01", "extract_openmeteo_marine", "running"))
    found = backfill.gaps(log, bounds(spark, "2026-01-01", "2026-01-01"))
    status = dict(rows(found.select("task_id", "status")))
    assert len(status) == 6 and status["extract_openmeteo_daily"] == "failed" and status["extract_openmeteo_pollen"] == "missing"
    assert "extract_openmeteo_marine" not in status
    assert backfill.gaps(log, bounds(spark, "2026-01-01", "2026-01-02"), "aemet").count() == 4
    with pytest.raises(ValueError):
        backfill.gaps(log, bounds(spark, "2026-01-01", "2026-01-01"), "elsewhere")


def test_plan_skips_success_unless_forced(spark):
    log = run_log(spark, ("2026-01-01", "extract_openweather", "failed"))
    other = log.unionByName(log.withColumns({"status": F.lit("success"), "dag_id": F.lit("manual")}))
    plan = backfill.backfill_plan(other, bounds(spark, "2026-01-01", "2026-01-01"), "openweather")
    assert rows(plan) == [("2026-01-01", "extract_openweather", "failed", "skip", "transform_openweather", "load_openweather")]
    forced = backfill.backfill_plan(other, bounds(spark, "2026-01-01", "2026-01-01"), "openweather", force=True)
    assert forced.first().action == "run"
    stations = backfill.backfill_plan(log, bounds(spark, "2026-01-01", "2026-01-01"), "aemet")
    assert {r.task_id: r.load_step for r in stations.collect()}["extract_aemet_stations"] is None


def test_gap_plan_pairs_no_tables(spark):
    text = backfill.gaps(run_log(spark, ("2026-01-01", "x", "failed")), bounds(spark, "2026-01-01", "2026-01-01"))
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_null_profile_and_frame_profile(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, "a")], "x double, s string")
    assert rows(diagnostics.null_profile(df).select("column", "null_count", "mostly_null")) == [("x", 2, True), ("s", 2, True)]
    one = diagnostics.frame_profile(df, ["x", "y"], "f").first()
    assert (one.valid, one.row_count, one.issues) == (False, 3, "missing columns: y; x: 66.7% null; s: 66.7% null")
    assert diagnostics.frame_profile(df, ["x"], "f").first().valid
    empty = diagnostics.frame_profile(df.limit(0), ["x"], "f").first()
    assert (empty.valid, empty.issues) == (False, "empty")


def test_json_structure(spark):
    bodies = [{"a": [{"b": 1}, 2], "c": {"d": {"e": 1}}}, {"a": [], "c": None, "f": 1.5, "g": True}]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies] + [("{broken",)], "text string")
    found = {(r.path, r.kind): (r.n_values, r.min_members, r.max_members) for r in diagnostics.json_structure(df).collect()}
    assert found[("$", "dict")] == (2, 2, 4)
    assert found[("$.a", "list")] == (2, 0, 2) and found[("$.a[0]", "dict")] == (1, 1, 1)
    assert found[("$.c", "null")][0] == 1 and found[("$.c.d", "dict")] == (1, 1, 1)
    assert found[("$.f", "float")][0] == 1 and found[("$.g", "bool")][0] == 1
    assert not any(path.count(".") > 2 for path, _ in found)


def test_schema_diff(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([], "i long, t string")
    out = {r.column: (r.presence, r.type_differs, r.left_rows, r.right_rows) for r in diagnostics.schema_diff(a, b).collect()}
    assert out == {"i": ("common", True, 1, 0), "s": ("only_left", False, 1, 0), "t": ("only_right", False, 1, 0)}
