import json
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skyloom.catalog.stored import writers
from skyloom.operators import backfill, lineage
from skyloom.plans import daily, facts
from skyloom.plans.facts import FACTS
from skyloom.quality.errors import QualityError
from skyloom.quality.metrics import clear_history, metric_anomalies, read_history
from skyloom.sources import lake, sinks
from skyloom.streaming import incremental

def as_of():
    return F.lit("2026-01-29 06:00:00").cast("timestamp_ntz")



def cities(spark):
    return spark.createDataFrame([(1, "Madrid"), (2, "Barcelona")], "city_id int, city_name string")


def silver(spark, feed, *rows_, **fixed):
    spec = FACTS[feed]
    names = ["city_name", "time", *spec.sources]
    data = [tuple(r.get(n) for n in names) for r in rows_]
    kinds = {"city_name": "string", "time": "string", "sunrise": "string", "sunset": "string"}
    schema = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)
    df = spark.createDataFrame(data, schema).withColumn("extraction_date", F.lit("2026-01-29"))
    return df.withColumn("o", F.monotonically_increasing_id())


def build(df, feed, spark, target=None):
    return facts.build_fact(df, FACTS[feed], cities(spark), as_of(), ["o"], target)


def test_pollen_rounds_and_keeps_the_first(spark):
    t = "2026-01-29T01:00"
    df = silver(spark, "pollen", {"city_name": "Madrid", "time": t, "alder_pollen": 5.5},
                {"city_name": "Madrid", "time": t, "alder_pollen": 9.0},
                {"city_name": "Unknown", "time": t, "alder_pollen": 1.0}).coalesce(1)
    out = build(df, "pollen", spark)
    assert rows(out.select("city_id", "extraction_date_id", "alder_pollen", "data_source")) == [(1, 20260129, 6, "Open-Meteo")]
    assert build(df, "pollen", spark, target=out).count() == 0


def test_nan_is_null_and_marine_drops_inland_rows(spark):
    df = silver(spark, "marine", {"city_name": "Madrid", "time": "2026-01-29", "wave_height_max": float("nan")},
                {"city_name": "Barcelona", "time": "2026-01-30", "wave_height_max": 1.2, "wave_direction_dominant": 200.9})
    out = build(df, "marine", spark)
    assert rows(out.select("city_id", "forecast_date_id", "wave_direction_dominant")) == [(2, 20260130, 200)]
    assert "data_source" not in out.columns


def test_sunrise_and_overflow(spark):
    df = silver(spark, "daily", {"city_name": "Madrid", "time": "2026-01-29", "temperature_2m_max": 12.345, "sunrise": "2026-01-29T08:30"},
                {"city_name": "Barcelona", "time": "2026-01-29", "temperature_2m_max": 1000.0})
    out = build(df, "daily", spark)
    assert rows(out.select("temp_max", "sunrise")) == [(Decimal("12.35"), "08:30:00")]
    counts = facts.load_accounting(df, FACTS["daily"], cities(spark), as_of(), ["o"])
    assert dict(rows(counts)) == {"loaded": 1, "duplicate": 0, "conflict": 0, "overflow:temp_max": 1}


def test_observation_needs_a_timestamp(spark):
    df = spark.createDataFrame([("Madrid", 1769644800.0, 1.0), ("Madrid", None, 2.0), ("Nowhere", 1.0, 3.0)],
                               "city string, dt double, temperature double")
    for source in FACTS["observation"].sources:
        if source not in df.columns:
            df = df.withColumn(source, F.lit(None).cast("string" if "weather_" in source and source != "weather_id" else "double"))
    df = df.withColumn("date", F.lit("2026-01-29")).withColumn("o", F.monotonically_increasing_id())
    keyed = facts.key_rows(df, FACTS["observation"], cities(spark))
    assert {r.temperature: r.reject_reason for r in keyed.collect()} == {1.0: None, 2.0: "missing_timestamp", 3.0: "unknown_city"}
    row = build(df, "observation", spark).first()
    assert (row.city_id, row.date_id, str(row.observation_timestamp)) == (1, 20260129, "2026-01-29 00:00:00")


def test_load_plan_is_one_shuffle_of_the_batch(spark):
    df = silver(spark, "pollen", {"city_name": "Madrid", "time": "2026-01-29T01:00"})
    text = build(df, "pollen", spark)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "WindowGroupLimit" in text
    assert text.count("Exchange hashpartitioning(city_id") == 1
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


# -- a whole day ------------------------------------------------------------

META = {"extraction_timestamp": "20260129_060000", "execution_date": "2026-01-29"}


def put(root, path, body):
    target = root / "lake" / "bronze" / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(body if isinstance(body, str) else json.dumps(body, indent=2))


def layout_for(spark, tmp_path):
    layout = daily.Layout(str(tmp_path / "lake"), str(tmp_path / "warehouse"))
    city_rows = spark.createDataFrame(
        [("28079", "Madrid", 40.4, -3.7, "ES", 0), ("08019", "Barcelona", 41.38, 2.17, "ES", 1)],
        "city_code string, city_name string, latitude double, longitude double, country_code string, is_coastal int")
    daily.reset_warehouse(spark, layout, city_rows, datetime(2026, 1, 28))
    return layout


def fill(root):
    hours = [f"2026-01-29T{h:02d}:00" for h in range(3)]
    for name in ("Madrid", "Barcelona", "Atlantis"):
        put(root, f"air_quality/2026-01-29/air_{name}.json",
            {"hourly": {"time": hours, "pm10": [1.0, 2.0, None]}, "municipio_nombre": name, "_metadata": META})
    put(root, "air_quality/2026-01-29/broken.json", "{not json")
    put(root, "stations/2026-01-29/stations.json", {"stations": [
        {"indicativo": "3129", "nombre": "RETIRO", "altitud": "667", "latitud": "402455N", "longitud": "034041W"},
        {"indicativo": "9999Z", "nombre": "NEW", "altitud": "1,5", "latitud": "402455N", "longitud": "034041W"}], "_metadata": META})
    put(root, "climatology/daily/2026-01-29/daily_9999Z.json", {"station_id": "9999Z", "_metadata": META, "records": [
        {"fecha": "2026-01-01", "tmed": "8,5", "prec": "Ip"}, {"fecha": "2026-01-01", "tmed": "9,5"}, {"fecha": "2026-01-02"}]})
    put(root, "current/2026-01-29/weather_madrid.json", {
        "dt": 1769644800, "main": {"temp": 10.5, "humidity": 50, "pressure": 1000}, "_metadata": {"city_name": "Madrid"}})


TASKS = ["extract_openweather", "extract_openmeteo_air_quality", "extract_aemet_stations", "extract_aemet_daily_climatology"]


def test_run_day_twice(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    fill(tmp_path)
    tasks = [*TASKS, "extract_openmeteo_pollen"]
    first = daily.run_day(spark, layout, "2026-01-29", datetime(2026, 1, 29, 6), tasks=tasks)
    air = first["extract_openmeteo_air_quality"]
    assert (air["status"], air["rows_input"], air["rows_loaded"], air["rows_rejected"]) == ("success", 9, 6, 3)
    assert air["scores"]["uniqueness"] == 1.0 and air["scores"]["summary"]["success"]
    assert air["outcomes"] == {"loaded": 6, "duplicate": 0, "conflict": 0, "unknown_city": 3}
    assert air["unknown"] == ["Atlantis"]
    assert (air["written"]["documents"], air["written"]["rejected"]) == (4, 1)
    refused = spark.read.parquet(layout.rejects("air_quality", "2026-01-29")).collect()
    assert [(r.path.rsplit("/", 1)[1], r.reject_reason) for r in refused] == [("broken.json", "unreadable")]
    assert first["extract_aemet_daily_climatology"]["rows_loaded"] == 2
    assert first["extract_aemet_daily_climatology"]["outcomes"]["duplicate"] == 1
    assert first["extract_openweather"]["rows_loaded"] == 1
    assert first["extract_aemet_stations"]["rows_loaded"] == 2  # stations of the inventory
    assert daily.stations_of(spark, layout).count() == 16
    assert (first["extract_openmeteo_pollen"]["status"], first["extract_openmeteo_pollen"]["rows_loaded"]) == ("success", 0)
    again = daily.run_day(spark, layout, "2026-01-29", datetime(2026, 1, 29, 7), tasks=tasks)
    assert [again[t]["rows_loaded"] for t in TASKS] == [0, 0, 2, 0]
    assert again["extract_openmeteo_air_quality"]["outcomes"]["conflict"] == 6
    history = read_history(spark, layout.table("metric_history"))
    assert history.filter("target_table = 'fct_air_quality' and metric_name = 'uniqueness_score'").count() == 2
    clear_history(spark, layout.table("metric_history"))
    assert read_history(spark, layout.table("metric_history")).count() == 0

    air = spark.read.parquet(layout.fact("air_quality"))
    assert air.count() == 6 and {str(r.p_month) for r in air.select("p_month").collect()} == {"202601"}
    log = daily.run_log(spark, layout)
    found = {r.task_id: (r.status, r.records_processed) for r in log.collect()}
    assert found["extract_openmeteo_pollen"] == ("success", 0) and found["extract_openweather"] == ("success", 0)
    assert len(found) == 5 and log.filter("duration_seconds is null").count() == 0

    metrics = lineage.read_log(spark, layout.table("etl_metrics"), "etl_metrics")
    loaded = {r.target_table: (r.rows_input, r.rows_loaded, r.rows_rejected) for r in metrics.collect()}
    assert loaded["fct_air_quality"] == (9, 0, 9) and len(loaded) == 3  # the second run replaced the first
    assert metrics.join(log.withColumnRenamed("id", "etl_run_id"), "etl_run_id").count() == 3
    files = lineage.read_log(spark, layout.table("lake_metadata"), "lake_metadata")
    layers = {r.layer: r["count"] for r in files.groupBy("layer").count().collect()}
    bronze = [f for f in (tmp_path / "lake" / "bronze").rglob("*.json") if "2026-01-29" in str(f)]
    assert layers == {"silver": 7, "bronze": len(bronze)} and files.filter("file_size_bytes > 0").count() == files.count()
    assert files.filter("layer = 'bronze' and record_count = 1 and object_path like 'air_quality/2026-01-29/%'").count() == 4

    bounds = spark.sql("select date'2026-01-29' first_day, date'2026-01-30' last_day")
    gaps = backfill.gaps(log, bounds)
    assert gaps.count() == 16 - 5
    plan = backfill.backfill_plan(log, spark.sql("select date'2026-01-29' first_day, date'2026-01-29' last_day"), "aemet", force=True)
    assert plan.count() == 0

    calls = []

    def runner(date, task):
        calls.append((date, task))
        if task.endswith("marine"):
            raise RuntimeError("no sea")

    one_day = spark.sql("select date'2026-01-29' first_day, date'2026-01-29' last_day")
    counts = backfill.run_backfill(backfill.backfill_plan(log, one_day), runner)
    assert counts == {"success": 2, "failed": 1, "skipped": 0}
    assert [t for _, t in calls] == sorted(t for _, t in calls)


def test_rejects_of_an_earlier_run_are_replaced_and_unread_files_listed(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    fill(tmp_path)
    daily.transform(spark, layout, "air_quality", "2026-01-29", datetime(2026, 1, 29, 6))
    put(tmp_path, "air_quality/2026-01-29/broken.json", {"hourly": {"time": []}, "municipio_nombre": "Madrid", "_metadata": META})
    done = daily.transform(spark, layout, "air_quality", "2026-01-29", datetime(2026, 1, 29, 7))
    assert (done["documents"], done["rejected"]) == (4, 0)
    assert not lake.folders_matching(spark, layout.rejects("air_quality", "2026-01-29"))
    docs = lake.documents_or_prefix(spark, None, layout.lake, "bronze/air_quality/2026-01-29/")
    files = lake.document_files(spark, None, layout.lake, "bronze/air_quality/2026-01-29/")
    some = docs.filter(~F.col("path").endswith("air_Madrid.json"))
    lost = daily.rejected_documents(some, files, "air_quality").collect()
    assert [(r.path.rsplit("/", 1)[1], r.reject_reason) for r in lost] == [("air_Madrid.json", "unreadable_file")]


def test_accounting_of_an_empty_feed_and_null_orders(spark):
    df = silver(spark, "pollen", {"city_name": "Madrid", "time": "2026-01-29T01:00"})
    counts = facts.load_accounting(df.limit(0), FACTS["pollen"], cities(spark), as_of(), ["o"])
    assert dict(rows(counts)) == {"loaded": 0, "duplicate": 0, "conflict": 0}
    bad = silver(spark, "daily", {"city_name": "Madrid", "time": "x"}, {"city_name": None, "time": "2026-01-29"},
                 *[{"city_name": "Madrid", "time": "2026-01-29", "temperature_2m_max": t} for t in (1000.0, 1.0)])
    counts = facts.load_accounting(bad.coalesce(1).withColumn("o", F.lit(None).cast("long")), FACTS["daily"],
                                   cities(spark), as_of(), ["o", "temperature_2m_max"])
    assert dict(rows(counts)) == {"loaded": 1, "duplicate": 1, "conflict": 0, "unknown_city": 1,
                                  "null_key:forecast_date_id": 1}


def test_series_with_null_names_stay_apart(spark):
    values = [(None, "a", 1.0)] * 6 + [(None, "a", 50.0)] + [("a", None, 50.0)] * 6 + [("a", None, 1.0)]
    history = spark.createDataFrame(values, "target_table string, metric_name string, value double")
    found = metric_anomalies(history).select("target_table", "metric_name", "value")
    assert sorted(rows(found), key=repr) == [("a", None, 1.0), (None, "a", 50.0)]


def test_strict_gate_stops_the_load(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    put(tmp_path, "air_quality/2026-01-29/a.json", {
        "hourly": {"time": ["2026-01-29T00:00"], "pm10": [5000.0]}, "municipio_nombre": "Madrid", "_metadata": META})
    run_at = datetime(2026, 1, 29, 6)
    daily.transform(spark, layout, "air_quality", "2026-01-29", run_at)
    with pytest.raises(QualityError):
        daily.load(spark, layout, "air_quality", "2026-01-29", run_at, strict=True)
    assert layout.fact_table("air_quality").open(spark).count() == 0
    assert daily.load(spark, layout, "air_quality", "2026-01-29", run_at)["rows_loaded"] == 1


def test_latest_snapshot_wins_and_historical_reads_all(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    body = {"hourly": {"time": ["2026-01-29T00:00"], "pm10": [1.0]}, "municipio_nombre": "Madrid", "_metadata": META}
    put(tmp_path, "air_quality/2026-01-29/a.json", body)
    daily.transform(spark, layout, "air_quality", "2026-01-29", datetime(2026, 1, 29, 6))
    body["hourly"]["pm10"] = [7.0]
    put(tmp_path, "air_quality/2026-01-29/a.json", body)
    daily.transform(spark, layout, "air_quality", "2026-01-29", datetime(2026, 1, 29, 7))
    assert daily.latest_silver(spark, layout, "air_quality", "2026-01-29").first().pm10 == 7.0
    for year in (2024, 2025):
        put(tmp_path, f"historical/{year}/3129/h.json", {"station_id": "3129", "year": year, "_metadata": META,
            "records": [{"fecha": f"{year}-05-01", "tmed": "1,0"}]})
    daily.transform(spark, layout, "historical", "2026-01-29", datetime(2026, 1, 29, 6))
    put(tmp_path, "historical/2025/3129/h.json", {"station_id": "3129", "year": 2025, "_metadata": META,
        "records": [{"fecha": "2025-05-01", "tmed": "9,0"}, {"fecha": "2025-05-02", "tmed": "2,0"}]})
    daily.transform(spark, layout, "historical", "2026-01-29", datetime(2026, 1, 29, 7))
    bad = next((tmp_path / "lake" / "silver" / "historical").rglob("*.parquet")).with_name("bad.parquet")
    bad.write_bytes(b"PAR1 nonsense PAR1")
    first = daily.load(spark, layout, "historical", "2026-01-29", datetime(2026, 1, 29, 7))
    assert first["rows_loaded"] == 3 and len(first["skipped"]) == 1 and first["skipped"][0].endswith("/bad.parquet")
    log = lineage.read_log(spark, layout.table("lake_metadata"), "lake_metadata")
    assert {r.status: r["count"] for r in log.groupBy("status").count().collect()} == {"loaded": first["files"] - 1, "skipped": 1}
    loaded = {r.date_id: float(r.temp_avg) for r in spark.read.parquet(layout.fact("historical")).collect()}
    assert loaded == {20240501: 1.0, 20250501: 1.0, 20250502: 2.0}  # the first snapshot wins
    # the second load tries the file that could not be read and opens none that was loaded
    for old in (tmp_path / "lake" / "silver" / "historical").rglob("*.parquet"):
        if old.is_file() and old.name != "bad.parquet":
            old.write_bytes(b"would fail to open")
    bad.unlink()
    again = daily.load(spark, layout, "historical", "2026-01-29", datetime(2026, 1, 29, 8))
    assert (again["rows_loaded"], again["files"]) == (0, 0)


def test_incremental_load_replays_nothing(spark, tmp_path):
    fill(tmp_path)
    source, table, mark = (str(tmp_path / p) for p in ("lake/bronze/air_quality", "fact", "mark"))

    def run(checkpoint):
        docs = incremental.document_stream(spark, source)
        store = facts.fact_table(FACTS["air_quality"], table, 4)
        incremental.load_new_documents(docs, "air_quality", cities(spark), store, checkpoint, as_of()).awaitTermination()
        return spark.read.parquet(table).count()

    assert run(mark) == 6
    put(tmp_path, "air_quality/2026-01-30/air_x.json",
        {"hourly": {"time": ["2026-01-30T00:00"]}, "municipio_nombre": "Madrid", "_metadata": META})
    assert run(mark) == 7
    assert run(str(tmp_path / "fresh")) == 7  # everything again from the start


# -- sources and sinks ------------------------------------------------------


def test_city_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("city_code,city_name,latitud,longitud,country_code,is_coastal\n08019,Málaga,36.7,-4.4,ES,1\n")
    assert rows(lake.read_city_csv(spark, str(path))) == [("08019", "Málaga", 36.7, -4.4, "ES", 1)]
    path.write_text("city_code,city_name\n1,x\n")
    with pytest.raises(ValueError, match="latitud"):
        lake.read_city_csv(spark, str(path))


def test_corrupt_file_is_skipped_in_the_historical_scan(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "h" / "a"))
    (tmp_path / "h" / "a" / "bad.parquet").write_bytes(b"PAR1 nonsense PAR1")
    path = str(tmp_path / "h" / "a")
    assert lake.read_table(spark, path, "id long", skip_bad_files=True).count() == 3
    with pytest.raises(Exception):
        lake.read_table(spark, path, "id long").count()


def test_listing_and_missing_prefix(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "x" / "a.parquet"))
    assert lake.list_objects(spark, str(tmp_path), "x", ".parquet").count() == 1
    assert lake.list_objects(spark, str(tmp_path), "nothing", ".parquet").count() == 0
    assert lake.latest_file(spark, str(tmp_path), "nothing") is None


def test_indented_documents(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"a": 1, "b": {"c": [1, 2]}}, indent=2))
    (tmp_path / "c.json").write_text("{\n broken")
    back = lake.read_json(spark, str(tmp_path), "a int, b struct<c: array<int>>")
    assert sorted(rows(back.selectExpr("a", "b.c[1]", "_corrupt_record is null")), key=repr) == [
        (1, 2, True), (1, 2, True), (None, None, False)]


def test_json_round_trip_and_date_overwrite(spark, tmp_path):
    docs = spark.createDataFrame([('{"a": 1}',), ("{broken",)], "text string")
    assert sinks.write_json(docs, str(tmp_path / "j")) > 0
    back = lake.read_json(spark, str(tmp_path / "j"), "a int", multi_line=False)
    assert sorted(rows(back), key=repr) == [(1, None), (None, "{broken")]
    root = str(tmp_path / "d")
    sinks.overwrite_dates(spark.createDataFrame([(1, "d1"), (2, "d2")], "v int, date string"), root)
    sinks.overwrite_dates(spark.createDataFrame([(9, "d2")], "v int, date string"), root)
    assert sorted(rows(spark.read.parquet(root))) == [(1, "d1"), (9, "d2")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        for _ in range(2):
            sinks.append_snapshot(docs, str(tmp_path), "snap_1")


def test_dates_in_falling_order_and_one_moment_lose_no_rows(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    fill(tmp_path)
    moment = datetime(2026, 2, 3, 6)
    for date, tasks in (("2026-01-30", TASKS[:1]), ("2026-01-29", TASKS[:1]), ("2026-01-29", TASKS[1:2])):
        daily.run_day(spark, layout, date, moment, tasks=tasks)
    log = daily.run_log(spark, layout)
    assert sorted((str(r.execution_date), r.task_id, r.status) for r in log.collect()) == [
        ("2026-01-29", "extract_openmeteo_air_quality", "success"),
        ("2026-01-29", "extract_openweather", "success"), ("2026-01-30", "extract_openweather", "success")]
    assert log.select("id").distinct().count() == 3


def test_run_gaps_runs_the_missing_tasks(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    fill(tmp_path)
    bounds = spark.sql("select date'2026-01-28' first_day, date'2026-01-29' last_day")
    counts = daily.run_gaps(spark, layout, bounds, datetime(2026, 2, 3, 6), "openweather")
    assert counts == {"success": 2, "failed": 0, "skipped": 0}
    log = daily.run_log(spark, layout)
    assert sorted((str(r.execution_date), r.records_processed) for r in log.collect()) == [("2026-01-28", 0), ("2026-01-29", 1)]
    assert daily.run_gaps(spark, layout, bounds, datetime(2026, 2, 3, 7), "openweather") == dict.fromkeys(counts, 0)


def test_default_stations_and_historical_task_without_data(spark, tmp_path):
    layout = layout_for(spark, tmp_path)
    out = daily.run_day(spark, layout, "2026-01-29", datetime(2026, 1, 29, 6), tasks=["extract_aemet_stations", daily.HISTORICAL_TASK])
    assert out["extract_aemet_stations"]["status"] == "success" and out["extract_aemet_stations"]["rows_loaded"] == 15
    assert (out[daily.HISTORICAL_TASK]["status"], out[daily.HISTORICAL_TASK]["rows_loaded"]) == ("success", 0)


def test_named_documents_come_before_the_prefix(spark, tmp_path):
    fill(tmp_path)
    root = str(tmp_path / "lake" / "bronze")
    prefix = "air_quality/2026-01-29/"
    assert lake.documents_or_prefix(spark, None, root, prefix).count() == 4
    one = lake.documents_or_prefix(spark, [f"{prefix}air_Madrid.json"], root, prefix)
    assert one.count() == 1 and one.first().path.endswith("air_Madrid.json")
    layout = daily.Layout(str(tmp_path / "lake"), str(tmp_path / "w"))
    done = daily.transform(spark, layout, "air_quality", "2026-01-29", datetime(2026, 1, 29, 6), [f"bronze/{prefix}air_Madrid.json"])
    assert done["rows"] == 3 and done["bytes"] > 0


def test_paths(spark):
    df = spark.createDataFrame([("s3://b/current/2026-01-29/weather_las palmas_20260129_060000.json",), ("else.json",)], "p string")
    parts = lake.parse_path(F.col("p"), "current/{date}/weather_{city}_{timestamp}.json")
    assert rows(df.select(*[c.alias(n) for n, c in parts.items()])) == [
        ("2026-01-29", "las palmas", "20260129_060000"), (None, None, None)]


def test_period_chunks_stop_at_the_run_date(spark):
    df = lake.period_chunks(spark.createDataFrame([("a",)], "s string"), F.lit(2025), F.lit(2026), F.lit("2026-05-10"))
    out = [(str(r.start_date), str(r.end_date)) for r in df.orderBy("start_date").collect()]
    assert len(out) == 6 and out[0] == ("2025-01-01", "2025-03-31") and out[-1] == ("2026-04-01", "2026-05-10")


def test_small_documents_share_tasks(spark, tmp_path):
    layout = daily.Layout(str(tmp_path / "lake"), str(tmp_path / "warehouse"))
    folder = Path(layout.bronze("pollen", "2026-01-29"))
    folder.mkdir(parents=True)
    for i in range(800):
        body = {"municipio_nombre": f"C{i}", "hourly": {"time": ["2026-01-29T00:00"], "birch_pollen": [i]}, "_metadata": {}}
        (folder / f"pollen_{i:03d}.json").write_text(json.dumps(body))
    done = daily.transform(spark, layout, "pollen", "2026-01-29", datetime(2026, 1, 29, 6))
    assert (done["rows"], done["documents"], done["rejected"]) == (800, 800, 0)
    # 32 documents a task without that, 25 files
    assert len(list((Path(layout.silver) / done["path"]).glob("*.parquet"))) <= 4 * spark.sparkContext.defaultParallelism
    assert done["listing"].count() == 800


def test_file_names_of_a_writer_sort_in_order():
    assert writers(10) == 32
    assert all(n / writers(n) <= 500 for n in (16_001, 39_555, 237_330))


def test_a_load_reads_its_batch_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(name):
        read.add(1)
        return name

    spec = FACTS["pollen"]
    names = ["city_name", "time", "extraction_date", "o", *spec.sources]
    data = [(city, "2026-01-01T00:00", "2026-01-01", i, *[1.0] * len(spec.sources))
            for i, city in enumerate(["Madrid", "Madrid", "Atlantis", None, "Atlantis", "Thule"])]
    kinds = ["string"] * 3 + ["int"] + ["double"] * len(spec.sources)
    batch = spark.createDataFrame(data, ", ".join(f"{a} {b}" for a, b in zip(names, kinds)))
    batch = batch.withColumn("city_name", F.udf(seen, "string").asNondeterministic()("city_name"))
    cities = spark.createDataFrame([(1, "Madrid")], "city_id int, city_name string")
    store = facts.fact_table(spec, str(tmp_path / "f"), 4)
    got = facts.load_fact(batch, spec, cities, store, F.lit("2026-01-02").cast("timestamp_ntz"), ["o"])
    assert got["outcomes"] == {"loaded": 1, "duplicate": 1, "conflict": 0, "unknown_city": 4}
    assert got["unknown"] == [None, "Atlantis", "Thule"]
    assert read.value == len(data)


def test_documents_of_one_file_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    body = {"municipio_nombre": "Madrid", "hourly": {"time": ["2026-01-29T00:00"], "birch_pollen": [1]}, "_metadata": META}
    docs = spark.createDataFrame([(f"p{i:02d}", json.dumps(body)) for i in range(40)], "path string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "in"))
    tasks = []

    def load(batch, *rest):
        tasks.append(batch.select(F.spark_partition_id()).distinct().count())
        return {}

    monkeypatch.setattr(incremental, "load_fact", load)
    stream = spark.readStream.schema("path string, text string").parquet(str(tmp_path / "in"))
    incremental.load_new_documents(stream, "pollen", cities(spark), None, str(tmp_path / "mark"), as_of()).awaitTermination()
    assert tasks == [4]
