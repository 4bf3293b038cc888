"""One day from bronze documents to fact rows, with run log and lineage."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.operators import backfill, flatten, lineage
from skyloom.operators.partitions import MonthTable
from skyloom.plans import dims
from skyloom.plans.facts import FACTS, fact_table, load_fact
from skyloom.plans.historical import load_new_files
from skyloom.quality.checks import suite_for
from skyloom.quality.metrics import append_history, gate_report
from skyloom.session import checkpointed
from skyloom.sources import lake, sinks

_ORDER = ["_src", "_pos"]
_HISTORICAL_COLUMNS = ", ".join(
    ["station_id string", "station_name string", "province string", "date string", "year int"]
    + [f"{name} double" for _, name in flatten.CLIMATOLOGY]
    + ["extraction_date string", "_src string", "_pos int"]
)
HISTORICAL_TASK = "load_aemet_historical"
TASK_FEED = {
    "extract_openweather": "observation",
    "extract_openmeteo_daily": "daily",
    "extract_openmeteo_hourly": "hourly",
    "extract_openmeteo_air_quality": "air_quality",
    "extract_openmeteo_pollen": "pollen",
    "extract_openmeteo_marine": "marine",
    "extract_aemet_stations": "stations",
    "extract_aemet_daily_climatology": "station_day",
    HISTORICAL_TASK: "historical",
}


@dataclass(frozen=True)
class Layout:
    """Where a lake and a warehouse keep their tables."""

    lake: str
    warehouse: str
    buckets: int = 8

    def bronze(self, feed: str, date: str) -> str:
        head = fixed.BRONZE_PATHS[feed].split("{", 1)[0]
        return f"{self.lake}/bronze/{head}" if feed == "historical" else f"{self.lake}/bronze/{head}{date}/"

    @property
    def silver(self) -> str:
        return f"{self.lake}/silver"

    def silver_prefix(self, feed: str, date: str) -> str:
        return fixed.SILVER_PATHS[feed].split("{", 1)[0] + f"{date}/"

    def rejects(self, feed: str, date: str) -> str:
        return f"{self.warehouse}/document_rejects/feed={feed}/date={date}"

    def fact(self, feed: str) -> str:
        return f"{self.warehouse}/{FACTS['station_day' if feed == 'historical' else feed].table}"

    def fact_table(self, feed: str) -> MonthTable:
        return fact_table(FACTS["station_day" if feed == "historical" else feed], self.fact(feed), self.buckets)

    def table(self, name: str) -> str:
        return f"{self.warehouse}/{name}"


def reset_warehouse(
    spark: SparkSession, layout: Layout, cities: DataFrame, run_at: datetime, week_rule: str = "iso"
) -> None:
    """Dimensions from their seeds, empty facts, empty logs."""
    moment = F.lit(run_at).cast("timestamp_ntz")
    for name in ("dim_aemet_stations", "metric_history", *lineage.LOGS):
        lake.remove_folder(spark, layout.table(name))
    for name, df in dims.dims_all(spark, cities, week_rule, moment).items():
        if name == "dim_aemet_stations":
            sinks.append_rows(df, layout.table(name))
        else:
            df.write.mode("overwrite").parquet(layout.table(name))
    for feed in FACTS:
        layout.fact_table(feed).create(spark)


def stations_of(spark: SparkSession, layout: Layout) -> DataFrame:
    """The station dimension; it is append-only, with one writer at a time for its ids."""
    rows = sinks.current_rows(spark, layout.table("dim_aemet_stations"), dims.STATION_COLUMNS, ["station_id"])
    return rows.drop("_run", "_since")


def run_log(spark: SparkSession, layout: Layout) -> DataFrame:
    return lineage.read_log(spark, layout.table("etl_run_log"), "etl_run_log")


# -- stages -----------------------------------------------------------------


def _flat(docs: DataFrame, feed: str, date: str, stamp: str, watch: Observation | None = None) -> DataFrame:
    day = F.lit(date)
    if feed == "observation":
        return flatten.flatten_observations(docs, day, watch)
    if feed == "stations":
        return flatten.flatten_stations(docs, day, watch)
    if feed in ("station_day", "historical"):
        return flatten.flatten_climatology(docs, day, feed == "historical", watch)
    return flatten.explode_columnar(docs, flatten.FEEDS[feed], day, F.lit(stamp), watch)


def _parsed(docs: DataFrame, feed: str) -> DataFrame:
    if feed == "observation":
        return flatten.parse_observations(docs)
    if feed == "stations":
        return flatten.parse_stations(docs)
    if feed in ("station_day", "historical"):
        return flatten.parse_climatology(docs)
    return flatten.parse_columnar(docs, flatten.FEEDS[feed])


def rejected_documents(docs: DataFrame, files: DataFrame, feed: str) -> DataFrame:
    """``path, reject_reason`` of the documents that gave no rows; a file of
    ``files`` that could not be read at all is an ``unreadable_file``."""
    unread = files.join(docs.select("path").distinct(), "path", "left_anti")
    return flatten.rejects(_parsed(docs, feed)).unionByName(
        unread.select("path", F.lit("unreadable_file").alias("reject_reason"))
    )


def _tasks(spark: SparkSession, size: int) -> int:
    """Tasks for ``size`` bytes of documents: a few per core, more where one would get above 32 MB."""
    return max(4 * spark.sparkContext.defaultParallelism, size // (32 << 20) + 1)


def transform(
    spark: SparkSession, layout: Layout, feed: str, date: str, run_at: datetime,
    handed_over: list[str] | None = None,
) -> dict:
    """Bronze documents of a day to one silver snapshot; returns rows, bytes, documents, rejected and the listing.

    Observations replace the snapshot of their date, all other feeds add one.
    Small documents share tasks, and with them silver files.
    Documents are counted while the snapshot is written.  Only if some were
    refused or not readable are they looked at again, and stored with their
    path and reason in place of those of an earlier run.  A day without
    documents writes nothing; its path is None.
    """
    stamp = f"{run_at:%Y%m%d_%H%M%S}"
    prefix = layout.bronze(feed, date).removeprefix(f"{layout.lake}/")
    if not handed_over and not lake.folders_matching(spark, layout.bronze(feed, date)):
        return {"path": None, "rows": 0, "bytes": 0, "documents": 0, "rejected": 0}
    docs = lake.documents_or_prefix(spark, handed_over, layout.lake, prefix)
    files = lake.document_files(spark, handed_over, layout.lake, prefix)
    found, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    watch = Observation()
    rows = _flat(docs.coalesce(_tasks(spark, size)), feed, date, stamp, watch)
    path = fixed.SILVER_PATHS[feed].format(date=date, timestamp=stamp)
    target = f"{layout.silver}/{path}"
    if feed == "observation":
        done = sinks.write_table(rows, target)
    else:
        done = sinks.append_snapshot(rows, layout.silver, path)
    seen = watch.get
    refused = seen.get("rejected", 0) + found - seen.get("documents", 0)
    folder = layout.rejects(feed, date)
    if refused:
        rejected_documents(docs, files, feed).write.mode("overwrite").parquet(folder)
    elif lake.folders_matching(spark, folder):
        lake.remove_folder(spark, folder)
    return {"path": path, **done, "documents": found, "rejected": refused, "listing": files}


def latest_silver(spark: SparkSession, layout: Layout, feed: str, date: str) -> DataFrame | None:
    """The last finished snapshot of a feed and date."""
    snapshots = lake.finished_folders(
        spark, f"{layout.silver}/{layout.silver_prefix(feed, date)}*"
    )
    return lake.read_table(spark, snapshots[-1]) if snapshots else None


def load(
    spark: SparkSession, layout: Layout, feed: str, date: str, run_at: datetime, strict: bool = False
) -> dict:
    """The latest silver snapshot into its table, behind the quality gate; of the
    historical feed all files that were not loaded before.

    Returns the row accounting and, for feeds with a suite, the quality scores.
    """
    moment = F.lit(run_at).cast("timestamp_ntz")
    if feed == "historical":
        return _load_historical(spark, layout, date, moment)
    silver = latest_silver(spark, layout, feed, date)
    if feed == "stations":
        return _load_stations(spark, layout, silver, moment)
    if silver is None:
        return {"rows_input": 0, "rows_loaded": 0, "rows_rejected": 0}
    spec = FACTS[feed]
    scores = {}
    if spec.suite:
        scores = gate_report(silver.drop(*_ORDER), suite_for(spec.suite), spec.table, moment, strict)
    if spec.entity == "station":
        dim = dims.ensure_stations(stations_of(spark, layout), moment)
    else:
        dim = spark.read.parquet(layout.table("dim_city"))
    order = ["bronze_source"] if feed == "observation" else _ORDER
    counts = load_fact(silver, spec, dim, layout.fact_table(feed), moment, order, F.lit(date))
    return {**counts, "table": spec.table, "scores": scores}


def _load_historical(spark: SparkSession, layout: Layout, date: str, moment: Column) -> dict:
    """New historical files, the oldest snapshot first; unreadable ones are left out and named."""
    spec = FACTS["station_day"]
    dim = dims.ensure_stations(stations_of(spark, layout), moment)
    counts = load_new_files(
        spark, layout.silver, "historical/", _HISTORICAL_COLUMNS, layout.table("lake_metadata"),
        spec, dim, layout.fact_table("historical"), moment, _ORDER, "aemet", F.lit(date),
    )
    return {**counts, "table": spec.table, "scores": {}} if counts["files"] else counts


def _load_stations(spark: SparkSession, layout: Layout, silver: DataFrame | None, moment: Column) -> dict:
    """The stations of an inventory, or the default ones; counts them, not the dimension."""
    feed = dims.default_stations(spark) if silver is None or silver.isEmpty() else silver
    merged = dims.load_stations(stations_of(spark, layout), feed, moment)
    touched = Observation()
    changed = merged.join(feed.select("station_id").distinct(), "station_id", "left_semi")
    sinks.append_rows(changed.observe(touched, F.count(F.lit(1)).alias("n")), layout.table("dim_aemet_stations"))
    n = touched.get["n"]
    return {"rows_input": n, "rows_loaded": n, "rows_rejected": 0}


def run_task(
    spark: SparkSession, layout: Layout, task: str, date: str, run_at: datetime, strict: bool = False
) -> dict:
    """Transform and load what one extraction task delivered.

    The historical task loads what lies in silver.  A day without documents is
    a success with no rows; without an inventory the default stations are used.
    """
    feed = TASK_FEED[task]
    if feed == "historical":
        return load(spark, layout, feed, date, run_at, strict)
    written = transform(spark, layout, feed, date, run_at)
    if written["path"] is None and feed != "stations":
        return {"rows_input": 0, "rows_loaded": 0, "rows_rejected": 0}
    return {"written": written, **load(spark, layout, feed, date, run_at, strict)}


# -- a day ------------------------------------------------------------------


def _source(task: str) -> str:
    return task.split("_")[1]


def _start_log(spark, layout, tasks, date, moment) -> None:
    names = spark.createDataFrame(
        [(fixed.EXTRACTION_DAG, task, date) for task in tasks], "dag_id string, task_id string, day string"
    ).select("dag_id", "task_id", F.col("day").cast("date").alias("execution_date"), moment.alias("start_time"))
    lineage.append_log(
        spark, layout.table("etl_run_log"), "etl_run_log", names, lambda log: lineage.start_runs(log, names, moment)
    )


def _end_log(spark, layout, results, date, moment) -> DataFrame:
    """Append all outcomes to the run log; returns the ids of the day's runs."""
    ids = run_log(spark, layout).filter(
        (F.col("dag_id") == fixed.EXTRACTION_DAG) & (F.col("execution_date") == F.lit(date).cast("date"))
    ).select("id", *lineage.RUN_KEY)
    ends = spark.createDataFrame(
        [(t, r["status"], r["rows_loaded"], r.get("error"), datetime.now()) for t, r in results.items()],
        "task_id string, status string, records_processed long, error_message string, end_time timestamp_ntz",
    )
    ends = ids.join(ends, "task_id")
    lineage.append_log(
        spark, layout.table("etl_run_log"), "etl_run_log", ends, lambda log: lineage.end_runs(log, ends, moment)
    )
    return ids.select("id", "task_id")


_FILE_COLUMNS = """bucket_name string, object_path string, layer string, data_source string,
record_count long, file_size_bytes long, status string"""


def _bronze_files(task: str, files: DataFrame) -> DataFrame:
    """The documents a task read, one record each, from the listing alone."""
    return files.select(
        F.lit("bronze").alias("bucket_name"), F.regexp_extract("path", "/bronze/(.*)$", 1).alias("object_path"),
        F.lit("bronze").alias("layer"), F.lit(_source(task)).alias("data_source"),
        F.lit(1).cast("long").alias("record_count"), F.col("length").alias("file_size_bytes"),
        F.lit("success").alias("status"),
    )


def _log_files(spark, layout, results, moment) -> None:
    """Bronze documents that were read and silver snapshots that were written."""
    written = {t: r["written"] for t, r in results.items() if r.get("written", {}).get("path")}
    if written:
        silver = [
            ("silver", w["path"], "silver", _source(t), w["rows"], w["bytes"], "success") for t, w in written.items()
        ]
        new = spark.createDataFrame(silver, _FILE_COLUMNS)
        for task, w in written.items():
            new = new.unionByName(_bronze_files(task, w["listing"]))
        new = checkpointed(new)  # listed once, looked at twice
        lineage.append_log(
            spark, layout.table("lake_metadata"), "lake_metadata", new, lambda log: lineage.log_files(log, new, moment)
        )


def _log_metrics(spark, layout, results, ids, date, moment) -> None:
    dimensions = ["completeness", "validity", "uniqueness", "freshness"]
    measured = []
    for task, r in results.items():
        if "table" in r:
            scores = r["scores"]
            summary = json.dumps(scores["summary"], default=str) if scores else None
            measured.append(
                (task, r["table"], _source(task), r["rows_input"], r["rows_loaded"], r["rows_rejected"],
                 *[scores.get(d) for d in dimensions], scores.get("overall_score"), summary))
    if measured:
        columns = ", ".join(f"{d}_score double" for d in [*dimensions, "overall_quality"])
        new = spark.createDataFrame(
            measured, "task_id string, target_table string, data_source string, rows_input long, "
            f"rows_loaded long, rows_rejected long, {columns}, quality_details string")
        new = new.join(ids.withColumnRenamed("id", "etl_run_id"), "task_id")
        new = new.withColumn("execution_date", F.lit(date).cast("date"))
        lineage.append_log(
            spark, layout.table("etl_metrics"), "etl_metrics", new, lambda log: lineage.log_metrics(log, new, moment)
        )
    rows = [
        (r["table"], m["metric_name"], m["value"], m["dimension"])
        for r in results.values() if r.get("scores") for m in r["scores"]["metrics"]
    ]
    if rows:  # one per column and score of a feed
        history = spark.createDataFrame(rows, "target_table string, metric_name string, value double, dimension string")
        history = history.select("target_table", moment.alias("measured_at"), "metric_name", "value", "dimension")
        append_history(history, layout.table("metric_history"))


def run_day(
    spark: SparkSession, layout: Layout, date: str, run_at: datetime, strict: bool = False,
    tasks: list[str] | None = None,
) -> dict[str, dict]:
    """All tasks of a day, stations first; a failing feed does not stop the others.

    The run log is written before the first and after the last task, on its
    own, so that it outlives a load that failed.  The frames the logs are built
    from hold one row per task, nine at most.
    """
    todo = sorted(tasks or TASK_FEED, key=lambda task: TASK_FEED[task] != "stations")
    moment = F.lit(run_at).cast("timestamp_ntz")
    _start_log(spark, layout, todo, date, moment)
    results = {}
    for task in todo:
        try:
            results[task] = {"status": "success", **run_task(spark, layout, task, date, run_at, strict)}
        except Exception as error:  # recorded in the log, the other feeds go on
            results[task] = {"status": "failed", "rows_loaded": 0, "error": str(error)}
    ids = _end_log(spark, layout, results, date, moment)
    _log_files(spark, layout, results, moment)
    _log_metrics(spark, layout, results, ids, date, moment)
    return results


def run_gaps(
    spark: SparkSession, layout: Layout, bounds: DataFrame, run_at: datetime, source: str = "all",
    force: bool = False, strict: bool = False,
) -> dict[str, int]:
    """Run every task of the days in ``bounds`` that the run log lacks or holds as failed.

    The plan is stored first: each run adds to the run log.
    """
    plan = checkpointed(backfill.backfill_plan(run_log(spark, layout), bounds, source, force))

    def one(date, task: str) -> None:
        result = run_day(spark, layout, str(date), run_at, strict, [task])[task]
        if result["status"] == "failed":
            raise RuntimeError(result["error"])

    return backfill.run_backfill(plan, one)
