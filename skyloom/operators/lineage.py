"""Run log, file lineage and load metrics.

The three logs are append-only: a change appends the new states of the rows it
touches, and readers take the last state of each key.  Ids number the keys in
the order of their first append.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.clean import duration_seconds
from skyloom.operators.merge import number_rows, upsert
from skyloom.sources.sinks import append_rows, compact, current_rows

RUN_LOG_COLUMNS = (
    "id int, dag_id string, task_id string, execution_date date, start_time timestamp_ntz, "
    "end_time timestamp_ntz, status string, records_processed long, error_message string, "
    "duration_seconds int, created_at timestamp_ntz, updated_at timestamp_ntz"
)
LAKE_COLUMNS = (
    "id int, bucket_name string, object_path string, layer string, data_source string, "
    "record_count long, file_size_bytes long, status string, load_timestamp timestamp_ntz"
)
METRIC_COLUMNS = (
    "id int, etl_run_id int, execution_date date, target_table string, data_source string, "
    "rows_input long, rows_loaded long, rows_rejected long, completeness_score decimal(5,4), "
    "validity_score decimal(5,4), uniqueness_score decimal(5,4), freshness_score decimal(5,4), "
    "overall_quality_score decimal(5,4), quality_details string, measured_at timestamp_ntz"
)
RUN_KEY = ["dag_id", "task_id", "execution_date"]
_MEASURES = [
    "rows_input", "rows_loaded", "rows_rejected", "completeness_score", "validity_score",
    "uniqueness_score", "freshness_score", "overall_quality_score", "quality_details",
]


@dataclass(frozen=True)
class Log:
    """Columns (``id`` first) and key of an append-only log."""

    columns: str
    key: tuple[str, ...]

    @property
    def stored(self) -> str:
        return self.columns.removeprefix("id int, ")


LOGS = {
    "etl_run_log": Log(RUN_LOG_COLUMNS, tuple(RUN_KEY)),
    "lake_metadata": Log(LAKE_COLUMNS, ("object_path",)),
    "etl_metrics": Log(METRIC_COLUMNS, ("etl_run_id", "target_table")),
}


def read_log(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A log as a table: the last state of each key, with its id."""
    log = LOGS[name]
    rows = current_rows(spark, path, log.stored, log.key)
    numbered = number_rows(rows, ["_since", *log.key], "id")
    return numbered.select(F.col("id").cast("int").alias("id"), *[c for c in rows.columns if not c.startswith("_")])


def append_log(
    spark: SparkSession, path: str, name: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> None:
    """Append what ``change`` makes of the rows of the log that ``keys`` name, and of new ones.

    ``change`` gets them without ids.  Whoever else appends meanwhile keeps
    their rows; of two changes of one key the later one counts.
    """
    log = LOGS[name]
    wanted: Sequence[str] = [k for k in log.key if k in keys.columns]
    known = current_rows(spark, path, log.stored, log.key).drop("_run", "_since")
    append_rows(change(known.join(keys.select(*wanted).distinct(), wanted, "left_semi")), path)


def compact_log(spark: SparkSession, path: str, name: str) -> int:
    return compact(spark, path, LOGS[name].stored, LOGS[name].key)


def _ident(log: DataFrame) -> str | None:
    return "id" if "id" in log.columns else None


def start_runs(log: DataFrame, starts: DataFrame, as_of: Column) -> DataFrame:
    """The run log after ``starts`` (key and start_time) began.

    A run that starts again keeps its id and record count, and loses its end
    time and error message.
    """
    running, nothing = F.lit("running"), F.lit(None)
    return upsert(
        log, starts, RUN_KEY, ["start_time"],
        on_update={"status": running, "end_time": nothing, "error_message": nothing},
        on_insert={"status": running, "created_at": as_of, "updated_at": as_of},
        ident=_ident(log),
    )


def end_runs(log: DataFrame, ends: DataFrame, as_of: Column) -> DataFrame:
    """The run log after ``ends`` (id, or the run's key without ids; end_time, status,
    records_processed, error_message) finished; other runs stay as they are."""
    on = ["id"] if "id" in log.columns else RUN_KEY
    changed = ["end_time", "status", "records_processed", "error_message"]
    done = ends.select(*on, *[F.col(c).alias(f"_end_{c}") for c in changed], F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    new = {c: F.col(f"_end_{c}") for c in changed}
    new["duration_seconds"] = duration_seconds(F.col("start_time"), F.col("_end_end_time"))
    new["updated_at"] = as_of
    types = dict(log.dtypes)
    return log.join(done, on, "left").select(
        *[
            (F.when(hit, new[c]).otherwise(F.col(c)) if c in new else F.col(c)).cast(types[c]).alias(c)
            for c in log.columns
        ]
    )


def file_records(rows: DataFrame) -> DataFrame:
    """Per file of a scanned frame: ``object_path, record_count, file_size_bytes``."""
    return rows.groupBy(F.col("_metadata.file_path").alias("object_path")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max("_metadata.file_size").alias("file_size_bytes"),
    )


def log_files(lake: DataFrame, files: DataFrame, as_of: Column) -> DataFrame:
    """File lineage after ``files`` were written, keyed by path."""
    return upsert(
        lake, files, ["object_path"], ["record_count", "file_size_bytes", "status"],
        on_update={"load_timestamp": as_of},
        on_insert={"load_timestamp": as_of, "bucket_name": F.col("bucket_name"),
                   "layer": F.col("layer"), "data_source": F.col("data_source")},
        ident=_ident(lake),
    )


def log_metrics(metrics: DataFrame, measured: DataFrame, as_of: Column) -> DataFrame:
    """Load metrics after ``measured`` arrived, keyed by run and table."""
    return upsert(
        metrics, measured, ["etl_run_id", "target_table"], _MEASURES,
        on_update={"measured_at": as_of},
        on_insert={"measured_at": as_of, "execution_date": F.col("execution_date"),
                   "data_source": F.col("data_source")},
        ident=_ident(metrics),
    )
