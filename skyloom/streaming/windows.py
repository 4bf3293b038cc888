"""Quality per event-time window, and keyed deduplication, while rows arrive.

Both keep state only as long as the watermark has not passed it: the largest
moment seen so far less ``delay``.  Rows older than that are late and left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyloom.functions.clean import iso_to_ts, normalise_nan
from skyloom.quality.checks import Suite, counters, expectations, present
from skyloom.sources.sinks import append_once


def table_stream(
    spark: SparkSession, path: str, columns: str, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files below ``path``, oldest first, ``files_per_batch`` at a time."""
    reader = spark.readStream.schema(columns).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _with_moment(rows: DataFrame, moment: str) -> DataFrame:
    """Text and naive moments as instants, which watermarks are made of, whatever zone the session has."""
    value = F.col(f"`{moment}`")
    kind = dict(rows.dtypes)[moment]
    if kind == "timestamp":
        return rows
    naive = iso_to_ts(value) if kind == "string" else value.cast("timestamp_ntz")
    return rows.withColumn(moment, F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), naive)))


def window_metrics(
    rows: DataFrame, suite: Suite, moment: str, width: str, delay: str,
    table: Column, columns: Sequence[str] | None = None,
) -> DataFrame:
    """Metric rows of every tumbling window of ``moment``: row count, completeness
    per column, and the share of the suite's checks that pass.

    ``table`` names the series and may depend on the row.  A window is measured
    at its end and returned once, when the watermark has passed it; rows without
    moment belong to none.  The shape is that of the metric history.  Works on a
    table too, which has no late rows and returns every window.
    """
    chosen = [c for c in (columns or rows.columns) if c != moment]
    clean = _with_moment(normalise_nan(rows), moment)
    wanted = {**counters(clean, suite), **{f"n:{c}": present(c) for c in chosen}}
    if rows.isStreaming:
        clean = clean.withWatermark(moment, delay)
    groups = clean.groupBy(F.window(moment, width).alias("_window"), table.alias("target_table")).agg(
        *[value.alias(name) for name, value in wanted.items()]
    )
    checks = expectations(rows, suite)
    passed = sum((c["success"].cast("int") for c in checks), F.lit(0))

    def metric(name: str, value: Column, dimension: str) -> Column:
        return F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("value"),
                        F.lit(dimension).alias("dimension"))

    metrics = [
        metric("row_count", F.col("row_count"), "volume"),
        *[metric(f"completeness_{c}", F.col(f"`n:{c}`") / F.col("row_count"), "completeness") for c in chosen],
        metric("validity_score", passed / len(checks), "validity"),
    ]
    return groups.select("target_table", F.timestamp_add("MICROSECOND", F.unix_micros("_window.end"), _epoch()).alias("measured_at"), F.inline(F.array(*metrics)))


def store_stream(rows: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """Append what arrived or finished since the last call to a table, then stop.

    A batch that is replayed after a failure replaces what it wrote before, so
    each row stands in the table once.  ``name`` tells the streams that write to
    one table apart.  A metric history is such a table.
    """

    def store(batch: DataFrame, number: int) -> None:
        append_once(batch, path, f"{name}-{number}")

    return (
        rows.writeStream.outputMode("append").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def first_arrivals(rows: DataFrame, key: Sequence[str], moment: str, delay: str) -> DataFrame:
    """Rows whose ``key`` has not arrived before, however many batches ago.

    A key is remembered until the watermark passes ``delay`` after the row that
    brought it, so ``delay`` is to cover the time between repeated deliveries.
    """
    named = rows.withColumn("_moment", F.col(f"`{moment}`"))
    marked = _with_moment(named, "_moment").withWatermark("_moment", delay)
    return marked.dropDuplicatesWithinWatermark(list(key)).drop("_moment")
