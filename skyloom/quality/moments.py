"""Moments of metric series that can be merged, so that anomalies need no full history.

Count, mean and sum of squared deviations are kept per series and day.  Those of
days, or of parts of a day that arrive later, add up to those of the whole
series, whatever the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.lookup import dim_join
from skyloom.session import checkpointed
from skyloom.sources.lake import folders_matching
from skyloom.sources.sinks import append_once

SERIES = ("target_table", "metric_name")
MOMENTS = "target_table string, metric_name string, day date, points long, present long, mean double, spread double"


def _merged(by: list[Column | str], parts: DataFrame) -> DataFrame:
    """``parts`` (points, present, mean, spread) added up within each group.

    The mean of a group is needed before deviations from it can be added, so the
    parts meet twice; they are far fewer than the values behind them.
    """
    weighted = F.sum(F.col("mean") * F.col("present")) / F.nullif(F.sum("present"), F.lit(0))
    group = F.struct(*by)
    keyed = parts.withColumn("_group", group)
    centre = keyed.groupBy("_group").agg(weighted.alias("_centre"))
    moved = F.col("spread") + F.col("present") * (F.col("mean") - F.col("_centre")) * (F.col("mean") - F.col("_centre"))
    placed = dim_join(keyed, checkpointed(centre), "_group", "_group", {"_centre": "_centre"}, how="inner")
    return placed.groupBy("_group").agg(
        F.sum("points").alias("points"), F.sum("present").alias("present"),
        F.first("_centre").alias("mean"), F.sum(moved).alias("spread"),
    ).select("_group.*", "points", "present", "mean", "spread")


def day_moments(history: DataFrame) -> DataFrame:
    """The moments of metric rows, per series and day."""
    present = F.count("value")
    return history.groupBy(*SERIES, F.col("measured_at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("points"), present.alias("present"), F.avg("value").alias("mean"),
        (F.var_pop("value") * present).alias("spread"),
    ).na.fill(0.0, ["mean", "spread"])


def add_moments(history: DataFrame, path: str, name: str) -> None:
    """Add the moments of new metric rows to the state, once for each ``name``."""
    append_once(day_moments(history), path, name)


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    """The state, one row per series, day and addition; empty before the first."""
    if not folders_matching(spark, path):
        return spark.createDataFrame([], MOMENTS)
    return spark.read.schema(MOMENTS).option("recursiveFileLookup", "true").parquet(path)


def by_day(state: DataFrame) -> DataFrame:
    """One row per series and day, for a state to be stored anew."""
    return _merged([*SERIES, "day"], state)


def anomalies_of(
    rows: DataFrame, state: DataFrame, threshold: float = 2.0, min_points: int = 5
) -> DataFrame:
    """The rows among ``rows`` further than ``threshold`` standard deviations from the mean of their series.

    The series is what ``state`` holds, these rows included; no older row is read.
    The result is that of a scan of the whole history, for these rows.
    """
    series = F.struct(*SERIES)
    stats = _merged([*SERIES], state).select(
        series.alias("_series"), "points", "mean", F.sqrt(F.col("spread") / F.col("present")).alias("std")
    ).filter((F.col("points") >= min_points) & (F.col("std") > 0))
    joined = dim_join(
        rows.withColumn("_series", series), checkpointed(stats), "_series", "_series",
        {"mean": "mean", "std": "std"}, how="inner",
    )
    z = F.abs(F.col("value") - F.col("mean")) / F.col("std")
    return joined.withColumn("z_score", z).filter(F.col("z_score") > threshold).drop("_series", "mean", "std")
