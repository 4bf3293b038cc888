"""Scores, reports and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import fixed_values as fixed
from skyloom.functions.clean import iso_to_ts, normalise_nan
from skyloom.operators.dedupe import distinct_keys
from skyloom.operators.lookup import dim_join
from skyloom.quality.checks import Suite, counters, expectations, present, profile, summary
from skyloom.quality.errors import QualityError
from skyloom.session import checkpointed
from skyloom.sources.lake import folders_matching, remove_folder
from skyloom.sources.sinks import append_once


def completeness_scores(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, score`` for each column; no rows for an empty table."""
    chosen = [c for c in (columns or df.columns) if c in df.columns]
    wanted = {"row_count": F.count(F.lit(1)), **{f"n:{c}": present(c) for c in chosen}}
    row = profile(normalise_nan(df), wanted).filter("row_count > 0")
    scores = [F.struct(F.lit(c).alias("column"), (F.col(f"`n:{c}`") / F.col("row_count")).alias("score"))
              for c in chosen]
    return row.select(F.inline(F.array(*scores)))


def uniqueness_score(df: DataFrame, key: list[str]) -> DataFrame:
    """``row_count, distinct_keys, uniqueness``.

    The total is a scan without shuffle; the distinct count shuffles key
    columns only, already reduced on the map side.
    """
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    if any(c not in df.columns for c in key):
        score = F.when(F.col("row_count") == 0, 1.0).otherwise(0.0)
        return rows.select("row_count", F.lit(0).cast("long").alias("distinct_keys"),
                           score.alias("uniqueness"))
    rows = rows.withColumn("distinct_keys", distinct_keys(df, key).scalar())
    score = F.when(F.col("row_count") > 0, F.col("distinct_keys") / F.col("row_count")).otherwise(1.0)
    return rows.withColumn("uniqueness", score)


def _latest(df: DataFrame, column: str) -> dict[str, Column]:
    """Counters for freshness: newest moment and unreadable values."""
    moment = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.StringType):
        parsed = iso_to_ts(moment)
        return {"latest": F.max(parsed),
                "unreadable": F.count_if(moment.isNotNull() & parsed.isNull())}
    return {"latest": F.max(moment.cast("timestamp_ntz")), "unreadable": F.count_if(F.lit(False))}


def _freshness(as_of: Column, max_age_hours: float) -> Column:
    age = F.timestamp_diff("MICROSECOND", F.col("latest"), as_of) / F.lit(3.6e9)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - age / max_age_hours))
    return F.when(F.col("latest").isNull() | (F.col("unreadable") > 0), 0.0).otherwise(score)


def freshness_score(df: DataFrame, column: str, as_of: Column, max_age_hours: float = 24.0) -> DataFrame:
    """``freshness``: 1 for data as new as ``as_of``, 0 at the maximal age; 0 for
    an empty table, a missing column or unreadable moments."""
    if column not in df.columns:
        return df.agg(F.lit(0.0).alias("freshness"))
    row = profile(df, _latest(df, column))
    return row.select(_freshness(as_of, max_age_hours).alias("freshness"))


def freshness_by(
    df: DataFrame, by: list[str], column: str, as_of: Column, max_age_hours: float = 24.0
) -> DataFrame:
    """``freshness`` of every group, in one grouping of one scan."""
    latest = {name: value.alias(name) for name, value in _latest(df, column).items()}
    groups = df.groupBy(*by).agg(*latest.values())
    return groups.select(*by, _freshness(as_of, max_age_hours).alias("freshness"))


def range_conformity(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """``conformity``: share of present values inside the bounds."""
    if column not in df.columns:
        return df.agg(F.lit(0.0).alias("conformity"))
    value = F.col(f"`{column}`")
    row = normalise_nan(df).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("valid"),
        F.count_if(value.between(low, high)).alias("inside"),
    )
    score = (
        F.when(F.col("n") == 0, 0.0).when(F.col("valid") == 0, 1.0)
        .otherwise(F.col("inside") / F.col("valid"))
    )
    return row.select(score.alias("conformity"))


# -- report -----------------------------------------------------------------


def quality_report(
    df: DataFrame,
    suite: Suite,
    table: str,
    as_of: Column,
    key: list[str] | None = None,
    moment: str | None = None,
    weights: dict[str, float] | None = None,
    max_age_hours: float = 24.0,
) -> DataFrame:
    """One row: dimension scores, overall score, summary, metrics, advice.

    Two passes at most: one aggregation for every counter, and one over the key
    columns when uniqueness is asked for.
    """
    weights = weights or fixed.SCORE_WEIGHTS
    clean = normalise_nan(df)
    wanted = counters(clean, suite)
    wanted.update({f"n:{c}": present(c) for c in df.columns})
    if moment:
        wanted.update(_latest(clean, moment))
    row = profile(clean, wanted)

    scores = F.array(
        *[F.struct(F.lit(c).alias("column"), F.try_divide(F.col(f"`n:{c}`"), F.col("row_count")).alias("score"))
          for c in df.columns]
    )
    scores = F.when(F.col("row_count") > 0, scores).otherwise(F.slice(scores, 1, 0))
    checks = F.array(*expectations(clean, suite))
    row = row.withColumns({"scores": scores, "checks": checks})
    passed = F.size(F.filter("checks", lambda e: e["success"]))
    total = F.aggregate("scores", F.lit(0.0), lambda acc, s: acc + s["score"])
    dimensions = {
        "completeness": F.when(F.size("scores") > 0, total / F.size("scores")).otherwise(0.0),
        "validity": passed / F.size("checks"),
    }
    if key:
        if all(c in df.columns for c in key):
            row = row.withColumn("distinct_keys", distinct_keys(clean, key).scalar())
            share = F.col("distinct_keys") / F.col("row_count")
        else:
            share = F.lit(0.0)
        dimensions["uniqueness"] = F.when(F.col("row_count") > 0, share).otherwise(1.0)
    if moment:
        dimensions["freshness"] = _freshness(as_of, max_age_hours)
    row = row.withColumns(dimensions)

    weight = {name: weights.get(name, fixed.OTHER_WEIGHT) for name in dimensions}
    weighted, mean = F.lit(0.0), F.lit(0.0)
    for name in dimensions:
        weighted = weighted + F.col(name) * weight[name]
        mean = mean + F.col(name)
    row = row.withColumns(
        {"overall_score": weighted / sum(weight.values()), "mean_score": mean / len(dimensions)}
    )

    metric = [
        F.struct(F.lit(f"{name}_score").alias("metric_name"), F.col(name).alias("value"),
                 F.lit(name).alias("dimension"))
        for name in dimensions if name != "completeness"
    ]
    per_column = F.transform(
        "scores",
        lambda s: F.struct(F.concat(F.lit("completeness_"), s["column"]).alias("metric_name"),
                           s["score"].alias("value"), F.lit("completeness").alias("dimension")),
    )
    row = row.withColumn("summary", summary(F.col("checks"), suite, len(df.columns)))
    return row.select(
        F.concat(F.lit(f"{table}_"), F.date_format(as_of, "yyyyMMdd_HHmmss")).alias("report_id"),
        F.lit(table).alias("target_table"),
        as_of.alias("generated_at"),
        *dimensions,
        "overall_score",
        "scores",
        F.concat(per_column, F.array(*metric)).alias("metrics"),
        _advice(list(dimensions)).alias("recommendations"),
        "summary",
    )


def gate_report(
    df: DataFrame, suite: Suite, table: str, as_of: Column, strict: bool = False
) -> dict:
    """Report a feed before its load; under ``strict`` a failed check raises.

    The key is city and time where the feed has them, else city and date.
    """
    key = ["city_name", "time"] if "city_name" in df.columns else ["city", "date"]
    moment = "time" if "time" in df.columns else None
    report = quality_report(df, suite, table, as_of, key, moment)
    result = report.first().asDict(recursive=True)
    if strict and not result["summary"]["success"]:
        raise QualityError(f"validation failed for {table}", result["summary"])
    return result


def _advice(dimensions: list[str]) -> Column:
    low = F.transform(F.filter("scores", lambda s: s["score"] < 0.9), lambda s: s["column"])
    failed = F.filter("checks", lambda e: ~e["success"])
    kinds = F.array_distinct(F.transform(F.slice(failed, 1, 3), lambda e: e["expectation_type"]))
    rules = [
        F.when(
            (F.col("completeness") < 0.9) & (F.size(low) > 0),
            F.concat(F.lit(fixed.ADVICE["completeness"]), F.array_join(F.slice(low, 1, 5), ", ")),
        ),
        F.when(
            (F.col("validity") < 0.95) & (F.size(failed) > 0),
            F.concat(F.lit(fixed.ADVICE["validity"]), F.array_join(kinds, ", ")),
        ),
    ]
    if "uniqueness" in dimensions:
        rules.append(F.when(F.col("uniqueness") < 1.0, F.lit(fixed.ADVICE["uniqueness"])))
    if "freshness" in dimensions:
        rules.append(F.when(F.col("freshness") < 0.5, F.lit(fixed.ADVICE["freshness"])))
    rules.append(F.when(F.col("mean_score") < 0.8, F.lit(fixed.ADVICE["overall"])))
    return F.filter(F.array(*rules), lambda text: text.isNotNull())


def report_metrics(report: DataFrame) -> DataFrame:
    """The metric rows of reports, ready to append to a metric history."""
    return report.select(
        "target_table", F.col("generated_at").alias("measured_at"), F.inline("metrics")
    ).select("target_table", "measured_at", "metric_name", "value", "dimension")


def report_json(report: DataFrame) -> DataFrame:
    return report.select("report_id", F.to_json(F.struct(*report.columns)).alias("report"))


# -- history ----------------------------------------------------------------


def append_history(rows: DataFrame, path: str, once: str | None = None) -> None:
    """Add the metric rows of a run to the history.

    Rows given under a name (``once``) are added once, however often that is repeated.
    """
    if once is None:
        rows.write.mode("append").parquet(path)
    else:
        append_once(rows, path, once)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The stored history; empty before the first run."""
    folders = folders_matching(spark, path)
    schema = "target_table string, measured_at timestamp_ntz, metric_name string, value double, dimension string"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def clear_history(spark: SparkSession, path: str) -> None:
    remove_folder(spark, path)


def metrics_summary(
    history: DataFrame, table: str | None = None, dimension: str | None = None
) -> DataFrame:
    """Metric rows of one table and one dimension; no filter where not given."""
    if table:
        history = history.filter(F.col("target_table") == table)
    if dimension:
        history = history.filter(F.col("dimension") == dimension)
    return history


def metric_anomalies(history: DataFrame, threshold: float = 2.0, min_points: int = 5) -> DataFrame:
    """Metric rows further than ``threshold`` standard deviations from the mean
    of their own series; short and constant series have none.

    Series statistics are combined on the map side and joined back, so a long
    series is never gathered in one task.
    """
    series = F.struct("target_table", "metric_name")  # a null part is a value of its own
    marked = history.withColumn("_series", series)
    stats = marked.groupBy("_series").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.count(F.lit(1)).alias("points"),
    ).filter((F.col("points") >= min_points) & (F.col("std") > 0))
    joined = dim_join(marked, checkpointed(stats), "_series", "_series", {"mean": "mean", "std": "std"}, how="inner")
    z = F.abs(F.col("value") - F.col("mean")) / F.col("std")
    return joined.withColumn("z_score", z).filter(F.col("z_score") > threshold).drop(
        "_series", "mean", "std"
    )
