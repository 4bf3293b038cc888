"""Gap detection over the run log and the plan to fill the gaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed


def expected_runs(bounds: DataFrame, source: str = "all") -> DataFrame:
    """Every expected task of every day between ``first_day`` and ``last_day``.

    Days and tasks are exploded from arrays; no tables are paired.
    """
    if source != "all" and source not in fixed.BACKFILL_SOURCES:
        raise ValueError(f"unknown source {source!r}")
    tasks = F.array(*[F.lit(task) for task in fixed.EXPECTED_TASKS])
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("execution_date"))
    runs = days.select(
        "execution_date",
        F.lit(fixed.EXTRACTION_DAG).alias("dag_id"),
        F.explode(tasks).alias("task_id"),
    )
    return runs if source == "all" else runs.filter(F.col("task_id").like(f"%{source}%"))


def gaps(log: DataFrame, bounds: DataFrame, source: str = "all") -> DataFrame:
    """Expected runs that are missing or failed; a running one is no gap."""
    known = log.select("execution_date", "dag_id", "task_id", "status")
    joined = expected_runs(bounds, source).join(known, ["execution_date", "dag_id", "task_id"], "left")
    return joined.filter(F.col("status").isNull() | (F.col("status") == "failed")).select(
        F.col("execution_date").cast("string").alias("execution_date"),
        "dag_id",
        "task_id",
        F.coalesce("status", F.lit("missing")).alias("status"),
    )


def with_action(found: DataFrame, log: DataFrame, force: bool = False) -> DataFrame:
    """Gaps with ``action``: skip where the task already succeeded that day."""
    done = (
        log.filter(F.col("status") == "success")
        .select(F.col("execution_date").cast("string").alias("execution_date"), "task_id")
        .distinct()
        .withColumn("_done", F.lit(True))
    )
    skip = F.col("_done").isNotNull() & F.lit(not force)
    joined = found.join(done, ["execution_date", "task_id"], "left")
    return joined.withColumn("action", F.when(skip, "skip").otherwise("run")).drop("_done")


def to_do(found: DataFrame, log: DataFrame) -> DataFrame:
    """Gaps without a successful run of the same task and day.

    Many successful runs of one task and day become one row before the join.
    """
    done = (
        log.filter(F.col("status") == "success")
        .select(F.col("execution_date").cast("string").alias("execution_date"), "task_id")
        .distinct()
    )
    return found.join(done, ["execution_date", "task_id"], "left_anti")


def gaps_by_date(found: DataFrame) -> DataFrame:
    """One row per day with its sorted tasks; a day has eight tasks at most."""
    return found.groupBy("execution_date").agg(
        F.sort_array(F.collect_set("task_id")).alias("tasks")
    )


def stage_of(task: Column, stage: str) -> Column:
    """The transform or load step that belongs to an extraction task; the
    station inventory feeds a dimension and has no fact load."""
    step = F.replace(task, F.lit("extract_"), F.lit(f"{stage}_"))
    if stage == "load":
        return F.when(task != "extract_aemet_stations", step)
    return step


def with_steps(found: DataFrame) -> DataFrame:
    """Gaps with the transform and load steps that follow each extraction."""
    return found.select(
        "execution_date", "task_id", "status", "action",
        stage_of(F.col("task_id"), "transform").alias("transform_step"),
        stage_of(F.col("task_id"), "load").alias("load_step"),
    )


def backfill_plan(log: DataFrame, bounds: DataFrame, source: str = "all", force: bool = False) -> DataFrame:
    """What to run per gap: extraction task, then transform and load steps."""
    return with_steps(with_action(gaps(log, bounds, source), log, force))


def backfill_summary(results: DataFrame) -> DataFrame:
    """``success, failed, skipped`` of finished steps (column ``outcome``)."""
    return results.agg(
        *[F.count_if(F.col("outcome") == name).alias(name) for name in ("success", "failed", "skipped")]
    )


def run_backfill(plan: DataFrame, runner: Callable[[str, str], None]) -> dict[str, int]:
    """Run the plan day by day; a failing task does not stop the others.

    The driver loops over the plan (days times eight tasks), while ``runner``
    starts Spark jobs for one task of one day.
    """
    counts = {"success": 0, "failed": 0, "skipped": 0}
    for row in plan.orderBy("execution_date", "task_id").toLocalIterator():
        if row["action"] == "skip":
            counts["skipped"] += 1
            continue
        try:
            runner(row["execution_date"], row["task_id"])
            counts["success"] += 1
        except Exception:
            counts["failed"] += 1
    return counts
