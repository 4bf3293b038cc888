"""Windows, keyed deduplication and append-only tables: late rows, repeated deliveries, failures, several writers."""

from datetime import date, datetime
from threading import Thread

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from skyloom.operators import lineage
from skyloom.quality.checks import Suite
from skyloom.quality.metrics import append_history, read_history
from skyloom.sources import sinks
from skyloom.streaming import windows

COLUMNS = "ts timestamp_ntz, kind string, value double"
SUITE = Suite("s", required=("value",), ranges={"value": (0.0, 10.0)}, critical=("value",), threshold=0.9)


def deliver(spark, root, name, *rows):
    data = [(datetime(2026, 1, d, h), kind, value) for d, h, kind, value in rows]
    sinks.append_snapshot(spark.createDataFrame(data, COLUMNS).coalesce(1), f"{root}/in", name)


def measure(spark, root):
    rows = windows.table_stream(spark, f"{root}/in", COLUMNS, 1)
    metrics = windows.window_metrics(rows, SUITE, "ts", "1 day", "1 day", F.col("kind"), ["value"])
    query = windows.store_stream(metrics, f"{root}/history", f"{root}/mark", "s")
    query.awaitTermination()
    return query.recentProgress


def found(spark, root):
    return {(r.target_table, r.measured_at.day, r.metric_name): r.value for r in read_history(spark, f"{root}/history").collect()}


def test_windows_once_and_late_rows_left_out(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, root, "a", (1, 1, "x", 1.0), (1, 2, "x", None), (1, 3, "y", 99.0))
    measure(spark, root)
    assert found(spark, root) == {}  # the first day may still grow
    deliver(spark, root, "b", (1, 23, "x", 2.0), (3, 1, "x", 1.0))
    measure(spark, root)
    day = {k: v for k, v in found(spark, root).items() if k[1] == 2}
    assert day == {
        ("x", 2, "row_count"): 3.0, ("x", 2, "completeness_value"): 2 / 3, ("x", 2, "validity_score"): 2 / 3,
        ("y", 2, "row_count"): 1.0, ("y", 2, "completeness_value"): 1.0, ("y", 2, "validity_score"): 2 / 3,
    }
    deliver(spark, root, "c", (1, 5, "x", 7.0), (5, 0, "x", 1.0))  # the first row is late
    progress = measure(spark, root)
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) == 1
    assert found(spark, root)[("x", 2, "row_count")] == 3.0 and found(spark, root)[("x", 4, "row_count")] == 1.0
    assert read_history(spark, f"{root}/history").count() == 9


def test_windows_of_a_table_are_all_there(spark, tmp_path):
    deliver(spark, str(tmp_path), "a", (1, 1, "x", 1.0), (2, 1, "x", 1.0))
    rows = spark.read.parquet(f"{tmp_path}/in/a")
    out = windows.window_metrics(rows, SUITE, "ts", "1 day", "1 day", F.lit("t"), ["value"])
    assert out.filter("metric_name = 'row_count'").count() == 2
    assert windows.window_metrics(rows.filter("false"), SUITE, "ts", "1 day", "1 day", F.lit("t")).count() == 0


def test_a_replayed_batch_is_stored_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    deliver(spark, root, "a", (1, 1, "x", 1.0), (9, 1, "x", 1.0))
    real, calls = windows.append_once, []

    def failing(rows, path, name):
        real(rows, path, name)
        calls.append(name)
        if len(calls) == 2:  # the batch that brings the window out
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(windows, "append_once", failing)
    with pytest.raises(StreamingQueryException):
        measure(spark, root)
    measure(spark, root)
    assert calls[1] == calls[2]
    assert read_history(spark, f"{root}/history").count() == 3


def test_named_history_rows_are_added_once(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.sql("select 't' target_table, timestamp_ntz'2026-01-01' measured_at, 'm' metric_name, 1.0D value, 'd' dimension")
    append_history(rows, path)
    for _ in range(2):
        append_history(rows, path, once="run-1")
    assert read_history(spark, path).count() == 2


def test_one_key_in_two_batches_gives_one_row_and_state_shrinks(spark, tmp_path):
    root = str(tmp_path)

    def run():
        rows = windows.table_stream(spark, f"{root}/in", COLUMNS, 1)
        query = windows.store_stream(windows.first_arrivals(rows, ["kind"], "ts", "2 days"), f"{root}/out", f"{root}/mark", "s")
        query.awaitTermination()
        return [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]

    deliver(spark, root, "a", (1, 1, "x", 1.0), (1, 1, "x", 2.0), (1, 2, "y", 1.0))
    run()
    deliver(spark, root, "b", (2, 1, "x", 3.0), (2, 2, "z", 1.0))
    assert max(run()) == 3
    stored = spark.read.schema(COLUMNS).option("recursiveFileLookup", "true").parquet(f"{root}/out")
    assert sorted(r.kind for r in stored.collect()) == ["x", "y", "z"]
    deliver(spark, root, "c", (20, 1, "w", 1.0))
    assert run()[-1] == 1  # only the newest key is remembered


# --- append-only tables


def starts(spark, *tasks):
    rows = [("d", t, date(2026, 1, 1), datetime(2026, 1, 1, 6)) for t in tasks]
    return spark.createDataFrame(rows, "dag_id string, task_id string, execution_date date, start_time timestamp_ntz")


def begin(spark, path, *tasks):
    keys = starts(spark, *tasks)
    lineage.append_log(spark, path, "etl_run_log", keys, lambda log: lineage.start_runs(log, keys, F.lit("2026-01-01").cast("timestamp_ntz")))


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    path, log = str(tmp_path / "log"), lineage.LOGS["etl_run_log"]
    moment = F.lit("2026-01-01").cast("timestamp_ntz")
    begin(spark, path, "a")
    # both read the log before either of them writes
    base = [lineage.read_log(spark, path, "etl_run_log").cache() for _ in range(2)]
    assert [b.count() for b in base] == [1, 1]
    for seen, tasks in zip(base, (("a", "b"), ("c",))):
        keys = starts(spark, *tasks)
        changed = lineage.start_runs(seen, keys, moment).join(keys, list(log.key), "left_semi")
        sinks.append_rows(changed.drop("id"), path)
    rows = {r.task_id: r.id for r in lineage.read_log(spark, path, "etl_run_log").collect()}
    assert rows == {"a": 1, "b": 2, "c": 3}
    workers = [Thread(target=begin, args=(spark, path, f"t{i}")) for i in range(4)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    rows = {r.task_id: r.id for r in lineage.read_log(spark, path, "etl_run_log").collect()}
    assert len(rows) == 7 and sorted(rows.values()) == list(range(1, 8)) and rows["a"] == 1


def test_last_state_counts_and_compaction_changes_nothing(spark, tmp_path):
    path, columns = str(tmp_path / "t"), "k string, v int, w string"
    assert sinks.current_rows(spark, path, columns, ["k"]).count() == 0 and sinks.compact(spark, path, columns, ["k"]) == 0
    for rows in ([("a", 1, "x"), (None, 5, "n")], [("a", None, "y"), ("b", 2, None)], [("c", 3, "z")]):
        sinks.append_rows(spark.createDataFrame(rows, columns).coalesce(1), path)

    def current():
        return sorted(map(str, sinks.current_rows(spark, path, columns, ["k"]).collect()))

    before = current()
    assert len(before) == 4 and any("v=None, w='y'" in r for r in before)
    assert sinks.compact(spark, path, columns, ["k"]) == 3 and current() == before
    assert sinks.compact(spark, path, columns, ["k"]) == 0
    # an append of an older writer that comes after the compaction
    late = spark.createDataFrame([("a", 7, "old", "0", "0")], f"{columns}, _run string, _since string")
    late.write.parquet(f"{path}/at=0")
    assert {r.k: r.w for r in sinks.current_rows(spark, path, columns, ["k"]).collect()}["a"] == "y"
