"""Writing the lake and the warehouse."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyloom.session import scratch_root
from skyloom.sources.lake import folders_matching, list_objects, remove_folder


def _bytes_below(spark: SparkSession, path: str) -> int:
    return list_objects(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def write_json(docs: DataFrame, path: str, text: str = "text") -> int:
    """Document text, one per line; returns the bytes written."""
    docs.select(F.col(text).alias("value")).write.mode("overwrite").text(path)
    return _bytes_below(docs.sparkSession, path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> dict:
    """Parquet; returns rows (counted while writing) and bytes below the path."""
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return {"rows": rows.get["rows"], "bytes": _bytes_below(df.sparkSession, path)}


def overwrite_dates(df: DataFrame, root: str, date_column: str = "date") -> None:
    """Replace only the dates present in ``df``; other dates stay."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(root)
    )


def append_snapshot(df: DataFrame, root: str, path: str) -> dict:
    """A new snapshot under its own time-stamped name; never replaces another."""
    return write_table(df, f"{root.rstrip('/')}/{path}", mode="errorifexists")


# -- append-only tables -----------------------------------------------------


def append_once(df: DataFrame, root: str, name: str) -> None:
    """Rows below a folder of their own; a repeated write replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/once={name}")


def append_rows(df: DataFrame, root: str) -> None:
    """New states of rows, stamped with the moment of writing; nothing is read or replaced.

    Writers do not wait for each other and none can lose the rows of another.
    """
    stamp = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    stamps = {"_run": F.lit(stamp), "_since": F.lit(stamp)}
    df.withColumns(stamps).write.parquet(f"{root.rstrip('/')}/at={stamp}")


def current_rows(spark: SparkSession, root: str, columns: str, key: Sequence[str]) -> DataFrame:
    """The last state of each key, with the stamps of its last and its first append (``_run``, ``_since``).

    States meet in one grouping, reduced before the shuffle; a table that was
    never written is empty.
    """
    schema = f"{columns}, _run string, _since string"
    if not folders_matching(spark, root):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    rest = [F.col(c) for c in rows.columns if c not in (*key, "_since")]
    last = rows.groupBy(*key).agg(
        F.max_by(F.struct(*rest), "_run").alias("_last"), F.min("_since").alias("_since")
    )
    return last.select(*key, "_last.*", "_since").select(*rows.columns)


def compact(spark: SparkSession, root: str, columns: str, key: Sequence[str]) -> int:
    """Replace all appends so far by the last state of each key; returns the folders removed.

    The states keep their stamps, so an append that comes later still finds its
    place, and a run that dies before the old folders are gone leaves only
    repeated states.  Run it while nobody reads.
    """
    old = folders_matching(spark, f"{root.rstrip('/')}/at=*")
    if len(old) > 1:
        stamp = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        current_rows(spark, root, columns, key).write.parquet(f"{root.rstrip('/')}/at={stamp}")
        for folder in old:
            remove_folder(spark, folder)
        return len(old)
    return 0


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; call it when no result is read any more."""
    remove_folder(spark, scratch_root(spark))
