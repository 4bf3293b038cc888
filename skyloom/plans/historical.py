"""Loading a folder that grows: only files that no load has seen are opened.

The ledger is the file lineage.  A file that was loaded stands there as
``loaded`` with its rows, none if it is empty; one that cannot be read stands
there as ``skipped`` and is tried again at the next load.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators import lineage
from skyloom.operators.partitions import MonthTable
from skyloom.plans.facts import FactSpec, load_fact
from skyloom.sources.lake import list_objects, read_table


def _below(path: Column, root: str) -> Column:
    """The path of a file below ``root``, whichever way its address is written."""
    name = root.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_extract(path, f"/{name}/(.*)$", 1)


def new_files(
    spark: SparkSession, root: str, prefix: str, ledger: DataFrame, modified_after: str | None = None
) -> DataFrame:
    """``path, object_path, file_size_bytes`` of the Parquet files below ``root/prefix`` that the ledger has not as loaded.

    ``modified_after`` (as Spark reads it) leaves out older files at once.
    """
    listing = list_objects(spark, root, prefix, ".parquet", modified_after)
    files = listing.select("path", _below(F.col("path"), root).alias("object_path"), F.col("length").alias("file_size_bytes"))
    loaded = ledger.filter("status = 'loaded'").select("object_path")
    return files.join(loaded, "object_path", "left_anti")


def empty_files(spark: SparkSession, root: str, files: dict[str, str], columns: str) -> set[str]:
    """Those of ``files`` (object path -> path) that can be read and hold no rows, from their footers.

    If a read fails, each half is tried alone, so that one bad file costs no
    more than a few reads.
    """
    if not files:
        return set()
    try:
        filled = lineage.file_records(read_table(spark, list(files.values()), columns))
        return set(files) - {r.name for r in filled.select(_below(F.col("object_path"), root).alias("name")).collect()}
    except (PySparkException, Py4JJavaError):
        names = sorted(files)
        halves = [names[: len(names) // 2], names[len(names) // 2 :]] if len(names) > 1 else []
        return {name for half in halves for name in empty_files(spark, root, {n: files[n] for n in half}, columns)}


def load_new_files(
    spark: SparkSession, root: str, prefix: str, columns: str, ledger_path: str,
    spec: FactSpec, dim: DataFrame, table: MonthTable, as_of: Column, order: list[str],
    source: str, run_date: Column | None = None, modified_after: str | None = None,
) -> dict:
    """Append the rows of new files to a fact table and note the files; returns the row accounting.

    ``files`` counts the new files and ``skipped`` lists those that cannot be read.
    The order of rows begins with the folder of their file.  The names of the new
    files, not of all, are held by the driver, as any read of files does.
    """
    ledger = lineage.read_log(spark, ledger_path, "lake_metadata")
    fresh = {r.path: r for r in new_files(spark, root, prefix, ledger, modified_after).collect()}
    if not fresh:
        return {"rows_input": 0, "rows_loaded": 0, "rows_rejected": 0, "outcomes": {}, "unknown": [], "files": 0, "skipped": []}
    rows = read_table(spark, sorted(fresh), columns, skip_bad_files=True)
    place = F.col("_metadata.file_path")
    seen = {r.object_path: r.record_count for r in lineage.file_records(rows).select(
        _below(F.col("object_path"), root).alias("object_path"), "record_count").collect()}
    # an empty file has nothing to be loaded; one that cannot be read is tried again
    silent = {r.object_path: r.path for r in fresh.values() if r.object_path not in seen}
    seen.update(dict.fromkeys(empty_files(spark, root, silent, columns), 0))
    placed = rows.withColumn("_folder", F.regexp_extract(place, "^(.*)/", 1))
    counts = load_fact(placed, spec, dim, table, as_of, ["_folder", *order], run_date)
    noted = spark.createDataFrame(
        [("silver", r.object_path, "silver", source, seen.get(r.object_path, 0), r.file_size_bytes,
          "loaded" if r.object_path in seen else "skipped") for r in fresh.values()],
        "bucket_name string, object_path string, layer string, data_source string, "
        "record_count long, file_size_bytes long, status string",
    )
    lineage.append_log(
        spark, ledger_path, "lake_metadata", noted, lambda log: lineage.log_files(log, noted, as_of)
    )
    skipped = sorted(r.object_path for r in fresh.values() if r.object_path not in seen)
    return {**counts, "files": len(fresh), "skipped": skipped}
