"""Documents to fact rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyloom.operators.flatten import FEEDS, explode_columnar
from skyloom.operators.partitions import MonthTable
from skyloom.plans.facts import FACTS, load_fact
from skyloom.streaming.windows import first_arrivals


def document_stream(
    spark: SparkSession, path: str, per_line: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """New document files below ``path`` as ``path, text``, ``files_per_batch`` at a time."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", str(not per_line).lower())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def load_new_documents(
    docs: DataFrame, feed: str, dim: DataFrame, table: MonthTable, checkpoint: str, as_of: Column,
    delay: str | None = None, on_loaded: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Load everything that arrived since the last call, then stop.

    Each batch goes through the same load as a daily run.  Its documents are dealt
    to ``spark.sql.shuffle.partitions`` tasks before they are parsed, since a batch
    may be a few files that do not split.  A batch that is
    replayed after a failure inserts nothing twice, because a row is only
    inserted where its key is absent.  With ``delay``, rows delivered again
    within that time are dropped before the load, from a state that keeps only
    the keys of that time.  ``on_loaded`` gets the number and the row accounting
    of each batch after its rows were appended and before it counts as done.
    """
    spec = FACTS[feed]
    dealt = docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = explode_columnar(dealt, FEEDS[feed])
    if delay:
        rows = first_arrivals(rows, [spec.entity_from, spec.moment_from, spec.run_date], spec.moment_from, delay)

    def load(batch: DataFrame, number: int) -> None:
        counts = load_fact(batch, spec, dim, table, as_of, ["_src", "_pos"])
        if on_loaded:
            on_loaded(number, counts)

    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
