"""Reading the lake: documents, tables, listings, snapshots and path layouts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.fixed_values import CITY_CSV_COLUMNS
from skyloom.functions.clean import run_stamp
from skyloom.operators.lookup import dim_join
from skyloom.session import checkpointed

# One pattern per placeholder, so that underscores inside a city name or a run
# stamp do not shift the other parts.
_PLACEHOLDERS = {
    "date": r"\d{4}-\d{2}-\d{2}",
    "start": r"\d{4}-\d{2}-\d{2}",
    "end": r"\d{4}-\d{2}-\d{2}",
    "timestamp": r"\d{8}_\d{6}",
    "year": r"\d{4}",
    "station": r"[^/_]+",
    "city": r"[^/]+",
}


# -- documents and tables ---------------------------------------------------


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], per_line: bool = False, glob: str = "*.json"
) -> DataFrame:
    """JSON documents as ``path, text``: one per file, or one per line.

    The text stays unparsed, so a broken document costs its own row only.
    """
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("ignoreCorruptFiles", "true")
    )
    rows = reader.text(paths if isinstance(paths, str) else list(paths), wholetext=not per_line)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_json(
    spark: SparkSession, paths: str | Sequence[str], schema: str, multi_line: bool = True
) -> DataFrame:
    """JSON files straight into ``schema``; unreadable text lands in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, _corrupt_record string")
        .option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "true")
        .json(paths if isinstance(paths, str) else list(paths))
    )


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: str | None = None,
    skip_bad_files: bool = False,
) -> DataFrame:
    """Parquet file, folder or list of either, as one frame.

    ``skip_bad_files`` is the historical load: an unreadable file is left out
    and the others are read.  It wants ``columns``, because the file that would
    be sampled for a schema may be the unreadable one.
    """
    many = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("ignoreCorruptFiles", str(skip_bad_files).lower())
    return (reader.schema(columns) if columns else reader).parquet(*many)


def read_city_csv(spark: SparkSession, path: str) -> DataFrame:
    """The cities file with its required columns; codes keep leading zeros."""
    raw = spark.read.option("header", "true").csv(path)
    missing = [name for name in CITY_CSV_COLUMNS if name not in raw.columns]
    if missing:
        raise ValueError(f"cities file lacks columns {missing}, found {raw.columns}")
    return raw.select(
        "city_code",
        "city_name",
        F.col("latitud").cast("double").alias("latitud"),
        F.col("longitud").cast("double").alias("longitud"),
        "country_code",
        F.col("is_coastal").cast("int").alias("is_coastal"),
    )


# -- listings and snapshots -------------------------------------------------


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", suffix: str = "", modified_after: str | None = None
) -> DataFrame:
    """Files below ``root/prefix`` whose name ends in ``suffix``: ``path, length``.

    With ``modified_after`` only files written later.  A prefix that does not
    exist is an empty listing.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
    )
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    try:
        listing = reader.load(f"{root.rstrip('/')}/{prefix}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long")
    return listing.select("path", "length")


def latest_file(spark: SparkSession, root: str, prefix: str, suffix: str = ".parquet") -> str | None:
    """The last file name under a prefix; only that one name reaches the driver."""
    return list_objects(spark, root, prefix, suffix).agg(F.max("path")).first()[0]


def finished_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a glob whose write finished, in name order.

    Spark marks a finished folder with an empty ``_SUCCESS`` file, which its
    own readers hide, so the file system is asked directly.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    marker = hadoop.Path(f"{pattern.rstrip('/')}/_SUCCESS")
    found = marker.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marker)
    return sorted(status.getPath().getParent().toString() for status in found or [])


def folders_matching(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a glob, whether their write finished or not, in name order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern.rstrip("/"))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def latest_snapshot(rows: DataFrame, prefix: str = "prefix", path: str = "path") -> DataFrame:
    """Rows of the last snapshot path of each prefix."""
    newest = checkpointed(rows.groupBy(prefix).agg(F.max(path).alias("newest")))
    joined = dim_join(rows, newest, prefix, prefix, {"newest": "_newest"}, how="inner")
    return joined.filter(F.col(path) == F.col("_newest")).drop("_newest")


def documents_or_prefix(
    spark: SparkSession, handed_over: Sequence[str] | None, root: str, prefix: str
) -> DataFrame:
    """Documents named by the previous stage, or everything under the prefix."""
    if handed_over:
        return read_documents(spark, [f"{root.rstrip('/')}/{path}" for path in handed_over])
    return read_documents(spark, f"{root.rstrip('/')}/{prefix}")


def document_files(
    spark: SparkSession, handed_over: Sequence[str] | None, root: str, prefix: str, glob: str = "*.json"
) -> DataFrame:
    """``path, length`` of the files ``documents_or_prefix`` means to read, from the listing alone.

    Spark gives each few small files a task, which for names alone is too many.
    """
    names = list(handed_over) if handed_over else [prefix]
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load([f"{root.rstrip('/')}/{name}" for name in names])
    )
    return listing.select(F.col("_metadata.file_path").alias("path"), "length").coalesce(
        2 * spark.sparkContext.defaultParallelism
    )


# -- path layouts -----------------------------------------------------------


def render_path(template: str, **parts: Column) -> Column:
    """A path layout filled from columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    columns = [F.lit(p) if i % 2 == 0 else parts[p] for i, p in enumerate(pieces) if p]
    return F.concat(*columns)


def parse_path(path: Column, template: str) -> dict[str, Column]:
    """The placeholder values of a path, null where the path has another layout."""
    pattern, groups = "", []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            pattern += re.escape(piece)
        elif piece in groups:
            pattern += rf"\{groups.index(piece) + 1}"
        else:
            groups.append(piece)
            pattern += f"({_PLACEHOLDERS[piece]})"
    full = f"(?:^|/){pattern}$"
    return {
        name: F.when(path.rlike(full), F.regexp_extract(path, full, i + 1))
        for i, name in enumerate(groups)
    }


# -- request plans and envelopes --------------------------------------------


def period_chunks(stations: DataFrame, first_year: Column, last_year: Column, as_of: Column) -> DataFrame:
    """Station, year and quarter ranges that have begun by ``as_of``; the open
    quarter ends at ``as_of``.  Each station row yields its own ranges, so
    nothing is paired with another table."""
    starts = F.sequence(
        F.make_date(first_year, F.lit(1), F.lit(1)),
        F.make_date(last_year, F.lit(10), F.lit(1)),
        F.expr("interval 3 months"),
    )
    chunks = stations.withColumn("_as_of", as_of.cast("date")).withColumn(
        "start_date", F.explode(F.filter(starts, lambda day: day <= as_of.cast("date")))
    )
    return chunks.select(
        *stations.columns,
        F.year("start_date").alias("year"),
        F.quarter("start_date").alias("quarter"),
        "start_date",
        F.least(F.date_sub(F.add_months("start_date", 3), 1), "_as_of").alias("end_date"),
    )


def lookback(end: Column, days: int = 30) -> tuple[Column, Column]:
    """Default request window: ``days`` before the end date up to the end date."""
    return F.date_sub(end.cast("date"), days), end.cast("date")


def bronze_envelope(
    rows: DataFrame, run_at: Column, execution_date: Column, payload: Sequence[str], **extra: Column
) -> DataFrame:
    """The ``payload`` columns of each row as a JSON document with run metadata."""
    meta = F.struct(
        run_stamp(run_at).alias("extraction_timestamp"),
        execution_date.alias("execution_date"),
        *[value.alias(name) for name, value in extra.items()],
    )
    body = F.struct(*[F.col(f"`{name}`") for name in payload], meta.alias("_metadata"))
    return rows.select(F.to_json(body).alias("text"))
