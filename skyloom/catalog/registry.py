"""Registration of queries and output helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31 06:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, for comparison."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        out.append(column.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), 6) for n in names})
