"""Keyed keep-first and duplicate counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first under ``order``, nulls in the key being values.

    The filter on ``row_number() = 1`` lets Spark keep only the first row of
    each key on the map side (``WindowGroupLimit``), so a key that holds a third
    of the table still sends at most one row per task through the shuffle.
    """
    by_key = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(by_key))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_first(df, key, [F.col(name).desc() for name in order])


def duplicate_members(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row: ``is_unique, duplicate_rows``.

    Counts are combined on the map side; no group is ever collected.
    """
    if any(name not in df.columns for name in key):
        return df.agg(F.lit(False).alias("is_unique"), F.count(F.lit(1)).alias("duplicate_rows"))
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    members = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return groups.agg((members == 0).alias("is_unique"), members.alias("duplicate_rows"))


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of distinct key tuples, nulls counted as values: ``distinct_keys``."""
    return df.select(*key).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))
