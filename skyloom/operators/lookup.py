"""Lookup joins of facts against dimensions, with a measured broadcast bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``side`` is small enough to send to every executor.

    Rows and the bytes of their texts are measured, not estimated.  The
    measurement stops one row past the bound, so it is cheap on a table of any
    size.
    """
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in side.dtypes if kind == "string"]
    width = sum(texts, F.lit(8 * len(side.columns)))
    sample = side.select(width.alias("width")).limit(max_rows + 1)
    found = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("width").alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: dict[str, str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``fact`` with ``columns`` (dimension column -> output name) of its match.

    ``dim`` must hold one row per key, and should be stored: a side that is
    itself the result of a big aggregation is better checkpointed first, as the
    size check runs it.  Up to ``max_rows`` dimension rows are broadcast.  Beyond
    that it is one sort-merge join, with one read and one shuffle of the fact;
    ``spark.sql.adaptive.skewJoin`` splits the partition of a key that holds a
    large share of the table.
    """
    small = dim.select(
        F.col(dim_key).alias("_dim_key"),
        *[F.col(source).alias(target) for source, target in columns.items()],
    )
    on = F.col(fact_key) == F.col("_dim_key")
    if fits_broadcast(small, max_rows):
        return fact.join(F.broadcast(small), on, how).drop("_dim_key")

    # both sides are shuffled once; adaptive execution splits the partitions of hot keys
    return fact.join(small.hint("merge"), on, how).drop("_dim_key")


def one_row_per_name(dim: DataFrame, name: str, ident: str) -> DataFrame:
    """Name -> id with the largest id for a repeated name, so a join cannot fan out."""
    return dim.filter(F.col(name).isNotNull()).groupBy(name).agg(F.max(ident).alias(ident))


def city_lookup(
    fact: DataFrame,
    cities: DataFrame,
    name: str = "city_name",
    fallback: str | None = None,
    ident: str = "city_id",
    dim_name: str = "city_name",
    how: str = "left",
) -> DataFrame:
    """``fact`` with ``city_id``: by ``name``, else by the ``fallback`` column.

    Rows of unknown cities keep a null id under ``how="left"``; the caller
    drops or reports them.
    """
    mapping = one_row_per_name(cities, dim_name, ident)
    if fallback is None or fallback not in fact.columns:
        return dim_join(fact, mapping, name, dim_name, {ident: ident}, how)
    if name not in fact.columns:
        return dim_join(fact, mapping, fallback, dim_name, {ident: ident}, how)
    first = dim_join(fact, mapping, name, dim_name, {ident: "_id_by_name"})
    second = dim_join(first, mapping, fallback, dim_name, {ident: "_id_by_other"})
    out = second.withColumn(ident, F.coalesce("_id_by_name", "_id_by_other"))
    out = out.drop("_id_by_name", "_id_by_other")
    return out if how == "left" else out.filter(F.col(ident).isNotNull())


def station_lookup(
    fact: DataFrame, stations: DataFrame, key: str = "station_id", how: str = "left"
) -> DataFrame:
    """``fact`` with the surrogate ``station_key`` of its natural station id."""
    mapping = one_row_per_name(stations, "station_id", "id")
    return dim_join(fact, mapping, key, "station_id", {"id": "station_key"}, how)


def unknown_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Distinct fact keys without a dimension row and how many rows they hold.

    The fact is reduced to one row per key before it meets the dimension.
    """
    keys = fact.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(dim.select(F.col(dim_key).alias("key")), "key", "left_anti")


def first_keys(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` distinct keys in order, for a log line."""
    return df.select(F.col(key).alias("key")).distinct().orderBy("key").limit(n)


def fk_orphans(
    fact: DataFrame, checks: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Rows per foreign key value that has no parent; null keys are allowed.

    ``checks`` maps a fact column to (parent table, parent key).
    """
    found = None
    for column, (parent, parent_key) in checks.items():
        orphans = (
            unknown_keys(fact.filter(F.col(column).isNotNull()), parent, column, parent_key)
            .select(
                F.lit(column).alias("fk_column"),
                F.col("key").cast("string").alias("fk_value"),
                "n_rows",
            )
        )
        found = orphans if found is None else found.unionByName(orphans)
    return found
