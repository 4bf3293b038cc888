"""Insert-if-absent, keyed upsert and row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.dedupe import keep_first, keep_last
from skyloom.session import checkpointed


def insert_if_absent(
    batch: DataFrame,
    target: DataFrame | None,
    key: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """Rows of ``batch`` to append: first per key, and only keys not in ``target``.

    Keep-first and the anti join hash on the same columns, so the batch is
    shuffled once; of the target only the key columns are read.
    """
    fresh = keep_first(batch, key, order)
    if target is None:
        return fresh
    return fresh.join(target.select(*key), list(key), "left_anti")


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with consecutive numbers from ``start + 1`` in the given order.

    A window without partitions would pull everything into one task.  Here the
    rows are range-sorted, each partition numbers its own rows, and partition
    sizes (one row per partition) shift them.  The sorted rows are checkpointed
    first: sizes and rows must come from the same run of the sort.
    """
    placed = checkpointed(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    )
    part, offset = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).collect()
    before, rows = start, []
    for row in sorted(sizes):
        rows.append((row["part"], before))
        before += row["size"]
    spark = df.sparkSession
    shifts = spark.createDataFrame(rows, "_part long, _before long")
    numbered = placed.join(F.broadcast(shifts), part == F.col("_part"))
    return numbered.withColumn(name, F.col("_before") + offset + 1).drop(
        "_place", "_part", "_before"
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    updates: Sequence[str],
    on_update: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    ident: str | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` after merging ``source`` by ``key``.

    Where a source row exists its ``updates`` columns win and ``on_update``
    columns take the given expression; every other column, the surrogate
    ``ident`` included, stays.  New keys get ``on_insert`` values and the next
    ids in key order.  Of several source rows for one key the last in ``order``
    counts; without an order the greatest by all its other columns does, so a
    key never becomes two rows.

    Source and target meet in one full outer join; with an ``ident`` its result
    is kept in reliable storage, and only the unmatched rows are numbered.
    """
    on_update, on_insert = on_update or {}, on_insert or {}
    key = list(key)
    source = keep_last(source, key, order or [c for c in source.columns if c not in key])
    columns, types = target.columns, dict(target.dtypes)
    fresh = {c: F.col(c) if c in updates else on_insert.get(c, F.lit(None)) for c in columns if c not in key}
    incoming = source.select(*key, *[value.alias(f"_new_{c}") for c, value in fresh.items()], F.lit(True).alias("_hit"))
    hit, old = F.col("_hit").isNotNull(), F.col("_old").isNotNull()

    def merged(column: str) -> Column:
        if column in key:
            return F.col(column)
        if column in updates:
            changed = F.when(hit, F.col(f"_new_{column}")).otherwise(F.col(column))
        elif column in on_update:
            changed = F.when(hit, on_update[column]).otherwise(F.col(column))
        else:
            changed = F.col(column)
        return F.when(old, changed).otherwise(F.col(f"_new_{column}"))

    joined = target.withColumn("_old", F.lit(True)).join(incoming, key, "full_outer")
    out = joined.select("_old", *[merged(c).alias(c) for c in columns])
    # typed last: only what a reader asks for is cast
    typed = [F.col(c).cast(types[c]).alias(c) for c in columns]
    if not ident:
        return out.select(*typed)
    out = checkpointed(out)
    kept = out.filter(F.col("_old").isNotNull()).select(*typed)
    start = kept.agg(F.max(ident)).first()[0] or 0
    new = number_rows(out.filter(F.col("_old").isNull()).drop("_old", ident), key, ident, start)
    return kept.unionByName(new.select(*typed))
