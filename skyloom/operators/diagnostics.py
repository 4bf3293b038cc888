"""Profiles of frames and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.clean import normalise_nan


def null_profile(df: DataFrame) -> DataFrame:
    """``column, data_type, row_count, null_count, null_ratio, mostly_null`` from
    one aggregation."""
    counted = normalise_nan(df).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null:{c}") for c in df.columns],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), "row_count",
                 F.col(f"`null:{c}`").alias("null_count"))
        for c, t in df.dtypes
    ]
    rows = counted.select(F.inline(F.array(*entries)))
    ratio = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count"))
    return rows.withColumn("null_ratio", ratio).withColumn(
        "mostly_null", F.coalesce(ratio > 0.5, F.lit(False))
    )


def frame_profile(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """``name, valid, row_count, column_count, issues``; a high null share is an
    issue but leaves the frame valid."""
    missing = [c for c in required if c not in df.columns]
    counted = normalise_nan(df).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null:{c}") for c in df.columns],
    )
    empty = F.col("row_count") == 0
    ratio = {c: F.col(f"`null:{c}`") / F.col("row_count") for c in df.columns}
    issues = [F.when(empty, F.lit("empty"))]
    if missing:
        issues.append(F.when(~empty, F.lit(f"missing columns: {', '.join(missing)}")))
    issues += [
        F.when(~empty & (ratio[c] > 0.5), F.format_string(f"{c}: %.1f%% null", ratio[c] * 100))
        for c in df.columns
    ]
    return counted.select(
        F.lit(name).alias("name"),
        (~empty & F.lit(not missing)).alias("valid"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array_join(F.filter(F.array(*issues), lambda i: i.isNotNull()), "; ").alias("issues"),
    )


def _kind(value: Column) -> Column:
    """dict, list, or the scalar class of a variant."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | shape.startswith("VOID"), "null")
        .when(shape.startswith("OBJECT"), "dict")
        .when(shape.startswith("ARRAY"), "list")
        .when(shape == "STRING", "str")
        .when(shape == "BOOLEAN", "bool")
        .when(shape == "BIGINT", "int")
        .otherwise("float")
    )


def _members(value: Column) -> Column:
    """Number of members of an object or elements of a list."""
    return F.coalesce(
        F.size(F.try_variant_get(value, "$", "map<string, variant>")),
        F.size(F.try_variant_get(value, "$", "array<variant>")),
    )


def json_structure(docs: DataFrame, text: str = "text", max_depth: int = 3) -> DataFrame:
    """Structure of a corpus of JSON documents: per path and kind, how often it
    occurs and how many members it has.

    Objects are followed into every member and lists into their first element,
    down to ``max_depth`` levels.  The corpus is read and parsed once: each row
    of the deepest level also stands for its parents where it is their first
    member.
    """
    spark = docs.sparkSession
    rows = docs.select(F.try_parse_json(F.col(text)).alias("v")).filter("v is not null")
    rows = rows.select(
        "v", F.lit("$").alias("path0"), _kind(F.col("v")).alias("kind0"), _members(F.col("v")).alias("members0")
    )
    for depth in range(1, max_depth):
        path, kind = F.col(f"path{depth - 1}"), F.col(f"kind{depth - 1}")
        listed = kind == "list"
        inside = F.when(kind.isin("dict", "list"), F.col("v"))
        kept = [c for c in rows.columns if c != "v"]
        member = spark.tvf.variant_explode_outer(inside.outer()).alias("m")
        rows = rows.lateralJoin(member).filter(F.col("m.pos").isNull() | ~listed | (F.col("m.pos") == 0))
        name = F.when(listed, F.concat(path, F.lit("[0]"))).otherwise(F.concat(path, F.lit("."), F.col("m.key")))
        there, value = F.col("m.pos").isNotNull(), F.col("m.value")
        rows = rows.select(
            *kept,
            value.alias("v"),
            F.when(there, name).alias(f"path{depth}"),
            F.when(there, _kind(value)).alias(f"kind{depth}"),
            _members(value).alias(f"members{depth}"),
            F.coalesce(F.col("m.pos"), F.lit(0)).alias(f"pos{depth}"),
        )
    entries = []
    for depth in range(max_depth):
        counted = F.col(f"path{depth}").isNotNull()
        for below in range(depth + 1, max_depth):
            counted = counted & (F.col(f"pos{below}") == 0)
        entry = F.struct(*[F.col(f"{part}{depth}").alias(part) for part in ("path", "kind", "members")])
        entries.append(F.when(counted, entry))
    found = rows.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
    return found.groupBy("e.path", "e.kind").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.min("e.members").cast("long").alias("min_members"),
        F.max("e.members").cast("long").alias("max_members"),
    )


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """``column, presence, left_type, right_type, type_differs`` and both row
    counts, for every column of either frame."""
    mine, theirs = dict(left.dtypes), dict(right.dtypes)
    names = list(mine) + [c for c in theirs if c not in mine]
    rows = []
    for c in names:
        presence = "common" if c in mine and c in theirs else "only_left" if c in mine else "only_right"
        differs = presence == "common" and mine[c] != theirs[c]
        rows.append((c, presence, mine.get(c), theirs.get(c), differs))
    listed = left.sparkSession.createDataFrame(
        rows, "column string, presence string, left_type string, right_type string, type_differs boolean"
    )
    count = F.count(F.lit(1))
    return listed.withColumn("left_rows", left.agg(count).scalar()).withColumn(
        "right_rows", right.agg(count).scalar()
    )
