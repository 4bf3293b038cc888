"""The schema of a corpus of documents, day by day: what comes, goes or changes its type."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMBERS = "day string, path string, kind string"


def day_schemas(docs: DataFrame, day: Column) -> DataFrame:
    """``day, n_documents, n_unreadable, shape`` of documents (``text``, or ``body`` as VARIANT).

    The shape is the one schema that all documents of the day fit; Spark merges
    it on the map side, so a day is never collected.
    """
    body = F.col("body") if "body" in docs.columns else F.try_parse_json("text")
    parsed = docs.select(day.cast("string").alias("day"), body.alias("body"))
    return parsed.groupBy("day").agg(
        F.count("body").alias("n_documents"), F.count_if(F.col("body").isNull()).alias("n_unreadable"),
        F.schema_of_variant_agg("body").alias("shape"),
    )


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "object"
    if isinstance(kind, T.ArrayType):
        return "list"
    if isinstance(kind, T.NumericType):
        return "number"
    return {"variant": "mixed", "void": "null"}.get(kind.simpleString(), kind.simpleString())


def _members(kind: T.DataType, path: str = "$") -> Iterator[tuple[str, str]]:
    yield path, _kind(kind)
    if isinstance(kind, T.StructType):
        for field in kind:
            yield from _members(field.dataType, f"{path}.{field.name}")
    elif isinstance(kind, T.ArrayType):
        yield from _members(kind.elementType, f"{path}[*]")


def schema_members(spark: SparkSession, shapes: DataFrame) -> DataFrame:
    """``day, path, kind`` of every member of the shapes of ``day_schemas``: one text per day."""
    rows = []
    for r in shapes.select("day", "shape").collect():
        kind = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", r.shape))
        rows += [(r.day, path, name) for path, name in _members(kind)]
    return spark.createDataFrame(rows, MEMBERS)


def merged_schema(members: DataFrame) -> DataFrame:
    """``path, kind, first_day, last_day, n_days`` over all days; kinds that differ are ``mixed``, null fits any."""
    kinds = F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))
    return members.groupBy("path").agg(
        F.when(F.size(kinds) == 0, F.lit("null")).when(F.size(kinds) == 1, F.get(kinds, F.lit(0)))
        .otherwise(F.lit("mixed")).alias("kind"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count_distinct("day").alias("n_days"),
    )


def schema_changes(members: DataFrame) -> DataFrame:
    """``day, path, change, kind_before, kind``: members that a day has ``added``, ``removed`` or ``retyped``
    against the day stored before it.

    A member that is always null has the kind null, and is retyped when values come.
    """
    days = members.agg(F.sort_array(F.collect_set("day")).alias("days"))  # one name per day
    numbered = days.select("days", F.posexplode("days").alias("_n", "day")).select(
        "day", (F.col("_n") + 1).alias("_n"), F.get("days", F.col("_n") + 1).alias("_next")
    )
    rows = members.join(F.broadcast(numbered), "day")
    by_path = Window.partitionBy("path").orderBy("_n")
    rows = rows.withColumns({
        "_before": F.lag("_n").over(by_path), "kind_before": F.lag("kind").over(by_path),
        "_after": F.lead("_n").over(by_path),
    })
    neighbour = F.col("_before") == F.col("_n") - 1
    here = F.when((F.col("_n") > 1) & ~F.coalesce(neighbour, F.lit(False)), F.lit("added")).when(
        neighbour & (F.col("kind_before") != F.col("kind")), F.lit("retyped")
    )
    none = F.lit(None).cast("string")
    came = F.struct("day", "path", here.alias("change"), F.when(here == "retyped", F.col("kind_before")).alias("kind_before"), "kind")
    gone = F.when(
        F.col("_next").isNotNull() & ~F.coalesce(F.col("_after") == F.col("_n") + 1, F.lit(False)), F.lit("removed")
    )
    went = F.struct(F.col("_next").alias("day"), "path", gone.alias("change"), F.col("kind").alias("kind_before"), none.alias("kind"))
    return rows.select(F.inline(F.array(came, went))).filter("change is not null")
