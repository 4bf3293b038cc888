"""Mixing sources to target weights by entropy balancing.

Document rates stay as close as possible, in relative entropy, to one copy each
while the words of every source meet its target.  The convex dual has one
multiplier per source; the rates are exponentially tilted by document size and
end at the largest allowed number of copies.  All multipliers are found
together by Newton steps.  Each step is one aggregation over distinct
(source, size) cells, so its cost does not grow with the number of copies.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from skyloom.llm.common import text_of, written

WORD = r"[^\x20\x09-\x0D]+"

#: Documents of one part, in which copies of one cell are chosen, so that no task holds all documents of one size;
#: sources and cells that one task takes.
PART, SOURCES, CELLS = 1 << 12, 1 << 16, 1 << 18

#: Single copies that may change in a source after rounding.
CHANGES = 64


class NotConverged(RuntimeError):
    """The multipliers of some sources did not meet their target."""


def size_of(text_col: str) -> Column:
    return F.regexp_count(text_of(f"`{text_col}`"), F.lit(WORD)).cast("long")


def _key(source_col: str) -> Column:
    """Sources by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("~"))


def targets(cells: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Per source: words, weight, target.  One row per source.

    The targets rise together in proportion to the weights; each stops at
    ``cap`` times the words of its source.  That is the limit of sharing the
    excess anew by weight until no target is above its bound.
    """
    sums = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    order = F.row_number().over(Window.orderBy("key"))
    turn = (F.pmod(order - 1, F.lit(len(weights))) + 1).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    sums = sums.withColumn("weight", weight).withColumn("bound", F.col("words") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("bound") / F.col("weight"), "key")
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = sums.withColumn(
        "level",  # of all that are not yet full when this one is the next to fill
        (F.sum("words").over(everything) * F.lit(share) - F.coalesce(F.sum("bound").over(upto), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))),
    )
    ratio = F.col("bound") / F.col("weight")
    # the first source, in the order they fill, that the level does not fill any more
    first = F.min(F.when(F.col("level") <= ratio, F.struct(ratio.alias("r"), "key", "level"))).over(everything)
    level = F.coalesce(first["level"], F.max(ratio).over(everything))
    return sums.withColumn("top", level).select(
        "key", "words", "docs", F.least(F.col("top") * F.col("weight"), F.col("bound")).alias("target")
    )


def tilt(cells: DataFrame, goals: DataFrame, cap: float, tolerance: float = 1e-6, steps: int = 60) -> DataFrame:
    """The sources of ``goals`` that have words, with their multiplier ``tilt``.

    A document of size s has the rate min(cap, exp(tilt * s / mean size)).  A
    Newton step that leaves the bracket of its root, or goes far, becomes a
    bounded step towards the middle of the bracket.  A source whose target is
    its bound has all its documents at the cap.  One step is one grouping of the
    cells, which also carries what is known of their source; the number of
    sources that are not done comes with it.  ``NotConverged`` is raised when
    some are left after ``steps``.
    """
    log_cap = float(np.log(cap))
    full = F.col("target") >= F.col("words") * F.lit(float(cap) * (1 - 1e-9))
    start = goals.where("words > 0").withColumns(
        {"tilt": F.when(full, F.lit(1e9)).otherwise(F.lit(0.0)), "low": F.lit(-1e9), "high": F.lit(1e9)}
    )
    state, sources = _stored(start.withColumn("done", F.lit(False)), 1)
    tasks = 1 + sources // SOURCES
    live = cells.where("size > 0")
    known = ["key", "words", "docs", "target", "tilt", "low", "high"]
    for _ in range(steps):
        z = F.col("size") * F.col("docs") / F.col("words")
        power = F.col("tilt") * z
        capped = power >= log_cap
        mass = F.col("size") * F.col("n") * F.when(capped, F.lit(float(cap))).otherwise(F.exp(power))
        sums = live.join(state.select(*known), "key").groupBy(*known).agg(
            F.sum(mass).alias("mass"), F.sum(F.when(capped, F.lit(0.0)).otherwise(mass * z)).alias("slope")
        )
        gap = F.col("mass") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        middle = F.greatest(F.col("tilt") - 4, F.least(F.col("tilt") + 4, (low + high) / 2))
        good = (newton > low) & (newton < high) & (F.abs(newton - F.col("tilt")) <= 4)
        done = F.abs(gap) <= F.col("target") * tolerance
        moved = sums.select(
            "key", "words", "docs", "target", low.alias("low"), high.alias("high"), done.alias("done"),
            F.when(done, F.col("tilt")).when(good, newton).otherwise(middle).alias("tilt"),
        )
        state, left = _stored(moved, tasks)
        if not left:
            return state
    raise NotConverged(f"{left} of {sources} sources are not within {tolerance} of their target after {steps} steps")


def _stored(state: DataFrame, tasks: int) -> tuple[DataFrame, int]:
    """The state in few files, and how many sources are not done."""
    watch = Observation()
    kept = written(state.coalesce(tasks).observe(watch, F.count_if(~F.col("done")).alias("left")), "state")
    return kept, watch.get["left"]


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` as a stored table, and its rows."""
    kept = written(df, "cells")
    return kept, kept.count()


def _round(cells: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """Whole copies per cell: its expected copies, rounded down or up.

    The fractions are carried from cell to cell of a source in the order of size,
    so any stretch of sizes gets its expected copies within one, and the words of
    all are off by little more than the largest document.  Then single copies go
    or come where rounding left room, the size nearest to the missing words first,
    while that brings the words nearer to the target; what remains is at most half
    a document.  A source has at most as many open cells as there are sizes.
    """
    z = F.col("size") * F.col("docs") / F.col("words")
    rate = F.least(F.exp(F.least(F.col("tilt") * z, F.lit(float(np.log(cap))))), F.lit(float(cap)))
    due = F.col("n") * rate
    running = F.floor(F.sum(due).over(Window.partitionBy("key").orderBy("size")) + 0.5)
    before = F.coalesce(F.lag("running").over(Window.partitionBy("key").orderBy("size")), F.lit(0))
    first = (
        cells.join(state.select("key", "words", "docs", "target", "tilt"), "key")
        .withColumns({"low": F.floor(due + 1e-9), "high": F.ceil(due - 1e-9), "running": running})
        .withColumn("copies", F.greatest("low", F.least("high", F.col("running") - before)))
        .select("key", "size", "n", "target", "low", "high", "copies")
    )
    first = written(first, "rounded")
    change = F.when(F.col("copies") < F.col("high"), F.lit(1)).when(F.col("copies") > F.col("low"), F.lit(-1))
    open_cells = F.when((F.col("size") > 0) & change.isNotNull(), F.struct("size", change.cast("long").alias("change")))
    sources = first.groupBy("key").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("left"),
        F.sort_array(F.collect_list(open_cells), asc=False).alias("cells"),
    )
    none = F.array().cast("array<struct<size:bigint,change:bigint>>")

    def nearer(at: Column, _: Column) -> Column:
        left = at["left"]
        free = F.filter("cells", lambda c: (c["change"] * left > 0) & ~F.array_contains(at["taken"], c))
        best = F.array_min(F.transform(free, lambda c: F.struct(F.abs(F.abs(left) - c["size"]).alias("off"), c.alias("cell"))))["cell"]
        moved = F.struct((left - best["size"] * best["change"]).alias("left"), F.concat(at["taken"], F.array(best)).alias("taken"))
        return F.when(best["size"] < 2 * F.abs(left), moved).otherwise(at)

    # the words are off by about one document, so a few single copies are enough
    taken = F.reduce(
        F.sequence(F.lit(1), F.lit(CHANGES)), F.struct(F.col("left"), none.alias("taken")), nearer, lambda at: at["taken"]
    )
    changes = sources.select("key", F.inline(taken))
    return first.join(changes, ["key", "size"], "left").select(
        "key", "size", "n", (F.col("copies") + F.coalesce("change", F.lit(0))).cast("long").alias("copies")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    whole_rows: bool = False,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies (and ``row``, the
    whole input row, if ``whole_rows``).

    Sources in code point order, null last, take the weights in turn and share
    ``share`` times all words; a target stops at ``cap`` times its source's
    words.  No document is taken more than ``cap`` times.  Texts that are null,
    empty or blank have size 0 and one copy.  Rerunning gives the same copies;
    repeated rows are documents of their own; an empty table gives no rows.
    Other columns are only carried along.
    """
    rows = written(
        docs.select(
            *([F.struct("*").alias("row")] if whole_rows else []),
            F.col(f"`{id_col}`").alias("doc_id"), size_of(text_col).alias("size"), _key(source_col).alias("key"),
        ),
        "sizes",
    )
    parts = 1 + rows.count() // PART
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    small = written(rows.groupBy("key", "size", "part").agg(F.count("*").alias("m")), "parts")
    cells, n_cells = _counted(small.groupBy("key", "size").agg(F.sum("m").alias("n")))
    goals, _ = _counted(targets(cells, weights, share, cap))
    cells = cells.coalesce(1 + n_cells // CELLS)
    state = tilt(cells, goals, cap)
    blank = cells.join(goals.where("words = 0"), "key").select("key", "size", "n", F.col("n").alias("copies"))
    placed = _round(cells, state, cap).unionByName(blank)
    # the copies of a cell fall on its parts by running count, exactly in total
    big = "decimal(38,0)"
    upto = F.sum("m").over(Window.partitionBy("key", "size").orderBy("part")).cast(big)

    def due(count: Column) -> Column:
        return F.floor(count * F.col("copies").cast(big) / F.col("n").cast(big)).cast("long")

    shares = (
        small.withColumn("upto", upto).join(placed, ["key", "size"])
        .select(
            "key", "size", "part", "m",
            F.when(F.col("size") == 0, F.col("m"))
            .otherwise(due(F.col("upto")) - due(F.col("upto") - F.col("m").cast(big))).alias("take"),
        )
        .join(goals.select("key", F.col("words").alias("source_size"), "target"), "key")
    )
    rank = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    each = F.floor(F.col("take") / F.col("m")).cast("long")
    extra = (F.col("rank") <= F.pmod(F.col("take"), F.col("m"))).cast("long")
    return rows.withColumn("rank", rank).join(shares, ["key", "size", "part"]).select(
        *(["row"] if whole_rows else []), "doc_id", "size", "source_size", "target", (each + extra).alias("copies")
    )


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it."""
    mixed = mix(docs, whole_rows=True, **options).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
