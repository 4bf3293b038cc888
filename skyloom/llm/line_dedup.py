"""Runs of lines that repeat earlier runs.

Winnowing over line hashes: of every window (a run of ``lines`` consecutive
lines, of fewer lines with at least ``long_words`` words, or one line with at
least ``line_words``) the place of its least
line hash is selected, and that hash is a fingerprint.  Equal windows select equal
places, so a fingerprint found at one place only rules out all windows that
selected it; most lines of a corpus end there.  The windows of the other
fingerprints are compared whole and joined to the first of their kind.  Windows
that touch or overlap extend a match both ways to its full run, and the later
runs are deleted.

Where every line of a longer window is long enough to be a window itself, its
lines say what it says, and it is left out.

A window is joined to one place, the first, never to all others, so a passage
that many documents share costs one row per place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import text_of, written

WORD = r"[^\x20\x09-\x0D]+"


def windows(rows: DataFrame, lines: int, long_words: int, line_words: int) -> DataFrame:
    """(row, doc_id, start, length, place, fingerprint, content): all windows with a word in them
    that hold a line of less than ``line_words`` words, and all single lines of more.

    ``place`` is the line that the window selects, the first with its least hash.
    """

    def run(length):
        def window(i):
            hashes = F.slice("first", i, length)
            least = F.array_min(hashes)
            return F.struct(
                i.alias("start"), F.lit(length).alias("length"),
                (i + F.array_position(hashes, least).cast("int") - 1).alias("place"), least.alias("fingerprint"),
                F.xxhash64(F.slice("second", i, length)).alias("content"), words(i, length).alias("words"),
            )

        return window

    def words(i, length):
        return F.aggregate(F.slice("words", i, length), F.lit(0), lambda a, x: a + x)

    def least(length):
        return F.lit(0) if length == lines else F.lit(long_words)

    def needed(length):
        """Whether a window counts; its longest lines count alone."""
        if length == 1:
            return lambda i: F.element_at("words", i) >= line_words
        return lambda i: (words(i, length) >= least(length)) & (F.array_min(F.slice("words", i, length)) < line_words)

    def starts(length):
        last = F.size("first") - length + 1
        return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))

    found = [F.transform(F.filter(starts(n), needed(n)), run(n)) for n in range(1, lines + 1)]
    each = rows.select("row", "doc_id", F.explode(F.concat(*found)).alias("w")).select("row", "doc_id", "w.*")
    return each.where("words > 0").drop("words")


def shared_windows(each: DataFrame) -> DataFrame:
    """The windows whose fingerprint was selected at two places or more, stored.

    All windows are stored too: lines are hashed once, and read for the two uses.
    """
    each = written(each, "selected")
    place = F.xxhash64("row", "place")
    found = each.groupBy("fingerprint").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    # stored, so that both sides of the join are plain shuffles and a hot fingerprint can be split
    repeated = written(found.where("a != b").select("fingerprint"), "fingerprints")
    return written(each.drop("place").join(repeated, "fingerprint", "left_semi"), "windows")


def repeated_runs(
    docs: DataFrame, lines: int = 3, long_words: int = 50, line_words: int = 8,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(stored rows: row, doc_id, text), (row, runs: array of first line, last line, from 0)."""
    stored = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
            text_of(f"`{text_col}`").alias("text"),
        ),
        "lines",
    )
    split = F.split("text", "\n", -1)
    rows = stored.select(
        "row", "doc_id",
        F.transform(split, lambda x: F.xxhash64(F.trim(x))).alias("first"),
        F.transform(split, lambda x: F.xxhash64(F.lit(1), F.trim(x))).alias("second"),
        F.transform(split, lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
    )
    each = shared_windows(windows(rows, lines, long_words, line_words))
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row", "start")
    first = written(
        each.groupBy("fingerprint", "content", "length")
        .agg(F.min(order).alias("least"), F.count("*").alias("places"))
        .where("places > 1")
        .select(
            "fingerprint", "content", "length",
            F.col("least.row").alias("first_row"), F.col("least.start").alias("first_start"),
        ),
        "first",
    )
    elsewhere = (F.col("row") != F.col("first_row")) | (F.col("start") >= F.col("first_start") + F.col("length"))
    later = each.join(first, ["fingerprint", "content", "length"]).where(elsewhere)
    later = later.select("row", F.col("start").alias("a"), (F.col("start") + F.col("length") - 1).alias("b"))
    by_start = Window.partitionBy("row").orderBy("a", "b")
    reach = F.max("b").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col("a") > reach + 1)).cast("int")
    numbered = later.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(by_start))
    merged = numbered.groupBy("row", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    runs = merged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct((F.col("a") - 1).alias("first"), (F.col("b") - 1).alias("last")))).alias("runs")
    )
    return stored, runs


def dedup_lines(
    docs: DataFrame, lines: int = 3, long_words: int = 50, line_words: int = 8,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_lines, runs (first and last line deleted, from 0), n_deleted, text.

    Lines end at line feeds and are equal when they are so without spaces at
    their ends.  A run of at least ``lines`` lines, of fewer with at least
    ``long_words`` words, or a line of at least ``line_words``, is deleted where an
    equal one stands in an earlier document (by id, null last) or earlier in the
    same one without overlap.
    Every line keeps its first place.  Stretches without a word do not count.
    A null text is one empty line; repeated rows repeat each other, so the later
    ones lose what the first has; an empty table gives no rows; other columns
    are not read.
    """
    stored, runs = repeated_runs(docs, lines, long_words, line_words, id_col, text_col)
    none = F.array().cast("array<struct<first:int,last:int>>")
    rows = stored.join(runs, "row", "left").select(
        "doc_id", "text", F.coalesce("runs", none).alias("runs")
    )
    split = F.split("text", "\n", -1)
    # what stands between the runs: one slice before each run, one after the last
    ends = F.concat(F.array(F.lit(-1)), F.transform("runs", lambda r: r["last"]))
    starts = F.concat(F.transform("runs", lambda r: r["first"]), F.array(F.size(split)))
    gaps = F.filter(F.arrays_zip(ends.alias("e"), starts.alias("s")), lambda g: g["s"] - g["e"] > 1)
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(split, g["e"] + 2, g["s"] - g["e"] - 1)))
    text = F.when(F.size("runs") == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    deleted = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return rows.select(
        "doc_id", F.size(split).cast("long").alias("n_lines"), "runs", deleted.alias("n_deleted"), text.alias("text")
    )
