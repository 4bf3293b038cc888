"""Contiguous shards of least largest size over groups of equal texts.

Groups (equal texts) are atoms.  In the order of their digest they lie on an
axis of bytes; a shard is a contiguous run of atoms.  The smallest capacity for
which the greedy check needs no more than the wanted shards is found by binary
search, then the axis is cut there.

The axis stays distributed.  The driver holds only some atom ends.  Between two
of them the greedy check has an optimistic answer (a cut anywhere) and a
pessimistic one (a cut at a known end).  Where the two disagree, one
aggregation brings finer ends, until the smallest capacity is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import text_of, written

#: Runs of digests whose sums are chained first, ends fetched in one round, and parts in which a shard is numbered.
RUNS, ENDS, PARTS = 4096, 16384, 256


@dataclass
class Axis:
    """Known atom ends; ``whole[i]`` tells that no other end lies between ends i and i + 1."""

    ends: list[int]
    whole: list[bool]

    def next(self, at: int, capacity: int, optimistic: bool) -> int:
        reach = at + capacity
        if reach >= self.ends[-1]:
            return self.ends[-1]
        i = bisect_right(self.ends, reach) - 1
        return reach if optimistic and not self.whole[i] else self.ends[i]

    def walk(self, capacity: int, shards: int, optimistic: bool) -> list[int]:
        """Greedy cut positions, one per shard."""
        at, cuts = 0, []
        for _ in range(shards):
            at = self.next(at, capacity, optimistic)
            cuts.append(at)
        return cuts

    def smallest(self, low: int, high: int, shards: int, optimistic: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, optimistic)[-1] >= self.ends[-1]:
                high = middle
            else:
                low = middle + 1
        return low


def _ends(atoms: DataFrame, ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(least end, largest end, number of ends) of even parts of each range (from, to]; at most ENDS rows."""
    each = max(1, ENDS // len(ranges))
    part = F.lit(None).cast("long")
    for k, (a, b) in enumerate(ranges):
        width = max(1, -(-(b - a) // each))
        inside = (F.col("end") > a) & (F.col("end") <= b)
        part = F.when(inside, F.lit(k * each) + F.floor((F.col("end") - a - 1) / width)).otherwise(part)
    within = F.lit(False)
    for a, b in ranges:
        within = within | ((F.col("end") > a) & (F.col("end") <= b))
    found = atoms.where(within).groupBy(part.alias("part")).agg(
        F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n")
    )
    return sorted((r.a, r.b, r.n) for r in found.collect())


def _refine(axis: Axis, parts: list[tuple[int, int, int]], ranges: list[tuple[int, int]]) -> Axis:
    """``axis`` with the ends of ``parts``, which hold all ends in ``ranges``."""
    whole = {}
    for a, b, n in parts:
        if b > a:
            whole[a] = n == 2
        whole[b] = True  # up to the next end, which is known too
    old = dict(zip(axis.ends, [*axis.whole, True]))
    ends = sorted(set(axis.ends) | set(whole))
    flags = []
    starts = [a for a, _ in ranges]
    for end in ends:
        i = bisect_right(starts, end) - 1
        inside = i >= 0 and end < ranges[i][1]
        flags.append(whole.get(end, True if inside else old.get(end, True)) if inside else old.get(end, True))
    return Axis(ends, flags[:-1])


def _unsure(axis: Axis, low: int, high: int, shards: int) -> list[tuple[int, int]]:
    """Ranges of the axis in which a cut for a capacity in [low, high] may lie and where ends are unknown."""
    early, late = axis.walk(low, shards, False), axis.walk(high, shards, True)
    ranges: list[tuple[int, int]] = []
    for a, b in zip([0, *early], [0, *late][: shards]):
        first, last = a + low, min(b + high, axis.ends[-1])
        i = max(0, bisect_right(axis.ends, first) - 1)
        while i < len(axis.ends) - 1 and axis.ends[i] <= last:
            if not axis.whole[i]:
                ranges.append((axis.ends[i], axis.ends[i + 1]))
            i += 1
    joined: list[tuple[int, int]] = []
    for a, b in sorted(set(ranges)):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    while len(joined) > 64:  # few wide ranges keep the filter short
        gap = min(range(len(joined) - 1), key=lambda k: joined[k + 1][0] - joined[k][1])
        joined[gap : gap + 2] = [(joined[gap][0], joined[gap + 1][1])]
    return joined


def minimax_cuts(atoms: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity, and cut positions on the axis (one per shard, the last is its end).

    ``atoms``: a stored table with ``end`` (position after the atom) and ``bytes``.
    Among the cuts of least capacity those are taken that come nearest to even
    shares, so no shard is left empty while another could give it an atom.
    """
    top = atoms.agg(F.max("end").alias("total"), F.max("bytes").alias("most")).first()
    if top.total is None:
        return 0, []
    total, most = top.total, top.most
    axis = Axis([0, total], [False])
    axis = _refine(axis, _ends(atoms, [(0, total)]), [(0, total)])
    low, high = max(most, -(-total // shards)), total
    while True:
        low, high = axis.smallest(low, high, shards, True), axis.smallest(low, high, shards, False)
        if low == high:
            return high, _even(axis, high, shards)
        ranges = _unsure(axis, low, high, shards)
        axis = _refine(axis, _ends(atoms, ranges), ranges)


def _even(axis: Axis, capacity: int, shards: int) -> list[int]:
    """Cuts within ``capacity``, each as near to an even share of what is left as the rest allows."""
    ends, total = axis.ends, axis.ends[-1]
    least = [total]  # from which position the last k shards can hold the rest
    for _ in range(shards - 1):
        least.append(ends[bisect_left(ends, max(0, least[-1] - capacity))])
    cuts, at = [], 0
    for left in range(shards, 1, -1):
        low = max(least[left - 1], at)
        high = ends[bisect_right(ends, at + capacity) - 1]
        share = at + (total - at) / left
        i = bisect_left(ends, share)
        best = min(ends[max(0, i - 1) : i + 1], key=lambda e: abs(e - share))
        at = min(max(best, low), high)
        cuts.append(at)
    return [*cuts, total]


def _digest(text_col: str) -> Column:
    return F.sha2(text_of(f"`{text_col}`"), 256)


def shard_documents(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    A size is the UTF-8 bytes of the text plus 1; a null text has none and is
    in the group of the empty text.  Documents with equal texts get one shard.
    The largest shard is as small as contiguous runs in digest order allow.
    Slots count from 0 within a shard without gaps.  With fewer groups than
    shards some shards stay empty; an empty table gives no rows.  Repeated rows
    get slots of their own; other columns are not read.
    """
    text = text_of(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _digest(text_col).alias("digest"),
    )
    rows = written(rows, "sizes")
    run = F.conv(F.substring("digest", 1, 3), 16, 10).cast("int").alias("run")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes")).select(run, "digest", "bytes")
    chained = written(
        groups.withColumn("inner", F.sum("bytes").over(Window.partitionBy("run").orderBy("digest"))), "runs"
    )
    # RUNS rows at most, however large the table
    sums = chained.groupBy("run").agg(F.sum("bytes").alias("bytes"))
    before = F.sum("bytes").over(Window.orderBy("run")) - F.col("bytes")
    offsets = sums.select("run", before.alias("before"))
    atoms = written(
        chained.join(F.broadcast(offsets), "run").select(
            "digest", "bytes", (F.col("before") + F.col("inner")).alias("end")
        ),
        "atoms",
    )
    _, cuts = minimax_cuts(atoms, shards)
    # the digest of the last atom of each shard: at most ``shards`` rows
    last = {r.end: r.digest for r in atoms.where(F.col("end").isin(cuts)).select("end", "digest").collect()}
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("digest") > F.lit(last.get(cut, ""))).cast("int")
    placed = rows.withColumn("shard", shard.cast("int"))
    # number each shard in even parts, so that no task sorts a whole shard
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(PARTS)).cast("int"))
    parts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    start = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    parts = parts.select("shard", "part", start.alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "digest"))
    numbered = placed.withColumn("rank", rank)
    return numbered.join(F.broadcast(parts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot")
    )
