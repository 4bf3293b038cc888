"""Exact deduplication on a cuckoo-filter index of live digests.

Every document is reduced to the SHA-256 of its text without white space.  An
index keeps one live entry per digest: a cuckoo filter answers "surely new" for
most digests, and a hit is verified against the digests stored for that bucket.
An entry that leaves the index is deleted from the filter, and a filter that
overflows is rebuilt at twice its size from the stored digests.

The same index runs twice: over the rows of each input partition, where it
reduces a group of copies to one row per task, and over the reduced rows of a
digest bucket.  No task ever holds a whole group.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import WHITE, text_of, written

SLOTS = 4
KICKS = 64


class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit fingerprints, four slots a bucket,
    insertion and deletion.  ``add`` returns False when it overflows."""

    def __init__(self, buckets: int = 256):
        self.buckets = buckets
        self.rows: list[list[int]] = [[] for _ in range(buckets)]
        self.count = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:10], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.rows[a] or mark in self.rows[b]

    def add(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for place in (a, b):
            if len(self.rows[place]) < SLOTS:
                self.rows[place].append(mark)
                self.count += 1
                return True
        place = a
        for kick in range(KICKS):
            row = self.rows[place]
            mark, row[kick % SLOTS] = row[kick % SLOTS], mark
            place = self._other(place, mark)
            if len(self.rows[place]) < SLOTS:
                self.rows[place].append(mark)
                self.count += 1
                return True
        return False  # one fingerprint has no place; the caller rebuilds from its stored keys

    def remove(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for place in (a, b):
            if mark in self.rows[place]:
                self.rows[place].remove(mark)
                self.count -= 1
                return True
        return False


_digest_of = itemgetter(0)


class LiveIndex:
    """Live digests with one entry each.  ``put`` merges an entry into the live
    one of its digest; beyond ``limit`` entries the oldest is evicted and
    returned, so the memory of a task is bounded.

    Entries lie in sorted buckets, as many as the filter has.  Only a hit of the
    filter is looked up there; a digest that is surely new is not.
    """

    def __init__(self, merge: Callable[[tuple, tuple], tuple], limit: int):
        self.merge, self.limit = merge, limit
        self.filter = CuckooFilter()
        self.content: list[list[tuple[bytes, tuple]]] = [[] for _ in range(self.filter.buckets)]
        self.order: deque[bytes] = deque()

    def __len__(self) -> int:
        return len(self.order)

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        for bucket in self.content:
            yield from bucket

    def _bucket(self, digest: bytes) -> list[tuple[bytes, tuple]]:
        return self.content[int.from_bytes(digest[10:18], "big") & (len(self.content) - 1)]

    def put(self, digest: bytes, entry: tuple) -> tuple[bytes, tuple] | None:
        bucket = self._bucket(digest)
        if digest in self.filter:
            at = bisect_left(bucket, digest, key=_digest_of)
            if at < len(bucket) and bucket[at][0] == digest:
                bucket[at] = digest, self.merge(bucket[at][1], entry)
                return None
        insort(bucket, (digest, entry), key=_digest_of)
        self.order.append(digest)
        if not self.filter.add(digest):
            self._grow()
        return self._evict() if len(self.order) > self.limit else None

    def _evict(self) -> tuple[bytes, tuple]:
        digest = self.order.popleft()
        bucket = self._bucket(digest)
        self.filter.remove(digest)
        return bucket.pop(bisect_left(bucket, digest, key=_digest_of))

    def _grow(self) -> None:
        """Rebuild filter and buckets, twice as many or more, from the stored keys."""
        size = self.filter.buckets
        while True:
            size *= 2
            self.filter = CuckooFilter(size)
            if all(self.filter.add(digest) for digest in self.order):
                break
        entries = list(self.items())
        self.content = [[] for _ in range(size)]
        for digest, entry in entries:
            insort(self._bucket(digest), (digest, entry), key=_digest_of)


def _merge(a: tuple, b: tuple) -> tuple:
    """Entries are (count, chars, id or None, row); most characters, then the smallest id (null last)."""
    better = (-a[1], a[2] is None, a[2] or 0, a[3]) <= (-b[1], b[2] is None, b[2] or 0, b[3])
    best = a if better else b
    return a[0] + b[0], *best[1:]


def _reduce(limit: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def frame(entries) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "digest": [d for d, _ in entries],
                "n": pd.Series([e[0] for _, e in entries], dtype="int64"),
                "chars": pd.Series([e[1] for _, e in entries], dtype="int64"),
                "id": pd.Series([e[2] for _, e in entries], dtype="Int64"),
                "row": pd.Series([e[3] for _, e in entries], dtype="int64"),
            }
        )

    def run(frames):
        index, out = LiveIndex(_merge, limit), []
        for rows in frames:
            for digest, n, chars, key, row in zip(
                rows["digest"], rows["n"], rows["chars"], rows["id"].astype("Int64"), rows["row"]
            ):
                key = None if key is pd.NA else int(key)
                if gone := index.put(bytes(digest), (int(n), int(chars), key, int(row))):
                    out.append(gone)
            if len(out) >= 10_000:
                yield frame(out)
                out = []
        out.extend(index.items())
        for at in range(0, len(out), 10_000):
            yield frame(out[at : at + 10_000])

    return run


def with_digest(text_col: str = "text") -> tuple[Column, Column]:
    """Columns (digest, chars) of a text: SHA-256 without white space, code points."""
    text = text_of(f"`{text_col}`")
    bare = F.translate(text, WHITE, "")
    return F.unhex(F.sha2(bare, 256)), F.length(text).cast("long")


def keepers(digests: DataFrame, limit: int = 200_000) -> DataFrame:
    """One row per digest of ``digests`` (digest, chars, id, row): digest, keep_id, keep_row, group_size.

    ``limit`` bounds the live entries of one index; entries evicted by it are
    merged exactly by the last step, which sums the few rows left per digest.
    """
    shape = "digest binary, n long, chars long, id long, row long"
    rows = digests.select("digest", F.lit(1).cast("long").alias("n"), "chars", "id", "row")
    reduce = _reduce(limit)
    once = rows.mapInPandas(reduce, shape)
    twice = once.repartition("digest").mapInPandas(reduce, shape)
    order = F.struct((-F.col("chars")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("c"), "row")
    return (
        twice.groupBy("digest")
        .agg(F.min(order).alias("best"), F.sum("n").alias("group_size"))
        .select("digest", F.col("best.c").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    )


def _light(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    digest, chars = with_digest(text_col)
    return written(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"), digest.alias("digest"), chars.alias("chars"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; a null text is
    empty.  Of equal texts the one with the most code points stays, then the
    smallest id; a null id comes after all others.  Of rows that repeat the
    kept id one stays.  An empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    rows = _light(docs, id_col, text_col)
    # stored, so that both sides of the join are plain shuffles and a hot group can be split
    return rows.join(written(keepers(rows), "keepers"), "digest").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns kept."""
    keep = written(keepers(_light(docs, id_col, text_col)), "keepers").select(F.col("digest").alias("kd"), "keep_id")
    digest, chars = with_digest(text_col)
    packed = docs.select(
        F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
        digest.alias("digest"), chars.alias("chars"),
    )
    kept = packed.join(keep, (F.col("digest") == F.col("kd")) & F.col("id").eqNullSafe(F.col("keep_id")))
    # more than one row only where the table repeats an id
    first = F.row_number().over(Window.partitionBy("kd", "keep_id").orderBy(F.desc("chars")))
    return kept.withColumn("first", first).where("first = 1").select("row.*")
