"""Removing every byte that a repeated string of a given length covers.

Of all suffixes only the first ``length`` bytes are ordered, by passes from the
most significant digit on; suffixes that are alone leave the sort, and the
groups that remain at full depth are exactly the repeated strings.

The first digit is the *seed*: the least hash among the runs of ``gram`` bytes
that begin in the string, so equal strings have equal seeds at equal places.
Neighbouring strings mostly share their seed occurrence, and such a *chunk* of
strings travels as one row.  Seeds that occur once drop out, chunks that are
equal as a whole are settled by counting, and only the rest, one chunk of each
kind, carries bytes to the passes inside tasks.

Chunks of a seed with very many kinds are cut into pieces of strings that share
their bytes around the seed, and those bytes are the next digit.  A group that
is still large is dealt to blocks; what is alone in its block meets the other
blocks by the last digit, the fingerprint of the whole string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from skyloom.llm.common import mixed, powers, text_of, written

#: Strings of a text handled at once, bytes of one step of the passes, passes, kinds in a block, pieces of a chunk.
SEGMENT, STEP, DIGITS, BLOCK, PIECES = 1 << 20, 1 << 20, 8, 512, 8

SEED = "k1 long, k2 long, at long, low long, high long, seed long, digest long"
CHUNK = """k1 long, k2 long, at long, low long, high long, n long, seed long, part int, digit long,
digest long, bytes binary"""
FOUND = "open boolean, g1 long, g2 long, g3 long, g4 long, k1 long, k2 long, low long, high long, alone boolean"

#: Hashes are aligned to this power, so that they can be compared between texts and tasks.
TOP = 1 << 23


def _sums(data: bytes) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, start: np.ndarray, width) -> np.ndarray:
    """Of the bytes ``[start, start + width)``."""
    return mixed((sums[start + width] - sums[start]) * powers(TOP + 1)[TOP - start])


def seeds_of(data: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Chunks of the strings of one segment: seed place, first and last string, seed hash, hash of all bytes."""
    sums, n = _sums(data), len(data) - gram + 1
    span = length - gram + 1
    hashes = _hashes(sums, np.arange(n), gram)
    key = np.full(-(-n // span) * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    key[:n] = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = key.reshape(-1, span)  # least value of each window from running minima of blocks
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: n - span + 1], before[span - 1 : n])
    low = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    high = np.concatenate([low[1:], [len(least)]]) - 1
    at = (least[low] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    width = high - low + length
    digest = _hashes(sums, low, width) ^ mixed((width * 1_000_003 + at - low).astype(np.uint64))
    return at, low, high, hashes[at], digest


def _seed_rows(length: int, gram: int) -> Callable:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["k1", "k2", "at", "low", "high", "seed", "digest"]
        for frame in frames:
            parts, held = [], 0
            for k1, k2, text in zip(frame["k1"], frame["k2"], frame["bytes"]):
                for x in range(0, len(text) - length + 1, SEGMENT):
                    at, low, high, seed, digest = seeds_of(text[x : x + SEGMENT + length - 1], length, gram)
                    key = np.full(len(at), k1), np.full(len(at), k2)
                    parts.append((*key, at + x, low + x, high + x, seed.view(np.int64), digest.view(np.int64)))
                    held += len(at)
                if held > 50_000:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts)))))
                    parts, held = [], 0
            if parts:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts)))))

    return run


def _code(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def pieces_of(text: bytes, at: int, low: int, high: int, length: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """Number, digit, first and last string of the pieces of a chunk.

    Strings are cut by their bytes before the seed, in even ranges; the digit is
    what all strings of a piece hold around the seed.
    """
    rest = length - gram
    width = -(-(rest + 1) // PIECES)
    for part in range(PIECES):
        least, most = part * width, (part + 1) * width - 1
        first, last = max(low, at - most), min(high, at - least)
        if first <= last:
            yield part, _code(text[at - least : at + gram + max(0, rest - most)]), first, last


def _chunk_rows(length: int, gram: int) -> Callable:
    """Documents with their chunks to rows with bytes; chunks of a seed with many kinds become pieces.

    Pieces that a task meets again are settled: such runs go on without bytes,
    and of their bytes one row is left.
    """
    names = [c.split()[0] for c in CHUNK.split(",")]

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, held, met = [], 0, {}
            for r in frame.itertuples(index=False):
                for at, low, high, n, kinds, seed, digest in zip(r.at, r.low, r.high, r.n, r.kinds, r.seed, r.digest):
                    if kinds <= BLOCK:
                        chunk = r.bytes[low : high + length]
                        out.append([r.k1, r.k2, at, low, high, n, seed, -1, 0, digest, chunk])
                        held += len(chunk)
                        continue
                    for part, digit, first, last in pieces_of(r.bytes, at, low, high, length, gram):
                        chunk = r.bytes[first : last + length]
                        code = _code(chunk + int(at - first).to_bytes(8, "little"))
                        row = [r.k1, r.k2, at, first, last, n, seed, part, digit, code, chunk]
                        before = met.setdefault((seed, part, code), row)
                        if before is row:
                            out.append(row)
                            held += len(chunk)
                        elif before[:4] != row[:4]:  # a repeated row of a document is not another place
                            if before[5] == 1:
                                out.append([*before[:5], 2, before[0], -2, 0, 0, b""])
                                before[5] = 2
                            out.append([*row[:5], 2, row[0], -2, 0, 0, b""])
                if held > 8 * STEP:
                    yield pd.DataFrame(out, columns=names)
                    out, held, met = [], 0, {}
            if out:
                yield pd.DataFrame(out, columns=names)

    return run


def equal_groups(words: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """Most significant digit first: the group of each suffix at full depth, -1 if it is alone.

    ``words`` holds one digit array per pass, ``group`` the groups before the first pass.
    """
    result, active = np.full(len(group), -1, dtype=np.int64), np.arange(len(group))
    for digit in words:
        if not len(active):
            break
        order = np.lexsort((digit[active], group))
        active, group = active[order], group[order]
        digits = digit[active]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digits[1:] != digits[:-1])])
        label = np.cumsum(new) - 1
        together = np.bincount(label)[label] > 1
        active, group = active[together], label[together]
    result[active] = group
    return result


def _passes(length: int) -> Callable:
    """Sorted blocks of chunks and pieces to the strings found repeated.

    A row that is not ``open`` is a run of repeated strings.  Of a group with several
    blocks also every different string is returned once, open, under its fingerprints
    ``g1`` to ``g4``; it is ``alone`` if its block has it once.
    """
    width = -(-length // DIGITS)
    offsets = [min(t * width, length - width) for t in range(DIGITS)]
    block_of = ["seed", "part", "digit", "block"]

    def settled_runs(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"open": False, "g1": rows["k1"], "g2": rows["k2"], "g3": rows["low"], "g4": 0,
                             "k1": rows["k1"], "k2": rows["k2"], "low": rows["low"], "high": rows["high"], "alone": False})

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["bytes"].str.len().to_numpy(np.int64)
        sums = _sums(b"".join(rows["bytes"]))
        strings = sizes - length + 1
        row = np.repeat(np.arange(len(rows)), strings)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
        start = np.repeat(np.cumsum(sizes) - sizes, strings) + inner
        block = rows.groupby(block_of, sort=False).ngroup().to_numpy()
        left = (rows["at"] - rows["low"]).to_numpy(np.int64)[row] - inner  # bytes before the seed
        words = [_hashes(sums, start + o, width) for o in offsets]
        group = equal_groups(words, block[row] * length + left)
        settled = rows["n"].to_numpy()[row] > 1  # all of the chunk occurs twice
        low = rows["low"].to_numpy(np.int64)[row] + inner
        hit = (group >= 0) & ~settled
        first = hit.copy()
        first[1:] &= ~(hit[:-1] & (row[1:] == row[:-1]))
        last = hit.copy()
        last[:-1] &= ~(hit[1:] & (row[1:] == row[:-1]))
        k1, k2 = rows["k1"].to_numpy()[row], rows["k2"].to_numpy()[row]
        done = pd.DataFrame({"open": False, "g1": k1[first], "g2": k2[first], "g3": low[first], "g4": 0,
                             "k1": k1[first], "k2": k2[first], "low": low[first], "high": low[last], "alone": False})
        wide = np.flatnonzero((rows["blocks"].to_numpy() > 1)[row])
        if not len(wide):
            return done
        lead = np.ones(len(wide), dtype=bool)  # one string of each group goes on
        inside = np.flatnonzero(group[wide] >= 0)
        _, one = np.unique(group[wide][inside], return_index=True)
        lead[inside] = False
        lead[inside[one]] = True
        wide = wide[lead]
        mark = np.zeros(len(wide), dtype=np.uint64)
        for t, word in enumerate(words):
            mark = mixed(mark * np.uint64(0x9E3779B97F4A7C15) + word[wide] + np.uint64(t + 1))
        whole = _hashes(sums, start[wide], length)
        alone = (group[wide] < 0) & ~settled[wide]
        return pd.concat([done, pd.DataFrame({
            "open": True, "g1": rows["seed"].to_numpy()[row[wide]], "g2": left[wide], "g3": whole.view(np.int64),
            "g4": mark.view(np.int64), "k1": k1[wide], "k2": k2[wide], "low": low[wide], "high": low[wide],
            "alone": alone})])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            done = frame["part"] == -2
            if done.any():
                yield settled_runs(frame[done])
            # rows that repeat a document bring its chunks again
            rest = pd.concat([rest, frame[~done]]).drop_duplicates(["k1", "k2", "at", "low"], ignore_index=True)
            blocks = rest.assign(size=rest["bytes"].str.len()).groupby(block_of, sort=False)["size"].agg(["sum", "size"])
            begin, held, at = 0, 0, 0
            for size, rows in blocks.iloc[:-1].itertuples(index=False):
                held, at = held + size, at + rows
                if held > STEP:
                    yield solve(rest.iloc[begin:at].reset_index(drop=True))
                    begin, held = at, 0
            rest = rest.iloc[begin:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield solve(rest)

    return run


@F.pandas_udf(BinaryType())
def _kept(texts: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
    """The bytes outside the spans; null stays null."""
    out = []
    for text, a, b in zip(texts, low, high):
        if text is None or a is None:
            out.append(None)
            continue
        pieces, at = [], 0
        for x, y in zip(a, b):
            pieces.append(text[at:x])
            at = y
        out.append(b"".join([*pieces, text[at:]]))
    return pd.Series(out, dtype=object)


def _merged(runs: Column) -> Column:
    """Sorted (low, high) pairs joined where they touch or overlap."""
    empty = F.array().cast("array<struct<low:bigint,high:bigint>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (x["low"] <= F.try_element_at(done, F.lit(-1))["high"])
        longer = F.struct(last["low"].alias("low"), F.greatest(last["high"], x["high"]).alias("high"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.reduce(F.array_sort(runs), empty, add)


def remove_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans, kept.

    ``spans`` are the maximal removed runs as (low, high) bytes, ``kept`` the
    other bytes.  A byte goes if a string of ``length`` bytes over it starts
    anywhere else too, in another document or the same; overlapping strings
    count, strings never cross documents, and all are judged on the input.  So
    equal texts of ``length`` bytes or more, repeated rows among them, go whole.
    A null text is empty; shorter texts stay as they are.  Ids may be null,
    repeated or of any type that casts to text.  An empty table gives no rows;
    other columns are not read.  Bytes count as equal when 64-bit hashes of two
    kinds agree.
    """
    gram = max(1, length // 4)
    text = text_of(f"`{text_col}`")
    rows = docs.select(
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit("id"), F.col(f"`{id_col}`").cast("string"), F.length(text), F.crc32(text.cast("binary"))).alias("k2"),
        F.col(f"`{id_col}`").alias("doc_id"), text.cast("binary").alias("bytes"),
    )
    seeds = written(rows.select("k1", "k2", "bytes").mapInPandas(_seed_rows(length, gram), SEED), "seeds")
    kinds = seeds.groupBy("seed", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at", "low", "high")).alias("r")
    )
    many = kinds.groupBy("seed").agg(F.count("*").alias("kinds"))
    kinds = written(kinds.join(many, "seed").where("n > 1 OR kinds > 1"), "kinds")
    whole = seeds.join(kinds.where("n > 1").select("seed", "digest"), ["seed", "digest"], "left_semi").select(
        "k1", "k2", "low", "high"
    )
    names = ["at", "low", "high", "n", "kinds", "seed", "digest"]

    def chunks_of(chosen: DataFrame) -> DataFrame:
        listed = chosen.groupBy("k1", "k2").agg(F.collect_list(F.struct(*names)).alias("c"))
        listed = listed.select("k1", "k2", *[F.col(f"c.{x}").alias(x) for x in names])
        return rows.join(listed, ["k1", "k2"]).mapInPandas(_chunk_rows(length, gram), CHUNK)

    one = kinds.where("kinds > 1").select("seed", "digest", "n", "kinds", "r.*")
    group = ["seed", "part", "digit"]
    large = chunks_of(one.where(F.col("kinds") > BLOCK)).where("part >= 0").groupBy(*group).agg(F.count("*").alias("pieces"))
    large = large.where(F.col("pieces") > BLOCK).select(*group, F.ceil(F.col("pieces") / BLOCK).cast("int").alias("blocks"))
    chunks = chunks_of(one).join(large, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    chunks = chunks.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    found = (
        chunks.repartition(*group, "block").sortWithinPartitions(*group, "block", "digest")
        .mapInPandas(_passes(length), FOUND)
    )
    others = F.count("*").over(Window.partitionBy("open", "g1", "g2", "g3", "g4"))
    parts = found.withColumn("places", others).where("NOT open OR (alone AND places > 1)")
    runs = whole.unionByName(parts.select("k1", "k2", "low", "high"))
    runs = runs.select("k1", "k2", F.struct("low", (F.col("high") + length).alias("high")).alias("run"))
    spans = runs.groupBy("k1", "k2").agg(F.collect_list("run").alias("runs")).select(
        "k1", "k2", _merged(F.col("runs")).alias("spans")
    )
    hit = F.col("spans").isNotNull()
    cut = _kept(F.when(hit, F.col("bytes")), F.col("spans.low"), F.col("spans.high"))
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    result = rows.join(spans, ["k1", "k2"], "left").withColumn("kept", F.coalesce(cut, F.col("bytes")))
    size = F.octet_length("bytes").cast("long")
    return result.select(
        "doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("spans", none).alias("spans"), "kept",
    )
