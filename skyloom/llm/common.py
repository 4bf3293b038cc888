"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import scratch_path

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"

#: Bytes of a word (digits, lower-case letters, all of a non-ASCII character); the rest become spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, and a
    lost executor cannot change rows that were already used."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def byte_words(text: str) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in UTF-8."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


def slices(frames: Iterable[pd.DataFrame], text: str, chars: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into runs of whole rows of about ``chars`` characters,
    so that the memory of a vectorised step does not depend on the batch size.
    A longer text makes a run of its own."""
    for frame in frames:
        if not len(frame):
            continue
        ends = np.cumsum(frame[text].str.len().fillna(0).to_numpy(dtype=np.int64) + 1)
        part = (ends - 1) // chars
        for _, rows in frame.groupby(part, sort=True):
            yield rows.reset_index(drop=True)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base modulo 2**64; grows to the longest text seen."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
    return _powers[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``words`` words.

    A text of fewer words has one shingle of all its words; one without words
    has none.  Polynomial hashes of the bytes between word bounds, taken from
    one running sum, so the whole text is hashed at once.
    """
    found = byte_words(text or "")
    if not found:
        return np.empty(0, dtype=np.uint64)
    width = min(words, len(found))
    data = np.frombuffer(b" ".join(found), dtype=np.uint8).astype(np.uint64)
    n = len(data)
    p = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data + np.uint64(1)) * p[:n], out=sums[1:])
    spaces = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [n]])
    a, b = starts[: len(starts) - width + 1], ends[width - 1 :]
    # align to the last power, so that equal words at different places hash alike
    value = (sums[b] - sums[a]) * p[n - a]
    # the alignment depends on n; undo it with the inverse power
    value = value * _inverse_power(n)
    return np.unique(mixed(value ^ ((b - a).astype(np.uint64) << np.uint64(48))))


def _inverse_power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), -n, 1 << 64))
