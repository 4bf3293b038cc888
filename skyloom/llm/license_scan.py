"""Short licence notices, exact and with bounded errors.

A notice with at most k edits, cut into k + 1 pieces, keeps at least one piece
unchanged (pigeonhole).  The pieces are searched exactly; around each hit the
regex library verifies the whole notice with its error bound and reports the
span and its edits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import byte_words, text_of

# Phrases and labels of the base result.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Notices the method searches besides the base phrases.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge", "mit"),
    ("licensed under the apache license", "apache"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("creative commons attribution", "cc-by"),
    ("mozilla public license", "mpl"),
    ("dedicated to the public domain", "public-domain"),
)


@dataclass(frozen=True)
class Notice:
    words: str
    label: str
    base: bool
    edits: int

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): ``edits`` + 1 parts of nearly equal length."""
        n, k = len(self.words), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]


def notices(base=BASE, more=NOTICES, chars_per_edit: int = 10) -> list[Notice]:
    """One edit is allowed for every ``chars_per_edit`` characters of a notice."""
    return [
        Notice(words, label, kind, len(words) // chars_per_edit)
        for group, kind in ((base, True), (more, False))
        for words, label in group
    ]


class Scanner:
    def __init__(self, wanted: list[Notice]):
        import regex

        self.items = []
        for notice in wanted:
            exact = re.compile(rb"(?<![^ ])" + re.escape(notice.words.encode()) + rb"(?![^ ])")
            bounded = regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(notice.words)}){{e<={notice.edits}}}(?![^ ])")
            seeds = [(at, piece.encode()) for at, piece in notice.pieces()]
            self.items.append((notice, exact, bounded, seeds))

    def windows(self, text: bytes, spaces: np.ndarray, notice: Notice, seeds) -> list[tuple[int, int]]:
        """Whole-word stretches in which a match may lie, merged where they meet."""
        found = []
        n, k = len(notice.words), notice.edits
        for offset, piece in seeds:
            at = text.find(piece)
            while at >= 0:
                found.append((max(0, at - offset - k), at - offset + n + k))
                at = text.find(piece, at + 1)
        merged: list[list[int]] = []
        for a, b in sorted(found):
            # by the places of the spaces, so that hits in one very long word stay cheap
            i, j = np.searchsorted(spaces, (a, b))
            a = int(spaces[i - 1]) + 1 if i else 0
            b = int(spaces[j]) if j < len(spaces) else len(text)
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        return [(a, b) for a, b in merged]

    def scan(self, text: str | None) -> tuple[int, list[tuple]]:
        """Number of words, and spans (label, first word, end word, edits, similarity, base)."""
        words = byte_words(text or "")
        joined = b" ".join(words)
        spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
        spans = set()

        def span(notice: Notice, a: int, b: int, edits: int, base: bool) -> None:
            start, end = int(np.searchsorted(spaces, a)), int(np.searchsorted(spaces, b)) + 1
            spans.add((notice.label, start, end, edits, 1 - edits / len(notice.words), base))

        for notice, exact, bounded, seeds in self.items:
            if notice.base or not notice.edits:
                at = joined.find(notice.words.encode())
                while at >= 0:
                    if exact.match(joined, at):
                        span(notice, at, at + len(notice.words), 0, notice.base)
                    at = joined.find(notice.words.encode(), at + 1)
            if notice.edits:
                for a, b in self.windows(joined, spaces, notice, seeds):
                    window = joined[a:b].decode("utf-8", "replace")
                    left, at = a, 0  # the same place in bytes and in characters
                    for m in bounded.finditer(window):
                        left, at = left + len(window[at : m.start()].encode()), m.start()
                        edits = sum(m.fuzzy_counts)
                        if not (edits == 0 and notice.base):
                            span(notice, left, left + len(m.group().encode()), edits, False)
        return len(words), sorted(spans)


def license_spans(
    docs: DataFrame, wanted: list[Notice] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, and ``spans`` (label, first word,
    end word exclusive, edits, similarity, base) in order.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered.
    A base span is a place where a base phrase's words stand consecutively; the
    method adds spans with up to one edit per ten characters, at word bounds.
    A null or empty text has no words and no spans; repeated rows repeat their
    result; an empty table gives no rows; other columns are not read.
    """
    wanted = wanted or notices()

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(wanted)
        for frame in frames:
            found = [scanner.scan(text) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_words": [n for n, _ in found],
                    "spans": [
                        [dict(zip(("label", "first", "end", "edits", "similarity", "base"), s)) for s in spans]
                        for _, spans in found
                    ],
                }
            )

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    return rows.mapInPandas(
        run,
        f"doc_id {kind}, n_words long, spans array<struct<label:string,first:long,end:long,"
        "edits:int,similarity:double,base:boolean>>",
    )
