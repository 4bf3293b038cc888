"""Encoding and decoding with a merge-type sentencepiece model.

For every prefix of a run of text, the encoding has one last token, and the
encoding of the prefix before that token is itself the one of that prefix.  So
one table with the last token of each prefix holds the whole encoding.  An
automaton yields the tokens that end at each place; the one that is compatible
with the last token of the prefix before it is the entry.  Two tokens are
compatible when merging their joined text gives just these two.  The ids are
then recovered backwards from the end of the table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import text_of

SPACE = "▁"
UNKNOWN = -1


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of the model: text, rank (smaller merges first), and ids of the 256 byte pieces."""

    ids: dict[str, int]
    ranks: dict[str, float]
    bytes_: tuple[int, ...]


def read_model(path: str) -> Vocabulary:
    """The vocabulary of a merge-type model with byte fallback, identity
    normalisation and a leading space; other models are refused."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, ranks, byte_ids = {}, {}, [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_unused(i):
            raise ValueError("models with unused pieces are not supported")
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i)):
            ids[piece], ranks[piece] = i, -model.get_score(i)
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces")
    if any(c not in ids for piece in ids for c in piece):
        raise ValueError("a piece holds a character that is no piece")
    probe = "  ﬁ①  a\tb \n"
    if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("only identity normalisation with a leading space is supported")
    return Vocabulary(ids, ranks, tuple(byte_ids))


class PieceCoder:
    """Encodes runs of text; runs end where no piece can cross."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = 200_000):
        import ahocorasick

        self.ids, self.ranks, self.byte_ids = vocabulary.ids, vocabulary.ranks, vocabulary.bytes_
        self.pieces = {i: piece for piece, i in self.ids.items()}
        self.plain = {i: piece.replace(SPACE, " ").encode() for piece, i in self.ids.items()}
        self.plain |= {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.characters = {piece for piece in self.ids if len(piece) == 1}
        self.fits: dict[int, bool] = {}
        self.remembered = remembered
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.runs = re.compile(self._runs())

    def _runs(self) -> str:
        """A pattern that cuts text only where no piece can cross: before a space
        after other characters, at line feeds, and between two sets of characters
        that never stand side by side in a piece."""
        if any("\n" in piece for piece in self.ids):
            return r"(?s).+"
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            return r"\n|[^\n]+"
        beside: dict[str, set[str]] = {}
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):
                if a != SPACE:
                    beside.setdefault(a, set()).add(b)
                    beside.setdefault(b, set()).add(a)
        marks, open_ = set(), ["."]  # the characters that the full stop hangs together with
        while open_:
            c = open_.pop()
            if c not in marks:
                marks.add(c)
                open_.extend(beside.get(c, ()))
        if any(c.isalpha() for c in marks):
            return rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
        group = "".join(re.escape(c) for c in sorted(marks))
        return rf"\n|{SPACE}*[^{SPACE}\n{group}]+|{SPACE}*[{group}]+|{SPACE}+"

    def merge(self, text: str) -> list[str]:
        """Merge characters pair by pair: the best rank first, then the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (UNKNOWN: nothing that could merge with it)."""
        key = before * 1_000_000 + token
        found = self.fits.get(key)
        if found is None:
            right = self.pieces[token]
            want = [right] if before == UNKNOWN else [self.pieces[before], right]
            found = self.merge("".join(want)) == want
            if len(self.fits) >= 2_000_000:
                self.fits.clear()
            self.fits[key] = found
        return found

    def last_tokens(self, run: str) -> list[int | None]:
        """The last token of every prefix; UNKNOWN for a character outside the vocabulary."""
        last: list[int | None] = [None] * (len(run) + 1)
        if not self.characters.issuperset(run):
            for i, c in enumerate(run):
                if c not in self.characters:
                    last[i + 1] = UNKNOWN
        last[0] = UNKNOWN
        fits, compatible = self.fits, self.compatible
        for end, (token, length) in self.automaton.iter(run):
            end += 1
            if last[end] is None:
                before = last[end - length]
                if before is not None:
                    good = fits.get(before * 1_000_000 + token)
                    if compatible(before, token) if good is None else good:
                        last[end] = token
        return last

    def encode_run(self, run: str) -> list[int]:
        last, at, out = self.last_tokens(run), len(run), []
        pieces = self.pieces
        while at:
            token = last[at]
            if token == UNKNOWN:
                out.extend(self.byte_ids[b] for b in reversed(run[at - 1].encode("utf-8", "replace")))
                at -= 1
            else:
                out.append(token)
                at -= len(pieces[token])
        return out[::-1]

    def decode_ids(self, ids: Iterable[int]) -> str:
        """Text of ids; the space that stands before every text is not cut here."""
        return b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")

    def _run(self, run: str) -> tuple[str, str]:
        """Runs met lately are kept in two generations of bounded size."""
        found = self.older.get(run)
        if found is None:
            ids = self.encode_run(run)
            found = ",".join(map(str, ids)), self.decode_ids(ids)
        if len(run) <= 64:
            if len(self.known) >= self.remembered:
                self.older, self.known = self.known, {}
            self.known[run] = found
        return found

    def encode(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by commas, and the decoded text."""
        if not text:
            return "", ""
        one = self._run
        parts = [self.known.get(run) or one(run) for run in self.runs.findall(SPACE + text.replace(" ", SPACE))]
        return ",".join([ids for ids, _ in parts]), "".join([plain for _, plain in parts])[1:]


def encode_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (decimal, comma-joined) and decoded.

    With ``digests`` the last two are given as SHA-256 (ids_sha256,
    decoded_sha256), so that long texts do not travel back.  A null or empty
    text has no ids.  Repeated rows are encoded alike; an empty table gives no
    rows; other columns are not read.  The driver reads the model once and
    broadcasts its pieces (below 2 MB for 32,000 pieces).
    """
    pieces = read_model(model_path)
    # plain containers: broadcast values are pickled by reference to their classes
    sent = docs.sparkSession.sparkContext.broadcast((pieces.ids, pieces.ranks, pieces.bytes_))
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest() if digests else text

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = PieceCoder(Vocabulary(*sent.value))
        for frame in frames:
            n, ids, plain = [], [], []
            for text in frame["text"]:
                a, b = coder.encode(text)
                n.append(a.count(",") + 1 if a else 0)
                ids.append(digest(a))
                plain.append(digest(b))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_tokens": n, names[0]: ids, names[1]: plain})

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, n_tokens long, {names[0]} string, {names[1]} string")
