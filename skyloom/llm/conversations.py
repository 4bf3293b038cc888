"""Repairing the turn structure of conversations by aligning them to a grammar.

A sound conversation has the role initials ``(s?(ua)+)?``.  All sound strings
of one first letter are prefixes of one alternating string, so one
Wagner-Fischer table aligns the turns to each feasible length at once; Ukkonen
bands leave out cells that cost more than the incumbent.  Of the cheapest
lengths the audits are traced back and compared.

Turns pass through a task in order.  A conversation is held in segments of
``SEGMENT`` turns; a longer one is a chain of segments, of which only the best
audit of each of the four states of the grammar goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import WHITE

#: Turns and characters held at once, and solved conversations a task remembers.
SEGMENT, CHARS, SOLVED = 512, 1 << 22, 50_000

#: Costs of the edits; an undeleted truncated turn adds ``BROKEN``.
REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60

RESULT = """key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,
audit string, repaired_sha256 string, repaired string"""


def _pair(symbol: str, target: str) -> int:
    """Cost of turning a turn into the target letter.  ``d``: only deletion; upper case: truncated."""
    if symbol == "d":
        return FAR
    broken = BROKEN if symbol.isupper() else 0
    if symbol.lower() == target:
        return broken
    return FAR if target == "s" else REROLE + broken


def _letter(first: str, at: int) -> str:
    """Letter number ``at`` of the alternating string that begins with ``first``."""
    if first == "s":
        return "s" if at == 0 else _letter("u", at - 1)
    return "ua"[(at + (first == "a")) % 2]


def greedy(symbols: str, first: str) -> tuple[int, int]:
    """Cost and length of one alignment, for the first incumbent."""
    cost, at = 0, 0
    for symbol in symbols:
        edit = _pair(symbol, _letter(first, at))
        if edit <= DELETE or edit < FAR and _letter(first, at) == "s":
            cost, at = cost + edit, at + 1
        else:
            cost += DELETE
    return cost, at


class Table:
    """Costs of aligning the first i symbols to the first j target letters, where they can be within ``bound``."""

    def __init__(self, symbols: str, first: str, bound: int):
        self.symbols, n = symbols, len(symbols)
        self.target = "".join(_letter(first, at) for at in range(n + bound // INSERT))
        self.low = [max(0, i - bound // DELETE) for i in range(n + 1)]
        self.rows: list[list[int]] = []
        for i in range(n + 1):
            self.rows.append([])
            for j in range(self.low[i], i + bound // INSERT + 1):
                self.rows[i].append(min((c for _, _, c in self.steps(i, j)), default=0 if i == j == 0 else FAR))

    def at(self, i: int, j: int) -> int:
        if i < 0 or j < self.low[i] or j - self.low[i] >= len(self.rows[i]):
            return FAR
        return self.rows[i][j - self.low[i]]

    def steps(self, i: int, j: int) -> Iterator[tuple[str, tuple[int, int], int]]:
        """Edits that end in the cell: letter, cell before, cost with it."""
        if i > 0 and (cost := self.at(i - 1, j)) < FAR:
            yield "D", (i - 1, j), cost + DELETE
        if j > self.low[i] and self.target[j - 1] != "s" and (cost := self.at(i, j - 1)) < FAR:
            yield "I", (i, j - 1), cost + INSERT
        if i > 0 and j > 0 and (cost := self.at(i - 1, j - 1)) < FAR:
            edit = _pair(self.symbols[i - 1], self.target[j - 1])
            if edit < FAR:
                yield "K" if edit % BROKEN == 0 else "R", (i - 1, j - 1), cost + edit

    def audit(self, j: int) -> str:
        """The ASCII-least cheapest audit that ends with j target letters."""
        onward: dict[tuple[int, int], dict[str, tuple[int, int]]] = {}
        layer = {(len(self.symbols), j)}
        seen = set(layer)
        while layer:  # back over all cheapest ways
            before = set()
            for cell in layer:
                for letter, source, cost in self.steps(*cell):
                    if cost == self.at(*cell):
                        onward.setdefault(source, {})[letter] = cell
                        if source not in seen:
                            seen.add(source)
                            before.add(source)
            layer = before
        cell, letters = (0, 0), []
        while cell != (len(self.symbols), j):  # and forth by the least letter
            letter = min(onward[cell])
            letters.append(letter)
            cell = onward[cell][letter]
        return "".join(letters)

    def best(self, lengths: Iterable[int]) -> tuple[int, str] | None:
        """Least cost over some target lengths, with the ASCII-least audit."""
        n = len(self.symbols)
        costs = {j: c for j in lengths if (c := self.at(n, j)) < FAR}
        least = min(costs.values(), default=FAR)
        return (least, min(self.audit(j) for j, c in costs.items() if c == least)) if costs else None


def _least(*found: tuple[int, str] | None) -> tuple[int, str] | None:
    return min((f for f in found if f), default=None)


def align(symbols: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    bounds = [DELETE * len(symbols)]
    for first in "us":
        cost, length = greedy(symbols, first)
        if first == "u" or length:
            # the length is made even after the optional s, and not s alone
            missing = length % 2 if first == "u" else 2 if length == 1 else (length + 1) % 2
            bounds.append(cost + INSERT * missing)
    bound = min(bounds)
    plain = Table(symbols, "u", bound)
    found = [plain.best(range(0, len(plain.target) + 1, 2))]
    if "s" in symbols.lower():
        led = Table(symbols, "s", bound)
        found.append(led.best(range(3, len(led.target) + 1, 2)))
    return _least(*found)


def transfers(symbols: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and audit of a segment for each state of the grammar before and after it."""

    def table(first: str) -> tuple:
        """The best of one, odd and even numbers of letters, the first apart where it is an s."""
        if first == "s" and "s" not in symbols.lower():
            return None, None, None
        aligned = Table(symbols, first, greedy(symbols, first)[0] + 2 * INSERT)
        size = len(aligned.target) + 1
        return aligned.best([1]), aligned.best(range(3 if first == "s" else 1, size, 2)), aligned.best(range(2, size, 2))

    none = (DELETE * len(symbols), "D" * len(symbols))
    _, odd, even = table("u")
    _, odd_a, even_a = table("a")
    alone, odd_s, even_s = table("s")
    result = {
        (START, START): none, (START, SYSTEM): alone, (START, USER): _least(odd, even_s),
        (START, ASSISTANT): _least(even, odd_s),
        (SYSTEM, SYSTEM): none, (SYSTEM, USER): odd, (SYSTEM, ASSISTANT): even,
        (USER, USER): _least(none, even_a), (USER, ASSISTANT): odd_a,
        (ASSISTANT, ASSISTANT): _least(none, even), (ASSISTANT, USER): odd,
    }
    return {states: found for states, found in result.items() if found}


def repaired(audit: str, state: int, turns: list[tuple[str, str]]) -> Iterator[str]:
    """The turns ``role:text`` that an audit leaves."""
    at = 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        role, text = ("assistant" if state == USER else "user", "")
        if letter != "I":
            role, text = (turns[at][0] if letter == "K" else role), turns[at][1]
            at += 1
        state = {"s": SYSTEM, "u": USER}.get(role[0], ASSISTANT)
        yield f"{role}:{text}"


class Conversation:
    """One conversation while its turns arrive in order."""

    def __init__(self, key: str, solved: dict, texts: bool):
        self.key, self.solved, self.texts = key, solved, texts
        self.symbols, self.turns, self.chars = [], [], 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.distinct = 0
        #: Per state: cost, audit, running hash, repaired turns so far.
        self.states = {START: (0, "", hashlib.sha256(), ())}
        self.whole = True

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if len(self.symbols) >= SEGMENT or self.chars > CHARS:
            self.close_segment()
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if fault:
            self.faults[fault] += 1
        symbol = initial if initial and initial in "sua" else "x"
        self.symbols.append("d" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
        self.turns.append((role, text))
        self.chars += len(text)

    def _extended(self, state: int, audit: str, cost: int) -> tuple:
        total, letters, digest, parts = self.states[state]
        digest = digest.copy()
        for line in repaired(audit, state, self.turns):
            digest.update((f"\n{line}" if state != START else line).encode("utf-8", "replace"))
            state = USER  # any but the start: from now on lines are joined
            parts = (parts, line) if self.texts else parts
        return total + cost, letters + audit, digest, parts

    def close_segment(self) -> None:
        self.whole = False
        ways: dict[int, tuple] = {}
        for (before, after), (cost, audit) in transfers("".join(self.symbols)).items():
            if before in self.states:
                total, letters, *_ = self.states[before]
                way = (total + cost, letters + audit, before, audit, cost)
                ways[after] = min(ways.get(after, way), way)
        self.states = {after: self._extended(before, audit, cost) for after, (_, _, before, audit, cost) in ways.items()}
        self.symbols, self.turns, self.chars = [], [], 0

    def result(self) -> tuple:
        if self.whole:
            symbols = "".join(self.symbols)
            if symbols not in self.solved and len(self.solved) < SOLVED:
                self.solved[symbols] = align(symbols)
            cost, audit = self.solved.get(symbols) or align(symbols)
            end = self._extended(START, audit, cost)
        else:
            if self.symbols:
                self.close_segment()
            end = min((self.states[s] for s in (START, ASSISTANT) if s in self.states), key=lambda e: e[:2])
        cost, audit, digest, parts = end
        lines = []
        while parts:
            parts, line = parts
            lines.append(line)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (self.key, gaps, *self.faults.values(), self.illegal, cost, audit, digest.hexdigest(),
                "\n".join(reversed(lines)) if self.texts else None)


def _repairs(texts: bool):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RESULT.split(",")]
        solved: dict[str, tuple[int, str]] = {}
        current = None
        for frame in frames:
            out = []
            for key, known, turn, role, text, fault, real in frame.itertuples(index=False):
                if current is None or key != current.key:
                    if current is not None:
                        out.append(current.result())
                    current = Conversation(key, solved, texts)
                if real:
                    current.add(turn if known else None, role, text, fault)
            yield pd.DataFrame(out, columns=names)
        if current is not None:
            yield pd.DataFrame([current.result()], columns=names)

    return run


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def turns_of(rows: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``conv, turn, role, text, copy, real`` with one space for null roles and texts."""
    return rows.select(
        F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        _or_space(role_col).alias("role"), _or_space(text_col).alias("text"),
        F.lit(0).alias("copy"), F.lit(True).alias("real"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """A test of repair: by the CRC of id and turn, of 20 turns one is dropped (kept as not ``real``), one
    emptied, one loses ``.!?``, one is repeated, and one becomes the user's."""
    place = F.concat(_or_space("conv"), F.lit(":"), _or_space("turn"))
    harm = F.pmod(F.crc32(place.cast("binary")), F.lit(20))
    text = F.when(harm == 1, F.lit("")).when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return turns.select(
        "conv", "turn", F.when(harm == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (harm != 0).alias("real"), F.col("role").alias("role0"), F.col("text").alias("text0"),
    )


def repair(turns: DataFrame, texts: bool = False) -> DataFrame:
    """One row per conversation of ``turns_of`` or ``damaged``: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256 and, with ``texts``, repaired.

    Turns are taken by number, nulls first, then by role, text and copy.  The
    first fault of a turn counts: blank, duplicate (role and text seen earlier
    in the conversation) or truncated (its last character that is not white is
    none of ``.!?``).  Rows without id are one conversation, whose id is null.  A
    conversation without real turns has zeros, an empty audit and the hash of
    the empty string.  An empty table gives no rows; other columns are not read.

    A conversation goes through one task, since its hash runs over its turns in
    order, but it is never collected: ``SEGMENT`` turns and four audits are held.
    """
    kind = turns.schema["conv"].dataType
    first_role, first_text = ("role0", "text0") if "role0" in turns.columns else ("role", "text")
    order = [F.col("turn").asc_nulls_first(), F.col(first_role), F.col(first_text), F.col("copy")]
    rows = turns.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("~")))
    rows = rows.repartition("key")
    again = F.row_number().over(Window.partitionBy("key", "real", "role", "text").orderBy(*order)) > 1
    bare = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(F.length(bare) == 0, F.lit("blank")).when(F.col("again"), F.lit("duplicate"))
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit("truncated"))
    )
    rows = rows.withColumn("again", again).sortWithinPartitions("key", *order)
    done = rows.select(
        "key", F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"),
        "role", "text", fault.alias("fault"), "real",
    ).mapInPandas(_repairs(texts), RESULT)
    ident = F.when(F.col("key") != "~", F.substring("key", 2, 1 << 30)).cast(kind).alias("conv_id")
    return done.select(ident, *[c for c in done.columns if c not in ("key", *([] if texts else ["repaired"]))])
