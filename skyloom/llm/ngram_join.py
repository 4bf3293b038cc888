"""Near-duplicate join of documents on the Jaccard similarity of their word shingles.

A MinHash LSH forest finds candidates.  Every tree orders the signatures by a
string of minimum hashes; documents that share a long prefix in a tree meet
there.  The matched prefix is shortened step by step until the share of similar
pairs that it is expected to find reaches the target recall.

Documents with one set of shingles are one vertex, so copies cost one row.
Candidates are joined to clusters through signatures alone; within a cluster
every pair is verified on its whole shingle sets, in blocks of bounded size.
Pairs never leave the task that verifies them: it returns counts of links and a
star per connected part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import mixed, shingles, slices, text_of, written
from skyloom.llm.components import components

TREES, DEPTH = 32, 6

#: Signatures in one block, sets in one block, and shingles in one block.
BLOCK, SETS, SHINGLES = 1024, 256, 1_000_000

_draw = np.random.default_rng(11)
_A = _draw.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_B = _draw.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def minhash(hashes: np.ndarray) -> np.ndarray:
    """Least values of TREES * DEPTH hash functions over a set of 64-bit shingle hashes, 16 bits of each."""
    least = np.full(len(_A), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), 256):
        part = hashes[at : at + 256, None] * _A + _B
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(row, id, mark, n, set, sig): hash of the text, number of shingles, identity of their set, signature; stored."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in slices(frames, "text", 4_000_000):
            sets = [shingles(text, words) for text in rows["text"]]
            yield pd.DataFrame(
                {
                    "row": rows["row"], "id": rows["id"].astype("Int64"), "mark": rows["mark"], "n": [len(s) for s in sets],
                    "set": [set_key(s) for s in sets], "sig": [minhash(s).tobytes() if len(s) else None for s in sets],
                }
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
        text_of(f"`{text_col}`").alias("text"), F.xxhash64(text_of(f"`{text_col}`")).alias("mark"),
    )
    return written(rows.mapInPandas(run, "row long, id long, mark long, n long, set binary, sig binary"), "signatures")


def grouped(frames: Iterable[pd.DataFrame], key: str, step: Callable[[pd.DataFrame], pd.DataFrame | None]) -> Iterator[pd.DataFrame]:
    """Apply ``step`` to the runs of equal ``key`` in a sorted partition."""
    held: list[pd.DataFrame] = []

    def groups(frame):
        cuts = np.concatenate([[0], np.flatnonzero(frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]) + 1, [len(frame)]])
        return [frame.iloc[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def results(parts):
        out = [r for part in parts if (r := step(part)) is not None and len(r)]
        return pd.concat(out, ignore_index=True) if out else None

    for frame in frames:
        if not len(frame):
            continue
        parts = groups(frame)
        if held and held[0][key].iloc[0] == parts[0][key].iloc[0]:
            held.append(parts.pop(0))
        if not parts:
            continue
        done = ([pd.concat(held, ignore_index=True)] if held else []) + parts[:-1]
        held = [parts[-1]]
        if (made := results(done)) is not None:
            yield made
    if held and (made := results([pd.concat(held, ignore_index=True)])) is not None:
        yield made


def _parts(adjacent: np.ndarray) -> np.ndarray:
    """Least index reachable from each vertex of a small graph."""
    n = len(adjacent)
    label = np.arange(n)
    adjacent = adjacent | np.eye(n, dtype=bool)
    while True:
        least = np.where(adjacent, label[None, :], n).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """Chance that a pair shares a prefix of ``depth`` in one of the trees."""
    return 1 - (1 - similarity**depth) ** trees


def _candidate_step(cut: float, threshold: float, depth: int):
    """Within one block of signatures: a star per connected part, and how many
    similar pairs are seen and expected."""

    def step(rows: pd.DataFrame) -> pd.DataFrame | None:
        ids, side = rows["rep"].to_numpy(), rows["side"].to_numpy()
        if side[0] and (side == side[0]).all():  # the other part is empty
            return None
        sig = np.frombuffer(b"".join(rows["sig"]), dtype=np.uint16).reshape(len(rows), -1)
        equal = np.zeros((len(rows), len(rows)), dtype=np.uint16)
        for column in sig.T:
            equal += column[:, None] == column[None, :]
        near = equal >= cut * sig.shape[1]
        np.fill_diagonal(near, False)
        if side[0]:  # pairs within a side belong to that side's own block
            near &= side[:, None] != side[None, :]
        if not near.any():
            return None
        seen = equal[np.triu(near)] / sig.shape[1]
        seen = np.clip(seen[seen >= threshold], threshold, 1)
        label = _parts(near)
        move = label != np.arange(len(rows))
        out = pd.DataFrame({"u": ids[label[move]], "v": ids[move], "seen": 0.0, "due": 0.0})
        out.loc[0, ["seen", "due"]] = float(len(seen)), float((1 / recall(seen, depth)).sum())
        return out

    return step


def _blocks(members: DataFrame, group: Column, parts: Column, key: Column) -> DataFrame:
    """Rows of a group dealt to pairs of its parts: ``block`` and ``side``; one block if it has one part.

    A row goes to as many blocks as its group has parts, none of which holds
    more than two parts.  ``side`` is 0 in the block of one part, else 1 or 2, so
    that a block of two parts is known even where one of them is empty.
    """
    part = F.pmod(F.xxhash64(key, F.lit(3)), parts)
    dealt = members.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return dealt.withColumns(
        {
            "block": F.xxhash64(group, F.least("part", "other"), F.greatest("part", "other")),
            "side": F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2),
        }
    )


def _candidates(reps: DataFrame, depth: int, cut: float, threshold: float) -> DataFrame:
    """Stars over representatives (rep, sig) that share ``depth`` values in a tree."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.xxhash64(t, F.substring("sig", t * (2 * DEPTH) + 1, F.lit(2 * depth))),
    )
    places = reps.select("rep", F.explode(keys).alias("key"))
    groups = (
        places.groupBy("key").agg(
            F.count("*").alias("m"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.min("rep").alias("y")
        )
        .where("m > 1")
        # trees often agree on a whole group: it is looked at once
        .groupBy("m", "x", "y").agg(F.min("key").alias("key"))
    )
    members = places.join(groups.select("key", "m"), "key").distinct().join(reps, "rep")
    parts = F.ceil(F.col("m") / BLOCK).cast("long")
    blocks = _blocks(members, F.col("key"), parts, F.col("rep")).select("block", "side", "rep", "sig")
    step = _candidate_step(cut, threshold, depth)
    # after a shuffle by block, the rows of a block follow each other
    dealt = blocks.repartition("block").sortWithinPartitions("block", "side", "rep")
    return dealt.mapInPandas(lambda frames: grouped(frames, "block", step), "u long, v long, seen double, due double")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a block, by products of column stretches."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    column = np.cumsum(np.diff(value, prepend=value[:1]) != 0)
    shared = np.bincount(column) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 8192
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            table = np.zeros((len(sets), width), dtype=np.float32)
            table[owner[a:b], column[a:b] - k * width] = 1
            total += table @ table.T
    return total


def _verify_step(threshold: float):
    """Within one block of whole sets: links of each set (weighted by copies), and stars of linked parts."""

    def step(rows: pd.DataFrame) -> pd.DataFrame | None:
        ids, side, copies = rows["rep"].to_numpy(), rows["side"].to_numpy(), rows["copies"].to_numpy()
        if side[0] and (side == side[0]).all():  # the other part is empty
            return None
        sets = [np.frombuffer(b, dtype=np.uint64) for b in rows["sets"]]
        both = intersections(sets)
        size = np.array([len(s) for s in sets], dtype=np.float64)
        linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if side[0]:
            linked &= side[:, None] != side[None, :]
        if not linked.any():
            return None
        use = linked.any(axis=1)
        label = _parts(linked)
        return pd.DataFrame({"rep": ids[use], "links": (linked @ copies)[use].astype(np.int64), "root": ids[label[use]]})

    return step


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    threshold: float = 0.8,
    target: float = 0.9999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, row, mark (hash of the text), class_id, class_row, class_size, n_links.

    Two documents are linked when the Jaccard similarity of their sets of
    ``words``-word shingles is at least ``threshold``; words are those of the
    licence scan.  A class is a connected component of links; its id is the
    least doc_id (null last) of its rows.  ``n_links`` counts linked documents,
    copies included.  Fewer words than ``words`` make one shingle; a text
    without words (or null) is a class of its own with no links.  Repeated rows
    are copies of each other; an empty table gives no rows; other columns are
    not read.
    """
    table = signatures(docs, words, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("row").alias("c"), "mark")
    sets = written(
        table.where("n > 0").groupBy("set").agg(F.min(order).alias("least"), F.count("*").alias("copies"))
        .select("set", F.col("least.c").alias("rep"), F.col("least.b").alias("rep_id"), F.col("least.mark").alias("rep_mark"), "copies"),
        "sets",
    )
    reps = table.where("n > 0").select(F.col("row").alias("rep"), "sig").join(sets.select("rep"), "rep")
    reps = written(reps, "representatives")
    stars, seen, due, depth = None, 0.0, 0.0, DEPTH
    while True:
        found = written(_candidates(reps, depth, threshold - 0.2, threshold), "candidates")
        sums = found.agg(F.sum("seen").alias("seen"), F.sum("due").alias("due")).first()
        seen, due = sums.seen or 0.0, sums.due or 0.0
        edges = found.select("u", "v")
        stars = edges if stars is None else stars.union(edges)
        if depth == 1 or (recall(threshold, depth) >= target and (due == 0 or seen / due >= target)):
            break
        depth -= 1
    clusters = components(stars).select(F.col("v").alias("rep"), F.col("root").alias("cluster"))
    clustered = written(clusters.join(sets, "rep"), "clusters")
    linked = _verified(docs, table, clustered, words, threshold, id_col, text_col)
    classes = components(linked.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    of_set = (
        sets.join(classes.select(F.col("v").alias("rep"), "root"), "rep", "left").join(links, "rep", "left")
        .select("set", "rep", "rep_id", "copies", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    of_set = written(of_set, "classes")
    least = F.min(F.struct(F.col("rep_id").isNull().alias("a"), F.col("rep_id").alias("b"), F.col("rep").alias("c")))
    sizes = of_set.groupBy("root").agg(F.sum("copies").alias("size"), least.alias("least"))
    of_set = of_set.join(sizes, "root").select(
        "set", F.col("least.b").alias("class_id"), F.col("least.c").alias("class_row"), F.col("size").alias("class_size"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
    )
    light = table.select("row", "id", "mark", "n", "set")
    joined = light.where("n > 0").join(of_set, "set").select(
        F.col("id").alias("doc_id"), "row", "mark", "class_id", "class_row", "class_size", "n_links"
    )
    alone = light.where("n = 0").select(
        F.col("id").alias("doc_id"), "row", "mark", F.col("id").alias("class_id"), F.col("row").alias("class_row"),
        F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"),
    )
    return joined.unionByName(alone)


def _verified(docs, table, clustered, words: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(rep, links, root): exact links within clusters, stored."""
    wanted = clustered.select("rep_id", "rep_mark", F.col("set").alias("wanted"), "rep", "cluster", "copies")
    text = text_of(f"`{text_col}`")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    # one plan at every size: the clustered side grows with the corpus, so it is never broadcast
    # an id may be null or repeat, so a text meets its own representative by its hash too
    own = F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("mark") == F.col("rep_mark"))
    texts = texts.join(wanted.hint("merge"), own).select("text", "wanted", "rep", "cluster", "copies")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in slices(frames, "text", 2_000_000):
            sets = [shingles(text, words) for text in rows["text"]]
            good = np.array([set_key(s) == bytes(w) for s, w in zip(sets, rows["wanted"])], dtype=bool)
            out = rows.loc[good, ["rep", "cluster", "copies"]].copy()
            out["n"] = [len(s) for s, g in zip(sets, good) if g]
            out["sets"] = [s.tobytes() for s, g in zip(sets, good) if g]
            yield out

    shape = "rep long, cluster long, copies long, n long, sets binary"
    members = texts.mapInPandas(run, shape)
    members = written(members, "shingles").dropDuplicates(["rep"])  # an id that repeats brings a text twice
    sums = members.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1")
    parts = F.greatest(F.ceil(F.col("m") / SETS), F.ceil(F.col("total") / SHINGLES)).cast("long")
    members = members.join(sums, "cluster")
    blocks = _blocks(members, F.col("cluster"), parts, F.col("rep")).select("block", "side", "rep", "copies", "sets")
    step = _verify_step(threshold)
    dealt = blocks.repartition("block").sortWithinPartitions("block", "side", "rep")
    return written(
        dealt.mapInPandas(lambda frames: grouped(frames, "block", step), "rep long, links long, root long"), "links"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, the one whose id names it; all columns kept."""
    classes = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    stay = classes.where("row = class_row").groupBy("doc_id", "mark").agg(F.count("*").alias("times"))
    packed = docs.select(
        F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.xxhash64(text_of(f"`{text_col}`")).alias("seen"),
    )
    kept = packed.join(stay, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("seen") == F.col("mark")))
    # more than one row only where the table repeats an id with its text
    nth = F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy("id"))
    return kept.withColumn("nth", nth).where("nth <= times").select("row.*")
