"""Nearest neighbours by inner product on a forest of hash-prefix trees.

A tree gives every vector a long string of bits, the signs of its products with
random directions, and is the sorted array of these strings.  A query descends
to the longest prefix it shares with the array.  Then it ascends in all trees
together, one bit at a time, until it has met enough candidates; these are
scored exactly.  How many are enough is learned from a bounded sample of
queries compared with every row.

Trees are cut at a short prefix into cells, and large cells into parts, so that
a task holds a bounded stretch of a sorted array.  Equal vectors are one entry.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import written

TREES, BITS = 32, 32

#: Entries and queries of one cell that meet in one task.
PART, QUERIES = 16384, 4096


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v: doubles) of vectors that are finite, not zero, and of the most frequent length."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    ).where("id is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)).distinct()
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0].n if lengths else 0))


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: key, v, norm2, and the k + 1 smallest ids that have it.
    No other id of the vector can be among k nearest."""
    rows = rows.select("id", "v", F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"))
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return few.groupBy("a", "b").agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v")
    ).select(F.col("ids")[0].alias("key"), "a", "b", "ids", "v", norm2.alias("norm2"))


def _strings(entries: DataFrame, planes: np.ndarray, most: float) -> DataFrame:
    """(key, ids, v as bytes of doubles, point: strings as an entry, query: strings as a
    query).  An entry gets one more coordinate that brings all to one length, so
    that the nearest by angle is the largest by inner product."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).astype(np.int64)
        for rows in frames:
            if not len(rows):
                continue
            x = np.stack(rows["v"].to_numpy())
            rest = np.sqrt(np.maximum(most - rows["norm2"].to_numpy(), 0))[:, None]
            plain = x @ planes[:-1]
            as_entry = ((plain + rest * planes[-1]) > 0).reshape(len(x), TREES, BITS) @ weights
            as_query = (plain > 0).reshape(len(x), TREES, BITS) @ weights
            yield pd.DataFrame(
                {
                    "key": rows["key"], "ids": rows["ids"], "v": [r.tobytes() for r in x],
                    "point": list(as_entry), "query": list(as_query),
                }
            )

    shape = "key long, ids array<long>, v binary, point array<long>, query array<long>"
    return entries.select("key", "ids", "v", "norm2").mapInPandas(run, shape)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of bit strings."""
    different = (a ^ b).astype(np.float64)  # below 2**53, so exact
    return np.where(different == 0, BITS, BITS - np.floor(np.log2(np.maximum(different, 1))) - 1).astype(np.int64)


def _budget(entries: DataFrame, queries: DataFrame, k: int, target: float, size: int) -> tuple[int, int]:
    """(candidates that are enough, depth to start from), learned on at most ``size``
    queries, each compared with every entry."""
    picked = queries.orderBy(F.xxhash64("key"), "key").limit(size).collect()
    if not picked:
        return 1, 0
    q = np.stack([np.frombuffer(r.v) for r in picked])
    strings = np.array([r.query for r in picked])
    keys = np.array([r.key for r in picked])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels = np.zeros((len(q), BITS + 1), np.int64)
        best: list[list[tuple[float, int]]] = [[] for _ in q]
        for rows in frames:
            if not len(rows):
                continue
            x = np.stack([np.frombuffer(b) for b in rows["v"]])
            points = np.stack(rows["point"].to_numpy())
            own = rows["key"].to_numpy()
            for i in range(len(q)):
                match = _shared(points, strings[i][None, :])
                levels[i] += np.bincount(match.ravel(), minlength=BITS + 1)
                score = np.where(own == keys[i], -np.inf, x @ q[i])
                top = np.argpartition(-score, min(k, len(score) - 1))[:k]
                best[i] = sorted(best[i] + [(float(score[j]), int(match[j].max())) for j in top], reverse=True)[:k]
        yield pd.DataFrame(
            {
                "i": range(len(q)), "levels": list(levels), "score": [[s for s, _ in b] for b in best],
                "match": [[m for _, m in b] for b in best],
            }
        )

    found = entries.select("key", "v", "point").mapInPandas(
        run, "i int, levels array<long>, score array<double>, match array<int>"
    )
    # one row per sampled query and task, then one per sampled query
    zipped = found.withColumn("x", F.arrays_zip("score", "match"))
    tops = zipped.groupBy("i").agg(F.slice(F.sort_array(F.flatten(F.collect_list("x")), False), 1, k).alias("x")).collect()
    counts = (
        zipped.select("i", F.posexplode("levels").alias("level", "n")).groupBy("i", "level").agg(F.sum("n").alias("n")).collect()
    )
    level = np.zeros((len(q), BITS + 1), np.int64)
    for r in counts:
        level[r.i, r.level] = r.n
    at_least = level[:, ::-1].cumsum(axis=1)[:, ::-1]  # candidates met at each depth, over all trees
    match = {r.i: np.array([x.match for x in r.x if np.isfinite(x.score)]) for r in tops}
    enough = 1
    while True:
        depth = np.array([np.flatnonzero(row >= min(enough, row[0])).max() for row in at_least])
        hits = [(m >= depth[i]) for i, m in match.items() if len(m)]
        if not hits or np.concatenate(hits).mean() >= target or (depth == 0).all():
            return enough, int(max(0, np.quantile(depth, 0.1)))
        enough = max(enough + 1, int(enough * 1.25))


def _meet(points: DataFrame, queries: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Entries and queries dealt to (tree, cell, part): every query of a cell meets every entry of it."""
    shift = BITS - depth
    trees = TREES if depth else 1

    def placed(df, column):
        each = df.select("*", F.posexplode(F.slice(column, 1, trees)).alias("tree", "string")).drop("point", "query")
        return each.withColumn("cell", F.shiftright("string", shift))

    p, q = placed(points, "point"), placed(queries, "query")
    sizes = p.groupBy("tree", "cell").agg(F.count("*").alias("np")).join(
        q.groupBy("tree", "cell").agg(F.count("*").alias("nq")), ["tree", "cell"]
    )
    sizes = sizes.select(
        "tree", "cell", F.ceil(F.col("np") / PART).cast("long").alias("pp"), F.ceil(F.col("nq") / QUERIES).cast("long").alias("qp")
    )
    p = p.join(sizes, ["tree", "cell"])
    p = p.withColumn("pi", F.pmod(F.xxhash64("key"), F.col("pp"))).withColumn("qi", F.explode(F.sequence(F.lit(0), F.col("qp") - 1)))
    q = q.join(sizes, ["tree", "cell"])
    q = q.withColumn("qi", F.pmod(F.xxhash64("key"), F.col("qp"))).withColumn("pi", F.explode(F.sequence(F.lit(0), F.col("pp") - 1)))
    return p.drop("pp", "qp"), q.drop("pp", "qp")


def _ranges(array: np.ndarray, strings: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretch of a sorted array that shares the first ``depth`` bits of each string."""
    shift = (BITS - depth).astype(np.int64)
    low = (strings >> shift) << shift
    return np.searchsorted(array, low), np.searchsorted(array, low + (np.int64(1) << shift))


def _count_cell(floor: int):
    def step(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(q):
            return pd.DataFrame({"key": pd.Series(dtype="int64"), "counts": pd.Series(dtype=object)})
        array, strings = np.sort(p["string"].to_numpy()), q["string"].to_numpy()
        counts = np.zeros((len(q), BITS + 1 - floor), np.int64)
        for depth in range(floor, BITS + 1):
            a, b = _ranges(array, strings, np.full(len(q), depth))
            counts[:, depth - floor] = b - a
        return pd.DataFrame({"key": q["key"], "counts": list(counts)})

    return step


def _score_cell(k: int):
    def step(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        kinds = {"query": "int64", "key": "int64", "ids": object, "score": "float64"}
        none = pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
        if not len(p) or not len(q):
            return none
        order = np.argsort(p["string"].to_numpy(), kind="stable")
        array, key, ids = p["string"].to_numpy()[order], p["key"].to_numpy()[order], p["ids"].to_numpy()[order]
        x = np.frombuffer(b"".join(p["v"].to_numpy()[order])).reshape(len(p), -1)
        vectors = np.frombuffer(b"".join(q["v"])).reshape(len(q), -1)
        a, b = _ranges(array, q["string"].to_numpy(), q["depth"].to_numpy())
        out_q, out_p, out_s = [], [], []
        for i, own in enumerate(q["key"].to_numpy()):
            if b[i] > a[i]:
                near = x[a[i] : b[i]] @ vectors[i]
                top = np.argpartition(-near, k + 9)[: k + 10] if len(near) > k + 10 else np.arange(len(near))
                at = a[i] + top
                score = (x[at] * vectors[i]).sum(axis=1)  # the same bits wherever this pair meets
                best = np.lexsort((key[at], -score))[: k + 1]
                out_q.append(np.full(len(best), own))
                out_p.append(at[best])
                out_s.append(score[best])
        if not out_q:
            return none
        at = np.concatenate(out_p)
        return pd.DataFrame(
            {"query": np.concatenate(out_q), "key": key[at], "ids": list(ids[at]), "score": np.concatenate(out_s)}
        )

    return step


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    target: float = 0.95,
    sample: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest of each query (id divisible by ``every``): query_id, rank, vec_id, score.

    Candidates are all rows but the query's own; nearness is the inner product
    in double precision, ties go to the smaller id.  Vectors that are null,
    zero, hold null or non-finite components, have a null id or another length
    than most take no part.  Repeated rows count once.  With fewer than ``k``
    candidates all are returned; an empty table gives no rows; other columns
    are not read.  ``target`` is the recall aimed at on ``sample`` queries.
    """
    rows = written(_usable(vectors, id_col, vector_col), "vectors")
    entries = written(_entries(rows, k), "distinct")
    top = entries.agg(F.max("norm2").alias("most"), F.max(F.size("v")).alias("n"), F.count("*").alias("rows")).first()
    dims = top.n or 0
    planes = np.random.default_rng(3).standard_normal((dims + 1, TREES * BITS))
    points = written(_strings(entries, planes, top.most or 0.0), "forest")
    asked = rows.where(F.pmod("id", F.lit(every)) == 0).select(
        F.col("id").alias("query_id"), F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b")
    )
    asked = written(asked.join(entries.select("key", "a", "b"), ["a", "b"]).select("query_id", "key"), "asked")
    queries = written(points.join(asked.select("key").distinct(), "key").select("key", "v", "query"), "queries")
    enough, depth = _budget(points, queries, k, target, sample)
    least = min(enough, TREES * top.rows) if top.rows else 0
    if top.rows <= k + 1:  # only the root holds k others
        depth = 0
    found, open_ = None, queries
    while True:
        cell = ["tree", "cell", "pi", "qi"]
        if depth:
            light_p, light_q = _meet(points.select("key", "point"), open_.select("key", "query"), depth)
            counts = light_p.groupBy(cell).cogroup(light_q.groupBy(cell)).applyInPandas(
                _count_cell(depth), "key long, counts array<long>"
            )
            sums = counts.select("key", F.posexplode("counts").alias("up", "n")).groupBy("key", "up").agg(F.sum("n").alias("n"))
            # the deepest level, the same in all trees, at which enough candidates are met
            deepest = sums.where(F.col("n") >= least).groupBy("key").agg((F.max("up") + depth).cast("long").alias("depth"))
            ready = open_.join(written(deepest, "depths"), "key")
        else:  # at the root everything is met
            ready = open_.withColumn("depth", F.lit(0).cast("long"))
        p, q = _meet(points.select("key", "ids", "v", "point"), ready, depth)
        hits = p.groupBy(cell).cogroup(q.groupBy(cell)).applyInPandas(
            _score_cell(k), "query long, key long, ids array<long>, score double"
        )
        hits = written(hits.groupBy("query", "key").agg(F.max("score").alias("score"), F.first("ids").alias("ids")), "hits")
        # a query that met fewer than k others ascends further
        met = hits.groupBy("query").agg(F.sum(F.size("ids")).alias("met"))
        full = met.where(F.col("met") > k) if depth else met
        done = hits.join(full.select("query"), "query", "left_semi")
        found = done if found is None else found.unionByName(done)
        if depth == 0:
            break
        open_ = written(open_.join(full.select(F.col("query").alias("key")), "key", "left_anti"), "open")
        if not open_.take(1):
            break
        depth = max(0, depth - 2)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    few = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    each = few.select(F.col("query").alias("key"), F.explode("ids").alias("vec_id"), "score").join(asked, "key")
    each = each.where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
