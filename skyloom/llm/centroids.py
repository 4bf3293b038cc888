"""Centroid clustering with exact assignment by the threshold algorithm.

Every dimension keeps its centroids in a sorted list.  A vector walks all lists
outward from its own value, always to the nearer side; each centroid met is
measured exactly.  A centroid not met yet is at least as far in every dimension
as the frontier there, so the walk ends when the sum of the squared frontier
distances strictly exceeds the best exact distance, which keeps ties.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import written

#: Vectors walked together.
SLICE = 4096


def largest(dims: int) -> int:
    """The bound of components whose squared distances fit a long."""
    return 1 << ((62 - (dims - 1).bit_length()) // 2 - 1)


def nearest_centroids(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid (ties: smallest number), and the distances taken."""
    n, (k, dims) = len(vectors), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    right = np.empty((n, dims), dtype=np.int64)
    for d in range(dims):
        right[:, d] = np.searchsorted(values[:, d], vectors[:, d])
    left = right - 1
    column, far = np.arange(dims), np.iinfo(np.int64).max
    best, number, measured = np.full(n, far), np.full(n, k), 0
    met = np.zeros((n, k), dtype=bool)
    active = np.arange(n)
    for _ in range(k):
        x, a, b = vectors[active], left[active], right[active]
        below = np.where(a >= 0, x - values[np.maximum(a, 0), column], far)
        above = np.where(b < k, values[np.minimum(b, k - 1), column] - x, far)
        down = below <= above
        new = np.zeros((len(active), k), dtype=bool)
        new[np.arange(len(active))[:, None], order[np.where(down, a, b), column]] = True
        new &= ~met[active]
        met[active] |= new
        left[active], right[active] = a - down, b + ~down
        i, c = np.nonzero(new)
        measured += len(i)
        distance = np.full((len(active), k), far)
        distance[i, c] = ((x[i] - centroids[c]) ** 2).sum(axis=1)
        candidate = distance.argmin(axis=1)
        least = distance[np.arange(len(active)), candidate]
        better = (least < best[active]) | ((least == best[active]) & (candidate < number[active]))
        best[active] = np.where(better, least, best[active])
        number[active] = np.where(better, candidate, number[active])
        active = active[(np.minimum(below, above) ** 2).sum(axis=1) <= best[active]]
        if not len(active):
            break
    return number, best, measured


def _slices(frames: Iterable[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for frame in frames:
        for at in range(0, len(frame), SLICE):
            part = frame.iloc[at : at + SLICE]
            yield part, np.stack(part["v"].to_numpy()).astype(np.int64)


def _sums(centroids: np.ndarray) -> Callable:
    """Per task and centroid met: vectors and componentwise sums; as many rows as centroids at most."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=np.int64)
        for _, vectors in _slices(frames):
            number, _, _ = nearest_centroids(vectors, centroids)
            count += np.bincount(number, minlength=len(centroids))
            np.add.at(sums, number, vectors)
        some = np.flatnonzero(count)
        yield pd.DataFrame({"cluster": some, "n": count[some], "total": list(sums[some])})

    return run


def _assigned(centroids: np.ndarray) -> Callable:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, vectors in _slices(frames):
            number, distance, _ = nearest_centroids(vectors, centroids)
            yield pd.DataFrame({"id": part["id"], "cluster": number, "distance": distance})

    return run


def grid_vectors(vectors: DataFrame, dims: int, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``id`` (as text) and ``v``, the components as integers floor(scale * x), of the vectors that can take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    v = F.transform(x, lambda c: F.floor(F.lit(scale) * c))
    usable = F.coalesce(F.size(x) == dims, F.lit(False)) & F.coalesce(
        F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < largest(dims))), F.lit(False)
    )
    return vectors.where(usable).select(F.col(f"`{id_col}`").cast("string").alias("id"), v.alias("v"))


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: float = 64.0,
    seed: str = "1:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector: id, cluster, distance, centroid, cluster_inertia, inertia.

    A vector takes part if it has ``dims`` components, none null or non-finite
    or so large that squared distances would not fit a long (see ``largest``).
    The first centroids are those with the least sha256 of ``seed`` and id;
    vectors without id start none but are assigned.  Equal ids are ordered by
    their components.  With fewer vectors than ``k`` there are fewer centroids;
    if no vector has an id, or the table is empty, there are no rows.  A
    centroid without vectors stays.  Repeated rows count each; other columns
    are not read.  The driver holds k centroids and their sums only.
    """
    kind = vectors.schema[id_col].dataType
    kept = written(grid_vectors(vectors, dims, scale, id_col, vector_col), "vectors")
    first = (
        kept.where("id IS NOT NULL").withColumn("hash", F.sha2(F.concat(F.lit(seed), "id"), 256))
        .orderBy("hash", "id", "v").limit(k).collect()
    )
    centroids = np.array([r.v for r in first], dtype=np.int64).reshape(len(first), dims)
    schema = "id string, cluster int, distance long"
    if len(centroids):
        for _ in range(rounds):
            sums = kept.mapInPandas(_sums(centroids), "cluster int, n long, total array<long>")
            big = "decimal(38,0)"
            rows = sums.select("cluster", "n", F.posexplode("total").alias("d", "s")).groupBy("cluster", "d").agg(
                F.sum(F.col("n").cast(big)).alias("n"), F.sum(F.col("s").cast(big)).alias("s")
            )
            for r in rows.collect():  # k * dims rows
                centroids[r.cluster, r.d] = int(r.s) // int(r.n)
        found = written(kept.mapInPandas(_assigned(centroids), schema), "clusters")
    else:
        found = kept.sparkSession.createDataFrame([], schema)
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def long(value: int) -> Column:
        return F.lit(value if value < 1 << 63 else None).cast("long")

    def of_cluster(values: list[Column]) -> Column:
        return F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)

    return found.select(
        F.col("id").cast(kind).alias("id"), "cluster", "distance",
        of_cluster([F.array(*[F.lit(int(c)) for c in row]) for row in centroids]).cast("array<long>").alias("centroid"),
        of_cluster([long(inertia.get(c, 0)) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        long(sum(inertia.values())).alias("inertia"),
    )
