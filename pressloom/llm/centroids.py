"""k-means with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it. In each
round the driver measures the centroids, of bounded number, against the pivots too. By the triangle
inequality a centroid is at least as far from a vector as their distances to a pivot differ; the
largest of these differences is its lower bound. The centroid with the smallest bound is measured
exactly, then every other centroid whose bound does not exceed that distance, in integers. Tasks
return sums and counts per centroid only.

A vector counts if it has exactly ``dims`` components, none null or not finite; the others have no
row in the result. Integers beyond ``vectors.MOST`` are held there. Of centroids at equal distance the
smaller number wins. Repeated rows count each; of repeated ids the smaller vector starts a centroid
first, and rows without an id start one only if there are fewer others. With fewer vectors than ``k``
each is a centroid; an empty table gives no rows. Inertias beyond a long are null. Only the key and the
vector are read of a table, whatever else it has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import dropped, map_arrow, stored
from pressloom.llm.vectors import floor_means, integers, lists, matrix, sums

K, ROUNDS, DIMS, SEED = 40, 5, 64, "2"
#: Pivots: one list of so many distances is stored for each vector.
PIVOTS = 16
#: Pairs of a vector and a centroid that are measured at once.
_PAIRS = 1 << 14
_MOST_LONG = 2**63 - 1


class Centroids(NamedTuple):
    values: np.ndarray  # one row per centroid
    to_pivots: np.ndarray  # their distances to the pivots


def starts(table: DataFrame, k: int, seed: str, key: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    rows = table.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in rows], np.int64)


def spread(vectors: np.ndarray, n: int) -> np.ndarray:
    """Pivots: ``n`` of the vectors, each the one farthest from those before it."""
    chosen, least = [0], squared(vectors, vectors[:1])
    while len(chosen) < min(n, len(vectors)):
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(vectors, vectors[chosen[-1:]]))
    return vectors[chosen]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p[None]) for p in pivots], 1).astype(float))


def nearest(x: np.ndarray, near: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each vector the nearest centroid, its squared distance, and how many were measured."""
    bound = np.zeros((len(x), len(centroids.values)))
    for own, others in zip(near.T, centroids.to_pivots.T, strict=True):
        np.maximum(bound, np.abs(own[:, None] - others[None, :]), out=bound)
    # Roots are rounded; the slack keeps a centroid that could be as near as the best.
    bound -= 1e-9 * (1 + np.maximum(near.max(1)[:, None], centroids.to_pivots.max()))
    first = bound.argmin(1)
    best = squared(x, centroids.values[first])
    row, centroid = np.nonzero(bound <= np.sqrt(best.astype(float))[:, None])
    distance = np.empty(len(row), np.int64)
    for at in range(0, len(row), _PAIRS):
        part = slice(at, at + _PAIRS)
        distance[part] = squared(x[row[part]], centroids.values[centroid[part]])
    begin = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(distance, begin)
    hits = np.flatnonzero(distance == least[row])  # by row, then centroid
    winner = centroid[hits[np.searchsorted(row[hits], np.arange(len(x)))]]
    return winner, least, np.diff(np.append(begin, len(row)))


def _totals(table: DataFrame, centroids: Centroids) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of every centroid that has vectors."""
    k, dims = centroids.values.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                owner, _, _ = nearest(x, _near(batch.column(1)), centroids)
                count += np.bincount(owner, minlength=k)
                total += sums(owner, x, k)
        used = np.flatnonzero(count)
        yield {"cluster": used, "n": count[used], "total": lists(total[used])}

    parts = map_arrow(table.select("v", "near"), run, "cluster int, n long, total array<long>")
    added = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dims)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect()
    return {r.cluster: (r.n, [r[f"s{i}"] for i in range(dims)]) for r in rows}


def _near(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def assigned(
    embeddings: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    pivots: int = PIVOTS,
    seed: str = SEED,
    key: str = "vec_id",
    column: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """key, cluster, distance and n_measured (centroids measured exactly) per vector; the centroids."""
    kept = integers(embeddings.filter(F.size(column) == dims), key, column)
    values = starts(kept, k, seed, key)
    schema = f"{key} long, cluster int, distance long, n_measured long"
    if not len(values):
        return kept.sparkSession.createDataFrame([], schema), values
    fixed = spread(values, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                near = pivot_distances(matrix(batch.column(1)), fixed)
                yield {key: batch.column(0), "v": batch.column(1), "near": lists(near)}

    table = stored(map_arrow(kept, measure, f"{key} long, v array<int>, near array<double>"))
    for _ in range(rounds):
        found = _totals(table, Centroids(values, pivot_distances(values, fixed)))
        values = np.array([floor_means(found[c][1], found[c][0]) if c in found else v for c, v in enumerate(values.tolist())], np.int64)
    last = Centroids(values, pivot_distances(values, fixed))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                owner, distance, n = nearest(matrix(batch.column(1)), _near(batch.column(2)), last)
                yield {key: batch.column(0), "cluster": owner, "distance": distance, "n_measured": n}

    result = stored(map_arrow(table.select(key, "v", "near"), assign, schema))
    dropped(table)
    return result, values


def clustered(embeddings: DataFrame, **options) -> DataFrame:
    """vec_id, cluster and distance per vector, with the inertia and a digest of its centroid."""
    rows, values = assigned(embeddings, **options)
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    own = {r.cluster: int(r.inertia) for r in rows.groupBy("cluster").agg(total).collect()}
    long = lambda n: n if n <= _MOST_LONG else None
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in values.tolist()]
    summary = [(c, long(n), long(sum(own.values())), digest[c]) for c, n in own.items()]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    summary = rows.sparkSession.createDataFrame(summary, schema)  # at most k rows
    return rows.drop("n_measured").join(F.broadcast(summary), "cluster")
