"""Centroid clustering of integer vectors by scalar lookup tables.

In each round a batch tabulates, for each dimension, the squared difference of each occurring integer
value to each centroid. The distances of its vectors are then sums of gathered table rows. Tasks return sums by
centroid, so only the centroids themselves reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import stored

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
#: Beyond this a sum of squared differences would not fit 64 bits; such a component is an error.
LARGEST = 1 << 27
#: Vectors whose table rows are summed at a time.
BLOCK = 4096


def integer_vectors(table: DataFrame, column: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>): the vectors of exactly ``dimensions`` finite components, each as floor(scale * x).

    Others are left out. A component beyond LARGEST after scaling is an error, not another number.
    """
    x = F.col(column).cast("array<double>")
    usable = (F.size(x) == dimensions) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    )
    whole = F.transform(x, lambda e: F.floor(e * scale))
    fits = F.forall(x, lambda e: F.abs(e * scale) <= LARGEST)
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST} / {scale}")).cast("array<long>"))
    return table.where(usable).select(F.col("vec_id").cast("long"), checked.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = "2") -> np.ndarray:
    """Vectors of the least sha256 of ``salt:vec_id``, in that order; fewer if there are fewer.

    Rows that share a vec_id stand in the order of their components, rows without one come last.
    """
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(mark.alias("mark"), "v").orderBy(F.asc_nulls_last("mark"), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector (rows of integers) to each centroid, by lookup tables."""
    total = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        values, place = np.unique(vectors[:, d], return_inverse=True)
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += table[place]
    return total


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(start, BLOCK)
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            v = flat.astype(np.int64).reshape(batch.num_rows, -1)
            far = distances(v, centroids)
            best = far.argmin(axis=1)  # the first of equals
            yield batch, v, best, far[np.arange(len(v)), best]


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the exact mean of their vectors; empty ones stay."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, v, best, _ in _assigned(batches, centroids):
            np.add.at(sums, best, v)
            counts += np.bincount(best, minlength=len(centroids))
        full = np.flatnonzero(counts)
        where, dims = np.repeat(full, size), np.tile(np.arange(size), len(full))
        yield pa.RecordBatch.from_arrays(
            [pa.array(where), pa.array(dims), pa.array(sums[full].ravel()), pa.array(np.repeat(counts[full], size))],
            ["cluster", "d", "total", "n"],
        )

    parts = vectors.select("v").mapInArrow(run, "cluster long, d long, total long, n long")
    exact = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    out = centroids.copy()
    # one row for each centroid and dimension
    for r in parts.groupBy("cluster", "d").agg(exact, F.sum("n").alias("n")).collect():
        out[r["cluster"], r["d"]] = int(r["total"]) // r["n"]
    return out


def clusters(
    table: DataFrame,
    column: str = "embedding",
    dimensions: int = DIMENSIONS,
    count: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``table(vec_id, column)`` -> (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Every usable vector (see :func:`integer_vectors`) is assigned to its nearest of ``count`` centroids after ``rounds``
    rounds; the smaller number wins ties. ``cluster_inertia`` and ``inertia`` are the distances summed
    over its cluster and over all. Repeated rows and rows without vec_id count and come out as often as given; with fewer
    vectors than ``count`` there are as many centroids as vectors; null, short, long and non-finite vectors are left out; an
    empty table gives no row. Other columns are dropped.
    """
    vectors = stored(integer_vectors(table, column, dimensions, scale), "integer-vectors")
    # without vectors nothing is assigned to the one that stands in
    centroids = first_centroids(vectors, count).reshape(-1, dimensions)
    if not len(centroids):
        centroids = np.zeros((1, dimensions), np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, far in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"]
            )

    near = stored(vectors.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    # one row for each centroid at most
    totals = dict(near.groupBy("cluster").agg(F.sum("distance")).collect())
    known = {k: (totals[k], marks[k]) for k in totals}
    session = table.sparkSession
    rows = [(k, *v, sum(totals.values())) for k, v in known.items()]
    facts = session.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string, inertia long")
    return near.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
