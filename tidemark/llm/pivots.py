"""Clusters around centroids, found with a table of distances to fixed pivots (LAESA).

The distances of every vector to a few fixed pivots are measured once and stored with it. In every round the distances of the centroids to the
pivots are measured on the driver, and by the triangle inequality the difference of two such distances is a lower bound of the distance between a
vector and a centroid; the greatest bound over all pivots counts. A vector is measured exactly against the centroid of the least bound, and then
against those whose bound does not exceed the best distance so far. Distances are squared and exact integers. Bounds are floating
numbers, lowered by more than rounding can have raised them, and a centroid goes only if its bound is greater, never on a tie.

A round reads the stored table, writes nothing, and adds one row of sums per centroid for each task: ``centroids * (width + 1)`` numbers
meet and go to the driver. Pivots are chosen among the first centroids, each the farthest from those before.

Nulls and oddities: vectors that are null, hold null or non-finite components or have another length than ``width`` take no part. Centroids start
with the rows of the smallest hash, null ids last, and of rows with one id the smaller vector first; repeated rows count as often as they
are there; fewer rows than centroids give as many centroids as rows. A centroid without vectors stays. Components beyond
``vectors.LARGEST`` after scaling are an error. An empty table gives no rows and no centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import vectors as V
from tidemark.session import stored

#: A root of a 64-bit integer is off by far less than this share.
SLACK = 2.0 ** -48


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row of ``a`` to one vector or to the same row of ``b``."""
    return np.square(a - b).sum(-1)


def farthest(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different points, each the farthest from those before; the first point comes first."""
    chosen = [0]
    gap = squared(points, points[0])
    while len(chosen) < min(count, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(points, points[chosen[-1]]))
    return points[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid (ties: the smaller number), and how many distances that took.

    ``to_pivots`` has each vector's squared distances to the pivots.
    """
    roots = np.sqrt(to_pivots.astype(np.float64))
    bound = np.zeros((len(x), len(centroids)))
    for k, pivot in enumerate(pivots):
        own, theirs = roots[:, k, None], np.sqrt(squared(centroids, pivot).astype(np.float64))[None, :]
        np.maximum(bound, np.abs(own - theirs) - (own + theirs) * SLACK, out=bound)
    number = bound.argmin(1)
    best = squared(x, centroids[number])
    bound *= bound * (1 - SLACK)
    measured, first = len(x), number.copy()
    for k, centroid in enumerate(centroids):
        left = np.flatnonzero((bound[:, k] <= best) & (first != k))
        found = squared(x[left], centroid)
        better = (found < best[left]) | (found == best[left]) & (k < number[left])
        best[left[better]], number[left[better]] = found[better], k
        measured += len(left)
    return number, best, measured


class Clusters:
    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids

    @property
    def sha256(self) -> list[str]:
        """Of each centroid's components in decimal, joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def _measured(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    fields = T.StructType([*rows.schema.fields, T.StructField("pivots", T.ArrayType(T.LongType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in V.portions(batches):
            x = V.matrix(batch["v"], pivots.shape[1])
            found = np.stack([squared(x, p) for p in pivots], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, V.lists(found, pa.int64())], names=fields.fieldNames())

    return stored(rows.mapInArrow(measure, fields))


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple]:
    for batch in V.portions(batches):
        x = V.matrix(batch["v"], centroids.shape[1])
        number, distance, _ = nearest(x, V.matrix(batch["pivots"], len(pivots)), centroids, pivots)
        yield batch, x, number, distance


def _sums(centroids: np.ndarray, pivots: np.ndarray) -> Callable:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for _, x, number, _ in _assigned(batches, centroids, pivots):
            np.add.at(sums, number, np.concatenate([x, np.ones((len(x), 1), np.int64)], 1))
        if sums[:, -1].any():
            yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))], names=["sums"])

    return add


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 40, rounds: int = 5, scale: int = 256,
            width: int = 64, seed: str = "2:", pivots: int = 8) -> tuple[DataFrame, Clusters]:
    """``row, cluster, distance`` of every usable vector of ``width`` components, and the final centroids.

    ``row`` is a struct of all columns but the vector; ``distance`` is squared, between vectors of ``floor(scale * x)``. The first centroids are the rows
    with the smallest sha256 of ``seed`` followed by the id.
    """
    if count < 1 or pivots < 1 or width < 1 or rounds < 0:
        raise ValueError("one centroid, pivot and component at least, and no negative number of rounds")
    rows = V.integers(vectors, id_col, vector_col, scale).where(F.size("v") == width)
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).asc_nulls_last()
    start = [r["v"] for r in rows.select("id", "v").orderBy(order, "v").limit(count).collect()]
    centroids = np.array(start, np.int64).reshape(len(start), width)
    if not start:
        return rows.select("row", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), Clusters(centroids)
    fixed = farthest(centroids, pivots)
    table = _measured(rows, fixed)
    for _ in range(rounds):
        totals = V.added(table.select("v", "pivots").mapInArrow(_sums(centroids, fixed), "sums array<long>"), centroids.size + len(centroids))
        updated = V.means(totals.reshape(len(centroids), width + 1), centroids)
        if (updated == centroids).all():
            break
        centroids = updated
    fields = T.StructType([rows.schema["row"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, distance in _assigned(batches, centroids, fixed):
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(number, pa.int32()), pa.array(distance)], names=fields.fieldNames())

    return table.select("row", "v", "pivots").mapInArrow(label, fields), Clusters(centroids)
