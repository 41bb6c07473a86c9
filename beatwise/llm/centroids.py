"""Centroid clustering with equal-average equal-variance search.

Centroids are sorted by the mean of their components.  A vector looks at them
outward from its own mean.  With d components, sums S and deviations V from the
mean, ``(Sx - Sc)^2 / d + (Vx - Vc)^2`` is never above the squared distance: the
search stops where the first part alone exceeds the best distance, and a
centroid is rejected where both do.  What is left is measured in integers, so
distances, ties, sums and means are exact.

A round reads the staged integer vectors once; each task sends one sum per
centroid, so a hot cluster or vector costs no more than any other, and the
driver sees the K summed rows only.

Defined results:

* vectors with another number of components, with a null or non-finite
  component, or null themselves are left out; so are those with a component of
  ``LARGEST`` or more after scaling, whose distances would not fit 64 bits;
* ties go to the smaller centroid number; equal vectors that are both first
  centroids leave the second one empty, and an empty centroid stays;
* first centroids are taken by the hash of the id, then by the vector; null ids
  come last; with fewer vectors than ``k`` there are as many centroids;
* repeated rows count as often as they occur; no rows: no rows;
* kept columns called ``cluster`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import materialize, pack

SCALE = 256
#: Components stay below this in absolute value: 64 squared differences fit 62 bits.
LARGEST = 1 << 27
#: Vectors searched together.
AT_ONCE = 4096
#: Room for rounding in the real-valued bounds: never rejects a centroid within it.
ROOM, SLACK = 1e-9, 1e-6


class OutwardSearch:
    """Nearest of a few integer centroids, by mean and deviation bounds."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.points, self.sums = centroids[self.number], sums[self.number]
        self.spread = _deviation(self.points)
        self.measured = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: smallest) and the squared distance, for rows of int64."""
        number, best = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        for at in range(0, len(x), AT_ONCE):
            number[at:at + AT_ONCE], best[at:at + AT_ONCE] = self._nearest(x[at:at + AT_ONCE])
        return number, best

    def _nearest(self, x):
        d, k = x.shape[1], len(self.sums)
        sums, spread = x.sum(axis=1), _deviation(x)
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), k)
        above = np.searchsorted(self.sums, sums)
        below = above - 1
        far = np.int64(np.iinfo(np.int64).max)
        open_ = np.arange(len(x))
        for _ in range(k):
            low, high, own = below[open_], above[open_], sums[open_]
            gap_low = np.where(low >= 0, own - self.sums[np.maximum(low, 0)], far)
            gap_high = np.where(high < k, self.sums[np.minimum(high, k - 1)] - own, far)
            down = gap_low <= gap_high
            c = np.where(down, low, high)
            bound = np.minimum(gap_low, gap_high).astype(float) ** 2 / d
            limit = best[open_] * (1 + ROOM) + SLACK
            within = bound <= limit  # every centroid further out has a larger gap
            open_, c, down, bound, limit = open_[within], c[within], down[within], bound[within], limit[within]
            if not len(open_):
                break
            below[open_[down]] -= 1
            above[open_[~down]] += 1
            look = bound + (spread[open_] - self.spread[c]) ** 2 <= limit
            v, c = open_[look], c[look]
            self.measured += len(v)
            off = x[v] - self.points[c]
            distance = np.einsum("ij,ij->i", off, off)
            name = self.number[c]
            closer = (distance < best[v]) | ((distance == best[v]) & (name < number[v]))
            best[v[closer]], number[v[closer]] = distance[closer], name[closer]
        return number, best


def _deviation(x: np.ndarray) -> np.ndarray:
    """Length of each row's difference from its own mean."""
    x = x.astype(float)
    return np.sqrt(((x - x.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.int64)


def integer_vectors(df: DataFrame, id_col: str, vector: str, dimensions: int, keep: list[str] | None) -> DataFrame:
    """``(row, id, vec)`` of the vectors that count, components as ``floor(SCALE * x)``."""
    sound = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < LARGEST, F.lit(False)))
    rows = pack(df, keep, id=F.col(id_col).cast("string"), size=F.size(vector), sound=sound, raw=F.col(vector))
    vec = F.when(F.col("sound"), F.transform("raw", lambda x: F.floor(x.cast("double") * SCALE).cast("int")))
    return rows.filter(F.col("size") == dimensions).filter("sound").select("row", "id", vec.alias("vec"))


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """Exact component sums of every cluster that has any rows; the last number is their count."""
    k, d = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, total = OutwardSearch(centroids), np.zeros((k, d + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if not len(x):
                continue
            number, _ = search.nearest(x)
            order = np.argsort(number, kind="stable")
            found, first = np.unique(number[order], return_index=True)
            total[found, :d] += np.add.reduceat(x[order], first, axis=0)
            total[:, d] += np.bincount(number, minlength=k)
        some = np.flatnonzero(total[:, d])
        if len(some):
            yield pa.RecordBatch.from_pydict({"cluster": some, "total": list(total[some])}, schema=pa.schema(
                [("cluster", pa.int64()), ("total", pa.list_(pa.int64()))]))

    parts = vectors.select("vec").mapInArrow(partial, "cluster bigint, total array<bigint>")
    sums = parts.select("cluster", F.posexplode("total").alias("place", "part")).groupBy("cluster", "place").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    whole: dict[int, list[int]] = {}
    for r in sums.orderBy("cluster", "place").collect():  # k times d + 1 numbers
        whole.setdefault(r["cluster"], []).append(int(r["total"]))
    return whole


def cluster(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dimensions: int = 64, k: int = 40,
            rounds: int = 5, seed: int = 2, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``df`` (or those in ``keep``) plus the struct ``cluster``, for every vector that counts.

    ``cluster`` has ``number``, ``distance`` (squared), ``inertia`` (its
    cluster's summed distance), ``total_inertia`` and ``centroid_sha256``.
    """
    if min(dimensions, k) < 1 or dimensions > 64:
        raise ValueError("dimensions must be 1 to 64, k positive")
    spark = df.sparkSession
    keep = [c for c in keep or df.columns if c.lower() != "cluster"]
    vectors = materialize(integer_vectors(df, id_col, vector, dimensions, keep), "vectors")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), "id"), 256)
    first = vectors.select(mark.alias("mark"), "vec").orderBy(F.col("mark").asc_nulls_last(), "vec").limit(k).collect()
    centroids = np.array([r["vec"] for r in first], np.int64).reshape(len(first), dimensions)
    for _ in range(rounds if len(first) else 0):
        for c, (*total, n) in _sums(vectors, centroids).items():
            centroids[c] = [t // n for t in total]  # floors, also below zero

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = OutwardSearch(centroids)
        for batch in batches:
            number, distance = search.nearest(_matrix(batch.column(1), dimensions))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)],
                                             ["row", "number", "distance"])

    schema = StructType([vectors.schema["row"]]).add("number", "integer").add("distance", "long")
    placed = materialize(vectors.select("row", "vec").mapInArrow(assign, schema), "clusters")
    sums = placed.groupBy("number").agg(F.sum("distance").alias("inertia")).collect()  # k rows
    total = sum(r["inertia"] for r in sums)
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    facts = spark.createDataFrame([(r["number"], r["inertia"], total, digest(r["number"])) for r in sums],
                                  "number int, inertia bigint, total_inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "number").select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        F.struct("number", "distance", "inertia", "total_inertia", "centroid_sha256").alias("cluster"))
