"""Centroid clustering by a bisector tournament.

For every pair of centroids the bisecting hyperplane has an integer normal, twice the difference of
the two, and an integer threshold, the difference of their squared lengths. The sign of the test
tells which of the two is nearer to a vector; zero favours the smaller number. The centroids meet as
in a tournament: neighbours in the order of their numbers, then the winners, until k - 1 tests have
eliminated all but one. Its distance is computed once, exactly.

A round is one pass over the vectors: each task sums its vectors for every centroid, the sums are
added up by Spark, and the driver divides k rows. Only these sums are shuffled, never vectors. Sums
are split in high and low halves, and tests run on Python integers where 64 bits could overflow, so
all results are exact.

Defined results: vectors that are null, of another length than ``dim``, or hold nulls, non-finite
entries or entries whose scaled floor no 64-bit integer holds, take no part; with fewer vectors than
k there are fewer centroids; equal ids are ordered by their vectors, and null ids start no centroid;
copies count as often as they stand there; a distance or sum beyond 64 bits is null; an empty table
gives an empty one. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import keep, pieces, ship

#: Rows that are tested at once: a test gathers a normal for each of them.
AT_ONCE = 1024
LARGEST = 2.0**62


def usable(embeddings: DataFrame, dim: int, scale: float, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, the vectors as doubles, of those that take part."""
    fits = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double") * scale) < LARGEST, F.lit(False)))
    return embeddings.where(F.col(vector).isNotNull() & (F.size(vector) == dim)).where(fits).select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))


def integers(batch: pa.RecordBatch, dim: int, scale: float) -> np.ndarray:
    return np.floor(batch.column("v").flatten().to_numpy() * scale).astype(np.int64).reshape(-1, dim)


def largest_of(vectors: np.ndarray) -> int:
    return int(np.abs(vectors).max(initial=0))


class Tournament:
    """The bisectors of some centroids (rows of 64-bit integers)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        wide = centroids.astype(object)
        lengths = (wide * wide).sum(axis=1)
        self.largest = int(np.abs(wide).max(initial=0))
        # of pair (i, j): twice (j - i), and |j|² - |i|²
        self.normals = 2 * (wide[None] - wide[:, None])
        self.thresholds = lengths[None] - lengths[:, None]
        kind = self.kind(self.largest)
        self.normals, self.thresholds = self.normals.astype(kind), self.thresholds.astype(kind)

    def kind(self, largest: int) -> type:
        """Numbers in which tests of entries of at most this size are exact."""
        most = 8 * self.centroids.shape[1] * max(self.largest, largest) ** 2
        return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each vector."""
        kind = self.kind(largest_of(vectors))
        if kind is object and self.normals.dtype == np.float64:  # its whole numbers are exact
            self.normals, self.thresholds = self.normals.astype(np.int64), self.thresholds.astype(np.int64)
        vectors = vectors.astype(kind)
        out = np.empty(len(vectors), dtype=np.int64)
        for at in range(0, len(vectors), AT_ONCE):
            some = vectors[at:at + AT_ONCE]
            out[at:at + AT_ONCE] = self.played(some)
        return out

    def played(self, some: np.ndarray) -> np.ndarray:
        k = len(self.centroids)
        first, second = np.arange(0, k - 1, 2), np.arange(1, k, 2)
        # All vectors share the first pairs: their tests are one product.
        side = some @ self.normals[first, second].T - self.thresholds[first, second]
        left = np.where(side > 0, second, first)
        if k % 2:
            left = np.hstack([left, np.full((len(some), 1), k - 1)])
        while left.shape[1] > 1:
            odd = left[:, -1:] if left.shape[1] % 2 else left[:, :0]
            a, b = left[:, 0:left.shape[1] - 1:2], left[:, 1::2]
            won = np.empty_like(a)
            for m in range(a.shape[1]):
                i, j = a[:, m], b[:, m]
                side = (some * self.normals[i, j]).sum(axis=1) - self.thresholds[i, j]
                won[:, m] = np.where(side > 0, j, i)
            left = np.hstack([won, odd])
        return left[:, 0]

    def distances(self, vectors: np.ndarray, numbers: np.ndarray) -> list[int | None]:
        """Squared distances to the centroids of these numbers; null where 64 bits are too few."""
        if self.kind(largest_of(vectors)) is not object:
            off = vectors - self.centroids[numbers]
            return (off * off).sum(axis=1).tolist()
        off = vectors.astype(object) - self.centroids[numbers].astype(object)
        return [x if x < 1 << 63 else None for x in (off * off).sum(axis=1).tolist()]


SUMS = "cluster int, dim int, n bigint, high bigint, low bigint"


def summed(rows: DataFrame, centroids: np.ndarray, scale: float) -> DataFrame:
    """For each task's share of the vectors, their number and sums by centroid."""
    k, dim = centroids.shape
    names = [f.split()[0] for f in SUMS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Tournament(centroids)
        counts = np.zeros(k, np.int64)
        high, low = np.zeros((k, dim), np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for part in pieces(batch, 4 << 20):
                vectors = integers(part, dim, scale)
                won = tests.winners(vectors)
                order = np.argsort(won, kind="stable")
                found, starts = np.unique(won[order], return_index=True)
                vectors = vectors[order]
                counts[found] += np.diff([*starts, len(order)])
                high[found] += np.add.reduceat(vectors >> 32, starts, axis=0)
                low[found] += np.add.reduceat(vectors & 0xFFFFFFFF, starts, axis=0)
        some = np.flatnonzero(counts)
        columns = (np.repeat(some, dim).astype(np.int32), np.tile(np.arange(dim, dtype=np.int32), len(some)),
                   np.repeat(counts[some], dim), high[some].ravel(), low[some].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return rows.mapInArrow(run, SUMS)


def moved(rows: DataFrame, centroids: np.ndarray, scale: float) -> np.ndarray:
    """The centroids after a round: the floors of the means; those without a vector stay."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = summed(rows, centroids, scale).groupBy("cluster", "dim").agg(wide("n"), wide("high"), wide("low"))
    out = centroids.copy()
    for r in sums.collect():  # k * dim rows at most
        out[r.cluster, r.dim] = ((int(r.high) << 32) + int(r.low)) // int(r.n)
    return out


def started(rows: DataFrame, k: int, salt: str, scale: float, dim: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of salt and id, in that order."""
    name = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = rows.where(F.col("vec_id").isNotNull()).withColumn("_name", name).orderBy("_name", "v").limit(k).collect()
    return np.array([np.floor(np.array(r.v) * scale).astype(np.int64) for r in chosen], dtype=np.int64).reshape(-1, dim)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


FOUND = "vec_id bigint, cluster int, distance bigint"


def assigned(rows: DataFrame, centroids: np.ndarray, scale: float) -> DataFrame:
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Tournament(centroids)
        for batch in batches:
            for part in pieces(batch, 4 << 20):
                vectors = integers(part, dim, scale)
                won = tests.winners(vectors)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(won.astype(np.int32)),
                     pa.array(tests.distances(vectors, won), pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, FOUND)


def cluster(
    embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, salt: str = "2:"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that
    takes part."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = usable(embeddings, dim, scale)
    centroids = started(rows, k, salt, scale, dim)
    if not len(centroids):
        rows = rows.where("false")
        return rows.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(rounds):
        centroids = moved(rows, centroids, scale)
    found = keep(assigned(rows, centroids, scale), "assigned")
    sums = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"),
        F.count_if(F.col("distance").isNull()).alias("unknown")).collect()  # k rows at most
    known = lambda x, unknown: x if not unknown and x is not None and x < 1 << 63 else None
    inertia = known(sum(int(r.total or 0) for r in sums), sum(r.unknown for r in sums))
    about = spark.createDataFrame(
        [(r.cluster, known(int(r.total or 0), r.unknown), inertia, digest(centroids[r.cluster])) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
