"""Whitening of embeddings, from an exact scatter matrix by bit slices.

Vectors become integers. In a batch each dimension is shifted by its smallest value, and the bit
planes of the shifted values are packed across rows into 64-bit words. The sum of the products of two
dimensions is the sum, over pairs of their planes, of the population count of the planes' AND, weighed
by the power of two of the pair; the shifts are put back with integers. Spark adds up the batches'
sums. The scatter is centred as integers, ``n * P - S S'``, and only then divided and given to the
eigensolver, so no digit is lost to a large mean.

The fit list holds each distinct vector once: copies are reduced in the map tasks, so a vector that
a third of the rows share is one row a task. What the driver gets grows with the square of the
vectors' length alone.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries, or entries
whose scaled floor no 64-bit integer holds, are dropped; vectors of each length are fitted apart;
repeated rows each get results; a component without variance (in a fit list of one vector, say) has a
null ``whitened`` and is left out of ``identity_error``, which is null if none varies; a deviation
beyond 64 bits is null; an empty table gives an empty one. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import keep, pieces, ship

SCALE, OFFSET, COMPONENTS = 64.0, 1_000_000, 16
LARGEST = 2.0**62
#: Rows whose planes are packed at once.
AT_ONCE = 8192
#: Under this share of the largest eigenvalue a component counts as one without variance.
NOTHING = 1e-12
#: Low bits of sums that are added up apart from the others.
LOW = 50


def whole(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, dim, x``: the vectors that take part, as integers."""
    scaled = lambda x: x.cast("double") * SCALE
    fits = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(scaled(x)) < LARGEST, F.lit(False)))
    return embeddings.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(fits).select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.size(vector).alias("dim"),
        F.transform(vector, lambda x: F.floor(scaled(x)).cast("bigint") + OFFSET).alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """The bit planes of non-negative numbers (rows, dims), as words (dims, bits, words)."""
    rows, dim = shifted.shape
    words = -(-rows // 64)
    flags = np.zeros((dim, bits, words * 64), dtype=bool)
    for b in range(bits):
        flags[:, b, :rows] = (shifted.T >> np.uint64(b)) & np.uint64(1)
    return np.packbits(flags, axis=2).view(np.uint64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums by dimension and of products of dimensions (upper triangle), as Python integers,
    of values less ``OFFSET``."""
    rows, dim = x.shape
    base = x.min(axis=0)
    shifted = (x - base).astype(np.uint64)  # differences of signed numbers wrap to the right ones
    bits = max(1, int(shifted.max()).bit_length())
    packed = planes(shifted, bits)
    weights = np.array([1 << b for b in range(bits)], dtype=object)
    pairs = np.multiply.outer(weights, weights)
    sums = (np.bitwise_count(packed).sum(axis=2, dtype=np.int64).astype(object) * weights).sum(axis=1)
    products = np.zeros((dim, dim), dtype=object)
    for i in range(dim):
        counts = np.empty((dim - i, bits, bits), dtype=np.int64)
        for b in range(bits):
            counts[:, b] = np.bitwise_count(packed[i:] & packed[i, b]).sum(axis=2, dtype=np.int64)
        products[i, i:] = (counts.astype(object) * pairs).sum(axis=(1, 2))
    shift = base.astype(object) - OFFSET
    products += np.multiply.outer(shift, sums) + np.multiply.outer(sums, shift) + rows * np.multiply.outer(shift, shift)
    return sums + rows * shift, products


SUMS = "dim int, i int, j int, high string, low bigint, n bigint"


def sums_of(fit: DataFrame) -> DataFrame:
    """For each task's share of the fit list: numbers, sums (``j`` is -1) and sums of products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, list] = {}
        for batch in batches:
            for part in pieces(batch, 16 << 20):
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    x = matrix(part.column("x").take(pa.array(np.flatnonzero(dims == dim))), dim)
                    for at in range(0, len(x), AT_ONCE):
                        some = x[at:at + AT_ONCE]
                        sums, products = scatter(some)
                        if dim in made:
                            made[dim][0] += len(some)
                            made[dim][1] += sums
                            made[dim][2] += products
                        else:
                            made[dim] = [len(some), sums, products]
        for dim, (n, sums, products) in made.items():
            i, j = np.triu_indices(dim)
            values = [*sums, *products[i, j]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(values), dim, np.int32)), pa.array(np.concatenate([np.arange(dim), i]).astype(np.int32)),
                pa.array(np.concatenate([np.full(dim, -1), j]).astype(np.int32)),
                pa.array([str(v >> LOW) for v in values], pa.string()),  # may need more than 64 bits
                pa.array([v & ((1 << LOW) - 1) for v in values], pa.int64()), pa.array(np.full(len(values), n))],
                names=["dim", "i", "j", "high", "low", "n"])

    return fit.mapInArrow(run, SUMS)


@dataclass
class Fit:
    """What whitens vectors of one length."""

    n: int
    sums: np.ndarray  # Python integers, of values less OFFSET
    axes: np.ndarray  # (dim, components), each divided by the root of its eigenvalue; 0 without variance
    varies: np.ndarray
    explained: np.ndarray
    error: float | None = None

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """``x - S/n`` and the exact ``sum((n x - S)²)`` of each row."""
        off = x - OFFSET
        most = self.n * int(np.abs(off).max(initial=0)) + max(map(abs, self.sums))
        if most * most * x.shape[1] < 1 << 63:
            scaled = self.n * off - self.sums.astype(np.int64)
            return scaled / self.n, (scaled * scaled).sum(axis=1).tolist()
        scaled = self.n * off.astype(object) - self.sums
        total = (scaled * scaled).sum(axis=1).tolist()
        return (scaled / self.n).astype(float), [t if t < 1 << 63 else None for t in total]


def fitted(n: int, sums: np.ndarray, products: np.ndarray) -> Fit:
    """Centred as integers; each entry is then divided once, correctly rounded."""
    dim = len(sums)
    exact = n * products - np.multiply.outer(sums, sums)
    v = np.array([[exact[min(i, j), max(i, j)] / (n * n) for j in range(dim)] for i in range(dim)])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:COMPONENTS]
    e = values[order]
    trace = sum(exact[i, i] for i in range(dim)) / (n * n)
    varies = e > NOTHING * max(float(values.max()), 0.0)
    axes = np.where(varies, vectors[:, order] / np.sqrt(np.where(varies, e, 1.0)), 0.0)
    return Fit(n, sums, axes, varies, np.maximum(e, 0.0) / trace if trace else np.zeros(len(e)))


def fit_of(fit_list: DataFrame) -> dict[int, Fit]:
    """The fit of each length of vector."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = sums_of(fit_list).groupBy("dim", "i", "j").agg(wide("high"), wide("low"), wide("n")).collect()
    out = {}
    for dim in {r.dim for r in rows}:  # dim * (dim + 3) / 2 rows a length
        sums, products = np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
        for r in rows:
            if r.dim == dim:
                value = (int(r.high) << LOW) + int(r.low)
                if r.j < 0:
                    sums[r.i] = value
                else:
                    products[r.i, r.j] = value
        out[dim] = fitted(int(next(r.n for r in rows if r.dim == dim)), sums, products)
    return out


def identity_errors(fit_list: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """How far the covariance of the whitened fit list is from the identity, measured on it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, 16 << 20):
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    x = matrix(part.column("x").take(pa.array(np.flatnonzero(dims == dim))), dim)
                    z = fits[dim].centred(x)[0] @ fits[dim].axes
                    z = np.hstack([np.ones((len(z), 1)), z])
                    made[dim] = made.get(dim, 0) + z.T @ z
        for dim, total in made.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([total.ravel().tolist()])], names=["dim", "total"])

    rows = fit_list.mapInArrow(run, "dim int, total array<double>")
    rows = rows.select("dim", F.posexplode("total")).groupBy("dim", "pos").agg(F.sum("col").alias("total")).collect()
    out = {}
    for dim, fit in fits.items():
        size = len(fit.varies) + 1
        total = np.zeros(size * size)
        for r in rows:
            if r.dim == dim:
                total[r.pos] = r.total
        total = total.reshape(size, size) / fit.n
        error = np.abs(total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:]) - np.eye(size - 1))
        error = error[np.ix_(fit.varies, fit.varies)]
        out[dim] = float(error.max()) if error.size else None
    return out


WHITE = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def whiten(embeddings: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for every
    vector that takes part and each of its first ``COMPONENTS`` components."""
    ship(embeddings.sparkSession)
    rows = whole(embeddings)
    fit_list = keep(rows.select("dim", "x").distinct(), "fit-list")
    fits = fit_of(fit_list)
    for dim, error in identity_errors(fit_list, fits).items():
        fits[dim].error = error
    shared = embeddings.sparkSession.sparkContext.broadcast(fits)  # a length squared at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in WHITE.split(", ")]
        for batch in batches:
            for part in pieces(batch, 1 << 20):
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    some, fit = part.take(pa.array(np.flatnonzero(dims == dim))), shared.value[dim]
                    centred, deviation = fit.centred(matrix(some.column("x"), dim))
                    many, k = some.num_rows, len(fit.varies)
                    each = np.repeat(np.arange(many), k)
                    yield pa.RecordBatch.from_arrays([
                        some.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                        pa.array(np.full(many * k, fit.n)), pa.array(deviation, pa.int64()).take(pa.array(each)),
                        pa.array((centred @ fit.axes).ravel(), mask=np.tile(~fit.varies, many)),
                        pa.array(np.tile(fit.explained, many)),
                        pa.array([fit.error] * (many * k), pa.float64())], names=names)

    return rows.mapInArrow(run, WHITE)
