"""Whitening of embeddings by exact covariances from bit planes."""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored

# Entries become integers in steps of 1 / SCALE, moved by OFFSET.
SCALE, OFFSET = 1024, 100_000
# Entries of a block of rows: its planes fit a processor's cache.
_BLOCK = 1 << 20
# Sums leave a task in parts of so many bits, which Spark adds up without overflow.
_LIMB = 32
# Eigenvalues below this share of the largest are rounding, not variance.
_FLAT = 1e-12
# The first deviation that a decimal of 38 digits does not hold.
_MOST = 10**38
_SCHEMA = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double,"
    " explained double, identity_error double"
)


def as_integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) + OFFSET; entries beyond 2 ** 62 stop there."""
    scaled = np.floor(SCALE * vectors.astype(np.float64))
    return np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64) + OFFSET


def _planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """Bit b of dimension i over all rows as words: (dimensions, bits, words)."""
    rows, dims = shifted.shape
    padded = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    padded[:rows] = shifted
    out = np.empty((dims, bits, len(padded) // 64), np.uint64)
    for b in range(bits):
        plane = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(np.ascontiguousarray(plane.T), axis=1)
        out[:, b] = packed.view(np.uint64)
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of the columns of an integer block, exactly.

    Each dimension is shifted by its least value, its bits are packed across the rows,
    and the products of two dimensions are the ones that two planes share, counted by
    AND and weighted by 2 ** (a + b). The shifts are put back afterwards.
    """
    rows, dims = x.shape
    least = x.min(axis=0)
    shifted = (x.view(np.uint64) - least.view(np.uint64)[None, :]).astype(np.uint64)
    bits = max(1, int(shifted.max()).bit_length())
    planes = _planes(shifted, bits)
    # Sums that may pass 63 bits are kept as Python's integers.
    small = 2 * bits + rows.bit_length() + 1 < 63
    kind = np.int64 if small else object
    weights = np.array([1 << b for b in range(bits)], kind)
    products = np.zeros((dims, dims), kind)
    for i in range(dims):
        for a in range(bits):
            ones = np.bitwise_count(planes[i, a] & planes[i:]).sum(axis=2, dtype=np.int64)
            row = (ones.astype(kind) * weights).sum(axis=1)
            products[i, i:] += row * weights[a]
    total = (np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(kind) * weights).sum(axis=1)
    base, total, products = (v.astype(object) for v in (least, total, products))
    products = np.triu(products) + np.triu(products, 1).T
    cross = np.multiply.outer(base, total)
    products = products + cross + cross.T + rows * np.multiply.outer(base, base)
    return total + rows * base, products


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    waiting, rows, most = [], 0, max(64, _BLOCK // dims)
    for batch in batches:
        whole = as_integers(_matrix(batch.column(0), dims))
        for at in range(0, len(whole), most):
            part = whole[at : at + most]
            if rows + len(part) > most and rows:
                yield np.concatenate(waiting)
                waiting, rows = [], 0
            waiting.append(part)
            rows += len(part)
    if rows:
        yield np.concatenate(waiting)


@dataclass
class Fit:
    """Exact sums of the fit list, and its components by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of variance 1; n * x - S is exact, so centring loses nothing."""
        centred = self._centred(x).astype(np.float64) / self.n
        return centred @ self.components / np.sqrt(self.eigenvalues)

    def _centred(self, x: np.ndarray) -> np.ndarray:
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n
        kind = np.int64 if max(most, *map(abs, self.sums), 0) < 2**61 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)[None, :]

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2, exactly."""
        centred = self._centred(x)
        most = max((abs(int(v)) for v in (centred.max(initial=0), centred.min(initial=0))))
        if most * most * max(1, x.shape[1]) >= 2**62:
            centred = centred.astype(object)
        return (centred * centred).sum(axis=1).tolist()


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows whose vector is there and holds finite entries only."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        v.isNotNull() & finite
    )


def fit(rows: DataFrame, dims: int, components: int) -> Fit | None:
    """The components of rows (vec_id, v) of so many dimensions; None without rows.

    Every task packs and counts its own rows in blocks and returns its sums, a matrix
    of dims x dims whatever its rows; Spark adds them, and the driver gets one matrix.
    """

    def count(batches):
        n, sums, products = 0, None, None
        for block in _blocks(batches, dims):
            s, p = scatter(block)
            sums, products = (s, p) if sums is None else (sums + s, products + p)
            n += len(block)
        if n:
            upper = np.triu_indices(dims)
            values = [n, *sums.tolist(), *products[upper].tolist()]
            yield from _limbs(values)

    limbs = rows.select("v").mapInArrow(count, "place int, limb int, value long")
    summed = limbs.groupBy("place", "limb").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    )
    values: dict[int, int] = {}
    for place, limb, value in summed.collect():
        values[place] = values.get(place, 0) + (int(value) << (_LIMB * limb))
    if not values.get(0):
        return None
    n, sums = values[0], [values.get(1 + i, 0) for i in range(dims)]
    covariance = np.zeros((dims, dims))
    at = 1 + dims
    for i in range(dims):
        for j in range(i, dims):
            centred = n * values.get(at, 0) - sums[i] * sums[j]
            covariance[i, j] = covariance[j, i] = centred / (n * n)
            at += 1
    found, vectors = np.linalg.eigh(covariance)
    order = np.argsort(found)[::-1][:components]
    order = order[found[order] > max(0.0, _FLAT * found.max())]
    return Fit(n, sums, vectors[:, order], found[order], float(np.trace(covariance)))


def _project(rows: DataFrame, dims: int, found: Fit) -> DataFrame:
    """(vec_id, deviation, whitened): a row per vector, from the sums alone."""

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = as_integers(_matrix(batch.column(1), dims))
            values = [Decimal(v) if v < _MOST else None for v in found.deviations(x)]
            white = found.whitened(x)
            ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column(0),
                    "deviation": pa.array(values, pa.decimal128(38, 0)),
                    "whitened": pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())),
                }
            )

    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    return rows.mapInArrow(project, schema)


def _identity_error(white: DataFrame, components: int) -> float:
    """Largest entry of the coordinates' covariance minus the identity, by absolute value.

    Spark centres each task's rows before it multiplies them.
    """
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    w = F.col("whitened")
    row = white.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """Rows of (vec_id, embedding) on the first principal components, scaled to variance 1.

    Returns ``vec_id, component, n, deviation, whitened, explained, identity_error``, a row
    for each vector and component from 1. All covariances are over all vectors kept:
    ``n`` of them, with their integers (see ``as_integers``) summed and multiplied
    exactly. ``deviation`` is the sum over dimensions of (n * x - S) ** 2, null where it
    has more than 38 digits; ``explained`` is the component's share of the variance;
    ``identity_error`` is measured on the whitened rows.

    Vectors that are null or hold a null or non-finite entry are left out, and so are
    those shorter than the longest, as they miss entries. Components without variance
    are left out, so equal vectors, a single one or an empty table give no rows.
    Repeated rows and rows without vec_id count like others; further columns are ignored.
    """
    valid = _valid(vectors)
    dims = valid.agg(F.max(F.size("v"))).first()[0] or 0
    rows = valid.filter(F.size("v") == dims)
    found = fit(rows, dims, components) if dims else None
    if found is None or not len(found.eigenvalues):
        return vectors.sparkSession.createDataFrame([], _SCHEMA)
    white = stored(_project(rows, dims, found), "whitened")
    error = _identity_error(white, len(found.eigenvalues))
    share = F.array(*[F.lit(float(e) / found.trace) for e in found.eigenvalues])
    spread = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _limbs(values: list[int]) -> Iterator[pa.RecordBatch]:
    """(place, limb, value) rows: each number in parts of 32 bits, the last with its sign."""
    for limb in range(8):
        kept = [(i, v) for i, v in enumerate(values) if v]
        if not kept:
            return
        mask = (1 << _LIMB) - 1
        rows = [(i, v if -mask <= v <= mask else v & mask) for i, v in kept]
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array([i for i, _ in rows], pa.int32()),
                "limb": pa.array([limb] * len(rows), pa.int32()),
                "value": pa.array([v for _, v in rows], pa.int64()),
            }
        )
        values = [0 if -mask <= v <= mask else v >> _LIMB for v in values]
