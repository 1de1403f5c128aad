"""Whitening of embeddings: exact scatter from bit-sliced cross-products, eigenvectors, projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import arrow_schema

#: Rows whose bit planes are packed together.
BLOCK = 8192
#: Exact sums travel as limbs of so many bits, so that no column overflows.
LIMB = 60
SUMS = "i int, j int, lo bigint, mid bigint, hi bigint"


@dataclass(frozen=True)
class Whitening:
    """Exact first and second moments of the fit list and its principal components."""

    n: int
    sums: list[int]           # S, per dimension
    directions: np.ndarray    # (components, dimensions), unit rows
    variances: np.ndarray     # eigenvalue of each component, falling
    explained: np.ndarray     # share of the trace of each component

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number vectors; centred as integers before anything is rounded."""
        centred = self.centred(x).astype(np.float64) / self.n
        return centred @ self.directions.T / np.sqrt(self.variances)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as 64-bit numbers where they fit and as Python numbers beyond."""
        largest = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums), default=0)
        if largest < 1 << 62:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, exact at any size."""
        y = self.centred(x)
        if y.dtype == object or int(np.abs(y).max(initial=0)) >= 1 << 50:
            return [sum(int(v) * int(v) for v in row) for row in y]
        high, low = y >> 25, y & ((1 << 25) - 1)
        parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
        return [(int(a) << 50) + (int(b) << 26) + int(c) for a, b, c in zip(*parts)]


def whole_vectors(df: DataFrame, vector_column: str, scale: int, shift: int) -> DataFrame:
    """``df`` with ``_x``, floor(scale * c) + shift of every entry; rows with unusable vectors are dropped.

    Dropped are null vectors, and those with null or non-finite entries.
    """
    vector = F.col(f"`{vector_column}`").cast(T.ArrayType(T.DoubleType()))
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    # Entries beyond the range of a long stay at its ends, less the shift.
    bound = float(1 << 62)
    whole = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(bound)), F.lit(-bound))) + shift)
    return df.where(F.coalesce(finite, F.lit(False))).withColumn("_x", whole)


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact cross-products of the columns of a block of whole numbers >= 0, by bit planes.

    Bit b of every column over all rows is one plane of packed words. The product of two columns is the sum
    over pairs of planes of the bits that both have, each pair weighted by the two powers of two.
    Upper triangle only; Python numbers where 64 bits could overflow.
    """
    rows, dims = x.shape
    bits = max(1, int(x.max(initial=0)).bit_length())
    words = -(-rows // 64)
    padded = np.zeros((dims, bits, words * 64), dtype=np.uint8)
    for b in range(bits):
        padded[:, b, :rows] = ((x >> b) & 1).T
    planes = np.packbits(padded, axis=2, bitorder="little").view(np.uint64).reshape(dims, bits, words)
    exact = np.int64 if 2 * bits + rows.bit_length() < 63 else object
    powers = np.array([1 << b for b in range(bits)], dtype=exact)
    out = np.zeros((dims, dims), dtype=exact)
    for i in range(dims):
        for a in range(bits):
            both = np.bitwise_count(planes[i:] & planes[i, a]).sum(axis=2, dtype=np.int64)
            out[i, i:] += (both.astype(exact) * powers).sum(axis=1) * (1 << a)
    return out


def _matrix(vectors: pa.Array, dims: int, missing: int) -> np.ndarray:
    """Rows of a list column; entries that a shorter vector lacks stand for zero components."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.full((len(sizes), dims), missing, dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def fit(df: DataFrame, vector_column: str = "embedding", components: int = 32, scale: int = 64,
        shift: int = 1_000_000) -> Whitening:
    """Moments of all vectors of ``df`` and their first components by falling variance.

    Every task packs the bit planes of its rows, block by block, above the least value of the
    block, and adds up exact cross-products; Spark sums them over tasks. What reaches the driver
    is one number for each pair of dimensions, however many rows there are. The covariance is
    centred in whole numbers, n * XY - S S', before it becomes floating point. Components
    without variance are left out, as nothing can scale them to one.
    """
    held = whole_vectors(df, vector_column, scale, shift).select("_x")
    dims = held.agg(F.max(F.size("_x"))).first()[0] or 0
    schema = arrow_schema(SUMS)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, np.zeros(dims, dtype=object)
        products = np.zeros((dims, dims), dtype=object)
        for batch in source:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.column("_x").slice(at, BLOCK), dims, shift)
                low = [int(v) for v in x.min(axis=0)]
                u = x - np.array(low, dtype=np.int64)
                # Columns sum in two halves, so that no 64-bit sum overflows.
                own = ((u >> 32).sum(axis=0).astype(object) << 32) + (u & 0xFFFFFFFF).sum(axis=0).astype(object)
                lows, rows = np.array(low, dtype=object), len(x)
                products += (scatter(u).astype(object) + np.outer(own, lows) + np.outer(lows, own)
                             + rows * np.outer(lows, lows))
                sums += own + rows * lows
                count += rows
        if not count:
            return
        found = [(-1, -1, count), *((-1, i, int(s)) for i, s in enumerate(sums)),
                 *((i, j, int(products[i, j])) for i in range(dims) for j in range(i, dims))]
        mask = (1 << LIMB) - 1
        cells = [(i, j, v & mask, v >> LIMB & mask, v >> 2 * LIMB) for i, j, v in found]
        yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*cells), schema)], schema=schema)

    limbs = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("lo", "mid", "hi")]
    totals = {(r["i"], r["j"]): int(r["lo"]) + (int(r["mid"]) << LIMB) + (int(r["hi"]) << 2 * LIMB)
              for r in held.mapInArrow(run, SUMS).groupBy("i", "j").agg(*limbs).collect()}
    return components_of(totals, dims, components)


def components_of(totals: dict[tuple[int, int], int], dims: int, components: int) -> Whitening:
    """The whitening for exact totals: count at (-1, -1), sums at (-1, i), cross-products at i <= j."""
    n = totals.get((-1, -1), 0)
    sums = [totals.get((-1, i), 0) for i in range(dims)]
    spread = [[n * totals[min(i, j), max(i, j)] - sums[i] * sums[j] if n else 0 for j in range(dims)]
              for i in range(dims)]
    if not n or not any(spread[i][i] for i in range(dims)):
        return Whitening(n, sums, np.zeros((0, dims)), np.zeros(0), np.zeros(0))
    covariance = np.array([[v / (n * n) for v in row] for row in spread])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order].T
    real = np.flatnonzero(values > values[0] * dims * np.finfo(float).eps)[:components]
    # The variance along a computed direction is one order more precise than the eigenvalue found.
    wide = vectors[real].astype(np.longdouble)
    variances = np.einsum("ki,ij,kj->k", wide, covariance.astype(np.longdouble), wide).astype(float)
    trace = sum(spread[i][i] for i in range(dims)) / (n * n)
    return Whitening(n, sums, vectors[real], variances, variances / trace)


def identity_error(df: DataFrame, model: Whitening, vector_column: str = "embedding", scale: int = 64,
                   shift: int = 1_000_000) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k, dims = len(model.variances), len(model.sums)
    schema = arrow_schema("i int, j int, v double")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in source:
            w = model.project(_matrix(batch.column("_x"), dims, shift))
            total += w.sum(axis=0)
            products += w.T @ w
        i, j = np.divmod(np.arange(k * k), max(k, 1))
        yield pa.record_batch([
            pa.array(np.concatenate([i, np.full(k, -1)]), type=pa.int32()),
            pa.array(np.concatenate([j, np.arange(k)]), type=pa.int32()),
            pa.array(np.concatenate([products.ravel(), total]))], schema=schema)

    if not k:
        return 0.0
    held = whole_vectors(df, vector_column, scale, shift).select("_x")
    found = {(r["i"], r["j"]): r["v"] for r in held.mapInArrow(run, "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    mean = np.array([found[-1, j] for j in range(k)]) / model.n
    moments = np.array([[found[i, j] for j in range(k)] for i in range(k)]) / model.n
    return float(np.abs(moments - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, id_column: str = "vec_id", vector_column: str = "embedding",
           scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """id, deviation decimal(38,0) and whitened array<double> (one entry per component) of every usable row.

    An entry c counts as the whole number floor(scale * c) + shift. Rows whose vector is null or holds null
    or non-finite entries are dropped, also from the fit; shorter vectors count as padded with zeros,
    and empty ones are all padding. Rows without id stay, repeated rows give a result each, other
    columns are ignored, and an empty table gives no rows. Entries beyond 2^62 / scale in size count
    as that size. ``deviation`` is the sum over dimensions of (n * x - S)^2 and null where it
    exceeds 38 digits.
    """
    dims = len(model.sums)
    kind = df.select(F.col(f"`{id_column}`").alias("id")).schema["id"].dataType

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = _matrix(batch.column("_x"), dims, shift)
            w = model.project(x)
            k = w.shape[1]
            spread = [Decimal(d) if d < 10 ** 38 else None for d in model.deviations(x)]
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, type=pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(spread, type=pa.decimal128(38, 0)), rows], ["id", "deviation", "whitened"])

    out = T.StructType([T.StructField("id", kind), T.StructField("deviation", T.DecimalType(38, 0)),
                        T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    held = whole_vectors(df, vector_column, scale, shift).select(F.col(f"`{id_column}`").alias("id"), "_x")
    return held.mapInArrow(run, out).withColumnRenamed("id", id_column)
