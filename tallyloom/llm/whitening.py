"""Embedding whitening from an exact covariance.

1. Entries become integers ``floor(scale * c) + shift`` and, less the least of
   their dimension, unsigned numbers of a few bits.
2. Every task packs each bit of each dimension, across rows, into 64-bit words.
   The popcount of two such bit planes ANDed, times their weights, is their part
   of a cross product; summed over planes and rows it is the exact product.
3. Products and sums are centred as integers on the driver (one number per pair
   of dimensions), and the covariance's eigenvectors whiten every row.

Rows whose vector is null, or holds null or non-finite entries, are left out, and
so are empty vectors.  Vectors must be of one length (else ValueError).  Repeated
rows and ids count as often as they come.  Components without variance can't be
whitened and are left out, so equal rows or a single one give no result rows; an
empty table gives none.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import frugal, materialise

SCALE, SHIFT = 1024, 100_000
PACKED = 4096  # rows in one set of bit planes
MOST_BITS = 44  # of a dimension's spread: products of any number of rows then fit 38 digits


@dataclass
class Whitening:
    """What whitens a row: (x - mean) @ axes / sqrt(eigenvalue)."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray  # falling
    axes: np.ndarray  # one column per value

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, x array<long>) of the rows whose vector has finite entries only; one too large for a long fails the query."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    fits = lambda c: F.when(F.abs(c * F.lit(float(scale))) < F.lit(2.0 ** 62), c).otherwise(
        F.raise_error(F.lit("a vector's entry is too large for a long")).cast("double"))
    return (rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where((F.size(v) > 0) & finite)
            .select("id", F.transform(v, lambda c: F.floor(fits(c) * F.lit(float(scale))) + F.lit(shift)).alias("x")))


def fit(vectors: DataFrame, components: int | None = None) -> Whitening | None:
    """The whitening of all of ``vectors`` (id, x); None without rows."""
    seen = (vectors.select(F.posexplode("x").alias("d", "c")).groupBy("d")
            .agg(F.count("*").alias("n"), F.min("c").alias("least"), F.max("c").alias("most")).orderBy("d").collect())
    if not seen:
        return None
    if len({r.n for r in seen}) > 1:
        raise ValueError("vectors of different lengths")
    n, least = seen[0].n, np.array([r.least for r in seen], np.int64)
    bits = [max(1, int(r.most - r.least).bit_length()) for r in seen]
    if max(bits) > MOST_BITS:
        raise ValueError(f"a dimension spreads over more than 2^{MOST_BITS} steps")
    dims = len(seen)
    parts = (scatter(vectors, least, bits).groupBy("i", "j")
             .agg(F.sum("product").alias("product")).collect())
    product = [[0] * dims for _ in range(dims)]
    sums = [0] * dims
    for r in parts:
        if r.j < 0:
            sums[r.i] = int(r.product)
        else:
            product[r.i][r.j] = product[r.j][r.i] = int(r.product)
    # a shift of all rows changes no covariance: the integers are centred as they are
    covariance = np.array([[(n * product[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    values, axes = values[order], axes[:, order]
    real = values > dims * np.finfo(float).eps * max(values[0], 0)
    return Whitening(n, [s + n * int(m) for s, m in zip(sums, least, strict=True)], covariance, values[real], axes[:, real])


def scatter(vectors: DataFrame, least: np.ndarray, bits: list[int]) -> DataFrame:
    """(i, j, product decimal): parts of the sums of u_i * u_j for i <= j, and of u_i under j = -1; u = x - ``least``."""
    dims = len(bits)
    plane_of = np.repeat(np.arange(dims), bits)
    weight_of = np.concatenate([np.arange(b) for b in bits])
    first = np.cumsum([0, *bits])
    small = 2 * max(bits) + PACKED.bit_length() < 62  # a set's products fit 64 bits
    kind = np.int64 if small else object
    weight = np.array([1 << int(w) for w in weight_of], kind)

    def planes(x: np.ndarray) -> np.ndarray:
        u = (x - least).astype(np.uint64)
        bit = (u[:, plane_of] >> weight_of.astype(np.uint64)) & np.uint64(1)
        packed = np.packbits(bit.T.astype(np.uint8), axis=1)
        return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)

    def products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, out = planes(x), np.zeros((dims, dims), kind)
        for i in range(dims):
            for p in range(first[i], first[i + 1]):
                both = np.bitwise_count(words[p] & words[first[i]:]).sum(1, dtype=np.int64).astype(kind)
                out[i, i:] += weight[p] * np.add.reduceat(both * weight[first[i]:], first[i:-1] - first[i])
        ones = np.bitwise_count(words).sum(1, dtype=np.int64).astype(kind)
        return out, np.add.reduceat(ones * weight, first[:-1])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((dims, dims), object), np.zeros(dims, object)
        for part in parts:
            lists = part.column(0)
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
            for at in range(0, len(x), PACKED):
                product, one = products(x[at:at + PACKED])
                total, sums = total + product, sums + one
        i, j = np.triu_indices(dims)
        rows = [*zip(i.tolist(), j.tolist(), map(str, total[i, j]), strict=True), *((k, -1, str(s)) for k, s in enumerate(sums))]
        yield pa.RecordBatch.from_pylist([dict(zip(("i", "j", "product"), r, strict=True)) for r in rows],
                                         schema=pa.schema([("i", pa.int32()), ("j", pa.int32()), ("product", pa.string())]))

    return (vectors.select("x").mapInArrow(frugal(run), "i int, j int, product string")
            .select("i", "j", F.col("product").cast("decimal(38,0)").alias("product")))


def whitened_rows(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened array<double>): every row by ``model``.

    ``deviation``, sum of (n * x - S)^2 over dimensions, is exact; whitening
    subtracts the mean from n * x as integers before anything is rounded.
    """
    n, sums = model.n, np.array(model.sums, object)
    scaled = model.axes / np.sqrt(model.values) / n

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(sums))
            most = int(np.abs(x).max(initial=0)) * n + max(map(abs, model.sums))
            kind = np.int64 if most < 1 << 62 else object
            gap = x.astype(kind) * n - sums.astype(kind)
            wide = len(sums) * int(np.abs(gap).max(initial=0)) ** 2 >= 1 << 63
            squares = (gap.astype(object) if wide else gap) ** 2
            white = gap.astype(np.float64) @ scaled
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([str(s) for s in squares.sum(1)], pa.string()),
                pa.array(list(white), pa.list_(pa.float64()))], names=["id", "deviation", "whitened"])

    kind = vectors.schema["id"].dataType.simpleString()
    return (vectors.select("id", "x").mapInArrow(frugal(run), f"id {kind}, deviation string, whitened array<double>")
            .withColumn("deviation", F.col("deviation").cast("decimal(38,0)")))


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity; one small row per task is collected."""
    schema = pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(components), np.zeros((components, components))
        for part in parts:
            w = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, components)
            n, sums, products = n + len(w), sums + w.sum(0), products + w.T @ w
        yield pa.RecordBatch.from_pylist([{"n": n, "sums": sums.tolist(), "products": products.ravel().tolist()}], schema=schema)

    at = lambda c, k: F.sum(F.get(c, F.lit(k)))
    got = (white.select("whitened").mapInArrow(frugal(run), "n long, sums array<double>, products array<double>")
           .agg(F.sum("n"), F.array(*(at("sums", k) for k in range(components))),
                F.array(*(at("products", k) for k in range(components ** 2)))).first())
    n, mean = got[0], np.array(got[1]) / got[0]
    found = np.array(got[2]).reshape(components, components) / n - np.outer(mean, mean)
    return float(np.abs(found - np.eye(components)).max())


def whiten(rows: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened array<double>, explained array<double>, identity_error), one row per whole vector."""
    vectors = materialise(whole_vectors(rows, id_col, vector_col), "whole-vectors")
    model = fit(vectors, components)
    if model is None or not len(model.values):
        kind = vectors.schema["id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"id {kind}, n long, deviation decimal(38,0), whitened array<double>, "
                                                     "explained array<double>, identity_error double")
    white = materialise(whitened_rows(vectors, model), "whitened")
    error = identity_error(white, len(model.values))
    return white.select("id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                        F.array(*(F.lit(float(e)) for e in model.explained)).alias("explained"),
                        F.lit(error).alias("identity_error"))
