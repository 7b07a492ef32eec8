"""Whitening of embeddings from exact integer cross-products of bit-sliced vectors.

Entries become integers, x = floor(256 c). The covariance is over the distinct vectors (the fit list). Every dimension is
shifted by its minimum, and block by block its bit planes are packed across rows into 64-bit words. A cross-product of two
dimensions is the sum of 2^(a+b) times the bits that plane a of the one and plane b of the other have in common, so tasks
only count bits; Spark adds the counts per pair of dimensions and a+b, and the driver, which gets them for each pair of dimensions,
never rows, weighs and centres them as integers: n Σxy - Σx Σy is exact at any size. Only then it becomes a matrix of doubles for
eigh.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.workspace import materialize

SCALE = 256
#: Rows whose planes are packed at a time (a multiple of 64): the words of two planes then stay in a processor's cache.
BLOCK = 1 << 13
VECTOR = "vec_id BIGINT, x ARRAY<BIGINT>"
OUT = ("vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE")


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id and x of the rows whose vector has no null and no non-finite entry."""
    entry = F.col("embedding")
    finite = F.forall(entry, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    whole = embeddings.select("vec_id", "embedding").where(entry.isNotNull() & finite)
    return whole.select("vec_id", F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("x"))


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch whose column x has lists of `dims` integers."""
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def extent(fit: DataFrame, dims: int) -> list[tuple[int, int]]:
    """(minimum, maximum) of each dimension."""

    def run(batches):
        low, high = np.full(dims, np.iinfo(np.int64).max), np.full(dims, np.iinfo(np.int64).min)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, dims)
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if low[0] <= high[0]:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(dims), "low": low, "high": high})

    found = fit.select("x").mapInArrow(run, "dim BIGINT, low BIGINT, high BIGINT").groupBy("dim").agg(F.min("low"), F.max("high"))
    return [(low, high) for _, low, high in sorted(found.collect())]


@dataclass
class Planes:
    """Which bit planes the shifted dimensions have: plane p is bit `bit[p]` of dimension `dim[p]`."""

    low: np.ndarray
    dim: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, spans: list[tuple[int, int]]) -> Planes:
        widths = [(high - low).bit_length() for low, high in spans]
        return cls(np.array([low for low, _ in spans], np.int64), np.repeat(np.arange(len(spans)), widths),
                   np.concatenate([np.arange(w) for w in widths]).astype(np.int64) if widths else np.zeros(0, np.int64))

    def pack(self, x: np.ndarray) -> np.ndarray:
        """One row of words for each plane; missing rows of the last word are zero."""
        with np.errstate(over="ignore"):
            shifted = (x.astype(np.uint64) - self.low.astype(np.uint64)).T
        bits = (shifted[self.dim] >> self.bit[:, None].astype(np.uint64)).astype(np.uint8) & np.uint8(1)
        padded = np.zeros((len(self.dim), -(-bits.shape[1] // 64) * 64), np.uint8)
        padded[:, :bits.shape[1]] = bits
        return np.packbits(padded, axis=1).view(np.uint64)


def common_bits(words: np.ndarray) -> np.ndarray:
    """For planes p <= q the number of rows that have both bits; the rest is zero."""
    out = np.zeros((len(words), len(words)), np.int64)
    for p in range(len(words)):
        out[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """Matrices of `BLOCK` rows and a smaller last one."""
    held, rows = [], 0
    for batch in batches:
        x = matrix(batch, dims)
        while len(x):
            take = x[:BLOCK - rows]
            held.append(take)
            rows, x = rows + len(take), x[len(take):]
            if rows == BLOCK:
                yield np.concatenate(held)
                held, rows = [], 0
    if rows:
        yield np.concatenate(held)


def cross_products(fit: DataFrame, spans: list[tuple[int, int]]) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums and the sums of products of all dimensions over `fit`, as exact integers."""
    dims, planes = len(spans), Planes.of(spans)

    def run(batches):
        n, single, both = 0, np.zeros(len(planes.dim), np.int64), np.zeros((len(planes.dim),) * 2, np.int64)
        for x in _blocks(batches, dims):
            words = planes.pack(x)
            both += common_bits(words)
            n += len(x)
        if not n:
            return
        single = np.diag(both)
        # A product of bits a and b has the weight 2^(a+b); pairs of planes of one dimension count from both sides.
        p, q = np.nonzero(both)
        low, high = planes.dim[p], planes.dim[q]
        twice = np.where((low == high) & (p != q), 2, 1)
        key = (low * dims + high) * 128 + planes.bit[p] + planes.bit[q]
        keys, at = np.unique(key, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, both[p, q] * twice)
        where = np.flatnonzero(single)
        yield pa.RecordBatch.from_pydict({
            "i": np.r_[-1, planes.dim[where], keys // 128 // dims], "j": np.r_[-1, np.full(len(where), -1), keys // 128 % dims],
            "power": np.r_[0, planes.bit[where], keys % 128], "bits": np.r_[n, single[where], total]})

    counted = fit.select("x").mapInArrow(run, "i BIGINT, j BIGINT, power BIGINT, bits BIGINT")
    counted = counted.groupBy("i", "j", "power").agg(F.sum("bits").alias("bits"))
    n, sums, products = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    for i, j, power, bits in counted.collect():
        if i < 0:
            n = bits
        elif j < 0:
            sums[i] += bits << power
        else:
            products[i][j] += bits << power
    # Back from shifted entries u = x - low to x.
    low = [a for a, _ in spans]
    for i in range(dims):
        for j in range(i, dims):
            products[i][j] += low[j] * sums[i] + low[i] * sums[j] + n * low[i] * low[j]
            products[j][i] = products[i][j]
    return n, [s + n * a for s, a in zip(sums, low)], products


@dataclass
class Model:
    """n, sums S, and up to `len(values)` components (columns of `vectors`) with their eigenvalues and shares."""

    n: int
    sums: list[int]
    largest: int
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @classmethod
    def fit(cls, n: int, sums: list[int], products: list[list[int]], spans: list[tuple[int, int]], components: int) -> Model:
        dims = range(len(sums))
        # Division of integers is rounded once, so every entry is the closest double.
        v = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in dims] for i in dims])
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        some = values > len(sums) * np.finfo(float).eps * max(values[0], 0)
        values, vectors = values[some], vectors[:, some]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        largest = sum(max(abs(n * low - s), abs(n * high - s)) ** 2 for (low, high), s in zip(spans, sums))
        return cls(n, sums, largest, vectors, values, values / np.trace(v))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S: 64-bit integers where they fit, else Python's."""
        if self.largest >= 1 << 62:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def deviation(self, centred: np.ndarray) -> list[int | None]:
        """Σ (n x - S)^2, null where a BIGINT cannot hold it."""
        total = (centred * centred).sum(axis=1)
        return [t if -(1 << 63) <= t < 1 << 63 else None for t in total.tolist()]

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def whiten(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of each vector and component.

    Rows without vector, or with a null or non-finite entry, are left out, and so are vectors without entries and those of another
    length than most have (ties: the longer). Repeated rows are rows of their own, but fitted once. A null vec_id stays null.
    Components without variance are not given, so a table with one distinct vector, like an empty one, has no rows; a
    deviation beyond 64 bits is null. Other columns are ignored. `identity_error` is one value: the largest absolute entry of the
    covariance of whitened over the fit list, minus the identity.
    """
    spark = embeddings.sparkSession
    whole = integers(embeddings)
    lengths = whole.groupBy(F.size("x").alias("size")).count().where("size > 0").orderBy(F.desc("count"), F.desc("size")).first()
    empty = spark.createDataFrame([], f"{OUT}, identity_error DOUBLE")
    if lengths is None:
        return empty
    dims = lengths["size"]
    whole = whole.where(F.size("x") == dims)
    fit = materialize(whole.select("x").distinct(), "whitening-fit")
    spans = extent(fit, dims)
    model = Model.fit(*cross_products(fit, spans), spans, components)
    k = len(model.values)
    if not k:
        return empty
    names = [f"z{i}" for i in range(k)]

    def project(batches):
        for batch in batches:
            z = model.whiten(model.centred(matrix(batch, dims)))
            yield pa.RecordBatch.from_arrays([pa.array(z[:, i]) for i in range(k)], names=names)

    def describe(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                centred = model.centred(matrix(part, dims))
                rows, z = part.num_rows, model.whiten(centred)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)),
                    pa.array([d for d in model.deviation(centred) for _ in range(k)], pa.int64()), pa.array(z.reshape(-1)),
                    pa.array(np.tile(model.explained, rows))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    z = fit.mapInArrow(project, ", ".join(f"{c} DOUBLE" for c in names))
    covariance = z.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for (i, j), c in zip(pairs, covariance)) if math.isfinite(sum(covariance)) else math.nan
    return whole.mapInArrow(describe, OUT).withColumn("identity_error", F.lit(float(error)))
