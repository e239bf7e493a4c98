"""Embedding whitening from exact cross-products, by bit-sliced scatter.

Entries become whole numbers. Each dimension is shifted to start at 0 and cut into bit planes; a plane of a block of rows is packed into
64-bit words, and the number of common bits of two planes, by AND and popcount, counts 2**(a + b) times in the cross-product of their
dimensions. The sums are whole numbers, so they are exact in any order of rows and tasks. They are centred as whole numbers, and only
then become the floating-point matrix whose eigenvectors are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import settle, small_batches

#: x = floor(SCALE * c) + OFFSET of an entry c.
SCALE, OFFSET = 1024, 100_000
#: Rows whose planes are packed at a time.
BLOCK = 1 << 14
#: Products travel in parts of so many bits, so that sums over all tasks fit in a long.
LIMB, LIMBS = 40, 4


@dataclass
class Fit:
    """What whitening needs: the number of vectors, sums by dimension, and components as columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def whole_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors that take part, as whole numbers.

    Null vectors and those with null or non-finite entries are left out; one whose length is not the most frequent (of several, the largest)
    lacks entries, and is left out too. An entry too large for a long is an error.
    """
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(v.isNotNull() & finite)
    usual = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    whole = F.transform(v, lambda c: F.floor(c * SCALE) + OFFSET)
    return rows.filter(F.size("v") == (usual["width"] if usual else 0)).select("vec_id", whole.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def dimension_bounds(vectors: DataFrame) -> list[tuple[int, int, int, int]]:
    """(n, sum, least, largest) of each dimension of (x), in order; tasks give a row for each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, None, None, None
        for batch in batches:
            x = matrix(batch.column(0))
            if not x.size:
                continue
            # Sums of halves, as a sum of longs may not fit in a long.
            part = ((x >> 32).sum(0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(0)
            total = part if total is None else total + part
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"k": range(len(low)), "n": [n] * len(low), "hi": [int(t) >> 32 for t in total], "lo": [int(t) & 0xFFFFFFFF for t in total], "low": low, "high": high}, schema=pa.schema([(c, pa.int64()) for c in ("k", "n", "hi", "lo", "low", "high")]))

    rows = vectors.select("x").mapInArrow(partial, "k long, n long, hi long, lo long, low long, high long")
    found = rows.groupBy("k").agg(F.sum("n"), F.sum("hi"), F.sum("lo"), F.min("low"), F.max("high")).collect()  # a row for each dimension
    return [(n, (hi << 32) + lo, low, high) for _, n, hi, lo, low, high in sorted(map(tuple, found))]


def planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The bit planes of each dimension of a block, the low bit first, a row of 64-bit words each."""
    shifted = (x - low).astype(np.uint64)  # differences of longs, right as unsigned numbers
    words = -(-len(x) // 64)
    out = np.zeros((int(bits.sum()), words * 8), np.uint8)
    k = 0
    for d, width in enumerate(bits):
        for b in range(width):
            packed = np.packbits((shifted[:, d] >> np.uint64(b)) & np.uint64(1) != 0)
            out[k, : len(packed)] = packed
            k += 1
    return out.view(np.uint64)


def add_products(total: np.ndarray, block: np.ndarray, bits: np.ndarray) -> None:
    """Add to ``total`` [i, j], i <= j, the sums over a block of planes of the shifted entries of dimensions i and j."""
    first = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    weight = np.concatenate([np.arange(w) for w in bits]) if len(block) else np.zeros(0, int)
    used = np.flatnonzero(bits)  # a dimension with one value has no planes and no products
    for i in used:
        rest = block[first[i] :]
        starts = first[used[used >= i]] - first[i]
        for a in range(bits[i]):
            counts = np.bitwise_count(rest[a] & rest).sum(1, dtype=np.int64)
            sums = np.add.reduceat(counts.astype(total.dtype) << (weight[first[i] :].astype(total.dtype) + a), starts)
            total[i, used[used >= i]] += sums


def shifted_products(vectors: DataFrame, low: list[int], high: list[int], rows: int) -> np.ndarray:
    """The exact matrix of sums of products of the shifted entries of (x), as Python numbers.

    Each task gives one row for each pair of dimensions, and Spark adds these; the driver has one matrix of width x width.
    """
    d = len(low)
    bits = np.array([(h - a).bit_length() for a, h in zip(low, high, strict=True)], int)
    # Longs, where all sums of a task are sure to fit.
    kind = np.int64 if 2 * int(bits.max(initial=0)) + rows.bit_length() < 62 else object
    lows = np.array(low, np.int64)
    names = ["i", "j", *(f"l{k}" for k in range(LIMBS))]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d), kind), False
        for batch in batches:
            x = matrix(batch.column(0))
            for a in range(0, len(x), BLOCK):
                add_products(total, planes(x[a : a + BLOCK], lows, bits), bits)
                seen = True
        if seen:
            i, j = np.triu_indices(d)
            values = total[i, j].astype(object)
            limbs = [((values >> (LIMB * k)) & ((1 << LIMB) - 1)).astype(np.int64) for k in range(LIMBS)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (i, j, *limbs)], names=names)

    parts = vectors.select("x").mapInArrow(partial, ", ".join(f"{c} long" for c in names))
    found = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names[2:]]).toArrow()
    out = np.zeros((d, d), object)
    columns = [found.column(c).to_pylist() for c in names]
    for i, j, *limbs in zip(*columns, strict=True):
        out[i, j] = out[j, i] = sum(v << (LIMB * k) for k, v in enumerate(limbs))
    return out


def fit(vectors: DataFrame) -> Fit | None:
    """Components of all of (x); None without vectors or entries.

    Eigenvectors have their largest entry positive. Each eigenvalue that is 0 but for rounding is 0.
    """
    bounds = dimension_bounds(vectors)
    if not bounds:
        return None
    n, sums = bounds[0][0], [b[1] for b in bounds]
    low, high = [b[2] for b in bounds], [b[3] for b in bounds]
    shifted = np.array([s - n * a for s, a in zip(sums, low, strict=True)], object)
    centred = n * shifted_products(vectors, low, high, n) - np.outer(shifted, shifted)  # n * n times the covariance, exactly
    covariance = np.array([[v / (n * n) for v in row] for row in centred], float)
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1].copy(), vectors_[:, ::-1]
    values[values <= np.finfo(float).eps * len(values) * max(values[0], 0)] = 0
    largest = np.abs(vectors_).argmax(0)
    vectors_ = vectors_ * np.where(vectors_[largest, np.arange(len(values))] < 0, -1.0, 1.0)
    trace = sum(centred.diagonal()) / (n * n)
    explained = values / trace if trace else np.full(len(values), np.nan)
    return Fit(n, sums, values, vectors_, explained)


def whiten(vectors: DataFrame, model: Fit, components: int) -> DataFrame:
    """(vec_id, deviation, whitened): the squared distance of n * x from the sums, exact, and the vector's first components over their standard deviations.

    A component without variance is null for all rows; a deviation that does not fit in a long is null.
    """
    k = min(components, len(model.values))
    known = model.values[:k] > 0
    scale = model.vectors[:, :k] / np.where(known, np.sqrt(np.where(known, model.values[:k], 1)), 1)
    n, sums = model.n, model.sums
    sent = vectors.sparkSession.sparkContext.broadcast((scale, known, n, sums))  # k columns of as many numbers as a vector has
    ident = vectors.schema["vec_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, known, n, sums = sent.value
        small = np.array(sums, float)
        for batch in batches:
            x = matrix(batch.column(1))
            # Longs where all products and their sum are sure to fit, Python numbers elsewhere.
            far = np.abs(x.astype(float) * n - small).max(initial=0) ** 2 * max(1, len(sums))
            fits = far < 2.0**62 and np.abs(x.astype(float)).max(initial=0) * n < 2.0**62 and np.abs(small).max(initial=0) < 2.0**62
            off = x * n - np.array(sums, np.int64) if fits else x.astype(object) * n - np.array(sums, object)
            squares = (off * off).sum(1)
            deviation = pa.array([int(s) if s < 2**63 else None for s in squares], pa.int64())
            white = (off / n).astype(float) @ scale
            cells = pa.array(white.ravel(), mask=np.tile(~known, len(x)))
            lists = pa.ListArray.from_arrays(np.arange(0, len(cells) + 1, max(1, len(known)), dtype=np.int32), cells)
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], names=["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(project, f"vec_id {ident}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """The largest absolute entry of the covariance of (whitened) less the identity, from all rows; None without a component that varies."""
    each = [F.get("whitened", F.lit(k)) for k in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = whitened.agg(*[F.covar_pop(each[i], each[j]) for i, j in pairs]).first()
    errors = [abs(v - (i == j)) for (i, j), v in zip(pairs, row, strict=True) if v is not None]
    return max(errors, default=None)


def whiten_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """Whitened components of each vector: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    A row for each row of ``embeddings`` that takes part (see ``whole_vectors``) and each component, of which there are at most as many as
    entries. Repeated rows and null ids are rows as all others. Without variance ``whitened`` is null, and ``explained`` is null if there is
    none at all. ``deviation`` is null beyond a long. Other columns are not looked at. No rows give no rows.
    """
    small_batches(embeddings)
    vectors = settle(whole_vectors(embeddings, id_col, vector_col))
    model = fit(vectors)
    if model is None:
        null = lambda kind: F.lit(None).cast(kind)
        return vectors.limit(0).select("vec_id", null("int").alias("component"), null("long").alias("n"), null("long").alias("deviation"), null("double").alias("whitened"), null("double").alias("explained"), null("double").alias("identity_error"))
    k = min(components, len(model.values))
    found = settle(whiten(vectors, model, k))
    error = identity_error(found, k)
    explained = F.array(*[F.lit(None if np.isnan(v) else float(v)).cast("double") for v in model.explained[:k]])
    rows = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
