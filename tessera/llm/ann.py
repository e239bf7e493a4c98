"""Approximate nearest neighbours by largest inner product: inverted lists and an adaptive scan of dimensions.

Centroids of the lists are fitted on a bounded sample; every row is put in a list. The number of lists grows with
the table: where the sample can't give enough centroids, a second level splits each list by what is left of a vector
after its centroid, so a list is a pair of centroids. In a list, vectors are randomly rotated and their columns are
looked at block by block. After each block a hypothesis test compares what a candidate has so far with what one would have that
ends above the query's threshold, the k-th best so far; candidates that fail it are abandoned. What remains is scored
exactly on the vectors as given.

How many lists a query probes is fitted too: a few queries are searched exactly against all rows, and ``RECALL`` of their
true neighbours must be in the lists probed. The nearest ``FIRST`` lists are searched first; their k-th best is the threshold
that the others start from. Queries that find less than k go on with more lists. Equal vectors are one candidate with as
many ids as can be asked for, and the rows and the queries of a list are dealt in blocks, so a large list is no single task's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.shared import settle, small_batches

#: Rows that centroids are fitted on at most, and queries that are searched exactly to fit the number of probes.
SAMPLE, TRIED = 16_384, 128
#: Rows that a list should have; most centroids of a level; share of true neighbours that the probed lists should hold.
LIST_ROWS, CENTROIDS, RECALL = 800, 2048, 0.985
#: Numbers in a block of rows and in a block of queries; queries scanned together.
BLOCK, TOGETHER = 1 << 19, 512
#: Columns in a block, and standard deviations that the test allows.
COLUMNS, Z = 16, 3.5
#: Lists of a query that set its first threshold.
FIRST = 4
#: Rows that are scanned between two looks at the thresholds.
STEP = 128


@dataclass
class Index:
    """Centroids of two levels, lists to probe, the width that vectors are padded to, and the type of their numbers."""

    upper: np.ndarray
    lower: np.ndarray
    probes: int
    width: int
    kind: type

    @property
    def lists(self) -> int:
        return len(self.upper) * len(self.lower)

    def list_of(self, x: np.ndarray) -> np.ndarray:
        """The list that holds each row."""
        x = x.astype(np.float32)
        upper = (x @ self.upper.T).argmax(1)
        if len(self.lower) == 1:
            return upper.astype(np.int32)
        left = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30) - self.upper[upper]
        lower = (left @ self.lower.T - (self.lower**2).sum(1) / 2).argmax(1)
        return (upper * len(self.lower) + lower).astype(np.int32)

    def nearest_lists(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n lists that are nearest to each row, nearest first."""
        x, n = x.astype(np.float32), min(n, self.lists)
        upper, lower, out = x @ self.upper.T, x @ self.lower.T, np.empty((len(x), n), np.int32)
        # The n nearest lists are of the n nearest upper centroids.
        some = np.argsort(-upper, 1, kind="stable")[:, :n]
        step = max(1, (1 << 22) // (some.shape[1] * len(self.lower)))
        for a in range(0, len(x), step):
            at = some[a : a + step]
            near = (np.take_along_axis(upper[a : a + step], at, 1)[:, :, None] + lower[a : a + step, None, :]).reshape(len(at), -1)
            best = np.argsort(-near, 1, kind="stable")[:, :n] if len(self.lower) > 1 else np.broadcast_to(np.arange(n), (len(at), n))
            out[a : a + step] = np.take_along_axis(at, best // len(self.lower), 1) * len(self.lower) + best % len(self.lower)
        return out


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(width: int) -> np.ndarray:
    """A random rotation, the same for each width."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(width)).standard_normal((width, width)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    out = np.zeros((len(column), width), kind)
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = values
    return out


def _means(x: np.ndarray, n: int, unit: bool) -> np.ndarray:
    """n centroids of the rows, by largest inner product on the unit sphere, or by least distance."""
    rng = np.random.Generator(np.random.PCG64(11))
    centroids = x[rng.choice(len(x), n, replace=False)].astype(np.float64)
    for _ in range(8):
        of = (x @ centroids.T - (0 if unit else (centroids**2).sum(1) / 2)).argmax(1)
        count = np.bincount(of, minlength=n)
        for j in range(x.shape[1]):
            centroids[:, j] = np.where(count > 0, np.bincount(of, x[:, j], n) / np.maximum(count, 1), centroids[:, j])
        if unit:
            centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    return centroids.astype(np.float32)


def _tried(index: Index, q: np.ndarray, query_ids: np.ndarray, k: int):
    """Rows (id, vector) to the k best of each query in a task, (query, score, list), scored in full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q64 = q.astype(np.float64)
        score, of = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int32)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), index.width, index.kind)
                near = q64 @ x.astype(np.float64).T
                near[query_ids[:, None] == batch.column(0).to_numpy()] = -np.inf
                near, held = np.concatenate([score, near], 1), np.concatenate([of, np.broadcast_to(index.list_of(x), near.shape)], 1)
                top = np.argsort(-near, 1, kind="stable")[:, :k]
                score, of = np.take_along_axis(near, top, 1), np.take_along_axis(held, top, 1)
        query, at = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(score[query, at]), pa.array(of[query, at])], ["query", "score", "list"])

    return run


def fit(vectors: DataFrame, k: int, sample: int = SAMPLE) -> Index | None:
    """An index from at most ``sample`` rows (id, vector), chosen by a hash of the id; None without rows.

    The number of probes is fitted with ``TRIED`` of these as queries against all rows.
    """
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not facts["n"]:
        return None
    kind = np.float32 if dict(vectors.dtypes)["vector"] == "array<float>" else np.float64
    rows = vectors.withColumn("h", F.xxhash64("id")).orderBy("h", "id", "vector").limit(sample).select("id", "vector").toArrow()
    ids, x = rows.column(0).to_numpy(), _matrix(rows.column(1).combine_chunks(), facts["width"], kind)
    wanted = max(1, facts["n"] // LIST_ROWS)
    upper = _means(x.astype(np.float32), int(min(wanted, CENTROIDS, -(-len(x) // 8))), True)
    lower = np.zeros((1, facts["width"]), np.float32)
    if wanted > len(upper):
        left = x / np.linalg.norm(x, axis=1, keepdims=True)
        left = (left - upper[(left @ upper.T).argmax(1)]).astype(np.float32)
        lower = _means(left, int(min(-(-wanted // len(upper)), CENTROIDS, -(-len(x) // 8))), False)
    index = Index(upper, lower, 1, facts["width"], kind)
    q, query_ids = x[:TRIED], ids[:TRIED]
    near = vectors.select("id", "vector").mapInArrow(_tried(index, q, query_ids, k), "query int, score double, list int")
    found = near.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "list"))).filter(F.col("rank") <= k).select("query", "list").collect()  # TRIED * k rows at most
    needed = [1]
    for n in range(len(q)):
        scores = (q[n].astype(np.float32) @ upper.T)[:, None] + q[n].astype(np.float32) @ lower.T
        needed += [int((scores > scores.ravel()[r["list"]]).sum()) + 1 for r in found if r["query"] == n]
    needed.sort()
    index.probes = needed[min(len(needed) - 1, int(RECALL * len(needed)))]
    return index


def _place(index: Index):
    """Rows (id, vector) with the list that holds each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), index.width, index.kind)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(index.list_of(x))], ["id", "raw", "list"])

    return run


def _ask(index: Index, probes: int):
    """Rows (id, vector) with the lists that each probes, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), index.width, index.kind)
                order = index.nearest_lists(x, probes)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * order.shape[1], pa.int32()), pa.array(order.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), lists], ["id", "raw", "lists"])

    return run


def scan(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, score) of the k best of each query that the tests leave, by score and then id, none below its ``floor``."""
    width = x.shape[1]
    turn = rotation(width)
    xr, qr = x.astype(np.float32) @ turn, q.astype(np.float32) @ turn
    x_norm, q_norm = np.linalg.norm(xr, axis=1), np.linalg.norm(qr, axis=1)
    x64, q64 = x.astype(np.float64), q.astype(np.float64)
    best = np.full((len(q), 0), -np.inf)
    found: list[tuple] = []
    for a in range(0, len(x), STEP):
        rows = slice(a, a + STEP)
        threshold = np.maximum(best.min(1), floor) if best.shape[1] >= k else floor
        sofar = qr[:, :COLUMNS] @ xr[rows, :COLUMNS].T
        qi, xi = np.nonzero(query_ids[:, None] != ids[None, rows])
        part = sofar[qi, xi]
        xi += a
        for seen in range(COLUMNS, width, COLUMNS):
            share = seen / width
            spread = q_norm[qi] * x_norm[xi] * np.sqrt(share * (1 - share) / width)
            alive = part >= threshold[qi] * share - Z * spread
            qi, xi, part = qi[alive], xi[alive], part[alive]
            part = part + np.einsum("ij,ij->i", qr[qi, seen : seen + COLUMNS], xr[xi, seen : seen + COLUMNS])
        alive = part >= threshold[qi] - 1e-4 * (1 + np.abs(threshold[qi]))
        qi, xi = qi[alive], xi[alive]
        score = np.einsum("ij,ij->i", q64[qi], x64[xi])
        high = score >= floor[qi]
        qi, xi, score = qi[high], xi[high], score[high]
        found.append((qi, xi, score))
        order = np.lexsort((-score, qi))
        place = np.arange(len(qi)) - np.searchsorted(qi[order], qi[order])
        fresh = np.full((len(q), k), -np.inf)
        keep = place < k
        fresh[qi[order][keep], place[keep]] = score[order][keep]
        best = -np.sort(-np.concatenate([best, fresh], 1), 1)[:, :k]
    qi, xi, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
    order = np.lexsort((ids[xi], -score, qi))
    qi, xi, score = qi[order], xi[order], score[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[keep], xi[keep], score[keep]


def nearest(data: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found of each row where ``is_query`` (a column of id).

    Largest inner product first, ties to the smaller id; all candidates if there are fewer. Rows without id, and vectors
    that are null, empty, zero or not finite, take no part, and a row is no candidate of a query of its id. Shorter vectors count as
    padded with zeros. Rows of equal id stay candidates each; of queries of one id, one is asked. Float vectors are taken as they are, others as doubles.
    Other columns are not looked at.
    """
    small_batches(data)
    kind = "float" if dict(data.select(F.col(vector_col).alias("v")).dtypes)["v"] == "array<float>" else "double"
    rows = data.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    out = "query_id long, rank int, vec_id long, score double"
    index = fit(rows.select("id", "vector"), k)
    if index is None:
        return data.sparkSession.createDataFrame([], out)
    # Of equal vectors only those with the k + 1 least ids can be among the k nearest of a query.
    same = F.dense_rank().over(W.partitionBy(F.xxhash64("raw"), "raw").orderBy("id"))
    placed = rows.select("id", "vector").mapInArrow(_place(index), "id long, raw binary, list int").withColumn("same", same)
    placed = settle(placed.filter(F.col("same") <= k + 1).drop("same"))
    queries = settle(rows.filter("asks").select("id", "vector").dropDuplicates(["id"]))
    most = max(64, BLOCK // index.width)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            left = left.sort_values("id")
            ids = left["id"].to_numpy()
            x = np.frombuffer(b"".join(left["raw"]), index.kind).reshape(len(left), -1)
            for a in range(0, len(right), TOGETHER):
                some = right.iloc[a : a + TOGETHER]
                query_ids = some["id"].to_numpy()
                q = np.frombuffer(b"".join(some["raw"]), index.kind).reshape(len(some), -1)
                qi, xi, score = scan(ids, x, query_ids, q, some["floor"].to_numpy(), k)
                found.append(pd.DataFrame({"query_id": query_ids[qi], "vec_id": ids[xi], "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    def search(some: DataFrame) -> DataFrame:
        """Each pair of a block of rows and a block of queries of a list is one group; a row goes to as many as have queries for it."""
        pairs = some.select("id", "raw", "floor", F.explode("lists").alias("list"))
        rows_of, asked = (t.groupBy("list").agg(F.ceil(F.count("*") / most).cast("int").alias(n)) for t, n in ((placed, "blocks"), (pairs, "parts")))
        shape = settle(rows_of.join(asked, "list"))
        own = F.xxhash64("id", "raw")
        left = placed.join(shape, "list").withColumn("block", F.pmod(own, F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        right = pairs.join(shape, "list").withColumn("part", F.pmod(own, F.col("parts")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        keys = ["list", "block", "part"]
        return left.select(*keys, "id", "raw").groupBy(*keys).cogroup(right.select(*keys, "id", "raw", "floor").groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")

    def best(near: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
        return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    lowest, probes = F.lit(float("-inf")), index.probes
    asks = settle(queries.mapInArrow(_ask(index, probes), "id long, raw binary, lists array<int>"))
    found = settle(best(search(asks.withColumn("lists", F.slice("lists", 1, FIRST)).withColumn("floor", lowest))))
    done = min(FIRST, probes)
    while True:
        if done < probes:
            floors = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
            later = asks.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", lowest)).withColumn("lists", F.slice("lists", done + 1, probes - done))
            found = settle(best(found.drop("rank").unionByName(search(later))))
            done = probes
        if probes == index.lists:
            return found
        # Lists can be small: queries with less than k found go on, if need be to all lists.
        full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
        short = settle(queries.join(full, "id", "left_anti"))
        if short.isEmpty():
            return found
        probes = min(index.lists, 8 * probes)
        asks = settle(short.mapInArrow(_ask(index, probes), "id long, raw binary, lists array<int>"))
