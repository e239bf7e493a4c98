"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and the L1 term leaves most weights at zero, so what goes to
the executors is a short list of buckets and weights, at most 2**BITS of them. A document's features are the
different buckets of its words, word pairs and pairs with one word between.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import small_batches
from tessera.llm.textops import BASE, LOWER, chunks, hash_runs, mix, runs

BITS = 18
#: Labelled rows that the model is fitted on at most, chosen by a hash of their id.
SAMPLE = 12_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
#: How much more an example of the rarer, toxic class counts, so that one telling word is enough.
POSITIVE = 3.0
#: Examples seen at least, by going over a small sample again, and most rounds.
STEPS, ROUNDS = 24_000, 12

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Weights:
    """The weights that are not zero, by bucket, and the constant term."""

    bias: float = 0.0
    bucket: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first and end row, then buckets and the row, from the first, that each is of."""
    for a, b, data, off in chunks(column):
        data = LOWER[data]
        starts, ends, row_words = runs(_IN_WORD[data], off)
        h = hash_runs(data, starts, ends)
        row = np.repeat(np.arange(b - a), np.diff(row_words))
        found, of = [mix(h + np.uint64(1))], [row]
        for gap in (1, 2):
            pair = row[gap:] == row[: len(row) - gap]
            found.append(mix(h[: len(h) - gap] * BASE + h[gap:] + np.uint64(2 + gap))[pair])
            of.append(row[gap:][pair])
        yield a, b, (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(of)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists: list = []
        for a, b, bucket, row in features(batch.column(2)):
            key = np.unique((row << BITS) | bucket)
            at = np.searchsorted(key >> BITS, np.arange(b - a + 1))
            lists += [key[at[k] : at[k + 1]] & ((1 << BITS) - 1) for k in range(b - a)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(lists, pa.list_(pa.int32()))], ["h", "y", "label_id", "buckets"])


def train(examples: list[np.ndarray], labels: np.ndarray) -> Weights:
    """FTRL-proximal over the examples in their order, round after round."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the constant term, without L1
    for _ in range(int(np.clip(-(-STEPS // max(1, len(examples))), 2, ROUNDS))):
        for x, y in zip(examples, labels, strict=True):
            i = np.append(x, size)
            zi, ni = z[i], n[i]
            root = np.sqrt(ni)
            shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0)
            shrunk[-1] = zi[-1]
            w = -shrunk / ((BETA + root) / ALPHA + L2)
            g = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y) * (POSITIVE if y else 1.0)
            z[i] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[i] = ni + g * g
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    shrunk[-1] = z[-1]
    w = -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)
    kept = np.flatnonzero(w[:-1])
    return Weights(float(w[-1]), kept, w[kept])


def _train_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = [b for b in batches if b.num_rows]
    if table:
        rows = sorted(((h, y, x.values.to_numpy()) for b in table for h, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True)), key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))
        w = train([r[2] for r in rows], np.array([r[1] for r in rows], float))
        yield pa.RecordBatch.from_arrays([pa.array([w.bias]), pa.array([w.bucket]), pa.array([w.weight])], ["bias", "bucket", "weight"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` rows of ``labels`` (id, label) and a text for each.

    The features of the sample meet in one task, which is bounded by ``sample`` lists of at most 2**BITS buckets. Null labels are left
    out; without any labelled text all weights are zero. Of several texts of one id the one with the least features counts.
    """
    small_batches(docs)
    known = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("label_id"), (F.col(label_col) > 0).cast("int").alias("y"))
    chosen = known.withColumn("h", F.xxhash64("label_id")).orderBy("h", "label_id", "y").limit(sample)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = text.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("h", "y", "text", F.col("label_id").cast("string").alias("label_id"))  # ``chosen`` has at most ``sample`` rows
    featured = rows.mapInArrow(_featurise, "h long, y int, label_id string, buckets array<int>")
    once = featured.groupBy("h", "y", "label_id").agg(F.min("buckets").alias("buckets")).select("h", "y", "buckets")
    trained = once.repartition(1).mapInArrow(_train_sample, "bias double, bucket array<long>, weight array<double>").collect()
    return Weights(trained[0][0], np.array(trained[0][1], np.int64), np.array(trained[0][2])) if trained else Weights()


def score(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of each row; the whole text counts, null as empty. Nothing but the text is looked at."""
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[weights.bucket] = weights.weight
        used = dense != 0
        for batch in batches:
            total = np.full(batch.num_rows, weights.bias)
            for a, b, bucket, row in features(batch.column(1)):
                hit = used[bucket]
                key = np.unique((row[hit] << BITS) | bucket[hit])
                total[a:b] += np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], b - a)
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """``score`` for all documents by weights that are fitted on labels that are not ``held_out`` (a column of doc_id).

    Repeated rows each get their score; empty tables give an empty result; a null id is not held out.
    """
    weights = fit(docs, labels.filter(~held_out))
    return score(docs, weights).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
