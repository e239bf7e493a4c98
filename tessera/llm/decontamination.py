"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ten words. A window is joined by its shingles: these are put in order of how often they occur in
all documents, rarest first. Containment must be whole, so one shingle, the rarest, is the prefix that a document must share. Where
it does, the shingle's place in the window says where the window would begin and end in the document: a place outside the text is no
candidate. What is left is held against the document's words, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.shared import settle, small_batches
from tessera.llm.textops import BASE, LOWER, chunks, hash_runs, mix, runs

#: Words of a window, and of a shingle.
WIDTH, SHINGLE = 10, 3
#: Bits of the filter that scans documents for shingles of items. What passes it by chance is found out by joins, at any number of items.
FILTER_BITS = 24

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_SHIFT = np.uint64(64 - FILTER_BITS)


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in lower case, starts and ends of words, and the offsets of rows in those."""
    data = LOWER[data]
    return (data, *runs(_IN_WORD[data], off))


def shingles(words: np.ndarray, row_words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``size`` words inside a row."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(row_words) - 1), np.diff(row_words))
    h = np.zeros(count, np.uint64)
    for k in range(size):
        h = (h + words[k : k + count]) * BASE
    at = np.flatnonzero(row[:count] == row[size - 1 :])
    return mix(h[at] + np.uint64(size)), at


def item_windows(items: DataFrame, width: int = WIDTH, size: int = SHINGLE) -> DataFrame:
    """(item_id, text, length, shingles): the windows of each item, their words joined by spaces, and the hashes of their shingles in order.

    An item of fewer than ``width`` words is one window, one without words none; a window shorter than ``size`` is its own shingle.
    """
    small_batches(items)
    ident = items.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, raw, off in chunks(batch.column(1)):
                data, starts, ends, row_words = words_of(raw, off)
                h = hash_runs(data, starts, ends)
                for r, (lo, hi) in enumerate(zip(row_words[:-1].tolist(), row_words[1:].tolist(), strict=True)):
                    if lo == hi:
                        continue
                    length = min(width, hi - lo)
                    of, _ = shingles(h[lo:hi], np.array([0, hi - lo]), min(size, length))
                    words = [data[s:e].tobytes().decode() for s, e in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist(), strict=True)]
                    per = length - min(size, length) + 1
                    ids = batch.column(0).slice(a + r, 1)
                    for first in range(0, hi - lo - length + 1, 1000):
                        at = range(first, min(first + 1000, hi - lo - length + 1))
                        out = {"text": [" ".join(words[k : k + length]) for k in at], "length": pa.array([length] * len(at), pa.int32()), "shingles": [of[k : k + per].astype(np.int64).tolist() for k in at]}
                        yield pa.RecordBatch.from_pydict({"item_id": ids.take(pa.array([0] * len(at))), **out})

    return items.mapInArrow(cut, f"item_id {ident}, text string, length int, shingles array<long>")


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A table of 2**FILTER_BITS marks, in bytes of eight, of the column ``h``: a bounded size, whatever the number of hashes."""
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    parts = hashes.groupBy(F.shiftright(slot, 5).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 32).cast("int"))).alias("bits"))
    found = parts.toArrow()  # at most 2**(FILTER_BITS - 5) rows
    words = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return words


def passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash has its mark."""
    slot = h >> _SHIFT
    return (words[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def shingle_counts(docs: DataFrame, hashes: DataFrame, sizes: list[int]) -> DataFrame:
    """(h, n): how often each of ``hashes`` (h) occurs in all texts, 0 included."""
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(hashes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, off in chunks(batch.column(0)):
                data, starts, ends, row_words = words_of(raw, off)
                words = hash_runs(data, starts, ends)
                for size in sizes:
                    h, _ = shingles(words, row_words, size)
                    some, n = np.unique(h[passes(sent.value, h)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    found = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return hashes.join(found, "h", "left").select("h", F.coalesce("n", F.lit(0)).alias("n"))


def candidates(docs: DataFrame, prefixes: DataFrame, sizes: list[int], width: int) -> DataFrame:
    """(row, doc_id, n_words, at, h, before, context): a row without ``h`` for each document, and one for each shingle that may be a prefix.

    ``row`` names the document's row, as ids may be null or repeated. ``context`` are the words around the shingle that a window with
    it could hold, joined by spaces, ``before`` of them in front of it.
    """
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(prefixes))
    ident = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_words", "at", "h", "before", "context"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, off in chunks(batch.column(1)):
                data, starts, ends, row_words = words_of(raw, off)
                words = hash_runs(data, starts, ends)
                n = np.diff(row_words)
                rows = row + np.arange(b - a)
                row += b - a
                none = lambda kind: pa.nulls(b - a, kind)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(rows), ids.slice(a, b - a), pa.array(n), none(pa.int64()), none(pa.int64()), none(pa.int32()), none(pa.string())], names=names)
                body = None
                for size in sizes:
                    h, at = shingles(words, row_words, size)
                    hit = passes(sent.value, h)
                    h, at = h[hit], at[hit]
                    if not len(h):
                        continue
                    if body is None:  # words with one space after each
                        keep = _IN_WORD[data].copy()
                        keep[ends[ends < len(data)]] = True
                        gap = np.where(_IN_WORD[data], data, 32).astype(np.uint8)
                        # Words at the end of a row that meet the next row's have no byte between them, so ends are found by word.
                        place = np.concatenate([[0], np.cumsum(keep)])
                        body = gap[keep].tobytes()
                    of = np.searchsorted(row_words, at, "right") - 1
                    first = np.maximum(row_words[of], at - (width - size))
                    last = np.minimum(row_words[of + 1], at + width) - 1
                    texts = [body[s:e].decode() for s, e in zip(place[starts[first]].tolist(), place[ends[last]].tolist(), strict=True)]
                    local = at - row_words[of]
                    for k in range(0, len(h), 10_000):
                        part = slice(k, k + 10_000)
                        columns = [pa.array(rows[of[part]]), ids.slice(a, b - a).take(pa.array(of[part])), pa.array(n[of[part]]), pa.array(local[part]), pa.array(h[part].astype(np.int64)), pa.array((at - first)[part].astype(np.int32)), pa.array(texts[part], pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(scan, f"row long, doc_id {ident}, n_words long, at long, h long, before int, context string")


def _merged(spans: DataFrame) -> DataFrame:
    """(row, spans): the union of the spans (row, first, past) of each row, as (first, past) in order."""
    ends = spans.groupBy("row", "first").agg(F.max("past").alias("past"))
    order = W.partitionBy("row").orderBy("first")
    reach = F.max("past").over(order.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("first") <= reach, 0).otherwise(1)).over(order)
    whole = ends.withColumn("island", island).groupBy("row", "island").agg(F.min("first").alias("first"), F.max("past").alias("past"))
    return whole.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "past"))).alias("spans"))


def find_contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, size: int = SHINGLE) -> DataFrame:
    """Where documents hold windows of items: doc_id, n_words, spans, items.

    Words are runs of digits, a to z, and characters from U+0080, after A to Z are put in lower case. ``spans`` are the hit words,
    as arrays of (first, past), word numbers from 0, with no overlap; ``items`` the ids, as strings in order, of the items that have an
    occurring window. Both are empty where there is none. ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not
    looked at. A row for each row of ``docs``: null and repeated ids are rows of their own. Null and empty texts have no words. A window of
    several items is compared once. An item without id marks words, but is in no list. Empty tables are like any other.
    """
    docs = docs.select("doc_id", "text")
    windows = settle(item_windows(items.select("item_id", "text"), width, size))
    different = windows.groupBy("text").agg(F.first("length").alias("length"), F.first("shingles").alias("shingles"))
    lengths = sorted(r[0] for r in windows.select(F.least("length", F.lit(size)).alias("k")).distinct().collect())  # at most ``size``
    of_items = different.select(F.explode("shingles").alias("h")).distinct()
    counts = settle(shingle_counts(docs, of_items, lengths))
    ranked = different.select("text", "length", F.posexplode("shingles").alias("offset", "h")).join(counts, "h")
    # A shingle that no document has rules its window out.
    rarest = ranked.groupBy("text", "length").agg(F.min(F.struct("n", "h", "offset")).alias("m")).filter("m.n > 0").select("text", "length", "m.h", "m.offset")
    prefixes = settle(rarest)
    found = settle(candidates(docs, prefixes.select("h").distinct(), lengths, width))

    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("length") <= F.col("n_words")) & (F.col("offset") <= F.col("before"))
    same = F.array_join(F.slice(F.split("context", " "), F.col("before") - F.col("offset") + 1, F.col("length")), " ") == F.col("window")
    near = found.filter("h is not null").join(prefixes.withColumnRenamed("text", "window"), "h").filter(inside)
    hits = settle(near.filter(same).select("row", start.alias("first"), (start + F.col("length")).alias("past"), "window").distinct())
    owners = windows.filter("item_id is not null").select(F.col("text").alias("window"), F.col("item_id").cast("string").alias("item")).distinct()
    of_rows = hits.select("row", "window").distinct().join(owners, "window").select("row", "item").distinct()
    lists = of_rows.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    rows = found.filter("h is null").select("row", "doc_id", "n_words")
    out = rows.join(_merged(hits.select("row", "first", "past")), "row", "left").join(lists, "row", "left")
    empty: Column = F.array().cast("array<struct<first: bigint, past: bigint>>")
    return out.select("doc_id", "n_words", F.coalesce("spans", empty).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``find_contamination`` in figures: doc_id, n_words, n_hit, n_items, items_sha256 (of the ids joined by commas), contaminated."""
    found = find_contamination(docs, items, width)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


#: All runs of as many words as some window has, against the windows themselves.
ORACLE = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS text, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
runs AS (SELECT k, p, n, array_to_string(w[p:p + n - 1], ' ') AS text FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hits AS (SELECT k, p, runs.n, item_id FROM runs JOIN win ON runs.text = win.text AND runs.n = win.n),
words AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT k, p, n FROM hits)) GROUP BY k),
ids AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN ids USING (k)
"""
