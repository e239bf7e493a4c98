"""Threshold-scaled sketches of documents: every shingle hash below a fixed fraction is kept.

Sketches of equal fraction merge by union, and the share of one sketch that is in another estimates
how much of one document is in another, also where their lengths are very unequal. A short text may
have no hash below the threshold; a fingerprint therefore also has the number of words and a digest of
their sequence, by which equal documents are known.

All of this is DataFrame and SQL functions.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.shared import settle

#: One shingle hash in this many is kept.
SCALE = 8
WIDTH = 5
_TOP = 2**63 - 1


def word_hashes(text: Column) -> Column:
    """A hash of each word of a text, in order; null counts as empty."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def shingles(h: Column, width: int = WIDTH) -> Column:
    """Non-negative 63-bit hashes of the runs of ``width`` words, or of all words if fewer, from the hashes of the words."""
    whole = F.array(F.xxhash64(h))
    long = F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
    runs = F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < width, whole).otherwise(long)
    return F.transform(runs, lambda x: x.bitwiseAND(F.lit(_TOP)))


def sketch(text: Column, scale: int = SCALE, width: int = WIDTH) -> Column:
    """The sorted sketch of a text as an array; null counts as empty."""
    return fingerprint(text, scale, width)["kept"]


def fingerprint(text: Column, scale: int = SCALE, width: int = WIDTH) -> Column:
    """A struct of n, the number of words, digest, a hash of their sequence, and kept, the sorted sketch; null counts as empty."""
    limit = F.lit(_TOP // scale)

    def of(h: Column) -> Column:
        below = F.filter(shingles(h, width), lambda x: x < limit)
        return F.struct(F.size(h).alias("n"), F.xxhash64(h).alias("digest"), F.sort_array(F.array_distinct(below)).alias("kept"))

    # An array of one element gives the hashes of the words a name, so that they are made once.
    return F.transform(F.array(word_hashes(text)), of)[0]


def merged(a: Column, b: Column) -> Column:
    """The sketch of two documents together."""
    return F.sort_array(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the documents of two sketches; null where neither keeps a hash."""
    common = F.size(F.array_intersect(a, b))
    return F.try_divide(common, F.size(a) + F.size(b) - common)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the document of sketch a that is in that of b; null where a keeps no hash."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(a))


def alike(a: Column, b: Column) -> Column:
    """``likeness`` of two fingerprints: 1 where they are equal, 0 where nothing was kept of two that are not."""
    same = (a["n"] == b["n"]) & (a["digest"] == b["digest"])
    return F.when(same, 1.0).otherwise(F.coalesce(likeness(a["kept"], b["kept"]), F.lit(0.0)))


def as_text(a: Column) -> Column:
    """A fingerprint as n:digest:sketch, the digest and the hashes of the sketch in lower-case hexadecimal, these joined by commas; empty for a text without words."""
    kept = F.array_join(F.transform(a["kept"], lambda h: F.lower(F.hex(h))), ",")
    return F.when(a["n"] == 0, "").otherwise(F.concat_ws(":", a["n"].cast("string"), F.lower(F.hex(a["digest"])), kept))


def _slice_of(ident: Column, bounds: Column, steps: int) -> Column:
    """Number of bounds that are at most ``ident``, by bisection."""
    found = F.aggregate(
        F.array(*[F.lit(2**k) for k in reversed(range(steps))]),
        F.lit(0),
        lambda at, step: at + F.when(F.get(bounds, at + step - 1) <= ident, step).otherwise(0),
    )
    return F.coalesce(found, F.lit(0))


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", slices: int | None = None) -> DataFrame:
    """``docs`` with a struct column ``next``: ``columns`` of the row that follows by ``id_col``, after the last row those of the first.

    Rows of equal id follow each other by a hash of the first of ``columns``, then by ``columns``; null ids go first. Rows are dealt by
    ranges of id and hash, so no task holds them all, nor all rows of an id; the first row of each range goes to the range before it too.
    The bounds of the ranges come from a sample of 20 rows for each range. With one row, it follows itself.
    """
    slices = slices or 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = slices.bit_length()
    ident = F.col(id_col).cast("long")
    key = F.struct(ident.isNotNull().alias("known"), F.coalesce(ident, F.lit(0)).alias("id"), F.xxhash64(F.lit(1), columns[0]).alias("h"))
    keys = docs.select(key.alias("id"))
    sample = keys.orderBy(F.xxhash64("id"), "id").limit(20 * slices).agg(F.array_sort(F.collect_list("id")).alias("s"))
    bounds = sample.select(F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(slices - 1)), lambda k: F.get("s", F.floor(F.size("s") * k / slices).cast("int"))))).alias("bounds"))
    bounds = settle(bounds.select(F.filter("bounds", lambda b: b.isNotNull()).alias("bounds")))
    bounds = F.broadcast(bounds)  # one row of at most ``slices`` keys, the same in both uses
    dealt = keys.crossJoin(bounds).select("id", _slice_of(F.col("id"), F.col("bounds"), steps).alias("slice"))
    order = W.orderBy("slice")
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    firsts = (
        dealt.groupBy("slice")
        .agg(F.min("id").alias("first"))
        .select(
            F.col("first").alias("first_id"),
            F.coalesce(F.lag("slice").over(order), F.last("slice").over(everything)).alias("ghost"),
            F.lag("slice").over(order).isNull().alias("wraps"),
        )
    )
    payload = F.struct(*[F.col(c) for c in columns])
    others = F.struct(*[F.col(c) for c in docs.columns if c not in columns])
    placed = (
        docs.select(others.alias("row"), key.alias("id"), payload.alias("payload"))
        .crossJoin(bounds)
        .withColumn("slice", _slice_of(F.col("id"), F.col("bounds"), steps))
        .drop("bounds")
        .join(F.broadcast(firsts), F.expr("id = first_id"), "left")  # at most ``slices`` rows
    )
    real = F.struct(F.col("slice"), F.lit(False).alias("is_ghost"), F.lit(False).alias("wraps"))
    ghost = F.struct(F.col("ghost").alias("slice"), F.lit(True).alias("is_ghost"), F.col("wraps"))
    both = placed.withColumn("at", F.explode(F.when(F.col("ghost").isNull(), F.array(real)).otherwise(F.array(real, ghost))))
    along = W.partitionBy("slice").orderBy(F.col("wraps"), F.col("id"), F.col("is_ghost"), F.col("payload"))
    return (
        both.select("id", "row", "payload", "at.*")
        .withColumn("next", F.lead("payload").over(along))
        .filter(~F.col("is_ghost"))
        .select("row.*", "payload.*", "next")
    )


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text and of an edited form of it, and their likeness.

    Edited: the last floor(n_chars / 2) code points give way to the first as many, or all, of the next
    document by ``id_col``. One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Null text is empty: its fingerprint is the empty
    string and it is like another empty one (1.0), unlike any other (0.0). A null id goes first; rows of equal
    id follow each other by a hash of the text. An only row follows itself. Other columns are not looked at.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("own", fingerprint(F.col("text"), scale))
    paired = with_next(own, ["text", "own"])
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), (n - half).cast("int")), F.left(F.col("next.text"), half))
    # The edited text and its sketch each under a name of their own, in steps that are not folded together.
    step = paired.select("doc_id", n.alias("n_chars"), "own", F.col("next.own").alias("next_own"), F.explode(F.array(edited)).alias("edited"))
    step = step.select("doc_id", "n_chars", "own", "next_own", F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(fingerprint(F.col("edited"), scale))).alias("edited_own"))
    return step.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited_own")).alias("edited_fingerprint"),
        alike(F.col("own"), F.col("edited_own")).alias("near_edited"),
        alike(F.col("own"), F.col("next_own")).alias("near_next"),
    )
