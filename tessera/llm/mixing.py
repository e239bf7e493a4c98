"""Mixing sources to target weights by weighted fair queueing.

Each document of a source, in a shuffled order that depends on the seed alone, has a virtual
finish time: the words of its source up to and with it, divided by the source's target. All
documents of all sources in the order of that time, cut where the budget of words is spent, are the
mix. A source whose target is above its size goes round again, at most ``max_epochs`` times.

Sums over an order are taken in levels (totals of slices, then the rows of a slice), so no task
holds a source or the whole order. The slice of virtual time in which the budget is spent is cut into finer
ones, from its first to its last time, until it has few rows or only one time; those are sorted. Of one time there is at most a row for each source and round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.shared import settle

#: Least hexadecimal digits of the shuffle key that name a slice of a source's order; rows that there are for each slice before more digits are taken.
SLICE_DIGITS, SLICE_ROWS = 3, 50_000
#: Slices of virtual time 1, and of a slice that is cut again; slices of each doubling of the time beyond 2; rows of a slice that is not cut again.
TIME_SLICES, LATE_SLICES, FEW = 4096, 64, 20_000


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, cycle: int = 3, max_epochs: int = 3) -> DataFrame:
    """source, source_no (from 1, by code point, null last), weight, source_size and target of each source.

    Weights are 1 to ``cycle``, repeating. Targets share the total of all sizes by weight; none is
    above ``max_epochs`` times its source's size, and what is above goes to the others by weight.
    Its input is a row for each source and task after partial sums, so its one-task windows hold sources only.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = by_source.withColumn(
        "source_no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", ((F.col("source_no") - 1) % cycle + 1).cast("long"))
    capped = numbered.withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = W.orderBy((F.col("cap").cast("double") / F.col("weight")).asc(), F.col("source_no").asc())
    below = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        capped.withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("spent", F.coalesce(F.sum("cap").over(below), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(onward))
        .withColumn("level", (F.col("budget") - F.col("spent")).cast("double") / F.col("weights_left"))
        .withColumn("level", F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level")))
        # The first source that stays under its cap sets the level of all that do.
        .withColumn("level", F.first("level", ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return levels.select("source", "source_no", "weight", "source_size", target.alias("target"), "budget")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: int = 3,
    max_epochs: int = 3,
    seed: str = "mix",
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, epochs.

    ``size`` counts words; ``epochs`` is how often the mix takes the document, ``taken`` the words it
    so takes. Null or empty texts and sources without words have size and taken 0, and target 0.
    A null source is a source, the last one. Repeated rows count each on its own. An empty table
    gives an empty result. The shuffled order is that of a hash of seed, id and text. Other columns of ``docs`` are not looked at;
    ``row_col``, if given, numbers the rows and is in the result too.
    """
    number = [F.col(row_col).alias("row_no")] if row_col else []
    sized = settle(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.coalesce(text_col, F.lit(""))))).alias("key"),
            *number,
        )
    )
    n = sized.count()
    digits = next(d for d in range(SLICE_DIGITS, 33) if n <= SLICE_ROWS * 16**d)
    targets = source_targets(sized, cycle, max_epochs)
    rows = sized.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source")).select("d.*", "t.source_no", "t.source_size", "t.target", "t.budget").withColumn("slice", F.substring("key", 1, digits))
    before = W.partitionBy("source_no").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = (
        rows.groupBy("source_no", "slice")
        .agg(F.sum("size").alias("slice_size"))
        .select(F.col("source_no").alias("no"), F.col("slice").alias("sl"), F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("offset"))
    )
    inside = W.partitionBy("source_no", "slice").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = settle(
        rows.withColumn("within", F.sum("size").over(inside))
        .join(slices, (F.col("source_no") == F.col("no")) & (F.col("slice") == F.col("sl")))
        .withColumn("upto", F.col("offset") + F.col("within"))
        .drop("slice", "no", "sl", "offset", "within")
    )

    def finish(epoch: Column) -> Column:
        return F.try_divide((epoch * F.col("source_size") + F.col("upto")).cast("double"), F.col("target"))

    def place(time: Column, epoch: Column) -> Column:
        return F.struct(time.alias("time"), F.col("source_no"), epoch.alias("epoch"), F.col("key"), F.col("doc_id"))

    queue = placed.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))).withColumn("time", finish(F.col("epoch")))
    so_far = W.orderBy("slice").rowsBetween(W.unboundedPreceding, 0)  # over one row for each slice
    # Sources with large documents and small targets have late times: these are in slices that grow, so their number does not follow the number of sources.
    time = F.col("time")
    slice_of = F.when(time < 2, F.floor(time * TIME_SLICES)).otherwise(2 * TIME_SLICES + F.floor(F.log2(time / 2) * LATE_SLICES))
    left, some, low, high = None, queue, 0.0, 0.0
    while True:
        budget = F.max("budget") if left is None else F.lit(left)
        cut = (
            some.groupBy(slice_of.alias("slice"))
            .agg(F.sum("size").alias("slice_size"), F.count("*").alias("n"), F.min("time").alias("low"), F.max("time").alias("high"), budget.alias("budget"))
            .withColumn("spent", F.sum("slice_size").over(so_far))
            .filter("spent > budget")
            .agg(F.min_by(F.struct("n", "low", "high", (F.col("budget") - F.col("spent") + F.col("slice_size")).alias("left")), "slice").alias("cut"))
            .first()["cut"]
        )
        if cut is None:
            break
        # What is before this slice is taken whole, what is after it not at all. Slices follow the time, so no other slice has a time between these two.
        left, low, high = cut["left"], cut["low"], cut["high"]
        some = queue.filter(time.between(low, high))
        if cut["n"] <= FEW or low == high:
            break
        slice_of = F.least(F.floor((time - low) / (high - low) * TIME_SLICES), F.lit(TIME_SLICES - 1))
    last = None
    if left is not None:
        order = W.orderBy("time", "source_no", "epoch", "key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
        last = some.withColumn("spent", F.sum("size").over(order)).filter(F.col("spent") <= left).agg(F.max(place(F.col("time"), F.col("epoch"))).alias("last"))
        placed = placed.crossJoin(F.broadcast(settle(last)))  # of one row

    def taken_in(epoch: Column) -> Column:
        taken = F.lit(1)
        if left is not None:
            time = finish(epoch)
            taken = F.when(time < low, 1).when((time <= high) & F.coalesce(place(time, epoch) <= F.col("last"), F.lit(False)), 1).otherwise(0)
        return F.when(F.col("size") == 0, 0).otherwise(taken)

    epochs = sum((taken_in(F.lit(k)) for k in range(1, max_epochs)), taken_in(F.lit(0)))
    return placed.withColumn("epochs", epochs).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), "epochs", *[F.col("row_no").alias(row_col or "")] * bool(row_col))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, with the columns of ``docs``."""
    rows = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    chosen = mix_sources(rows, row_col="__row", **options).filter("epochs > 0").select("__row", F.col("epochs").alias("__epochs"))
    return rows.join(chosen, "__row").withColumn("__epoch", F.explode(F.sequence(F.lit(1), "__epochs"))).select(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM by_source),
capped AS (SELECT *, (no - 1) % 3 + 1 AS w, source_size * 3 AS cap FROM numbered),
ranked AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS budget,
         CAST(coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent,
         CAST(sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS wl
  FROM capped),
leveled AS (SELECT *, CAST(budget - spent AS DOUBLE) / wl AS lv FROM ranked),
level AS (SELECT arg_min(lv, CAST(cap AS DOUBLE) / w) AS level FROM leveled WHERE cap > lv * w),
targets AS (
  SELECT source, no, source_size, budget,
         least(CAST(cap AS DOUBLE), coalesce(level * w, CAST(cap AS DOUBLE))) AS target
  FROM leveled, level),
placed AS (
  SELECT d.*, t.no, t.source_size, t.target, t.budget,
         CAST(sum(size) OVER (PARTITION BY t.no ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
queue AS (
  SELECT *, CAST(e * source_size + upto AS DOUBLE) / target AS vt
  FROM placed, (VALUES (0), (1), (2)) AS epochs(e) WHERE size > 0),
spent AS (SELECT *, sum(size) OVER (ORDER BY vt, no, e, key, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM queue),
taken AS (SELECT doc_id, key, no, upto, CAST(sum(size) AS BIGINT) AS taken FROM spent WHERE total <= budget GROUP BY ALL)
SELECT p.doc_id, p.source, p.size, p.source_size, p.target, coalesce(t.taken, 0) AS taken,
       CAST(CASE WHEN p.size = 0 THEN 0 ELSE coalesce(t.taken, 0) // p.size END AS INTEGER) AS epochs
FROM placed p LEFT JOIN taken t ON p.doc_id = t.doc_id AND p.no = t.no AND p.upto = t.upto
"""
