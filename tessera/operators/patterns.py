"""Selections over quads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.sources.shared import settle


def triple_pattern(quads: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None, g: str | None = None) -> DataFrame:
    """The quads that match; None matches all. The conditions reach a Parquet scan."""
    for name, value in (("g", g), ("s", s), ("p", p), ("o", o)):
        if value is not None:
            quads = quads.filter(F.col(name) == value)
    return quads


def subjects_with(quads: DataFrame, p: str, o: str | None = None) -> DataFrame:
    return triple_pattern(quads, p=p, o=o).select("s", "s_kind").distinct()


def objects_of(quads: DataFrame, p: str, s: str | None = None) -> DataFrame:
    return triple_pattern(quads, s=s, p=p).select("o", "o_kind", "o_dt", "o_lang").distinct()


def contains_statement(keys: DataFrame, key: str, quads: DataFrame, s: Column | None = None, p: str | None = None, o: Column | None = None) -> DataFrame:
    """``keys`` with ``contained``: whether some quad has the key as element_id and matches."""
    conditions = [c for c in (s is not None and F.col("s") == s, p is not None and F.col("p") == p, o is not None and F.col("o") == o) if c is not False]
    found = quads.filter(reduce(lambda a, b: a & b, conditions, F.lit(True))).select(F.col("element_id").alias("__key")).distinct()
    return keys.join(found, F.col(key) == F.col("__key"), "left").withColumn("contained", F.col("__key").isNotNull()).drop("__key")


def allowed_predicates(quads: DataFrame, allowed: list[str]) -> DataFrame:
    return quads.filter(F.col("p").isin(*allowed))


def sample_elements(rows: DataFrame, positions: tuple[int, ...]) -> DataFrame:
    return rows.filter(F.col("element_id").isin(*positions))


def prefix_limit(rows: DataFrame, size: int) -> DataFrame:
    return rows.filter(F.col("element_id") < size)


def nth_element(rows: DataFrame, n: int) -> DataFrame:
    return rows.filter(F.col("element_id") == n)


def element_index(rows: DataFrame, shard: Column, position: Column) -> DataFrame:
    """``rows`` with a dense element_id from 0 in the order of shard and position in it.

    Rows are dealt by ranges of that order and numbered inside them; the few ranges are then shifted by the sizes of those before.
    """
    dealt = in_ranges(rows.withColumns({"__shard": shard, "__at": position}), "__shard", "__at")
    inside = W.partitionBy("__range").orderBy("__shard", "__at")
    before = W.orderBy("__r").rowsBetween(W.unboundedPreceding, -1)  # over one row for each range
    starts = dealt.groupBy(F.col("__range").alias("__r")).agg(F.count("*").alias("__n")).select("__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = dealt.withColumn("__place", F.row_number().over(inside) - 1).join(starts, F.col("__range") == F.col("__r"))
    return numbered.withColumn("element_id", F.col("__start") + F.col("__place")).select(*rows.columns, "element_id")


def in_ranges(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with __range, the number of the range of ``order`` that each is in; written down, so that the ranges stay as they are."""
    return settle(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))


def with_following(rows: DataFrame, value: str, by: str, *order: str) -> DataFrame:
    """``rows`` with ``following``, the value of the next row of the same ``by``, null after the last.

    Rows are dealt by ranges, so that a group of any size is no single task's; the first row of a group in each range is the next of
    the last one in the range before. Rows of equal ``by`` and ``order`` are in one range.
    """
    dealt = in_ranges(rows, by, *order)
    heads = dealt.groupBy("__range", by).agg(F.min(F.struct(*order, value)).alias("__first"))
    # One row for each group and range.
    across = W.partitionBy(by).orderBy("__range")
    heads = heads.withColumn("__then", F.lead(f"__first.{value}").over(across)).select("__range", F.col(by).alias("__by"), "__then")
    inside = W.partitionBy("__range", by).orderBy(*order, value)
    joined = dealt.withColumn("following", F.lead(value).over(inside)).join(heads.withColumnRenamed("__range", "__r"), (F.col("__range") == F.col("__r")) & F.col(by).eqNullSafe(F.col("__by")))
    return joined.withColumn("following", F.coalesce("following", "__then")).select(*rows.columns, "following")


def first_value(rows: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """(key, value) of the first value of each key by ``order``, or by the value itself."""
    return rows.groupBy(key).agg(F.min_by(value, order or value).alias(value))


def last_matching(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))
