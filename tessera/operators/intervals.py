"""Sets of whole numbers as disjoint runs, by key, and the gaps between those.

Numbers are dealt by key and block of 2**BITS consecutive ones, so no window is over more than a block, whatever numbers a key has. Runs
of any parts of a set, in any order and with repeats, merge to the runs of the whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Bits of a number inside a block.
BITS = 16
_WORD = 64


def _above(number: Column, level: int) -> Column:
    """The block of a number at a level; 0 above all blocks."""
    return F.shiftright(number, BITS * level) if BITS * level < _WORD else F.lit(0).cast("long")


def runs_of(numbers: DataFrame, by: str = "archive", number: str = "number") -> DataFrame:
    """(by, lo, hi): the maximal runs of the different numbers of each key, cut at blocks. Null numbers are in none."""
    n = F.col(number).cast("long")
    each = numbers.select(F.col(by), n.alias("n")).filter("n is not null").distinct()
    order = W.partitionBy(by, "block").orderBy("n")
    placed = each.withColumn("block", _above(F.col("n"), 1)).withColumn("run", F.col("n") - F.row_number().over(order))
    return placed.groupBy(by, "block", "run").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).select(by, "lo", "hi")


def merged_runs(runs: DataFrame, by: str = "archive") -> DataFrame:
    """(by, lo, hi): the union of runs that each lie in one block, as disjoint runs that don't touch inside a block."""
    order = W.partitionBy(by, "block").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    starts = F.when(F.col("lo") <= reach + 1, 0).otherwise(1)
    different = runs.select(by, "lo", "hi").distinct().withColumn("block", _above(F.col("lo"), 1)).withColumn("starts", starts)
    numbered = different.withColumn("island", F.sum("starts").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(by, "block", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(by, "lo", "hi")


def gaps_of(runs: DataFrame, by: str = "archive") -> DataFrame:
    """(by, after, missing): the last number before each gap, and the first that is missing, of disjoint runs that each lie in one block.

    Gaps are looked for inside blocks, then between the blocks of a larger block, and so on up, so no window is over more than 2**BITS rows.
    """
    level, now, found = 1, runs.select(by, "lo", "hi"), []
    while True:
        order = W.partitionBy(by, "block").orderBy("lo")
        placed = now.withColumn("block", _above(F.col("lo"), level)).withColumn("next", F.lead("lo").over(order))
        found.append(placed.filter("next <> hi + 1").select(by, F.col("hi").alias("after"), (F.col("hi") + 1).alias("missing")))
        if BITS * level >= _WORD:
            return reduce(DataFrame.unionByName, found)
        now = placed.groupBy(by, "block").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("block")
        level += 1


def gaps(numbers: DataFrame, by: str = "archive", number: str = "number") -> DataFrame:
    """(by, after, missing) of the different numbers of each key."""
    return gaps_of(runs_of(numbers, by, number), by)
