"""Structured Streaming over directories of quads written as Parquet.

A file holds whole elements, so a micro-batch does. Nothing here needs event time: the only order of a stream is its element
numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.operators import intervals, stats
from tessera.sources.shared import shared_folder
from tessera.sources.views import QUADS


def parallelism(spark: SparkSession) -> int:
    """Files that are written at a time, and read in a batch: as many as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_stream_files(quads: DataFrame, path: str, files: int | None = None) -> None:
    """Quads as files of ranges of elements, so that no element is in two files."""
    quads.repartitionByRange(files or 4 * parallelism(quads.sparkSession), "element_id").write.parquet(path)


def element_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The quads of a directory as a stream."""
    files_per_batch = files_per_batch or parallelism(spark)
    return spark.readStream.schema(QUADS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Process all that is there, batch by batch; exceptions of a batch are raised.

    A run with the checkpoint of one that was stopped goes on after the last batch that ended; without one it has its own.
    """
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint or shared_folder(stream.sparkSession)).trigger(availableNow=True).start()
    query.awaitTermination()


def fan_out(stream: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Each batch, read once and kept for its time, goes through every function and to a folder for each.

    A batch that runs again writes to the same folder of its number, so it does not count twice.
    """
    spark = stream.sparkSession
    base = shared_folder(spark)

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        for name, function in sinks.items():
            function(batch).write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")
        batch.unpersist()

    run_to_end(stream, each)
    return {name: spark.read.parquet(f"{base}/{name}").drop("batch") for name in sinks}


def statistics_sink(base: str, bounds: list[int], names: tuple[str, ...] = stats.NAMES, quoted: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A sink that writes what the statistics need of a batch of whole elements: mergeable states by bucket, and datatypes by the bucket where they
    come first. A batch that runs again replaces its own part."""

    def each(batch: DataFrame, number: int) -> None:
        sizes = batch.sparkSession.createDataFrame([(b,) for b in bounds], "size long")
        rows = stats.element_table(list(names), None, batch, None if quoted is None else quoted(batch), unique=True).persist()
        stats.states(rows, list(names), sizes).write.mode("overwrite").parquet(f"{base}/states/batch={number}")
        if stats.LISTED in names:
            stats.first_seen(rows, sizes).write.mode("overwrite").parquet(f"{base}/seen/batch={number}")
        rows.unpersist()

    return each


def statistics_so_far(spark: SparkSession, base: str, sizes: DataFrame, names: tuple[str, ...] = stats.NAMES) -> DataFrame:
    """The statistics of all batches that the sink has written; may be read while the stream runs."""
    found = stats.summaries_of(stats.merged(spark.read.parquet(f"{base}/states").drop("batch")), list(names), sizes, dense=True)
    if stats.LISTED not in names:
        return found
    seen = spark.read.parquet(f"{base}/seen").groupBy("x").agg(F.min("bucket").alias("bucket"))
    return stats.with_listed(found, seen, sizes)


def running_stats(stream: DataFrame, sizes: DataFrame, names: tuple[str, ...] = stats.NAMES, quoted: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All statistics of a stream of quads at the prefixes ``sizes`` (size, is_full), as ``stats.all_statistics`` has them.

    ``quoted`` gives the quoted triples of a batch. Element numbers are dense, so one below a size that does not come has no statements.
    """
    base = shared_folder(stream.sparkSession)
    bounds = sorted(r["size"] for r in sizes.select("size").collect())  # at most seven
    run_to_end(stream, statistics_sink(base, bounds, names, quoted))
    return statistics_so_far(stream.sparkSession, base, sizes, names)


class RunKeeper(StatefulProcessor):
    """Keeps the numbers of a key and block as disjoint runs, in a map from start to end, and gives those that a batch changed.

    Numbers may come in any order and again. A block holds at most 2**16 numbers, so a key's state is bounded.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", "lo long", "hi long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = {lo[0]: hi[0] for lo, hi in self.runs.iterator()}
        new = np.unique(np.concatenate([r["number"].to_numpy(np.int64) for r in rows]))
        cut = np.flatnonzero(np.diff(new) != 1)
        found = sorted([*held.items(), *zip(new[[0, *(cut + 1)]].tolist(), new[[*cut, -1]].tolist(), strict=True)])
        merged = found[:1]
        for lo, hi in found[1:]:
            if lo <= merged[-1][1] + 1:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        now = dict(merged)
        for lo in held.keys() - now.keys():
            self.runs.removeKey((lo,))
        for lo, hi in now.items():
            if held.get(lo) != hi:
                self.runs.updateValue((lo,), (hi,))
        yield pd.DataFrame({"archive": [key[0]], "block": [key[1]], "lo": [[lo for lo, _ in merged]], "hi": [[hi for _, hi in merged]]})

    def close(self) -> None:
        pass


def stream_runs(numbers: DataFrame) -> DataFrame:
    """(archive, block, lo, hi) with all runs, as arrays of their ends, of each archive and block that a batch of (archive, number) adds to; needs the RocksDB state store."""
    placed = numbers.filter("number is not null").select("archive", "number", F.shiftright("number", intervals.BITS).alias("block"))
    return placed.groupBy("archive", "block").transformWithStateInPandas(RunKeeper(), outputStructType="archive string, block long, lo array<long>, hi array<long>", outputMode="Update", timeMode="None")


def stream_gaps(numbers: DataFrame) -> DataFrame:
    """Gaps (archive, after, missing) of a stream (archive, number) by keyed state, at its end, whatever the order of its files.

    Each batch writes the runs of the keys that it touched; the last of each key count.
    """
    base = shared_folder(numbers.sparkSession)
    run_to_end(stream_runs(numbers), lambda batch, number: batch.write.mode("overwrite").parquet(f"{base}/batch={number}"), "update")
    last = numbers.sparkSession.read.parquet(base).groupBy("archive", "block").agg(F.max_by(F.arrays_zip("lo", "hi"), "batch").alias("runs"))
    return intervals.gaps_of(last.select("archive", F.inline("runs")))


def stream_gaps_in_batches(numbers: DataFrame) -> DataFrame:
    """J5 without keyed state: each batch is written as the runs of its numbers, and the runs of all batches are merged at the end.

    ``numbers`` (archive, number) is the stream; files may come in any order, and a batch that runs again writes its own runs again.
    """
    runs = fan_out(numbers, {"runs": intervals.runs_of})["runs"]
    return intervals.gaps_of(intervals.merged_runs(runs))
