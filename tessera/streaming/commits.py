"""Outputs that are done or not: data first, then a marker.

An output is there for its readers once its marker is. What a run or batch that was stopped has left without a marker is not read, and the
next run writes that output in a folder of its own. Markers are small tables beside the data, with the run and number of rows of each output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def markers(spark: SparkSession, base: str, key: str, kind: str = "string") -> DataFrame:
    """(key, rows, run) of the outputs that are done."""
    schema = f"{key} {kind}, rows long, run string"
    return spark.read.schema(schema).parquet(f"{base}/done") if _exists(spark, f"{base}/done") else spark.createDataFrame([], schema)


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The inputs of which no output is done."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def write_marked(outputs: DataFrame, keys: DataFrame, base: str, key: str, run: str | None = None) -> None:
    """Write the rows of each key to a folder of its run and key, and then, when all are there, the markers of all ``keys``, also those without rows."""
    spark = outputs.sparkSession
    run = run or uuid.uuid4().hex
    outputs.write.partitionBy(key).parquet(f"{base}/data/run={run}")
    kind = keys.schema[key].dataType.simpleString()
    found = spark.read.schema(f"{key} {kind}").parquet(f"{base}/data/run={run}").groupBy(F.col(key).alias("of")).agg(F.count("*").alias("rows"))
    counted = keys.select(key).distinct().join(found, F.col(key) == F.col("of"), "left").select(key, F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(run).alias("run"))
    counted.write.mode("append").parquet(f"{base}/done")


def process_pending(inputs: DataFrame, key: str, function: Callable[[DataFrame], DataFrame], base: str, run: str | None = None) -> None:
    """Apply ``function`` to the inputs whose output is not done, and write its rows by key with their markers."""
    spark = inputs.sparkSession
    todo = pending(inputs, markers(spark, base, key, inputs.schema[key].dataType.simpleString()), key)
    write_marked(function(todo), todo, base, key, run)


def finished(spark: SparkSession, base: str, schema: str, key: str, kind: str = "string") -> DataFrame:
    """The rows of the outputs that are done, with their key and run; ``schema`` is that of the rows."""
    done = markers(spark, base, key, kind).select(key, "run")
    return spark.read.schema(f"{schema}, {key} {kind}, run string").parquet(f"{base}/data").join(done, [key, "run"])


def marked_sink(base: str, function: Callable[[DataFrame], DataFrame] = lambda batch: batch, after_data: Callable[[int], None] = lambda number: None) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its number, then its marker; a batch that runs again replaces both.

    ``after_data`` is called between the two.
    """

    def each(batch: DataFrame, number: int) -> None:
        function(batch).write.mode("overwrite").parquet(f"{base}/data/batch={number}")
        after_data(number)
        spark = batch.sparkSession
        rows = spark.read.parquet(f"{base}/data/batch={number}").count()
        spark.createDataFrame([(number, rows)], "number long, rows long").coalesce(1).write.mode("overwrite").parquet(f"{base}/done/batch={number}")

    return each


def finished_batches(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """The rows of the batches that are done."""
    done = spark.read.parquet(f"{base}/done").select(F.col("number").alias("batch"))
    return spark.read.schema(f"{schema}, batch long").parquet(f"{base}/data").join(done, "batch", "left_semi").drop("batch")
