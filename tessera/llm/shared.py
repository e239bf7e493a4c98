"""Tables written between jobs, the given tables, and the size of Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.shared import settle, shared_folder

__all__ = ["read_table", "settle", "shared_folder", "small_batches"]

#: Rows and bytes of an Arrow batch at most: texts can be long, and a batch is held whole.
BATCH, BATCH_BYTES = 1000, 1 << 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> None:
    """Let no Arrow batch of this session have more than BATCH rows, or more than a row beyond BATCH_BYTES, so that a worker's memory stays small.

    The session keeps these settings; smaller ones are left as they are.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).lower().removesuffix("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            conf.set(key, most)
