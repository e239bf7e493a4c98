"""Queries against their SQL on tables with keys as large as those of large copies."""

import os

import pytest
from pyspark.sql import functions as F

from tessera import plans
from tests.compare import TABLES, connect, same

KEYS = [0, 1, 14_999, 10_000, 100_000, 1_000_000, 10_000_000, 100_000_000, 1_000_000_000, 899_999, 1_199_999, 9_899_999]


@pytest.fixture(scope="module")
def large_keys(spark, sf_dir, tmp_path_factory):
    """The small tables, with orders and parts of KEYS."""
    folder = str(tmp_path_factory.mktemp("large_keys"))
    keys = spark.createDataFrame([(i, k) for i, k in enumerate(KEYS)], "i long, k long")
    for name in TABLES:
        source = f"{sf_dir}/{name}.parquet"
        if name not in ("orders", "part"):
            os.symlink(source, f"{folder}/{name}.parquet")
            continue
        rows = spark.read.parquet(source)
        key = rows.columns[0]
        some = rows.join(keys, F.col(key) == F.col("i")).withColumn(key, F.col("k").cast(rows.schema[key].dataType))
        some = some.filter(f"{key} < 50000000") if name == "part" else some.withColumn("o_custkey", F.lit(1).cast(rows.schema["o_custkey"].dataType))
        some.select(rows.columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["h22_distribution_title", "h4_human_size", "h5_human_bytes", "l6_dataset_download_table"])
def test_large_keys(name, spark, large_keys):
    same(plans.queries()[name](spark, large_keys), connect(large_keys), plans.oracle_sql()[name])
