"""Tables written between jobs, in the folder that all executors share, and files that tasks read as streams."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders that this process has made, by session.
_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder of this machine stands for it if Spark runs on this machine only; elsewhere that is an error,
    as executors would not see each other's files. Folders are deleted by ``clean_up``, at the end of the process at the latest.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(clean_up)
    _made.append((spark, path))
    return path


def clean_up() -> None:
    """Delete the folders made so far; tables that were read from them can't be read any more."""
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may be gone
            jvm = spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
    _made.clear()


def open_stream(path: str):
    """A file as a stream of its bytes, opened in a task."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")
    return system.open_input_stream(name, compression=None)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is not broadcast.

    Spark guesses the size of a table from its files, which are compressed, and doesn't count the rows that an explode adds. So it
    may take a table for small that the driver can't hold.
    """
    return df.hint("merge")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage is cut, and it survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
