"""Package files of all prefixes of a stream from one write.

Each statement is sorted, serialised and compressed once, as part of a gzip member of its bucket. Members one after the other are a
gzip file too, so the file of a prefix is a copy of the members of its buckets; its digests are taken on the way.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.terms import nt_statement
from tessera.operators.stats import with_bucket
from tessera.sources.shared import open_stream, settle

PARTS = "bucket long, part int, path string, elements long, statements long, plain_bytes long, byte_size long"
PACKAGES = "size long, path string, members long, byte_size long, md5 string, sha1 string, plain_bytes long, plain_md5 string, plain_sha256 string"


def _target(folder: str):
    """The file system and path of a folder, which is made if it is not there."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    system.create_dir(base, recursive=True)
    return system, base


def write_members(quads: DataFrame, sizes: DataFrame, folder: str, with_graph: bool = True) -> DataFrame:
    """PARTS: the statements of all elements below the largest of ``sizes`` (size) as gzip members, a file for each bucket and range of elements, in order of
    (bucket, part).

    The order is that of elements and then of statements. A member has no time or name in it, so a task that runs again writes the
    same bytes; it writes under a name of its own and then gives the file its place.
    """
    order = ["element_id", F.coalesce("g", F.lit("")), "s", "p", "o", F.coalesce("o_dt", F.lit("")), F.coalesce("o_lang", F.lit(""))]
    placed = with_bucket(quads, sizes).repartitionByRange("element_id").sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system = out = member = row = attempt = last = None
        done = []

        def close() -> None:
            member.close()
            row["byte_size"] = out.tell()
            out.close()
            system.move(attempt, row["path"])
            done.append(row)

        for batch in batches:
            for bucket, element, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row is None or row["bucket"] != bucket:
                    if row is not None:
                        close()
                    system, base = _target(folder)
                    attempt = f"{base}/.attempt-{uuid.uuid4().hex}"
                    out = system.open_output_stream(attempt, compression=None)
                    member = gzip.GzipFile(filename="", mode="wb", fileobj=out, mtime=0)
                    row = {"bucket": bucket, "part": part, "path": f"{base}/member-{bucket:012d}-{part:06d}.gz", "elements": 0, "statements": 0, "plain_bytes": 0}
                    last = None
                text = line.encode() + b"\n"
                member.write(text)
                row["elements"] += element != last
                row["statements"] += 1
                row["plain_bytes"] += len(text)
                last = element
        if row is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([(n.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[n.split()[1]]) for n in PARTS.split(", ")]))

    return settle(placed.select("bucket", "element_id", nt_statement(with_graph).alias("line")).mapInArrow(write, PARTS))


def package_sizes(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(size, elements, statements, plain_bytes, byte_size) of each prefix, as sums over its members; elements without statements are in none."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("elements", "statements", "plain_bytes", "byte_size")]
    by_bucket = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("elements", "statements", "plain_bytes", "byte_size")])
    return sizes.select("size").join(by_bucket, F.col("bucket") <= F.col("size"), "left").groupBy("size").agg(*sums)  # at most seven rows on either side


def write_packages(parts: DataFrame, sizes: DataFrame, folder: str, name: str = "flat", extension: str = "nt.gz") -> DataFrame:
    """PACKAGES: a file for each prefix, with the digests of the file and of the text in it.

    A file is one stream of bytes, so a prefix is one task's, which copies the members and holds none of them whole.
    """
    listed = sizes.select("size").join(parts.select("bucket", "part", "path"), F.col("bucket") <= F.col("size"), "left").groupBy("size")
    members = listed.agg(F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), F.struct("bucket", "part", "path")))).alias("m")).select("size", "m.path")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, paths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, base = _target(folder)
                attempt, target = f"{base}/.attempt-{uuid.uuid4().hex}", f"{base}/{name}_{size}.{extension}"
                digests = {n: hashlib.new(k, usedforsecurity=False) for n, k in (("md5", "md5"), ("sha1", "sha1"), ("plain_md5", "md5"), ("plain_sha256", "sha256"))}
                total = plain = 0
                with system.open_output_stream(attempt, compression=None) as out:
                    for path in paths or ():
                        unpack = zlib.decompressobj(31)
                        with open_stream(path) as source:
                            while chunk := source.read(1 << 20):
                                out.write(chunk)
                                total += len(chunk)
                                for n in ("md5", "sha1"):
                                    digests[n].update(chunk)
                                while chunk:
                                    text = unpack.decompress(chunk, 1 << 22)
                                    chunk = unpack.unconsumed_tail
                                    plain += len(text)
                                    for n in ("plain_md5", "plain_sha256"):
                                        digests[n].update(text)
                        text = unpack.flush()
                        plain += len(text)
                        for n in ("plain_md5", "plain_sha256"):
                            digests[n].update(text)
                system.move(attempt, target)
                row = {"size": size, "path": target, "members": len(paths or ()), "byte_size": total, "plain_bytes": plain} | {n: h.hexdigest() for n, h in digests.items()}
                yield pa.RecordBatch.from_pylist([{n.split()[0]: row[n.split()[0]] for n in PACKAGES.split(", ")}])

    return settle(members.repartition(8, "size").mapInArrow(copy, PACKAGES))
