"""WARC archives, written with an index and read back by byte ranges of the selected records.

Writing a partition gives one archive of gzip members, one for each record, and a row of the index for
each: archive, offset, length, URL and digest. Reading selects rows of the index first, joins ranges
that touch or nearly touch, and reads each joined range once, in order. A task that is run again writes
an archive of another name; the index names only archives of tasks that succeeded.

A record's id comes from its archive and offset, so it is known from the index: responses are written first, and
revisits then refer to the ids that they have there. Which pages are revisits is found without their payloads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import settle, shared_folder, small_batches

#: Smallest payload that a revisit record may stand for.
MIN_REVISIT = 1000
#: Ranges with a gap of at most so many bytes are read as one, up to a total of READ_MOST.
GAP, READ_MOST = 1 << 16, 1 << 23
#: Bytes of archives that one task reads, more where that would make more than TASKS tasks.
READ_TASK, TASKS = 1 << 23, 10_000
#: Revisits up to this number are broadcast (under 20 MB); more are joined by a shuffle.
FEW = 200_000
INDEX = "page_id long, url string, digest string, archive string, offset long, length long"
#: A fixed date: archives of the same rows are the same bytes.
DATE = "1970-01-01T00:00:00Z"


def opened(uri: str):
    """The file system of a folder all executors share, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def record(ident: str, page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, target: tuple[int, str, str | None] | None) -> bytes:
    """One record. A revisit has the HTTP head of its payload, but not the payload; ``target`` is what it refers to: page, record id and URL."""
    line = lambda x: "".join((x or "").splitlines())
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if target else 'response'}",
        f"WARC-Record-ID: {ident}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {line(url)}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        f"X-Page-Id: {'null' if page_id is None else page_id}",
    ]
    if target:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {target[1]}", f"WARC-Refers-To-Target-URI: {line(target[2])}", f"X-Refers-To-Page: {target[0]}"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])


def parsed(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers of a record, and length and bytes of its payload; a revisit has no bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, int(_fields(http)["Content-Length"]), payload


def _writer(folder: str):
    """Rows (page_id, url, payload, digest, size, and page, archive, offset and URL of the response that a revisit refers to) to rows of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, offset, name = None, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            rows = []
            for page_id, url, html, digest, size, page, archive, place, target in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    system, path = opened(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                refers = None if page is None else (page, record_id(archive, place), target)
                packer = zlib.compressobj(1, wbits=31)
                member = packer.compress(record(record_id(name, offset), page_id, url, html.encode(), digest, size, refers)) + packer.flush()
                out.write(member)
                rows.append((page_id, url, digest, name, offset, len(member)))
                offset += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["page_id", "url", "digest", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write a record for each row and return the index, a table under ``folder``.

    Of rows with equal payloads of at least ``min_revisit`` bytes, that with the largest id is the response and the
    others revisit it; rows of the same id as it are responses too. Smaller ones are all responses. Null html is
    an empty payload, and a null url an empty one in the record; a null id never is what others refer to. Other columns are not looked at.
    """
    small_batches(pages)
    folder = folder or shared_folder(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    large = settle(rows.filter(F.col("size") >= min_revisit).select("page_id", "url", "digest", "size"))
    last = large.groupBy("digest", "size").agg(F.max("page_id").alias("page"), F.count("*").alias("n")).filter("n > 1 and page is not null").drop("n")
    again = settle(large.join(last, ["digest", "size"]).filter(~F.col("page").eqNullSafe(F.col("page_id"))))
    keys = again.select("page_id", "digest").distinct().toDF("again_id", "again_digest")
    keys = F.broadcast(keys) if again.count() <= FEW else keys
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("page", "long"), ("archive", "string"), ("offset", "long"), ("target", "string"))]
    first = rows.join(keys, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left_anti")
    write = _writer(f"{folder}/archives")
    first.select("page_id", "url", "html", "digest", "size", *nothing).mapInArrow(write, INDEX).write.parquet(f"{folder}/index")

    index = pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")
    response = index.join(again.select(F.col("page").alias("page_id"), "digest").distinct(), ["page_id", "digest"], "left_semi")
    response = response.groupBy(F.col("page_id").alias("page"), "digest").agg(F.min(F.struct("archive", "offset", F.col("url").alias("target"))).alias("at"))
    second = again.join(response, ["page", "digest"]).select("page_id", "url", F.lit("").alias("html"), "digest", "size", "page", "at.*")
    second.mapInArrow(write, INDEX).write.mode("append").parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _reader(payloads: bool):
    """Index rows, sorted by archive and offset, to records."""
    names = ["record_id", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "refers_to_record", "payload"]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    width = len(names) - (not payloads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            at = 0
            while at < len(rows):
                first, end = at, rows[at][1] + rows[at][2]
                at += 1
                while at < len(rows) and rows[at][0] == rows[first][0] and 0 <= rows[at][1] - end <= GAP and rows[at][1] + rows[at][2] - rows[first][1] <= READ_MOST:
                    end = rows[at][1] + rows[at][2]
                    at += 1
                if rows[first][0] != name:
                    if source is not None:
                        source.close()
                    name = rows[first][0]
                    system, path = opened(name)
                    source = system.open_input_file(path)
                data = source.read_at(end - rows[first][1], rows[first][1])
                out = []
                for _, offset, length in rows[first:at]:
                    start = offset - rows[first][1]
                    fields, size, payload = parsed(zlib.decompress(data[start : start + length], wbits=31))
                    revisit = fields["WARC-Type"] == "revisit"
                    claimed = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    digest = claimed if revisit else hashlib.sha1(payload).hexdigest()
                    if digest != claimed or (not revisit and len(payload) != size):
                        raise ValueError(f"{name} at {offset}: the payload is not what its record says")
                    page = fields["X-Page-Id"]
                    out.append(
                        (
                            fields["WARC-Record-ID"],
                            None if page == "null" else int(page),
                            fields["WARC-Target-URI"],
                            size,
                            digest,
                            fields["WARC-Type"],
                            int(fields["X-Refers-To-Page"]) if revisit else None,
                            fields["WARC-Refers-To"] if revisit else None,
                            None if revisit else payload,
                        )[:width]
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)], names[:width])
        if source is not None:
            source.close()

    return run


RECORDS = "record_id string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_to_record string"


def read_records(selected: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that rows of an index name: RECORDS and, if asked for, payload, which is null for revisits.

    Each payload is held against its digest. Records are dealt to tasks by their bytes, in the order of the archives.
    """
    small_batches(selected)
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = min(TASKS, -(-total // READ_TASK)) or 1
    placed = selected.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return placed.mapInArrow(_reader(payloads), RECORDS + ", payload binary" * payloads)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive all pages and read all records back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return read_records(write_archives(pages), payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
last AS (SELECT h, max(page_id) AS response FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN response IS NULL OR response = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> p.page_id THEN response END AS refers_to
FROM p LEFT JOIN last ON p.h = last.h
"""
