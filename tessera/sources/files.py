"""Archives, flat statement files, release records and collections."""

from __future__ import annotations

import hashlib
import io
import re
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.names import directory_levels, element_id_of, element_path
from tessera.functions.terms import nt_statement
from tessera.operators.patterns import element_index
from tessera.sources.shared import open_stream

RELEASE = "struct<tag_name: string, assets: array<struct<name: string, browser_download_url: string>>>"
ENTRIES = "archive string, pos long, path string, size long, mtime long, content binary"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ENTRIES of the archives whose paths are given, read as streams."""
    schema = pa.schema([("archive", pa.string()), ("pos", pa.int64()), ("path", pa.string()), ("size", pa.int64()), ("mtime", pa.int64()), ("content", pa.binary())])
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            rows, held = [], 0
            with open_stream(archive) as source, tarfile.open(fileobj=source, mode="r|gz") as tar:
                for pos, m in enumerate(x for x in tar if x.isreg()):
                    data = tar.extractfile(m).read()
                    rows.append((archive, pos, m.name, m.size, int(m.mtime), data))
                    held += len(data)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


def read_element_archive(spark: SparkSession, path: str) -> DataFrame:
    """A1: ENTRIES of the regular members of tar.gz archives of any size, read as streams in the tasks, members one by one.

    A gzip stream cannot be split, so an archive is one task's, and large streams should come as many archives.
    """
    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(_members, ENTRIES)


def stream_element_archives(spark: SparkSession, path: str, archives_per_batch: int | None = None) -> DataFrame:
    """The ENTRIES of a folder of tar.gz archives as a stream; archives that come later are read too.

    Spark's file source keeps in the checkpoint which archives a batch has, so a stream that is stopped goes on after the last
    batch that ended. The contents of archives are read in the tasks only, from their paths.
    """
    one_each = archives_per_batch or int(spark.conf.get("spark.sql.shuffle.partitions"))
    binary = "path string, modificationTime timestamp, length long, content binary"
    found = spark.readStream.format("binaryFile").schema(binary).option("maxFilesPerTrigger", one_each).option("pathGlobFilter", "*.tar.gz").load(path)
    return found.select("path").mapInArrow(_members, ENTRIES)


def write_element_stream(documents: DataFrame, folder: str, archives: int | None = None, extension: str = "ttl", members: int | None = None) -> DataFrame:
    """A5: documents (element_id, data) as tar.gz archives of ranges of elements, members in order and with time 0.

    Gives (archive, pos, path). There are as many archives as shuffle partitions if no number is given. A task writes under a name of its own
    and then gives the file the name of its first element, so a task that runs again, or twice at a time, leaves the same whole file.
    """
    archives = archives or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = directory_levels(members or 0)
    named = documents.select("element_id", element_path(F.col("element_id"), levels, extension).alias("path"), "data").repartitionByRange(archives, "element_id").sortWithinPartitions("element_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        tar = out = name = None
        pos = 0
        for batch in batches:
            rows = []
            for element, path, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tar is None:
                    system, base = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
                    system.create_dir(base, recursive=True)
                    name = f"{base}/elements-{element:010d}.tar.gz"
                    attempt = f"{base}/.attempt-{uuid.uuid4().hex}"
                    out = system.open_output_stream(attempt, compression=None)
                    tar = tarfile.open(fileobj=out, mode="w|gz")
                info = tarfile.TarInfo(path)
                body = data.encode()
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
                rows.append({"archive": name, "pos": pos, "path": path})
                pos += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows)
        if tar is not None:
            tar.close()
            out.close()
            system.move(attempt, name)

    return named.mapInArrow(write, "archive string, pos long, path string")


def element_documents(quads: DataFrame, with_graph: bool = True) -> DataFrame:
    """(element_id, data): the statements of each element in canonical order, a line each."""
    lines = quads.select("element_id", nt_statement(with_graph).alias("line"), F.struct(F.coalesce("g", F.lit("")), "s", "p", "o", F.coalesce("o_dt", F.lit("")), F.coalesce("o_lang", F.lit(""))).alias("at"))
    # An element is one small graph, so its lines meet in one row.
    ordered = F.sort_array(F.collect_list(F.struct("at", "line")))
    return lines.groupBy("element_id").agg(F.concat(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n"), F.lit("\n")).alias("data"))


def write_flat(quads: DataFrame, path: str, with_graph: bool = True) -> None:
    """A4: gzipped N-Quads (N-Triples) lines, in the order of elements and then of statements."""
    order = ["element_id", F.coalesce("g", F.lit("")), "s", "p", "o", F.coalesce("o_dt", F.lit("")), F.coalesce("o_lang", F.lit(""))]
    ranged = quads.repartitionByRange(*order).sortWithinPartitions(*order)  # by all of the order, as one element may be the whole graph
    ranged.select(nt_statement(with_graph).alias("value")).write.option("compression", "gzip").text(path)


#: The white space that \s stands for, spelled out, as a set of plain characters is matched faster.
_WHITE = r" \t\n\x0B\f\r"
#: Terms of a line. All repeats are possessive, so texts of any length are matched without recursion.
_IRI = rf'<[^<>"{_WHITE}]*+>'
_BNODE = rf'_:[^{_WHITE}"<>.]++(?:\.++[^{_WHITE}"<>.]++)*+'
_LITERAL = rf'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:@[A-Za-z]++(?:-[A-Za-z0-9]++)*+|\^\^{_IRI})?+'
#: The terms of a line and the marks of quoted triples, one after the other, each where the one before ends, then the full stop with what may follow it.
_TOKENS = rf"\G[{_WHITE}]*+(<<|>>|{_IRI}|{_LITERAL}|{_BNODE}|\.\s*+(?:#.*+)?+$)"
#: Runs of one escape, or of none; escapes of 16 bits come together, as two may be one character.
_PIECES = r"(?s)\G(?:(?:\\u[0-9A-Fa-f]{4})++|\\U[0-9A-Fa-f]{8}|\\.|[^\\]++)"
_SURROGATES = r"(?i)^(?:\\u(?:[0-9a-c][0-9a-f]{3}|d[0-7][0-9a-f]{2}|[ef][0-9a-f]{3}|d[89ab][0-9a-f]{2}\\ud[c-f][0-9a-f]{2}))++$"
_POINT = r"(?i)^\\U00(?:0[0-9a-f]|10)(?!(?<=00)d[89a-f])[0-9a-f]{4}$"
_PLAIN_ESCAPE = r"""^\\[tbnrf"'\\]$"""


def _sound_escapes(text: Column) -> Column:
    """Whether all escapes of a text stand for a character."""
    fine = lambda p: ~p.startswith("\\") | p.rlike(_PLAIN_ESCAPE) | p.rlike(_SURROGATES) | p.rlike(_POINT)
    return ~F.contains(text, F.lit("\\")) | F.forall(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), fine)


def _unescaped(text: Column) -> Column:
    """A text whose escapes are sound, with the characters that they stand for."""

    def piece(p: Column) -> Column:
        raw = F.substr(p, F.lit(2))
        plain = F.translate(raw, "tbnrf", "\t\b\n\r\f")
        points = F.when(p.startswith("\\u"), F.decode(F.unhex(F.replace(p, F.lit("\\u"), F.lit(""))), "UTF-16BE")).when(p.startswith("\\U"), F.decode(F.unhex(F.substr(p, F.lit(3))), "UTF-32"))
        return F.when(~p.startswith("\\"), p).otherwise(F.coalesce(points, plain))

    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    return F.when(~F.contains(text, F.lit("\\")), text).otherwise(F.array_join(F.transform(pieces, piece), ""))


def _joined(tokens: Column, first: Column, last: Column) -> Column:
    """Tokens from ``first`` to ``last``, counted from 1, as the text of one term."""
    return F.array_join(F.slice(tokens, first, last - first + 1), " ")


def _closed(tokens: Column, parts: bool = False) -> Column:
    """Tokens with each quoted triple closed to one term: a struct of ``terms``, ``ok``, and with ``parts`` ``done``, a struct of each quoted triple.

    A fold with what is open: the places (s or o) at which open triples stand, outermost first, and where in the tokens each of them and its
    predicate is; so depth has no limit. Of a closed triple ``done`` has its path, depth and where it starts, has its predicate and ends; see
    ``_part_terms``. The fold keeps numbers, not texts, so a step costs the same whatever was closed before.
    """
    ints = F.array().cast("array<int>")
    done = F.array().cast("array<struct<path: string, depth: int, first: int, predicate: int, last: int>>")

    def state(path: Column, place: Column, ok: Column, opened: Column, ends: Column, found: Column, n: Column) -> Column:
        return F.struct(path.alias("path"), place.alias("place"), ok.alias("ok"), opened.alias("opened"), ends.alias("ends"), *([found.alias("done")] if parts else []), n.alias("n"))

    def step(x: Column, token: Column) -> Column:
        path, place, opened, ends, n = x["path"], x["place"], x["opened"], x["ends"], x["n"] + 1
        before = x["done"] if parts else None
        nested, outermost = path != "", F.length(path) == 1
        held = F.size(opened)
        part = F.struct(path.alias("path"), F.length(path).alias("depth"), F.get(opened, held - 2).alias("first"), F.get(opened, held - 1).alias("predicate"), n.alias("last"))
        opens = state(F.concat(path, F.when(place == 0, "s").otherwise("o")), F.lit(0), (place == 0) | (place == 2), F.array_append(opened, n), ends, before, n)
        shorter = F.substring(path, F.lit(1), F.length(path) - 1)
        closes = state(shorter, F.when(F.endswith(path, F.lit("s")), 1).otherwise(3), nested & (place == 3), F.slice(opened, F.lit(1), F.greatest(held - 2, F.lit(0))), F.when(outermost, F.array_append(ends, n)).otherwise(ends), F.array_append(before, part) if parts else None, n)
        fits = F.when(place == 0, ~F.startswith(token, F.lit('"'))).when(place == 1, F.startswith(token, F.lit("<"))).otherwise(place == 2)
        term = state(path, place + 1, F.when(nested, fits).otherwise(place < 5), F.when(nested & (place == 1), F.array_append(opened, n)).otherwise(opened), F.when(nested, ends).otherwise(F.array_append(ends, n)), before, n)
        return F.when(~x["ok"], x).when(token == "<<", opens).when(token == ">>", closes).otherwise(term)

    def end(x: Column) -> Column:
        terms = F.transform(x["ends"], lambda last, k: _joined(tokens, F.coalesce(F.get(x["ends"], k - 1), F.lit(0)) + 1, last))
        return F.struct(terms.alias("terms"), (x["ok"] & (x["path"] == "")).alias("ok"), *([x["done"].alias("done")] if parts else []))

    start = state(F.lit(""), F.lit(0), F.lit(True), ints, ints, done, F.lit(0))
    return F.aggregate(tokens, start, step, end)


def _part_terms(tokens: Column, part: Column) -> Column:
    """The three terms of a quoted triple that ``_closed`` found in the tokens, null if it has none."""
    at = part["predicate"]
    return F.array(_joined(tokens, part["first"] + 1, at - 1), F.get(tokens, at - 1), _joined(tokens, at + 1, part["last"] - 1))


def parse_lines(lines: DataFrame, parts: str | None = None) -> DataFrame:
    """Lines (text, ...) with the quad columns added; all are null where a line is no statement.

    A quoted triple, of any depth, is a term of kind ``triple`` with its terms joined by spaces; ``quoted_parts`` gives those. Each line is matched once.
    With ``parts`` a column of that name has the path and depth of each of a statement's quoted triples, as ``quoted_parts`` has them.
    """
    tokens, path = F.regexp_extract_all("text", F.lit(_TOKENS), F.lit(1)), F.array().cast("array<struct<path: string, depth: int>>")

    def row(terms: Column, ok: Column, fine: Column, found: Column) -> Column:
        return F.struct(F.when(ok, terms).alias("t"), fine.alias("fine"), *([found.alias("q")] if parts else []))

    def quoted(tokens: Column) -> Column:
        # What follows the full stop may have any characters.
        fine = ~F.contains("text", F.lit("\\")) | F.forall(tokens, lambda t: t.startswith(".") | _sound_escapes(t))
        of = lambda c: row(c["terms"], c["ok"], fine, F.transform(c["done"], lambda d: F.struct(d["path"].alias("path"), d["depth"].alias("depth"))) if parts else path)
        return F.get(F.transform(F.array(_closed(tokens, parts is not None)), of), F.lit(0))

    # An array of one row keeps the match and the fold a step of their own, so that their uses, and filters on them, don't repeat them; a
    # function of the one in an array has it evaluated once. Without the marks of quoted triples nothing is folded.
    marked = F.contains("text", F.lit("<<")) | F.contains("text", F.lit(">>"))
    rows = F.when(marked, F.transform(F.array(tokens), quoted)).otherwise(F.array(row(tokens, F.lit(True), F.lit(True), path)))
    found = lines.select("*", F.explode(rows).alias("__x")).select(*lines.columns, F.col("__x.t").alias("__t"), F.col("__x.fine").alias("__fine"), *([F.col("__x.q").alias(parts)] if parts else []))
    read = _parsed(found, [*lines.columns, *([parts] if parts else [])])
    return read.withColumn(parts, F.when(F.col("s").isNotNull(), F.col(parts)).otherwise(F.slice(F.col(parts), F.lit(1), F.lit(0)))) if parts else read


def _parsed(found: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the terms of a line and its full stop (__t), and whether escapes in quoted triples are sound (__fine), as quads; see ``parse_lines``."""

    def kind(t: Column) -> Column:
        return F.when(t.startswith("<<"), "triple").when(t.startswith("<"), "iri").when(t.startswith("_:"), "bnode").when(t.startswith('"'), "literal")

    c, null = F.col, F.lit(None).cast("string")
    at = lambda k: F.get("__t", F.lit(k))
    ended = at(4).startswith(".")
    tokens = {"s": at(0), "p": at(1), "o": at(2), "g": F.when(ended, at(3))}
    found = found.select(*columns, (F.when(F.size("__t") == 4, at(3).startswith(".")).otherwise((F.size("__t") == 5) & ended)).alias("__whole"), "__fine", *[t.alias("__" + n) for n, t in tokens.items()])
    suffix = F.when(c("__o").startswith('"'), F.substring_index("__o", '"', -1))
    found = found.withColumns({"__suffix": suffix, **{f"__{n}_kind": kind(c("__" + n)) for n in tokens}})
    size = lambda n: F.char_length(c("__" + n))

    def inside(n: str) -> Column:
        """A term without its marks, as written."""
        t = c("__" + n)
        text = F.when(c(f"__{n}_kind") == "iri", F.substr(t, F.lit(2), size(n) - 2)).when(c(f"__{n}_kind") == "bnode", F.substr(t, F.lit(3))).when(c(f"__{n}_kind") == "triple", F.trim(F.substr(t, F.lit(3), size(n) - 4)))
        return text.when(c(f"__{n}_kind") == "literal", F.substr(t, F.lit(2), size(n) - F.char_length("__suffix") - 2)) if n == "o" else text

    found = found.withColumns({"__in_" + n: inside(n) for n in tokens} | {"__dt": F.when(F.startswith("__suffix", F.lit("^^")), F.substr("__suffix", F.lit(4), F.char_length("__suffix") - 4))})
    node = lambda n, *kinds: c(f"__{n}_kind").isin(*kinds)
    escapes = [c("__fine")] + [(c(f"__{n}_kind") == "triple") | _sound_escapes(c("__in_" + n)) for n in tokens] + [_sound_escapes(c("__dt"))]
    sound = c("__whole") & node("s", "iri", "bnode", "triple") & node("p", "iri") & c("__o_kind").isNotNull() & (c("__g").isNull() | node("g", "iri", "bnode"))
    for fine in escapes:
        sound = sound & F.coalesce(fine, F.lit(True))
    plain = F.lit("http://www.w3.org/2001/XMLSchema#string")
    lang = F.when(F.startswith("__suffix", F.lit("@")), F.substr("__suffix", F.lit(2)))
    terms = {"o_dt": F.when(c("__suffix") == "", plain).otherwise(_unescaped(c("__dt"))), "o_lang": lang}
    for n in tokens:
        terms |= {n: F.when(c(f"__{n}_kind") == "triple", c("__in_" + n)).otherwise(_unescaped(c("__in_" + n))), n + "_kind": c(f"__{n}_kind")}
    found = found.withColumn("__sound", F.coalesce(sound, F.lit(False)))
    return found.select(*columns, *[F.when(c("__sound"), terms.get(n, null)).alias(n) for n in ("o", "o_kind", "o_dt", "o_lang", "g", "g_kind", "s", "s_kind", "p", "p_kind")])


def is_blank(text: Column) -> Column:
    """Lines without statement that a file may have."""
    return text.rlike(r"^\s*+(?:#.*+)?+$")


def statements(lines: DataFrame, bad: str = "error", where: str = "text") -> DataFrame:
    """The lines (text, ...) that are statements, with the quad columns. Blank lines and comments go; a line that is
    neither is an error that names ``where``, or goes too if ``bad`` is ``drop`` (``validate.parse_check`` lists such lines)."""
    rows = parse_lines(lines.filter(~is_blank(F.col("text"))))
    if bad == "drop":
        return rows.filter("s is not null")
    wrong = F.raise_error(F.concat(F.lit("no statement in "), F.col(where).cast("string"), F.lit(": "), F.left(F.col("text"), F.lit(200))))
    return rows.withColumn("s", F.when(F.col("s").isNull(), wrong).otherwise(F.col("s")))


def read_flat_statements(spark: SparkSession, path: str, bad: str = "error") -> DataFrame:
    """A3: the statements of (gzipped) N-Triples or N-Quads files as quad columns; see ``statements`` for other lines."""
    return statements(spark.read.text(path).withColumnRenamed("value", "text"), bad).drop("text")


def quoted_parts(quads: DataFrame) -> DataFrame:
    """(element_id, path, depth, parts) of the quoted triples that are subject or object of a quad, those inside them at any depth included.

    ``path`` says where: s or o for each level.
    """
    parts = ("s", "s_kind", "p", "p_kind", "o", "o_kind", "o_dt", "o_lang")
    outer = F.filter(F.array(*[F.when(F.col(n + "_kind") == "triple", F.struct(F.lit(n).alias("at"), F.concat(F.lit("<< "), F.col(n), F.lit(" >>")).alias("text"))) for n in "so"]), lambda x: x.isNotNull())
    texts = quads.select("element_id", F.explode(outer).alias("x")).select("element_id", "x.*")
    tokens = texts.select("element_id", "at", F.explode(F.array(F.regexp_extract_all("text", F.lit(_TOKENS), F.lit(1)))).alias("t"))
    closed = tokens.select("element_id", "at", "t", F.explode(F.array(_closed(F.col("t"), parts=True))).alias("c"))
    none = F.lit(None).cast("int")  # a text that is no quoted triple has one part without terms, which is an error below
    wrong = F.array(F.struct(F.lit("s").alias("path"), F.lit(1).alias("depth"), none.alias("first"), none.alias("predicate"), none.alias("last")))
    found = closed.select("element_id", "at", "t", F.explode(F.when(F.col("c.ok"), F.col("c.done")).otherwise(wrong)).alias("q"))
    # The path of the outermost is s, as it is the first term of its text.
    rows = found.select("element_id", F.concat("at", F.substr("q.path", F.lit(2))).alias("path"), "q.depth", F.array_append(_part_terms(F.col("t"), F.col("q")), F.lit(".")).alias("__t"), F.lit(True).alias("__fine"))
    read = _parsed(rows, ["element_id", "path", "depth"])
    wrong = F.raise_error(F.concat(F.lit("no quoted triple at "), F.col("path"), F.lit(" of element "), F.col("element_id").cast("string")))
    return read.select("element_id", "path", "depth", F.when(F.col("s").isNull(), wrong).otherwise(F.col("s")).alias("s"), *parts[1:])


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, byte_size, md5, sha1, sha256) of each file, in lower-case hexadecimal; files of any size are read as streams in the tasks."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                found, size = [hashlib.new(kind, usedforsecurity=False) for kind in ("md5", "sha1", "sha256")], 0
                with open_stream(name) as source:
                    while part := source.read(1 << 20):
                        size += len(part)
                        for h in found:
                            h.update(part)
                rows.append({"path": name, "file_name": name.rpartition("/")[2], "byte_size": size} | {h.name: h.hexdigest() for h in found})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path").mapInArrow(digest, "path string, file_name string, byte_size long, md5 string, sha1 string, sha256 string")


def digests(text: Column) -> list[Column]:
    """Byte size, md5, sha1 and sha256 of a text."""
    return [F.octet_length(text).cast("long").alias("byte_size"), F.md5(text).alias("md5"), F.sha1(text).alias("sha1"), F.sha2(text, 256).alias("sha256")]


def release_info(json: Column) -> Column:
    """A release record, null for what is none."""
    return F.from_json(json, RELEASE)


def source_asset_url(release: Column, name: str = "source.tar.gz") -> Column:
    """The URL of the one asset of that name; null if there is none or several."""
    found = F.filter(release["assets"], lambda a: a["name"] == name)
    return F.when(F.size(found) == 1, F.get(found, F.lit(0))["browser_download_url"])


def member_name(path: Column, strip: str = "profile-") -> Column:
    """The name of a collection's member from its file path; null for the template."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[a-z]+(\.gz)?$", "")
    return F.when(stem != "template", F.regexp_replace(stem, "^" + strip, ""))


def load_collection(spark: SparkSession, path: str) -> DataFrame:
    """The statements of all flat files under ``path``, keyed by ``name``; a line that is none is an error.

    A member is a file, or a folder of part files, right below ``path``; files may be compressed, as Spark's readers know it by their names. A name
    is found once a file. Of the files only paths come to the join, which the driver lists anyway, so they may be broadcast.
    """
    top = f"/{path.rstrip('/').rpartition('/')[2]}/"
    under = lambda kind: spark.read.format(kind).option("recursiveFileLookup", "true").load(path)
    file = F.col("_metadata.file_path")
    start = F.locate(top, file)
    member = F.when(start > 0, F.substring_index(F.substr(file, start + len(top)), "/", 1)).otherwise("")
    names = under("binaryFile").select(file.alias("__named"), member_name(F.regexp_replace(member, r"^\w+=", "")).alias("name")).filter("name is not null")
    lines = under("text").select(F.col("value").alias("text"), file.alias("__file"))
    return statements(lines.join(F.broadcast(names), F.col("__file") == F.col("__named")).select("text", "name"), where="name").drop("text")


def write_degrees(degrees: DataFrame, path: str, with_nodes: bool = True) -> None:
    """A TSV folder for each role: node, occurrences, lower bound, estimate, upper bound."""
    columns = (["node"] if with_nodes else []) + ["occurrences", "distinct_lower", "distinct_est", "distinct_upper"]
    degrees.select("role", *columns).write.partitionBy("role").option("sep", "\t").csv(path)


def archive_entries(rows: DataFrame, number: Column, archive: Column, extension: str = "ttl") -> DataFrame:
    """(archive, pos, path, number) of archives' entries named by numbers; positions come from ranges of all entries, so an archive is no single task's."""
    named = rows.select(archive.alias("archive"), number.alias("number"), F.concat(F.lpad(number.cast("string"), 10, "0"), F.lit("." + extension)).alias("path"))
    numbered = element_index(named, F.col("archive"), F.col("path")).withColumnRenamed("element_id", "pos")
    first = numbered.groupBy("archive").agg(F.min("pos").alias("first"))
    placed = numbered.join(first.withColumnRenamed("archive", "__archive"), F.col("archive").eqNullSafe(F.col("__archive")))
    return placed.select("archive", (F.col("pos") - F.col("first")).alias("pos"), "path", element_id_of(F.col("path")).alias("number"))
