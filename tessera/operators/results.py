"""Benchmark results from nanopublications, stream types, and records of datasets and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import parse_purl, semver_key
from tessera.functions.terms import category_of


def nanopub_index(quads: DataFrame, has_assertion: str, has_pubinfo: str) -> DataFrame:
    """(np, head, assertion, pubinfo) by the two links in each head graph; the least where there are several."""
    a = quads.filter(F.col("p") == has_assertion).groupBy(F.col("g").alias("head"), F.col("s").alias("np")).agg(F.min("o").alias("assertion"))
    b = quads.filter(F.col("p") == has_pubinfo).groupBy("g").agg(F.min("o").alias("pubinfo"))
    return a.join(b, F.col("head") == F.col("g")).select("np", "head", "assertion", "pubinfo")


def benchmark_results(quads: DataFrame, index: DataFrame, protocol: str, uses_profile: str, uses_task: str, created: str) -> DataFrame:
    """(np, profile, task, date) of the nanopublications whose assertion follows a protocol; the first of each, or null."""
    wanted = quads.filter(F.col("p").isin(protocol, uses_profile, uses_task))
    steps = wanted.filter(F.col("p") == protocol).groupBy(F.col("g").alias("pg")).agg(F.min("o").alias("protocol"))
    part = lambda p, name: wanted.filter(F.col("p") == p).groupBy("g", "s").agg(F.min("o").alias(name)).withColumnsRenamed({"g": name + "_g", "s": name + "_s"})
    out = index.join(steps, F.col("assertion") == F.col("pg"))
    for p, name in ((uses_profile, "profile"), (uses_task, "task")):
        out = out.join(part(p, name), (F.col("assertion") == F.col(name + "_g")) & (F.col("protocol") == F.col(name + "_s")), "left")
    dates = quads.filter(F.col("p") == created).groupBy(F.col("g").alias("dg"), F.col("s").alias("ds")).agg(F.min("o").alias("date"))
    return out.join(dates, (F.col("pubinfo") == F.col("dg")) & (F.col("np") == F.col("ds")), "left").select("np", "profile", "task", "date")


def results_for_task(results: DataFrame, task: str, version: str) -> DataFrame:
    """Results (np, task) of one task at a version up to the given one; those with other URLs or versions are left out."""
    p = parse_purl(F.col("task"))
    rows = results.withColumn("purl", p).filter((F.col("purl.kind") == "tasks") & (F.col("purl.id") == task))
    return rows.filter(semver_key(F.col("purl.version")) <= semver_key(F.lit(version))).drop("purl")


def typed_nanopubs(index: DataFrame, signatures: DataFrame, types: DataFrame, wanted: str) -> DataFrame:
    """(np, pubkey, assertion) with a valid signature (np, pubkey) and, in its pubinfo graph, the type (g, o)."""
    of_type = types.filter(F.col("o") == wanted).select(F.col("g").alias("pubinfo")).distinct()
    return index.join(of_type, "pubinfo", "left_semi").join(signatures, "np").select("np", "pubkey", "assertion").distinct()


def in_category(nanopubs: DataFrame, uses: DataFrame, category: str) -> DataFrame:
    """Those whose assertion graph uses (g, o) a profile or task of the category."""
    hits = uses.filter(category_of(F.col("o")) == category).select(F.col("g").alias("assertion")).distinct()
    return nanopubs.join(hits, "assertion", "left_semi")


def drop_marked(nanopubs: DataFrame, marks: DataFrame) -> DataFrame:
    """Without those that ``marks`` (np, pubkey) supersede or retract by the same key."""
    return nanopubs.join(marks.select("np", "pubkey").distinct(), ["np", "pubkey"], "left_anti")


def results_order(results: DataFrame, task: str = "task", date: str = "date") -> DataFrame:
    """by task, then by date; missing ones last."""
    return results.orderBy(F.coalesce(task, F.lit("zzz")), F.coalesce(date, F.lit("zzz")), "np")


def stream_types_of(usages: DataFrame, types: DataFrame) -> DataFrame:
    """(dataset, name, is_flat, element_type): usages (dataset, type IRI) by the local name in the small table of stream types."""
    named = usages.select("dataset", F.regexp_extract("type", r"([^/#]*)$", 1).alias("name"))
    return named.join(types, "name").select("dataset", "name", "is_flat", "element_type")


#: The stream types, their document names, whether they are flat, and what their elements are.
STREAM_TYPES = (
    ("graphStream", "rdf-graph-stream", False, "graph"),
    ("subjectGraphStream", "rdf-subject-graph-stream", False, "graph"),
    ("datasetStream", "rdf-dataset-stream", False, "dataset"),
    ("namedGraphStream", "rdf-named-graph-stream", False, "dataset"),
    ("timestampedNamedGraphStream", "timestamped-rdf-named-graph-stream", False, "dataset"),
    ("flatTripleStream", "flat-rdf-triple-stream", True, "triple"),
    ("flatQuadStream", "flat-rdf-quad-stream", True, "quad"),
)


def stream_types(spark) -> DataFrame:
    return spark.createDataFrame(STREAM_TYPES, "name string, doc_name string, is_flat boolean, element_type string")


def dataset_records(facts: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """One row for each dataset of facts (dataset, property, value), a column for each property; a missing required one is an error."""
    row = facts.groupBy("dataset").agg(*[F.min(F.when(F.col("property") == p, F.col("value"))).alias(p) for p in (*required, *optional)])
    must = {p: F.when(F.col(p).isNull(), F.raise_error(F.concat(F.lit(f"no {p} of "), F.col("dataset")))).otherwise(F.col(p)) for p in required}
    return row.withColumns(must)


def previous_versions(releases: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, version) of the latest release of each wanted (name, file_name) that has the file as an asset; tags are v and the version.

    Releases that repeat a version and file count once, before the join.
    """
    assets = releases.select(F.expr("substring(tag_name, 2)").alias("version"), F.explode("assets.name").alias("file_name")).distinct()
    return wanted.join(assets, "file_name").groupBy("name").agg(F.max_by("version", semver_key(F.col("version"))).alias("version"))
