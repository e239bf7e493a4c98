"""Report tables, and statistics and distributions as statements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import distribution_title, distribution_weight, doc_weight, group_digits, human_bytes, human_size, local_id

DIST_TYPES = ("flat", "stream", "jelly")


def stats_with_files(stats: DataFrame, files: DataFrame) -> DataFrame:
    """C20: statistics with the files of the same size; never by position."""
    return stats.join(files, "size")


def download_rows(distributions: DataFrame) -> DataFrame:
    """(dataset, size, flat, stream, jelly): the byte size of each type in a column."""
    return distributions.groupBy("dataset", "size").agg(*[F.max(F.when(F.col("dist_type") == t, F.col("byte_size"))).alias(t) for t in DIST_TYPES])


def profile_size_table(distributions: DataFrame, sizes: list[int], contains: str | None = None) -> DataFrame:
    """(dataset, one column for each size, full): file names; full is the largest distribution there is."""
    rows = distributions if contains is None else distributions.filter(F.col("file_name").contains(contains))
    return rows.groupBy("dataset").agg(*[F.max(F.when(F.col("size") == s, F.col("file_name"))).alias(f"s{s}") for s in sizes], F.max_by("file_name", "size").alias("full"))


def dataset_download_table(distributions: DataFrame) -> DataFrame:
    """A row for each size of a dataset, with readable sizes."""
    rows = download_rows(distributions)
    return rows.select("dataset", "size", human_size(F.col("size"), True).alias("name"), *[human_bytes(F.col(t)).alias(t) for t in DIST_TYPES])


def statistics_table(stats: DataFrame, order: list[str]) -> DataFrame:
    """Statistic by measure as text, in the given order; what is missing is N/A."""
    place = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("statistic"))
    text = [F.coalesce(F.format_string("%.2f", F.col(m)), F.lit("N/A")).alias(m) for m in ("sum", "mean", "st_dev", "min", "max")]
    return stats.select("size", "statistic", place.cast("int").alias("weight"), *text)


def unique_with_bounds(stats: DataFrame) -> DataFrame:
    """(size, statistic, shown): the unique count, with its bounds where it has some."""
    shown = F.when(F.col("unique_lower").isNull(), group_digits(F.col("unique_count"))).otherwise(F.concat(F.lit("~ "), group_digits(F.col("unique_count")), F.lit(" ("), group_digits(F.col("unique_lower")), F.lit(" - "), group_digits(F.col("unique_upper")), F.lit(")")))
    return stats.select("size", "statistic", shown.alias("shown"))


def statistics_to_statements(stats: DataFrame, total: int) -> DataFrame:
    """(s, p, o) of each measure of each statistic, of its type and of the weights; ids depend on content only."""
    node = F.concat(F.lit("_:"), F.md5(F.concat_ws("|", "statistic", F.col("size").cast("string"))))
    of_set = F.concat(F.lit("#statistics-"), F.lower(human_size(F.col("size"), True)))
    pairs = [("urn:p:type", F.concat(F.lit("urn:t:"), "statistic")), ("urn:p:weight", doc_weight(F.col("size"), F.lit(total)).cast("string"))]
    pairs += [(f"urn:p:{m}", F.format_string("%.3f", F.col(m))) for m in ("sum", "mean", "min", "max")]
    facts = [F.struct(node.alias("s"), F.lit(p).alias("p"), o.alias("o")) for p, o in pairs]
    facts.append(F.struct(of_set.alias("s"), F.lit("urn:p:hasStatistics").alias("p"), node.alias("o")))
    return stats.select(F.explode(F.array(*facts)).alias("t")).select("t.*").filter("o is not null")


def distributions_to_statements(distributions: DataFrame) -> DataFrame:
    """(s, p, o) of distributions (dataset, size, total, dist_type, file_name, byte_size, md5, sha1)."""
    c = F.col
    s = F.concat(c("dataset"), F.lit("#"), local_id(c("file_name")))
    pairs = [
        ("urn:p:title", distribution_title(c("size"), c("total"), c("dist_type"))),
        ("urn:p:weight", distribution_weight(c("size"), c("total"), c("dist_type")).cast("string")),
        ("urn:p:elements", c("size").cast("string")),
        ("urn:p:byteSize", c("byte_size").cast("string")),
        ("urn:p:md5", c("md5")),
        ("urn:p:sha1", c("sha1")),
        ("urn:p:extent", F.when(c("size") == c("total"), "full").otherwise("partial")),
    ]
    facts = [F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o")) for p, o in pairs]
    return distributions.select(F.explode(F.array(*facts)).alias("t")).select("t.*")


def dataset_overview(info: DataFrame) -> DataFrame:
    """L1: name, element type, element and statement counts as text, and whether RDF-star is used, by name."""
    return info.select("name", "element_type", group_digits(F.col("element_count")).alias("elements"), group_digits(F.coalesce("statement_count", F.lit(0))).alias("statements"), "uses_star").orderBy("name")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
