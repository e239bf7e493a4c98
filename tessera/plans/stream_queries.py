"""Queries that run as streams over files of quads, and the SQL of their batch equals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.names import element_id_of
from tessera.operators import stats, validate
from tessera.plans.stat_queries import STREAMS, shown, shown_sql
from tessera.sources import files
from tessera.sources.shared import shared_folder
from tessera.sources.views import VIEWS, by_element, table, with_views
from tessera.streaming import jobs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _stream(spark, sf_dir, view: str):
    path = shared_folder(spark)
    jobs.write_stream_files(VIEWS[view](spark, sf_dir), path)
    return jobs.element_stream(spark, path)


def j1_element_stream(spark, sf_dir):
    return jobs.fan_out(_stream(spark, sf_dir, "q_events"), {"all": lambda b: b.select("element_id", "p", "o")})["all"]


def j1_archive_stream(spark, sf_dir):
    """Elements in archives, streamed from these: number and lines of each."""
    folder = shared_folder(spark)
    documents = files.element_documents(by_element("q_events", spark, sf_dir), with_graph=False)
    files.write_element_stream(documents, folder, members=10_000).write.format("noop").mode("overwrite").save()
    entries = files.stream_element_archives(spark, folder, 3)
    lines = F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1
    return jobs.fan_out(entries, {"all": lambda b: b.select(element_id_of(F.col("path")).alias("element_id"), lines.alias("statements"))})["all"]


def j2_fan_out(spark, sf_dir):
    sinks = {
        "predicates": lambda b: b.groupBy("p").agg(F.count("*").alias("n")),
        "samples": lambda b: b.filter(F.col("element_id").isin(0, 10, 100, 1000)).groupBy("p").agg(F.count("*").alias("n")),
    }
    out = jobs.fan_out(_stream(spark, sf_dir, "q_events"), sinks)
    both = out["predicates"].withColumn("sink", F.lit("predicates")).unionByName(out["samples"].withColumn("sink", F.lit("samples")))
    return both.groupBy("sink", "p").agg(F.sum("n").alias("n"))


def j3_running_stats(spark, sf_dir):
    """All fifteen statistics of the stream of documents with quoted triples, which are read from its terms."""
    elements = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("element_id"))
    sizes = stats.prefix_sizes(elements, STREAMS["documents"][3])
    return shown(jobs.running_stats(_stream(spark, sf_dir, "q_stars"), sizes, quoted=files.quoted_parts))


def j4_stream_checks(spark, sf_dir):
    def check(batch):
        elements = batch.select("element_id").distinct()
        marked = batch.withColumn("g", F.when(F.col("element_id") % 50 == 0, "urn:g")).withColumn("g_kind", F.when(F.col("g").isNotNull(), "iri"))
        return validate.structure_violations(elements, marked, triple_stream=True)

    return jobs.fan_out(_stream(spark, sf_dir, "q_events"), {"violations": check})["violations"]


def j5_stream_gap_check(spark, sf_dir):
    path = shared_folder(spark)
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    numbers = o.select(F.concat(F.lit("a"), (F.col("o_orderkey") % 3).cast("string")).alias("archive"), (F.col("o_orderkey") / 3).cast("long").alias("number"))
    n = jobs.parallelism(spark)
    numbers.repartitionByRange(4 * n, "number").write.parquet(path)
    stream = spark.readStream.schema("archive string, number long").option("maxFilesPerTrigger", n).parquet(path)
    return jobs.stream_gaps_in_batches(stream)


QUERIES |= {f.__name__: f for f in (j1_element_stream, j1_archive_stream, j2_fan_out, j3_running_stats, j4_stream_checks, j5_stream_gap_check)}
SQL["j1_element_stream"] = with_views("q_events") + " SELECT element_id, p, o FROM q_events"
SQL["j1_archive_stream"] = with_views("q_events") + " SELECT element_id, count(*) AS statements FROM q_events GROUP BY element_id"
SQL["j2_fan_out"] = with_views("q_events") + " SELECT 'predicates' AS sink, p, count(*) AS n FROM q_events GROUP BY p UNION ALL SELECT 'samples', p, count(*) FROM q_events WHERE element_id IN (0, 10, 100, 1000) GROUP BY p"
SQL["j3_running_stats"] = shown_sql(*STREAMS["documents"])
SQL["j4_stream_checks"] = "SELECT event_id AS element_id, 'no_named_graphs' AS rule, 'named graphs in a triple stream' AS message FROM events WHERE event_id % 50 = 0"
SQL["j5_stream_gap_check"] = "WITH n AS (SELECT DISTINCT 'a' || (o_orderkey % 3) AS archive, o_orderkey // 3 AS number FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), f AS (SELECT *, lead(number) OVER (PARTITION BY archive ORDER BY number) AS following FROM n) SELECT archive, number AS after, number + 1 AS missing FROM f WHERE following <> number + 1"
