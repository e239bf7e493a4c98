"""Queries of traversals, lookups, results, matching, validation and reports, and their SQL.

The metadata graph is derived from the relational tables: region, nation, customer and supplier are profiles in a
hierarchy, parts are datasets, orders are nanopublications keyed by their customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import ROOT
from tessera.functions.terms import RDF_TYPE, XSD
from tessera.operators import graphs, profiles, reports, results, stats, validate
from tessera.plans.name_queries import SIZE_NAMES, human_sql
from tessera.plans.stat_queries import STATISTICS, inputs, summary_sql
from tessera.sources import files
from tessera.sources.shared import dealt, settle
from tessera.sources.views import QUAD_COLUMNS, VIEWS, bnode, by_element, explode_quads, iri, literal, quad, spread, table, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# Hierarchy


def hierarchy(spark, sf_dir) -> DataFrame:
    """(above, below) of the direct pairs."""
    n = table(spark, sf_dir, "nation").select(F.expr("'r' || n_regionkey").alias("above"), F.expr("'n' || n_nationkey").alias("below"))
    s = table(spark, sf_dir, "supplier").select(F.expr("'n' || s_nationkey").alias("above"), F.expr("'s' || s_suppkey").alias("below"))
    c = table(spark, sf_dir, "customer").select(F.expr("'n' || c_nationkey").alias("above"), F.expr("'c' || c_custkey").alias("below"))
    return n.unionByName(s).unionByName(c)


_HIERARCHY = "edges AS (SELECT 'r' || n_regionkey AS above, 'n' || n_nationkey AS below FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer)"


@query("c12_profile_closure", f"WITH RECURSIVE {_HIERARCHY}, p AS (SELECT above, below FROM edges UNION SELECT p.above, e.below FROM p JOIN edges e ON p.below = e.above) SELECT above AS s, 'urn:p:supersetOf' AS p, below AS o FROM p UNION ALL SELECT below, 'urn:p:subsetOf', above FROM p")
def c12_profile_closure(spark, sf_dir):
    return graphs.closure_statements(graphs.transitive_pairs(hierarchy(spark, sf_dir)), "urn:p:supersetOf", "urn:p:subsetOf")


@query("c13_subject_subgraph", with_views("q_orders") + ", p AS (SELECT element_id, s AS root, s AS node FROM q_orders WHERE p = 'urn:p:status' AND o = 'P' UNION SELECT q.element_id, p.root, q.o FROM p JOIN q_orders q ON q.s = p.node AND q.o_kind = 'bnode' AND q.element_id = p.element_id) SELECT root, q.p, count(*) AS n FROM p JOIN q_orders q ON q.s = p.node AND q.element_id = p.element_id GROUP BY root, q.p")
def c13_subject_subgraph(spark, sf_dir):
    q = by_element("q_orders", spark, sf_dir)
    own = q.filter("p = 'urn:p:status' and o = 'P'").select("element_id").distinct()
    # A root leads to statements of its own element only, so other elements go before statements are dealt by their subjects.
    q = settle(q.join(dealt(own), "element_id", "left_semi"))
    # Labels of blank nodes are local to an element, so they are made global first.
    scoped = q.withColumns({x: F.when(F.col(x + "_kind") == "bnode", F.concat_ws("/", "element_id", x)).otherwise(F.col(x)) for x in "so"})
    roots = scoped.filter("p = 'urn:p:status' and o = 'P'").select(F.col("s").alias("root"))
    return graphs.subject_subgraph(scoped, roots).groupBy("root", "p").agg(F.count("*").alias("n"))


@query("c13_long_chains_and_cycles", "WITH b AS (SELECT event_id, event_id // 2000 AS block, CAST(round(value * 100) AS BIGINT) AS cents FROM events) SELECT 'urn:chain:' || block AS root, 1 + count(*) + count(*) - CASE WHEN block % 2 = 0 THEN 1 ELSE 0 END AS statements, CAST(sum(cents) AS BIGINT) AS cents FROM b GROUP BY block")
def c13_long_chains_and_cycles(spark, sf_dir):
    """Events as blank nodes, each leading to the next, in chains of 2,000 and, in turn with these, cycles."""
    e = table(spark, sf_dir, "events").select("event_id", F.round(F.col("value") * 100).cast("long").alias("cents"), F.floor(F.col("event_id") / 2000).alias("block"))
    last = e.groupBy("block").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    rows = e.join(last, "block")
    node = lambda k: bnode(F.concat(F.lit("_:e"), k.cast("string")))
    here, root = node(F.col("event_id")), iri(F.concat(F.lit("urn:chain:"), F.col("block").cast("string")))
    following = F.when(F.col("event_id") < F.col("last"), F.col("event_id") + 1).when(F.col("block") % 2 == 1, F.col("first"))
    start = F.when(F.col("event_id") == F.col("first"), F.col("event_id"))
    g = explode_quads(rows, F.col("event_id"), [quad(here, "urn:p:cents", literal(F.col("cents"), "integer")), quad(here, "urn:p:next", node(following)), quad(root, "urn:p:start", node(start))])
    found = graphs.subject_subgraph(g, last.select(F.concat(F.lit("urn:chain:"), F.col("block").cast("string")).alias("root")))
    return found.groupBy("root").agg(F.count("*").alias("statements"), F.sum(F.when(F.col("p") == "urn:p:cents", F.col("o").cast("long"))).alias("cents"))


@query("c14_element_subject_node", with_views("q_orders", "q_stars", "quoted_stars") + " SELECT DISTINCT element_id, s AS node FROM q_orders WHERE p = 'urn:p:status' UNION SELECT element_id, o FROM q_orders WHERE p = 'urn:p:customer' UNION SELECT element_id, s FROM quoted_stars")
def c14_element_subject_node(spark, sf_dir):
    orders = validate.subject_nodes(VIEWS["q_orders"](spark, sf_dir), [("target_subjects_of", "urn:p:status"), ("target_objects_of", "urn:p:customer")])
    stars = validate.subject_nodes(VIEWS["q_stars"](spark, sf_dir), [("quoted_subject", None)], VIEWS["quoted_stars"](spark, sf_dir))
    return orders.union(stars).distinct()


@query("k2_subject_shape_plug_in", with_views("q_orders") + " SELECT DISTINCT element_id, o AS node FROM q_orders WHERE p = 'urn:p:priority' AND o LIKE '1%'")
def k2_subject_shape_plug_in(spark, sf_dir):
    validate.register_shape("urgent", lambda quads, quoted, prefix, rdf_type: quads.filter((F.col("p") == "urn:p:priority") & F.col("o").startswith(prefix)).select("element_id", F.col("o").alias("node")))
    return validate.subject_nodes(VIEWS["q_orders"](spark, sf_dir), [("urgent", "1")])


# Datasets


_TYPE = "CASE p_partkey % 4 WHEN 0 THEN 'graphStream' WHEN 1 THEN 'flatTripleStream' WHEN 2 THEN 'timestampedNamedGraphStream' ELSE 'subjectGraphStream' END"
_IS_FLAT = "p_partkey % 4 = 1"
_ELEMENT_TYPE = "CASE p_partkey % 4 WHEN 1 THEN 'triple' WHEN 2 THEN 'dataset' ELSE 'graph' END"


@query("c1_stream_types_of_dataset", f"SELECT p_partkey AS dataset, {_TYPE} AS name, {_IS_FLAT} AS is_flat, {_ELEMENT_TYPE} AS element_type FROM part")
def c1_stream_types_of_dataset(spark, sf_dir):
    usages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("dataset"), F.expr(f"'urn:streams/v#' || {_TYPE}").alias("type"))
    return results.stream_types_of(usages, results.stream_types(spark))


@query("b10_flat_stream_type", f"SELECT p_partkey AS dataset, {_ELEMENT_TYPE} = 'triple' AS is_triple_stream FROM part WHERE {_IS_FLAT}")
def b10_flat_stream_type(spark, sf_dir):
    return c1_stream_types_of_dataset(spark, sf_dir).filter("is_flat").select("dataset", (F.col("element_type") == "triple").alias("is_triple_stream"))


def distributions(spark, sf_dir) -> DataFrame:
    """Distributions of parts: three sizes by three types, with the statistics sum as statements."""
    rows = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", "p_size", F.explode(F.array(F.lit(10_000), F.lit(100_000), F.expr("100001 + p_partkey"))).alias("size"))
    rows = rows.withColumn("dist_type", F.explode(F.array(*map(F.lit, reports.DIST_TYPES))))
    return rows.select(
        F.expr("'urn:d:' || p_partkey").alias("dataset"),
        F.col("size").cast("long").alias("size"),
        F.expr("CAST(100001 + p_partkey AS BIGINT)").alias("total"),
        "dist_type",
        F.expr("dist_type || '_' || size || CASE dist_type WHEN 'flat' THEN '.nt.gz' WHEN 'stream' THEN '.tar.gz' ELSE '.jelly.gz' END").alias("file_name"),
        F.expr("CAST(size * p_size AS BIGINT)").alias("byte_size"),
        F.expr("CAST(size * 7 AS BIGINT)").alias("statements"),
        F.md5(F.expr("dist_type || size")).alias("md5"),
        F.sha1(F.expr("dist_type || size")).alias("sha1"),
    )


_DISTS = """WITH d AS (SELECT 'urn:d:' || p_partkey AS dataset, CAST(x.size AS BIGINT) AS size, CAST(100001 + p_partkey AS BIGINT) AS total, t.dist_type,
t.dist_type || '_' || x.size || CASE t.dist_type WHEN 'flat' THEN '.nt.gz' WHEN 'stream' THEN '.tar.gz' ELSE '.jelly.gz' END AS file_name, CAST(x.size * p_size AS BIGINT) AS byte_size, CAST(x.size * 7 AS BIGINT) AS statements,
md5(t.dist_type || x.size) AS md5, sha1(t.dist_type || x.size) AS sha1
FROM part, LATERAL (SELECT unnest([10000, 100000, 100001 + p_partkey]) AS size) AS x, (VALUES ('flat'), ('stream'), ('jelly')) AS t(dist_type))"""


@query("d22_download_rows", _DISTS + " SELECT dataset, size, max(CASE WHEN dist_type = 'flat' THEN byte_size END) AS flat, max(CASE WHEN dist_type = 'stream' THEN byte_size END) AS stream, max(CASE WHEN dist_type = 'jelly' THEN byte_size END) AS jelly FROM d GROUP BY dataset, size")
def d22_download_rows(spark, sf_dir):
    return reports.download_rows(distributions(spark, sf_dir))


@query("d23_profile_size_table", _DISTS + " SELECT dataset, max(CASE WHEN size = 10000 THEN file_name END) AS s10000, max(CASE WHEN size = 100000 THEN file_name END) AS s100000, max_by(file_name, size) AS \"full\" FROM d WHERE dist_type = 'jelly' GROUP BY dataset")
def d23_profile_size_table(spark, sf_dir):
    return reports.profile_size_table(distributions(spark, sf_dir).filter("dist_type = 'jelly'"), [10_000, 100_000])


@query("l5_profile_download_table", _DISTS + " SELECT dataset, flavour, max(CASE WHEN size = 10000 THEN file_name END) AS s10000, max(CASE WHEN size = 100000 THEN file_name END) AS s100000, max_by(file_name, size) AS \"full\" FROM d JOIN (VALUES ('.n'), ('tar.gz'), ('jelly.gz')) AS f(flavour) ON contains(file_name, flavour) GROUP BY dataset, flavour")
def l5_profile_download_table(spark, sf_dir):
    d = distributions(spark, sf_dir)
    return reports.union_all([reports.profile_size_table(d, [10_000, 100_000], f).withColumn("flavour", F.lit(f)) for f in (".n", "tar.gz", "jelly.gz")])


@query("l6_dataset_download_table", _DISTS + f" SELECT dataset, size, CASE size {SIZE_NAMES} ELSE 'Full' END AS name, {human_sql('max(byte_size)')} AS flat, {human_sql('max(byte_size)')} AS stream, {human_sql('max(byte_size)')} AS jelly FROM d GROUP BY dataset, size")
def l6_dataset_download_table(spark, sf_dir):
    return reports.dataset_download_table(distributions(spark, sf_dir))


@query("c2_distribution_stats", _DISTS + " SELECT dataset, file_name, size, byte_size, statements FROM d")
def c2_distribution_stats(spark, sf_dir):
    """By the hops from a distribution to its statistics set, to the statistic of the class, to its sum."""
    d = distributions(spark, sf_dir).withColumn("dist", F.concat_ws("#", "dataset", "file_name"))
    has_set = d.select("dist", F.concat(F.lit("set:"), F.col("dist")).alias("set"))
    statistics = d.select(F.concat(F.lit("set:"), F.col("dist")).alias("set"), F.explode(F.array(F.struct(F.lit("StatementCount").alias("class"), F.col("statements").alias("sum")), F.struct(F.lit("IriCount").alias("class"), F.lit(1).cast("long").alias("sum")))).alias("x")).select("set", "x.*")
    return d.drop("statements").join(dealt(has_set), "dist").join(dealt(statistics.filter("class = 'StatementCount'")), "set").select("dataset", "file_name", "size", "byte_size", F.col("sum").alias("statements"))


@query("d21_max_statement_count", _DISTS + " SELECT dataset, max(statements) AS statement_count FROM d GROUP BY dataset")
def d21_max_statement_count(spark, sf_dir):
    return distributions(spark, sf_dir).groupBy("dataset").agg(F.max("statements").alias("statement_count"))


_L9 = """SELECT dataset || '#' || lower(replace(split_part(file_name, '.', 1), '_', '-')) AS s, p, o FROM d, LATERAL (VALUES
('urn:p:title', CASE WHEN size = total THEN 'Full' WHEN size = 10000 THEN '10K elements' ELSE '100K elements' END || ' ' || CASE dist_type WHEN 'jelly' THEN 'Jelly' ELSE dist_type END || ' distribution'),
('urn:p:weight', CAST(3 * CASE WHEN size = total THEN 0 ELSE length(CAST(total AS STRING)) - length(CAST(size AS STRING)) + 1 END + CASE dist_type WHEN 'flat' THEN 0 WHEN 'stream' THEN 1 ELSE 2 END AS STRING)),
('urn:p:elements', CAST(size AS STRING)), ('urn:p:byteSize', CAST(byte_size AS STRING)), ('urn:p:md5', md5), ('urn:p:sha1', sha1), ('urn:p:extent', CASE WHEN size = total THEN 'full' ELSE 'partial' END)) AS x(p, o)"""


@query("l9_distributions_to_statements", _DISTS + " " + _L9)
def l9_distributions_to_statements(spark, sf_dir):
    return reports.distributions_to_statements(distributions(spark, sf_dir))


_STAT_ARGS = STATISTICS["statements"][1:]


@query("c20_stats_with_files", f"SELECT s.*, f.dist_type, f.file_name FROM ({summary_sql('statements', *_STAT_ARGS)}) s JOIN (SELECT 10000 AS size, t.dist_type, t.dist_type || '-10k' AS file_name FROM (VALUES ('flat'), ('stream'), ('jelly')) AS t(dist_type)) f ON s.size = f.size")
def c20_stats_with_files(spark, sf_dir):
    elements, quads, _ = inputs(spark, sf_dir, *_STAT_ARGS[:3])
    found = stats.summary(stats.element_values("statements", elements, quads), stats.prefix_sizes(elements, _STAT_ARGS[3]))
    saved = spark.createDataFrame([(10_000, t, f"{t}-10k") for t in reports.DIST_TYPES], "size long, dist_type string, file_name string")
    return reports.stats_with_files(found, saved)


_TABLE_STATS = ("statements", "graphs", "byte_density")


def _table(spark, sf_dir):
    elements, quads, _ = inputs(spark, sf_dir, *_STAT_ARGS[:3])
    return stats.prefix_stats(list(_TABLE_STATS[:2]), elements, quads, sizes=stats.prefix_sizes(elements, _STAT_ARGS[3])), elements


_TWO = " UNION ALL ".join(f"SELECT *, '{n}' AS statistic FROM ({summary_sql(n, *_STAT_ARGS)})" for n in _TABLE_STATS[:2])


@query("d24_statistics_table", f"SELECT size, statistic, CAST(CASE statistic WHEN 'statements' THEN 2 ELSE 1 END AS INTEGER) AS weight, " + ", ".join(f"coalesce(printf('%.2f', round({m} * 100) / 100), 'N/A') AS {m}" for m in ("sum", "mean", "st_dev", "min", "max")) + f" FROM ({_TWO})")
def d24_statistics_table(spark, sf_dir):
    return reports.statistics_table(_table(spark, sf_dir)[0], ["graphs", "statements"])


@query("l8_statistics_to_statements", f"WITH st AS ({_TWO}), t AS (SELECT *, '_:' || md5(statistic || '|' || size) AS node, (SELECT count(*) FROM orders) AS total FROM st) SELECT s, p, o FROM t, LATERAL (VALUES (node, 'urn:p:type', 'urn:t:' || statistic), (node, 'urn:p:weight', CAST(CASE WHEN size = total THEN 0 ELSE length(CAST(total AS STRING)) - length(CAST(size AS STRING)) + 1 END AS STRING)), (node, 'urn:p:sum', printf('%.3f', sum)), (node, 'urn:p:mean', printf('%.3f', round(mean * 1000) / 1000)), (node, 'urn:p:min', printf('%.3f', min)), (node, 'urn:p:max', printf('%.3f', max)), ('#statistics-' || CASE size WHEN 10000 THEN '10k' WHEN 100000 THEN '100k' WHEN 1000000 THEN '1m' ELSE 'full' END, 'urn:p:hasStatistics', node)) AS x(s, p, o)")
def l8_statistics_to_statements(spark, sf_dir):
    found, elements = _table(spark, sf_dir)
    return reports.statistics_to_statements(found, elements.count())


@query("l7_statistics_report", "SELECT CAST(o_custkey AS BIGINT) AS size, 'orders' AS statistic, CASE WHEN o_custkey % 2 = 0 THEN format('{:,}', count(*)) ELSE '~ ' || format('{:,}', count(*)) || ' (' || format('{:,}', count(*) - 1) || ' - ' || format('{:,}', count(*) + 1) || ')' END AS shown FROM orders GROUP BY o_custkey")
def l7_statistics_report(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("size")).agg(F.count("*").alias("unique_count"))
    n = n.select("size", F.lit("orders").alias("statistic"), "unique_count", F.when(F.col("size") % 2 == 1, F.col("unique_count") - 1).alias("unique_lower"), (F.col("unique_count") + 1).alias("unique_upper"))
    return reports.unique_with_bounds(n)


# Metadata records


def facts(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pairs = F.array(*[F.struct(F.lit(n).alias("property"), F.expr(e).cast("string").alias("value")) for n, e in (("identifier", "'d-' || p_partkey"), ("description", "p_name"), ("element_count", "CAST(p_size * 1000 - 5000 AS BIGINT)"), ("temporal_prop", "CASE WHEN p_partkey % 3 = 0 THEN 'urn:p:time' END"))])
    return p.select(F.expr("'urn:d:' || p_partkey").alias("dataset"), F.explode(pairs).alias("f")).select("dataset", "f.*").filter("value is not null")


@query("c3_dataset_metadata_record", "SELECT 'urn:d:' || p_partkey AS dataset, 'd-' || p_partkey AS identifier, p_name AS description, CAST(CAST(p_size * 1000 - 5000 AS BIGINT) AS STRING) AS element_count, CASE WHEN p_partkey % 3 = 0 THEN 'urn:p:time' END AS temporal_prop FROM part")
def c3_dataset_metadata_record(spark, sf_dir):
    return results.dataset_records(facts(spark, sf_dir), ["identifier", "description", "element_count"], ["temporal_prop"])


def info(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.expr("'d-' || p_partkey").alias("identifier"),
        F.expr(f"array({_TYPE}, 'datasetStream')").alias("stream_types"),
        F.expr("CAST(p_size * 1000 - 5000 AS BIGINT)").alias("element_count"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN 'urn:p:time' END").alias("temporal_prop"),
        F.expr("p_partkey % 5 = 0").alias("has_subject_shape"),
        F.expr("p_partkey % 2 = 0").alias("conforms_rdf11"),
        F.expr("p_partkey % 7 <> 0").alias("conforms_star"),
        F.expr("p_partkey % 11 = 0").alias("uses_gen_datasets"),
        F.expr("p_partkey % 13 = 0").alias("uses_gen_triples"),
        F.expr("p_partkey % 17 = 0").alias("uses_star"),
    )


_INFO = f"WITH i AS (SELECT 'd-' || p_partkey AS identifier, {_TYPE} AS t, p_size * 1000 - 5000 AS n, p_partkey % 3 = 0 AS temporal, p_partkey % 5 = 0 AS shape, p_partkey % 2 = 0 AS r11, p_partkey % 7 <> 0 AS star, p_partkey % 11 = 0 AS gd, p_partkey % 13 = 0 AS gt, p_partkey % 17 = 0 AS us FROM part)"


@query(
    "i8_metadata_consistency",
    _INFO
    + " SELECT identifier, rule FROM i, LATERAL (VALUES ('rdf11_with_nonstandard_feature', r11 AND (gd OR gt OR us)), ('star_draft_without_use', NOT r11 AND star AND NOT us), ('rdf11_without_star_draft', r11 AND NOT star), ('generalized_datasets_in_triple_stream', gd AND t IN ('graphStream', 'subjectGraphStream', 'flatTripleStream')), ('invalid_element_count', n <= 0), ('no_temporal_property', NOT temporal AND t = 'timestampedNamedGraphStream'), ('no_subject_shape', NOT shape AND t = 'subjectGraphStream')) AS r(rule, bad) WHERE bad",
)
def i8_metadata_consistency(spark, sf_dir):
    return validate.metadata_consistency(info(spark, sf_dir))


def _constraint(profile, level, path, op, *terms, n=None, kind="literal", dt="integer"):
    """A row of profiles.CONSTRAINTS; terms of a kind, with the datatype if they are literals."""
    full = [(t, kind, XSD + dt if kind == "literal" else None, None) for t in terms]
    return (profile, level, f"{op} {' '.join(path)} {terms}", list(path), op, n, full)


_PART_RULES = (
    _constraint("big", "dataset", ["urn:p:size"], "ge", "25"),
    _constraint("big", "dataset", ["urn:p:price"], "ge", "1000"),
    _constraint("small", "dataset", ["urn:p:size"], "le", "10"),
    _constraint("small", "dataset", ["urn:p:price"], "min_count", n=1),
    _constraint("exact", "dataset", ["urn:p:size"], "has_value", "7"),
    _constraint("impossible", "dataset", ["urn:p:weight"], "min_count", n=1),
)


@query("c4_match_profiles", "SELECT 'big' AS profile, p_partkey AS target FROM part WHERE p_size >= 25 AND p_retailprice >= 1000 UNION ALL SELECT 'small', p_partkey FROM part WHERE p_size <= 10 AND p_retailprice IS NOT NULL UNION ALL SELECT 'exact', p_partkey FROM part WHERE p_size = 7")
def c4_match_profiles(spark, sf_dir):
    s = iri(F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")))
    q = explode_quads(table(spark, sf_dir, "part"), F.col("p_partkey"), [quad(s, "urn:p:size", literal(F.col("p_size"), "integer")), quad(s, "urn:p:price", literal(F.col("p_retailprice"), "double"))])
    rules = spark.createDataFrame(_PART_RULES, profiles.CONSTRAINTS)
    found = profiles.conforming(q.withColumn("focus", F.col("s")), rules, rules.select("profile").distinct(), None, RDF_TYPE, "urn:p:subClassOf")
    return found.select("profile", F.regexp_extract("focus", "([0-9]+)$", 1).cast("long").alias("target"))


def _customers_as_datasets(spark, sf_dir) -> DataFrame:
    """Customers as datasets, with a blank node that says their stream type; orders as their distributions, with a blank node of statistics."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    text = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    root, usage = iri(text("urn:dataset:", "c_custkey")), bnode(text("_:usage", "c_custkey"))
    sets = explode_quads(
        c,
        F.col("c_custkey"),
        [
            quad(root, RDF_TYPE, iri("urn:t:Dataset")),
            quad(root, "urn:p:usage", usage),
            quad(usage, "urn:p:streamType", iri(text("urn:type:n", "c_nationkey"))),
            quad(root, "urn:p:segment", literal(F.col("c_mktsegment"), lang=F.lit("en"))),
            quad(root, "urn:p:count", literal(F.abs(F.col("c_acctbal")).cast("long"), "integer")),
            quad(root, "urn:p:temporal", iri(F.when(F.col("c_custkey") % 4 == 0, "urn:p:day"))),
        ],
    )
    dist, stats_ = iri(text("urn:dist:", "o_orderkey")), bnode(text("_:stats", "o_orderkey"))
    of = explode_quads(
        o,
        F.col("o_orderkey"),
        [
            quad(iri(text("urn:dataset:", "o_custkey")), "urn:p:distribution", dist),
            quad(dist, "urn:p:format", iri(text("urn:format:", "o_orderpriority"))),
            quad(dist, "urn:p:size", literal(F.col("o_totalprice").cast("long"), "integer")),
            quad(dist, "urn:p:statistics", stats_),
            quad(stats_, "urn:p:status", literal(F.col("o_orderstatus"))),
        ],
    )
    return sets.unionByName(of)


def _stream_taxonomy(spark, sf_dir) -> DataFrame:
    """Nations as stream types below their regions', and classes of those."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    text = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    kind = iri(text("urn:type:n", "n_nationkey"))
    types = explode_quads(n, F.col("n_nationkey"), [quad(kind, "urn:p:broader", iri(text("urn:type:r", "n_regionkey"))), quad(kind, RDF_TYPE, iri(F.when(F.col("n_nationkey") % 2 == 0, "urn:t:Even").otherwise("urn:t:Odd")))])
    region = iri(text("urn:type:r", "r_regionkey"))
    above = explode_quads(r, F.col("r_regionkey"), [quad(region, "urn:p:broader", iri("urn:type:world"))])
    classes = explode_quads(r.limit(1), F.lit(0), [quad(iri("urn:t:Even"), "urn:p:subClassOf", iri("urn:t:Whole")), quad(iri("urn:t:Whole"), "urn:p:subClassOf", iri("urn:t:Number"))])
    return types.unionByName(above).unionByName(classes)


_TYPE_PATH = ["urn:p:usage", "urn:p:streamType"]
_LINK_RULES = (
    # Only by a type above the stated one.
    _constraint("supertype", "dataset", [*_TYPE_PATH, "urn:p:broader*"], "has_value", "urn:type:r3", kind="iri"),
    _constraint("supertype", "distribution", ["urn:p:format"], "has_value", "urn:format:1-URGENT", kind="iri"),
    _constraint("direct", "dataset", _TYPE_PATH, "in", "urn:type:n5", "urn:type:n7", "urn:type:r3", kind="iri"),
    _constraint("direct", "dataset", ["urn:p:temporal"], "max_count", n=0),
    _constraint("direct", "distribution", ["urn:p:size"], "ge", "100000"),
    _constraint("direct", "distribution", ["urn:p:statistics", "urn:p:status"], "in", "O", "F", dt="string"),
    _constraint("superclass", "dataset", _TYPE_PATH, "class", "urn:t:Number", kind="iri"),
    _constraint("superclass", "dataset", ["urn:p:temporal"], "min_count", n=1),
    _constraint("superclass", "dataset", ["urn:p:temporal"], "kind", "iri", kind="iri"),
    _constraint("superclass", "distribution", ["urn:p:size"], "datatype", XSD + "date", kind="iri"),
    _constraint("no_type_of_distributions", "dataset", ["urn:p:count"], "le", "100"),
    _constraint("no_type_of_distributions", "distribution", ["urn:p:format"], "min_of_class", "urn:t:Even", n=1, kind="iri"),
    _constraint("other_datatype", "dataset", ["urn:p:segment"], "has_value", "BUILDING", dt="string"),
)
_LINK_PROFILES = ("supertype", "direct", "superclass", "no_type_of_distributions", "other_datatype", "open")
_LINK_SQL = """
WITH d AS (SELECT c_custkey, n_regionkey, n_nationkey, c_custkey % 4 = 0 AS temporal, CAST(trunc(abs(c_acctbal)) AS BIGINT) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT 'supertype' AS profile, c_custkey FROM d WHERE n_regionkey = 3 UNION ALL SELECT 'direct', c_custkey FROM d WHERE n_nationkey IN (5, 7) AND NOT temporal UNION ALL SELECT 'superclass', c_custkey FROM d WHERE n_nationkey % 2 = 0 AND temporal UNION ALL SELECT 'no_type_of_distributions', c_custkey FROM d WHERE n <= 100 UNION ALL SELECT 'open', c_custkey FROM d),
o AS (SELECT 'supertype' AS profile, o_custkey, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT 'direct', o_custkey, o_orderkey FROM orders WHERE CAST(trunc(o_totalprice) AS BIGINT) >= 100000 AND o_orderstatus IN ('O', 'F') UNION ALL SELECT 'open', o_custkey, o_orderkey FROM orders)
SELECT m.profile, 'urn:dataset:' || c_custkey AS dataset, 'urn:dist:' || o_orderkey AS distribution FROM m LEFT JOIN o ON m.profile = o.profile AND c_custkey = o_custkey
"""


@query("c4_datasets_and_distributions", _LINK_SQL)
def c4_datasets_and_distributions(spark, sf_dir):
    shapes = spark.createDataFrame([(p, level) for p in _LINK_PROFILES for level in ("dataset", "distribution")], "profile string, level string")
    rules = spark.createDataFrame(_LINK_RULES, profiles.CONSTRAINTS)
    return profiles.link_profiles(_customers_as_datasets(spark, sf_dir), shapes, rules, _stream_taxonomy(spark, sf_dir), "urn:t:Dataset", "urn:p:distribution", RDF_TYPE, "urn:p:subClassOf")


_RULES = (("r", "Part", "name", "min_count", "1"), ("r", "Part", "brand", "in", "Brand#11|Brand#12|Brand#13"), ("r", "Part", "size", "datatype", "integer"), ("r", "Part", "note", "max_count", "0"), ("r", "Part", "brand", "pattern", "^Brand#[0-9]+$"), ("r", "Part", "name", "kind", "literal"))


@query("i14_constraint_validation", "SELECT 'r' AS profile, p_partkey AS target, property, op FROM part, LATERAL (VALUES ('brand', 'in', p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13')), ('note', 'max_count', p_size > 40), ('brand', 'pattern', NOT regexp_matches(p_brand, '^Brand#[0-9]+$')), ('size', 'datatype', p_size % 9 = 0), ('name', 'min_count', p_partkey % 50 = 0)) AS x(property, op, bad) WHERE bad")
def i14_constraint_validation(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    value = lambda n, e, t="'string'": F.struct(F.lit(n).alias("property"), F.lit("literal").alias("kind"), F.expr(t).alias("datatype"), F.expr(e).cast("string").alias("value"))
    f = p.select(F.col("p_partkey").alias("target"), F.explode(F.array(value("name", "CASE WHEN p_partkey % 50 <> 0 THEN p_name END"), value("brand", "p_brand"), value("size", "p_size", "CASE WHEN p_size % 9 = 0 THEN 'string' ELSE 'integer' END"), value("note", "CASE WHEN p_size > 40 THEN 'x' END"))).alias("x")).select("target", "x.*").filter("value is not null")
    targets = p.select(F.col("p_partkey").alias("target"), F.lit("Part").alias("class"))
    return validate.constraint_violations(targets, f, spark.createDataFrame(_RULES, "profile string, class string, property string, op string, value string"))


@query("i13_identifier_matches_name", "SELECT 's' || s_suppkey AS name, CASE s_suppkey % 4 WHEN 0 THEN 'missing_identifier' ELSE 'identifier_differs' END AS rule FROM supplier WHERE s_suppkey % 4 IN (0, 1)")
def i13_identifier_matches_name(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    ids = s.filter("s_suppkey % 4 <> 0").select(F.expr("'s' || s_suppkey").alias("name"), F.expr("CASE WHEN s_suppkey % 4 = 1 THEN 'other' ELSE 's' || s_suppkey END").alias("identifier"))
    return validate.identifier_matches_name(s.select(F.expr("'s' || s_suppkey").alias("name")), ids)


@query("i16_empty_or_rootless_dataset", "SELECT o_orderkey AS name, CASE WHEN o_orderkey % 5 = 0 THEN 'empty' ELSE 'no_root' END AS rule FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0")
def i16_empty_or_rootless_dataset(spark, sf_dir):
    q = VIEWS["q_orders"](spark, sf_dir).withColumnRenamed("element_id", "name").filter(f"name % 5 <> 0 and not (name % 7 = 0 and p = '{RDF_TYPE}')")
    return validate.rootless(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name")), q, "urn:t:Order", RDF_TYPE)


# Structure


def _corrupted(spark, sf_dir) -> DataFrame:
    """q_orders with statements added to some elements."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    g = iri(F.concat(F.lit("urn:order:"), k.cast("string")))
    lit = (F.lit("x"), F.lit("literal"))
    more = [
        F.when(k % 97 == 0, quad(g, "urn:p:extra", iri("urn:x"), iri("urn:other"))),
        F.when(k % 89 == 0, quad(g, "urn:p:extra", iri("urn:x"), lit)),
        F.when(k % 83 == 0, quad(lit, "urn:p:extra", iri("urn:x"), g)),
        F.when(k % 79 == 0, quad((F.lit("<urn:a> <urn:b> <urn:c>"), F.lit("triple")), "urn:p:extra", iri("urn:x"), g)),
        F.when(k % 73 == 0, quad(g, "urn:p:created", literal("again"))),
    ]
    added = o.select(k.alias("element_id"), F.explode(F.array(*more)).alias("q")).filter("q is not null").select("element_id", "q.*")
    clean = VIEWS["q_orders"](spark, sf_dir).filter("not (element_id % 71 = 0 and p = 'urn:p:created')")
    return clean.select("element_id", *QUAD_COLUMNS).unionByName(added)


def _elements(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("element_id"))


_BAD = "SELECT o_orderkey AS element_id, '{rule}' AS rule, '{text}' AS message FROM orders WHERE {where}"
_CASES = {
    "exactly_one_named_graph": ("not exactly one named graph", "o_orderkey % 97 = 0 OR o_orderkey % 89 = 0"),
    "literal_graph_names": ("a graph name is a literal", "o_orderkey % 89 = 0"),
    "generalized_triples": ("a generalized triple is not declared", "o_orderkey % 83 = 0"),
    "undeclared_quoted_triples": ("a quoted triple is not declared", "o_orderkey % 79 = 0"),
}
_TIMES = "SELECT o_orderkey AS element_id, 'temporal_property_once' AS rule, CASE WHEN o_orderkey % 71 = 0 THEN 'the temporal property is not present' ELSE 'the temporal property is present multiple times' END AS message FROM orders WHERE (o_orderkey % 71 = 0) <> (o_orderkey % 73 = 0) AND o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0"
_STRUCTURE = " UNION ALL ".join([_BAD.format(rule=r, text=t, where=w) for r, (t, w) in _CASES.items()] + [_TIMES])


@query("i1_i7_structure_violations", _STRUCTURE)
def i1_i7_structure_violations(spark, sf_dir):
    return validate.structure_violations(_elements(spark, sf_dir), _corrupted(spark, sf_dir), named_graph_stream=True, temporal_property="urn:p:created")


def _rule(number: int, rule: str, sql: str):
    @query(f"i{number}_{rule}", sql)
    def run(spark, sf_dir, rule=rule):
        return i1_i7_structure_violations(spark, sf_dir).filter(F.col("rule") == rule)


for _n, _r in ((2, "exactly_one_named_graph"), (5, "literal_graph_names"), (6, "generalized_triples"), (7, "undeclared_quoted_triples")):
    _rule(_n, _r, _BAD.format(rule=_r, text=_CASES[_r][0], where=_CASES[_r][1]))
_rule(3, "temporal_property_once", _TIMES)


@query("i1_no_named_graphs", "SELECT o_orderkey AS element_id, 'no_named_graphs' AS rule, 'named graphs in a triple stream' AS message FROM orders")
def i1_no_named_graphs(spark, sf_dir):
    return validate.structure_violations(_elements(spark, sf_dir), VIEWS["q_orders"](spark, sf_dir), triple_stream=True)


@query("i4_subject_node_once", with_views("q_orders") + ", n AS (SELECT o_orderkey AS element_id, count(DISTINCT q.s) AS n FROM orders LEFT JOIN q_orders q ON q.element_id = o_orderkey AND q.p = 'urn:p:quantity' GROUP BY 1) SELECT element_id, 'subject_node_once' AS rule, CASE WHEN n = 0 THEN 'the subject node is not present' ELSE 'the subject node is present multiple times' END AS message FROM n WHERE n <> 1")
def i4_subject_node_once(spark, sf_dir):
    q = VIEWS["q_orders"](spark, sf_dir)
    nodes = validate.subject_nodes(q, [("target_subjects_of", "urn:p:quantity")])
    return validate.structure_violations(_elements(spark, sf_dir), q, named_graph_stream=True, subjects=nodes).filter("rule = 'subject_node_once'")


# Archives


def _entries(spark, sf_dir) -> DataFrame:
    """Entries of one archive for each status, numbered by the orders that have lines."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return files.archive_entries(o, F.col("o_orderkey"), F.concat(F.lit("c"), (F.col("o_orderkey") / 1000).cast("int").cast("string")))


_ENTRIES = "WITH n AS (SELECT DISTINCT o_orderkey AS number, 'c' || CAST(o_orderkey // 1000 AS STRING) AS archive FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), f AS (SELECT *, lead(number) OVER (PARTITION BY archive ORDER BY number) AS following FROM n), gaps AS (SELECT archive, number AS after, number + 1 AS missing FROM f WHERE following <> number + 1)"


@query("e4_sequence_gaps", _ENTRIES + " SELECT * FROM gaps")
def e4_sequence_gaps(spark, sf_dir):
    return validate.sequence_gaps(_entries(spark, sf_dir))


@query("i10_archive_sequence", _ENTRIES + " SELECT archive, count(*) AS gaps FROM gaps GROUP BY archive")
def i10_archive_sequence(spark, sf_dir):
    return validate.sequence_gaps(_entries(spark, sf_dir)).groupBy("archive").agg(F.count("*").alias("gaps"))


@query("f3_cap_violations", _ENTRIES + " SELECT * FROM gaps ORDER BY archive, after LIMIT 10")
def f3_cap_violations(spark, sf_dir):
    return validate.cap(validate.sequence_gaps(_entries(spark, sf_dir)), ["archive", "after"])


@query("i9_archive_count", _ENTRIES + ", c AS (SELECT archive, count(*) AS n FROM n GROUP BY archive) SELECT archive, 'archive_count' AS rule, 'expected 1000 files, found ' || n AS message FROM c WHERE n <> 1000 UNION ALL SELECT 'none', 'archive_count', 'the archive is empty'")
def i9_archive_count(spark, sf_dir):
    entries = _entries(spark, sf_dir)
    declared = entries.select("archive").distinct().unionByName(spark.createDataFrame([("none",)], "archive string")).withColumn("element_count", F.lit(1000))
    return validate.archive_count(entries, declared)


@query("i11_archive_names", _ENTRIES + ", m AS (SELECT archive, number, lpad(CAST(number AS STRING), 10, '0') || '.ttl' AS path FROM n), broken AS (SELECT archive, CASE number % 100 WHEN 7 THEN path || 'x' WHEN 8 THEN substr(path, 2) ELSE path END AS path FROM m) SELECT archive, path FROM broken WHERE NOT regexp_matches(path, '(^|/)[0-9]{10}\\.ttl$')")
def i11_archive_names(spark, sf_dir):
    entries = _entries(spark, sf_dir).withColumn("path", F.expr("CASE number % 100 WHEN 7 THEN path || 'x' WHEN 8 THEN substr(path, 2) ELSE path END"))
    return validate.archive_names(entries, triple_stream=True)


@query("k5_extra_validation", with_views("q_events") + ", g AS (SELECT * REPLACE (CASE WHEN element_id % 50 = 0 THEN 'urn:g' END AS g) FROM q_events) SELECT element_id, 'no_named_graphs' AS rule, 'named graphs in a triple stream' AS message FROM g WHERE g IS NOT NULL GROUP BY element_id UNION ALL SELECT element_id, 'cheap', 'fewer than 1000 cents' FROM q_events WHERE p = 'urn:p:cents' AND CAST(o AS BIGINT) < 1000")
def k5_extra_validation(spark, sf_dir):
    """The structure rules of a triple stream together with a check of one's own."""
    q = VIEWS["q_events"](spark, sf_dir)
    marked = q.withColumn("g", F.when(F.col("element_id") % 50 == 0, "urn:g")).withColumn("g_kind", F.when(F.col("g").isNotNull(), "iri"))
    elements = table(spark, sf_dir, "events").select(F.col("event_id").alias("element_id"))
    own = q.filter((F.col("p") == "urn:p:cents") & (F.col("o").cast("long") < 1000)).select("element_id", F.lit("cheap").alias("rule"), F.lit("fewer than 1000 cents").alias("message"))
    return validate.combined([lambda: validate.structure_violations(elements, marked, triple_stream=True), lambda: own])


# Nanopublications: an order, whose key is its customer


def nanopubs(spark, sf_dir) -> DataFrame:
    """Quads of nanopublications: head, assertion and pubinfo graphs."""
    o = table(spark, sf_dir, "orders")
    c = F.col
    k = c("o_orderkey").cast("string")
    np = iri(F.concat(F.lit("urn:np:"), k))
    graph = lambda x: iri(F.concat(F.lit("urn:np:"), k, F.lit(f"#{x}")))
    step = iri(F.concat(F.lit("urn:step:"), k))
    task = F.when(c("o_orderkey") % 5 != 0, F.concat(F.lit(ROOT + "v/"), F.expr("CAST(o_orderkey % 3 AS STRING) || '.' || CAST(o_orderkey % 4 AS STRING) || '.0'"), F.lit("/tasks/t"), F.expr("CAST(o_custkey % 6 AS STRING)")))
    profile = F.when(c("o_orderkey") % 4 != 0, F.concat(F.lit(ROOT + "v/dev/profiles/"), F.lower(F.substring("o_orderpriority", 3, 3)), F.lit("-x")))
    return explode_quads(
        o,
        c("o_orderkey"),
        [
            quad(np, "urn:np:hasAssertion", graph("a"), graph("h")),
            quad(np, "urn:np:hasPublicationInfo", graph("i"), graph("h")),
            F.when(c("o_orderkey") % 7 != 0, quad(iri("urn:x"), "urn:p:protocol", step, graph("a"))),
            quad(step, "urn:p:usesProfile", iri(profile), graph("a")),
            quad(step, "urn:p:usesTask", iri(task), graph("a")),
            F.when(c("o_orderkey") % 3 != 0, quad(np, "urn:p:created", literal(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")), graph("i"))),
            F.when(c("o_orderkey") % 2 == 0, quad(np, "urn:p:hasType", iri("urn:t:PerformedBenchmark"), graph("i"))),
        ],
    )


_NP = f"""n AS (SELECT o_orderkey AS k, o_custkey AS key, o_orderstatus AS status, o_orderpriority AS priority, 'urn:np:' || o_orderkey AS np,
CASE WHEN o_orderkey % 5 <> 0 THEN '{ROOT}v/' || (o_orderkey % 3) || '.' || (o_orderkey % 4) || '.0/tasks/t' || (o_custkey % 6) END AS task,
CASE WHEN o_orderkey % 4 <> 0 THEN '{ROOT}v/dev/profiles/' || lower(substr(o_orderpriority, 3, 3)) || '-x' END AS profile,
CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS date FROM orders)"""


def _index(q):
    return results.nanopub_index(q, "urn:np:hasAssertion", "urn:np:hasPublicationInfo")


@query("c5_nanopub_index", f"WITH {_NP} SELECT np, np || '#h' AS head, np || '#a' AS assertion, np || '#i' AS pubinfo FROM n")
def c5_nanopub_index(spark, sf_dir):
    return _index(nanopubs(spark, sf_dir))


def _results(spark, sf_dir):
    q = nanopubs(spark, sf_dir)
    return results.benchmark_results(q, _index(q), "urn:p:protocol", "urn:p:usesProfile", "urn:p:usesTask", "urn:p:created")


@query("c6_benchmark_results", f"WITH {_NP} SELECT np, profile, task, date FROM n WHERE k % 7 <> 0")
def c6_benchmark_results(spark, sf_dir):
    return _results(spark, sf_dir)


@query("c7_results_for_task", f"WITH {_NP} SELECT np, task FROM n WHERE k % 7 <> 0 AND k % 5 <> 0 AND key % 6 = 2 AND (k % 3 < 1 OR (k % 3 = 1 AND k % 4 <= 2))")
def c7_results_for_task(spark, sf_dir):
    return results.results_for_task(_results(spark, sf_dir).select("np", "task"), "t2", "1.2.0")


@query("f4_results_order", f"WITH {_NP} SELECT np, task, date FROM n WHERE k % 7 <> 0")
def f4_results_order(spark, sf_dir):
    return results.results_order(_results(spark, sf_dir)).select("np", "task", "date")


@query("l2_benchmark_result_table", f"WITH {_NP} SELECT CASE WHEN task IS NULL THEN 'Unknown' ELSE 't' || (key % 6) || ' (' || (k % 3) || '.' || (k % 4) || '.0)' END AS task, CASE WHEN profile IS NULL THEN 'Unknown' ELSE lower(substr(priority, 3, 3)) || '-x (dev)' END AS profile, coalesce(split_part(date, 'T', 1), 'Unknown') AS date, CASE WHEN task IS NULL THEN '-' ELSE '#' || np END AS details, np AS source FROM n WHERE k % 7 <> 0")
def l2_benchmark_result_table(spark, sf_dir):
    from tessera.functions.names import date_part, parse_purl
    from tessera.functions.terms import last_segment

    r = _results(spark, sf_dir).withColumns({"t": parse_purl(F.col("task")), "p": parse_purl(F.col("profile"))})
    shown = lambda x: F.when(F.col(x).isNull(), "Unknown").otherwise(F.concat(F.col(f"{x}.id"), F.lit(" ("), F.col(f"{x}.version"), F.lit(")")))
    details = F.when(F.col("t").isNull(), "-").otherwise(F.concat(F.lit("#"), last_segment(F.col("np"))))
    rows = r.select(shown("t").alias("task"), shown("p").alias("profile"), F.coalesce(date_part(F.col("date")), F.lit("Unknown")).alias("date"), details.alias("details"), F.col("np").alias("source"))
    return rows.orderBy("task", "date", "source")


def _typed(spark, sf_dir, q):
    keys = table(spark, sf_dir, "orders").select(F.expr("'urn:np:' || o_orderkey").alias("np"), F.col("o_custkey").alias("pubkey"))
    types = q.filter("p = 'urn:p:hasType'").select("g", "o")
    return results.typed_nanopubs(_index(q), keys, types, "urn:t:PerformedBenchmark")


@query("c8_nanopubs_for_category", f"WITH {_NP} SELECT np, key AS pubkey, np || '#a' AS assertion FROM n WHERE k % 2 = 0")
def c8_nanopubs_for_category(spark, sf_dir):
    return _typed(spark, sf_dir, nanopubs(spark, sf_dir))


@query("c9_category_exists", f"WITH {_NP} SELECT np, key AS pubkey FROM n WHERE k % 2 = 0 AND (regexp_replace(task, '^.*/([a-z0-9]+).*', '\\1') = 't1' OR regexp_replace(profile, '^.*/([a-z0-9]+).*', '\\1') = 't1')")
def c9_category_exists(spark, sf_dir):
    q = nanopubs(spark, sf_dir)
    uses = q.filter(F.col("p").isin("urn:p:usesTask", "urn:p:usesProfile")).select("g", "o")
    return results.in_category(_typed(spark, sf_dir, q), uses, "t1").select("np", "pubkey")


def _marks(spark, sf_dir, kind: str) -> DataFrame:
    """(np, pubkey): superseded by a later order of the customer and priority; retracted by an order of status F."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    np = F.expr("'urn:np:' || o_orderkey").alias("np")
    if kind == "retracts":
        return o.filter("o_orderstatus = 'F'").select(np, F.col("o_custkey").alias("pubkey"))
    last = o.groupBy(F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("pr")).agg(F.max("o_orderkey").alias("last"))
    return o.join(last, (F.col("o_custkey") == F.col("c")) & (F.col("o_orderpriority") == F.col("pr"))).filter("o_orderkey < last").select(np, F.col("o_custkey").alias("pubkey"))


_SUPERSEDED = "EXISTS (SELECT 1 FROM n m WHERE m.key = n.key AND m.priority = n.priority AND m.k > n.k)"


@query("c10_drop_superseded", f"WITH {_NP} SELECT np, key AS pubkey FROM n WHERE k % 2 = 0 AND NOT {_SUPERSEDED}")
def c10_drop_superseded(spark, sf_dir):
    return results.drop_marked(_typed(spark, sf_dir, nanopubs(spark, sf_dir)), _marks(spark, sf_dir, "supersedes")).select("np", "pubkey")


@query("c11_drop_retracted", f"WITH {_NP} SELECT np, key AS pubkey FROM n WHERE k % 2 = 0 AND status <> 'F'")
def c11_drop_retracted(spark, sf_dir):
    return results.drop_marked(_typed(spark, sf_dir, nanopubs(spark, sf_dir)), _marks(spark, sf_dir, "retracts")).select("np", "pubkey")


@query("c8_c11_current_results", f"WITH {_NP} SELECT np, key AS pubkey FROM n WHERE k % 2 = 0 AND regexp_replace(task, '^.*/([a-z0-9]+).*', '\\1') = 't1' AND status <> 'F' AND NOT {_SUPERSEDED}")
def c8_c11_current_results(spark, sf_dir):
    q = nanopubs(spark, sf_dir)
    found = results.in_category(_typed(spark, sf_dir, q), q.filter("p = 'urn:p:usesTask'").select("g", "o"), "t1")
    for kind in ("supersedes", "retracts"):
        found = results.drop_marked(found, _marks(spark, sf_dir, kind))
    return found.select("np", "pubkey")


# Links, labels, vocabularies, versions


@query("c15_catalog_links", "SELECT 'urn:main' AS s, CASE WHEN p_partkey % 2 = 0 THEN 'urn:p:dataset' ELSE 'urn:p:resource' END AS p, 'urn:d:' || p_partkey AS o FROM part UNION ALL SELECT 'urn:d:' || p_partkey, 'urn:p:inCatalog', 'urn:main' FROM part UNION ALL SELECT 'n' || n_nationkey, 'urn:p:inSeries', 'r' || n_regionkey FROM nation")
def c15_catalog_links(spark, sf_dir):
    members = table(spark, sf_dir, "part").select("p_partkey", F.expr("'urn:d:' || p_partkey").alias("member"))
    links = graphs.catalog_links("urn:main", members, F.when(F.col("p_partkey") % 2 == 0, "urn:p:dataset").otherwise("urn:p:resource"), "urn:p:inCatalog")
    series = table(spark, sf_dir, "nation").select(F.expr("'r' || n_regionkey").alias("s"), F.lit("urn:p:member").alias("p"), F.expr("'n' || n_nationkey").alias("o"))
    return links.unionByName(graphs.inverse_statements(series, "urn:p:member", "urn:p:inSeries"))


def labels(spark, sf_dir) -> DataFrame:
    s = iri(F.expr("'urn:x/c' || c_custkey"))
    n = F.col("c_name")
    k = F.col("c_custkey")
    return explode_quads(
        table(spark, sf_dir, "customer"),
        k,
        [
            F.when(k % 4 == 0, quad(s, "urn:p:pref", literal(F.concat(n, F.lit(" de")), lang=F.lit("de")))),
            F.when(k % 8 == 0, quad(s, "urn:p:pref", literal(F.concat(n, F.lit(" en")), lang=F.lit("en")))),
            F.when(k % 4 <= 1, quad(s, "urn:p:label", literal(n))),
            F.when(k % 4 <= 2, quad(s, "urn:p:other", literal(n))),
        ],
    )


@query("c16_label_lookup", "SELECT 'urn:x/c' || c_custkey AS s, CASE WHEN c_custkey % 8 = 0 THEN c_name || ' en' WHEN c_custkey % 4 = 0 THEN c_name || ' de' WHEN c_custkey % 4 = 1 THEN c_name ELSE 'c' || c_custkey END AS label FROM customer")
def c16_label_lookup(spark, sf_dir):
    subjects = table(spark, sf_dir, "customer").select(F.expr("'urn:x/c' || c_custkey").alias("s"))
    return graphs.label_lookup(subjects, labels(spark, sf_dir), "urn:p:pref", "urn:p:label")


@query("c19_vocabulary_map", "SELECT 'urn:x/c' || c_custkey AS s, p, count(*) AS n FROM customer, LATERAL (VALUES ('" + RDF_TYPE + "', true), ('urn:s:free', true), ('urn:s:name', c_custkey % 4 <= 1), ('" + RDF_TYPE + "', c_custkey % 4 <= 1), ('urn:s:alt', c_custkey % 4 = 0), ('urn:s:alt', c_custkey % 8 = 0)) AS x(p, there) WHERE there GROUP BY ALL")
def c19_vocabulary_map(spark, sf_dir):
    g = labels(spark, sf_dir)
    typed = explode_quads(table(spark, sf_dir, "customer"), F.col("c_custkey"), [quad(iri(F.expr("'urn:x/c' || c_custkey")), RDF_TYPE, iri("urn:d:Dataset"))])
    types = spark.createDataFrame([("urn:d:Dataset", "urn:s:Dataset")], "old string, new string")
    properties = spark.createDataFrame([("urn:p:label", "urn:s:name", False), ("urn:p:pref", "urn:s:alt", True)], "old string, new string, as_text boolean")
    out = graphs.vocabulary_map(g.unionByName(typed), types, properties, RDF_TYPE, "urn:s:Dataset", "urn:s:free", "urn:p:label", "urn:s:Person")
    return out.groupBy("s", "p").agg(F.count("*").alias("n"))


def _releases(spark, sf_dir) -> DataFrame:
    """Releases with a file. Parts of one tag and place, and suppliers of one file and place, are the same release, so each comes to the join once."""
    tags = table(spark, sf_dir, "part").selectExpr("p_size", "p_partkey % 3 AS minor", "p_partkey % 100 AS place").distinct()
    names = table(spark, sf_dir, "supplier").selectExpr("s_suppkey % 20 AS file", "s_suppkey % 100 AS place").distinct()
    rows = tags.join(names, "place").select("p_size", "minor", "file").distinct()
    return rows.select(F.expr("'v' || p_size || '.' || minor || '.0'").alias("tag_name"), F.array(F.struct(F.expr("'f' || file || '.ttl'").alias("name"))).alias("assets"))


@query("c22_latest_previous_version", "WITH r AS (SELECT s_suppkey % 20 AS name, p_size AS ma, p_partkey % 3 AS mi FROM part JOIN supplier ON p_partkey % 100 = s_suppkey % 100) SELECT 'f' || name AS name, arg_max(ma || '.' || mi || '.0', ma * 10 + mi) AS version FROM r GROUP BY name")
def c22_latest_previous_version(spark, sf_dir):
    wanted = table(spark, sf_dir, "supplier").select(F.expr("'f' || (s_suppkey % 20)").alias("name"), F.expr("'f' || (s_suppkey % 20) || '.ttl'").alias("file_name")).distinct()
    return results.previous_versions(_releases(spark, sf_dir), wanted)


def _meta(spark, sf_dir, generated: bool) -> DataFrame:
    p = table(spark, sf_dir, "part")
    s = iri(F.expr("'urn:tmp:' || p_partkey"))
    u = (F.expr("'u' || p_partkey"), F.lit("bnode"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    rows = [quad(s, "urn:p:elements", literal(F.col("p_size"), "integer")), quad(s, "urn:p:usage", iri("urn:t:full"))] if generated else [quad(s, "urn:p:title", literal(F.col("p_name"))), quad(s, "urn:p:usage", u), quad(u, "urn:p:streamType", iri("urn:t:x"))]
    return explode_quads(p, F.col("p_partkey"), rows)


@query("g8_merge_dataset_metadata", "SELECT 'urn:d:' || p_partkey AS s, p, o FROM part, LATERAL (VALUES ('urn:p:elements', CAST(p_size AS STRING)), ('urn:p:usage', 'urn:t:full'), ('urn:p:title', p_name)) AS x(p, o)")
def g8_merge_dataset_metadata(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    roots = p.select(F.expr("'urn:tmp:' || p_partkey").alias("s"))
    renames = p.select(F.expr("'urn:tmp:' || p_partkey").alias("old"), F.expr("'urn:d:' || p_partkey").alias("new"))
    return graphs.merge_dataset_metadata(_meta(spark, sf_dir, False), _meta(spark, sf_dir, True), "urn:p:usage", roots, renames).select("s", "p", "o")


@query("g9_version_metadata", "SELECT 'urn:d:' || p_partkey AS s, p, o FROM part, LATERAL (VALUES ('urn:p:version', '1.0.0'), ('urn:p:landingPage', 'urn:d:' || p_partkey), ('urn:p:modified', '2024-01-01'), ('urn:p:distribution', 'urn:d:' || p_partkey || '#jelly-1k')) AS x(p, o) UNION ALL SELECT 'urn:d:' || p_partkey || '#jelly-1k', 'urn:p:downloadURL', 'urn:d:' || p_partkey || '/files/jelly_1K.gz' FROM part")
def g9_version_metadata(spark, sf_dir):
    from tessera.functions.names import local_id

    d = table(spark, sf_dir, "part").select(F.expr("'urn:d:' || p_partkey").alias("dataset"), F.lit("1.0.0").alias("version"), F.lit("jelly_1K.gz").alias("file_name"))
    return graphs.version_statements(d, d.withColumn("local_id", local_id(F.col("file_name"))), "2024-01-01")


@query("g11_package_collection", f"WITH m AS (SELECT '{ROOT}v/1.0.0/tasks/s' || s_suppkey AS t FROM supplier) SELECT s, p, o FROM m, LATERAL (VALUES (t, 'urn:p:version', '1.0.0'), (t, 'urn:p:inCategory', 'urn:cat'), ('urn:cat', 'urn:p:has', t), (t, 'urn:p:inCatalog', 'urn:main')) AS x(s, p, o)")
def g11_package_collection(spark, sf_dir):
    m = table(spark, sf_dir, "supplier").select(F.expr("'s' || s_suppkey").alias("name"), F.expr("'s' || s_suppkey").alias("identifier"))
    return graphs.package_members(m, "1.0.0", "urn:cat", "urn:main", "tasks")


@query("l1_dataset_overview", f"SELECT p_name || p_partkey AS name, {_ELEMENT_TYPE} AS element_type, format('{{:,}}', p_size * 1000) AS elements, CASE WHEN p_partkey % 3 = 0 THEN '0' ELSE format('{{:,}}', p_size * 7000) END AS statements, p_partkey % 17 = 0 AS uses_star FROM part")
def l1_dataset_overview(spark, sf_dir):
    i = table(spark, sf_dir, "part").select(F.expr("p_name || p_partkey").alias("name"), F.expr(_ELEMENT_TYPE).alias("element_type"), F.expr("p_size * 1000").alias("element_count"), F.expr("CASE WHEN p_partkey % 3 <> 0 THEN p_size * 7000 END").alias("statement_count"), F.expr("p_partkey % 17 = 0").alias("uses_star"))
    return reports.dataset_overview(i)


@query("f5_by_name_by_size", _DISTS + " SELECT dataset, size, dist_type FROM d")
def f5_by_name_by_size(spark, sf_dir):
    return distributions(spark, sf_dir).select("dataset", "size", "dist_type").orderBy("dataset", "size", "dist_type")


