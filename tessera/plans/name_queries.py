"""Queries of the scalar functions, over strings derived from the tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import names, terms
from tessera.sources.views import VIEWS, table, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}

_VERSION = "CASE p_partkey % 5 WHEN 0 THEN 'dev' WHEN 1 THEN p_size || '.' || (p_partkey % 13) || '.' || (p_partkey % 7) WHEN 2 THEN p_size || '.10.' || (p_partkey % 3) || '-rc1' WHEN 3 THEN 'abc' ELSE '1.' || p_size || '.0' END"
_ID = "'p-' || p_partkey"
_V = "CASE WHEN p_partkey % 4 = 0 THEN 'dev' ELSE p_size || '.0.1' END"
_KIND = "CASE p_partkey % 7 WHEN 0 THEN 'categories' WHEN 1 THEN 'tasks' WHEN 2 THEN 'profiles' WHEN 3 THEN 'datasets' WHEN 4 THEN 'schema' WHEN 5 THEN 'main' ELSE 'none' END"
_ROOT = names.ROOT
#: The short names of sizes, and the steps of byte sizes up to those of the largest BIGINT.
SIZE_NAMES = "WHEN 10000 THEN '10K' WHEN 100000 THEN '100K' WHEN 1000000 THEN '1M' WHEN 10000000 THEN '10M' WHEN 100000000 THEN '100M' WHEN 1000000000 THEN '1B'"


def human_sql(column: str) -> str:
    text = [f"printf('%.1f {u}', round({column} / {1024**k}.0 * 10) / 10)" for k, u in enumerate(("B", "KB", "MB", "GB", "TB", "PB", "EB"))]
    return "CASE " + " ".join(f"WHEN {column} < {1024 ** (k + 1)} THEN {t}" for k, t in enumerate(text[:-1])) + f" ELSE CASE WHEN {column} IS NOT NULL THEN {text[-1]} END END"


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


def part(spark, sf_dir):
    return table(spark, sf_dir, "part")


@query(
    "h1_semver_key",
    f"""WITH v AS (SELECT p_partkey, {_VERSION} AS version FROM part), m AS (SELECT *, regexp_extract(version, '^([0-9]+)\\.([0-9]+)\\.([0-9]+)(.*)$', ['a', 'b', 'c', 'd']) AS x, regexp_matches(version, '^[0-9]+\\.[0-9]+\\.[0-9]+.*$') AS ok FROM v)
SELECT p_partkey, version, version = 'dev' AS is_dev, coalesce(TRY_CAST(x.a AS INTEGER), 0) AS major, coalesce(TRY_CAST(x.b AS INTEGER), 0) AS minor, coalesce(TRY_CAST(x.c AS INTEGER), 0) AS patch, CASE WHEN ok THEN x.d ELSE '' END AS suffix
FROM m WHERE ok OR version = 'dev'""",
)
def h1_semver_key(spark, sf_dir):
    v = part(spark, sf_dir).select("p_partkey", F.expr(_VERSION).alias("version")).withColumn("k", names.semver_key(F.col("version")))
    return v.filter("k is not null").select("p_partkey", "version", "k.*")


@query(
    "h1_semver_order",
    f"""WITH v AS (SELECT DISTINCT {_VERSION} AS version FROM part), m AS (SELECT *, regexp_extract(version, '^([0-9]+)\\.([0-9]+)\\.([0-9]+)(.*)$', ['a', 'b', 'c', 'd']) AS x FROM v WHERE version = 'dev' OR regexp_matches(version, '^[0-9]+\\.[0-9]+\\.[0-9]+.*$'))
SELECT version, row_number() OVER (ORDER BY version = 'dev', CAST(nullif(x.a, '') AS INTEGER), CAST(nullif(x.b, '') AS INTEGER), CAST(nullif(x.c, '') AS INTEGER), x.d) AS place FROM m""",
)
def h1_semver_order(spark, sf_dir):
    """The window holds different versions only, not rows."""
    from pyspark.sql import Window as W

    v = part(spark, sf_dir).select(F.expr(_VERSION).alias("version")).distinct().withColumn("k", names.semver_key(F.col("version"))).filter("k is not null")
    return v.select("version", F.row_number().over(W.orderBy("k")).cast("long").alias("place"))


_PURL = f"""CASE {_KIND} WHEN 'categories' THEN '{_ROOT}v/' || ({_V}) || '/categories/' || {_ID} || '/sub' WHEN 'tasks' THEN '{_ROOT}v/' || ({_V}) || '/tasks/' || {_ID} || '/sub'
WHEN 'profiles' THEN '{_ROOT}v/' || ({_V}) || '/profiles/' || {_ID} || '/sub' WHEN 'datasets' THEN '{_ROOT}datasets/' || {_ID} || '/' || ({_V}) || '/sub' WHEN 'schema' THEN '{_ROOT}schema/' || {_ID} || '/' || ({_V})
WHEN 'main' THEN CASE WHEN ({_V}) = 'dev' THEN '{_ROOT}' ELSE '{_ROOT}v/' || ({_V}) END END"""


@query("h2_make_purl", f"SELECT p_partkey, {_PURL} AS url FROM part")
def h2_make_purl(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", names.make_purl(F.expr(_KIND), F.expr(_ID), F.expr(_V), F.lit("sub")).alias("url"))


@query(
    "h3_parse_purl",
    f"SELECT p_partkey, {_KIND} AS kind, CASE WHEN {_KIND} = 'main' THEN 'suite' ELSE {_ID} END AS id, {_V} AS version, true AS with_fragment_too FROM part WHERE {_KIND} <> 'none'",
)
def h3_parse_purl(spark, sf_dir):
    url = names.make_purl(F.expr(_KIND), F.expr(_ID), F.expr(_V))
    rows = part(spark, sf_dir).select("p_partkey", url.alias("url")).withColumn("p", names.parse_purl(F.col("url")))
    marked = names.parse_purl(F.concat("url", F.lit("#x")))
    whole = F.when(F.col("url") == names.ROOT, True).otherwise(marked == F.col("p"))
    return rows.filter("p is not null").select("p_partkey", "p.*", whole.alias("with_fragment_too"))


@query("h4_human_size", f"SELECT o_orderkey, CASE o_orderkey {SIZE_NAMES} ELSE CAST(o_orderkey AS STRING) END AS name, CASE o_orderkey {SIZE_NAMES} ELSE 'Full' END AS full_name FROM orders")
def h4_human_size(spark, sf_dir):
    c = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(c, names.human_size(c).alias("name"), names.human_size(c, True).alias("full_name"))


_BYTES = "CAST(p_partkey AS BIGINT) * p_partkey * p_size * 37"


@query("h5_human_bytes", f"WITH b AS (SELECT p_partkey, {_BYTES} AS n FROM part) SELECT p_partkey, {human_sql('n')} AS size FROM b")
def h5_human_bytes(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", names.human_bytes(F.expr(_BYTES)).alias("size"))


@query("h6_ascii_control_count", r"WITH t AS (SELECT doc_id, repeat(chr(1) || chr(11) || chr(19) || chr(20) || chr(9), CAST(doc_id % 5 AS BIGINT)) || text AS t FROM documents) SELECT doc_id, length(t) - length(regexp_replace(t, '[\x00-\x08\x0B\x0C\x0E-\x13]', '', 'g')) AS counted, length(t) - length(regexp_replace(t, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) AS intended FROM t")
def h6_ascii_control_count(spark, sf_dir):
    t = F.concat(F.repeat(F.lit("\x01\x0b\x13\x14\t"), (F.col("doc_id") % 5).cast("int")), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", terms.ascii_control_count(t).alias("counted"), terms.ascii_control_count(t, intended=True).alias("intended"))


@query("h7_group_digits", "SELECT o_orderkey, format('{:,}', o_orderkey * 991) AS grouped FROM orders")
def h7_group_digits(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", names.group_digits(F.col("o_orderkey") * 991).alias("grouped"))


_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


@query("h8_format_double", f"SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE format('{{:,}}', {_CENTS} // 4) || CASE {_CENTS} % 4 WHEN 0 THEN '.00' WHEN 1 THEN '.25' WHEN 2 THEN '.50' ELSE '.75' END END AS shown FROM part")
def h8_format_double(spark, sf_dir):
    text = F.expr(f"CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE CAST({_CENTS} / 4.0D AS STRING) END")
    return part(spark, sf_dir).select("p_partkey", names.format_double(text).alias("shown"))


@query("h9_readable_stream_name", "SELECT p_partkey, lower(trim(regexp_replace(p_type || 'StreamOf2' || p_brand, '([A-Z0-9])', ' \\1', 'g'))) AS readable FROM part")
def h9_readable_stream_name(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", names.readable_stream_name(F.expr("p_type || 'StreamOf2' || p_brand")).alias("readable"))


@query("h10_local_id", "SELECT s_suppkey, lower(replace(split_part(s_name || '_Jelly_10K.nt.gz', '.', 1), '_', '-')) AS local_id FROM supplier")
def h10_local_id(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.local_id(F.expr("s_name || '_Jelly_10K.nt.gz'")).alias("local_id"))


@query("h11_iri_parts", "SELECT c_custkey, CAST(c_custkey AS STRING) || '#f' || c_nationkey AS last_segment, 'f' || c_nationkey AS fragment, 'http://x.example/customer/' || c_custkey || '#' AS namespace FROM customer")
def h11_iri_parts(spark, sf_dir):
    iri = F.expr("'http://x.example/customer/' || c_custkey || '#f' || c_nationkey")
    return table(spark, sf_dir, "customer").select("c_custkey", terms.last_segment(iri).alias("last_segment"), terms.fragment(iri).alias("fragment"), terms.iri_namespace(iri).alias("namespace"))


@query("h12_date_part", "SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events")
def h12_date_part(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", names.date_part(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("day"))


@query("h18_doc_weight", "WITH t AS (SELECT count(*) AS n FROM orders) SELECT o_orderkey, CAST(CASE WHEN o_orderkey = n THEN 0 ELSE length(CAST(n AS STRING)) - length(CAST(o_orderkey AS STRING)) + 1 END AS INTEGER) AS weight, CAST(3 * CASE WHEN o_orderkey = n THEN 0 ELSE length(CAST(n AS STRING)) - length(CAST(o_orderkey AS STRING)) + 1 END + o_orderkey % 3 AS INTEGER) AS distribution_weight FROM orders, t")
def h18_doc_weight(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey").crossJoin(F.broadcast(o.agg(F.count("*").alias("n"))))  # of one row
    kind = F.when(F.col("o_orderkey") % 3 == 0, "flat").when(F.col("o_orderkey") % 3 == 1, "stream").otherwise("jelly")
    return rows.select("o_orderkey", names.doc_weight(F.col("o_orderkey"), F.col("n")).cast("int").alias("weight"), names.distribution_weight(F.col("o_orderkey"), F.col("n"), kind).cast("int").alias("distribution_weight"))


@query("h20_category_of_iri", r"SELECT p_partkey, regexp_replace('http://x.example/' || replace(p_name, ' ', '/') || '/' || p_size || 'a-b', '^.*/([a-z0-9]+).*', '\1') AS category FROM part")
def h20_category_of_iri(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", terms.category_of(F.expr("'http://x.example/' || replace(p_name, ' ', '/') || '/' || p_size || 'a-b'")).alias("category"))


def _nt_sql() -> str:
    from tessera.plans.stat_queries import LINE

    return with_views("q_docs") + f" SELECT element_id, md5({LINE}) AS line_md5 FROM q_docs"


@query("h21_nt_statement", _nt_sql())
def h21_nt_statement(spark, sf_dir):
    return VIEWS["q_docs"](spark, sf_dir).select("element_id", F.md5(terms.nt_statement()).alias("line_md5"))


@query("h22_distribution_title", f"SELECT o_orderkey, CASE WHEN o_orderkey = 14999 THEN 'Full' ELSE CASE o_orderkey {SIZE_NAMES} ELSE CAST(o_orderkey AS STRING) END || ' elements' END || CASE o_orderkey % 3 WHEN 0 THEN ' flat' WHEN 1 THEN ' stream' ELSE ' Jelly' END || ' distribution' AS title FROM orders")
def h22_distribution_title(spark, sf_dir):
    kind = F.when(F.col("o_orderkey") % 3 == 0, "flat").when(F.col("o_orderkey") % 3 == 1, "stream").otherwise("jelly")
    return table(spark, sf_dir, "orders").select("o_orderkey", names.distribution_title(F.col("o_orderkey"), F.lit(14999), kind).alias("title"))


@query("a2_element_id_from_name", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderkey END AS element_id FROM orders")
def a2_element_id_from_name(spark, sf_dir):
    path = F.expr("'a/' || lpad(CAST(o_orderkey AS STRING), 10, '0') || CASE o_orderkey % 3 WHEN 0 THEN '.ttl' WHEN 1 THEN '.trig' ELSE '.txt' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", names.element_id_of(path).alias("element_id"))


@query("a6_element_path_layout", "WITH n AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS STRING), 10, '0') AS d FROM orders) SELECT o_orderkey, substr(d, 5, 3) || '/' || d || '.ttl' AS one_level, substr(d, 2, 3) || '/' || substr(d, 5, 3) || '/' || d || '.ttl' AS two_levels FROM n")
def a6_element_path_layout(spark, sf_dir):
    c = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(c, names.element_path(c, 1).alias("one_level"), names.element_path(c, 2).alias("two_levels"))


@query("a17_stable_bnode_ids", with_views("q_orders") + " SELECT element_id, 'b' || md5(element_id || chr(1) || s) AS id FROM q_orders WHERE s_kind = 'bnode'")
def a17_stable_bnode_ids(spark, sf_dir):
    return VIEWS["q_orders"](spark, sf_dir).filter("s_kind = 'bnode'").select("element_id", terms.stable_bnode_id(F.col("element_id").cast("string"), F.col("s")).alias("id"))


@query("a18_name_uuid", "WITH h AS (SELECT p_partkey, md5(p_name) AS h FROM part) SELECT p_partkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', CAST((instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1 AS BIGINT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h")
def a18_name_uuid(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", terms.name_uuid(F.col("p_name")).alias("uuid"))


@query("b5_literal_class", with_views("q_docs", "q_events") + """, u AS (SELECT * FROM q_docs UNION ALL SELECT * FROM q_events) SELECT CASE WHEN coalesce(o_lang, '') <> '' THEN 'language' WHEN coalesce(o_dt, 'http://www.w3.org/2001/XMLSchema#string') = 'http://www.w3.org/2001/XMLSchema#string' THEN 'simple' ELSE 'datatype' END AS class, count(*) AS n FROM u WHERE o_kind = 'literal' GROUP BY 1""")
def b5_literal_class(spark, sf_dir):
    u = VIEWS["q_docs"](spark, sf_dir).unionByName(VIEWS["q_events"](spark, sf_dir))
    return u.select(terms.literal_class(F.col("o_kind"), F.col("o_dt"), F.col("o_lang")).alias("class")).filter("class is not null").groupBy("class").agg(F.count("*").alias("n"))


@query("b11_format_by_stream_type", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'nt.gz' ELSE 'nq.gz' END WHEN 1 THEN 'tar.gz' ELSE 'jelly.gz' END AS extension, CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'application/n-triples' ELSE 'application/n-quads' END WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'text/turtle' ELSE 'application/trig' END ELSE 'application/x-jelly-rdf' END AS media_type FROM orders")
def b11_format_by_stream_type(spark, sf_dir):
    kind = F.when(F.col("o_orderkey") % 3 == 0, "flat").when(F.col("o_orderkey") % 3 == 1, "stream").otherwise("jelly")
    return table(spark, sf_dir, "orders").select("o_orderkey", names.stream_format(kind, F.col("o_orderkey") % 2 == 0).alias("f")).select("o_orderkey", "f.*")
