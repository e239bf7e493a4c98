"""Quads tables derived from the relational tables, one scan each, and their schemas.

Canonical columns: element_id, g, g_kind, s, s_kind, p, p_kind, o, o_kind, o_dt, o_lang; a null g is the default
graph. An element is a set, so rows are distinct; the derivations that can repeat a statement drop repeats inside the element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.terms import RDF_TYPE, XSD, nt_term
from tessera.sources.shared import dealt

QUAD_COLUMNS = ("g", "g_kind", "s", "s_kind", "p", "p_kind", "o", "o_kind", "o_dt", "o_lang")
QUADS = "element_id long, " + ", ".join(f"{c} string" for c in QUAD_COLUMNS)
QUOTED = "element_id long, path string, depth int, " + ", ".join(f"{c} string" for c in QUAD_COLUMNS[2:])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iri(value: Column | str) -> tuple[Column, Column, Column, Column]:
    return (F.lit(value) if isinstance(value, str) else value, F.lit("iri"), F.lit(None).cast("string"), F.lit(None).cast("string"))


def bnode(value: Column) -> tuple[Column, Column, Column, Column]:
    return (value, F.lit("bnode"), F.lit(None).cast("string"), F.lit(None).cast("string"))


def literal(value: Column | str, datatype: str = "string", lang: Column | None = None) -> tuple[Column, Column, Column, Column]:
    value = F.lit(value) if isinstance(value, str) else value
    return (value.cast("string"), F.lit("literal"), F.lit(None if lang is not None else XSD + datatype).cast("string"), F.lit(None).cast("string") if lang is None else lang)


def quad(s: tuple, p: str, o: tuple, g: tuple | None = None) -> Column:
    """A struct of the quad columns."""
    null = F.lit(None).cast("string")
    graph = (null, null) if g is None else g[:2]
    values = (*graph, s[0], s[1], F.lit(p), F.lit("iri"), *o)
    return F.struct(*[v.alias(n) for v, n in zip(values, QUAD_COLUMNS, strict=True)])


def explode_quads(rows: DataFrame, element: Column, quads: list[Column]) -> DataFrame:
    """One row for each quad of each row; quads with a null object are left out."""
    return rows.select(element.cast("long").alias("element_id"), F.explode(F.array(*quads)).alias("q")).select("element_id", "q.*").filter(F.col("o").isNotNull())


def spread(rows: DataFrame, *keys: str, times: int = 1) -> DataFrame:
    """``rows`` dealt over as many tasks as there are shuffle partitions, or so many times more, by keys if there are some.

    For small rows of which much is made: Spark counts the bytes of a file or shuffle, and would give few tasks all of that work.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * times, *keys)


def _dealt_by(rows: DataFrame, key: str, by_element: int) -> DataFrame:
    return spread(rows, key, times=by_element) if by_element else rows


def q_events(spark: SparkSession, sf_dir: str, by_element: int = 0) -> DataFrame:
    """A triple stream: one element for each event."""
    e = _dealt_by(table(spark, sf_dir, "events"), "event_id", by_element)
    c = F.col
    s = iri(F.concat(F.lit("urn:event:"), c("event_id").cast("string")))
    return explode_quads(
        e,
        c("event_id"),
        [
            quad(s, RDF_TYPE, iri("urn:t:Event")),
            quad(s, "urn:p:user", iri(F.concat(F.lit("urn:user:"), c("user_id").cast("string")))),
            quad(s, "urn:p:kind", literal(c("event_type"))),
            quad(s, "urn:p:cents", literal(F.round(c("value") * 100).cast("long"), "integer")),
            quad(s, "urn:p:day", literal(c("ts").cast("date"), "date")),
            quad(s, "urn:p:k", literal(F.nullif(F.regexp_extract("props", "([0-9]+)", 1), F.lit("")), "integer")),
        ],
    )


def q_orders(spark: SparkSession, sf_dir: str, by_element: int = 0) -> DataFrame:
    """A timestamped named graph stream: one element for each order, a blank node for each of its different lines.

    With ``by_element`` rows are dealt by element while they are orders and lines, which are far smaller than the statements made of
    them; what is grouped by element then needs no shuffle of its own.
    """
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    c = F.col
    keys, o = o.select("key"), _dealt_by(o, "key", by_element)
    g = iri(F.concat(F.lit("urn:order:"), c("key").cast("string")))
    facts = explode_quads(
        o,
        c("key"),
        [
            quad(g, RDF_TYPE, iri("urn:t:Order"), g),
            quad(g, "urn:p:status", literal(c("o_orderstatus")), g),
            quad(g, "urn:p:priority", literal(c("o_orderpriority")), g),
            quad(g, "urn:p:customer", iri(F.concat(F.lit("urn:customer:"), c("o_custkey").cast("string"))), g),
            quad(g, "urn:p:cents", literal(F.round(c("o_totalprice") * 100).cast("long"), "integer"), g),
            quad(g, "urn:p:created", literal(c("o_orderdate").cast("date"), "date")),
        ],
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("qty"))
    lines = spread(lines, "l_orderkey", times=by_element or 1).distinct().join(dealt(keys), c("l_orderkey") == c("key"), "left_semi")  # one shuffle for both
    g = iri(F.concat(F.lit("urn:order:"), c("l_orderkey").cast("string")))
    b = bnode(F.concat_ws("_", F.lit("b"), c("l_linenumber"), c("l_partkey"), c("qty")))
    parts = explode_quads(
        lines,
        c("l_orderkey"),
        [
            quad(g, "urn:p:line", b, g),
            quad(b, "urn:p:part", iri(F.concat(F.lit("urn:part:"), c("l_partkey").cast("string"))), g),
            quad(b, "urn:p:quantity", literal(c("qty"), "integer"), g),
        ],
    )
    return facts.unionByName(parts)


def q_docs(spark: SparkSession, sf_dir: str, by_element: int = 0) -> DataFrame:
    """A subject graph stream: one element for each document, with control characters put before the source."""
    d = _dealt_by(table(spark, sf_dir, "documents"), "doc_id", by_element)
    c = F.col
    s = iri(F.concat(F.lit("urn:doc:"), c("doc_id").cast("string")))
    return explode_quads(
        d,
        c("doc_id"),
        [
            quad(s, RDF_TYPE, iri("urn:t:Document")),
            quad(s, "urn:p:text", literal(c("text"), lang=c("lang"))),
            quad(s, "urn:p:source", literal(F.concat(F.repeat(F.lit("\x01\x13\x14\t"), (c("doc_id") % 3).cast("int")), c("source")))),
        ],
    )


def q_stars(spark: SparkSession, sf_dir: str, by_element: int = 0) -> DataFrame:
    """One element for each labelled document, whose subject is a quoted triple."""
    part = _star_part(spark, sf_dir, by_element)
    c = F.col
    inner = F.concat_ws(" ", nt_term(c("s"), c("s_kind")), nt_term(c("p"), c("p_kind")), nt_term(c("o"), c("o_kind"), c("o_dt"), c("o_lang")))
    return explode_quads(part.withColumn("inner", inner), c("element_id"), [quad((c("inner"), F.lit("triple")), "urn:p:toxic", literal(c("toxic"), "integer"))])


def quoted_stars(spark: SparkSession, sf_dir: str, by_element: int = 0) -> DataFrame:
    """The quoted triples of ``q_stars``: path of the position, depth, and the parts."""
    return _star_part(spark, sf_dir, by_element).select("element_id", F.lit("s").alias("path"), F.lit(1).alias("depth"), *QUAD_COLUMNS[2:])


def _star_part(spark: SparkSession, sf_dir: str, by_element: int) -> DataFrame:
    labels = _dealt_by(table(spark, sf_dir, "labels"), "doc_id", by_element)
    c = F.col
    s = iri(F.concat(F.lit("urn:doc:"), c("doc_id").cast("string")))
    return labels.select(c("doc_id").cast("long").alias("element_id"), "toxic", quad(s, "urn:p:quality", literal(c("quality"), "integer")).alias("q")).select("element_id", "toxic", "q.*")


_NO = "CAST(NULL AS STRING)"


def _sql(element: str, s: str, s_kind: str, p: str, o: str, o_kind: str, source: str, dt: str = _NO, lang: str = _NO, g: str = _NO) -> str:
    g_kind = _NO if g == _NO else "'iri'"
    return f"SELECT CAST({element} AS BIGINT) AS element_id, {g} AS g, {g_kind} AS g_kind, {s} AS s, '{s_kind}' AS s_kind, {p} AS p, 'iri' AS p_kind, {o} AS o, '{o_kind}' AS o_kind, {dt} AS o_dt, {lang} AS o_lang FROM {source}"


def _events_sql() -> str:
    s = "'urn:event:' || event_id"
    dt = lambda t: f"'{XSD}{t}'"
    return " UNION ALL ".join(
        (
            _sql("event_id", s, "iri", f"'{RDF_TYPE}'", "'urn:t:Event'", "iri", "events"),
            _sql("event_id", s, "iri", "'urn:p:user'", "'urn:user:' || user_id", "iri", "events WHERE user_id IS NOT NULL"),
            _sql("event_id", s, "iri", "'urn:p:kind'", "event_type", "literal", "events WHERE event_type IS NOT NULL", dt("string")),
            _sql("event_id", s, "iri", "'urn:p:cents'", "CAST(CAST(round(value * 100) AS BIGINT) AS STRING)", "literal", "events WHERE value IS NOT NULL", dt("integer")),
            _sql("event_id", s, "iri", "'urn:p:day'", "CAST(CAST(ts AS DATE) AS STRING)", "literal", "events WHERE ts IS NOT NULL", dt("date")),
            _sql("event_id", s, "iri", "'urn:p:k'", "regexp_extract(props, '([0-9]+)', 1)", "literal", "events WHERE regexp_extract(props, '([0-9]+)', 1) <> ''", dt("integer")),
        )
    )


def _orders_sql() -> str:
    g = "'urn:order:' || o_orderkey"
    h = "'urn:order:' || l_orderkey"
    b = "'b_' || l_linenumber || '_' || l_partkey || '_' || qty"
    dt = lambda t: f"'{XSD}{t}'"
    lines = "(SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, CAST(trunc(l_quantity) AS BIGINT) AS qty FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) AS l"
    return " UNION ALL ".join(
        (
            _sql("o_orderkey", g, "iri", f"'{RDF_TYPE}'", "'urn:t:Order'", "iri", "orders", g=g),
            _sql("o_orderkey", g, "iri", "'urn:p:status'", "o_orderstatus", "literal", "orders", dt("string"), g=g),
            _sql("o_orderkey", g, "iri", "'urn:p:priority'", "o_orderpriority", "literal", "orders", dt("string"), g=g),
            _sql("o_orderkey", g, "iri", "'urn:p:customer'", "'urn:customer:' || o_custkey", "iri", "orders", g=g),
            _sql("o_orderkey", g, "iri", "'urn:p:cents'", "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING)", "literal", "orders", dt("integer"), g=g),
            _sql("o_orderkey", g, "iri", "'urn:p:created'", "CAST(CAST(o_orderdate AS DATE) AS STRING)", "literal", "orders", dt("date")),
            _sql("l_orderkey", h, "iri", "'urn:p:line'", b, "bnode", lines, g=h),
            _sql("l_orderkey", b, "bnode", "'urn:p:part'", "'urn:part:' || l_partkey", "iri", lines, g=h),
            _sql("l_orderkey", b, "bnode", "'urn:p:quantity'", "CAST(qty AS STRING)", "literal", lines, dt("integer"), g=h),
        )
    )


def _docs_sql() -> str:
    s = "'urn:doc:' || doc_id"
    return " UNION ALL ".join(
        (
            _sql("doc_id", s, "iri", f"'{RDF_TYPE}'", "'urn:t:Document'", "iri", "documents"),
            _sql("doc_id", s, "iri", "'urn:p:text'", "text", "literal", "documents WHERE text IS NOT NULL", lang="lang"),
            _sql("doc_id", s, "iri", "'urn:p:source'", "repeat(chr(1) || chr(19) || chr(20) || chr(9), CAST(doc_id % 3 AS BIGINT)) || source", "literal", "documents WHERE source IS NOT NULL", f"'{XSD}string'"),
        )
    )


def _stars_sql() -> str:
    inner = f"'<urn:doc:' || doc_id || '> <urn:p:quality> \"' || quality || '\"^^<{XSD}integer>'"
    return _sql("doc_id", inner, "triple", "'urn:p:toxic'", "CAST(toxic AS STRING)", "literal", "labels WHERE toxic IS NOT NULL AND quality IS NOT NULL", f"'{XSD}integer'")


def _quoted_sql() -> str:
    return f"SELECT doc_id AS element_id, 's' AS path, 1 AS depth, 'urn:doc:' || doc_id AS s, 'iri' AS s_kind, 'urn:p:quality' AS p, 'iri' AS p_kind, CAST(quality AS STRING) AS o, 'literal' AS o_kind, '{XSD}integer' AS o_dt, {_NO} AS o_lang FROM labels"


#: The views in SQL that DuckDB runs on the same tables.
VIEWS_SQL = {"q_events": _events_sql(), "q_orders": _orders_sql(), "q_docs": _docs_sql(), "q_stars": _stars_sql(), "quoted_stars": _quoted_sql()}
VIEWS = {"q_events": q_events, "q_orders": q_orders, "q_docs": q_docs, "q_stars": q_stars, "quoted_stars": quoted_stars}


def by_element(name: str, spark: SparkSession, sf_dir: str, times: int = 1) -> DataFrame:
    """A view for work by element: the statements of an element are where its rows of the tables were dealt to; see ``spread`` for ``times``."""
    return VIEWS[name](spark, sf_dir, by_element=times)


def with_views(*names: str) -> str:
    """The start of a query: WITH clauses of views, to go on with a comma or a SELECT."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({VIEWS_SQL[n]})" for n in names)
