"""Queries of the statistics, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import degrees, stats
from tessera.sources.shared import dealt, settle
from tessera.sources.views import VIEWS, by_element, table, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Statistic: its number, the view, the table and id of its elements, and fixed sizes.
_ORDERS = ("q_orders", "orders", "o_orderkey", (10_000, 100_000, 1_000_000))
_DOCS = ("q_docs", "documents", "doc_id", (100, 500, 10_000))
_STARS = ("q_stars", "documents", "doc_id", (100, 500, 10_000))
STATISTICS = {
    "iris": (1, *_ORDERS),
    "blank_nodes": (2, *_ORDERS),
    "literals": (3, *_ORDERS),
    "simple_literals": (4, *_ORDERS),
    "datatype_literals": (5, *_ORDERS),
    "language_literals": (6, *_DOCS),
    "datatypes": (7, *_ORDERS),
    "ascii_control_chars": (8, *_DOCS),
    "quoted_triples": (9, *_STARS),
    "subjects": (10, *_STARS),
    "predicates": (11, *_ORDERS),
    "objects": (12, *_ORDERS),
    "graphs": (13, *_ORDERS),
    "statements": (14, *_ORDERS),
    "byte_density": (15, *_ORDERS),
}


def inputs(spark, sf_dir: str, view: str, base: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    elements = table(spark, sf_dir, base).select(F.col(key).cast("long").alias("element_id"))
    quoted = by_element("quoted_stars", spark, sf_dir) if view == "q_stars" else None
    return elements, by_element(view, spark, sf_dir), quoted


_KEY = "v || chr(1) || coalesce(dt, '') || chr(1) || coalesce(lang, '')"
_DATATYPE = "k = 'literal' AND coalesce(lang, '') = '' AND dt IS NOT NULL AND dt <> 'http://www.w3.org/2001/XMLSchema#string'"
_SIMPLE = "k = 'literal' AND coalesce(lang, '') = '' AND (dt IS NULL OR dt = 'http://www.w3.org/2001/XMLSchema#string')"
_TERM = f"k || chr(1) || CASE WHEN k = 'literal' THEN {_KEY} ELSE v END"
_DISTINCT = {
    "iris": ("k = 'iri'", "v"),
    "blank_nodes": ("k = 'bnode'", "v"),
    "literals": ("k = 'literal'", _KEY),
    "simple_literals": (_SIMPLE, "v"),
    "datatype_literals": (_DATATYPE, _KEY),
    "language_literals": ("k = 'literal' AND coalesce(lang, '') <> ''", _KEY),
    "datatypes": (_DATATYPE, "dt"),
    "subjects": ("r = 's'", _TERM),
    "predicates": ("r = 'p'", _TERM),
    "objects": ("r = 'o'", _TERM),
}
LINE = r"""CASE s_kind WHEN 'iri' THEN '<' || s || '>' WHEN 'bnode' THEN '_:' || s ELSE '<< ' || s || ' >>' END || ' <' || p || '> ' ||
CASE o_kind WHEN 'iri' THEN '<' || o || '>' WHEN 'bnode' THEN '_:' || o ELSE '"' || replace(replace(replace(replace(replace(o, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"' ||
CASE WHEN coalesce(o_lang, '') <> '' THEN '@' || o_lang WHEN o_dt IS NULL OR o_dt = 'http://www.w3.org/2001/XMLSchema#string' THEN '' ELSE '^^<' || o_dt || '>' END END ||
CASE WHEN g IS NULL THEN '' ELSE ' <' || g || '>' END || ' .'"""


def uses_sql(view: str) -> str:
    """CTEs: the view, and ``u`` (element_id, r, v, k, dt, lang) of all term uses."""
    names = (view, "quoted_stars") if view == "q_stars" else (view,)
    uses = [f"SELECT element_id, '{r}' AS r, {r} AS v, {r}_kind AS k, {'o_dt' if r == 'o' else 'CAST(NULL AS STRING)'} AS dt, {'o_lang' if r == 'o' else 'CAST(NULL AS STRING)'} AS lang FROM {n}" for n in names for r in "spo"]
    uses.append(f"SELECT DISTINCT element_id, 'g', g, g_kind, CAST(NULL AS STRING), CAST(NULL AS STRING) FROM {view} WHERE g IS NOT NULL")
    return with_views(*names) + ", u AS (" + " UNION ALL ".join(uses) + ")"


def values_sql(name: str, view: str) -> str:
    """WITH clauses that end with ``vals`` (element_id, value)."""
    if name in _DISTINCT:
        which, what = _DISTINCT[name]
        return uses_sql(view) + f", vals AS (SELECT element_id, count(DISTINCT {what}) AS value FROM u WHERE {which} GROUP BY element_id)"
    body = {
        "graphs": "SELECT element_id, count(DISTINCT coalesce(g, 'DEFAULT GRAPH')) AS value FROM {v} GROUP BY element_id",
        "statements": "SELECT element_id, count(*) AS value FROM {v} GROUP BY element_id",
        "quoted_triples": "SELECT element_id, count(*) AS value FROM quoted_stars GROUP BY element_id" if view == "q_stars" else "SELECT element_id, 0 AS value FROM {v} WHERE false",
        "ascii_control_chars": r"SELECT element_id, CAST(sum(length(v) - length(regexp_replace(v, '[\x00-\x08\x0B\x0C\x0E-\x13]', '', 'g'))) AS BIGINT) AS value FROM u WHERE k = 'literal' GROUP BY element_id",
        "byte_density": "SELECT element_id, sum(strlen(" + LINE + ") + 1) / CAST(count(*) AS DOUBLE) AS value FROM {v} GROUP BY element_id",
    }[name].replace("{v}", view)
    return uses_sql(view) + f", vals AS ({body})"


def sizes_sql(base: str, sizes: tuple[int, ...]) -> str:
    fixed = ", ".join(f"({s})" for s in sizes)
    return f"total AS (SELECT count(*) AS total FROM {base}), sizes AS (SELECT size, size = total AS is_full, total FROM total, (SELECT s AS size FROM (VALUES {fixed}) AS f(s) UNION SELECT total FROM total) AS x WHERE size <= total)"


def summary_sql(name: str, view: str, base: str, key: str, sizes: tuple[int, ...]) -> str:
    value = "vals.value" if name == "byte_density" else "coalesce(vals.value, 0)"
    total = "" if name == "byte_density" else "CAST(sum(value) AS DOUBLE) AS sum, "
    return (
        values_sql(name, view)
        + f", {sizes_sql(base, sizes)}, filled AS (SELECT e.{key} AS element_id, {value} AS value FROM {base} e LEFT JOIN vals ON vals.element_id = e.{key}) "
        + f"SELECT size, is_full, count(value) AS n, {total}round(CAST(sum(value) AS DOUBLE) / count(value), 6) AS mean, "
        + "round(sqrt(greatest(CAST(sum(value * value) AS DOUBLE) / count(value) - (CAST(sum(value) AS DOUBLE) / count(value)) * (CAST(sum(value) AS DOUBLE) / count(value)), 0)), 4) AS st_dev, "
        + "CAST(min(value) AS DOUBLE) AS min, CAST(max(value) AS DOUBLE) AS max FROM sizes JOIN filled ON element_id < size GROUP BY size, is_full"
    )


def _summary(name: str):
    _, view, base, key, sizes = STATISTICS[name]

    def run(spark, sf_dir):
        elements, quads, quoted = inputs(spark, sf_dir, view, base, key)
        out = stats.summary(stats.element_values(name, elements, quads, quoted, dealt=True), stats.prefix_sizes(elements, sizes))
        return out.drop("sum") if name == "byte_density" else out

    return run


for _name, (_number, _view, _base, _key, _sizes) in STATISTICS.items():
    QUERIES[f"d{_number}_{_name}"] = _summary(_name)
    SQL[f"d{_number}_{_name}"] = summary_sql(_name, _view, _base, _key, _sizes)

#: Statement statistics of the event stream at all prefixes; also the flagship query.
_EVENTS = ("q_events", "events", "event_id", (1_000, 10_000, 100_000))


def e2_cumulative_prefix_stats(spark, sf_dir):
    elements, quads, _ = inputs(spark, sf_dir, *_EVENTS[:3])
    return stats.summary(stats.element_values("statements", elements, quads), stats.prefix_sizes(elements, _EVENTS[3]))


def d16_stat_summary(spark, sf_dir):
    elements, quads, _ = inputs(spark, sf_dir, *_EVENTS[:3])
    return stats.prefix_stats(["iris", "literals", "objects"], elements, quads, sizes=stats.prefix_sizes(elements, _EVENTS[3]))


def e3_cumulative_exact_distinct(spark, sf_dir):
    elements, quads, _ = inputs(spark, sf_dir, *_EVENTS[:3])
    return stats.prefix_unique(stats.distinct_values("literals", quads), stats.prefix_sizes(elements, _EVENTS[3]))


def d17_approx_distinct_bounds(spark, sf_dir):
    """The estimate itself differs from engine to engine, so the query gives the exact count and whether the estimate is within 3 %."""
    elements, quads, _ = inputs(spark, sf_dir, *_EVENTS[:3])
    sizes = stats.prefix_sizes(elements, _EVENTS[3])
    values = stats.distinct_values("literals", quads)
    about = stats.prefix_unique_approx(values, sizes).withColumnRenamed("unique_count", "estimate")
    near = F.abs(F.col("estimate") - F.col("unique_count")) <= 0.03 * F.col("unique_count")
    return stats.prefix_unique(values, sizes).join(about, "size").select("size", "unique_count", near.alias("within_3_percent"), ((F.col("unique_lower") <= F.col("estimate")) & (F.col("estimate") <= F.col("unique_upper"))).alias("in_bounds"))


#: The streams that all statistics are made of.
STREAMS = {"documents": _STARS, "orders": _ORDERS, "events": ("q_events", "events", "event_id", (1_000, 10_000, 100_000))}


def shown(found: DataFrame) -> DataFrame:
    """All statistics without what differs from engine to engine: the exact unique count, the values that are listed, and which have a sketch."""
    exact = F.when(F.col("statistic") == stats.LISTED, F.col("unique_count"))
    bounded = (F.col("unique_lower") <= F.col("unique_count")) & (F.col("unique_count") <= F.col("unique_upper"))
    listed = F.array_join("values", " ")
    return found.select("size", "is_full", "n", "mean", "st_dev", "min", "max", "statistic", exact.alias("exact_unique"), listed.alias("values"), F.coalesce(bounded, F.lit(False)).alias("sketched"))


def shown_sql(view: str, base: str, key: str, sizes: tuple[int, ...]) -> str:
    which, what = _DISTINCT["datatypes"]
    listed = uses_sql(view) + f", {sizes_sql(base, sizes)}, seen AS (SELECT DISTINCT size, {what} AS x FROM sizes JOIN u ON element_id < size WHERE {which}) SELECT size, CAST(count(x) AS BIGINT) AS exact_unique, coalesce(string_agg(x, ' ' ORDER BY x), '') AS values FROM sizes LEFT JOIN seen USING (size) GROUP BY size"
    one = lambda n: f"SELECT size, is_full, n, mean, st_dev, min, max, '{n}' AS statistic FROM ({summary_sql(n, view, base, key, sizes)})"
    sketched = ", ".join(f"'{n}'" for n in stats.SKETCHED)
    return "SELECT a.*, exact_unique, values, statistic IN (" + sketched + ") AS sketched FROM (" + " UNION ALL ".join(map(one, stats.NAMES)) + f") a LEFT JOIN ({listed}) l ON a.size = l.size AND statistic = 'datatypes'"


def d1_d15_all_statistics(spark, sf_dir):
    """All statistics of three streams, each from one scan, with the exact set of datatypes at each prefix."""
    def of(name: str) -> DataFrame:
        view, base, key, sizes = STREAMS[name]
        elements, quads, quoted = inputs(spark, sf_dir, view, base, key)
        return shown(stats.all_statistics(elements, quads, quoted, stats.prefix_sizes(elements, sizes), dealt=True)).withColumn("stream", F.lit(name))

    return reduce(DataFrame.unionByName, map(of, STREAMS))


def d17_unique_of_all_statistics(spark, sf_dir):
    """Exact unique counts of all statistics that have one, from one scan, and whether the sketches' bounds hold them, or miss by less than their width."""
    elements, quads, quoted = inputs(spark, sf_dir, *_STARS[:3])
    sizes = stats.prefix_sizes(elements, _STARS[3])
    about = stats.all_statistics(elements, quads, quoted, sizes, dealt=True).select("size", "statistic", F.col("unique_count").alias("estimate"), "unique_lower", "unique_upper")
    exact = stats.prefix_unique_counts([*stats.SKETCHED, stats.LISTED], quads, quoted, sizes)
    off = F.greatest(F.col("unique_lower") - F.col("unique_count"), F.col("unique_count") - F.col("unique_upper"), F.lit(0))
    near = F.when(F.col("statistic") == stats.LISTED, F.col("estimate") == F.col("unique_count")).otherwise(off <= F.col("unique_upper") - F.col("unique_lower"))
    return exact.join(about, ["size", "statistic"]).select("size", "statistic", "unique_count", near.alias("near"))


_UNIQUE = uses_sql("q_events") + f", {sizes_sql('events', _EVENTS[3])} SELECT size, count(DISTINCT {_KEY}) AS unique_count"
QUERIES |= {"e2_cumulative_prefix_stats": e2_cumulative_prefix_stats, "d16_stat_summary": d16_stat_summary, "e3_cumulative_exact_distinct": e3_cumulative_exact_distinct, "d17_approx_distinct_bounds": d17_approx_distinct_bounds}
QUERIES["d1_d15_all_statistics"] = d1_d15_all_statistics
SQL["d1_d15_all_statistics"] = " UNION ALL ".join(f"SELECT *, '{name}' AS stream FROM ({shown_sql(*of)})" for name, of in STREAMS.items())
QUERIES["d17_unique_of_all_statistics"] = d17_unique_of_all_statistics
_EXACT = {**_DISTINCT, "graphs": ("r = 'd'", "v")}
SQL["d17_unique_of_all_statistics"] = " UNION ALL ".join(
    f"SELECT size, '{n}' AS statistic, count(DISTINCT x) AS unique_count, true AS near FROM ({uses_sql('q_stars')}, w AS (SELECT element_id, r, v, k, dt, lang FROM u UNION ALL SELECT element_id, 'd', coalesce(g, 'DEFAULT GRAPH'), NULL, NULL, NULL FROM q_stars), {sizes_sql('documents', _STARS[3])} SELECT size, x FROM sizes LEFT JOIN (SELECT element_id, {what} AS x FROM w WHERE {which}) ON element_id < size) GROUP BY size"
    for n, (which, what) in _EXACT.items()
    if n in (*stats.SKETCHED, stats.LISTED)
)
SQL["e2_cumulative_prefix_stats"] = summary_sql("statements", *_EVENTS)
SQL["d16_stat_summary"] = " UNION ALL ".join(f"SELECT *, '{n}' AS statistic FROM ({summary_sql(n, *_EVENTS)})" for n in ("iris", "literals", "objects"))
SQL["e3_cumulative_exact_distinct"] = _UNIQUE + " FROM sizes JOIN u ON element_id < size WHERE k = 'literal' GROUP BY size"
SQL["d17_approx_distinct_bounds"] = _UNIQUE + ", true AS within_3_percent, true AS in_bounds FROM sizes JOIN u ON element_id < size WHERE k = 'literal' GROUP BY size"


def d18_degree_distribution(spark, sf_dir):
    return degrees.degree_distribution(VIEWS["q_orders"](spark, sf_dir))


def d19_degree_any_position(spark, sf_dir):
    return degrees.degree_distribution(VIEWS["q_orders"](spark, sf_dir), detailed=False)


def d20_distinct_nodes_per_role(spark, sf_dir):
    return degrees.distinct_nodes(VIEWS["q_orders"](spark, sf_dir))


def _sketches_held(about: DataFrame) -> DataFrame:
    """For each role: whether nodes of few statements are exact, and 95 % of the others in their bounds."""
    bounds = degrees.with_bounds(about).select("role", "distinct_lower", "distinct_upper", "x.*")
    n = F.col("distinct_statements")
    inside = (F.col("distinct_lower") <= n) & (n <= F.col("distinct_upper"))
    few = n <= 2**degrees.LG_HASHES
    told = F.col("distinct_lower") == F.col("distinct_upper")
    return bounds.groupBy("role").agg(F.count("*").alias("nodes"), F.sum("occurrences").alias("occurrences"), F.sum("distinct_statements").alias("distinct_statements"), F.bool_and(~few | (inside & told)).alias("few_are_exact"), (F.count_if(inside & ~few) >= 0.95 * F.count_if(~few) - 1).alias("many_are_near"))


#: Sketches of a task's nodes are made of its uses in their order, so the tasks are more, and each has fewer to sort.
_SKETCH_TASKS = 4


def d18_degree_sketches(spark, sf_dir):
    """Sketches of two streams in each role and in any, all merged from one table of each stream, against exact numbers.

    A node has one row in each table, so both merges and the comparison are joins by node, without a shuffle of their own.
    """
    streams = [by_element(v, spark, sf_dir, _SKETCH_TASKS) for v in ("q_orders", "q_events")]
    exact = degrees.node_degrees(reduce(DataFrame.unionByName, streams))
    both = exact.select("node", *[F.col(r).alias("x_" + r) for r in (*degrees.ROLES, "statement")])
    for k, stream in enumerate(streams):
        found = degrees.node_sketches(stream)
        both = both.join(dealt(found.select("node", *[F.col(r).alias(f"{r}_{k}") for r in degrees.ROLES])), "node", "left")
    merged = both.select(*[c for c in both.columns if c.startswith("x_")], *[degrees.united(F.col(f"{r}_0"), F.col(f"{r}_1")).alias(r) for r in degrees.ROLES])
    sketches = {r: F.col(r) for r in degrees.ROLES} | {"statement": degrees.in_any_role([F.col(r) for r in degrees.ROLES])}
    rows = F.array(*[F.struct(F.lit(r).alias("role"), x.alias("of"), F.col("x_" + r).alias("x")) for r, x in sketches.items()])
    about = merged.select(F.explode(rows).alias("r")).select("r.role", F.lit(None).cast("string").alias("node"), "r.of.*", "r.x").filter("x is not null").select("role", "node", F.lit(0).alias("occurrences"), "sketch", "x")
    return _sketches_held(about)


def a12_degree_counts(spark, sf_dir):
    found = degrees.degree_distribution(VIEWS["q_events"](spark, sf_dir))
    return found.groupBy("role", "occurrences").agg(F.count("*").alias("nodes"))


def _degree_sql(view: str, detailed: bool) -> str:
    o = LINE.split("' <' || p || '> ' ||")[1].split("||\nCASE WHEN g IS NULL")[0]
    s = "CASE s_kind WHEN 'iri' THEN '<' || s || '>' WHEN 'bnode' THEN '_:' || s ELSE '<< ' || s || ' >>' END"
    nodes = {"subject": s, "predicate": "'<' || p || '>'", "object": o.strip(), "graph": "'<' || g || '>'"}
    role = lambda r: r if detailed else "statement"
    return with_views(view) + ", l AS (SELECT *, " + LINE + f" AS line FROM {view}), uses AS (" + " UNION ALL ".join(f"SELECT '{role(r)}' AS role, {n} AS node, line FROM l" for r, n in nodes.items()) + ")"


QUERIES |= {"d18_degree_distribution": d18_degree_distribution, "d18_degree_sketches": d18_degree_sketches, "d19_degree_any_position": d19_degree_any_position, "d20_distinct_nodes_per_role": d20_distinct_nodes_per_role, "a12_degree_counts": a12_degree_counts}
_COUNTS = " SELECT role, node, count(*) AS occurrences, count(DISTINCT line) AS distinct_statements FROM uses WHERE node IS NOT NULL GROUP BY role, node"
SQL["d18_degree_distribution"] = _degree_sql("q_orders", True) + _COUNTS
SQL["d19_degree_any_position"] = _degree_sql("q_orders", False) + _COUNTS
SQL["d20_distinct_nodes_per_role"] = _degree_sql("q_orders", True) + " SELECT role, count(DISTINCT node) AS nodes FROM uses WHERE node IS NOT NULL GROUP BY role"
_BOTH = [f"SELECT * FROM ({_degree_sql(view, detailed)} SELECT role, node, line FROM uses WHERE node IS NOT NULL)" for view in ("q_orders", "q_events") for detailed in (True, False)]
SQL["d18_degree_sketches"] = f"WITH both_streams AS ({' UNION ALL '.join(_BOTH)}), n AS (SELECT role, node, count(*) AS occurrences, count(DISTINCT line) AS d FROM both_streams GROUP BY role, node) SELECT role, count(*) AS nodes, CAST(sum(occurrences) AS BIGINT) AS occurrences, CAST(sum(d) AS BIGINT) AS distinct_statements, true AS few_are_exact, true AS many_are_near FROM n GROUP BY role"
SQL["a12_degree_counts"] = _degree_sql("q_events", True) + f" SELECT role, occurrences, count(*) AS nodes FROM ({_COUNTS}) GROUP BY role, occurrences"


def d27_named_graph_count(spark, sf_dir):
    q = VIEWS["q_orders"](spark, sf_dir)
    names = q.select("g").filter("g is not null").distinct().agg(F.count("*").alias("named_graphs"))
    return names.crossJoin(F.broadcast(q.agg(F.count("*").alias("statements"))))  # of one row each


def k1_statistic_plug_in(spark, sf_dir):
    """A statistic of one's own: the longest object of an element."""
    stats.register_statistic("longest_object", lambda e, q, t: e.select("element_id").join(q.groupBy("element_id").agg(F.max(F.char_length("o")).cast("long").alias("value")), "element_id", "left").na.fill(0))
    elements, quads, _ = inputs(spark, sf_dir, *_EVENTS[:3])
    return stats.prefix_stats(["longest_object"], elements, quads, sizes=stats.prefix_sizes(elements, _EVENTS[3]))


QUERIES |= {"d27_named_graph_count": d27_named_graph_count, "k1_statistic_plug_in": k1_statistic_plug_in}
SQL["d27_named_graph_count"] = with_views("q_orders") + " SELECT count(DISTINCT g) AS named_graphs, count(*) AS statements FROM q_orders"
_LONGEST = summary_sql("statements", *_EVENTS).replace("SELECT element_id, count(*) AS value FROM q_events", "SELECT element_id, max(length(o)) AS value FROM q_events")
SQL["k1_statistic_plug_in"] = f"SELECT *, 'longest_object' AS statistic FROM ({_LONGEST})"
