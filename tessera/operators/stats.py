"""Statistics of stream elements at prefixes of the stream.

A value is computed for each element, zeros included, and summarised for each prefix size. Prefixes are not
scanned one by one: elements fall in the bucket of the least boundary above their number, buckets are aggregated once, and a
running sum over the few bucket rows gives every prefix.

The values of all statistics asked for come from one scan and one shuffle by element: an element is small, so what it has
meets in one row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.functions.names import PACKAGE_SIZES
from tessera.functions.terms import DEFAULT_GRAPH, ascii_control_count, literal_class, literal_key, nt_statement
from tessera.sources.shared import settle


def prefix_sizes(elements: DataFrame, sizes: tuple[int, ...] = tuple(PACKAGE_SIZES)) -> DataFrame:
    """(size, is_full) of each size up to the number of elements, and of that number itself; a size equal to it comes once.

    At most ``len(sizes) + 1`` rows, so they may be broadcast.
    """
    n = elements.agg(F.count("*").alias("n"))
    fixed = F.array(*[F.lit(s).cast("long") for s in sizes])
    return n.select("n", F.explode(F.array_distinct(F.array_append(F.filter(fixed, lambda s: s <= F.col("n")), F.col("n")))).alias("size")).select("size", (F.col("size") == F.col("n")).alias("is_full")).filter("size > 0")


def with_bucket(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``, the least size above the element's number; elements beyond all sizes go."""
    bounds = sizes.agg(F.sort_array(F.collect_list("size")).alias("bounds"))  # of at most seven numbers
    # An array of the one bucket, or of none: as a filter this would become a part of the join, which Spark then plans wrongly under a range sort.
    found = F.slice(F.filter("bounds", lambda b: b > F.col("element_id")), 1, 1)
    return rows.crossJoin(F.broadcast(bounds)).withColumn("bucket", F.explode(found)).drop("bounds")


_PARTS = ("s", "s_kind", "p", "p_kind", "o", "o_kind", "o_dt", "o_lang")


def statements(quads: DataFrame, quoted: DataFrame | None = None) -> DataFrame:
    """The quads and the triples quoted in them as one table, those marked as ``quoted``."""
    out = quads.select("element_id", "g", "g_kind", *_PARTS, F.lit(False).alias("quoted"))
    if quoted is not None:
        null = F.lit(None).cast("string")
        out = out.unionByName(quoted.select("element_id", null.alias("g"), null.alias("g_kind"), *_PARTS, F.lit(True).alias("quoted")))
    return out


def uses(rows: DataFrame, lines: bool = False, default_graph: bool = False, roles: str = "spog") -> DataFrame:
    """(element_id, quoted, role, value, kind, dt, lang) of every term use of ``statements`` in one of the roles s, p, o and g.

    With ``lines`` there is ``line``, the length of the line of a statement that is not quoted, with its predicate, and null elsewhere. With
    ``default_graph`` statements of the default graph have a use of role g and kind default too.
    """
    null, none = F.lit(None).cast("string"), F.lit(None).cast("int")
    line = F.when(~F.col("quoted"), F.octet_length(nt_statement()) + 1)

    def use(role: str, value: Column | None = None, kind: Column | None = None, dt: Column = null, lang: Column = null) -> Column:
        fields = [F.lit(role).alias("role"), (F.col(role) if value is None else value).alias("value"), (F.col(role + "_kind") if kind is None else kind).alias("kind"), dt.alias("dt"), lang.alias("lang")]
        return F.struct(*fields, *([(line if role == "p" else none).alias("line")] if lines else []))

    graph = use("g", F.coalesce("g", F.lit(DEFAULT_GRAPH)), F.when(F.col("g").isNull(), "default").otherwise(F.col("g_kind"))) if default_graph else use("g")
    all_uses = {"s": use("s"), "p": use("p"), "o": use("o", dt=F.col("o_dt"), lang=F.col("o_lang")), "g": graph}
    each = F.explode(F.array(*[u for role, u in all_uses.items() if role in roles]))
    found = rows.select("element_id", "quoted", each.alias("u")).select("element_id", "quoted", "u.*")
    return found.filter((F.col("role") != "g") | (~F.col("quoted") if default_graph else F.col("value").isNotNull()))


#: Statistics that count different values of an element.
DISTINCT = ("iris", "blank_nodes", "literals", "simple_literals", "datatype_literals", "language_literals", "datatypes", "subjects", "predicates", "objects")


def _roles(name: str) -> str:
    """The roles of the uses that a statistic looks at; only objects have a datatype or a language."""
    one = {"subjects": "s", "predicates": "p", "objects": "o", "graphs": "g", "statements": "p", "quoted_triples": "p", "byte_density": "p"}
    return one.get(name, "o" if name in ("datatype_literals", "language_literals", "datatypes") else "spog")


def _counted(name: str) -> tuple[Column, Column]:
    """Which term uses a statistic looks at, and what of them it counts."""
    c = F.col
    key = literal_key(c("value"), c("dt"), c("lang"))
    kind = literal_class(c("kind"), c("dt"), c("lang"))
    term = F.concat_ws("\u0001", "kind", F.when(c("kind") == "literal", key).otherwise(c("value")))
    return {
        "iris": (c("kind") == "iri", c("value")),
        "blank_nodes": (c("kind") == "bnode", c("value")),
        "literals": (c("kind") == "literal", key),
        "simple_literals": (kind == "simple", c("value")),
        "datatype_literals": (kind == "datatype", key),
        "language_literals": (kind == "language", key),
        "datatypes": (kind == "datatype", c("dt")),
        "subjects": (c("role") == "s", term),
        "predicates": (c("role") == "p", term),
        "objects": (c("role") == "o", term),
    }[name]


def distinct_values(name: str, quads: DataFrame, quoted: DataFrame | None = None) -> DataFrame:
    """(element_id, x) of the different values that statistic ``name`` counts."""
    if name == "graphs":
        return quads.select("element_id", F.coalesce("g", F.lit(DEFAULT_GRAPH)).alias("x")).distinct()
    which, what = _counted(name)
    return uses(statements(quads, quoted)).filter(which).select("element_id", what.alias("x")).distinct()


def _aggregate(name: str) -> Column:
    """The value of a statistic over the term uses of an element."""
    c = F.col
    predicate, graph, literal = (c("role") == "p") & ~c("quoted"), c("role") == "g", c("kind") == "literal"
    if name in DISTINCT:
        which, what = _counted(name)
        return F.size(F.collect_set(F.when(which, what))).cast("long")
    controls = F.aggregate(F.collect_set(F.when(literal & graph, c("value"))), F.lit(0).cast("long"), lambda n, x: n + ascii_control_count(x))  # a graph name counts once
    return {
        "graphs": F.size(F.collect_set(F.when(graph, c("value")))).cast("long"),
        "statements": F.count_if(predicate),
        "quoted_triples": F.count_if((c("role") == "p") & c("quoted")),
        "ascii_control_chars": F.coalesce(F.sum(F.when(literal & ~graph, ascii_control_count(c("value")))), F.lit(0)) + controls,
        "byte_density": F.sum("line") / F.nullif(F.count_if(predicate), F.lit(0)),
    }[name]


#: Statistics that are sums over the statements of an element, so that no uses have to be made.
PLAIN = ("statements", "quoted_triples", "byte_density", "ascii_control_chars")


def _plain_aggregate(name: str) -> Column:
    """The value of a statistic of PLAIN over the statements of an element."""
    own = ~F.col("quoted")
    if name == "statements":
        return F.count_if(own)
    if name == "quoted_triples":
        return F.count_if(~own)
    if name == "byte_density":
        return F.sum(F.when(own, F.octet_length(nt_statement()) + 1)) / F.nullif(F.count_if(own), F.lit(0))
    controls = lambda role: F.when(F.col(role + "_kind") == "literal", ascii_control_count(F.col(role))).otherwise(0)
    names = F.aggregate(F.collect_set(F.when(F.col("g_kind") == "literal", F.col("g"))), F.lit(0).cast("long"), lambda n, x: n + ascii_control_count(x))
    return F.coalesce(F.sum(controls("s") + controls("p") + controls("o")), F.lit(0)) + names


#: The statistics of this module.
NAMES = (*DISTINCT, "graphs", *PLAIN)
#: Those with a sketch of their different values, and that whose different values are kept themselves.
SKETCHED = ("iris", "literals", "simple_literals", "datatype_literals", "language_literals", "subjects", "predicates", "objects", "graphs")
LISTED = "datatypes"
_LG_SLOTS = 16


def _sketch(name: str) -> Column:
    """A sketch of the values that a statistic counts in an element."""
    which, what = (F.col("role") == "g", F.col("value")) if name == "graphs" else _counted(name)
    return F.hll_sketch_agg(F.when(which, what), F.lit(_LG_SLOTS))


def element_table(names: list[str], elements: DataFrame | None, quads: DataFrame, quoted: DataFrame | None = None, unique: bool = False, dealt: bool = False) -> DataFrame:
    """(element_id, and a column for each of ``names``): 0 where an element has none, but null for a density without statements.

    Sums over statements go through the shuffle as partial sums. Where a statistic counts different values, statements are dealt by
    element once, unless they are ``dealt`` so already, and all sets of an element are made where its statements are. With ``unique`` there are also its sketches of values
    (u_ and the name) and its datatypes (seen). Without ``elements`` only those with statements have a row.
    """
    rows = statements(quads, quoted)
    if set(names) <= set(PLAIN):
        found = rows.groupBy("element_id").agg(*[_plain_aggregate(n).alias(n) for n in names])
    else:
        kept = [_sketch(n).alias("u_" + n) for n in names if n in SKETCHED] + [F.collect_set(F.when(_counted(LISTED)[0], F.col("dt"))).alias("seen")] * (LISTED in names)
        roles = "".join(r for r in "spog" if any(r in _roles(n) for n in names))
        found = uses(rows if dealt else rows.repartition("element_id"), "byte_density" in names, "graphs" in names, roles).groupBy("element_id").agg(*[_aggregate(n).alias(n) for n in names], *(kept if unique else []))
    filled = [F.col(n) if n == "byte_density" else F.coalesce(n, F.lit(0)).alias(n) for n in names]
    whole = found if elements is None else elements.select("element_id").join(found, "element_id", "left")
    return whole.select("element_id", *filled, *[c for c in found.columns if c not in ("element_id", *names)])


def element_values(name: str, elements: DataFrame, quads: DataFrame, quoted: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """(element_id, value) of one statistic; see ``element_table``."""
    return element_table([name], elements, quads, quoted, dealt=dealt).withColumnRenamed(name, "value")


#: The parts of a state that are added up, and those of which the least or largest stays.
_SUMS, _LEAST, _LARGEST = ("n", "s", "ss", "rs", "rss"), ("lo",), ("hi",)


def states(values: DataFrame, names: list[str], sizes: DataFrame) -> DataFrame:
    """(bucket, statistic, n, s, ss, rs, rss, lo, hi, sketch): what a summary needs of the elements of a bucket, for each of the columns ``names`` of
    (element_id, ...), from one pass over the elements. States of parts of a stream add up to that of the whole; see ``merged``."""
    kinds = dict(values.dtypes)

    def of(name: str) -> Column:
        """Sums of whole numbers are exact."""
        v, whole = F.col(name), kinds[name] in ("bigint", "int")
        d = v.cast("decimal(19,0)") if whole else F.lit(None).cast("decimal(19,0)")
        r = F.lit(None).cast("double") if whole else v.cast("double")
        sketch = F.hll_union_agg("u_" + name) if "u_" + name in kinds else F.lit(None).cast("binary")
        sums = (F.count(v), F.sum(d).cast("decimal(38,0)"), F.sum(d * d).cast("decimal(38,0)"), F.sum(r), F.sum(r * r))
        return F.struct(F.lit(name).alias("statistic"), *[x.alias(n) for n, x in zip(_SUMS, sums, strict=True)], F.min(v).cast("double").alias("lo"), F.max(v).cast("double").alias("hi"), sketch.alias("sketch"))

    return with_bucket(values, sizes).groupBy("bucket").agg(F.array(*[of(n) for n in names]).alias("x")).select("bucket", F.explode("x").alias("x")).select("bucket", "x.*")


def merged(parts: DataFrame) -> DataFrame:
    """States of parts of a stream as one for each bucket and statistic."""
    sketch = F.when(F.count("sketch") > 0, F.hll_union_agg("sketch")).alias("sketch")
    each = [f(c).alias(c) for f, cs in ((F.sum, _SUMS), (F.min, _LEAST), (F.max, _LARGEST)) for c in cs]
    return parts.groupBy("bucket", "statistic").agg(*each, sketch)


def unique_bounds(estimate: Column) -> tuple[Column, Column]:
    """Bounds two standard deviations away from an estimate of a sketch with 2**16 slots.

    A sketch keeps up to some 6,000 hashes themselves, and is then as good as exact.
    """
    few, e = estimate <= 3 * 2 ** (_LG_SLOTS - 5), estimate.cast("double")
    lower = F.when(few, F.ceil(e / (1 + _SIGMAS * _FEW_RSE))).otherwise(F.floor(e / (1 + _SIGMAS * _RSE)))
    upper = F.when(few, F.floor(e / (1 - _SIGMAS * _FEW_RSE))).otherwise(F.ceil(e / (1 - _SIGMAS * _RSE)))
    return lower.cast("long"), upper.cast("long")


def summaries_of(found: DataFrame, names: list[str], sizes: DataFrame, dense: bool = False) -> DataFrame:
    """Summaries with unique counts and bounds at each prefix, from the states of its buckets.

    With ``dense`` the elements of a prefix are as many as its size, and those that no state has seen have no statements: their values are 0.
    """
    asked = sizes.select("size", "is_full", F.explode(F.array(*[F.lit(n) for n in names])).alias("statistic"))
    rows = asked.join(found.withColumnRenamed("statistic", "of"), F.expr("size = bucket and statistic = of"), "left")
    upto = W.partitionBy("statistic").orderBy("size").rowsBetween(W.unboundedPreceding, 0)  # over at most seven rows
    sketched = F.count("sketch").over(upto) > 0
    estimate = F.when(sketched, F.hll_sketch_estimate(F.hll_union_agg("sketch").over(upto)))
    run = rows.select("size", "is_full", "statistic", *[f(c).over(upto).alias(c) for f, cs in ((F.sum, _SUMS), (F.min, _LEAST), (F.max, _LARGEST)) for c in cs], estimate.alias("unique_count"))
    if dense:
        counted = F.col("statistic") != "byte_density"
        unseen = counted & (F.col("size") > F.coalesce("n", F.lit(0)))
        zero = lambda c, f: F.when(unseen, f(F.coalesce(c, F.lit(0.0)), F.lit(0.0))).otherwise(F.col(c))
        run = run.withColumns({"n": F.when(counted, F.col("size")).otherwise(F.col("n")), "lo": zero("lo", F.least), "hi": zero("hi", F.greatest), "s": F.when(counted, F.coalesce("s", F.lit(0))), "ss": F.when(counted, F.coalesce("ss", F.lit(0)))})
    n, total, squares = F.nullif(F.col("n"), F.lit(0)), F.coalesce(F.col("s").cast("double"), "rs"), F.coalesce(F.col("ss").cast("double"), "rss")
    mean = total / n
    variance = squares / n - mean * mean
    lower, upper = unique_bounds(F.col("unique_count"))
    return run.select(
        "size",
        "is_full",
        F.coalesce("n", F.lit(0)).alias("n"),
        total.alias("sum"),
        F.round(mean, 6).alias("mean"),
        F.round(F.sqrt(F.greatest(variance, F.lit(0.0))), 4).alias("st_dev"),
        F.col("lo").alias("min"),
        F.col("hi").alias("max"),
        "statistic",
        "unique_count",
        lower.alias("unique_lower"),
        upper.alias("unique_upper"),
    )


_UNIQUE = ("unique_count", "unique_lower", "unique_upper")


def summaries(values: DataFrame, names: list[str], sizes: DataFrame) -> DataFrame:
    """``summary`` of each of the columns ``names`` of (element_id, ...), named by ``statistic``, from one pass over the elements."""
    return summaries_of(states(values, names, sizes), names, sizes).drop(*_UNIQUE)


def first_seen(values: DataFrame, sizes: DataFrame) -> DataFrame:
    """(x, bucket): the bucket in which each value of the arrays ``seen`` of (element_id, seen) comes first."""
    return with_bucket(values.select("element_id", F.explode("seen").alias("x")), sizes).groupBy("x").agg(F.min("bucket").alias("bucket"))


def with_listed(found: DataFrame, seen: DataFrame, sizes: DataFrame) -> DataFrame:
    """``found`` with the exact unique count of the statistic whose values are listed, and their list, from ``first_seen``."""
    upto = W.orderBy("size").rowsBetween(W.unboundedPreceding, 0)  # over at most seven rows
    new = seen.groupBy("bucket").agg(F.collect_list("x").alias("new"))
    lists = sizes.join(new, F.col("size") == F.col("bucket"), "left").select(F.col("size").alias("__size"), F.array_sort(F.flatten(F.collect_list(F.coalesce("new", F.array())).over(upto))).alias("values"))
    both = found.join(lists, (F.col("size") == F.col("__size")) & (F.col("statistic") == LISTED), "left").drop("__size")
    exact = F.size("values").cast("long")
    return both.withColumns({n: F.when(F.col("statistic") == LISTED, exact).otherwise(F.col(n)) for n in _UNIQUE[:1]})


def all_statistics(elements: DataFrame | None, quads: DataFrame, quoted: DataFrame | None = None, sizes: DataFrame | None = None, names: tuple[str, ...] = NAMES, dealt: bool = False) -> DataFrame:
    """All statistics at all prefixes with their unique counts: size, is_full, n, sum, mean, st_dev, min, max, statistic, unique_count, unique_lower,
    unique_upper, values.

    Statements are read and dealt once; an element's row holds its counts, a sketch for each statistic that has one, and its datatypes. Of
    the datatypes all are kept, so their number is exact and ``values`` names them.
    """
    sizes = prefix_sizes(elements) if sizes is None else sizes
    rows = settle(element_table(list(names), elements, quads, quoted, unique=True, dealt=dealt))
    found = summaries_of(states(rows, list(names), sizes), list(names), sizes)
    return with_listed(found, first_seen(rows, sizes), sizes) if LISTED in names else found.withColumn("values", F.lit(None).cast("array<string>"))


def summary(values: DataFrame, sizes: DataFrame) -> DataFrame:
    """size, is_full, n, sum, mean, st_dev (of the population), min and max of (element_id, value) at each prefix. Without values all but n and sum are null."""
    return summaries(values, ["value"], sizes).drop("statistic")


def prefix_unique(values: DataFrame, sizes: DataFrame) -> DataFrame:
    """(size, unique_count) of the different x at each prefix, exact: each x counts where it is first seen."""
    first = with_bucket(values, sizes).groupBy("x").agg(F.min("bucket").alias("bucket"))
    new = first.groupBy("bucket").agg(F.count("*").alias("new"))
    upto = W.orderBy("size").rowsBetween(W.unboundedPreceding, 0)
    return sizes.join(new, F.col("size") == F.col("bucket"), "left").select("size", F.coalesce(F.sum("new").over(upto), F.lit(0)).alias("unique_count"))


def prefix_unique_counts(names: list[str], quads: DataFrame, quoted: DataFrame | None, sizes: DataFrame) -> DataFrame:
    """(size, statistic, unique_count), exact, of the values that each of the statistics counts, from one scan: a value counts where it is first seen."""
    tests = [(n, *((F.col("role") == "g", F.col("value")) if n == "graphs" else _counted(n))) for n in names]
    marks = F.filter(F.array(*[F.when(which, F.struct(F.lit(n).alias("statistic"), what.alias("x"))) for n, which, what in tests]), lambda m: m.isNotNull())
    each = uses(statements(quads, quoted), default_graph="graphs" in names).select("element_id", F.explode(marks).alias("m")).select("element_id", "m.*")
    first = with_bucket(each, sizes).groupBy("statistic", "x").agg(F.min("bucket").alias("bucket"))
    new = first.groupBy("statistic", "bucket").agg(F.count("*").alias("new"))
    asked = sizes.select("size", F.explode(F.array(*[F.lit(n) for n in names])).alias("statistic"))
    upto = W.partitionBy("statistic").orderBy("size").rowsBetween(W.unboundedPreceding, 0)
    rows = asked.join(new.withColumnRenamed("statistic", "of"), F.expr("size = bucket and statistic = of"), "left")
    return rows.select("size", "statistic", F.coalesce(F.sum("new").over(upto), F.lit(0)).alias("unique_count"))


#: Standard deviations of the bounds; the relative error of a sketch with 2**16 slots, and of one that keeps its hashes.
_SIGMAS, _RSE, _FEW_RSE = 2.0, 1.04 / 2**8, 5e-5


def prefix_unique_approx(values: DataFrame, sizes: DataFrame) -> DataFrame:
    """(size, unique_count, unique_lower, unique_upper) by mergeable sketches; the bounds are two standard deviations away."""
    sketches = with_bucket(values, sizes).groupBy("bucket").agg(F.hll_sketch_agg("x", F.lit(16)).alias("sketch"))
    rows = sizes.join(sketches, F.col("size") == F.col("bucket"), "left")
    upto = W.orderBy("size").rowsBetween(W.unboundedPreceding, 0)
    estimate = rows.select("size", F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch").over(upto)), F.lit(0)).alias("unique_count"))
    lower, upper = unique_bounds(F.col("unique_count"))
    return estimate.select("size", "unique_count", lower.alias("unique_lower"), upper.alias("unique_upper"))


#: Statistics that were added, by name: functions (elements, quads, quoted) -> (element_id, value).
REGISTRY: dict[str, Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]] = {}


def register_statistic(name: str, values: Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]) -> None:
    """Add a statistic: ``values`` gives (element_id, value) for the elements that have one. A name of this module's own is replaced."""
    REGISTRY[name] = values


def prefix_stats(names: list[str], elements: DataFrame, quads: DataFrame, quoted: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """The summaries of several statistics, with their name as ``statistic``. Those of this module come from one scan."""
    sizes = prefix_sizes(elements) if sizes is None else sizes
    own = [n for n in names if n not in REGISTRY]
    tables = [summaries(element_table(own, elements, quads, quoted), own, sizes)] if own else []
    tables += [summary(REGISTRY[n](elements, quads, quoted), sizes).withColumn("statistic", F.lit(n)) for n in names if n in REGISTRY]
    return reduce(DataFrame.unionByName, tables)
