"""Which datasets meet a profile, and which of their distributions: relational division on two levels.

A constraint looks at the values that a path of properties leads to from a focus node, inside what the node and its blank nodes say.
A focus node meets a profile if it breaks none of the constraints that say what values may be, and meets all of those that ask for
values; these are counted, so no focus node is paired with a profile that it has nothing of.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.graphs import TRIPLE, reachable, subject_subgraph
from tessera.sources.shared import dealt, settle

#: A constraint. ``path``: properties from the focus node; one that ends with * goes on as often as it can, or not at all. ``terms``: what
#: the constraint names, an IRI, a literal with its datatype and language, a class, a datatype, a kind or a number. ``n``: a count.
#: has_value: some value is the first term. in: each value is one of the terms. class: each value is of the first term's class.
#: min_of_class: at least ``n`` values are. min_count and max_count: ``n``. datatype, kind: of each value. ge, le: each value is a number
#: that is not below, or above, the first term.
CONSTRAINTS = "profile string, level string, id string, path array<string>, op string, n long, terms array<struct<value: string, kind: string, dt: string, lang: string>>"
#: Constraints that ask for values; the others are about each value that is there, and hold without any.
ASKING = ("has_value", "min_count", "min_of_class")
TERM = ("value", "kind", "dt", "lang")
_OBJECT = ("o", "o_kind", "o_dt", "o_lang")


def _terms(rows: DataFrame, *columns: str) -> DataFrame:
    """Statements with their objects under the names of TERM."""
    return rows.select(*columns, "s", "s_kind", "p", *[F.col(o).alias(t) for o, t in zip(_OBJECT, TERM, strict=True)])


def _closure(statements: DataFrame, properties: list[str], *by: str) -> DataFrame:
    """(by, p, node, value, kind): the nodes that one of the properties leads to, again and again."""
    edges = statements.filter(F.col("p").isin(properties) & (F.col("kind") != "literal"))
    node = lambda value, kind: F.struct(F.col(value).alias("value"), F.col(kind).alias("kind"))
    pairs = reachable(edges.select(*by, "p", node("s", "s_kind").alias("above"), node("value", "kind").alias("below")), *by, "p")
    return pairs.select(*by, "p", F.col("above.value").alias("node"), "below.value", "below.kind")


def values_at(facts: DataFrame, paths: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """(focus, path, value, kind, dt, lang): the different values at the end of each path (path) of each focus node that has some.

    facts (focus, statement columns) are what is said about each focus node and its blank nodes, ``context`` (statement columns) what is said for
    all of them. A step is a join on node and property, and there are as many as the longest path has. A starred property leads through a focus
    node's own nodes, then through those of the context; both closures are made beforehand, and literals are not reached by it.
    """
    stated = _terms(facts, "focus")
    shared = _terms(facts).limit(0) if context is None else _terms(context)
    listed = [r["path"] for r in paths.collect()]  # of the profiles, so few
    starred = sorted({p[:-1] for path in listed for p in path if p.endswith("*")})
    longest = max(map(len, listed), default=0)
    null = F.lit(None).cast("string")
    own_closure = _closure(stated, starred, "focus") if starred else None
    shared_closure = _closure(shared, starred) if starred and context is not None else None

    def along(at: DataFrame) -> DataFrame:
        """One plain property further."""
        from_node = at.filter("kind <> 'literal'").select("focus", "path", F.col("value").alias("s"), F.col("step").alias("p"))
        return from_node.join(dealt(stated), ["focus", "s", "p"]).select("focus", "path", *TERM).unionByName(from_node.join(shared, ["s", "p"]).select("focus", "path", *TERM))

    def star(at: DataFrame) -> DataFrame:
        """Any number of steps by a starred property."""
        now = at.select("focus", "path", *TERM, F.rtrim(F.col("step"), F.lit("*")).alias("p"))
        for closure, keys in ((own_closure and dealt(own_closure), ["focus", "p", "node"]), (shared_closure, ["p", "node"])):
            if closure is not None:
                moved = now.select("focus", "path", "p", F.col("value").alias("node")).join(closure, keys).select("focus", "path", "value", "kind", null.alias("dt"), null.alias("lang"), "p")
                now = now.unionByName(moved).distinct()
        return now.drop("p")

    first = F.get("path", F.lit(0))
    plain = paths.filter(~F.endswith(first, F.lit("*"))).select("path", first.alias("p"))
    now = stated.filter("s = focus").join(F.broadcast(plain), "p").select("focus", "path", *TERM)
    done = []
    if any(not path or path[0].endswith("*") for path in listed):
        others = paths.filter(F.coalesce(F.endswith(first, F.lit("*")), F.lit(True))).agg(F.collect_set("path").alias("paths"))  # one row of few paths
        kind = F.coalesce(F.min(F.when(F.col("s") == F.col("focus"), F.col("s_kind"))), F.lit("iri"))
        at_focus = facts.groupBy("focus").agg(kind.alias("kind")).crossJoin(F.broadcast(others)).select("focus", F.explode("paths").alias("path"), F.col("focus").alias("value"), "kind", null.alias("dt"), null.alias("lang"))
        done.append(at_focus.filter(F.size("path") == 0))
        now = now.unionByName(star(at_focus.filter(F.size("path") > 0).withColumn("step", first)))
    now = now.distinct()
    for k in range(1, longest + 1):
        if k == longest:
            done.append(now)
            break
        now = settle(now)
        done.append(now.filter(F.size("path") == k))
        moving = now.filter(F.size("path") > k).withColumn("step", F.get("path", F.lit(k)))
        now = along(moving.filter(~F.endswith("step", F.lit("*"))))
        if starred:
            now = now.unionByName(star(moving.filter(F.endswith("step", F.lit("*")))))
        now = now.distinct()
    return reduce(DataFrame.unionByName, done, now.limit(0)).distinct()


def classes_of(facts: DataFrame, context: DataFrame | None, rdf_type: str, subclass: str) -> DataFrame:
    """(focus, value, class): classes of nodes as facts and context state them, and all classes above those; ``focus`` is null for what the context says."""
    stated = _terms(facts, "focus")
    if context is not None:
        stated = stated.unionByName(_terms(context).withColumn("focus", F.lit(None).cast(facts.schema["focus"].dataType)))
    direct = stated.filter(F.col("p") == rdf_type).select("focus", F.col("s").alias("value"), F.col("value").alias("class")).distinct()
    above = _closure(stated, [subclass]).select(F.col("node").alias("class"), F.col("value").alias("upper"))
    return direct.unionByName(direct.join(above, "class").select("focus", "value", F.col("upper").alias("class"))).distinct()


def _number(text: Column) -> Column:
    return text.try_cast("double")


def conforming(facts: DataFrame, constraints: DataFrame, profiles: DataFrame, context: DataFrame | None, rdf_type: str, subclass: str) -> DataFrame:
    """(profile, focus) of the focus nodes that meet all constraints (profile, id, path, op, n, terms) of each of ``profiles`` (profile).

    ``facts`` must have a row for each focus node. A profile without constraints is met by all.
    """
    c = F.col
    constraints = F.broadcast(constraints)  # of the profiles, so few; each has the values of many focus nodes
    paths = constraints.select("path").distinct()
    of_classes = {"class", "min_of_class"} & {r["op"] for r in constraints.select("op").distinct().collect()}  # at most ten
    values = values_at(facts, paths, context).withColumn("at", F.struct(*TERM))
    values = settle(values) if of_classes else values
    met = values.join(constraints, "path").select("focus", "profile", "id", "op", "n", "terms", "at", *TERM)
    wanted = F.get("terms", F.lit(0))
    fits = (
        F.when(c("op") == "has_value", wanted.eqNullSafe(c("at")))
        .when(c("op") == "in", F.exists("terms", lambda t: t.eqNullSafe(c("at"))))
        .when(c("op") == "datatype", c("dt").eqNullSafe(wanted["value"]))
        .when(c("op") == "kind", c("kind") == wanted["value"])
        .when(c("op") == "ge", F.coalesce(_number(c("value")) >= _number(wanted["value"]), F.lit(False)))
        .when(c("op") == "le", F.coalesce(_number(c("value")) <= _number(wanted["value"]), F.lit(False)))
        .when(c("op").isin("min_count", "max_count"), F.lit(True))
        .otherwise(F.raise_error(F.concat(F.lit("unknown constraint "), c("op"))).cast("boolean"))
    )
    judged = met.filter(~c("op").isin("class", "min_of_class")).select("focus", "profile", "id", "op", "n", fits.alias("ok"))
    if of_classes:
        of_class = met.filter(c("op").isin("class", "min_of_class"))
        asked = of_class.select("focus", "profile", "id", "op", "n", "value", wanted["value"].alias("class"))
        classes = settle(classes_of(facts, context, rdf_type, subclass))
        own = classes.filter("focus is not null").withColumn("is", F.lit(True))
        shared = classes.filter("focus is null").select("value", "class").withColumn("is_shared", F.lit(True))
        member = asked.join(dealt(own), ["focus", "value", "class"], "left").join(shared, ["value", "class"], "left")
        judged = judged.unionByName(member.select("focus", "profile", "id", "op", "n", F.coalesce("is", "is_shared", F.lit(False)).alias("ok")))
    counted = settle(judged.groupBy("focus", "profile", "id", "op", "n").agg(F.count_if("ok").alias("fit"), F.count("*").alias("all")))
    asking = c("op").isin(*ASKING)
    broken = F.when(c("op") == "max_count", c("all") > c("n")).otherwise(~asking & (c("fit") < c("all")))
    answered = counted.filter(asking & (c("fit") >= F.when(c("op") == "has_value", 1).otherwise(c("n"))))
    # Asking for no value is no question.
    questions = constraints.filter(asking & ((c("op") == "has_value") | (c("n") > 0))).groupBy("profile").agg(F.count_distinct("id").alias("questions"))
    by_answers = answered.filter((c("op") == "has_value") | (c("n") > 0)).groupBy("profile", "focus").agg(F.count("*").alias("answers")).join(F.broadcast(questions), "profile").filter("answers = questions").select("profile", "focus")
    free = profiles.join(questions, "profile", "left_anti").agg(F.collect_set("profile").alias("profiles"))  # one row, of profiles that ask for nothing
    by_default = facts.select("focus").distinct().crossJoin(F.broadcast(free)).select(F.explode("profiles").alias("profile"), "focus")
    return by_answers.unionByName(by_default).join(dealt(counted.filter(broken).select("profile", "focus").distinct()), ["profile", "focus"], "left_anti")


def link_profiles(graph: DataFrame, shapes: DataFrame, constraints: DataFrame, context: DataFrame, dataset_class: str, distribution: str, rdf_type: str, subclass: str) -> DataFrame:
    """C4: (profile, dataset, distribution): the datasets that meet each profile, and their distributions that do; null where none does.

    ``graph`` are the statements about all datasets, with blank nodes that differ between datasets; ``shapes`` (profile, level) says which
    profiles have shapes for the level ``dataset`` and ``distribution``, and one that lacks either is an error; ``constraints`` are CONSTRAINTS.
    Datasets are judged with ``context``, a taxonomy of types and classes, and distributions without.
    """
    levels = shapes.groupBy("profile").agg(F.collect_set("level").alias("levels"))
    lacking = F.array_except(F.array(F.lit("dataset"), F.lit("distribution")), F.col("levels"))
    sound = F.when(F.size(lacking) == 0, F.col("profile")).otherwise(F.raise_error(F.concat(F.lit("no shape for the "), F.get(lacking, F.lit(0)), F.lit(" in profile "), F.col("profile"))))
    profiles = settle(levels.select(sound.alias("profile")))
    rules = settle(constraints)

    def judge(focus: DataFrame, level: str, context: DataFrame | None) -> DataFrame:
        facts = settle(subject_subgraph(graph, focus.select(F.col("focus").alias("root"))).withColumnRenamed("root", "focus"))
        # A focus node of which nothing is said has no values, but may meet a profile.
        silent = focus.join(dealt(facts.select("focus").distinct()), "focus", "left_anti").select("focus", *[F.lit(None).cast("string").alias(c) for c in TRIPLE])
        return conforming(facts.unionByName(silent), rules.filter(F.col("level") == level).drop("level"), profiles, context, rdf_type, subclass)

    datasets = graph.filter((F.col("p") == rdf_type) & (F.col("o") == dataset_class)).select(F.col("s").alias("focus")).distinct()
    matches = settle(judge(datasets, "dataset", context).withColumnRenamed("focus", "dataset"))
    links = graph.filter((F.col("p") == distribution) & (F.col("o_kind") != "literal")).select(F.col("s").alias("dataset"), F.col("o").alias("focus")).join(dealt(matches.select("dataset").distinct()), "dataset", "left_semi")
    links = settle(links.distinct())
    fitting = judge(links.select("focus").distinct(), "distribution", None).join(dealt(links), "focus").select("profile", "dataset", F.col("focus").alias("distribution"))
    return matches.join(dealt(fitting), ["profile", "dataset"], "left")
