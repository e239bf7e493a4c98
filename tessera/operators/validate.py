"""Validation: every operator gives a table of violations, (element_id, rule, message) or (subject, rule, message).

All rules are looked at; none stops at the first hit. ``strict`` raises on the first row instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.patterns import with_following
from tessera.sources.shared import dealt


def strict(violations: DataFrame) -> DataFrame:
    """The same rows, but an error as soon as there is one."""
    return violations.filter(F.raise_error(F.concat_ws(": ", *[F.col(c).cast("string") for c in violations.columns])).isNull())


def _found(rows: DataFrame, rule: str, message: str | Column) -> DataFrame:
    return rows.select("element_id", F.lit(rule).alias("rule"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def structure_violations(
    elements: DataFrame,
    quads: DataFrame,
    *,
    triple_stream: bool = False,
    named_graph_stream: bool = False,
    temporal_property: str | None = None,
    subjects: DataFrame | None = None,
    generalized_datasets: bool = False,
    generalized_triples: bool = False,
    rdf_star: bool = False,
) -> DataFrame:
    """I1 to I7 in one aggregation by element: what the declared stream does not allow.

    ``subjects``: (element_id, node) of the subject nodes by shapes, see ``subject_nodes``. Elements without statements are seen.
    """
    c = F.col
    flags = quads.groupBy("element_id").agg(
        F.count_distinct("g").alias("graphs"),
        F.sum((c("g_kind") == "literal").cast("int")).alias("literal_graphs"),
        F.sum(((c("s_kind") == "literal") | c("p_kind").isin("literal", "bnode")).cast("int")).alias("generalized"),
        F.sum(reduce(lambda a, b: a | b, [F.coalesce(c(k + "_kind") == "triple", F.lit(False)) for k in "gspo"]).cast("int")).alias("stars"),
    )
    flags = elements.select("element_id").join(flags, "element_id", "left").na.fill(0)
    checks: list[tuple[str, Column, Column]] = []
    out: list[DataFrame] = []
    if triple_stream:
        checks.append(("no_named_graphs", c("graphs") > 0, F.lit("named graphs in a triple stream")))
    elif named_graph_stream:
        checks.append(("exactly_one_named_graph", c("graphs") != 1, F.lit("not exactly one named graph")))
        if temporal_property is not None:
            names = quads.filter("g is not null").select("element_id", F.col("g").alias("name")).distinct()
            single = names.join(flags.filter("graphs = 1").select("element_id"), "element_id", "left_semi")
            stamps = quads.filter(c("g").isNull() & (c("p") == temporal_property)).select("element_id", F.col("s").alias("name"), "o")
            times = single.join(stamps, ["element_id", "name"], "left").groupBy("element_id").agg(F.count("o").alias("times"))
            text = F.when(c("times") == 0, "the temporal property is not present").otherwise("the temporal property is present multiple times")
            out.append(_found(times.filter("times <> 1"), "temporal_property_once", text))
    if subjects is not None:
        nodes = elements.select("element_id").join(subjects.distinct().groupBy("element_id").agg(F.count("*").alias("nodes")), "element_id", "left").na.fill(0)
        text = F.when(c("nodes") == 0, "the subject node is not present").otherwise("the subject node is present multiple times")
        out.append(_found(nodes.filter("nodes <> 1"), "subject_node_once", text))
    if not generalized_datasets:
        checks.append(("literal_graph_names", c("literal_graphs") > 0, F.lit("a graph name is a literal")))
    if not generalized_triples:
        checks.append(("generalized_triples", c("generalized") > 0, F.lit("a generalized triple is not declared")))
    if not rdf_star:
        checks.append(("undeclared_quoted_triples", c("stars") > 0, F.lit("a quoted triple is not declared")))
    hits = F.filter(F.array(*[F.when(bad, F.struct(F.lit(rule).alias("rule"), text.alias("message"))) for rule, bad, text in checks]), lambda x: x.isNotNull()) if checks else None
    if hits is not None:
        out.append(flags.select("element_id", F.explode(hits).alias("v")).select("element_id", "v.*"))
    return reduce(DataFrame.unionByName, out)


SHAPES = {
    "target_class": lambda quads, quoted, iri, rdf_type: quads.filter((F.col("p") == rdf_type) & (F.col("o") == iri)).select("element_id", F.col("s").alias("node")),
    "target_subjects_of": lambda quads, quoted, iri, rdf_type: quads.filter(F.col("p") == iri).select("element_id", F.col("s").alias("node")),
    "target_objects_of": lambda quads, quoted, iri, rdf_type: quads.filter(F.col("p") == iri).select("element_id", F.col("o").alias("node")),
    "quoted_subject": lambda quads, quoted, iri, rdf_type: quoted.filter("path = 's'").select("element_id", F.col("s").alias("node")),
}


def register_shape(kind: str, find) -> None:
    """Add a kind of subject shape: ``find(quads, quoted, iri, rdf_type)`` gives (element_id, node)."""
    SHAPES[kind] = find


def subject_nodes(quads: DataFrame, shapes: list[tuple[str, str | None]], quoted: DataFrame | None = None, rdf_type: str = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type") -> DataFrame:
    """(element_id, node) of the nodes that one of the shapes (kind, IRI) selects, as a set."""
    return reduce(DataFrame.unionByName, [SHAPES[kind](quads, quoted, iri, rdf_type) for kind, iri in shapes]).distinct()


def metadata_consistency(info: DataFrame) -> DataFrame:
    """I8: (identifier, rule) of each of seven rules that a dataset_info row breaks."""
    c = F.col
    triple = F.exists("stream_types", lambda t: t.isin("graphStream", "subjectGraphStream", "flatTripleStream"))
    odd = c("uses_gen_datasets") | c("uses_gen_triples") | c("uses_star")
    rules = (
        ("rdf11_with_nonstandard_feature", c("conforms_rdf11") & odd),
        ("star_draft_without_use", ~c("conforms_rdf11") & c("conforms_star") & ~c("uses_star")),
        ("rdf11_without_star_draft", c("conforms_rdf11") & ~c("conforms_star")),
        ("generalized_datasets_in_triple_stream", c("uses_gen_datasets") & triple),
        ("invalid_element_count", c("element_count") <= 0),
        ("no_temporal_property", c("temporal_prop").isNull() & F.array_contains("stream_types", "timestampedNamedGraphStream")),
        ("no_subject_shape", ~c("has_subject_shape") & F.array_contains("stream_types", "subjectGraphStream")),
    )
    hits = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(rule)) for rule, bad in rules]), lambda x: x.isNotNull())
    return info.select("identifier", F.explode(hits).alias("rule"))


def archive_count(entries: DataFrame, declared: DataFrame) -> DataFrame:
    """(archive, rule, message) where an archive of ``declared`` (archive, element_count) is empty or has another count."""
    n = declared.join(entries.groupBy("archive").agg(F.count("*").alias("n")), "archive", "left").na.fill(0, ["n"])
    text = F.when(F.col("n") == 0, "the archive is empty").otherwise(F.concat(F.lit("expected "), F.col("element_count").cast("string"), F.lit(" files, found "), F.col("n").cast("string")))
    return n.filter((F.col("n") == 0) | (F.col("n") != F.col("element_count"))).select("archive", F.lit("archive_count").alias("rule"), text.alias("message"))


def sequence_gaps(entries: DataFrame, number: str = "number", position: str = "pos", by: str = "archive") -> DataFrame:
    """(archive, after, missing) where the next number in order of position is not one more. The first number is free."""
    return with_following(entries, number, by, position).filter(F.col("following") != F.col(number) + 1).select(by, F.col(number).alias("after"), (F.col(number) + 1).alias("missing"))


def archive_names(entries: DataFrame, triple_stream: bool, clean: DataFrame | None = None) -> DataFrame:
    """(archive, path) of names that are not ten digits and ttl (triple streams) or trig; only of archives in ``clean`` if given."""
    bad = entries.filter(~F.col("path").rlike(r"(^|/)[0-9]{10}\." + ("ttl" if triple_stream else "trig") + "$"))
    return (bad if clean is None else bad.join(clean, "archive", "left_semi")).select("archive", "path")


def cap(violations: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """the first n violations, for a report."""
    return violations.orderBy(*order).limit(n)


def identifier_matches_name(names: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(name, rule): names without root or identifier, or with another; ``identifiers`` is (name, identifier)."""
    joined = names.join(identifiers, "name", "left")
    rule = F.when(F.col("identifier").isNull(), "missing_identifier").when(F.col("identifier") != F.col("name"), "identifier_differs")
    return joined.withColumn("rule", rule).filter("rule is not null").select("name", "rule")


def constraint_violations(targets: DataFrame, facts: DataFrame, constraints: DataFrame) -> DataFrame:
    """(profile, target, property, op) of the constraints that a target breaks.

    targets (target, class), facts (target, property, kind, datatype, value), constraints (profile, class, property, op, value). Operators:
    min_count, max_count, kind, datatype, pattern, in (values joined by |). Each target meets the
    constraints of its class only, and facts join on target and property.
    """
    asked = targets.join(F.broadcast(constraints.withColumnRenamed("value", "want")), "class")  # few, and of few classes, so that no task gets all targets of one
    met = asked.join(dealt(facts), ["target", "property"], "left")
    c = F.col
    ok = (
        F.when(c("value").isNull(), True)
        .when(c("op") == "kind", c("kind") == c("want"))
        .when(c("op") == "datatype", c("datatype") == c("want"))
        .when(c("op") == "pattern", F.expr("value RLIKE want"))
        .when(c("op") == "in", F.array_contains(F.split("want", r"\|"), c("value")))
        .otherwise(True)
    )
    counted = met.groupBy("profile", "target", "property", "op", "want").agg(F.count("value").alias("n"), F.bool_and(F.coalesce(ok, F.lit(False))).alias("ok"))
    broken = F.when(c("op") == "min_count", c("n") < c("want").cast("long")).when(c("op") == "max_count", c("n") > c("want").cast("long")).otherwise(~c("ok"))
    # Casts of words are not met: the branches above look at numbers only.
    return counted.withColumn("want", F.when(c("op").isin("min_count", "max_count"), c("want")).otherwise("0")).filter(broken).select("profile", "target", "property", "op")


def rootless(names: DataFrame, quads: DataFrame, root_class: str, rdf_type: str) -> DataFrame:
    """I16: (name, rule): names whose graph is empty, or has no root of the class."""
    size = quads.groupBy("name").agg(F.count("*").alias("n"), F.max(((F.col("p") == rdf_type) & (F.col("o") == root_class)).cast("int")).alias("root"))
    rule = F.when(F.col("n").isNull(), "empty").when(F.col("root") == 0, "no_root")
    return names.join(size, "name", "left").withColumn("rule", rule).filter("rule is not null").select("name", "rule")


def parse_check(lines: DataFrame) -> DataFrame:
    """(file, line, text) of the lines of a flat file that are no statement; see ``sources.files.parse_lines``."""
    from tessera.sources.files import is_blank, parse_lines

    return parse_lines(lines.filter(~is_blank(F.col("text")))).filter("s is null").select("file", "line", "text")


def combined(checks: list) -> DataFrame:
    """K5: the union of the tables of violations that functions without arguments give."""
    return reduce(DataFrame.unionByName, [check() for check in checks])
