"""Set operations, renames and traversals over metadata graphs: quads keyed by ``name`` where there are several."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.terms import name_uuid
from tessera.sources.shared import dealt, settle

TRIPLE = ["s", "s_kind", "p", "o", "o_kind", "o_dt", "o_lang"]


def merge_graphs(*graphs: DataFrame) -> DataFrame:
    """G1: the union as a set of triples."""
    return reduce(DataFrame.unionByName, [g.select(*TRIPLE) for g in graphs]).distinct()


def merge_named_graphs(*datasets: DataFrame) -> DataFrame:
    """The union of named graphs; graphs of one name merge.

    Statements are dealt by graph and subject, not by all they hold, so that those with the same long names lie side by side and are shuffled well compressed.
    """
    return reduce(DataFrame.unionByName, [d.select("g", *TRIPLE) for d in datasets]).repartition("g", "s").distinct()


def remove_statements(graph: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """Without the statements that match; None matches all."""
    hit = reduce(lambda a, b: a & b, [F.coalesce(F.col(n) == v, F.lit(False)) for n, v in (("s", s), ("p", p), ("o", o)) if v is not None], F.lit(True))
    return graph.filter(~hit)


def remove_values_deep(graph: DataFrame, subjects: DataFrame, p: str) -> DataFrame:
    """Without (s, p, o) of the subjects (s), and without the statements about those o, one level deep."""
    roots = subjects.select("s", F.lit(True).alias("root")).distinct()
    below = graph.filter(F.col("p") == p).join(dealt(roots), "s", "left_semi").select(F.col("o").alias("s"), F.lit(False).alias("root")).distinct()
    # What goes depends on a statement's subject and property alone, so the graph is joined once, with a row for each subject.
    marks = roots.unionByName(below).groupBy(F.col("s").alias("__s")).agg(F.bool_or("root").alias("__root"), F.bool_or(~F.col("root")).alias("__below"))
    gone = F.col("__below") | (F.col("__root") & F.coalesce(F.col("p") == p, F.lit(False)))
    return graph.join(dealt(marks), F.col("s") == F.col("__s"), "left").filter(~F.coalesce(gone, F.lit(False))).select(*graph.columns)


def rename_resources(graph: DataFrame, renames: DataFrame, by: str | None = None) -> DataFrame:
    """Old to new of ``renames`` in subjects and objects, on both sides of a statement; predicates and graph names stay.

    With ``by``, the column of small elements by which the graph is dealt, the different resources of an element are looked up, and its
    statements stay where they are; without, the statements are joined with the renames by subject and by object.
    """
    new = renames.select("old", "new")
    if by is None:
        out = graph.join(new.toDF("old_s", "new_s"), F.col("s") == F.col("old_s"), "left")
        out = out.join(new.toDF("old_o", "new_o"), (F.col("o") == F.col("old_o")) & (F.col("o_kind") != "literal"), "left")
    else:
        terms = graph.select(by, F.explode(F.array("s", F.when(F.col("o_kind") != "literal", F.col("o")))).alias("old")).filter("old is not null").distinct()
        own = terms.join(dealt(new), "old").groupBy(by).agg(F.collect_list(F.struct("old", "new")).alias("__own"))
        news = lambda n, at: F.explode_outer(F.transform(F.filter("__own", lambda x: at & (x["old"] == F.col(n))), lambda x: x["new"]))
        out = graph.join(dealt(own), by, "left")
        out = out.select("*", news("s", F.lit(True)).alias("new_s"))
        out = out.select("*", news("o", F.col("o_kind") != "literal").alias("new_o"))
    fresh_kind = lambda old, new, kind: F.when(new.isNull(), kind).when(new.startswith("_:"), "bnode").otherwise("iri")  # noqa: E731, ARG005
    out = out.withColumns({"s_kind": fresh_kind(F.col("s"), F.col("new_s"), F.col("s_kind")), "o_kind": fresh_kind(F.col("o"), F.col("new_o"), F.col("o_kind"))})
    return out.withColumns({"s": F.coalesce("new_s", "s"), "o": F.coalesce("new_o", "o")}).select(*graph.columns)


def rename_namespace_to_bnodes(graph: DataFrame, prefix: str) -> DataFrame:
    """Each subject under ``prefix`` becomes a blank node with an id made from its IRI."""
    old = graph.filter(F.col("s").startswith(prefix)).select(F.col("s").alias("old")).distinct()
    return rename_resources(graph, old.withColumn("new", F.concat(F.lit("_:"), name_uuid(F.col("old")))))


def reachable(edges: DataFrame, *by: str) -> DataFrame:
    """(by, above, below, distance): the transitive closure of direct pairs (by, above, below) with the least number of steps; cycles end.

    Paths double: a pair of at most twice the known distance is a known pair of exactly that distance, then another known pair. So the number of
    rounds grows with the logarithm of the depth, and a pair that is known does not come again. Each round's new pairs are written
    to the shared folder, beside those before.
    """
    parts = [settle(edges.select(*by, "above", "below").distinct().withColumn("distance", F.lit(1).cast("long")))]
    far = 1
    while True:
        known = reduce(DataFrame.unionByName, parts)
        front = parts[-1].filter(F.col("distance") == far).select(*by, "above", F.col("below").alias("mid"))
        back = known.select(*by, F.col("above").alias("mid"), "below", (F.col("distance") + far).alias("distance"))
        found = front.join(back, [*by, "mid"]).groupBy(*by, "above", "below").agg(F.min("distance").alias("distance"))
        new = settle(found.join(known, [*by, "above", "below"], "left_anti"))
        if new.isEmpty():
            return known
        parts.append(new)
        far *= 2


def transitive_pairs(edges: DataFrame, depth: int = 10) -> DataFrame:
    """(above, below) of the transitive closure of direct pairs; see ``reachable``.

    A cycle, or a pair more than ``depth`` levels below its direct pairs, is an error.
    """
    pairs = reachable(edges)
    worst = pairs.agg(F.max("distance").alias("far"), F.max(F.col("above") == F.col("below")).alias("cycle")).first()
    if worst["cycle"] or (worst["far"] or 0) > depth + 1:
        raise ValueError(f"more than {depth} levels of nesting")
    return pairs.select("above", "below")


def closure_statements(pairs: DataFrame, superset: str, subset: str) -> DataFrame:
    """Both directions of the pairs as statements (s, p, o)."""
    both = F.array(
        F.struct(F.col("above").alias("s"), F.lit(superset).alias("p"), F.col("below").alias("o")),
        F.struct(F.col("below").alias("s"), F.lit(subset).alias("p"), F.col("above").alias("o")),
    )
    return pairs.select(F.explode(both).alias("t")).select("t.*").distinct()


#: Up to so many edges, doubled jumps are as cheap as a chain that is shortened first.
SMALL = 2**16


def _heads(node: str, at: int) -> Column:
    """A coin of a node in a round, the same wherever it is asked."""
    return F.xxhash64(F.lit(at), F.col(node)).bitwiseAND(1) == 1


def _shortened(graph: DataFrame, roots: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node, to) of the edges to blank nodes, less nodes on chains; and for each round the nodes taken out, with the one above: (node, above).

    ``roots`` (node) are different. A node that is none of them and has one edge to it is below just the roots that its upper node is below.
    If it leads on, a round takes it out where its coin shows heads and the upper one's tails, and hangs what it leads to on the upper
    one, which the round leaves in. So a chain loses a quarter of its edges in a round, and all rounds together move and write as much as
    a few rounds of all edges. Rounds end when few edges are left, or when fewer than a sixth would go, as in graphs that are not deep.
    """
    edges = settle(graph.filter(F.col("o_kind") == "bnode").select(F.col("s").alias("node"), F.col("o").alias("to")))
    if edges.count() <= SMALL:
        return edges.distinct(), []
    leads = edges.select(F.col("node").alias("to")).distinct().withColumn("leads", F.lit(True))
    own = roots.select(F.col("node").alias("to"), F.lit(True).alias("own"))
    marked = edges.repartition("to").distinct().withColumn("above", F.count("*").over(Window.partitionBy("to")))
    marked = marked.join(dealt(leads), "to", "left").join(dealt(own), "to", "left")
    left = settle(marked.select("node", "to", ((F.col("above") == 1) & F.col("leads").isNotNull() & F.col("own").isNull()).alias("inner")))
    rounds = []
    while True:
        at = len(rounds)
        cut = F.col("inner") & _heads("to", at) & ~_heads("node", at)
        n = left.agg(F.count("*").alias("all"), F.count_if(cut).alias("cut")).first()
        if n["all"] <= SMALL or n["cut"] * 6 < n["all"]:
            return left.select("node", "to"), rounds
        gone, stay = left.filter(cut).select(F.col("to").alias("node"), F.col("node").alias("above")), left.filter(~cut)
        moved = stay.filter(_heads("node", at)).join(dealt(gone), "node", "left").select(F.coalesce("above", "node").alias("node"), "to", "inner")
        rounds.append(gone)
        left = settle(moved.unionByName(stay.filter(~_heads("node", at))))


def blank_nodes_below(graph: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, node) of each root and of the blank nodes that it leads to, at any depth; cycles end.

    Long chains are shortened first, see ``_shortened``, and their nodes found last, below those that were found without them. In what is
    left jumps double: with the nodes nearer than 2**k steps known, jumps of exactly 2**k steps give those nearer than 2**(k + 1). So a
    chain of n blank nodes takes log n rounds, and its jumps are never more than n rows.
    """
    parts = [settle(roots.select("root", F.col("root").alias("node")).distinct())]
    jump, rounds = _shortened(graph, parts[0].select("node"))
    while True:
        known = reduce(DataFrame.unionByName, parts)
        new = settle(known.join(dealt(jump), "node").select("root", F.col("to").alias("node")).distinct().join(dealt(known), ["root", "node"], "left_anti"))
        if new.isEmpty():
            break
        parts.append(new)
        jump = settle(jump.join(dealt(jump.toDF("to", "further")), "to").select("node", F.col("further").alias("to")).distinct())
    for at in reversed(range(len(rounds))):
        above = reduce(DataFrame.unionByName, parts).filter(~_heads("node", at)).withColumnRenamed("node", "above")
        parts.append(settle(above.join(dealt(rounds[at]), "above").select("root", "node")))
    return reduce(DataFrame.unionByName, parts)


def subject_subgraph(graph: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, statement columns) of each root and of the blank nodes that it leads to; see ``blank_nodes_below``."""
    return blank_nodes_below(graph, roots).join(dealt(graph), F.col("node") == F.col("s")).select("root", *TRIPLE).distinct()


def label_lookup(subjects: DataFrame, graph: DataFrame, pref_label: str, label: str, override: str | None = None) -> DataFrame:
    """(s, label): override, else preferred label, else label, each English first, else the local name."""
    order = [p for p in (override, pref_label, label) if p]
    rank = reduce(lambda a, kp: a.when(F.col("p") == kp[1], kp[0]), enumerate(order[1:], 1), F.when(F.col("p") == order[0], 0))
    english = F.when(F.col("o_lang") == "en", 0).when(F.col("o_lang").isNull(), 1).otherwise(2)
    best = graph.filter(F.col("p").isin(*order) & (F.col("o_kind") == "literal")).groupBy("s").agg(F.min(F.struct(rank.alias("r"), english.alias("e"), "o")).alias("m"))
    return subjects.select("s").distinct().join(best, "s", "left").select("s", F.coalesce("m.o", F.regexp_extract("s", r"([^/#:]*)$", 1)).alias("label"))


def vocabulary_map(graph: DataFrame, types: DataFrame, properties: DataFrame, rdf_type: str, dataset: str, free: str, name: str, person: str) -> DataFrame:
    """Types (old, new) are translated and unmapped ones kept; properties (old, new, as_text) are translated and unmapped ones dropped.

    Spark broadcasts both tables where their size allows it. Resources under a property with ``as_text`` become strings. A type that
    becomes ``dataset`` adds (s, ``free``, "true"); a ``name`` adds the type ``person``.
    """
    null = F.lit(None).cast("string")
    boolean = "http://www.w3.org/2001/XMLSchema#boolean"
    typed = graph.filter(F.col("p") == rdf_type).join(types, F.col("o") == F.col("old"), "left").withColumn("o", F.coalesce("new", "o")).select(*TRIPLE)
    flags = typed.filter(F.col("o") == dataset).select("s", "s_kind", F.lit(free).alias("p"), F.lit("true").alias("o"), F.lit("literal").alias("o_kind"), F.lit(boolean).alias("o_dt"), null.alias("o_lang"))
    facts = graph.filter(F.col("p") != rdf_type)
    text = F.col("as_text") & (F.col("o_kind") != "literal")
    mapped = facts.join(properties, F.col("p") == F.col("old")).select(
        "s", "s_kind", F.col("new").alias("p"), "o", F.when(text, "literal").otherwise(F.col("o_kind")).alias("o_kind"), F.when(text, "http://www.w3.org/2001/XMLSchema#string").otherwise(F.col("o_dt")).alias("o_dt"), "o_lang"
    )
    people = facts.filter(F.col("p") == name).select("s", "s_kind", F.lit(rdf_type).alias("p"), F.lit(person).alias("o"), F.lit("iri").alias("o_kind"), null.alias("o_dt"), null.alias("o_lang"))
    return merge_graphs(typed, flags, mapped, people)


def catalog_links(catalog: str, members: DataFrame, link: Column, inverse: str | None = None) -> DataFrame:
    """(s, p, o) from the catalog to each member (member, ...) by ``link``, and back by ``inverse``."""
    out = members.select(F.lit(catalog).alias("s"), link.alias("p"), F.col("member").alias("o"))
    return out if inverse is None else out.unionByName(members.select(F.col("member").alias("s"), F.lit(inverse).alias("p"), F.lit(catalog).alias("o")))


def inverse_statements(graph: DataFrame, p: str, inverse: str) -> DataFrame:
    """Statements (s, p, o) the other way round, for one property."""
    return graph.filter(F.col("p") == p).select(F.col("o").alias("s"), F.lit(inverse).alias("p"), F.col("s").alias("o"))


def merge_dataset_metadata(manual: DataFrame, generated: DataFrame, usage: str, roots: DataFrame, renames: DataFrame) -> DataFrame:
    """The manual graph less its stream type usage, with the generated one, and with its temporary ids renamed."""
    return rename_resources(merge_graphs(remove_values_deep(manual, roots, usage), generated), renames)


def version_statements(datasets: DataFrame, distributions: DataFrame, modified: str) -> DataFrame:
    """(s, p, o) that a version adds: of datasets (dataset, version), and of distributions (dataset, distribution, file_name, local_id).

    Distributions are named dataset#local_id.
    """
    own = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in (("urn:p:version", F.col("version")), ("urn:p:landingPage", F.col("dataset")), ("urn:p:modified", F.lit(modified)))]))
    of_sets = datasets.select(F.col("dataset").alias("s"), own.alias("x")).select("s", "x.*")
    named = F.concat(F.col("dataset"), F.lit("#"), F.col("local_id"))
    url = F.concat(F.col("dataset"), F.lit("/files/"), F.col("file_name"))
    of_files = distributions.select(named.alias("s"), F.lit("urn:p:downloadURL").alias("p"), url.alias("o"))
    links = distributions.select(F.col("dataset").alias("s"), F.lit("urn:p:distribution").alias("p"), named.alias("o"))
    return of_sets.unionByName(of_files).unionByName(links)


def package_members(members: DataFrame, version: str, category: str, catalog: str, kind: str) -> DataFrame:
    """(s, p, o) of tasks or profiles (name, identifier) of a category: versioned name, version, links to category and catalog.

    A member whose identifier is not its name raises an error.
    """
    from tessera.functions.names import make_purl

    sound = F.when(F.col("identifier").eqNullSafe(F.col("name")), F.col("name")).otherwise(F.raise_error(F.concat(F.lit("identifier does not match "), F.col("name"))))
    purl = make_purl(F.lit(kind), F.col("sound"), F.lit(version))
    rows = members.select(sound.alias("sound")).select(purl.alias("new"))
    facts = F.array(
        F.struct(F.col("new").alias("s"), F.lit("urn:p:version").alias("p"), F.lit(version).alias("o")),
        F.struct(F.col("new").alias("s"), F.lit("urn:p:inCategory").alias("p"), F.lit(category).alias("o")),
        F.struct(F.lit(category).alias("s"), F.lit("urn:p:has").alias("p"), F.col("new").alias("o")),
        F.struct(F.col("new").alias("s"), F.lit("urn:p:inCatalog").alias("p"), F.lit(catalog).alias("o")),
    )
    return rows.select(F.explode(facts).alias("t")).select("t.*")
