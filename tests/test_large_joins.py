"""What is broadcast, and what is dealt over tasks, by the plans; and rows that come to a join once."""

import glob
import random

from pyspark.sql import functions as F

from tessera.llm import neardup
from tessera.operators import degrees, graphs, profiles, stats, validate
from tessera.plans import graph_queries, quad_queries, stat_queries
from tessera.sources import files
from tessera.sources.views import QUADS, VIEWS, by_element


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_distributions_are_not_broadcast(spark, sf_dir):
    assert "Broadcast" not in plan(graph_queries.c2_distribution_stats(spark, sf_dir))


def test_a_release_comes_once(spark, sf_dir):
    rows = graph_queries._releases(spark, sf_dir)
    assert rows.count() == rows.distinct().count() > 0


def test_targets_and_facts_are_not_broadcast(spark):
    targets = spark.range(9).select(F.col("id").alias("target"), F.lit("Part").alias("class"))
    facts = targets.select("target", F.lit("a").alias("property"), F.lit("literal").alias("kind"), F.lit("string").alias("datatype"), F.lit("x").alias("value"))
    rules = spark.createDataFrame([("r", "Part", "a", "in", "y")], "profile string, class string, property string, op string, value string")
    found = validate.constraint_violations(targets, facts, rules)
    assert plan(found).count("BroadcastExchange") == 1 and "SortMergeJoin [target" in plan(found)
    assert found.count() == 9


def test_values_are_not_broadcast_for_a_list_of_constraints(spark):
    facts = spark.createDataFrame([(1, None, None, f"urn:{k}", "iri", "urn:p", "iri", str(k), "literal", None, None) for k in range(5)], QUADS).withColumn("focus", F.col("s"))
    rules = spark.createDataFrame([("r", "dataset", "one", ["urn:p"], "ge", None, [("3", "literal", None, None)]), ("r", "dataset", "two", ["urn:p"], "min_count", 1, [])], profiles.CONSTRAINTS)
    seen, settle = [], profiles.settle
    profiles.settle = lambda df: seen.append(plan(df)) or settle(df)
    try:
        found = profiles.conforming(facts, rules, rules.select("profile").distinct(), None, "urn:type", "urn:sub")
        assert {r["focus"] for r in found.collect()} == {"urn:3", "urn:4"}
    finally:
        profiles.settle = settle
    joins = [line for p in seen for line in p.splitlines() if "Join [path" in line]
    assert joins and all("BroadcastHashJoin" in line and "BuildRight" in line for line in joins)


def test_one_large_element_is_written_by_several_tasks(spark, tmp_path):
    q = spark.range(4000).select(F.lit(0).cast("long").alias("element_id"), F.concat(F.lit("urn:"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("s")).crossJoin(spark.createDataFrame([(None, None, "iri", "urn:p", "iri", "urn:o", "iri", None, None)], "g string, g_kind string, s_kind string, p string, p_kind string, o string, o_kind string, o_dt string, o_lang string"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_flat(q, str(tmp_path / "flat"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    parts = sorted(glob.glob(str(tmp_path / "flat" / "part-*")))
    lines = [[r[0] for r in spark.read.text(p).collect()] for p in parts]
    assert sum(map(bool, lines)) > 1 and (whole := sum(lines, [])) == sorted(whole) and len(whole) == 4000


def test_degrees_of_statements_that_repeat_and_nodes_in_several_places(spark):
    rows = [(e, g, "iri" if g else None, "a", "iri", "p", "iri", o, "iri", None, None) for e, g, o in ((0, "a", "a"), (1, "a", "a"), (2, None, "a"), (3, "g", "b"))]
    q = spark.createDataFrame(rows, QUADS)
    found = {(r["role"], r["node"]): (r["occurrences"], r["distinct_statements"]) for r in degrees.degree_distribution(q).collect()}
    assert found == {("subject", "<a>"): (4, 3), ("predicate", "<p>"): (4, 3), ("object", "<a>"): (3, 2), ("object", "<b>"): (1, 1), ("graph", "<a>"): (2, 1), ("graph", "<g>"): (1, 1)}
    found = {r["node"]: (r["occurrences"], r["distinct_statements"]) for r in degrees.degree_distribution(q, detailed=False).collect()}
    assert found == {"<a>": (9, 3), "<p>": (4, 3), "<b>": (1, 1), "<g>": (1, 1)}


def test_statements_are_dealt_before_the_uses_of_their_nodes(spark, sf_dir):
    for detailed in (True, False):
        text = plan(degrees.degree_distribution(VIEWS["q_events"](spark, sf_dir), detailed))
        assert text.count("Exchange hashpartitioning") == 2 and "hashpartitioning(subject" in text


def test_removal_joins_the_graph_once(spark):
    rows = [(0, None, None, s, "iri", p, "iri", o, "iri", None, None) for s, p, o in (("a", "p", "x"), ("a", "q", "y"), ("b", "p", "x"), ("b", "p", "y"), ("x", "r", "z"), ("y", "r", "z"), ("z", "p", "x"))]
    q = spark.createDataFrame(rows, QUADS)
    left = graphs.remove_values_deep(q, spark.createDataFrame([("a",), ("z",), ("a",)], "s string"), "p")
    assert plan(left).count("LeftAnti") == 0 and plan(left).count("LeftOuter") == 1
    assert {(r["s"], r["p"], r["o"]) for r in left.collect()} == {("a", "q", "y"), ("b", "p", "x"), ("b", "p", "y"), ("y", "r", "z")}
    assert left.count() == 4 and left.columns == q.columns


def test_sets_of_one_key_are_not_copied(spark):
    """All sets of a key that is not split meet in one group."""
    rest = spark.range(1500).select("id", F.col("id").alias("component"), F.lit(7).cast("long").alias("key"), F.lit(1500).cast("long").alias("n"), F.lit(b"").alias("long"), F.lit(0).alias("place"), F.array().cast("array<long>").alias("u"), F.array().cast("array<long>").alias("v"))
    found = neardup._grouped(rest)
    assert found.count() == 1500 and found.select("group").distinct().count() == 1 and found.filter("single").count() == 1500
    several = neardup._grouped(rest.withColumn("n", F.lit(neardup.BLOCK + 1).cast("long")))
    assert several.count() == 3000 and several.select("group").distinct().count() == 3


def test_statements_of_an_element_are_dealt_as_rows_of_tables(spark, sf_dir):
    text = plan(quad_queries.a4_flat_lines(spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 3 and "hashpartitioning(element_id" not in text


def test_statistics_of_dealt_statements_shuffle_no_statements(spark, sf_dir):
    elements, quads, quoted = stat_queries.inputs(spark, sf_dir, "q_orders", "orders", "o_orderkey")
    text = plan(stats.element_table(["objects", "literals"], None, quads, quoted, dealt=True))
    assert "hashpartitioning(element_id" not in text and text.count("Exchange hashpartitioning") == 3


def test_a_single_role_makes_one_use_of_a_statement(spark):
    q = spark.createDataFrame([(0, "g", "iri", "a", "iri", "p", "iri", str(k), "literal", None, None) for k in range(3)], QUADS)
    assert stats.uses(stats.statements(q), roles=stats._roles("objects")).count() == 3
    assert stats.element_table(["objects"], None, q).first()["objects"] == 3


def test_small_rows_of_which_much_is_made_are_spread(spark, sf_dir):
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert f"RoundRobinPartitioning({n})" in plan(graph_queries.l9_distributions_to_statements(spark, sf_dir))
    assert f"RoundRobinPartitioning({n})" in plan(quad_queries.a3_quoted_depths(spark, sf_dir))
    assert "hashpartitioning(event_id" in plan(by_element("q_events", spark, sf_dir))


def test_degrees_of_roles_and_of_any_come_from_one_pass(spark, sf_dir):
    rows = [(e, g, "iri" if g else None, "a", "iri", "p", "iri", o, "iri", None, None) for e, g, o in ((0, "a", "a"), (1, "a", "a"), (2, None, "a"), (3, "g", "b"))]
    q = spark.createDataFrame(rows, QUADS)
    whole = [{(r["role"], r["node"]): (r["occurrences"], r["distinct_statements"]) for r in degrees.degree_distribution(q, detailed).collect()} for detailed in (True, False)]
    found = {(role, r["node"]): tuple(r[role]) for r in degrees.node_degrees(q).collect() for role in (*degrees.ROLES, "statement") if r[role]}
    assert found == whole[0] | whole[1] and len(found) == 10
    text = plan(stat_queries.d18_degree_sketches(spark, sf_dir))
    assert text.count("hashpartitioning(subject") == 1 and "hashpartitioning(role, node" not in text


def test_renames_by_element_move_no_statements(spark, sf_dir):
    text = plan(quad_queries.g5_rename_resource(spark, sf_dir))
    assert "hashpartitioning(s," not in text and "hashpartitioning(o," not in text and "hashpartitioning(old" in text
    rows = [(e, None, None, s, "iri", "a", "iri", o, k, None, None) for e, s, o, k in ((0, "a", "a", "iri"), (0, "a", "a", "literal"), (1, "b", "a", "iri"), (1, "b", "c", "bnode"), (2, "d", "d", "iri"))]
    q = spark.createDataFrame(rows, QUADS)
    renames = spark.createDataFrame([("a", "x"), ("b", "_:y"), ("b", "z"), ("e", "w")], "old string, new string")
    found = sorted(map(tuple, graphs.rename_resources(q, renames, by="element_id").collect()), key=str)
    assert found == sorted(map(tuple, graphs.rename_resources(q, renames).collect()), key=str) and len(found) == 7


def test_a_line_is_matched_and_named_once(spark, tmp_path):
    top = tmp_path / "members"
    for at, n in (("member=profile-a.nq/part-0", 1), ("profile-b.nt", 2), ("deep/members/c.nq", 1), ("template.nq/part-0", 5)):
        (top / at).parent.mkdir(parents=True, exist_ok=True)
        (top / at).write_text("".join(f'<urn:{k}>\t<urn:p>\x0b"a b"@en .\n' for k in range(n)))
    found = files.load_collection(spark, str(top))
    assert sorted((r["name"], r["s"], r["o"], r["o_lang"]) for r in found.collect()) == [("a", "urn:0", "a b", "en"), ("b", "urn:0", "a b", "en"), ("b", "urn:1", "a b", "en"), ("deep", "urn:0", "a b", "en")]
    text = plan(found)
    assert text.count("Generate explode") == 2 and "regexp_extract(" not in text


def test_elements_without_root_go_before_statements_are_dealt(spark, sf_dir):
    seen, settle = [], graph_queries.settle
    graph_queries.settle = lambda df: seen.append(plan(df)) or settle(df)
    try:
        graph_queries.c13_subject_subgraph(spark, sf_dir)
    finally:
        graph_queries.settle = settle
    assert len(seen) == 1 and "LeftSemi" in seen[0] and "hashpartitioning(element_id" not in seen[0]


def test_named_graphs_are_dealt_by_graph_and_subject(spark):
    rows = [(e, g, "iri" if g else None, "a", "iri", "p", "iri", o, "iri", None, None) for e, g, o in ((0, "g", "x"), (1, "g", "x"), (2, None, "x"), (3, "g", "y"), (4, None, "x"))]
    q = spark.createDataFrame(rows, QUADS)
    found = graphs.merge_named_graphs(q, q.filter("element_id > 2"))
    text = plan(found)
    assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(g" in text and "s_kind" not in text.split("hashpartitioning(")[1].split(")")[0]
    assert sorted((r["g"] or "", r["o"]) for r in found.collect()) == [("", "x"), ("g", "x"), ("g", "y")]


def test_chains_are_shortened_before_jumps_double(spark, monkeypatch):
    """What the rounds write of a chain and a cycle is a few times their edges, not their edges for each doubling of the length."""
    chain = [("c", "c0"), *[(f"c{k}", f"c{k + 1}") for k in range(299)]]
    cycle = [("d", "d0"), *[(f"d{k}", f"d{(k + 1) % 300}") for k in range(300)]]
    g = spark.createDataFrame([(s, o, "bnode") for s, o in chain + cycle], "s string, o string, o_kind string")
    written, settle = [], graphs.settle

    def counted(df):
        out = settle(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(graphs, "settle", counted)
    monkeypatch.setattr(graphs, "SMALL", 40, raising=False)
    found = [tuple(r) for r in graphs.blank_nodes_below(g, spark.createDataFrame([("c",), ("d",)], "root string")).collect()]
    assert len(found) == 602 and set(found) == {(x, x) for x in "cd"} | {(x, f"{x}{k}") for x in "cd" for k in range(300)}
    assert sum(written) < 7 * 601


def test_shortened_graphs_lead_to_the_same_nodes(spark, monkeypatch):
    """Chains with side chains, cycles, loops, nodes with several edges to them, repeated edges, and roots inside of them."""
    monkeypatch.setattr(graphs, "SMALL", 0, raising=False)
    chance = random.Random(27)
    edges = [(f"{x}{k}", f"{x}{k + 1}") for x in "abef" for k in range(40)] + [("e40", "e0"), ("f40", "f7"), ("a3", "a3"), ("f20", "f20"), ("h1", "h0"), ("h0", "h1"), ("a40", "e9"), ("b40", "e9"), ("b5", "b6")]
    edges += [(f"{chance.choice('abef')}{chance.randrange(41)}", f"g{k}") for k in range(20)] + [(f"g{k}", f"i{k}") for k in range(20)]
    roots = ["a0", "a17", "b0", "f0", "f30", "e20", "g4", "x"]
    want = set()
    for root in roots:
        front = [root]
        while front:
            if (pair := (root, front.pop())) not in want:
                want.add(pair)
                front += [o for s, o in edges if s == pair[1]]
    g = spark.createDataFrame([(s, o, "bnode") for s, o in edges] + [("a1", "z", "iri")], "s string, o string, o_kind string")
    rounds = graphs._shortened(g, spark.createDataFrame([(r,) for r in roots], "node string"))[1]
    found = [tuple(r) for r in graphs.blank_nodes_below(g, spark.createDataFrame([(r,) for r in roots + ["a0"]], "root string")).collect()]
    assert len(rounds) > 1 and len(found) == len(want) and set(found) == want


def test_graphs_that_are_not_deep_are_not_shortened(spark, monkeypatch):
    monkeypatch.setattr(graphs, "SMALL", 0, raising=False)
    g = spark.createDataFrame([(f"r{k}", f"b{k}_{i}", "bnode") for k in range(30) for i in range(4)], "s string, o string, o_kind string")
    assert graphs._shortened(g, spark.createDataFrame([(f"r{k}",) for k in range(30)], "node string"))[1] == []


def test_sketches_of_a_node_are_one_row(spark, sf_dir):
    """Nothing is written between, a table of sketches is shuffled once, and its rows are those of the tables by role."""
    seen, settle = [], stat_queries.settle
    stat_queries.settle = lambda df: seen.append(df) or settle(df)
    try:
        text = plan(stat_queries.d18_degree_sketches(spark, sf_dir))
    finally:
        stat_queries.settle = settle
    assert not seen and text.count("hashpartitioning(node") == 3
    rows = [(e, g, "iri" if g else None, "a", "iri", "p", "iri", o, "iri", None, None) for e, g, o in ((0, "a", "a"), (1, "a", "a"), (2, None, "a"), (3, "g", "b"), *[(k, None, f"o{k % 5000}") for k in range(6000)])]
    q = spark.createDataFrame(rows, QUADS)
    halves = [degrees.node_sketches(q.filter(f"element_id % 2 = {k}")).select("node", *[F.col(r).alias(f"{r}{k}") for r in degrees.ROLES]) for k in (0, 1)]
    merged = halves[0].join(halves[1], "node", "full").select("node", *[degrees.united(F.col(f"{r}0"), F.col(f"{r}1")).alias(r) for r in degrees.ROLES])
    merged = merged.withColumn("statement", degrees.in_any_role([F.col(r) for r in degrees.ROLES]))
    found = {(role, r["node"]): (r[role]["occurrences"], r[role]["n"]) for r in merged.select("node", *[F.when(F.col(r).isNotNull(), F.struct(F.col(r)["occurrences"].alias("occurrences"), F.theta_sketch_estimate(F.col(r)["sketch"]).alias("n"))).alias(r) for r in (*degrees.ROLES, "statement")]).collect() for role in (*degrees.ROLES, "statement") if r[role]}
    tables = degrees.sketch_table(q)
    want = {(r["role"], r["node"]): (r["occurrences"], r["n"]) for detailed in (True, False) for r in degrees.merged_sketches(tables, detailed).select("role", "node", "occurrences", F.theta_sketch_estimate("sketch").alias("n")).collect()}
    assert found.keys() == want.keys() and all(found[k][0] == want[k][0] and abs(found[k][1] - want[k][1]) <= 0.05 * want[k][1] for k in want)
    assert {k: v for k, v in found.items() if v[1] < 4000} == {k: v for k, v in want.items() if v[1] < 4000} and found["statement", "<p>"][0] == 6004


def test_members_of_a_collection_are_written_compressed(spark, sf_dir, monkeypatch):
    from tessera.sources import shared

    made, shared_folder = [], shared.shared_folder
    monkeypatch.setattr(shared, "shared_folder", lambda s: made.append(shared_folder(s)) or made[-1])
    found = quad_queries.a15_load_collection(spark, sf_dir)
    parts = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(made[0]).select("path").collect()]
    lines = spark.read.option("recursiveFileLookup", "true").text(made[0])
    size = sum(r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(made[0]).select("length").collect())
    assert len({p.split("/")[-2] for p in parts}) == 8 and size * 4 < lines.agg(F.sum(F.length("value") + 1)).first()[0]
    assert found.agg(F.sum("n")).first()[0] == lines.count() - 1 and "FileScan binaryFile" in plan(found)
