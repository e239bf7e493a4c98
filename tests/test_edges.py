"""Edge cases on tables made by hand."""

import functools
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import names, terms
from tessera.operators import degrees, graphs, intervals, patterns, profiles, results, stats, validate
from tessera.sources import files, packages
from tessera.sources.views import QUADS, QUOTED
from tessera.streaming import commits, jobs

T = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
S = "http://www.w3.org/2001/XMLSchema#string"


def quads(spark, rows):
    full = [(e, g, gk, s, sk, p, "iri", o, ok, dt, lang) for e, g, gk, s, sk, p, o, ok, dt, lang in rows]
    return spark.createDataFrame(full, QUADS)


def elements(spark, n):
    return spark.range(n).select(F.col("id").alias("element_id"))


def one(df):
    return df.first()[0]


def test_semver_order(spark):
    versions = ["dev", "1.0.0", "1.0.0-rc1", "1.10.0", "1.9.0", "abc", None]
    df = spark.createDataFrame([(v,) for v in versions], "v string").withColumn("k", names.semver_key(F.col("v")))
    assert [r.v for r in df.filter("k is not null").orderBy("k").collect()] == ["1.0.0", "1.0.0-rc1", "1.9.0", "1.10.0", "dev"]


def test_purls_both_ways(spark):
    rows = [("categories", "a-1", "1.0"), ("tasks", "b", "dev"), ("profiles", "c", "2.1.0"), ("datasets", "d", "1.0.0"), ("schema", "e", "dev"), ("main", "suite", "dev"), ("main", "suite", "1.0.0")]
    df = spark.createDataFrame(rows, "kind string, id string, version string")
    url = names.make_purl(F.col("kind"), F.col("id"), F.col("version"))
    back = df.select("*", names.parse_purl(url).alias("p"))
    assert all((r.kind, r.id, r.version) == tuple(r.p) for r in back.collect())
    other = spark.createDataFrame([("https://example.org/other/v/1",), (names.ROOT + "schema/x",)], "u string").select(names.parse_purl(F.col("u")).alias("p")).collect()
    assert other[0].p is None and tuple(other[1].p) == ("schema", "x", "dev")


def test_control_characters(spark):
    df = spark.createDataFrame([("\x01\t\n\x0b\r\x13\x14\x1f",), (None,), ("",)], "t string")
    got = df.select(terms.ascii_control_count(F.col("t")).alias("a"), terms.ascii_control_count(F.col("t"), True).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(3, 5), (0, 0), (0, 0)]


def test_literal_classes(spark):
    df = spark.createDataFrame([("literal", None, None), ("literal", S, None), ("literal", "urn:int", None), ("literal", "urn:int", "en"), ("iri", None, None)], "k string, dt string, l string")
    assert [r[0] for r in df.select(terms.literal_class(F.col("k"), F.col("dt"), F.col("l"))).collect()] == ["simple", "simple", "datatype", "language", None]


def test_element_paths(spark):
    assert names.directory_levels(1) == 0 and names.directory_levels(1001) == 1 and names.directory_levels(1000) == 0 and names.directory_levels(10**7) == 2
    df = spark.createDataFrame([(1234567,)], "n long")
    assert one(df.select(names.element_path(F.col("n"), 2))) == "001/234/0001234567.ttl"
    odd = spark.createDataFrame([("000000042.ttl",), ("x/0000000042.trig",), ("0000000042.txt",)], "n string")
    assert [r[0] for r in odd.select(names.element_id_of(F.col("n"))).collect()] == [None, 42, None]


def test_sizes_when_the_count_is_a_size(spark):
    assert sorted(tuple(r) for r in stats.prefix_sizes(elements(spark, 10), (5, 10, 20)).collect()) == [(5, False), (10, True)]
    assert stats.prefix_sizes(elements(spark, 0)).count() == 0


def test_empty_elements_count_and_density_is_null(spark):
    q = quads(spark, [(0, None, None, "a", "iri", "p", "b", "iri", None, None)])
    e = elements(spark, 3)
    row = stats.summary(stats.element_values("statements", e, q), stats.prefix_sizes(e, ())).first()
    assert (row.n, row.sum, row.min, row["mean"]) == (3, 1.0, 0.0, 0.333333)
    density = stats.summary(stats.element_values("byte_density", e, q), stats.prefix_sizes(e, ())).first()
    assert density.n == 1 and density["mean"] == len("<a> <p> <b> .\n")


def test_quoted_triples_and_set_semantics(spark):
    q = quads(spark, [(0, None, None, "<x> <y> <z>", "triple", "p", "b", "iri", None, None), (0, "g", "iri", "<x> <y> <z>", "triple", "p", "b", "iri", None, None)])
    t = spark.createDataFrame([(0, "s", 1, "x", "iri", "y", "iri", "z", "iri", None, None)], QUOTED)
    e = elements(spark, 1)
    value = lambda n: stats.element_values(n, e, q, t).first().value
    assert (value("statements"), value("subjects"), value("objects"), value("graphs"), value("quoted_triples"), value("iris")) == (2, 2, 2, 2, 1, 6)


def test_prefix_stats_do_not_depend_on_partitions(spark, sf_dir):
    from tessera.plans.stat_queries import inputs

    e, q, _ = inputs(spark, sf_dir, "q_orders", "orders", "o_orderkey")
    sizes = stats.prefix_sizes(e, (100, 1000))
    a = stats.summary(stats.element_values("iris", e, q), sizes).orderBy("size").collect()
    b = stats.summary(stats.element_values("iris", e.repartition(7), q.repartition(3)), sizes).orderBy("size").collect()
    assert a == b
    assert all(x["sum"] <= y["sum"] and x["max"] <= y["max"] for x, y in zip(a, a[1:], strict=False))


def test_closure(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("c", "d")], "above string, below string")
    assert sorted(map(tuple, graphs.transitive_pairs(edges).collect())) == [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")]
    with pytest.raises(ValueError, match="levels"):
        graphs.transitive_pairs(spark.createDataFrame([("a", "b"), ("b", "a")], "above string, below string"))
    assert graphs.transitive_pairs(edges.limit(0)).count() == 0


def test_subgraph_with_a_cycle(spark):
    g = quads(spark, [(0, None, None, "r", "iri", "p", "x", "bnode", None, None), (0, None, None, "x", "bnode", "p", "y", "bnode", None, None), (0, None, None, "y", "bnode", "p", "x", "bnode", None, None), (0, None, None, "z", "iri", "p", "r", "iri", None, None)])
    roots = spark.createDataFrame([("r",)], "root string")
    assert graphs.subject_subgraph(g, roots).count() == 3


def test_rename_on_both_sides(spark):
    g = quads(spark, [(0, "old", "iri", "old", "iri", "old", "old", "iri", None, None), (0, None, None, "a", "iri", "p", "old", "literal", S, None)])
    got = {(r.g, r.s, r.p, r.o) for r in graphs.rename_resources(g, spark.createDataFrame([("old", "new")], "old string, new string")).collect()}
    assert got == {("old", "new", "old", "new"), (None, "a", "p", "old")}


def test_union_is_a_set(spark):
    g = quads(spark, [(0, None, None, "a", "iri", "p", "b", "iri", None, None), (1, None, None, "c", "iri", "p", "b", "iri", None, None)])
    assert graphs.merge_graphs(g, g).count() == 2
    assert graphs.remove_statements(graphs.merge_graphs(g), s="a").count() == 1


def test_structure_rules(spark):
    q = quads(
        spark,
        [
            (0, "g", "iri", "g", "iri", "t", "1", "literal", S, None),
            (0, None, None, "g", "iri", "time", "1", "literal", S, None),
            (1, None, None, "a", "iri", "p", "b", "iri", None, None),
            (2, "g", "iri", "a", "iri", "p", "b", "iri", None, None),
            (2, None, None, "g", "iri", "time", "1", "literal", S, None),
            (2, None, None, "g", "iri", "time", "2", "literal", S, None),
            (3, "g", "literal", "lit", "literal", "p", "<a> <b> <c>", "triple", None, None),
        ],
    )
    got = {(r.element_id, r.rule) for r in validate.structure_violations(elements(spark, 5), q, named_graph_stream=True, temporal_property="time").collect()}
    assert got == {(1, "exactly_one_named_graph"), (4, "exactly_one_named_graph"), (2, "temporal_property_once"), (3, "temporal_property_once"), (3, "literal_graph_names"), (3, "generalized_triples"), (3, "undeclared_quoted_triples")}
    with pytest.raises(Exception, match="exactly_one"):
        validate.strict(validate.structure_violations(elements(spark, 5), q.filter("element_id = 1"), named_graph_stream=True)).collect()


def test_sequence(spark):
    entries = spark.createDataFrame([("a", k, n) for k, n in enumerate([5, 6, 8])] + [("b", 0, 3)], "archive string, pos long, number long")
    assert [tuple(r) for r in validate.sequence_gaps(entries).collect()] == [("a", 6, 7)]


def test_flat_round_trip(spark, tmp_path):
    q = quads(
        spark,
        [
            (0, "g", "iri", "a", "iri", "p", 'q "x" \\ \n\r\t <y> .', "literal", S, None),
            (0, None, None, "b", "bnode", "p", "c", "bnode", None, None),
            (1, None, None, "a", "iri", "p", "5", "literal", "urn:int", None),
            (1, "g", "iri", "a", "iri", "p", "x <y> z", "literal", None, "en"),
            (2, None, None, "a", "iri", "p", "x" * 20000 + '"' * 3000, "literal", S, None),
        ],
    )
    files.write_flat(q, f"file://{tmp_path}/flat")
    back = files.read_flat_statements(spark, f"file://{tmp_path}/flat")
    columns = [c for c in q.columns if c != "element_id"]
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, q.select(columns).collect()))
    lines = spark.createDataFrame([("f", 1, "<a> <p> <o> ."), ("f", 2, "a <p> <o> ."), ("f", 3, '<a> <p> "x" y" .'), ("f", 4, "")], "file string, line long, text string")
    assert sorted(r.line for r in validate.parse_check(lines).collect()) == [2, 3]


def test_archives_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k}\n") for k in range(25)], "element_id long, data string")
    files.write_element_stream(docs, f"file://{tmp_path}/a", archives=3).collect()
    back = files.read_element_archive(spark, f"file://{tmp_path}/a/*.tar.gz")
    assert sorted((names_, bytes(c)) for names_, c in back.select("path", "content").collect()) == [(f"{k:010d}.ttl", f"text {k}\n".encode()) for k in range(25)]


def test_index_is_dense(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(10)], "shard long, at long")
    got = patterns.element_index(df, F.col("shard"), F.col("at")).orderBy("element_id").collect()
    assert [r.element_id for r in got] == list(range(10)) and [r.shard for r in got] == sorted(r.shard for r in got)


def test_marks_need_the_same_key(spark):
    n = spark.createDataFrame([("a", 1), ("b", 1)], "np string, pubkey long")
    marks = spark.createDataFrame([("a", 1), ("b", 2)], "np string, pubkey long")
    assert [r.np for r in results.drop_marked(n, marks).collect()] == ["b"]


def test_required_property(spark):
    f = spark.createDataFrame([("d", "a", "1")], "dataset string, property string, value string")
    with pytest.raises(Exception, match="no b of d"):
        results.dataset_records(f, ["a", "b"], []).collect()


def test_release_assets(spark):
    json = '{"tag_name": "v1", "assets": [{"name": "source.tar.gz", "browser_download_url": "u"}]}'
    df = spark.createDataFrame([(json,), ("no json",), (None,)], "j string").select(files.release_info(F.col("j")).alias("r")).select(files.source_asset_url(F.col("r")).alias("u"))
    assert [r.u for r in df.collect()] == ["u", None, None]


def plain_gaps(rows):
    by = {}
    for archive, n in rows:
        if n is not None:
            by.setdefault(archive, set()).add(n)
    found = []
    for archive, numbers in by.items():
        order = sorted(numbers)
        found += [(archive, a, a + 1) for a, b in zip(order, order[1:], strict=False) if b != a + 1]
    return sorted(found, key=str)


@pytest.mark.parametrize("bits", [16, 2])
def test_gaps_of_runs_are_those_of_a_plain_loop(spark, monkeypatch, bits):
    monkeypatch.setattr(intervals, "BITS", bits)
    monkeypatch.setattr(intervals, "_WORD", 64 if bits == 16 else 24)
    rnd = random.Random(bits)
    rows = [(rnd.choice("ab"), rnd.randrange(400)) for _ in range(600)] + [("c", n) for n in (-9, -8, 3, 3, 4, None)] + [(None, 1), (None, 5), ("d", 7)]
    rows += [("far", n) for n in ((0, 1, 2**40, 2**40 + 1, -(2**62)) if bits == 16 else (0, 1, 2**20))]
    df = spark.createDataFrame(rows, "archive string, number long").repartition(3)
    assert sorted(map(tuple, intervals.gaps(df).collect()), key=str) == plain_gaps(rows)
    parts = [intervals.runs_of(df.filter(F.col("number") % 3 == k)) for k in range(3)] + [intervals.runs_of(df.filter("number < 100"))]
    whole = intervals.merged_runs(functools.reduce(DataFrame.unionByName, parts))
    assert sorted(map(tuple, intervals.gaps_of(whole).collect()), key=str) == plain_gaps(rows)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, intervals.runs_of(df).collect()), key=str)


@pytest.mark.parametrize("order", ["in order", "reversed", "shuffled"])
def test_stream_gaps_in_any_order_of_files(spark, tmp_path, order):
    starts = {"in order": [0, 10, 20, 30, 40], "reversed": [40, 30, 20, 10, 0], "shuffled": [0, 20, 10, 40, 30]}[order]
    rows = []
    for at, start in enumerate(starts):
        part = [("a", n) for n in range(start, start + 10) if n != 25] + [("b", start // 10 + 70_000 * (start > 20)), ("a", 3)]
        rows += part
        spark.createDataFrame(part, "archive string, number long").coalesce(1).write.parquet(f"file://{tmp_path}/in{at}")
        for f in (tmp_path / f"in{at}").glob("*.parquet"):
            os.utime(f, (10_000 + at, 10_000 + at))
    want = plain_gaps(rows)
    assert want == [("a", 24, 25), ("b", 2, 3)]
    for files_per_batch in (1, 2, 100):
        stream = lambda n=files_per_batch: spark.readStream.schema("archive string, number long").option("maxFilesPerTrigger", n).parquet(f"file://{tmp_path}/in*")
        assert sorted(map(tuple, jobs.stream_gaps_in_batches(stream()).collect())) == want
        if files_per_batch != 2 or order == "shuffled":
            assert sorted(map(tuple, jobs.stream_gaps(stream()).collect())) == want


def test_following_over_ranges(spark):
    rows = [("a", k, k if k != 500 else 501) for k in range(1000)] + [("b", 0, 7)] + [("c", k, 2 * k) for k in range(300)] + [(None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "archive string, pos long, number long").repartition(6)
    got = {(r.archive, r.pos): r.following for r in patterns.with_following(df, "number", "archive", "pos").collect()}
    by = {}
    for archive, pos, number in rows:
        by.setdefault(archive, []).append((pos, number))
    for archive, entries in by.items():
        entries.sort()
        for (pos, _), (_, following) in zip(entries, [*entries[1:], (None, None)], strict=True):
            assert got[archive, pos] == following
    assert sorted(tuple(r) for r in validate.sequence_gaps(df.filter("archive = 'a'")).collect()) == [("a", 499, 500), ("a", 501, 502)]
    assert patterns.with_following(df.limit(0), "number", "archive", "pos").count() == 0


def test_element_index_is_dense_over_ranges(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("shard"), F.col("id").alias("at")).repartition(7)
    got = patterns.element_index(df, F.col("shard"), F.col("at")).orderBy("shard", "at").collect()
    assert [r.element_id for r in got] == list(range(2000))


def test_shared_folder_needs_a_name_on_a_cluster(monkeypatch):
    from tessera.sources import shared

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077", ""):
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared.shared_folder(Session(**{"spark.master": master}))
    for master in ("local", "local[4]", "local[*]"):
        assert shared.shared_folder(Session(**{"spark.master": master})).startswith("file:///")
    assert shared.shared_folder(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x"})).startswith("hdfs:///x/tessera-")


def test_archives_are_read_as_streams(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"line {k}\n" * 5) for k in range(30)], "element_id long, data string")
    written = files.write_element_stream(docs, str(tmp_path), archives=3).collect()
    assert len(written) == 30 and not list(tmp_path.glob(".attempt*"))
    back = files.read_element_archive(spark, str(tmp_path)).collect()
    assert {(r.path, bytes(r.content).decode()) for r in back} == {(f"{k:010d}.ttl", f"line {k}\n" * 5) for k in range(30)}
    import hashlib

    for r in files.file_digests(spark, str(tmp_path)).collect():
        data = (tmp_path / r.file_name).read_bytes()
        assert (r.byte_size, r.md5, r.sha1, r.sha256) == (len(data), *(hashlib.new(n, data).hexdigest() for n in ("md5", "sha1", "sha256")))


def test_closure_doubles(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graphs, "settle", lambda df, keep=graphs.settle: rounds.append(1) or keep(df))
    diamond = [(f"{k}{a}", f"{k + 1}{b}") for k in range(10) for a in "xy" for b in "xy"]
    pairs = graphs.transitive_pairs(spark.createDataFrame(diamond, "above string, below string")).collect()
    assert len(pairs) == len(set(pairs)) == 4 * 55 and len(rounds) <= 6
    rounds.clear()
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(0, 3)], "above long, below long")
    far = {(r.above, r.below): r.distance for r in graphs.reachable(chain).collect()}
    assert len(far) == 200 * 201 // 2 and far[0, 200] == 198 and len(rounds) <= 10
    with pytest.raises(ValueError, match="levels"):
        graphs.transitive_pairs(chain)
    cycle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "above string, below string")
    assert {tuple(r)[:2] for r in graphs.reachable(cycle).collect()} == {(x, y) for x in "abc" for y in "abc"}
    with pytest.raises(ValueError, match="levels"):
        graphs.transitive_pairs(cycle)
    assert graphs.transitive_pairs(cycle.limit(0)).count() == 0


def test_blank_nodes_of_long_chains_and_cycles(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graphs, "settle", lambda df, keep=graphs.settle: rounds.append(1) or keep(df))
    b = lambda k: f"_:{k}"
    rows = [("r", "iri", "p", "_:0", "bnode")] + [(b(k), "bnode", "p", b(k + 1), "bnode") for k in range(1999)]
    rows += [("q", "iri", "p", "_:c0", "bnode"), ("q", "iri", "p", "_:5", "bnode"), ("q", "iri", "p", "r", "iri")] + [(f"_:c{k}", "bnode", "p", f"_:c{(k + 1) % 7}", "bnode") for k in range(7)]
    g = spark.createDataFrame([(*r, None, None) for r in rows], "s string, s_kind string, p string, o string, o_kind string, o_dt string, o_lang string")
    roots = spark.createDataFrame([("r",), ("q",), ("none",)], "root string")
    found = {(r.root, r.node) for r in graphs.blank_nodes_below(g, roots).collect()}
    assert found == {("r", "r"), ("q", "q"), ("none", "none")} | {("r", b(k)) for k in range(2000)} | {("q", b(k)) for k in range(5, 2000)} | {("q", f"_:c{k}") for k in range(7)}
    assert len(rounds) <= 2 + 2 * 12


SUB = "urn:p:sub"


def conforming(spark, facts, rules, names, context=()):
    full = [(s, "bnode" if s.startswith("_:") else "iri", p, *o) for s, p, o in facts]
    schema = "s string, s_kind string, p string, o string, o_kind string, o_dt string, o_lang string"
    own = spark.createDataFrame([("d", *r) for r in full], "focus string, " + schema)
    shared = spark.createDataFrame([(s, "iri", p, *o) for s, p, o in context], schema)
    constraints = spark.createDataFrame([(p, "dataset", str(k), path, op, n, terms) for k, (p, path, op, n, terms) in enumerate(rules)], profiles.CONSTRAINTS)
    found = profiles.conforming(own, constraints, spark.createDataFrame([(n,) for n in names], "profile string"), shared, T, SUB)
    return {r.profile for r in found.collect()}


def test_constraints_of_profiles(spark):
    i, text, num = (lambda v: (v, "iri", None, None)), (lambda v: (v, "literal", S, None)), (lambda v: (v, "literal", "int", None))
    facts = [("d", "p", i("x")), ("d", "p", i("y")), ("d", "n", num("5")), ("d", "n", num("50")), ("d", "w", text("five")), ("d", "u", ("_:b", "bnode", None, None)), ("_:b", "t", i("k1")), ("d", "l", ("hi", "literal", "ls", "en"))]
    context = [("k1", "up", i("k2")), ("k2", "up", i("k3")), ("k3", "up", i("k1")), ("x", T, i("C1")), ("y", T, i("C2")), ("C1", SUB, i("C")), ("C2", SUB, i("C")), ("C", SUB, i("C"))]
    rules = {
        "has": [(["p"], "has_value", None, [i("x")])],
        "has other kind": [(["w"], "has_value", None, [("five", "literal", "int", None)])],
        "has language": [(["l"], "has_value", None, [("hi", "literal", "ls", "en")])],
        "in": [(["p"], "in", None, [i("x"), i("y"), i("z")])],
        "not in": [(["p"], "in", None, [i("x")])],
        "absent in": [(["q"], "in", None, [i("x")])],
        "absent": [(["q"], "has_value", None, [i("x")])],
        "two": [(["p"], "min_count", 2, [])],
        "three": [(["p"], "min_count", 3, [])],
        "zero": [(["q"], "min_count", 0, [])],
        "at most two": [(["p"], "max_count", 2, []), (["q"], "max_count", 0, [])],
        "at most one": [(["p"], "max_count", 1, [])],
        "range": [(["n"], "ge", None, [num("5")]), (["n"], "le", None, [num("50")])],
        "below": [(["n"], "le", None, [num("49")])],
        "no number": [(["w"], "ge", None, [num("1")])],
        "up": [(["u", "t", "up*"], "has_value", None, [i("k3")])],
        "up none": [(["u", "t", "up*"], "has_value", None, [i("k1")])],
        "up count": [(["u", "t", "up*"], "max_count", 3, []), (["u", "t", "up*"], "min_count", 3, [])],
        "class": [(["p"], "class", None, [i("C")])],
        "one class": [(["p"], "class", None, [i("C1")])],
        "some class": [(["p"], "min_of_class", 1, [i("C1")])],
        "two class": [(["p"], "min_of_class", 2, [i("C1")])],
        "datatype": [(["n"], "datatype", None, [i("int")])],
        "no datatype": [(["p"], "datatype", None, [i("int")])],
        "kind": [(["u"], "kind", None, [text("bnode")])],
        "itself": [([], "has_value", None, [i("d")]), (["up*"], "max_count", 1, [])],
        "one broken": [(["p"], "has_value", None, [i("x")]), (["p"], "max_count", 1, [])],
        "one unanswered": [(["p"], "has_value", None, [i("x")]), (["q"], "min_count", 1, [])],
    }
    want = {"has", "has language", "in", "absent in", "two", "zero", "at most two", "range", "up", "up none", "up count", "class", "some class", "datatype", "kind", "itself", "no constraint"}
    assert conforming(spark, facts, [(p, *r) for p, rs in rules.items() for r in rs], [*rules, "no constraint"], context) == want


def test_a_profile_without_shape_is_an_error(spark):
    g = spark.createDataFrame([("d", "iri", T, "D", "iri", None, None)], "s string, s_kind string, p string, o string, o_kind string, o_dt string, o_lang string")
    shapes = spark.createDataFrame([("a", "dataset"), ("a", "distribution"), ("b", "dataset")], "profile string, level string")
    rules = spark.createDataFrame([], profiles.CONSTRAINTS)
    with pytest.raises(Exception, match="no shape for the distribution in profile b"):
        profiles.link_profiles(g, shapes, rules, g.limit(0), "D", "dist", T, SUB).collect()
    got = profiles.link_profiles(g, shapes.filter("profile = 'a'"), rules, g.limit(0), "D", "dist", T, SUB).collect()
    assert [tuple(r) for r in got] == [("a", "d", None)]


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    rows = [(k // 3, None, None, f"s{k % 7}", "iri", f"p{k % 2}", str(k % 11), "literal", S if k % 2 else "urn:d" + str(k % 5), None) for k in range(90) if k // 3 != 4]
    df = quads(spark, rows)
    jobs.write_stream_files(df, f"file://{tmp_path}/in", 6)
    sizes = spark.createDataFrame([(10, False), (30, True)], "size long, is_full boolean")
    # The sum of densities depends on the order of its terms.
    rows_of = lambda found: {(r["size"], r.statistic): r for r in found.withColumn("sum", F.round("sum", 6)).collect()}
    want = rows_of(stats.all_statistics(elements(spark, 30), df, sizes=sizes))
    for n, times in ((1, 2), (2, 1), (100, 1)):
        base = f"file://{tmp_path}/out{n}"
        sink = jobs.statistics_sink(base, [10, 30])
        jobs.run_to_end(jobs.element_stream(spark, f"file://{tmp_path}/in", n), lambda b, k, sink=sink, times=times: [sink(b, k) for _ in range(times)] and None)
        assert rows_of(jobs.statistics_so_far(spark, base, sizes)) == want
    assert want[10, "datatypes"]["values"] == [f"urn:d{k}" for k in range(5)] and want[30, "subjects"].unique_count == 7 == want[30, "subjects"].unique_lower


def test_degree_sketches_of_few_statements_are_exact(spark, monkeypatch):
    monkeypatch.setattr(degrees, "LG_HASHES", 6)
    rows = [(0, None, None, "s", "iri", "p", f"o{k}", "iri", None, None) for k in range(1000)] + [(0, None, None, f"s{k % 40}", "iri", "q", "s", "iri", None, None) for k in range(80)]
    got = {(r.role, r.node): r for r in degrees.degree_sketches(quads(spark, rows)).collect()}
    assert all((r.distinct_lower, r.distinct_upper) == (1.0, 1.0) for (role, node), r in got.items() if node.startswith("<o"))
    assert got["predicate", "<q>"].occurrences == 80 and got["predicate", "<q>"].distinct_est == 40 == got["predicate", "<q>"].distinct_upper
    many = got["subject", "<s>"]
    assert many.distinct_lower < many.distinct_est < many.distinct_upper and 600 < many.distinct_est < 1500
    whole = {r.node: r for r in degrees.degree_sketches(quads(spark, rows), detailed=False).collect()}
    assert whole["<s>"].occurrences == 1080 and whole["<s0>"].distinct_est == 1


def test_a_stream_of_archives_goes_on_where_it_stopped(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"line {k}\n") for k in range(40)], "element_id long, data string")
    files.write_element_stream(docs, f"file://{tmp_path}/in", archives=5).collect()
    base, checkpoint = f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint"
    text = lambda batch: batch.select("path", F.decode("content", "UTF-8").alias("text"))
    seen = []

    def stop(number):
        seen.append(number)
        if number == 1 and seen.count(1) == 1:
            raise RuntimeError("stopped after the data, before the marker")

    stream = lambda: files.stream_element_archives(spark, f"file://{tmp_path}/in", 2)
    sink = commits.marked_sink(base, text, stop)
    with pytest.raises(Exception, match="stopped after the data"):
        jobs.run_to_end(stream(), sink, checkpoint=checkpoint)
    assert seen == [0, 1]
    schema = "path string, text string"
    early = commits.finished_batches(spark, base, schema).count()
    assert 0 < early < 40
    files.write_element_stream(docs.selectExpr("element_id + 40 AS element_id", "data"), f"file://{tmp_path}/in", archives=1).collect()
    jobs.run_to_end(stream(), sink, checkpoint=checkpoint)
    assert seen[:3] == [0, 1, 1] and seen.count(0) == 1
    got = sorted((r.path, r.text) for r in commits.finished_batches(spark, base, schema).collect())
    assert got == [(f"{k:010d}.ttl", f"line {k % 40}\n") for k in range(80)]


def test_packages_are_members_one_after_the_other(spark, tmp_path):
    rows = [(k, None, None, f"s{k}", "iri", "p", f"o {j}\n", "literal", S, None) for k in range(50) for j in range(3) if k != 30]
    sizes = spark.createDataFrame([(10,), (25,), (50,)], "size long")
    parts = packages.write_members(quads(spark, rows).repartition(3), sizes, f"file://{tmp_path}/m", with_graph=False)
    got = {r["size"]: r for r in packages.write_packages(parts, sizes, f"file://{tmp_path}/p").collect()}
    known = {r["size"]: r for r in packages.package_sizes(parts, sizes).collect()}
    for size, r in got.items():
        text = gzip.decompress(open(r.path, "rb").read()).decode()
        want = "".join(f'<s{k}> <p> "o {j}\\n" .\n' for k in range(size) for j in range(3) if k != 30)
        assert text == want and r.plain_md5 == hashlib.md5(want.encode()).hexdigest()
        assert (known[size].elements, known[size].statements, known[size].plain_bytes, known[size].byte_size) == (size - (size > 30), want.count("\n"), len(want), os.path.getsize(r.path))
    assert not list(tmp_path.glob("*/.attempt*")) and got[50].members >= 3
