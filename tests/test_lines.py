"""Lines of flat files: escapes, quoted triples, broken lines."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators.validate import parse_check
from tessera.sources import files

XSD = "http://www.w3.org/2001/XMLSchema#"


def parsed(spark, *texts):
    rows = files.parse_lines(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")).orderBy("k").collect()
    return [None if r.s is None else tuple(r[c] for c in ("s", "s_kind", "p", "o", "o_kind", "o_dt", "o_lang", "g", "g_kind")) for r in rows]


def literal(spark, text):
    (row,) = parsed(spark, f'<urn:s> <urn:p> "{text}" .')
    return row and row[3]


def test_escapes(spark):
    cases = {
        r"caf\u00e9": "caf" + chr(0xE9),
        r"\U0001F600 \uD83D\uDE00": chr(0x1F600) + " " + chr(0x1F600),
        r"\t\b\n\r\f\"\'\\": "\t\b\n\r\f\"'\\",
        r"\\u0041 \\\u0041": r"\u0041 " + chr(92) + "A",
        "plain é 日本": "plain é 日本",
        "": "",
        r"a\\": "a\\",
        "x" * 300_000 + r"\n" * 50_000: "x" * 300_000 + "\n" * 50_000,
    }
    found = parsed(spark, *[f'<urn:s> <urn:p> "{x}" .' for x in cases])
    assert [r[3] for r in found] == list(cases.values())
    broken = [r"\x", r"\u12", r"\uD800", r"\uDC00 x", r"\U00110000", r"\U0000D800", r"\uD800\u0041", "\\", 'a"b']
    assert parsed(spark, *[f'<urn:s> <urn:p> "{x}" .' for x in broken]) == [None] * len(broken)
    assert parsed(spark, r'<urn:caf\u00e9> <urn:p\u0041> "x"^^<urn:t\u0042> <urn:g\u0043> .') == [("urn:caf" + chr(0xE9), "iri", "urn:pA", "x", "literal", "urn:tB", None, "urn:gC", "iri")]


def test_terms_and_spaces(spark):
    found = parsed(spark, "<s> <p> <o> .", "_:a <p> _:b.c <g> . # note", '<s><p>"o"@en-GB.', '\t<s>\t<p>  "o"^^<t>   _:g  .  ', '<s> <p> "a . b" <g> .', "_:b1 <p> _:b2.")
    assert found == [
        ("s", "iri", "p", "o", "iri", None, None, None, None),
        ("a", "bnode", "p", "b.c", "bnode", None, None, "g", "iri"),
        ("s", "iri", "p", "o", "literal", None, "en-GB", None, None),
        ("s", "iri", "p", "o", "literal", "t", None, "g", "bnode"),
        ("s", "iri", "p", "a . b", "literal", XSD + "string", None, "g", "iri"),
        ("b1", "bnode", "p", "b2", "bnode", None, None, None, None),
    ]


@pytest.mark.parametrize("text", ["", "#", "<s> <p> <o>", "<s> <p> .", '"s" <p> <o> .', "<s> _:p <o> .", '<s> <p> <o> "g" .', "<s> <p> <o> <g> <h> .", "<s> <p> <o> . x", "x <s> <p> <o> .", "<s> <p> <o> . <s> <p> <o> .", "<s s> <p> <o> .", '<s> <p> "o" ^^<t> .', "<< <s> <p> <o> <p> <o> ."])
def test_what_is_no_statement(spark, text):
    assert parsed(spark, text) == [None]


def test_quoted_triples(spark):
    lines = ['<< <a> <b> "c \\u0041"@en >> <p> <o> .', "<s> <p> << << <a> <b> _:c >> <d> << <e> <f> <g> >> >> <h> ."]
    first, second = parsed(spark, *lines)
    assert first == ('<a> <b> "c \\u0041"@en', "triple", "p", "o", "iri", None, None, None, None)
    assert second == ("s", "iri", "p", "<< <a> <b> _:c >> <d> << <e> <f> <g> >>", "triple", None, None, "h", "iri")
    quads = files.statements(spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "element_id long, text string"))
    got = sorted((r.element_id, r.path, r.depth, r.s, r.s_kind, r.p, r.o, r.o_kind, r.o_lang) for r in files.quoted_parts(quads).collect())
    assert got == [
        (0, "s", 1, "a", "iri", "b", "c A", "literal", "en"),
        (1, "o", 1, "<a> <b> _:c", "triple", "d", "<e> <f> <g>", "triple", None),
        (1, "oo", 2, "e", "iri", "f", "g", "iri", None),
        (1, "os", 2, "a", "iri", "b", "c", "bnode", None),
    ]


def test_other_lines_are_an_error_or_listed(spark, tmp_path):
    text = '# head\n\n<s> <p> "1" .\n<s> <p> .\n   \n<s> <p> "2" .\n'
    (tmp_path / "x.nt").write_text(text)
    path = str(tmp_path / "x.nt")
    assert files.read_flat_statements(spark, path, bad="drop").count() == 2
    with pytest.raises(Exception, match="no statement in"):
        files.read_flat_statements(spark, path).collect()
    lines = spark.read.text(path).select(F.lit("x").alias("file"), F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"))
    assert [r.text for r in parse_check(lines).collect()] == ["<s> <p> ."]


def test_collections(spark, tmp_path):
    folder = tmp_path / "set"
    folder.mkdir()
    (folder / "profile-a.nt").write_text("<s> <p> <o> .\n")
    (folder / "b.nq").write_text("<s> <p> <o> <g> .\n<t> <p> <o> <g> .\n")
    (folder / "template.nt").write_text("this is none\n")
    assert sorted((r["name"], r.s, r.g) for r in files.load_collection(spark, str(folder)).collect()) == [("a", "s", None), ("b", "s", "g"), ("b", "t", "g")]
    (folder / "c.nt").write_text("<s> <p> .\n")
    with pytest.raises(Exception, match="no statement in c"):
        files.load_collection(spark, str(folder)).collect()


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("<< <a> <p> << _:b <q> \"x\\\"<<\"@en >> >> <r> <o> .", [("s", 1), ("so", 2)]),
        ("<a> <p> <<<< <a> <p> <<<b> <q> <c>>> >> <r> << <a> <b> <c> >>>> <g> .", [("o", 1), ("os", 2), ("oso", 3), ("oo", 2)]),
        ("<< <a> <p> <b> <r> <o> .", None),
        ("<< <a> <p> >> <r> <o> .", None),
        ("<< <a> <p> <b> <c> >> <r> <o> .", None),
        ("<< \"a\" <p> <b> >> <r> <o> .", None),
        ("<< <a> << <a> <b> <c> >> <b> >> <r> <o> .", None),
        ("<a> <p> <b> >> .", None),
        ("<< <a> <p> \"\\x\" >> <r> <o> .", None),
        ("<a> << <a> <p> <b> >> <c> .", None),
        ("<< " * 300 + "<a>" + " <p> <b> >>" * 300 + " <p> <b> .", [("s" * k, k) for k in range(1, 301)]),
    ],
)
def test_quoted_triples_of_any_depth(spark, text, parts):
    lines = spark.createDataFrame([(1, text)], "element_id long, text string")
    read = files.statements(lines, bad="drop")
    if parts is None:
        assert read.count() == 0
    else:
        assert sorted((r.path, r.depth) for r in files.quoted_parts(read).collect()) == sorted(parts)


def test_quoted_lines_are_read_once(spark, sf_dir):
    from tessera.plans import quad_queries

    found = quad_queries.a3_quoted_depths(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert found.count("FileScan parquet") == 1


def test_the_parts_of_a_line_are_those_of_its_statement(spark):
    texts = ["<a> <p> <<<< <a> <p> <<<b> <q> <c>>> >> <r> << <a> <b> \"\\u0041\\\\\" >>>> <g> . # \\x", "<< <a> <p> <b> >> <p> << << _:a <p> <b> >> <q> <c> >> .", "<a> <p> <b> .", "<< <a> <p> <b> >> <p> <b>", "<< <a> <p> <b> >> << <a> <p> <b> >> <c> .", "<< <a> <p> <b> . >> <p> <c> .", "<a> <b> <c> <d> <e> << <a> <p> <b> >> ."]
    lines = spark.createDataFrame(list(enumerate(texts)), "element_id long, text string")
    found = {r.element_id: (r.s is not None, sorted(map(tuple, r.q))) for r in files.parse_lines(lines, parts="q").collect()}
    parts = files.quoted_parts(files.statements(lines, bad="drop")).collect()
    assert found == {k: (k < 3, sorted((r.path, r.depth) for r in parts if r.element_id == k)) for k in range(7)}
    assert [len(found[k][1]) for k in range(7)] == [4, 3, 0, 0, 0, 0, 0]
    assert [r.o for r in parts if (r.element_id, r.path) == (0, "oo")] == ["A\\"]
    with pytest.raises(Exception, match="no quoted triple at s"):
        files.quoted_parts(spark.createDataFrame([(0, "<a> <p> << <b> <c> >>", "triple", "p", "iri", "o", "iri", None, None)], "element_id long, s string, s_kind string, p string, p_kind string, o string, o_kind string, o_dt string, o_lang string")).collect()
