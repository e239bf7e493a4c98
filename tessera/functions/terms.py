"""Expressions over RDF terms: kinds, classes, keys, serialised forms and stable ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
#: Stands for the default graph where graphs are counted.
DEFAULT_GRAPH = "DEFAULT GRAPH"
_SEPARATOR = "\u0001"


def literal_key(value: Column, datatype: Column, lang: Column) -> Column:
    """One string per different literal."""
    blank = F.lit("")
    return F.concat_ws(_SEPARATOR, F.coalesce(value, blank), F.coalesce(datatype, blank), F.coalesce(lang, blank))


def literal_class(kind: Column, datatype: Column, lang: Column) -> Column:
    """language, simple or datatype of a literal; null for other terms. A language tag decides first."""
    return F.when(kind != "literal", None).when(F.coalesce(lang, F.lit("")) != "", "language").when(F.coalesce(datatype, F.lit(XSD + "string")) == XSD + "string", "simple").otherwise("datatype")


def ascii_control_count(text: Column, intended: bool = False) -> Column:
    """Control characters other than tab, line feed and carriage return, up to 0x13, or to 0x1F as ``intended``."""
    last = r"\x1F" if intended else r"\x13"
    return F.coalesce(F.regexp_count(text, F.lit(rf"[\x00-\x08\x0B\x0C\x0E-{last}]")), F.lit(0)).cast("long")


def escaped(text: Column) -> Column:
    """Characters escaped as in N-Triples strings."""
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def nt_term(value: Column, kind: Column, datatype: Column | None = None, lang: Column | None = None) -> Column:
    """A term as in N-Triples. A ``triple`` term holds its serialised parts; a literal without datatype is plain."""
    suffix = F.lit("")
    if datatype is not None:
        suffix = F.when(F.coalesce(lang, F.lit("")) != "", F.concat(F.lit("@"), lang)).when(datatype.isNull() | (datatype == XSD + "string"), "").otherwise(F.concat(F.lit("^^<"), datatype, F.lit(">")))
    return (
        F.when(kind == "iri", F.concat(F.lit("<"), value, F.lit(">")))
        .when(kind == "bnode", F.concat(F.lit("_:"), value))
        .when(kind == "triple", F.concat(F.lit("<< "), value, F.lit(" >>")))
        .otherwise(F.concat(F.lit('"'), escaped(value), F.lit('"'), suffix))
    )


def nt_statement(with_graph: bool = True) -> Column:
    """A row of quads as an N-Quads line (N-Triples without graph), without line feed."""
    c = F.col
    parts = [nt_term(c("s"), c("s_kind")), nt_term(c("p"), c("p_kind")), nt_term(c("o"), c("o_kind"), c("o_dt"), c("o_lang"))]
    if with_graph:
        parts.append(nt_term(c("g"), c("g_kind")))  # null for the default graph, which concat_ws leaves out
        parts[-1] = F.when(c("g").isNotNull(), parts[-1])
    return F.concat(F.concat_ws(" ", *parts), F.lit(" ."))


def stable_bnode_id(content: Column, label: Column) -> Column:
    """A blank node id that depends on the element's content and the label only."""
    return F.concat(F.lit("b"), F.md5(F.concat_ws(_SEPARATOR, content, label)))


def name_uuid(name: Column) -> Column:
    """A version 3 UUID of the bytes of ``name`` alone."""
    h = F.md5(name)
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def in_namespace(iri: Column, prefix: str) -> Column:
    return F.coalesce(iri.startswith(prefix), F.lit(False))


def iri_namespace(iri: Column) -> Column:
    """Up to and with the last # or /."""
    return F.regexp_extract(iri, r"^(.*[#/])", 1)


def last_segment(iri: Column) -> Column:
    return F.element_at(F.split(iri, "/"), -1)


def fragment(iri: Column) -> Column:
    return F.element_at(F.split(iri, "#"), -1)


def category_of(iri: Column) -> Column:
    """The last segment of lower-case letters and digits, as far as they go; the whole input if there is none."""
    return F.regexp_replace(iri, "^.*/([a-z0-9]+).*", "$1")
