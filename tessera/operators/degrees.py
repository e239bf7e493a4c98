"""Node degree distributions of a statement stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.terms import nt_term

#: Hashes that a sketch keeps, as a power of 2, and standard deviations of the bounds of its estimate.
LG_HASHES, _SIGMAS = 12, 2.0
#: The roles of nodes in a statement.
ROLES = ("subject", "predicate", "object", "graph")


def _written(quads: DataFrame) -> DataFrame:
    """The parts of each statement as they are written, by role."""
    null = F.lit(None).cast("string")
    nodes = {"subject": nt_term(F.col("s"), F.col("s_kind")), "predicate": nt_term(F.col("p"), F.col("p_kind")), "object": nt_term(F.col("o"), F.col("o_kind"), F.col("o_dt"), F.col("o_lang")), "graph": F.when(F.col("g").isNotNull(), nt_term(F.col("g"), F.coalesce("g_kind", null)))}
    return quads.select(*[n.alias(role) for role, n in nodes.items()])


def node_uses(quads: DataFrame, detailed: bool = True) -> DataFrame:
    """(role, node, h) of each use of a node, with a digest of the statement; without detail all roles are ``statement``."""
    stmt = F.concat_ws(" ", *ROLES)
    each = F.array(*[F.struct(F.lit(role if detailed else "statement").alias("role"), F.col(role).alias("node")) for role in ROLES])
    return _written(quads).select(F.xxhash64(stmt).alias("h"), F.explode(each).alias("u")).select("u.role", "u.node", "h").filter("node is not null")


def degree_distribution(quads: DataFrame, detailed: bool = True) -> DataFrame:
    """Role, node, occurrences and the number of different statements.

    Statements, not the uses of their nodes, are made different first, dealt by subject, so that the uses of a subject and its graph
    are mostly summed up where they are; then both counts need partial sums only, also those of a frequent predicate.
    """
    used = _uses_of_different(quads)
    if detailed:
        return used.groupBy("role", "node").agg(F.sum("uses").alias("occurrences"), F.count("*").alias("distinct_statements"))
    # A node that a statement has in several places has an occurrence for each, of one statement.
    return used.groupBy(F.lit("statement").alias("role"), "node").agg(F.sum("uses").alias("occurrences"), F.count_if("first").alias("distinct_statements"))


def _uses_of_different(quads: DataFrame) -> DataFrame:
    """(role, node, uses, first) of each place of the different statements: how often the statement comes, and whether no place before has the node."""
    different = _written(quads).repartition("subject").groupBy(*ROLES).agg(F.count("*").alias("uses"))
    each = []
    for k, role in enumerate(ROLES):
        again = [F.coalesce(F.col(r) == F.col(role), F.lit(False)) for r in ROLES[:k]]
        each.append(F.struct(F.lit(role).alias("role"), F.col(role).alias("node"), F.col("uses"), (~reduce(Column.__or__, again, F.lit(False))).alias("first")))
    return different.select(F.explode(F.array(*each)).alias("u")).select("u.*").filter("node is not null")


def node_degrees(quads: DataFrame) -> DataFrame:
    """D18 and D19 in one: a row for each node, with (occurrences, distinct_statements) in each role, null where it has none, and in any as ``statement``."""
    of = lambda where: (F.sum(F.when(where, F.col("uses"))), F.count_if(where))
    found = [(role, *of(F.col("role") == role)) for role in ROLES] + [("statement", F.sum("uses"), F.count_if("first"))]
    each = [F.when(n > 0, F.struct(uses.alias("occurrences"), n.alias("distinct_statements"))).alias(role) for role, uses, n in found]
    return _uses_of_different(quads).groupBy("node").agg(*each)


def sketch_table(quads: DataFrame) -> DataFrame:
    """(role, node, occurrences, sketch): a theta sketch of the different statements of each node in each role.

    Tables of several streams or parts of one add up by ``merged_sketches``; nodes without their role too.
    """
    return node_uses(quads).groupBy("role", "node").agg(F.count("*").alias("occurrences"), F.theta_sketch_agg("h", LG_HASHES).alias("sketch"))


def node_sketches(quads: DataFrame) -> DataFrame:
    """A row for each node, with (occurrences, sketch) in each role, null where it has none: ``sketch_table`` with the name of a node once for all its roles.

    Tables of several streams or parts of one are joined by node and add up by ``united``.
    """
    of = lambda role: F.when(F.count_if(F.col("role") == role) > 0, F.struct(F.count_if(F.col("role") == role).alias("occurrences"), F.theta_sketch_agg(F.when(F.col("role") == role, F.col("h")), LG_HASHES).alias("sketch")))
    return node_uses(quads).groupBy("node").agg(*[of(role).alias(role) for role in ROLES])


def united(a: Column, b: Column) -> Column:
    """Two sketches of a node as one, each with its occurrences; a sketch alone is left as it is."""
    both = F.struct((a["occurrences"] + b["occurrences"]).alias("occurrences"), F.theta_union(a["sketch"], b["sketch"], LG_HASHES).alias("sketch"))
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def in_any_role(roles: list[Column]) -> Column:
    """The sketches of a node in each role as one, in which a statement counts once for all of them."""
    return reduce(united, roles)


def merged_sketches(parts: DataFrame, detailed: bool = True) -> DataFrame:
    """The union of sketch tables; without detail the roles of a node are one, ``statement``, and a statement counts once for all of them."""
    roles = parts if detailed else parts.withColumn("role", F.lit("statement"))
    return roles.groupBy("role", "node").agg(F.sum("occurrences").alias("occurrences"), F.theta_union_agg("sketch", LG_HASHES).alias("sketch"))


def with_bounds(sketches: DataFrame) -> DataFrame:
    """(role, node, occurrences, distinct_lower, distinct_est, distinct_upper): up to 2**LG_HASHES statements a sketch holds all hashes, and its number is exact."""
    estimate = F.theta_sketch_estimate("sketch").cast("double")
    off = F.when(F.col("distinct_est") <= 2**LG_HASHES, 0.0).otherwise(F.col("distinct_est") * (_SIGMAS / (2**LG_HASHES - 1) ** 0.5))
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], estimate.alias("distinct_est")).withColumns({"distinct_lower": F.col("distinct_est") - off, "distinct_upper": F.col("distinct_est") + off})


def degree_sketches(quads: DataFrame, detailed: bool = True) -> DataFrame:
    """As ``degree_distribution``, with an estimate and its bounds instead of the exact number."""
    found = sketch_table(quads)
    return with_bounds(found if detailed else merged_sketches(found, detailed=False))


def distinct_nodes(quads: DataFrame, detailed: bool = True) -> DataFrame:
    """(role, nodes), the number of different nodes of each role."""
    return node_uses(quads, detailed).select("role", "node").distinct().groupBy("role").agg(F.count("*").alias("nodes"))
