"""Connected components of a table of links, by alternating stars.

Every round rewires each node to the smallest neighbour it knows, first its
larger neighbours (large star), then its smaller ones (small star), until every
node points at the smallest node of its component.  A round is two group
minima and two equi-joins, whose hot keys adaptive execution splits; its result
is written to the shared folder, so the lineage stays short and a lost executor
costs one round.  No link ever reaches the driver: it sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexmill.llm.shared import materialize

MAX_ROUNDS = 60


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One rewiring of canonical links (a > b)."""
    if larger:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if larger:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.filter(F.col("v") != F.col("m")).select(
            F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b), two columns of one
    orderable type; `component` is the smallest node reachable.

    Links with a null end and links of a node to itself are no links.  An empty
    table gives an empty result.
    """
    links = links.select("a", "b").dropna().filter(F.col("a") != F.col("b"))
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        links = materialize(_star(_star(links, True), False), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
