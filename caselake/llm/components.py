"""Connected components of a distributed list of links.

Defined results: a link with a null end or from a node to itself links nothing,
so such a node is in the result only if another link names it; repeated links
count once; without links there are no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import stored
from caselake.operators.joins import join_summary


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())


def _around(edges: DataFrame, smaller: bool) -> DataFrame:
    """One star step: every node hands its least neighbour to its larger (or its smaller) neighbours.

    ``edges`` are (a, b) with a > b. A node with very many neighbours is summed
    up before the shuffle, and the adaptive skew join can split the join back.
    """
    if smaller:  # neighbours of u are those below it
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = join_summary(near, least, "u")
    if smaller:
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        linked = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.filter("a > b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for all nodes of ``links`` (a, b); the label is the least node of the component.

    Alternating large and small stars: the number of rounds grows with the
    logarithm of the size of a component. Each round is written to the shared
    folder; only two numbers per round reach the driver.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a > b").distinct(), name)
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = stored(_around(_around(edges, smaller=False), smaller=True), name)
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
