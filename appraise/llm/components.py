"""Connected components by alternating large-star and small-star steps.

Every step is a shuffle on a vertex with map-side minima; the edge table is cut
to shared storage after each round, and rounds end when no edge changes. The
number of rounds is logarithmic in the longest path. Edges are (a, b) of one
orderable type (longs, strings); repeated edges, loops and either direction are allowed. An empty edge table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appraise.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (a, b) edges: neighbours of a vertex move to its smallest neighbour.

    ``large`` looks at all neighbours and moves the larger ones; otherwise only
    smaller neighbours are looked at and all of them move. The minimum is a
    plain aggregate joined back, so a vertex with very many neighbours is
    folded before the shuffle and split as a skewed join partition.
    """
    if large:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = seen.join(low, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for every vertex of an edge.

    The component's own smallest vertex is listed too. Empty input: empty result.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .distinct(), "edges")
    state = None
    while True:
        totals = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if totals == state or totals[0] == 0:
            break
        state = totals
        now = cut(_star(_star(now, True), False), "edges")
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
