"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import saved


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Label every node that has an edge with the smallest node of its component.

    ``src`` and ``dst`` share one orderable type. Returns ``node`` and ``component``, one row per
    node. Edges with a NULL end and loops name no pair and are left out; repeated edges count
    once; no edges give no rows.

    Each round hooks all larger neighbours of a node, then all its smaller ones, onto the smallest
    one it knows (alternating large and small stars), until the edges form stars; that takes a
    number of rounds that grows with the logarithm of the longest path. A round is two aggregations,
    combined before they shuffle, and two joins with one row per node on one side, so a node with
    very many edges can be split. Edges stay distributed and are saved after every round.
    """
    u, v = F.col("u"), F.col("v")
    star = saved(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
        .distinct(),
        "edges",
    )
    state = _state(star)
    while state[0]:
        both = star.union(star.select(v, u))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .filter(v > u)
            .select(v.alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(least, "u").filter(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        star = saved(hooked.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(star)
        if before == state:
            break
    leaves = star.select(u.alias("node"), v.alias("component"))
    centres = star.select(v.alias("node"), v.alias("component")).distinct()
    return leaves.union(centres)


def _state(star: DataFrame) -> tuple:
    """A fingerprint of the edges: equal before and after a round that changed nothing."""
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(star.agg(F.count("*"), F.sum(mark)).first())
