"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: link each node's larger (or smaller) neighbours to the least node it sees."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        pairs = pairs.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select(F.col("u").alias("n"), F.least("u", "least").alias("m"))
    joined = pairs.join(least, pairs["u"] == least["n"])
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("n").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of a link; root is the least node reachable.

    Links are long pairs in either order; loops, repeats and NULLs are ignored. The links stay distributed; each step is
    written to the shared folder. Steps grow with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))
    )
    edges = written(edges.distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = written(_star(_star(edges, large=True), large=False), "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
