"""Connected components of links between vertices of any type that Spark can order.

Two steps alternate until nothing changes: every vertex links its larger neighbours to its
smallest one, then its smaller neighbours. The edges end as stars around the smallest vertex of
each component. A vertex with very many links is reduced by a map-side minimum; the join that
follows is split by Spark where a vertex is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least")
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``vertex`` and ``root``, the smallest vertex of its component, from links ``a`` and ``b``.

    Roots themselves are left out. A link of a vertex with itself is ignored.
    """
    pair = F.when(F.col("a") > F.col("b"), F.struct("a", "b")).otherwise(
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    edges = written(links.filter("a <> b").select(pair.alias("p")).select("p.*").distinct())
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
