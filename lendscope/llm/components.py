"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendscope.session import materialize

#: Every step at least halves the height of the trees, so this is far beyond need.
MOST_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: those above it; else those below, and itself) point to the least of them.

    The least neighbour comes from an aggregation with partial sums, so a node with very many links is
    never gathered in one place.
    """
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        joined = both.join(least, F.col("a") == F.col("node")).where("b > a")
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
        least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        joined = down.join(least, F.col("a") == F.col("node"))
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    return made.where("a != b").distinct()


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component): the least node that can be reached, for every node that occurs in ``links`` (a, b: long).

    A link with a null end or to itself says nothing. Each round is written to the
    shared folder, so lineage stays short and a lost executor costs tasks only. No links give no rows.
    """
    spark = links.sparkSession
    now = links.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    now = materialize(spark, now, purpose)
    mark = None
    for _ in range(MOST_ROUNDS):
        now = materialize(spark, _star(_star(now, True), False), purpose)
        # A fixed point has the same links, told by their number and an order-free digest.
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
