"""Sums over the subtrees of a forest by parallel tree contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lendscope.session import materialize

#: Every round takes all leaves and half of an even chain, or a quarter by a coin, so this is far beyond need.
MOST_ROUNDS = 400


def _heads(level: str, turn: int, bits: int) -> Column:
    """A choice per level and round, the same whenever a task is repeated.

    Of a chain's levels it takes every other one, then every fourth, and so on. What raking has made
    uneven since is halved in a second turn through the bits, and by a coin after that.
    """
    if turn < 2 * bits:
        return F.shiftright(level, turn % bits).bitwiseAND(F.lit(1)) == 1
    return F.xxhash64(F.col(level), F.lit(turn)).bitwiseAND(F.lit(1)) == 1


def _judged(live: DataFrame, names: list[str], turn: int, bits: int) -> DataFrame:
    """The live nodes after the leaves' sums went to their parents, each with its part in this round.

    rake: a leaf, whose sums are now whole. splice: a node of a chain that will be bridged; its parent and
    its child never are in the same round. keep: all others. What a parent gets is added up
    inside the tasks first, so a node with very many children costs a row per task.
    """
    kids = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("_node")).agg(F.count(F.lit(1)).alias("_kids"))
    flagged = live.join(kids, F.col("id") == F.col("_node"), "left").drop("_node")
    leaf = F.col("_kids").isNull()
    below = (
        flagged.where("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("_node"))
        .agg(
            F.sum(F.when(leaf, 0).otherwise(1)).alias("_left"),
            *(F.sum(F.when(leaf, F.col(n) + F.col(f"up_{n}")).otherwise(0)).alias(f"_gain_{n}") for n in names),
        )
    )
    above = below.select(F.col("_node").alias("_parent"), F.col("_left").alias("_siblings"))
    chain = (F.col("_left") == 1) & F.col("parent").isNotNull() & _heads("level", turn, bits)
    free = (F.col("_siblings") != 1) | ~_heads("above", turn, bits)
    return (
        flagged.join(below, F.col("id") == F.col("_node"), "left")
        .join(above, F.col("parent") == F.col("_parent"), "left")
        .select(
            "id",
            "parent",
            "level",
            "above",
            *((F.col(n) + F.coalesce(f"_gain_{n}", F.lit(0))).alias(n) for n in names),
            *(f"up_{n}" for n in names),
            F.when(leaf, "rake").when(chain & free, "splice").otherwise("keep").alias("part"),
        )
    )


def _bridged(judged: DataFrame, names: list[str]) -> DataFrame:
    """The kept nodes, hung below their nearest kept ancestor; ``via`` is the node that was bridged, ``add_`` what it has besides."""
    gone = judged.where("part = 'splice'").select(
        F.col("id").alias("via"),
        F.col("parent").alias("_parent"),
        F.col("above").alias("_above"),
        *(F.col(n).alias(f"_own_{n}") for n in names),
        *(F.col(f"up_{n}").alias(f"_up_{n}") for n in names),
    )
    kept = judged.where("part = 'keep'").join(gone, F.col("parent") == F.col("via"), "left")
    none = F.lit(0)
    return kept.select(
        "id",
        F.coalesce("_parent", "parent").alias("parent"),
        "level",
        F.coalesce("_above", "above").alias("above"),
        *names,
        *((F.col(f"up_{n}") + F.coalesce(f"_own_{n}", none) + F.coalesce(f"_up_{n}", none)).alias(f"up_{n}") for n in names),
        "via",
        *((F.col(f"_own_{n}") + F.col(f"up_{n}")).alias(f"add_{n}") for n in names),
    )


def subtree_sums(tree: DataFrame, names: list[str]) -> DataFrame:
    """(id, one long per name): for every node the sums of the named columns over its subtree, itself included.

    ``tree`` has id (long, distinct, not null), parent (null at a root), level (long, one more than the parent's) and the
    named long columns, not null. Rounds of joins alternate between raking all leaves into their parents and
    bridging nodes of unary chains, whose sums are then carried on the edge above their child; so a path
    of any length is gone after a number of rounds that grows with its logarithm. Then the bridged nodes are re-expanded in
    the opposite order: each is what it had, plus its child. Rounds are written to the shared folder. No rows give no rows.
    """
    spark = tree.sparkSession
    nothing = (F.lit(0).cast("long").alias(f"up_{n}") for n in names)
    live = materialize(spark, tree.select("id", "parent", "level", (F.col("level") - 1).alias("above"), *names, *nothing), "tree")
    bits = max(1, (live.agg(F.max("level")).first()[0] or 0).bit_length())
    raked: list[DataFrame] = []
    bridges: list[DataFrame] = []
    for turn in range(MOST_ROUNDS):
        judged = materialize(spark, _judged(live, names, turn, bits), "tree-judged")
        raked.append(judged.where("part = 'rake'").select("id", *names))
        parts = {row.part: row.n for row in judged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not parts.get("keep"):
            break
        if parts.get("splice"):
            live = materialize(spark, _bridged(judged, names), "tree-bridged")
            bridges.append(live.where("via IS NOT NULL").select("via", "id", *(f"add_{n}" for n in names)))
            live = live.drop("via", *(f"add_{n}" for n in names))
        else:
            live = judged.where("part = 'keep'").drop("part")
    else:
        raise RuntimeError("the tree was not contracted: a node is its own ancestor")
    known = reduce(DataFrame.unionByName, raked)
    for bridge in reversed(bridges):
        found = bridge.join(known, "id").select(F.col("via").alias("id"), *((F.col(f"add_{n}") + F.col(n)).alias(n) for n in names))
        known = known.unionByName(materialize(spark, found, "tree-expanded"))
    return known
