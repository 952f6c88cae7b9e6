"""Exact duplicates by a tree-merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import texts

#: Leaves of the merge tree: input partitions are dealt to so many sorted runs.
LEAVES = 256
#: Runs merged into one at each level; two is the binomial tree.
FAN_IN = 16


def digests(docs: DataFrame) -> DataFrame:
    """Each row's id, place, digest and two further marks of the text that must agree as well."""
    return texts(docs).select(
        "doc_id",
        F.monotonically_increasing_id().alias("place"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.octet_length("text").alias("n_bytes"),
        F.xxhash64("text").alias("mark"),
    )


def merged_runs(rows: DataFrame, leaves: int = LEAVES, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: the member that stays, and how many there are.

    The rows of a partition are sorted by digest and reduced before they move, so a run
    holds a digest once. Each round hands the runs of ``fan_in`` neighbours to one place
    per digest, where they are merged in order, until one run is left, which is spread
    over all tasks by digest. A text that a third of all rows share costs one row per
    task in the first round and at most ``fan_in`` rows in a later one. Rows are the same only
    where digest, length and the second hash all agree.
    """
    key = ("digest", "n_bytes", "mark")
    runs = rows.select(
        *key,
        F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("run"),
        F.struct("doc_id", "place").alias("keep"),
        F.lit(1).cast("long").alias("group_size"),
    )
    width = leaves
    while True:
        width = -(-width // fan_in)
        # The largest of structs is taken by sort aggregation: sorted runs in, one sorted run out.
        runs = (
            runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", *key)
            .agg(F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        )
        if width == 1:
            break
    return runs.drop("run")


def exact_duplicates(docs: DataFrame, leaves: int = LEAVES, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after no change; null is the empty text.
    The row with the largest doc_id stays (a null id is smaller than all). Of rows that repeat
    both text and id, the one that the stored table holds last stays. An empty table
    gives an empty result. Other columns are not read.
    """
    rows = digests(docs)
    runs = merged_runs(rows, leaves, fan_in).select(
        *(F.col(name).alias(f"run_{name}") for name in ("digest", "n_bytes", "mark")), "keep", "group_size"
    )
    same = [F.col(name) == F.col(f"run_{name}") for name in ("digest", "n_bytes", "mark")]
    # A frequent digest meets one row of the runs: the adaptive skew rule may split its rows.
    return rows.join(runs, same).select(
        "doc_id",
        "place",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        F.struct("doc_id", "place").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. ``docs`` is a stored table, whose rows keep their places."""
    gone = exact_duplicates(docs).where("NOT kept").select(F.col("place").alias("_gone_place"))
    return (
        docs.withColumn("_place", F.monotonically_increasing_id())
        .join(gone, F.col("_place") == F.col("_gone_place"), "left_anti")
        .drop("_place")
    )


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")

SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
