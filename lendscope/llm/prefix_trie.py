"""The trie of the prefixes of rebuilt conversations, with totals of every subtree."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.llm.contraction import subtree_sums
from lendscope.llm.turns import WORD, in_order, numbered, part
from lendscope.session import materialize

#: Conversations of so many consecutive ids share the beginning of the first of them.
FAMILY = 20
#: A conversation takes fewer turns than this from the first of its family.
MOST_SHARED = 4
#: Ids that one row of a chunked list of members holds.
CHUNK = 1000
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over: crc32 of its decimal id, modulo 4."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all conversations, their rebuilt turns): conv_id; conv_id, depth, part, mark_a, mark_b, n_words.

    Two 64-bit marks stand for a turn's role and text. ``part`` does not fall along a conversation,
    and the turns of one part lie in one task at most.
    """
    spark = conversations.sparkSession
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    marks = [F.xxhash64("role", "text").alias("mark_a"), F.xxhash64(F.lit(1), "text", "role").alias("mark_b")]
    words = F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words")
    ordered = in_order(rows, ["conv_id", "turn", "role", "text"], ["conv_id", *marks, words], "turns")
    turns = materialize(spark, numbered(ordered).withColumn("part", part()).drop("place"), "turns-numbered")
    counts = turns.where("ordinal = 1").select("conv_id", "n_rows")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = (
        counts.select("conv_id", first.alias("_first"), shared_turns(F.col("conv_id")).alias("_shared"))
        .join(counts.select(F.col("conv_id").alias("_first"), F.col("n_rows").alias("_there")), "_first", "left")
        .withColumn("_taken", F.least("_shared", F.coalesce("_there", F.lit(0))))
    )
    convs = materialize(spark, convs.select("conv_id", "_first", "_shared", "_taken"), "conversations")
    mine = ["mark_a", "mark_b", "n_words"]
    heads = turns.where(F.col("ordinal") < MOST_SHARED).select(F.col("conv_id").alias("_first"), F.col("ordinal").alias("depth"), *mine)
    taken = convs.join(heads, "_first").where("depth <= _shared").select("conv_id", "depth", F.lit(-1).cast("long").alias("part"), *mine)
    own = (
        turns.where(F.col("ordinal") > shared_turns(F.col("conv_id")))
        .join(convs, "conv_id")
        .select("conv_id", (F.col("ordinal") - F.col("_shared") + F.col("_taken")).alias("depth"), "part", *mine)
    )
    return convs.select("conv_id"), taken.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn's prefix as two 64-bit marks (a, b), those of the prefix before it (above_a, above_b), depth and n_words.

    A prefix is the exclusive-or of hashes of its turns with their depths, which can be put together from
    pieces: each part of a conversation is summed on its own and starts from the earlier parts' sums.
    """
    own = turns.select(
        "conv_id",
        "depth",
        "part",
        "n_words",
        F.xxhash64("depth", "mark_a", "mark_b").alias("own_a"),
        F.xxhash64(F.lit(2), "mark_b", "depth", "mark_a").alias("own_b"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        own.groupBy("conv_id", "part")
        .agg(F.bit_xor("own_a").alias("own_a"), F.bit_xor("own_b").alias("own_b"))
        .select(
            "conv_id",
            F.lit(0).cast("long").alias("depth"),
            "part",
            F.lit(None).cast("long").alias("n_words"),
            *(F.coalesce(F.bit_xor(n).over(earlier), F.lit(0)).alias(n) for n in ("own_a", "own_b")),
        )
    )
    so_far = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = own.unionByName(carried).select(
        "*", F.bit_xor("own_a").over(so_far).alias("a"), F.bit_xor("own_b").over(so_far).alias("b")
    )
    return summed.where("n_words IS NOT NULL").select(
        "conv_id",
        "depth",
        "n_words",
        "a",
        "b",
        F.col("a").bitwiseXOR(F.col("own_a")).alias("above_a"),
        F.col("b").bitwiseXOR(F.col("own_b")).alias("above_b"),
    )


def _chunks(batches):
    """Sorted (id, conv_id) rows of a task as lists of up to CHUNK ids of one node, in text: (id, first, members)."""
    node, first, held = None, None, []

    def row():
        return pa.RecordBatch.from_pydict(
            {"id": pa.array([node], pa.int64()), "first": pa.array([first], pa.int64()), "members": [",".join(held)]}
        )

    made = []
    for batch in batches:
        for each, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if each != node or len(held) >= CHUNK:
                if held:
                    made.append(row())
                node, first, held = each, conv, []
            held.append(str(conv))
        if made:
            yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
            made = []
    if held:
        yield row()


def _digests(batches):
    """Sorted (id, first, members) rows of a task as (id, ends_sha256); a list of any length passes piece by piece."""
    node, state = None, None
    for batch in batches:
        ids, shas = [], []
        for each, members in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if each == node:
                state.update(b",")
            else:
                if state is not None:
                    ids.append(node)
                    shas.append(state.hexdigest())
                node, state = each, hashlib.sha256()
            state.update(members.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shas, pa.string())], ["id", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of (id, conv_id) rows: the conversations that end at a node, ascending, as one digest.

    A digest can only be computed from front to back. The ids are therefore sorted by ranges over all tasks and packed
    there, so that the one task that digests a node's list reads a row per thousand members.
    """
    by = ["id", "conv_id"]
    packed = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_chunks, "id long, first long, members string")
    whole = packed.repartition("id").sortWithinPartitions("id", "first")
    return whole.mapInArrow(_digests, "id long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. A null role or text is empty. Turns go by turn, null first, then by role and text; rows
    that repeat all of that are turns of their own. Rows without conv_id belong to no conversation. No
    conversations give no rows, not even a root. Further columns, whatever their names, are not read.
    """
    spark = conversations.sparkSession
    convs, turns = rebuilt(conversations)
    found = materialize(spark, prefixes(turns), "prefixes")
    root = convs.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    nodes = (
        found.groupBy("depth", "a", "b")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("above_a").alias("above_a"),
            F.min("above_b").alias("above_b"),
            F.max("n_words").alias("n_words"),
        )
        .unionByName(
            root.select(
                "conv_id", "n_convs", *(zero.alias(n) for n in ("depth", "a", "b", "n_words")),
                *(F.lit(None).cast("long").alias(n) for n in ("above_a", "above_b")),
            )
        )
    )
    nodes = materialize(spark, nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    above = nodes.select(
        F.col("id").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("above_a"),
        F.col("b").alias("above_b"),
    )
    linked = nodes.join(above, ["depth", "above_a", "above_b"], "left")
    linked = materialize(spark, linked.select("id", "parent", "conv_id", "parent_conv_id", "depth", "n_convs", "n_words"), "nodes-linked")
    kids = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    kids = materialize(spark, kids, "children")
    tree = linked.join(kids, "id", "left").select(
        "id",
        "parent",
        F.col("depth").alias("level"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    totals = subtree_sums(tree, ["n_leaves", "saved_tokens"])
    last = found.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b")).alias("end"))
    ends = convs.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(f"end.{n}", zero).alias(n) for n in ("depth", "a", "b")))
    ends = end_digests(ends.join(nodes.select("id", "depth", "a", "b"), ["depth", "a", "b"]).select("id", "conv_id"))
    return (
        linked.join(totals, "id")
        .join(kids, "id", "left")
        .join(ends, "id", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
        )
    )


# crc32 of a decimal id, bit by bit, as this SQL has no function of that name.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
  lambda k, b: list_reduce(list_prepend(xor(k, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT)"""

SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ordinal
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 20 AS first, {_CRC.replace('conv_id', 'c.conv_id')} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns) c),
pieces AS (
  SELECT c.conv_id, 0 AS side, t.ordinal, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.first AND t.ordinal <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.ordinal, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.ordinal > c.h),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, ordinal) AS depth,
         string_agg(md5(role) || md5(text), ',') OVER (PARTITION BY conv_id ORDER BY side, ordinal) AS path,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM pieces),
paths AS (SELECT conv_id, depth, path, words FROM placed UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
ends AS (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id),
ended AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256 FROM ends GROUP BY path),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS own FROM paths GROUP BY path, depth),
above AS (
  SELECT n.path, n.own, p.depth AS up_depth, p.path AS up_path, n.depth, n.conv_id
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
kids AS (SELECT up_path, count(*) AS n_children FROM above WHERE up_depth = depth - 1 GROUP BY up_path),
totals AS (
  SELECT a.up_path, sum(a.own) AS saved_tokens, count(*) FILTER (WHERE k.up_path IS NULL) AS n_leaves
  FROM above a LEFT JOIN kids k ON k.up_path = a.path GROUP BY a.up_path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, t.n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN totals t ON t.up_path = n.path LEFT JOIN kids k ON k.up_path = n.path LEFT JOIN ended e ON e.path = n.path
LEFT JOIN above a ON a.path = n.path AND a.up_depth = n.depth - 1 LEFT JOIN nodes p ON p.path = a.up_path
"""
