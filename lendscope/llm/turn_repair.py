"""Cheapest repair of damaged conversations by a dynamic program with square-root checkpoints."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendscope.llm.turns import in_order, numbered
from lendscope.session import materialize

#: A block has as many rows as the square root of its conversation's, and so many at least.
LEAST_BLOCK = 64
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
NO_TEXT = hashlib.sha256(b"").hexdigest()
#: In place of a conversation that has no id.
NO_ID = " "

# --- fixed values: costs of the edits, and the initials that may follow each other ---
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LEGAL = ("su", "ua", "au")

# States by what was put out last: nothing yet, the system's turn, the user's, the assistant's.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after an inserted or reroled turn, whose role follows from the state before.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
#: The state after a kept turn of initial s, u, a or any other, or None where it may not follow.
_KEPT = (
    (_SYSTEM, None, None, None),
    (_USER, _USER, None, _USER),
    (None, None, _ASSISTANT, None),
    (None, None, None, None),
)
#: What is still to pay after the last row: the inserts that lead to a finished conversation.
_AT_END = (0, 2 * INSERT, INSERT, 0)
_NEVER = 1 << 60
# A row is one letter, A to L: three times its initial (s, u, a, other) plus its fault (none, must go, truncated).
_MUST_GO, _CUT_OFF = 1, 2
# An edit is one letter: d delete, x and y insert a user's or an assistant's turn, k keep, p and q make it the user's or assistant's.
_EDITS, _INITIALS = "dxykpq", "DIIKRR"
_ROLES = {"x": "user", "y": "assistant", "p": "user", "q": "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, was_role, was_text) of the rows that the contract's damage leaves, repeated ones twice."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(NO_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("was_role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("was_text"),
    )
    place = F.concat_ws(":", "conv", F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = rows.withColumn("_hit", F.crc32(place.cast("binary")) % 20).where("_hit != 0")
    twice = hit.withColumn("_copy", F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    cut = F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.regexp_replace("was_text", "[.!?]", "")).otherwise(F.col("was_text"))
    return twice.select(
        "conv", "turn", F.when(F.col("_hit") == 4, "user").otherwise(F.col("was_role")).alias("role"), cut.alias("text"), "was_role", "was_text"
    )


def _row_cost(letter: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after) of the edits that use up the row, in the order of their initials."""
    initial, fault = divmod(ord(letter) - 65, 3)
    edits = [("d", DELETE, state)]
    if fault != _MUST_GO:
        more = TRUNCATED if fault == _CUT_OFF else 0
        if _KEPT[initial][state] is not None:
            edits.append(("k", more, _KEPT[initial][state]))
        edits.append(("p" if _NEXT[state] == _USER else "q", REROLE + more, _NEXT[state]))
    return edits


_ROWS = {letter: tuple(tuple(_row_cost(letter, state)) for state in range(4)) for letter in map(chr, range(65, 77))}


def _back(letter: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The least costs from each state before a row, inserts included, by those after it."""
    costs = [min(cost + after[to] for _, cost, to in edits) for edits in _ROWS[letter]]
    for _ in range(3):  # no more than three inserts in a row lead anywhere new
        costs = [min(cost, INSERT + costs[_NEXT[state]]) for state, cost in enumerate(costs)]
    return tuple(costs)


@lru_cache(maxsize=20_000)
def transfer(letters: str) -> tuple[int, ...]:
    """The least cost of a block from each state to each state, 16 numbers; what ends in no row's edit is not counted."""
    columns = []
    for end in range(4):
        costs = tuple(0 if state == end else _NEVER for state in range(4))
        for letter in reversed(letters):
            costs = _back(letter, costs)
        columns.append(costs)
    return tuple(min(columns[end][start], _NEVER) for start in range(4) for end in range(4))


@lru_cache(maxsize=20_000)
def walk(letters: str, after: tuple[int, ...]) -> tuple[tuple[str, ...], tuple[int, ...], int]:
    """The block again: its costs are computed backwards from its checkpoint, then it is walked forward from every state.

    Returns for each state before the block the edits and the state after it, and the least cost from the empty state. Of the edits
    that keep to the least cost the one with the ASCII-least initial is taken, so the edits are the least of all cheapest ones.
    """
    costs = [after]
    for letter in reversed(letters):
        costs.append(_back(letter, costs[-1]))
    costs.reverse()
    every, ends = [], []
    for state in range(4):
        edits = []
        for at, letter in enumerate(letters):
            while True:
                options = list(_ROWS[letter][state])
                insert = ("x" if _NEXT[state] == _USER else "y", INSERT, _NEXT[state])
                options.insert(1, insert)  # after delete, before keep
                edit, to = next(
                    (edit, to)
                    for edit, cost, to in options
                    if cost + (costs[at] if edit in "xy" else costs[at + 1])[to] == costs[at][state]
                )
                edits.append(edit)
                state = to
                if edit not in "xy":
                    break
        every.append("".join(edits))
        ends.append(state)
    return tuple(every), tuple(ends), costs[0][_EMPTY]


def _transfers(batches):
    """(conv, block, letters) batches with the block's 16 costs."""
    for batch in batches:
        costs = [transfer(letters) for letters in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(costs, pa.list_(pa.int64()))], ["conv", "block", "costs"]
        )


def _checkpoints(batches):
    """Batches of (conv, all its blocks' costs in order) as (conv, block, after): the costs from each state behind the block."""
    for batch in batches:
        convs, blocks, after = [], [], []
        for conv, costs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            now = _AT_END
            for block in reversed(range(len(costs))):
                convs.append(conv)
                blocks.append(block)
                after.append(now)
                step = costs[block]
                now = tuple(min(step[4 * state + end] + now[end] for end in range(4)) for state in range(4))
        yield pa.RecordBatch.from_arrays(
            [pa.array(convs, pa.string()), pa.array(blocks, pa.int64()), pa.array(after, pa.list_(pa.int64()))], ["conv", "block", "after"]
        )


def _walks(batches):
    """(conv, block, letters, after) batches walked from every state."""
    legal = {(a, b) for a, b in (map("sua".index, pair) for pair in LEGAL)}
    for batch in batches:
        every, ends, costs, illegal, outer = [], [], [], [], []
        for letters, after in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            edits, end, cost = walk(letters, tuple(after))
            initials = [(ord(letter) - 65) // 3 for letter in letters]
            every.append(edits)
            ends.append(end)
            costs.append(cost)
            illegal.append(sum(pair not in legal for pair in zip(initials, initials[1:])))
            outer.append((initials[0], initials[-1]))
        small = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(every, pa.list_(pa.string())),
                pa.array(ends, small),
                pa.array(costs, pa.int64()),
                pa.array(illegal, pa.int64()),
                pa.array(outer, small),
            ],
            ["conv", "block", "every", "ends", "cost", "illegal", "outer"],
        )


def _chained(batches):
    """Batches of (conv, ends, outer of all its blocks in order): the state before every block, the inserts after the last, illegal seams."""
    legal = {(a, b) for a, b in (map("sua".index, pair) for pair in LEGAL)}
    for batch in batches:
        starts, tails, seams = [], [], []
        for ends, outer in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            states = [_EMPTY]
            for end in ends:
                states.append(end[states[-1]])
            state, tail = states.pop(), ""
            while state in (_SYSTEM, _USER):
                tail += "x" if _NEXT[state] == _USER else "y"
                state = _NEXT[state]
            starts.append(states)
            tails.append(tail)
            seams.append(sum((a[1], b[0]) not in legal for a, b in zip(outer, outer[1:])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(starts, pa.list_(pa.int32())), pa.array(tails, pa.string()), pa.array(seams, pa.int64())],
            ["conv", "starts", "tail", "seams"],
        )


def _repaired(batches):
    """Sorted rows of a task - a block's edits, then its rows - as (conv, repaired_sha256). Only one block's edits are held."""
    conv, state, turns, tail, first = None, None, iter(()), "", True

    def put(line: str) -> None:
        nonlocal first
        state.update((line if first else "\n" + line).encode())
        first = False

    for batch in batches:
        convs, shas = [], []
        for each, side, role, text in zip(*(batch.column(n).to_pylist() for n in range(4))):
            if each != conv or side == 0:
                for edit in tail:
                    put(f"{_ROLES[edit]}:")
            if each != conv:
                if conv is not None:
                    convs.append(conv)
                    shas.append(state.hexdigest())
                conv, state, first = each, hashlib.sha256(), True
            if side == 0:
                pieces = re.findall("[xy]*[dkpq]", text)
                turns, tail = iter(pieces), text[sum(map(len, pieces)) :]
                continue
            edits = next(turns)
            for edit in edits[:-1]:
                put(f"{_ROLES[edit]}:")
            if edits[-1] != "d":
                put(f"{_ROLES.get(edits[-1], role)}:{text}")
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(shas, pa.string())], ["conv", "repaired_sha256"])
    if conv is not None:
        for edit in tail:
            put(f"{_ROLES[edit]}:")
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], ["conv", "repaired_sha256"])


def _in_blocks(df: DataFrame, *values: str) -> DataFrame:
    """(conv, one array per value): what the blocks of a conversation have, in order; about as many as the square root of its rows."""
    listed = df.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", *values))).alias("_all"))
    return listed.select("conv", *(F.col(f"_all.{name}").alias(name) for name in values))


def repair(conversations: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """One row per conv_id of the table: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, null first, then by role and text before the damage; rows that repeat all of that follow each
    other. A null role, text, turn or id counts as one space in what is hashed and compared; rows without
    conv_id make up one conversation, whose conv_id is null. A conversation without rows after the damage has
    zeros, an empty audit and the digest of no text. gaps is null where it leaves 64 bits. An empty table
    gives an empty result. Further columns, whatever their names, are not read.

    A conversation's rows are cut into blocks of the square root of their number. Each block gives the least costs between the states
    at its ends; from the last block backwards they add up to the cost vectors at the blocks' ends, the only ones that
    are stored. Each block then computes its own vectors again and is walked forward. So a task holds one block,
    or a few numbers for each block of a conversation, however long that is. The digest alone has
    to read a conversation from front to back, row by row.
    """
    spark = conversations.sparkSession
    bare = F.rtrim("text", F.lit(SPACES))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    keep = [
        "conv",
        "turn",
        "role",
        "text",
        initial.alias("initial"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut_off"),
        F.xxhash64("role", "text").alias("mark_a"),
        F.xxhash64(F.lit(1), "text", "role").alias("mark_b"),
    ]
    rows = in_order(damaged(conversations), ["conv", "turn", "was_role", "was_text"], keep, "damaged")
    seen = rows.where("NOT blank").groupBy("conv", "mark_a", "mark_b").agg(F.min("place").alias("first_place"))
    placed = numbered(rows.select("conv", "turn", "initial", "blank", "cut_off", "mark_a", "mark_b", "place"), "conv")
    width = F.greatest(F.lit(least_block), F.ceil(F.sqrt("n_rows"))).cast("long")
    repeated = F.coalesce(F.col("place") > F.col("first_place"), F.lit(False))
    faulty = placed.join(seen, ["conv", "mark_a", "mark_b"], "left").select(
        "conv",
        "turn",
        "place",
        "ordinal",
        F.floor((F.col("ordinal") - 1) / width).cast("long").alias("block"),
        "initial",
        F.when(F.col("blank"), "blank").when(repeated, "duplicate").when(F.col("cut_off"), "truncated").alias("fault"),
    )
    faulty = materialize(spark, faulty, "faults")

    fault = F.when(F.col("fault") == "truncated", _CUT_OFF).when(F.col("fault").isNotNull(), _MUST_GO).otherwise(0)
    letter = F.chr((65 + 3 * F.col("initial") + fault).cast("long"))
    blocks = faulty.groupBy("conv", "block").agg(F.sort_array(F.collect_list(F.struct("ordinal", letter.alias("letter")))).alias("_rows"))
    blocks = materialize(spark, blocks.select("conv", "block", F.array_join("_rows.letter", "").alias("letters")), "blocks")
    several = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("conv")
    costs = blocks.join(several, "conv", "left_semi").mapInArrow(_transfers, "conv string, block long, costs array<long>")
    after = _in_blocks(costs, "costs").mapInArrow(_checkpoints, "conv string, block long, after array<long>")
    at_end = F.array(*(F.lit(cost).cast("long") for cost in _AT_END))
    armed = blocks.join(after, ["conv", "block"], "left").select("conv", "block", "letters", F.coalesce("after", at_end).alias("after"))
    schema = "conv string, block long, every array<string>, ends array<int>, cost long, illegal long, outer array<int>"
    walked = materialize(spark, armed.mapInArrow(_walks, schema), "walks")
    chained = _in_blocks(walked, "ends", "outer").mapInArrow(_chained, "conv string, starts array<int>, tail string, seams long")
    chained = materialize(spark, chained, "chains")
    starts = chained.select("conv", "tail", F.size("starts").alias("n_blocks"), F.posexplode("starts").alias("block", "start"))
    last = F.col("block") == F.col("n_blocks") - 1
    edits = walked.join(starts, ["conv", "block"]).select(
        "conv", "block", F.concat(F.col("every")[F.col("start")], F.when(last, F.col("tail")).otherwise("")).alias("edits")
    )
    edits = materialize(spark, edits, "edits")

    stated = faulty.groupBy("conv", "turn").agg(
        *(F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated"))
    )
    span = F.try_subtract(F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1)), F.count("turn"))
    counts = stated.groupBy("conv").agg(
        F.when(F.count("turn") == 0, 0).otherwise(span).alias("gaps"),
        *(F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")),
    )
    judged = walked.groupBy("conv").agg(
        F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"), F.sum("illegal").alias("_inside")
    )
    judged = judged.join(chained.select("conv", "seams"), "conv").select("conv", "cost", (F.col("_inside") + F.col("seams")).alias("illegal"))
    audits = _in_blocks(edits, "edits").select(
        "conv", F.translate(F.array_join("edits", ""), _EDITS, _INITIALS).alias("audit")
    )
    texts = rows.select("conv", "place", "role", "text").join(faulty.select("place", "block"), "place")
    stream = edits.select(
        "conv", "block", F.lit(0).alias("side"), F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.col("edits").alias("text")
    ).unionByName(texts.select("conv", "block", F.lit(1).alias("side"), "place", "role", "text"))
    stream = stream.repartition("conv").sortWithinPartitions("conv", "block", "side", "place").select("conv", "side", "role", "text")
    digests = stream.mapInArrow(_repaired, "conv string, repaired_sha256 string")

    every = conversations.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(NO_ID)).alias("conv")).distinct()
    found = every
    for part in (counts, judged, audits, digests):
        found = found.join(part, "conv", "left")

    def number(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    return found.select(
        F.when(F.col("conv") != NO_ID, F.col("conv")).cast("long").alias("conv_id"),
        F.when(F.col("cost").isNull(), 0).otherwise(F.col("gaps")).cast("long").alias("gaps"),
        *(number(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NO_TEXT)).alias("repaired_sha256"),
    )


# crc32 of `conv_id:turn`, bit by bit, as this SQL has no function of that name.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
  lambda c: ord(c)::BIGINT)), lambda k, b: list_reduce(list_prepend(xor(k, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT)"""


def _cost_of(side: str, state: str) -> str:
    return f"CASE {state} WHEN 'e' THEN {side}.e WHEN 's' THEN {side}.s WHEN 'u' THEN {side}.u ELSE {side}.a END"


SQL = f"""
WITH RECURSIVE raw AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0 FROM conversations),
hit AS (SELECT *, {_CRC} % 20 AS h FROM raw),
left_over AS (
  SELECT conv, turn, role0, text0, CASE WHEN h = 4 THEN 'user' ELSE role0 END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text
  FROM hit, range(CASE WHEN h = 3 THEN 2 ELSE 1 END) WHERE h <> 0),
placed AS (
  SELECT conv, turn, role, text, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role0, text0) AS i
  FROM left_over),
rows AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv, role, text) THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated'
            ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM placed),
costs AS (  -- what keeping or reroling a row adds, if it may stay at all
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS stay FROM rows),
back AS (  -- the least cost from each state before row i: nothing, system, user or assistant put out last
  SELECT conv, max(i) + 1 AS i, 0::BIGINT AS e, 4::BIGINT AS s, 2::BIGINT AS u, 0::BIGINT AS a FROM rows GROUP BY conv
  UNION ALL
  SELECT conv, i, least(e, 2 + u, 4 + a), least(s, 2 + u, 4 + a), least(u, 2 + a), least(a, 2 + u) FROM (
    SELECT r.conv, r.i,
           least(3 + b.e, r.stay + least(2 + b.u, CASE r.initial WHEN 's' THEN b.s WHEN 'u' THEN b.u ELSE 1000000000 END)) AS e,
           least(3 + b.s, r.stay + least(2 + b.u, CASE r.initial WHEN 'u' THEN b.u ELSE 1000000000 END)) AS s,
           least(3 + b.u, r.stay + least(2 + b.a, CASE r.initial WHEN 'a' THEN b.a ELSE 1000000000 END)) AS u,
           least(3 + b.a, r.stay + least(2 + b.u, CASE r.initial WHEN 'u' THEN b.u ELSE 1000000000 END)) AS a
    FROM back b JOIN costs r ON r.conv = b.conv AND r.i = b.i - 1)),
walk AS (
  SELECT conv, 1::BIGINT AS i, 'e' AS state, '' AS audit, [] :: VARCHAR[] AS lines FROM back WHERE i = 1
  UNION ALL
  SELECT conv, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
         CASE edit WHEN 'D' THEN state WHEN 'K' THEN initial ELSE due END, audit || edit,
         CASE edit WHEN 'D' THEN lines WHEN 'K' THEN lines || [role || ':' || text]
              ELSE lines || [CASE due WHEN 'u' THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END] END
  FROM (
    SELECT *, CASE WHEN text IS NOT NULL AND 3 + after_delete = now THEN 'D' WHEN 2 + after_insert = now THEN 'I'
                   WHEN may_keep AND stay + after_keep = now THEN 'K' ELSE 'R' END AS edit
    FROM (
      SELECT w.*, r.role, r.text, r.initial, r.stay, d.due,
             {_cost_of('b', 'w.state')} AS now, {_cost_of('n', 'w.state')} AS after_delete, {_cost_of('b', 'd.due')} AS after_insert,
             {_cost_of('n', 'r.initial')} AS after_keep,
             (w.state = 'e' AND r.initial = 's') OR (w.state IN ('e', 's', 'a') AND r.initial = 'u') OR (w.state = 'u' AND r.initial = 'a') AS may_keep
      FROM walk w JOIN back b ON b.conv = w.conv AND b.i = w.i LEFT JOIN back n ON n.conv = w.conv AND n.i = w.i + 1
      LEFT JOIN costs r ON r.conv = w.conv AND r.i = w.i
      JOIN (VALUES ('e', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) d(state, due) ON d.state = w.state
      WHERE r.text IS NOT NULL OR w.state IN ('s', 'u')))),
ended AS (
  SELECT w.conv, w.audit, sha256(coalesce(array_to_string(w.lines, chr(10)), '')) AS repaired_sha256
  FROM walk w JOIN (SELECT conv, max(i) + 1 AS i FROM rows GROUP BY conv) l ON l.conv = w.conv AND l.i = w.i WHERE w.state IN ('e', 'a')),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv)
SELECT CAST(nullif(o.conv, ' ') AS BIGINT) AS conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank,
       coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       coalesce(b.e, 0) AS cost, coalesce(x.audit, '') AS audit, coalesce(x.repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv FROM raw) o LEFT JOIN counts c ON c.conv = o.conv LEFT JOIN back b ON b.conv = o.conv AND b.i = 1
LEFT JOIN ended x ON x.conv = o.conv
"""
