"""Packing of tokenised documents into sequences as a cutting-stock problem, by column generation.

Documents are cut at multiples of the sequence length; the pieces left over are the items.
Only their length histogram, which is bounded by the sequence length, decides how they are
combined: a linear program over patterns (how many items of each length share a
sequence) is solved by column generation, the columns being priced by a knapsack dynamic
program; its rounded patterns are then dealt to the documents by their rank among
those of equal length, in Spark.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lendscope.llm.bpe import encoder, tokenizer_bytes
from lendscope.llm.common import texts
from lendscope.session import materialize

SEQUENCE = 2048
#: The id that ends each document.
END_ID = 1
#: Column generation stops when the program's value is proven to be this near to its bound.
GAP = 0.002
#: And after so many priced columns; what is missing then is padding, never a document.
COLUMNS = 150
#: Rows of one length that are ranked by one task.
RANKED_ROWS = 200_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cutter(content: bytes, size: int, end_id: int):
    """A step from documents to pieces: all ids of a text and the end id, cut at multiples of ``size``."""

    def cut(batches):
        coder = encoder(content)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_numpy(zero_copy_only=False) if not batch.column("doc_id").null_count else None
            names = batch.column("doc_id").to_pylist() if doc_ids is None else doc_ids
            for at, end, ids, counts in coder.encode(batch.column("text")):
                # Each text's ids with the end id behind them, in one array.
                whole = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                totals = counts + 1
                first = np.cumsum(totals) - totals
                cuts = -(-totals // size)
                owner = np.repeat(np.arange(end - at), cuts)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * size
                length = np.minimum(size, totals[owner] - start)
                begin = first[owner] + start
                view = memoryview(whole.view(np.uint8))
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[at + i] for i in owner], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(totals[owner], pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return cut


def _greedy(lengths: np.ndarray, counts: np.ndarray, size: int, whole: bool):
    """Patterns that use up the histogram from the longest item down: [(pattern, times, length it uses up)].

    A pattern takes the longest items that still fit, and is repeated until one of its
    lengths is used up. With ``whole`` it is repeated whole times, but once at least.
    """
    left = counts.astype(float)
    found = []
    while (open_ := np.flatnonzero(left > 1e-9)).size:
        pattern, room = {}, size
        while room > 0:
            fits = open_[lengths[open_] <= room]
            if whole:
                fits = fits[[left[i] > pattern.get(i, 0) for i in fits]] if len(fits) else fits
            if not len(fits):
                break
            item = int(fits[-1])
            most = room // lengths[item]
            take = int(min(most, left[item] - pattern.get(item, 0)) if whole else most)
            pattern[item] = pattern.get(item, 0) + take
            room -= take * int(lengths[item])
            open_ = open_[open_ < item]
        times = min(left[i] / n for i, n in pattern.items())
        if whole:
            times = float(max(1, int(times)))
        gone = min(pattern, key=lambda i: (left[i] - times * pattern[i], i))
        for i, n in pattern.items():
            left[i] = max(0.0, left[i] - times * n)
        if not whole:
            left[gone] = 0.0
        found.append((pattern, times, gone))
    return found


def _knapsack(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[dict[int, int], float]:
    """The most valuable pattern at the given prices, by a dynamic program over the room used."""
    best = np.zeros(size + 1)
    choice = np.full(size + 1, -1)
    for room in range(1, size + 1):
        best[room], choice[room] = best[room - 1], -1
        usable = np.searchsorted(lengths, room, "right")
        if usable:
            values = best[room - lengths[:usable]] + prices[:usable]
            top = int(np.argmax(values))
            if values[top] > best[room] + 1e-12:
                best[room], choice[room] = values[top], top
    pattern, room = {}, size
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            item = int(choice[room])
            pattern[item] = pattern.get(item, 0) + 1
            room -= int(lengths[item])
    return pattern, float(best[size])


def solve(lengths: np.ndarray, counts: np.ndarray, size: int, gap: float = GAP, columns: int = COLUMNS):
    """Patterns and how often each is used in the linear program's solution.

    Greedy patterns, each of which uses up one length, form a triangular first basis; new
    columns enter by the revised simplex method. The search stops near the lower bound: the
    items' total length, or the value at prices that no pattern exceeds.
    """
    m = len(lengths)
    basis: list[dict[int, int]] = [{} for _ in range(m)]
    steps = _greedy(lengths, counts, size, whole=False)
    done = {gone for _, _, gone in steps}
    # A length that was used up along with another gets a pattern of its own, at level 0.
    steps += [({i: max(1, size // int(lengths[i]))}, 0.0, i) for i in range(m) if i not in done]
    uses: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    inverse = np.zeros((m, m))
    # In the order in which lengths are used up the basis is triangular, and is inverted row by row.
    for pattern, _, gone in steps:
        basis[gone] = pattern
        inverse[gone, gone] = 1.0
        for column, n in uses[gone]:
            inverse[gone] -= n * inverse[column]
        inverse[gone] /= pattern[gone]
        for i, n in pattern.items():
            if i != gone:
                uses[i].append((gone, n))
    level = (inverse * counts).sum(axis=1)
    bound = float((lengths * counts).sum()) / size
    for _ in range(columns):
        value = float(level.sum())
        if value <= (1 + gap) * bound:
            break
        prices = inverse.sum(axis=0)
        pattern, worth = _knapsack(lengths, np.maximum(prices, 0), size)
        if worth <= 1 + 1e-9:
            break
        bound = max(bound, value / worth)
        entering = list(pattern)
        move = (inverse[:, entering] * np.array([pattern[i] for i in entering], float)).sum(axis=1)
        ratios = np.full(m, np.inf)
        ratios[move > 1e-9] = np.maximum(level[move > 1e-9], 0) / move[move > 1e-9]
        leaves = int(np.argmin(ratios))
        if not np.isfinite(ratios[leaves]):
            break
        row, step = inverse[leaves] / move[leaves], float(ratios[leaves])
        move[leaves] = 0.0
        used = np.flatnonzero(np.abs(move) > 1e-12)  # the basis is sparse: few rows change
        inverse[used] -= np.multiply.outer(move[used], row)
        level[used] -= move[used] * step
        inverse[leaves], level[leaves] = row, step
        basis[leaves] = pattern
    return basis, np.maximum(level, 0)


def patterns(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """Whole-number patterns {length: items} and their repeats that hold exactly the histogram's items."""
    result = []
    if full := histogram.get(size, 0):
        result.append(({size: 1}, full))
    lengths = np.array(sorted(n for n in histogram if n < size), np.int64)
    if not len(lengths):
        return result
    left = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    basis, level = solve(lengths, left.astype(float), size)
    for pattern, times in zip(basis, np.floor(level + 1e-9).astype(int).tolist()):
        times = min([times, *(int(left[i]) // n for i, n in pattern.items())])
        if times > 0:
            for i, n in pattern.items():
                left[i] -= times * n
            result.append(({int(lengths[i]): n for i, n in pattern.items()}, times))
    # What rounding down has left over, at most a few items a pattern.
    for pattern, times, _ in _greedy(lengths, left, size, whole=True):
        result.append(({int(lengths[i]): n for i, n in pattern.items()}, int(times)))
    return result


def slots(found: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, one past the last, items a sequence, first sequence, offset) of every part of a pattern."""
    rows, used, sequence = [], {}, 0
    for pattern, times in found:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n, first = pattern[length], used.get(length, 0)
            rows.append((length, first, first + times * n, n, sequence, offset))
            used[length] = first + times * n
            offset += n * length
        sequence += times
    return rows


def ranked(pieces: DataFrame, rows_per_task: int = RANKED_ROWS) -> DataFrame:
    """Adds each piece's rank, from 0, among those of equal length.

    Each length is split into slices by a hash of the id; slices are ranked side by side and start
    from the sizes of the slices before them, so one length may hold any part of all rows.
    """
    count = pieces.count()
    width = max(1, -(-count // rows_per_task))
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start"), F.lit(width)))
    sizes = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    local = sliced.withColumn("place", F.row_number().over(inside) - 1)
    return local.join(begin, ["length", "slice"]).withColumn("rank", F.col("place") + F.col("begin")).drop("place", "begin", "slice")


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is packed: a null text as the empty one (a single end id), repeated
    rows and null ids each by themselves. A longer document is cut at multiples of ``size``. An
    empty table gives an empty result. Texts are tokenised once; the pieces are written
    to the shared folder, so that ranks and histogram see the same rows even after executors are lost.
    """
    spark = docs.sparkSession
    cut = texts(docs).mapInArrow(_cutter(tokenizer_bytes(tokenizer_path), size, end_id), PIECES)
    pieces = materialize(spark, cut, "pieces")
    # At most ``size`` rows reach the driver.
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "slot_length long, first_rank long, end_rank long, items long, first_sequence long, slot_offset long"
    # Bounded by the number of lengths and patterns, whatever the number of documents.
    deal = F.broadcast(spark.createDataFrame(slots(patterns(histogram, size)), schema))
    inside = F.col("rank") - F.col("first_rank")
    return (
        ranked(pieces)
        .join(deal, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("first_sequence") + F.floor(inside / F.col("items"))).alias("sequence_id"),
            (F.col("slot_offset") + F.pmod(inside, F.col("items")) * F.col("length")).alias("offset"),
        )
    )
