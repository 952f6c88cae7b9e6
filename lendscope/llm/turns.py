"""Conversation rows in one order over the whole table, numbered without a window over a conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.session import materialize

#: A word, and what a text without any consists of.
WORD = r"[^\x20\x09-\x0D]+"
# monotonically_increasing_id() keeps the partition above these bits.
_PLACE_BITS = 33


def part(place: Column | str = "place") -> Column:
    """The stretch of the order that a place lies in."""
    return F.shiftright(place, _PLACE_BITS)


def in_order(rows: DataFrame, order: list[str], keep: list[Column | str], purpose: str) -> DataFrame:
    """The columns ``keep`` of all rows, written once, with ``place`` (long), which ascends along ``order``, nulls first.

    The rows are dealt out by ranges of the order, so one conversation may lie in many stretches and no
    task has to hold it. Rows that are the same in all of ``order`` follow each other in the order they are read in.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(name).asc_nulls_first() for name in (*order, "_tie")]
    dealt = tied.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(rows.sparkSession, dealt.select(*keep, F.monotonically_increasing_id().alias("place")), purpose)


def numbered(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Adds ``ordinal`` (from 1) and ``n_rows`` of each row's conversation to what ``in_order`` wrote in the order of ``key`` first.

    The rows of a conversation stand together within a stretch, so a place less the first one there, plus the
    rows of the stretches before, is the number: only one row per conversation and stretch is gathered.
    """
    stretches = rows.groupBy(F.col(key).alias("_key"), part().alias("_part")).agg(
        F.min("place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    whole = Window.partitionBy("_key")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(
        "_key",
        "_part",
        (F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0)) - 1).alias("_zero"),
        F.sum("_rows").over(whole).alias("n_rows"),
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (part() == F.col("_part"))
    return rows.join(starts, same).select(*rows.columns, (F.col("place") - F.col("_zero")).alias("ordinal"), "n_rows")
