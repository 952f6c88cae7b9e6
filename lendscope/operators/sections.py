"""Splitting documents into page ranges and sections, and putting ranges together again."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import fixed


def plan_ranges(df: DataFrame, pages: str, size: int = fixed.PAGES_PER_RANGE) -> DataFrame:
    """One row per page range [range_start, range_end). Up to ``size`` pages make one range, no page makes none."""
    count = F.col(pages)
    starts = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count.cast("long") - 1, F.lit(size).cast("long")))
    ranges = F.transform(
        starts,
        lambda start: F.struct(start.alias("range_start"), F.least(start + size, count.cast("long")).alias("range_end")),
    )
    return df.select("*", F.inline(ranges))


def join_ranges(parts: DataFrame, key: str, start: str, text: str, name: str, *more: Column) -> DataFrame:
    """Text of each document from its ranges in order.

    A single range is taken as it is; with several, each is preceded by a blank
    line. The group is one document, whose text has to fit into a row anyway. ``more`` are further aggregates of it.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(start).alias("start"), F.col(text).alias("text"))))
    pieces = F.transform(F.col("_parts"), lambda part: part["text"])
    whole = F.when(F.size("_parts") == 1, pieces[0]).otherwise(
        F.concat(F.lit("\n\n"), F.array_join(pieces, "\n\n"))
    )
    grouped = parts.groupBy(key).agg(ordered.alias("_parts"), *more)
    return grouped.select(key, whole.alias(name), *grouped.columns[2:])


def _or_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def split_sections(df: DataFrame, text: str, mark: str = fixed.SECTION_MARK) -> DataFrame:
    """One row per piece between marks, with piece_index, section (first line) and content (the rest).

    The whole text is left out of the result.
    Pieces of at most ten characters are dropped. The text before the first mark is a
    piece, and a deeper heading leaves its extra '#' at the end of the piece before. A
    piece without a line break has NULL content.
    """
    pieces = F.split(F.col(text), re.escape(mark))
    broken = F.locate("\n", F.col("_piece"))
    others = [column for column in df.columns if column != text]
    return (
        df.select(*others, F.posexplode(pieces).alias("piece_index", "_piece"))
        .filter(F.length(F.trim("_piece")) > fixed.SECTION_MIN_LENGTH)
        .withColumn("section", F.trim(_or_null(F.substring_index("_piece", "\n", 1))))
        .withColumn("content", F.trim(_or_null(F.when(broken > 0, F.substr("_piece", broken + 1)))))
        .drop("_piece")
    )
