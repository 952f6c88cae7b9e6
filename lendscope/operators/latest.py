"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(column: str) -> Column:
    """Descending with NULL first, as the model's source dialect sorts."""
    return F.col(column).desc_nulls_first()


def ranked(df: DataFrame, keys: list[str], order: list[Column], rows: int, rank: str = "rank") -> DataFrame:
    """The first ``rows`` rows of every key, numbered from 1.

    Spark limits each group inside every task before the shuffle, so a key that
    holds a large part of the table sends at most ``rows`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= rows)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order, which must end in a unique column."""
    return ranked(df, keys, order, 1, "_rank").drop("_rank")
