"""Running totals that do not put one key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame, key: str, order: list[str], slice_by: Column, amount: Column, name: str
) -> DataFrame:
    """Running sum of ``amount`` per ``key`` in ``order``.

    ``slice_by`` must not decrease along ``order`` (the day of the timestamp, for
    example), and should hold several rows of a key, because every slice adds one. Each (key, slice) is summed on its own, starting from the totals of the
    earlier slices. A hot key is thereby spread over all its slices, and only its
    slice totals meet in one task.
    """
    rows = df.withColumn("_slice", slice_by).withColumn("_amount", amount)
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # What the earlier slices add up to enters each slice as a row before its first.
    carried = (
        rows.groupBy(key, "_slice")
        .agg(F.sum("_amount").alias("_amount"))
        .withColumn("_amount", F.coalesce(F.sum("_amount").over(before), F.lit(0)))
        .withColumn("_own", F.lit(False))
    )
    inside = Window.partitionBy(key, "_slice").orderBy("_own", *order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_own", F.lit(True))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.sum("_amount").over(inside))
        .filter("_own")
        .drop("_slice", "_amount", "_own")
    )
