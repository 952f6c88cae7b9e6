"""Global numbering without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.session import materialize

# monotonically_increasing_id() keeps the row's place in its partition in the low 33 bits.
_PLACE_BITS = 33


def number_rows(spark: SparkSession, df: DataFrame, order: list[str], name: str, written: bool = False) -> DataFrame:
    """Adds 1, 2, 3, ... in the given order, whose columns must identify a row and not be NULL.

    Dealing out by ranges reads its input twice, once for a sample of the order columns. So the rows are written
    first, unless they are a written table already. The rows are range-partitioned and sorted by their order columns and written once, each with its
    partition and its place there. Every partition holds one stretch of the order, and a row's
    number is its place plus the rows of the stretches before, of which there are as many as
    partitions: no row is moved a second time.
    """
    df = df if written else materialize(spark, df, "numbering")
    tag = F.monotonically_increasing_id()
    stretches = materialize(
        spark,
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.shiftright(tag, _PLACE_BITS).alias("_part"),
            tag.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
        ),
        "stretches",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        stretches.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per partition, so its size is bounded by their number.
    numbered = stretches.join(F.broadcast(before), "_part")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place") + 1).alias(name))


def padded_id(prefix: str, number: Column, digits: int) -> Column:
    """Prefix and number, padded to at least ``digits`` digits and never cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0")))
