"""What the operators share: the documents they read, and sizes that follow the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text bytes that one byte of stored Parquet is taken to hold when partitions are sized.
TEXT_PER_STORED_BYTE = 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the given folder, by any path that Spark can open."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row, a null text as the empty one. Other columns, whatever their names, stay behind."""
    # An id that needs no cast stays the plain column, so that exchanges of these rows can be told to be the same.
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))


def stored_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``, from the sizes of the files it reads."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets(df: DataFrame, bytes_per_bucket: int = 8 << 20, least: int = 64, most: int = 1 << 20) -> int:
    """A power of two of hash buckets, so that one holds about ``bytes_per_bucket`` of text at any input size."""
    wanted = stored_bytes(df) * TEXT_PER_STORED_BYTE // bytes_per_bucket
    return min(most, max(least, 1 << max(0, int(wanted - 1).bit_length())))


def in_fold(doc_id: Column | str) -> Column:
    """True for the documents held out of training: crc32 of the id as text, modulo 5, is 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))
