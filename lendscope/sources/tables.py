"""Domain tables by name, from stored Parquet or from any other loader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.maintenance import Versions, append
from lendscope.sources.schemas import DEFAULTS, SCHEMAS, TIME_DEFAULTS


class Book:
    """The tables a plan reads. Each loader runs at most once per book."""

    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[["Book"], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._loaded: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            self._loaded[name] = self._loaders[name](self)
        return self._loaded[name]

    def replaced(self, **tables: DataFrame) -> "Book":
        """The same book with some tables taken from the given DataFrames."""
        book = Book(self.spark, self._loaders)
        book._loaded.update(self._loaded)
        book._loaded.update(tables)
        return book


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill NULL or missing columns with the declared defaults, as rows enter a table."""
    known = set(df.columns)
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in known else F.lit(value)
            for name, value in defaults.items()
        }
    )


def stored_book(spark: SparkSession, base: str) -> Book:
    """A book over ``base/<table>`` Parquet folders with the declared schemas.

    Stored NULLs stay NULL: defaults belong to the writing of a row. ``risk_scores``
    is the version that `plans.scoring.publish_scores` published last.
    """

    def loader(name: str) -> Callable[[Book], DataFrame]:
        return lambda _: spark.read.schema(SCHEMAS[name]).parquet(f"{base}/{name}")

    scores = {"risk_scores": lambda _: Versions(spark, f"{base}/risk_scores").read()}
    return Book(spark, {name: loader(name) for name in SCHEMAS} | scores)


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their order and type; a missing one is NULL."""
    known = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in known else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
    )


def insert(df: DataFrame, name: str, base: str) -> None:
    """Append rows to ``base/<table>``: a missing column gets its declared default, a given NULL stays NULL."""
    missing = {column: value for column, value in DEFAULTS.get(name, {}).items() if column not in df.columns}
    now = F.current_timestamp().cast("timestamp_ntz")
    times = {column: now for column in TIME_DEFAULTS.get(name, ()) if column not in df.columns}
    rows = df.withColumns({column: F.lit(value) for column, value in missing.items()} | times)
    append(shaped(rows, SCHEMAS[name]), f"{base}/{name}")
