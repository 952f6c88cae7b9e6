"""Macro feed: JSON files to typed indicators, incrementally, with refreshed scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendscope.operators.latest import latest
from lendscope.operators.maintenance import Versions, read_or_empty
from lendscope.session import materialize
from lendscope.sources.schemas import DEFAULTS, SCHEMAS
from lendscope.sources.tables import with_defaults
from lendscope.streaming.record_scan import scanned_records

# --- fixed values: feed keys, the columns they fill and their types ---
FEED_FIELDS = (
    ("indicator_id", "indicator_id", "string"),
    ("indicator_name", "indicator_name", "string"),
    ("category", "indicator_category", "string"),
    ("value", "value", "double"),
    ("previous_value", "previous_value", "double"),
    ("change_pct", "change_pct", "double"),
    ("unit", "unit", "string"),
    ("report_date", "report_date", "date"),
    ("frequency", "frequency", "string"),
    ("source", "source", "string"),
    ("region", "region", "string"),
)
REQUIRED = ("indicator_id", "indicator_name", "indicator_category", "value", "report_date")
INDICATOR_COLUMNS = [column for _, column, _ in FEED_FIELDS]
_TEXT = T.StructType([T.StructField("value", T.StringType())])


_FILE = (
    "_metadata.file_name AS source_file",
    "_metadata.file_path AS source_path",
    "_metadata.file_block_start AS source_block",
)


def _document() -> Column:
    """The one JSON value that ``value`` is; NULL where it is not one.

    The parser alone would read the first value and pass over whatever follows.
    """
    held = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(held) == 1, F.get(held, F.lit(0)))


def _to_raw(texts: DataFrame) -> DataFrame:
    """raw_data (variant), source_file and text of every record; raw_data is NULL where the text is not JSON.

    An outer array becomes one row per element.
    """
    records = (
        texts.filter(F.length(F.trim("value")) > 0)
        .withColumn("_document", _document())
        .withColumn("_list", F.try_variant_get("_document", "$", "array<variant>"))
    )
    return records.select(
        F.explode(F.coalesce("_list", F.array("_document"))).alias("raw_data"),
        "source_file",
        F.col("value").alias("text"),
    )


def records(lines: DataFrame) -> DataFrame:
    """The records of feed files given as lines: one value a line, values and arrays over many lines, or all of these mixed.

    Files whose every line is JSON are read line by line, in parallel. Only those with a line that is none are
    scanned for the ends of their records, each in one task that holds one record at a time. What is no JSON then either
    stays a record, without a value.
    """
    if "source_block" not in lines.columns:
        lines = lines.withColumn("source_block", F.lit(0).cast("long"))
    lines = lines.withColumn("_at", F.monotonically_increasing_id())
    broken = lines.filter((F.length(F.trim("value")) > 0) & _document().isNull()).select("source_path").distinct()
    if broken.isEmpty():
        return _to_raw(lines)
    torn = scanned_records(lines.join(broken, "source_path", "left_semi"))
    whole = lines.join(broken, "source_path", "left_anti")
    return _to_raw(torn).unionByName(_to_raw(whole))


def read_feed(spark: SparkSession, folder: str) -> DataFrame:
    """All feed records of a folder as a batch."""
    return records(spark.read.text(folder).selectExpr("value", *_FILE))


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the feed files as a stream: every file is read once, as the checkpoint of the query remembers."""
    reader = spark.readStream.schema(_TEXT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format("text").load(folder).selectExpr("value", *_FILE)


def stream_feed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Feed records as a stream, for files of one JSON value per line."""
    return _to_raw(stream_lines(spark, folder, files_per_batch))


def parse_indicators(raw: DataFrame) -> DataFrame:
    """The eleven typed columns beside the raw ones. A value of the wrong type becomes NULL."""
    typed = raw.select(
        "*", *[F.try_variant_get("raw_data", f"$.{key}", kind).alias(column) for key, column, kind in FEED_FIELDS]
    )
    return with_defaults(typed, DEFAULTS["macro_economic_indicators"])


def is_good() -> Column:
    """A record counts when it has all required columns."""
    good = F.lit(True)
    for column in REQUIRED:
        good = good & F.col(column).isNotNull()
    return good


def good_indicators(raw: DataFrame) -> DataFrame:
    return parse_indicators(raw).filter(is_good()).select(*INDICATOR_COLUMNS)


def quarantined(raw: DataFrame) -> DataFrame:
    """Records that are no JSON or lack a required column, with the reason."""
    reason = F.when(F.col("raw_data").isNull(), "not JSON").otherwise("missing or mistyped column")
    return parse_indicators(raw).filter(~is_good()).select("source_file", "text", reason.alias("reason"))


def one_per_id(df: DataFrame) -> DataFrame:
    """One row per indicator_id: the last batch, in it the newest report, then the highest value."""
    return latest(
        df,
        ["indicator_id"],
        [F.desc("batch"), F.desc_nulls_last("report_date"), F.desc_nulls_last("value"), F.asc("indicator_name")],
    )


class FeedTables:
    """Stored results of the feed below one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.raw_path = f"{base}/macro_economic_raw"
        self.indicators_path = f"{base}/macro_economic_indicators"
        self.quarantine_path = f"{base}/quarantine"
        self.checkpoint = f"{base}/checkpoint"
        self.scores = Versions(spark, f"{base}/risk_scores")

    def _landed(self) -> DataFrame:
        raw = SCHEMAS["macro_economic_raw"]
        return read_or_empty(self.spark, self.raw_path, T.StructType([*raw.fields, T.StructField("text", T.StringType())]))

    def raw(self) -> DataFrame:
        """The landing table: every record that is JSON, with its file."""
        return self._landed().filter(F.col("raw_data").isNotNull()).drop("text")

    def indicators(self) -> DataFrame:
        """All accepted indicators, repeated and revised ones too, with the batch they came in."""
        schema = T.StructType(
            [field for field in SCHEMAS["macro_economic_indicators"].fields if field.name in INDICATOR_COLUMNS]
        )
        stored = read_or_empty(
            self.spark, self.indicators_path, T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        )
        return stored.select(*INDICATOR_COLUMNS, "batch")

    def current(self) -> DataFrame:
        """One row per indicator_id: what came last, so that a revision counts."""
        return one_per_id(self.indicators()).drop("batch")

    def add(self, lines: DataFrame, batch_id: int) -> None:
        """Write one micro-batch into its own folders: a repeated batch overwrites itself.

        The records are landed once; what is accepted and what is set aside is read from there.
        """
        landing = f"{self.raw_path}/batch={batch_id}"
        now = F.current_timestamp().cast("timestamp_ntz").alias("loaded_at")
        records(lines).select("raw_data", "source_file", now, "text").write.mode("overwrite").parquet(landing)
        batch = self.spark.read.schema(self._landed().schema).parquet(landing)
        quarantined(batch).write.mode("overwrite").parquet(f"{self.quarantine_path}/batch={batch_id}")
        good_indicators(batch).write.mode("overwrite").parquet(f"{self.indicators_path}/batch={batch_id}")


def run_feed(
    spark: SparkSession,
    folder: str,
    base: str,
    refresh: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
) -> FeedTables:
    """Read what is new in the feed folder, then stop.

    Each micro-batch is appended. With ``refresh`` (a function from the current
    indicators to the score table) the scores are then written once, after the last
    batch, as a new version that is published last; a run that died before is made
    up for, because the version counts the batches it holds. Without new files nothing runs at all.
    """
    tables = FeedTables(spark, base)
    query: StreamingQuery = (
        stream_lines(spark, folder, files_per_batch)
        .writeStream.foreachBatch(tables.add)
        .option("checkpointLocation", tables.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if refresh is not None:
        newest = tables.indicators().agg(F.max("batch")).first()[0]
        published = tables.scores.published()
        if newest is not None and (published is None or published < newest):
            tables.scores.write(refresh(tables.current()), version=newest)
    return tables


def latest_per_indicator(stream: DataFrame) -> DataFrame:
    """Streaming state with the newest report per indicator; a late older report changes nothing.

    For an indicator stream with ``outputMode("update")`` or ``"complete"``. One small state row per indicator.
    """
    newest = F.max(
        F.struct(
            "report_date", "indicator_id", "indicator_category", "value", "previous_value", "change_pct", "unit", "source"
        )
    )
    return stream.groupBy("indicator_name").agg(newest.alias("newest")).select("indicator_name", "newest.*")


def merge_news(versions: Versions, news: DataFrame, number: int) -> bool:
    """Bring the live table of newest reports up to a batch of them; without anything that differs nothing is written.

    A batch that is delivered again finds its rows in the table already.
    """
    live = versions.read()
    if live is not None:
        news = materialize(news.sparkSession, news.select(*live.columns).subtract(live), "news")
    if news.isEmpty():
        return False
    rest = news if live is None else live.join(news, "indicator_name", "left_anti").unionByName(news)
    versions.write(rest, version=number)
    return True


def follow_latest(spark: SparkSession, folder: str, base: str, files_per_batch: int | None = None) -> Versions:
    """Read what is new in a feed of one value per line into the table of each indicator's newest report, then stop.

    The newest reports are streaming state; a batch gives out only the indicators that it has brought reports of, and
    only those that differ from the live table are merged into it.
    """
    versions = Versions(spark, f"{base}/latest")
    stream = good_indicators(stream_feed(spark, folder, files_per_batch))
    query: StreamingQuery = (
        latest_per_indicator(stream)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: merge_news(versions, batch, number))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return versions
