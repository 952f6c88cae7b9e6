"""Table maintenance on plain Parquet: append, replace by key, versions that switch last."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key is not in the new batch, and all new rows. A NULL key replaces nothing."""
    return surviving(old, new, key).unionByName(new, allowMissingColumns=True)


def surviving(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key does not occur in the new batch."""
    return old.join(new.select(key).distinct(), key, "left_anti")


def new_files(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that were never read with success under the same name and hash; a failed file comes again."""
    done = known.filter(F.col("processing_status") == "SUCCESS").select("file_name", "file_hash")
    return listing.join(done, ["file_name", "file_hash"], "left_anti")


def input_state(df: DataFrame) -> str:
    """A digest of the files a DataFrame reads: it changes when one is added, removed or written again.

    Folders are listed, no file is opened.
    """
    spark = df.sparkSession
    files = set(df.inputFiles())
    conf, state = spark._jsc.hadoopConfiguration(), []
    for folder in sorted({name.rsplit("/", 1)[0] for name in files}):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        for status in path.getFileSystem(conf).listStatus(path):
            if status.getPath().toUri().toString() in files or status.getPath().toString() in files:
                state.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr((sorted(files), sorted(state))).encode()).hexdigest()


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, or no rows when it was not written yet."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


class Versions:
    """A table kept as whole versions. A version is written completely before it is published.

    Every attempt has a folder of its own, and publishing appends one row (version, path) to a
    small log. Readers take the highest published version, of several attempts at it
    the one published last. A job that dies half-way, also one that repeats a version
    that is live, leaves what was published untouched.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _live(self) -> Row | None:
        log = f"{self.base}/published"
        if not table_exists(self.spark, log):
            return None
        newest = F.max_by(F.struct("version", "path"), F.struct("version", "published_at")).alias("live")
        return self.spark.read.parquet(log).agg(newest).first()["live"]

    def published(self) -> int | None:
        live = self._live()
        return None if live is None else live["version"]

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write and publish the next (or the given) version."""
        if version is None:
            current = self.published()
            version = 0 if current is None else current + 1
        path = f"version={version}/attempt={uuid.uuid4().hex}"
        df.write.parquet(f"{self.base}/{path}")
        entry = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"), F.lit(path).alias("path"), F.current_timestamp().alias("published_at")
        )
        append(entry, f"{self.base}/published")
        return version

    def read(self) -> DataFrame | None:
        live = self._live()
        return None if live is None else self.spark.read.parquet(f"{self.base}/{live['path']}")
