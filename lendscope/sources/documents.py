"""Document files: listing, parsing and rule-based field extraction."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import urlparse

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope import fixed
from lendscope.functions.text import markup_text, route_words
from lendscope.operators.maintenance import Versions
from lendscope.operators.sections import join_ranges, plan_ranges
from lendscope.session import materialize

Parser = Callable[..., str]


def list_documents(spark: SparkSession, folder: str, below: str = "policies/", name: str = "*.pdf") -> DataFrame:
    """file_name (path below ``folder``), file_size and file_hash of every file under ``folder/below``.

    Sub-folders are included. All files are read; see :class:`Manifest` for a folder that is listed again and again.
    """
    if _is_local(folder):
        found = _files(spark, folder, below, name).withColumn("file_hash", _opener(spark, True)("path", "length"))
    else:
        found = _scanned(spark, folder, below, name).withColumn("file_hash", F.md5("content"))
    return found.select("file_name", F.col("length").alias("file_size"), "file_hash")


#: Folders that one listing task walks, about.
FOLDERS_PER_TASK = 8


def _is_local(folder: str) -> bool:
    return urlparse(folder).scheme in ("", "file")


def _named(files: DataFrame, below: str) -> DataFrame:
    """With the file's path below the folder as ``file_name``."""
    return files.withColumn("file_name", F.concat(F.lit(below), F.substring_index("path", f"/{below}", -1)))


def _scanned(spark: SparkSession, folder: str, below: str, name: str) -> DataFrame:
    """Every file under ``folder/below`` by Spark's reader, which opens one only where its content is asked for."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .load(f"{folder.rstrip('/')}/{below}")
    )
    return _named(files.withColumnRenamed("modificationTime", "modified"), below)


def _files(spark: SparkSession, folder: str, below: str, name: str) -> DataFrame:
    """path, length, modified and file_name of every file under ``folder/below``; none is opened.

    Spark's reader keeps every file and a task for a few of them in the driver. On local disks the driver therefore reads only
    the folders right below, and tasks walk them. Other stores are listed by the reader. What it passes over is passed over here.
    """
    if not _is_local(folder):
        return _scanned(spark, folder, below, name).select("path", "length", "modified", "file_name")
    wanted = spark._jvm.org.apache.hadoop.fs.GlobPattern(name).compiled().pattern()

    def hidden(entry: str) -> bool:
        if entry.startswith(("_common_metadata", "_metadata")):
            return False
        return entry.startswith(".") or entry.startswith("_") and "=" not in entry or entry.endswith("._COPYING_")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = re.compile(wanted, re.DOTALL).fullmatch
        for batch in batches:
            for row in batch.to_pylist():
                open_folders, rows = [row["folder"]], []
                while open_folders:
                    with os.scandir(open_folders.pop()) as entries:
                        for entry in entries:
                            try:
                                if hidden(entry.name):
                                    continue
                                if entry.is_dir():
                                    if row["deep"]:
                                        open_folders.append(entry.path)
                                elif matches(entry.name):
                                    status = entry.stat()
                                    if status.st_size:
                                        rows.append((f"file:{entry.path}", status.st_size, status.st_mtime_ns // 1_000_000))
                            except FileNotFoundError:  # it has gone meanwhile
                                continue
                    if rows and (len(rows) > 10_000 or not open_folders):
                        yield pa.RecordBatch.from_arrays([pa.array(values) for values in zip(*rows)], ["path", "length", "changed"])
                        rows = []

    # The path as Spark's reader takes it: absolute, without doubled slashes.
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{below}").toUri().getPath()
    root = os.path.abspath(root)
    with os.scandir(root) as entries:
        folders = [(entry.path, True) for entry in entries if not hidden(entry.name) and entry.is_dir()]
    tasks = max(1, min(len(folders), spark.sparkContext.defaultParallelism), -(-len(folders) // FOLDERS_PER_TASK))
    given = spark.createDataFrame([(root, False), *folders], "folder string, deep boolean").repartition(tasks)
    found = given.mapInArrow(walk, "path string, length long, changed long")
    return _named(found.select("path", "length", F.timestamp_millis("changed").alias("modified")), below)


def _opener(spark: SparkSession, hashed: bool) -> Callable[..., Column]:
    """A function of columns (path, length): the bytes of local files, or their hash, read in the tasks a few rows at a time."""
    most = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))

    def opened(path: str, length: int) -> bytes | str:
        if length > most:
            raise ValueError(f"{path} has {length} bytes, more than spark.sql.sources.binaryFile.maxLength ({most})")
        with open(path.removeprefix("file:"), "rb") as file:
            return hashlib.file_digest(file, "md5").hexdigest() if hashed else file.read()

    # Not deterministic, so that a file is opened once however often its column is used.
    return F.udf(opened, T.StringType() if hashed else T.BinaryType(), useArrow=False).asNondeterministic()


def read_contents(spark: SparkSession, folder: str, name: str = "*") -> DataFrame:
    """Path and bytes of every file under a folder."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .load(folder)
        .select("path", "length", "content")
    )


def contents_of(wanted: DataFrame, folder: str, below: str = "policies/", name: str = "*.pdf") -> DataFrame:
    """``wanted`` (file_name, modified and others) with the bytes of those files as ``content``.

    Files older than the oldest that is wanted are passed over by the reader, unopened. They are dealt anew: the reader
    has a task for a few dozen files, and whatever is written from its tasks would be in as many pieces. On local disks
    only their names are dealt, and no content moves.
    """
    spark, oldest = wanted.sparkSession, wanted.agg(F.min("modified")).first()[0]
    if not _is_local(folder):
        files = _scanned(spark, folder, below, name).where(F.col("modified") >= F.lit(oldest))
        return wanted.join(files.select("file_name", "content"), "file_name").repartition("file_name")
    files = _files(spark, folder, below, name).where(F.col("modified") >= F.lit(oldest))
    paths = wanted.join(files.select("file_name", F.col("path").alias("_path"), F.col("length").alias("_length")), "file_name")
    return paths.repartition("file_name").withColumn("content", _opener(spark, False)("_path", "_length")).drop("_path", "_length")


class Manifest:
    """The files below a folder with size, time of change and hash, kept as published versions below ``base``.

    A refresh lists the folder and opens only files that are new, or differ from the last version in size or time.
    """

    def __init__(self, spark: SparkSession, base: str, folder: str, below: str = "policies/", name: str = "*.pdf"):
        self.spark = spark
        self.folder, self.below, self.name = folder, below, name
        self.versions = Versions(spark, base)

    def read(self) -> DataFrame:
        """file_name, file_size, modified, file_hash as the last refresh found them."""
        return self.versions.read()

    def refresh(self) -> int:
        """Publish what is there now; the number of files that were opened."""
        listed = _files(self.spark, self.folder, self.below, self.name).select(
            "file_name", F.col("length").alias("file_size"), "modified", "path"
        )
        # Dealt anew, because a scan has a task for a few dozen files, and each task would write a file of its own.
        listed = materialize(self.spark, listed.repartition("file_name"), "listing")
        known = self.versions.read()
        if known is None:
            known = listed.limit(0).drop("path").withColumn("file_hash", F.lit(""))
        state = ["file_name", "file_size", "modified"]
        same = listed.drop("path").join(known, state)
        changed = materialize(self.spark, listed.join(known, state, "left_anti"), "changed-files")
        opened = changed.count()
        if opened:
            if _is_local(self.folder):
                read = changed.withColumn("file_hash", _opener(self.spark, True)("path", "file_size"))
            else:
                files = _scanned(self.spark, self.folder, self.below, self.name)
                read = changed.join(files.select("path", F.md5("content").alias("file_hash")), "path")
            same = same.unionByName(read.select(*same.columns))
        if opened or known.count() != listed.count():
            self.versions.write(same.repartition("file_name"))
        return opened


_ADDED = T.StructType(
    [
        T.StructField("parsed_text", T.StringType()),
        T.StructField("processing_status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def parse_with(df: DataFrame, content: str, parser: Parser, arguments: tuple[str, ...] = ()) -> DataFrame:
    """Adds parsed_text, processing_status and error_message, and drops the content.

    ``parser`` turns the bytes of one document (and the values of the argument
    columns) into text. A document it cannot read becomes FAILED with the message;
    the others go on.
    """
    others = [field for field in df.schema.fields if field.name != content]
    names = [field.name for field in _ADDED.fields]

    def attempt(value, *more) -> tuple:
        try:
            return parser(bytes(value), *more), "SUCCESS", None
        except Exception as error:  # one bad document must not stop the batch
            return None, "FAILED", str(error)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            results = [attempt(*row) for row in zip(frame[content], *(frame[name] for name in arguments))]
            parsed = pd.DataFrame(results, columns=names, index=frame.index, dtype=object)
            yield pd.concat([frame.drop(columns=[content]), parsed], axis=1)

    return df.mapInPandas(batches, T.StructType([*others, *_ADDED.fields]))


def parse_by_ranges(
    df: DataFrame, key: str, content: str, pages: str, parser: Parser, size: int = fixed.PAGES_PER_RANGE
) -> DataFrame:
    """key, parsed_text, processing_status, error_message; long documents are read in page ranges side by side.

    ``parser`` gets bytes, first page and end page. A document with a range that
    fails is FAILED with the message of its first such range. A document without
    pages has no range and is SUCCESS with an empty text.
    """
    ranges = plan_ranges(df.select(key, content, pages), pages, size).drop(pages)
    parts = parse_with(ranges, content, parser, ("range_start", "range_end"))
    # With the texts, so that every range is parsed once.
    failed = F.when(F.col("processing_status") == "FAILED", F.col("range_start"))
    error = F.min_by("error_message", failed).alias("error_message")
    texts = join_ranges(parts, key, "range_start", "parsed_text", "parsed_text", error)
    bad = F.col("error_message").isNotNull()
    return (
        df.select(key)
        .join(texts, key, "left")
        .select(
            key,
            F.when(~bad, F.coalesce("parsed_text", F.lit(""))).alias("parsed_text"),
            F.when(bad, "FAILED").otherwise("SUCCESS").alias("processing_status"),
            "error_message",
        )
    )


UNREADABLE = "no readable text"
#: What a decoder puts in place of bytes it cannot read.
_UNDECODED = "\ufffd"


def parse_text(df: DataFrame, text: str, markup: bool = True) -> DataFrame:
    """Built-in parser, in column expressions: plain text, or the readable text of markup.

    A document without any text, or with bytes that could not be decoded, is FAILED; numbers
    and tables are text like any other. Adds the same columns as :func:`parse_with`.
    """
    body = markup_text(F.col(text)) if markup else F.col(text)
    readable = (F.length(F.trim("_body")) > 0) & ~F.contains("_body", F.lit(_UNDECODED))
    return (
        df.withColumn("_body", body)
        .withColumn("_readable", F.coalesce(readable, F.lit(False)))
        .withColumn("parsed_text", F.when(F.col("_readable"), F.col("_body")))
        .withColumn("processing_status", F.when(F.col("_readable"), "SUCCESS").otherwise("FAILED"))
        .withColumn("error_message", F.when(~F.col("_readable"), F.lit(UNREADABLE)))
        .drop("_body", "_readable")
    )


class FieldRules(NamedTuple):
    """Default rules that read document fields out of text: a pattern's first group, or words per category."""

    issuing_authority: str = r"(?i)issued by:? ([^\n.]+)"
    reference_number: str = r"\b([A-Z]{2,6}/[0-9]{4}-[0-9]{2}/[0-9]+)"
    effective_date: str = r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b"
    categories: tuple = (
        ("ASSET_CLASSIFICATION", ("npa", "asset classification", "sub-standard")),
        ("PROVISIONING", ("provision",)),
        ("CAPITAL_ADEQUACY", ("capital", "basel")),
        ("EXPOSURE_LIMITS", ("exposure",)),
        ("RESOLUTION", ("resolution",)),
        ("INSOLVENCY", ("insolven", "bankrupt")),
    )


def _group(text: Column, pattern: str) -> Column:
    # As an array of one, so that the pattern is sought once and not again for the comparison.
    found = F.array(F.trim(F.regexp_extract(text, pattern, 1)))
    return F.get(F.transform(found, lambda value: F.when(value != "", value)), F.lit(0))


def document_fields(text: str, rules: FieldRules = FieldRules()) -> dict[str, Column]:
    """The five document fields as columns: the title is the first line that is not blank, without heading marks."""
    categories = F.array(*[F.when(route_words(text, words), F.lit(label)) for label, words in rules.categories])
    return {
        "title": _group(F.col(text), r"^\s*(?:#+ )?([^\n]+)"),
        "issuing_authority": _group(F.col(text), rules.issuing_authority),
        "reference_number": _group(F.col(text), rules.reference_number),
        "effective_date": F.try_to_date(_group(F.col(text), rules.effective_date), "yyyy-MM-dd"),
        "category": F.get(F.array_compact(categories), F.lit(0)),
    }
