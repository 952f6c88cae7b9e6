"""Document ingestion: detect, parse, split, number, replace, log."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope import fixed
from lendscope.functions.text import fill, or_missing
from lendscope.operators.commits import CommitLog, Conflict
from lendscope.operators.latest import latest
from lendscope.operators.maintenance import append, new_files, read_or_empty, surviving
from lendscope.operators.numbering import number_rows, padded_id
from lendscope.operators.sections import split_sections
from lendscope.providers import Provider, Replies, extract_fields
from lendscope.session import materialize
from lendscope.sources.documents import FieldRules, document_fields
from lendscope.sources.schemas import DEFAULTS, SCHEMAS
from lendscope.sources.tables import shaped, with_defaults


def with_fields(
    docs: DataFrame,
    rules: FieldRules = FieldRules(),
    provider: Provider | None = None,
    questions: dict[str, str] | None = None,
    replies: Replies | None = None,
) -> DataFrame:
    """Adds the document fields, by column rules or by a provider, which is told the questions if there are any."""
    if provider is None:
        return docs.withColumns(document_fields("parsed_text", rules))
    found = extract_fields(docs, "parsed_text", fixed.DOCUMENT_FIELDS, provider, questions, replies)
    return found.withColumn("effective_date", F.try_to_date("effective_date", "yyyy-MM-dd"))


def policy_sections(docs: DataFrame) -> DataFrame:
    """Sections of parsed documents, with content possibly NULL."""
    return split_sections(docs, "parsed_text")


def in_run(docs: DataFrame, run_id: str) -> DataFrame:
    """Documents read in one run."""
    return docs.filter(F.col("run_id") == run_id)


def recent(docs: DataFrame, now: Column, hours: int = 1) -> DataFrame:
    """Documents read within the last hours, whatever run read them."""
    return docs.filter(F.col("processed_at") >= now - F.make_interval(hours=F.lit(hours)))


def unusable() -> Column:
    """A policy needs a title and content; other sections are kept aside, they do not stop the run."""
    return F.col("title").isNull() | F.col("content").isNull()


def highest_number(policies: DataFrame) -> Column:
    """Highest number among existing policy ids, 0 without one, as a scalar subquery."""
    digits = F.replace(F.col("policy_id"), F.lit(fixed.POLICY_PREFIX), F.lit(""))
    return policies.agg(F.coalesce(F.max(digits.try_cast("long")), F.lit(0).cast("long"))).scalar()


def assign_policy_ids(
    spark: SparkSession, sections: DataFrame, existing: DataFrame | None, order: list[str], written: bool = False
) -> DataFrame:
    """Running ids in the order of file and piece, continuing after the highest existing one."""
    numbered = number_rows(spark, sections, order, "_number", written)
    number = F.col("_number")
    if existing is not None:
        numbered = numbered.withColumn("_highest", highest_number(existing))
        number = number + F.col("_highest")
    identified = numbered.withColumn("policy_id", padded_id(fixed.POLICY_PREFIX, number, fixed.POLICY_DIGITS))
    return identified.drop("_number", "_highest")


def replace_policies(spark: SparkSession, existing: DataFrame, sections: DataFrame, order: list[str]) -> DataFrame:
    """Policies without those whose title is in the new batch, plus the new batch under new ids."""
    batch = materialize(spark, sections, "batch")
    kept = surviving(existing, batch, "title")
    return kept.unionByName(assign_policy_ids(spark, batch, kept, order, written=True), allowMissingColumns=True)


def error_rows(docs: DataFrame) -> DataFrame:
    """One row per failed document: its name and the line ``file: error``."""
    line = fill(fixed.ERROR_FORMAT, file="file_name", error=or_missing("error_message", ""))
    return docs.filter(F.col("processing_status") == "FAILED").select("file_name", line.alias("line"))


def error_text(docs: DataFrame) -> DataFrame:
    """One row: the lines of all failed documents in the order of their names, joined by ' | '; NULL without any.

    It is one value of one row of the run log, so it holds the failures of one run.
    """
    lines = F.array_sort(F.collect_list(F.struct("file_name", "line")))
    text = F.array_join(F.transform(lines, lambda item: item["line"]), fixed.ERROR_SEPARATOR)
    return error_rows(docs).agg(F.nullif(text, F.lit("")).alias("error_summary"))


def run_summary(detected: Column | int, docs: DataFrame, run_id: str, policies: Column | int) -> DataFrame:
    """One row of the run log with its result text; ``docs`` are the documents read in this run."""
    counts = docs.agg(
        F.count(F.lit(1)).alias("files_new"),
        F.count_if(F.col("processing_status") == "SUCCESS").alias("files_processed"),
        F.count_if(F.col("processing_status") == "FAILED").alias("files_failed"),
    )

    def as_column(value: Column | int) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("long")

    row = counts.select(
        F.lit(run_id).alias("run_id"),
        as_column(detected).alias("files_detected"),
        "files_new",
        "files_processed",
        "files_failed",
        as_column(policies).alias("policies_loaded"),
        F.when(F.col("files_failed") > 0, "PARTIAL").otherwise("SUCCESS").alias("status"),
    ).withColumn("error_summary", error_text(docs).scalar())
    result = fill(
        fixed.RUN_RESULT_FORMAT,
        run="run_id",
        detected="files_detected",
        new="files_new",
        processed="files_processed",
        failed="files_failed",
        policies="policies_loaded",
    )
    return row.withColumn("result", result)


LOG_SCHEMA = T.StructType(
    [
        *SCHEMAS["pdf_processing_log"].fields,
        T.StructField("result", T.StringType()),
    ]
)


class Library:
    """The stored state of the ingestion. All tables only grow, so a run writes no more than its own batch.

    ``documents`` holds every read attempt, ``policies`` the sections of every batch and ``titles``
    the titles each batch replaced. Each table has a folder per batch, whose number a run claims for itself, and a batch counts
    from when it is published, which is the last thing a run does: a run that dies before leaves
    nothing that is read. Of two runs at a time the second one to publish finds that the tables have moved on, and
    starts again from what the other has left to do. A policy counts while its batch is the last one of its title.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.documents = f"{base}/regulatory_docs_raw"
        self.policies = f"{base}/regulatory_policies"
        self.titles = f"{base}/policy_titles"
        self.quarantine = f"{base}/unusable_sections"
        self.errors = f"{base}/errors"
        self.published = CommitLog(spark, f"{base}/published_batches", "batch long, run_id string")
        self.claimed = CommitLog(spark, f"{base}/claimed_batches", "run_id string")
        self.log = f"{base}/pdf_processing_log"

    def write(self, df: DataFrame, path: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    def publish(self, batch: int, run_id: str, seen: int) -> bool:
        """Make a batch count; False when another run has published since ``seen`` was the last entry."""
        return self.published.commit(seen + 1, batch=batch, run_id=run_id)

    def batches(self) -> list[int]:
        """The published batches: one number per run that was completed."""
        return sorted(entry["batch"] for entry in self.published.entries())

    def read(self, path: str, schema: T.StructType) -> DataFrame:
        """The rows of published batches, from their folders alone: what a dead run left is not even listed."""
        folders = [f"{path}/batch={batch}" for batch in self.batches()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)

    def read_documents(self) -> DataFrame:
        return self.read(self.documents, DOCUMENT_SCHEMA)

    def known_files(self) -> DataFrame:
        """Hash of the newest successful read of every file."""
        good = self.read_documents().filter(F.col("processing_status") == "SUCCESS")
        return good.groupBy("file_name").agg(
            F.max_by("file_hash", "batch").alias("file_hash"), F.lit("SUCCESS").alias("processing_status")
        )

    def live_policies(self, *columns: Column | str) -> DataFrame:
        """The policies that count. With ``columns``, title, batch and those alone, taken before the policies meet the titles."""
        last = self.read(self.titles, TITLE_SCHEMA).groupBy("title").agg(F.max("batch").alias("batch"))
        rows = self.read(self.policies, POLICY_SCHEMA)
        return (rows.select("title", "batch", *columns) if columns else rows).join(last, ["title", "batch"], "left_semi")

    def next_batch(self, run_id: str) -> int:
        """A number above all earlier ones, claimed by this run: no other one writes into its folders."""
        number = max(self.claimed.last(), *self.batches(), 0) + 1
        while not self.claimed.commit(number, run_id=run_id):
            number += 1
        return number

    def note(self, row: DataFrame) -> None:
        """Append a row to the run log; columns that are not given get their declared defaults."""
        missing = {name: F.lit(value) for name, value in DEFAULTS["pdf_processing_log"].items() if name not in row.columns}
        append(shaped(row.withColumns(missing), LOG_SCHEMA), self.log)

    def read_log(self) -> DataFrame:
        """The last word on every run: RUNNING until it has ended."""
        rows = read_or_empty(self.spark, self.log, LOG_SCHEMA)
        return latest(rows, ["run_id"], [F.desc_nulls_last("run_completed_at"), F.desc("status")])


_BATCH = T.StructField("batch", T.LongType())
DOCUMENT_SCHEMA = T.StructType([*SCHEMAS["regulatory_docs_raw"].fields, _BATCH])
POLICY_SCHEMA = T.StructType([*SCHEMAS["regulatory_policies"].fields, _BATCH])
TITLE_SCHEMA = T.StructType([T.StructField("title", T.StringType()), _BATCH])
#: Runs that start again because another one has published meanwhile, before they give up.
ATTEMPTS = 5


def ingest(
    spark: SparkSession,
    base: str,
    listing: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    rules: FieldRules = FieldRules(),
    provider: Provider | None = None,
    run_id: str | None = None,
    questions: dict[str, str] | None = None,
    replies: Replies | None = None,
) -> str:
    """One ingestion run over a listing (file_name, file_size, file_hash).

    ``parse`` gets the listed rows of the new files, reads their contents and adds
    parsed_text, processing_status and error_message (and page_count, where it is known). Only new or changed files
    are parsed, and only their batch is written. A failed file keeps its earlier text and policies and comes again in
    the next run. The log has a RUNNING row from the start on, and at the end one with the counts and
    the failures, or FAILED with the message. Returns the one-line result.
    """
    run_id = run_id or str(uuid.uuid4())
    library = Library(spark, base)
    now = F.current_timestamp().cast("timestamp_ntz")
    # The start is one value, however often it is read.
    started = F.lit(spark.range(1).select(now).first()[0])
    library.note(spark.range(1).select(F.lit(run_id).alias("run_id"), started.alias("run_started_at")))
    try:
        for _ in range(ATTEMPTS):
            seen = library.published.last()
            batch = library.next_batch(run_id)
            # The list of new files is written, so that its true size decides how it meets the contents.
            todo = materialize(spark, new_files(listing, library.known_files()), "new-files")
            fresh = parse(todo).withColumns({"processed_at": now, "loaded_at": now})
            # Parsing and extraction may call a provider: run each once and keep the result. The texts are kept by the batch's own
            # documents, where a document is known by its file and place.
            fresh = shaped(with_defaults(fresh, DEFAULTS["regulatory_docs_raw"]), DOCUMENT_SCHEMA).drop("batch")
            library.write(fresh, library.documents, batch)
            written = spark.read.schema(fresh.schema).parquet(f"{library.documents}/batch={batch}")
            parsed = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
            good = parsed.filter(F.col("processing_status") == "SUCCESS")
            described = with_fields(good, rules, provider, questions, replies)
            if provider is not None:
                described = materialize(spark, described, "described")
            sections = policy_sections(described)
            usable = _policy_columns(sections.filter(~unusable()), run_id)

            before = library.live_policies()
            count_before = before.count()
            titles = described.filter(F.col("title").isNotNull()).select("title").distinct()
            library.write(titles, library.titles, batch)
            kept = surviving(before, spark.read.schema(titles.schema).parquet(f"{library.titles}/batch={batch}"), "title")
            # Only the keys are numbered, which moves them several times; the sections themselves move once, to their numbers.
            order, here = ["file_name", "piece_index"], ["_file", "_row", "piece_index"]
            ids = assign_policy_ids(spark, usable.select("_file", "_row", *order), kept, order).select(*here, "policy_id")
            added = usable.join(ids, here)
            aside = sections.filter(unusable()).select("file_name", "piece_index", "title", "section", F.lit(run_id).alias("run_id"))
            library.write(shaped(added.withColumn("created_at", now), POLICY_SCHEMA).drop("batch"), library.policies, batch)
            library.write(aside, library.quarantine, batch)
            library.write(error_rows(parsed).withColumn("run_id", F.lit(run_id)), library.errors, batch)
            if library.publish(batch, run_id, seen):
                break
        else:
            raise Conflict(f"{ATTEMPTS} other runs published meanwhile")

        loaded = library.live_policies().count() - count_before
        summary = run_summary(listing.count(), parsed, run_id, loaded)
        library.note(summary.withColumns({"run_started_at": started, "run_completed_at": now}))
        return library.read_log().filter(F.col("run_id") == run_id).first()["result"]
    except Exception as error:
        text = f"Run {run_id} FAILED: {error}"
        failed = spark.range(1).select(
            F.lit(run_id).alias("run_id"),
            F.lit("FAILED").alias("status"),
            F.lit(str(error)).alias("error_summary"),
            F.lit(text).alias("result"),
            started.alias("run_started_at"),
            now.alias("run_completed_at"),
        )
        library.note(failed)
        return text


def _policy_columns(sections: DataFrame, run_id: str) -> DataFrame:
    return sections.select(
        "_file",
        "_row",
        "file_name",
        "piece_index",
        "title",
        F.coalesce("issuing_authority", F.lit("Unknown")).alias("issuing_authority"),
        F.lit(fixed.DOCUMENT_TYPE).alias("document_type"),
        "section",
        "content",
        "effective_date",
        "reference_number",
        "category",
        F.lit(fixed.RELEVANCE_FORMAT.replace("{run}", run_id)).alias("relevance_to_lending"),
    )
