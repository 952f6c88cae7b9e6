"""Registered queries: each runs one library function over the whole driver tables of a folder."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from urllib.parse import urlparse

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope import fixed
from lendscope.functions.numbers import grouped, money
from lendscope.functions.text import clean_reply, markup_text, markup_title
from lendscope.operators import search
from lendscope.operators.maintenance import Versions, input_state, new_files, replace_by_key
from lendscope.operators.quality import InSet, MaxLength, NotNull, Reference, Unique, check_rules
from lendscope.operators.sections import join_ranges, plan_ranges
from lendscope.operators.word_index import WordIndex, where_any
from lendscope.plans import (
    advisor,
    applications,
    assessments,
    borrowers,
    ingestion,
    library,
    market,
    portfolio,
    score_state,
    scoring,
    semantic,
    signals,
)
from lendscope.providers import Replies
from lendscope.session import materialize, run_folder
from lendscope.sources.derived import DERIVED, derived_book
from lendscope.sources.documents import FieldRules, Manifest, contents_of, list_documents, parse_by_ranges, parse_text
from lendscope.sources.schemas import RULES
from lendscope.sources.tables import Book, insert, stored_book
from lendscope.streaming import macro_feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals leave the reports as doubles, and small integers as longs."""

    def shown(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return value.cast("long").alias(field.name)
        return value

    return df.select(*[shown(field) for field in df.schema.fields])


def on_book(name: str) -> Callable[[Callable[[Book], DataFrame]], Callable[[Book], DataFrame]]:
    """Register a function of the derived book under a query name."""

    def register(build: Callable[[Book], DataFrame]) -> Callable[[Book], DataFrame]:
        QUERIES[name] = lambda spark, folder: plain(build(derived_book(spark, folder)))
        return build

    return register


_SCORES: dict[tuple, str] = {}
_SCORED = ("customer", "supplier", "part", "nation", "region", "orders", "lineitem", "events")


def scored_book(spark: SparkSession, folder: str) -> Book:
    """The derived book with its stored score table, which a session computes once per state of the files, as a refresh job would."""
    book = derived_book(spark, folder)
    key = (spark.sparkContext.applicationId, *(input_state(book[name]) for name in _SCORED))
    if key not in _SCORES:
        base = run_folder(spark, "scores")
        scoring.publish_scores(book, base)
        _SCORES[key] = f"{base}/risk_scores"
    return book.replaced(risk_scores=Versions(spark, _SCORES[key]).read())


def on_scores(name: str) -> Callable[[Callable[[Book], DataFrame]], Callable[[Book], DataFrame]]:
    """Register a report over the stored score table under a query name."""

    def register(build: Callable[[Book], DataFrame]) -> Callable[[Book], DataFrame]:
        QUERIES[name] = lambda spark, folder: plain(build(scored_book(spark, folder)))
        return build

    return register


def _columns(build: Callable[[Book], DataFrame], *columns: str) -> Callable[[Book], DataFrame]:
    return lambda book: build(book).select(*columns)


@on_book("filter_active")
def filter_active(book: Book) -> DataFrame:
    return book["loan_history"].filter(F.col("loan_status") == "ACTIVE").select(
        "loan_id", "customer_id", "outstanding_balance"
    )


@on_book("like_filter")
def like_filter(book: Book) -> DataFrame:
    return book["documents"].filter(F.col("source").like("src1%")).select("doc_id", "source")


@on_book("score_bands")
def score_bands(book: Book) -> DataFrame:
    return scoring.statement_scores(book["company_financials"]).select(
        "customer_id", "fiscal_year", "fiscal_quarter", "de_score", "cr_score", "icr_score", "npm_score"
    )


RATIOS = ("debt_to_equity_ratio", "current_ratio", "interest_coverage_ratio", "net_profit_margin")
on_book("latest_financials")(
    _columns(scoring.latest_financials, "customer_id", "fiscal_year", "fiscal_quarter", *RATIOS)
)
on_book("latest_rating")(_columns(scoring.latest_rating, "customer_id", "rating", "rating_outlook", "rating_date"))
on_book("latest_industry")(market.industry_list)
on_book("latest_macro")(market.macro_list)
on_book("financial_scores")(
    _columns(
        scoring.financial_scores, "customer_id", "de_score", "cr_score", "icr_score", "npm_score",
        "financial_health_score",
    )
)
on_book("repayment_summary")(
    _columns(scoring.repayment_summary, "customer_id", "payments", "on_time", "on_time_pct", "max_overdue")
)


@on_book("repayment_scores")
def repayment_scores(book: Book) -> DataFrame:
    return scoring.repayment_scores(book).select(
        "customer_id", F.col("max_overdue").alias("max_days_overdue"), "ontime_score", "overdue_score",
        "repayment_score",
    )


on_book("cashflow_scores")(
    _columns(
        scoring.cashflow_scores, "customer_id", "net_flow_score", "balance_stability_score", "stress_score",
        "credit_debit_ratio", "min_balance",
    )
)
on_book("collateral_scores")(_columns(scoring.collateral_scores, "customer_id", "collateral_score"))
on_book("rating_scores")(_columns(scoring.rating_scores, "customer_id", "rating_num_score", "outlook_score"))
on_book("industry_scores")(
    _columns(
        scoring.industry_scores, "sector", "industry", "default_rate_score", "industry_outlook_score", "reg_risk_score"
    )
)
MACRO = (
    "cpi_score", "repo_score", "credit_growth_score", "system_npa_score", "fx_score", "latest_cpi",
    "latest_repo_rate", "latest_npa_ratio",
)
on_book("macro_scores")(_columns(scoring.macro_scores, *MACRO))
on_book("macro_pivot")(scoring.macro_pivot)
on_book("industry_join")(_columns(scoring.with_industry, "customer_id", "outlook", "default_rate_pct"))


@on_book("macro_cross")
def macro_cross(book: Book) -> DataFrame:
    rows = scoring.with_macro(book, book["customers"])
    return rows.select("customer_id", *[F.col(f"macro.{name}") for name in MACRO])


on_book("risk_scores")(scoring.risk_scores)
on_book("risk_drivers")(_columns(scoring.risk_scores, "customer_id", "key_risk_drivers"))
on_book("borrower_profiles")(signals.borrower_profiles)
on_book("risk_signals")(signals.risk_signals)
on_book("borrower_classification")(signals.borrower_classification)

on_book("exposure_kpis")(portfolio.exposure_kpis)
on_scores("portfolio_kpis")(portfolio.portfolio_kpis)
on_scores("grade_counts")(portfolio.grade_counts)
on_scores("grade_distribution")(portfolio.grade_distribution)
on_book("sma_breakdown")(portfolio.sma_breakdown)
on_scores("sector_summary")(portfolio.sector_summary)
on_scores("scorecard")(portfolio.scorecard)
on_scores("high_risk_borrowers")(portfolio.high_risk_borrowers)
on_scores("worst_15")(portfolio.worst_rows)
on_scores("score_components")(portfolio.score_components)
on_book("exposure_list")(portfolio.exposure_list)
on_book("borrower_list")(borrowers.borrower_list)
on_book("borrower_financials")(borrowers.borrower_financials)
on_book("borrower_loans")(borrowers.borrower_loans)
on_book("borrower_repayments")(borrowers.borrower_repayments)
on_book("loan_applications")(applications.loan_applications)
on_book("application_kpis")(applications.application_kpis)
on_book("decision_alignment")(applications.decision_alignment)
on_book("pending_applications")(applications.pending_applications)
on_book("macro_headline")(market.macro_headline)


@on_book("apps_filtered")
def apps_filtered(book: Book) -> DataFrame:
    return applications.applications_filtered(book, ["PENDING", "ESCALATED", "REJECTED"])


@on_scores("semantic_query")
def semantic_query(book: Book) -> DataFrame:
    result = semantic.query(
        book,
        measures=[
            "customers.total_borrowers", "risk_scores.avg_risk_score", "loan_history.total_outstanding",
            "loan_history.active_loan_count", "loan_applications.total_applications",
        ],
        dimensions=["customers.sector", "risk_scores.risk_grade"],
    )
    return result.withColumn("avg_risk_score", F.round("avg_risk_score", 4))


def _all_rules(book: Book, rules: list[tuple[str, list]]) -> DataFrame:
    checked = [check_rules(name, book[name], listed, book.__getitem__) for name, listed in rules]
    result = checked[0]
    for part in checked[1:]:
        result = result.unionByName(part)
    return result


@on_book("dq_pk")
def dq_pk(book: Book) -> DataFrame:
    return _all_rules(
        book.replaced(documents=documents(book)),
        [
            ("lineitem", [Unique("l_orderkey,l_linenumber")]),
            ("loan_repayment", [Unique("repayment_id")]),
            ("customers", [Unique("customer_id")]),
            ("documents", [Unique("file_hash")]),
        ],
    )


@on_book("dq_fk")
def dq_fk(book: Book) -> DataFrame:
    return _all_rules(
        book,
        [
            ("loan_repayment", [Reference("loan_id", "loan_history", "loan_id")]),
            ("loan_history", [Reference("customer_id", "customers", "customer_id")]),
            ("bank_transactions", [Reference("customer_id", "customers", "customer_id")]),
            ("documents", [Reference("doc_id", "labels", "doc_id")]),
        ],
    )


@on_book("dq_domain")
def dq_domain(book: Book) -> DataFrame:
    return _all_rules(
        book,
        [
            (
                "loan_applications",
                [
                    InSet("application_status", fixed.APPLICATION_STATUS_DOMAIN),
                    InSet("officer_decision", ("APPROVED", "REJECTED")),
                    NotNull("ai_recommendation"),
                ],
            ),
            ("industry_trends", [InSet("outlook", fixed.OUTLOOK_DOMAIN)]),
            ("documents", [InSet("lang", ("en", "fr", "de")), MaxLength("text", 2000)]),
        ],
    )


@on_book("dq_declared")
def dq_declared(book: Book) -> DataFrame:
    """Every declared rule of every derived table, as far as its columns are derived."""
    listed = []
    for name in DERIVED:
        known = set(book[name].columns)
        rules = [rule for rule in RULES.get(name, ()) if (rule.columns if isinstance(rule, Unique) else rule.column) in known]
        listed += [(name, rules)] if rules else []
    return _all_rules(book, listed)


# --- scalar functions ---


@on_book("scalar_functions")
def scalar_functions(book: Book) -> DataFrame:
    """Each deterministic scalar function once, over all orders with their customer."""
    key, priority, price = F.col("o_orderkey"), F.col("o_orderpriority"), money(F.col("o_totalprice"))
    day, name = F.to_date("o_orderdate"), F.col("c_name")
    odd_key = F.when(key % 2 == 1, key)
    json = F.concat(F.lit('{"a":{"b":'), key.cast("string"), F.lit('},"l":["x","y"]}'))
    return (
        book["orders"]
        .join(book["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key,
            F.when(price > 200000, "big").when(price > 100000, "mid").otherwise("small").alias("case_when"),
            F.coalesce(odd_key, F.lit(-1)).alias("coalesced"),
            F.nullif("o_orderstatus", F.lit("O")).alias("nulled"),
            F.round(price, 0).alias("rounded"),
            (price * 2 + 1 - key).alias("arithmetic"),
            ((price >= 1000) & ((key > 5) | (key == 0))).cast("int").alias("compared"),
            priority.isin("1-URGENT", "2-HIGH").cast("int").alias("in_list"),
            priority.like("%LOW").cast("int").alias("like_match"),
            F.concat(priority, F.lit("/"), "o_orderstatus").alias("joined"),
            F.concat(F.nullif("o_orderstatus", F.lit("O")), F.lit("x")).alias("joined_null"),
            price.cast("string").alias("number_text"),
            grouped(price).alias("grouped_text"),
            F.date_format(day, "yyyyMMdd").alias("date_text"),
            F.left(name, F.lit(5)).alias("left_text"),
            F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
            F.length(name).alias("name_length"),
            F.lpad(key.cast("string"), 8, "0").alias("padded"),
            F.replace(name, F.lit("Customer#"), F.lit("C-")).alias("replaced"),
            F.element_at(F.split(name, "#"), 2).alias("split_part"),
            F.regexp_substr(name, F.lit("[0-9]+")).alias("regexp_part"),
            F.regexp_extract(priority, r"^([0-9])-(.+)$", 2).alias("regexp_group"),
            F.upper(name).alias("upper_text"),
            F.lower(priority).alias("lower_text"),
            F.upper(priority).contains("SPEC").cast("int").alias("contained"),
            F.least(key, F.lit(500)).alias("least_value"),
            F.date_add(day, 30).alias("date_added"),
            F.try_to_date(F.concat(F.lit("2024-01-"), (key % 40).cast("string")), "yyyy-MM-d").alias("date_tried"),
            F.replace(F.substring(priority, 1, 2), F.lit("-"), F.lit("")).try_cast("long").alias("number_tried"),
            F.array_join(
                F.array_compact(F.array(F.nullif("o_orderstatus", F.lit("O")), F.lit("z"))), "; "
            ).alias("array_text"),
            F.variant_get(F.parse_json(json), "$.a.b", "long").alias("json_path"),
            F.variant_get(F.parse_json(json), "$.l[0]", "string").alias("json_item"),
            F.element_at(F.from_json(json, "a struct<b:long>, l array<string>")["l"], 2).alias("json_parsed"),
            (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % 9000 + 1000).alias("hash_suffix"),
        )
    )


# --- documents and policies ---


def documents(book: Book) -> DataFrame:
    """The documents as files: name in the order of doc_id, hash, page count (one character is a page)."""
    return book["documents"].select(
        "doc_id",
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file_name"),
        F.md5("text").alias("file_hash"),
        F.col("n_chars").alias("page_count"),
        "text",
    )


def known_documents(book: Book) -> DataFrame:
    """Earlier reads: labelled documents. Good quality was a success, and a toxic document has changed since."""
    read = documents(book).join(book["labels"], "doc_id")
    return read.select(
        "doc_id",
        "file_name",
        F.when(F.col("toxic") == 0, F.col("file_hash")).otherwise("changed").alias("file_hash"),
        F.when(F.col("quality") == 1, "SUCCESS").otherwise("FAILED").alias("processing_status"),
        "text",
    )


# Rules that find something in the invented prose of the documents.
PROSE_RULES = FieldRules(
    issuing_authority=r"(?i)under (?:the )?([a-z0-9 \-]+license)",
    reference_number=r"\b([0-9]{16})\b",
    effective_date=r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b",
)


def decoded(docs: DataFrame) -> DataFrame:
    """Documents as a decoder hands them over: the marks of the junk documents stand for bytes it could not read."""
    return docs.withColumn("text", F.replace("text", F.lit("***"), F.lit("\ufffd")))


def parsed_documents(book: Book) -> DataFrame:
    return parse_text(decoded(documents(book)), "text", markup=False)


def described_sections(docs: DataFrame) -> DataFrame:
    """Sections of whole document texts with the document's fields."""
    return ingestion.policy_sections(ingestion.with_fields(docs.withColumnRenamed("text", "parsed_text"), PROSE_RULES))


def policies(book: Book) -> DataFrame:
    """The policies of all documents, numbered from 1."""
    usable = described_sections(documents(book)).filter(~ingestion.unusable())
    return ingestion.assign_policy_ids(book.spark, usable, None, ["file_name", "piece_index"])


POLICY_KEY = ("policy_id", "doc_id", "piece_index")


@on_book("doc_listing")
def doc_listing(book: Book) -> DataFrame:
    """Every document written as a file of its own, then listed with size and hash."""
    folder = run_folder(book.spark, "documents")
    document_files(book["documents"], folder)
    found = list_documents(book.spark, folder, "policies/", "*.txt")
    return found.select(file_number().alias("doc_id"), "file_size", "file_hash")


#: Files of one folder below the document files: a folder a file makes a listing task a file.
FOLDER_FILES = 1000


def document_files(docs: DataFrame, folder: str) -> None:
    """Every document as a file of its own below ``folder/policies``; every call has its own folders there.

    On local disks the tasks write the files themselves, because Hadoop's local file system starts a process for the mode of
    every file and of its checksum, and only rows that share a file are moved to one task. Other stores are written by Spark. A
    task that is repeated writes the same files again.
    """
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    shared = F.col("doc_id").isNull() | (F.col("n") > 1)
    total, n_shared = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(shared)).first()
    run, folders = uuid.uuid4().hex, max(1, -(-total // FOLDER_FILES))
    place = F.concat(F.lit(f"{run}-"), F.pmod(F.xxhash64("doc_id"), F.lit(folders)).cast("string"))
    docs = docs.select(place.alias("part"), "doc_id", "text")
    target = urlparse(folder)
    if target.scheme not in ("", "file"):
        rows = dealt_documents(docs)
        rows.write.mode("append").partitionBy("part", "doc_id").option("lineSep", "\n").text(f"{folder}/policies")
        return
    base = f"{target.path}/policies"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one document lie together and share its file, a line each.
        lines = (row for batch in batches for row in batch.to_pylist())
        for (part, number), mine in groupby(lines, lambda row: (row["part"], row["doc_id"])):
            os.makedirs(f"{base}/part={part}", exist_ok=True)
            named = "__HIVE_DEFAULT_PARTITION__" if number is None else number
            with open(f"{base}/part={part}/doc_id={named}.txt", "wb") as file:
                for row in mine:
                    file.write((row["text"] or "").encode() + b"\n")
        yield pa.RecordBatch.from_pydict({"done": [True]})

    parts = [docs] if not n_shared else document_parts(docs, materialize(docs.sparkSession, counted.where(shared), "shared-files"))
    for rows in parts:
        rows.mapInArrow(put, "done boolean").write.format("noop").mode("overwrite").save()


def dealt_documents(docs: DataFrame) -> DataFrame:
    """The rows of a document in one task."""
    return docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")


def document_parts(docs: DataFrame, shared: DataFrame) -> list[DataFrame]:
    """The documents of one row, where they are, and those of several, which share a file, dealt so that their rows lie together."""
    ids = shared.select(F.col("doc_id").alias("_id"))
    once = docs.where("doc_id IS NOT NULL").join(ids, F.col("doc_id") == F.col("_id"), "left_anti")
    several = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return [once, dealt_documents(several).sortWithinPartitions("doc_id", "text")]


def file_number() -> Column:
    return F.regexp_extract("file_name", r"^policies/part=[^/]*/doc_id=([0-9]+)[/.]", 1).cast("long")


@on_book("doc_manifest")
def doc_manifest(book: Book) -> DataFrame:
    """The listing as a manifest keeps it: a tenth of the files came after its first refresh, and only those are opened then."""
    spark, docs, folder = book.spark, book["documents"], run_folder(book.spark, "documents")
    manifest = Manifest(spark, run_folder(spark, "manifest"), folder, "policies/", "*.txt")
    late = F.col("doc_id") % 10 == 7
    document_files(docs.where(~late), folder)
    manifest.refresh()
    document_files(docs.where(late), folder)
    manifest.refresh()
    return manifest.read().select(file_number().alias("doc_id"), "file_size", "file_hash")


@on_book("doc_incremental")
def doc_incremental(book: Book) -> DataFrame:
    return new_files(documents(book), known_documents(book)).select("doc_id", "file_hash")


@on_book("doc_replace")
def doc_replace(book: Book) -> DataFrame:
    old = known_documents(book).select("doc_id", "file_hash", F.lit("kept").alias("action"))
    new = new_files(documents(book), known_documents(book)).select("doc_id", "file_hash", F.lit("read").alias("action"))
    return replace_by_key(old, new, "doc_id")


@on_book("doc_recent")
def doc_recent(book: Book) -> DataFrame:
    """Labelled documents were read in an earlier run, the others in this one."""
    read = documents(book).join(book["labels"].withColumn("run_id", F.lit("run-1")), "doc_id", "left")
    runs = read.withColumn("run_id", F.coalesce("run_id", F.lit("run-2")))
    return ingestion.in_run(runs, "run-2").select("doc_id")


@on_book("doc_chunks")
def doc_chunks(book: Book) -> DataFrame:
    return plan_ranges(documents(book), "page_count").select("doc_id", "range_start", "range_end")


@on_book("doc_reassemble")
def doc_reassemble(book: Book) -> DataFrame:
    """Each range of every document on its own, put together again."""
    start = F.col("range_start").cast("int")
    part = F.substr("text", start + 1, F.col("range_end").cast("int") - start)
    parts = plan_ranges(documents(book), "page_count").select("doc_id", "range_start", part.alias("part"))
    whole = join_ranges(parts, "doc_id", "range_start", "part", "text")
    return whole.select("doc_id", F.length("text").alias("text_length"), F.md5("text").alias("text_hash"))


@on_book("doc_status")
def doc_status(book: Book) -> DataFrame:
    return parsed_documents(book).select("doc_id", "processing_status", "error_message")


@on_book("doc_fields")
def doc_fields(book: Book) -> DataFrame:
    docs = documents(book).withColumnRenamed("text", "parsed_text")
    return ingestion.with_fields(docs, PROSE_RULES).select("doc_id", *fixed.DOCUMENT_FIELDS)


def rule_provider(requests: pd.Series) -> pd.Series:
    """A provider that answers the questions by the rules of the invented prose; it fails on what is no request."""

    def group(pattern: str, text: str) -> str | None:
        found = re.search(pattern, text, re.ASCII)
        return (found.group(1).strip(" ") or None) if found else None

    def answer(request: str) -> str:
        asked = json.loads(request)
        text, rules = asked["text"], PROSE_RULES
        lowered = text.lower()
        known = {
            "title": group(r"^\s*(?:#+ )?([^\n]+)", text),
            "issuing_authority": group(rules.issuing_authority, text),
            "reference_number": group(rules.reference_number, text),
            "effective_date": group(rules.effective_date, text),
            "category": next((label for label, words in rules.categories if any(word in lowered for word in words)), None),
        }
        return json.dumps({"response": {name: known[name] for name in asked["questions"]}})

    return requests.map(answer)


@on_book("doc_fields_asked")
def doc_fields_asked(book: Book) -> DataFrame:
    """The document fields as a provider answers them in two runs over one reply table; the second asks what is new."""
    docs = documents(book).withColumnRenamed("text", "parsed_text")
    replies = Replies(book.spark, run_folder(book.spark, "replies"), "rules")
    known = docs.join(book["labels"], "doc_id", "left_semi")
    ingestion.with_fields(known, provider=rule_provider, questions=fixed.DOCUMENT_QUESTIONS, replies=replies)
    found = ingestion.with_fields(docs, provider=rule_provider, questions=fixed.DOCUMENT_QUESTIONS, replies=replies)
    return found.select("doc_id", *fixed.DOCUMENT_FIELDS)


@on_book("page_text")
def page_text(book: Book) -> DataFrame:
    text = markup_text(F.col("html"))
    return book["pages"].select(
        "page_id",
        markup_title(F.col("html")).alias("title"),
        F.length(text).alias("text_length"),
        F.md5(text).alias("text_hash"),
    )


@on_book("doc_errors")
def doc_errors(book: Book) -> DataFrame:
    """The line of every document that could not be read."""
    return ingestion.error_rows(parsed_documents(book))


@on_book("doc_run_log")
def doc_run_log(book: Book) -> DataFrame:
    """The run that reads what is new: counts, status, result text."""
    detected = book["documents"].agg(F.count(F.lit(1))).scalar()
    fresh = parse_text(decoded(new_files(documents(book), known_documents(book))), "text", markup=False)
    sections = described_sections(fresh.filter(F.col("processing_status") == "SUCCESS").drop("parsed_text"))
    loaded = sections.filter(~ingestion.unusable()).agg(F.count(F.lit(1))).scalar()
    return ingestion.run_summary(detected, fresh, "run-2", loaded)


def ingested(book: Book) -> ingestion.Library:
    """Two runs of the ingestion job: over the labelled documents, and then over all of them."""
    spark, base = book.spark, run_folder(book.spark, "library")
    files = documents(book).withColumn("file_size", F.octet_length("text").cast("long"))
    contents = files.select("file_name", "page_count", "text")
    listing = files.select("doc_id", "file_name", "file_size", "file_hash")

    def parse(new: DataFrame) -> DataFrame:
        return parse_text(decoded(new.join(contents, "file_name")), "text", markup=False)

    labelled = listing.join(book["labels"], "doc_id", "left_semi")
    for run_id, listed in (("run-1", labelled), ("run-2", listing)):
        ingestion.ingest(spark, base, listed.drop("doc_id"), parse, PROSE_RULES, run_id=run_id)
    return ingestion.Library(spark, base)


@on_book("ingest_log")
def ingest_log(book: Book) -> DataFrame:
    """The log rows of two ingestion runs, with the failures of each."""
    rows = ingested(book).read_log()
    return rows.select(
        "run_id", "files_detected", "files_new", "files_processed", "files_failed", "policies_loaded", "status",
        F.md5("error_summary").alias("error_hash"), "result",
        (F.col("run_started_at") <= F.col("run_completed_at")).alias("is_timed"),
    )


@on_book("ingest_policies")
def ingest_policies(book: Book) -> DataFrame:
    """What counts after two ingestion runs: sections by title and content, and whether their ids are distinct."""
    return live_sections(ingested(book))


def live_sections(stored: ingestion.Library) -> DataFrame:
    digests = (F.md5("title").alias("title_hash"), "section", F.md5("content").alias("content_hash"))
    ids = stored.live_policies("policy_id").agg(F.count_distinct("policy_id") == F.count(F.lit(1))).scalar()
    live = stored.live_policies(*digests).groupBy("title_hash", "section", "content_hash")
    return live.agg(F.count(F.lit(1)).alias("times")).withColumn("has_distinct_ids", ids)


#: Characters of a page of the document files.
PAGE = 1000


@on_book("ingest_files")
def ingest_files(book: Book) -> DataFrame:
    """Ingestion from files: manifest, bytes of the new ones, page ranges side by side, sections, policies, in two runs."""
    spark, base, folder = book.spark, run_folder(book.spark, "library"), run_folder(book.spark, "documents")
    manifest = Manifest(spark, run_folder(spark, "manifest"), folder, "policies/", "*.txt")

    def pages(content: bytes, start: int, end: int) -> str:
        # The writer ended the file with a line break, which is no part of the text.
        return content.decode()[:-1].replace("***", "\ufffd\ufffd\ufffd")[PAGE * start : PAGE * end]

    def parse(new: DataFrame) -> DataFrame:
        counted = F.ceil((F.length(F.decode("content", "UTF-8")) - 1) / PAGE)
        files = contents_of(new, folder, "policies/", "*.txt").withColumn("page_count", counted.cast("long"))
        texts = parse_by_ranges(files, "file_name", "content", "page_count", pages)
        read = texts.where("processing_status = 'SUCCESS'").select("file_name", F.col("parsed_text").alias("text"))
        return parse_text(new.join(read, "file_name"), "text", markup=False).drop("text", "modified")

    labelled = book["documents"].join(book["labels"], "doc_id", "left_semi")
    for run_id, docs in (("run-1", labelled), ("run-2", book["documents"].join(book["labels"], "doc_id", "left_anti"))):
        document_files(docs, folder)
        manifest.refresh()
        ingestion.ingest(spark, base, manifest.read(), parse, PROSE_RULES, run_id=run_id)
    return live_sections(ingestion.Library(spark, base))


@on_book("policy_sections")
def policy_sections(book: Book) -> DataFrame:
    docs = documents(book).withColumnRenamed("text", "parsed_text")
    return ingestion.policy_sections(docs).select("doc_id", "piece_index", "section", "content")


@on_book("policy_quarantine")
def policy_quarantine(book: Book) -> DataFrame:
    """Sections without content or title, which do not become policies."""
    return described_sections(documents(book)).filter(ingestion.unusable()).select("doc_id", "piece_index", "section")


@on_book("policy_ids")
def policy_ids(book: Book) -> DataFrame:
    return policies(book).select(*POLICY_KEY)


@on_book("policy_replace")
def policy_replace(book: Book) -> DataFrame:
    """The policies of the earlier successful reads, after the new and changed documents were read."""
    order = ["file_name", "piece_index"]
    earlier = known_documents(book).filter(F.col("processing_status") == "SUCCESS")
    old = described_sections(earlier.drop("processing_status")).filter(~ingestion.unusable())
    existing = ingestion.assign_policy_ids(book.spark, old, None, order)
    new = described_sections(new_files(documents(book), known_documents(book))).filter(~ingestion.unusable())
    return ingestion.replace_policies(book.spark, existing, new, order).select(*POLICY_KEY, F.md5("title").alias("title_hash"))


@on_book("policy_library")
def policy_library(book: Book) -> DataFrame:
    return library.policy_list(policies(book))


@on_book("policy_kpis")
def policy_kpis(book: Book) -> DataFrame:
    return library.policy_kpis(policies(book))


@on_book("policies_filtered")
def policies_filtered(book: Book) -> DataFrame:
    return library.policies_filtered(policies(book), ["PROVISIONING", None]).select("policy_id", "category")


# --- macro feed ---


def feed_folder(book: Book, folder: str | None = None, by_line: bool = False) -> str:
    """The derived indicators as feed files, which hold arrays, objects over many lines and broken lines in any order.

    ``by_line`` writes every value on one line.

    A day has one record per indicator. Every day's broken line carries its date, and
    every day has one record whose value is no number.
    """
    folder = folder or run_folder(book.spark, "feed")
    keys = [
        F.col(column).alias(key) if column != "region" else F.nullif("region", F.lit(fixed.REGION_DEFAULT)).alias(key)
        for key, column, _ in macro_feed.FEED_FIELDS
    ]
    indicators = book["macro_economic_indicators"]
    cpi = F.col("indicator_name") == fixed.CPI_NAME
    record = F.to_json(F.struct(*keys))
    days = indicators.filter(~cpi).groupBy("report_date").agg(F.sort_array(F.collect_list(record)).alias("records"))
    arrays = days.select(F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")).alias("value"))
    whole = record if by_line else F.to_json(F.struct(*keys), {"pretty": "true"})
    objects = indicators.filter(cpi).select(whole.alias("value"))
    date = F.col("report_date").cast("string")
    broken = days.select(
        F.explode(
            F.array(
                F.concat(F.lit('{"indicator_id": "broken-'), date, F.lit('"')),
                F.concat(F.lit('{"indicator_id": "typed-'), date, F.lit('", "value": "high"}')),
            )
        ).alias("value")
    )
    arrays.unionByName(objects).unionByName(broken).coalesce(4).write.text(folder)
    return folder


@on_book("feed_load")
def feed_load(book: Book) -> DataFrame:
    """Records of the landing table: the id where the record is JSON, and its text length."""
    raw = macro_feed.read_feed(book.spark, feed_folder(book))
    return raw.select(
        F.try_variant_get("raw_data", "$.indicator_id", "string").alias("indicator_id"),
        F.col("raw_data").isNull().cast("int").alias("is_broken"),
    )


@on_book("feed_raw")
def feed_raw(book: Book) -> DataFrame:
    """The stored landing table of the streaming job: raw records by path, also the rejected ones."""
    tables = macro_feed.run_feed(book.spark, feed_folder(book), run_folder(book.spark, "feed-tables"))
    return tables.raw().select(
        F.try_variant_get("raw_data", "$.indicator_id", "string").alias("indicator_id"),
        F.try_variant_get("raw_data", "$.value", "double").alias("value"),
    )


@on_book("feed_parse")
def feed_parse(book: Book) -> DataFrame:
    """The current indicators after the streaming job has read first estimates and then the feed files that revise them."""
    spark, base, folder = book.spark, run_folder(book.spark, "feed-tables"), run_folder(book.spark, "feed")
    record = F.struct(*[F.col(column).alias(key) for key, column, _ in macro_feed.FEED_FIELDS])
    estimates = book["macro_economic_indicators"].withColumn("value", F.col("value") + 1000)
    estimates.select(F.to_json(record).alias("value")).write.text(f"{folder}/part=1")
    macro_feed.run_feed(spark, folder, base)
    feed_folder(book, f"{folder}/part=2")
    return macro_feed.run_feed(spark, folder, base).current()


@on_book("feed_quarantine")
def feed_quarantine(book: Book) -> DataFrame:
    tables = macro_feed.run_feed(book.spark, feed_folder(book), run_folder(book.spark, "feed-tables"))
    return book.spark.read.parquet(tables.quarantine_path).select("text", "reason")


@on_book("stream_refresh")
def stream_refresh(book: Book) -> DataFrame:
    """The score table that the streaming job published after it read the feed, from stored components."""
    stored = scoring.stored_components(book)
    tables = macro_feed.run_feed(
        book.spark,
        feed_folder(book),
        run_folder(book.spark, "feed-tables"),
        refresh=lambda indicators: scoring.refreshed_scores(book, stored, indicators),
    )
    return tables.scores.read()


FACT_KEYS = {
    "company_financials": "financial_id",
    "loan_repayment": "repayment_id",
    "bank_transactions": "transaction_id",
    "loan_history": "loan_id",
    "credit_ratings": "rating_id",
}


@on_book("scores_from_changes")
def scores_from_changes(book: Book) -> DataFrame:
    """The score table after two deliveries of changed facts: rows that were missing, and rows that were wrong."""
    spark, base = book.spark, run_folder(book.spark, "score-state")
    # As stored tables, which the deliveries are taken from.
    tables = {name: materialize(spark, book[name], "facts") for name in FACT_KEYS}
    late = {name: F.pmod(F.xxhash64(key), F.lit(10)) == 0 for name, key in FACT_KEYS.items()}
    wrong = {name: F.pmod(F.xxhash64(key), F.lit(50)) == 1 for name, key in FACT_KEYS.items()}
    off = {
        "company_financials": {"net_profit_margin": F.lit(0)},
        "loan_repayment": {"days_overdue": F.col("days_overdue") + 400},
        "bank_transactions": {"running_balance": F.col("running_balance") - 1000},
        "loan_history": {"collateral_value": F.col("collateral_value") * 2},
        "credit_ratings": {"rating": F.lit("D")},
    }

    def mistaken(name: str) -> DataFrame:
        types = dict(tables[name].dtypes)
        rows = tables[name].where(wrong[name])
        return rows.withColumns({column: value.cast(types[column]) for column, value in off[name].items()})

    sound = {name: df.where(~wrong[name]) for name, df in tables.items()}
    mistakes = {name: mistaken(name) for name in tables}
    first = {name: sound[name].where(~late[name]).unionByName(mistakes[name]) for name in tables}
    second = {name: sound[name].unionByName(mistakes[name]) for name in tables}
    # The other tables are derived from the facts; they stay as they are, and are stored tables like them.
    others = {name: materialize(spark, book[name], "others") for name in ("customers", "industry_trends", "macro_economic_indicators")}
    state = score_state.ScoreState(spark, base)
    state.build(book.replaced(**others, **first))
    state.refresh(book.replaced(**others, **second), "missing rows", {name: sound[name].where(late[name]) for name in tables})
    corrected = {name: df.where(wrong[name]) for name, df in tables.items()}
    state.refresh(book.replaced(**others, **tables), "corrections", corrected, mistakes)
    return state.scores.read().drop("scored_at")


@on_book("latest_macro_stream")
def latest_macro_stream(book: Book) -> DataFrame:
    """Newest report per indicator, kept as streaming state over the feed files, two of them a batch, and merged into a table."""
    spark = book.spark
    live = macro_feed.follow_latest(spark, feed_folder(book, by_line=True), run_folder(spark, "latest"), 2)
    return live.read().select(
        "indicator_name", "indicator_category", "value", "previous_value", "change_pct", "unit", "report_date", "source"
    )


# --- search, routing, assessments ---


def benchmark_questions(book: Book) -> DataFrame:
    return book["benchmark"].select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


_INDEXES: dict[tuple, tuple[WordIndex, str]] = {}


def corpus_index(name: str, corpus: DataFrame, key: str, text: str, attributes: tuple[str, ...] = ()) -> WordIndex:
    """The stored index of a corpus, which a session keeps; it is refreshed when the files below have changed, as the service does."""
    spark = corpus.sparkSession
    place = (spark.sparkContext.applicationId, name, *sorted({path.rsplit("/", 2)[0] for path in corpus.inputFiles()}))
    state = input_state(corpus)
    if place not in _INDEXES or _INDEXES[place][1] != state:
        index = _INDEXES[place][0] if place in _INDEXES else WordIndex(spark, run_folder(spark, "word-index"), key, attributes)
        index.refresh(corpus, text)
        _INDEXES[place] = index, state
    return _INDEXES[place][0]


def document_index(book: Book) -> WordIndex:
    return corpus_index("documents", book["documents"], "doc_id", "text", ("lang", "source"))


@on_book("search_bm25")
def search_bm25(book: Book) -> DataFrame:
    return document_index(book).best(benchmark_questions(book), fixed.HITS_POLICY_PAGE)


@on_book("search_policies")
def search_policies(book: Book) -> DataFrame:
    """The best documents of two languages for every question, with their source."""
    where = where_any({"lang": ["de", "fr"]})
    return document_index(book).best(benchmark_questions(book), fixed.HITS_POLICY_PAGE, where, ("lang", "source"))


@on_book("search_scan")
def search_scan(book: Book) -> DataFrame:
    """The same ranking without an index, as for a corpus that is searched once."""
    return search.bm25(book["documents"], benchmark_questions(book), fixed.HITS_POLICY_PAGE)


@on_book("search_refreshed")
def search_refreshed(book: Book) -> DataFrame:
    """The ranking by an index of an older corpus - some documents missing, some longer, some since removed - after its refresh."""
    docs, number = book["documents"].select("doc_id", "text"), F.col("doc_id")
    older = docs.where(number % 10 != 0).withColumn("text", F.when(number % 10 == 1, F.concat("text", F.lit(" older words"))).otherwise(F.col("text")))
    removed = docs.where(number % 10 == 2).select((-number - 1).alias("doc_id"), "text")
    index = WordIndex(book.spark, run_folder(book.spark, "word-index"), "doc_id")
    index.refresh(older.unionByName(removed), "text")
    index.refresh(docs, "text")
    return index.best(benchmark_questions(book), fixed.HITS_POLICY_PAGE)


def label_centres(book: Book) -> DataFrame:
    """One query per label: the sum of its vectors, which points the same way as their mean."""
    items = book["embeddings"].select("label", F.posexplode("embedding").alias("place", "x"))
    sums = items.groupBy("label", "place").agg(F.sum(F.col("x").cast("decimal(20,12)")).cast("double").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "x")))
    return sums.groupBy("label").agg(F.transform(ordered, lambda item: item["x"]).alias("query_vector")).select(
        F.col("label").cast("long").alias("query_id"), "label", "query_vector"
    )


@on_book("search_topk")
def search_topk(book: Book) -> DataFrame:
    return search.nearest(book["embeddings"], label_centres(book), fixed.HITS_POLICY_PAGE, "vec_id", "embedding")


@on_book("search_filtered")
def search_filtered(book: Book) -> DataFrame:
    return search.nearest_within(
        book["embeddings"], label_centres(book), fixed.HITS_ADVISOR, "vec_id", "embedding", "label"
    )


def questions(book: Book) -> DataFrame:
    return book["conversations"].filter(F.col("role") == "user").select("conv_id", "turn", "text")


@on_book("route_first")
def route_first(book: Book) -> DataFrame:
    return questions(book).select("conv_id", "turn", advisor.route_first(F.col("text")).alias("dataset"))


@on_book("route_all")
def route_all(book: Book) -> DataFrame:
    datasets = F.array_join(advisor.route_all(F.col("text")), ",")
    return questions(book).select("conv_id", "turn", datasets.alias("datasets"))


@on_book("reply_cleanup")
def reply_cleanup(book: Book) -> DataFrame:
    """Replies whose line breaks arrive as the two characters backslash and n."""
    escaped = F.replace("text", F.lit("\n"), F.lit("\\n"))
    return (
        book["conversations"]
        .filter(F.col("role") == "assistant")
        .select("conv_id", "turn", clean_reply(escaped).alias("text"))
    )


@on_scores("question_context")
def question_context(book: Book) -> DataFrame:
    corpus = book["documents"].select("doc_id", F.col("source").alias("title"), F.col("lang").alias("section"), "text")
    result = advisor.question_context(
        book, benchmark_questions(book), corpus, "doc_id", "title", "text", index=document_index(book)
    )
    return result.select(
        "query_id", F.array_join("datasets", ",").alias("datasets"), "data_context", "context"
    )


@on_scores("question_context_first")
def question_context_first(book: Book) -> DataFrame:
    corpus = book["documents"].select("doc_id", F.col("source").alias("title"), "text")
    result = advisor.question_context_first(
        book, benchmark_questions(book), corpus, "doc_id", "title", "text", index=document_index(book)
    )
    return result.select("query_id", "dataset", "data_context", "context")


@on_scores("question_data")
def question_data(book: Book) -> DataFrame:
    """The data half of the context for every user turn, some of which name a dataset."""
    asked = questions(book).withColumnRenamed("text", "query")
    result = advisor.data_context(book, asked, "query")
    return result.select("conv_id", "turn", F.array_join("datasets", ",").alias("datasets"), "data_context")


def benchmark_policies(book: Book) -> DataFrame:
    """The documents as policies; each ends with a line naming its source and a norm, which the appraisal query can find."""
    norms = F.array(*[F.lit(norm) for norm in ("provisioning norms", "capital adequacy", "credit appraisal", "other matters")])
    line = F.concat(F.lit("\n"), F.element_at(norms, (F.col("doc_id") % 4 + 1).cast("int")))
    return book["documents"].select(
        F.col("doc_id").alias("policy_id"), F.col("source").alias("title"), F.concat("text", line).alias("content")
    )


def document_assessments(
    book: Book, run_date: str, run_id: str = "run-1", hour: int = 9, components: DataFrame | None = None
) -> DataFrame:
    """Assessments with the real appraisal query, as one run at a given hour generated them."""
    made = F.expr(f"TIMESTAMP_NTZ '{run_date} {hour:02d}:00:00'")
    policies = benchmark_policies(book)
    index = corpus_index("policies", policies, "policy_id", "content")
    return assessments.assessments(book, policies, run_date, run_id=run_id, generated_at=made, index=index, components=components)


ASSESSMENT = (
    "assessment_id", "customer_id", "prompt", "ai_narrative", "confidence_score", "ai_recommendation", "regulatory_citations"
)


@on_book("assessments")
def all_assessments(book: Book) -> DataFrame:
    return document_assessments(book, "2024-03-31").select(*ASSESSMENT)


@on_book("latest_assessment")
def latest_assessment(book: Book) -> DataFrame:
    """Two runs of one day inserted into the audit table, then the newest row per customer.

    Both runs compose their scores from the components that the day's book was brought to once.
    """
    base, components = run_folder(book.spark, "assessments"), scoring.stored_components(book)
    for run_id, hour in (("run-1", 9), ("run-2", 17)):
        insert(document_assessments(book, "2024-06-30", run_id, hour, components), "credit_assessments", base)
    stored = assessments.latest_assessment(stored_book(book.spark, base)["credit_assessments"])
    return stored.select(
        "assessment_id", F.col("customer_id").cast("long"), "assessment_date", "risk_score", "risk_grade", "sma_category", "ai_recommendation",
        "confidence_score", "ai_narrative", F.col("generated_at").cast("string").alias("generated_at"),
    )
