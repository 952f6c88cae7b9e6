"""Document files end to end: listing, parsing, sections, ids, replacement, log."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendscope.plans import ingestion, library
from lendscope.sources.documents import document_fields, list_documents, parse_by_ranges, parse_text, parse_with, read_contents


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def circular(title, *sections):
    return f"{title}\nIssued by: Central Bank\nRef ABC/2024-25/07 dated 2024-04-01 on provision rules\n" + "".join(
        f"## {head}\n{body}\n" for head, body in sections
    )


@pytest.fixture
def folder(tmp_path):
    stage = tmp_path / "stage"
    write(stage, "policies/one.pdf", circular("Asset rules", ("Scope", "Applies to all banks"), ("Norms", "Ninety days")))
    write(stage, "policies/deep/two.pdf", circular("Capital rules", ("Ratio", "Nine percent of assets")))
    write(stage, "policies/bad.pdf", "BROKEN")
    write(stage, "policies/readme.txt", "no pdf")
    write(stage, "other/three.pdf", circular("Elsewhere", ("x", "y")))
    return stage


def run(spark, folder, base, run_id):
    listing = list_documents(spark, f"file://{folder}")
    contents = read_contents(spark, f"file://{folder}/policies", "*.pdf").select(
        F.concat(F.lit("policies/"), F.substring_index("path", "/policies/", -1)).alias("file_name"), "content"
    )

    # Defined here, not in the module, so that it travels to the workers by value.
    def parse_bytes(value):
        if value.startswith(b"BROKEN"):
            raise ValueError("cannot read page 1")
        return value.decode()

    def parse(new):
        return parse_with(new.join(contents, "file_name"), "content", parse_bytes)

    return ingestion.ingest(spark, base, listing, parse, run_id=run_id)


def test_listing(spark, folder):
    found = {row["file_name"]: row for row in list_documents(spark, f"file://{folder}").collect()}
    assert sorted(found) == ["policies/bad.pdf", "policies/deep/two.pdf", "policies/one.pdf"]
    assert found["policies/bad.pdf"]["file_size"] == 6
    import hashlib

    assert found["policies/bad.pdf"]["file_hash"] == hashlib.md5(b"BROKEN").hexdigest()


def test_runs(spark, folder, tmp_path):
    base = f"file://{tmp_path}/library"
    first = run(spark, folder, base, "r1")
    # Text before the first mark is a section of its own.
    assert first == "Run r1 complete. Detected: 3 | New: 3 | Processed: 2 | Failed: 1 | Policies loaded: 5"
    state = ingestion.Library(spark, base)
    live = state.live_policies().orderBy("policy_id").collect()
    assert [row["policy_id"] for row in live] == ["REG001", "REG002", "REG003", "REG004", "REG005"]
    assert [row["section"] for row in live] == ["Capital rules", "Ratio", "Asset rules", "Scope", "Norms"]
    assert live[0]["issuing_authority"] == "Central Bank"
    assert live[0]["reference_number"] == "ABC/2024-25/07"
    assert str(live[0]["effective_date"]) == "2024-04-01"
    assert live[0]["category"] == "PROVISIONING"
    errors = spark.read.parquet(state.errors).collect()
    assert [(row["file_name"], row["line"]) for row in errors] == [("policies/bad.pdf", "policies/bad.pdf: cannot read page 1")]
    row = state.read_log().first()
    assert row["error_summary"] == "policies/bad.pdf: cannot read page 1" and row["status"] == "PARTIAL"
    assert row["run_started_at"] <= row["run_completed_at"]
    stored = state.read_documents().collect()
    assert all(row["loaded_at"] is not None and row["page_count"] == 0 for row in stored)

    # Nothing changed: only the failed file comes again, and the policies stay.
    second = run(spark, folder, base, "r2")
    assert second == "Run r2 complete. Detected: 3 | New: 1 | Processed: 0 | Failed: 1 | Policies loaded: 0"
    assert state.live_policies().count() == 5

    # A changed file replaces the policies of its title under new ids; the others stay.
    write(folder, "policies/one.pdf", circular("Asset rules", ("Scope", "Applies to every lender")))
    write(folder, "policies/bad.pdf", circular("Late rules", ("Start", "From the first of May")))
    third = run(spark, folder, base, "r3")
    assert third == "Run r3 complete. Detected: 3 | New: 2 | Processed: 2 | Failed: 0 | Policies loaded: 1"
    live = state.live_policies().orderBy("policy_id").collect()
    assert [(row["policy_id"], row["section"]) for row in live] == [
        ("REG001", "Capital rules"), ("REG002", "Ratio"), ("REG003", "Late rules"), ("REG004", "Start"),
        ("REG005", "Asset rules"), ("REG006", "Scope"),
    ]
    # A file that turns unreadable keeps its policies.
    write(folder, "policies/one.pdf", "BROKEN")
    run(spark, folder, base, "r4")
    assert state.live_policies().count() == 6
    log = {row["run_id"]: row for row in state.read_log().collect()}
    assert [log[key]["status"] for key in ("r1", "r2", "r3", "r4")] == ["PARTIAL", "PARTIAL", "SUCCESS", "PARTIAL"]
    # A file that goes back to an earlier text is new again.
    write(folder, "policies/one.pdf", circular("Asset rules", ("Scope", "Applies to all banks"), ("Norms", "Ninety days")))
    assert "New: 1 | Processed: 1" in run(spark, folder, base, "r5")


def test_failed_run_is_logged(spark, folder, tmp_path):
    base = f"file://{tmp_path}/library"

    def parse(new):
        raise RuntimeError("parser is not there")

    text = ingestion.ingest(spark, base, list_documents(spark, f"file://{folder}"), parse, run_id="r1")
    assert text == "Run r1 FAILED: parser is not there"
    row = ingestion.Library(spark, base).read_log().first()
    assert row["status"] == "FAILED" and row["error_summary"] == "parser is not there"


@pytest.mark.parametrize("dies_at", range(6))
def test_a_run_that_dies_is_repeated_whole(spark, folder, tmp_path, monkeypatch, dies_at):
    base = f"file://{tmp_path}/library"
    run(spark, folder, base, "r1")
    write(folder, "policies/one.pdf", circular("Asset rules", ("Scope", "Applies to every lender")))
    calls, write_batch, publish = [], ingestion.Library.write, ingestion.Library.publish

    def dying(step):
        def attempt(self, *given):
            done = step(self, *given) if len(calls) != dies_at or step is write_batch else None
            calls.append(step)
            if len(calls) == dies_at + 1:
                raise RuntimeError("the driver is gone")
            return done

        return attempt

    monkeypatch.setattr(ingestion.Library, "write", dying(write_batch))
    monkeypatch.setattr(ingestion.Library, "publish", dying(publish))
    assert run(spark, folder, base, "r2") == "Run r2 FAILED: the driver is gone"
    monkeypatch.undo()
    state = ingestion.Library(spark, base)
    assert state.live_policies().count() == 5  # nothing of the dead run is read
    assert run(spark, folder, base, "r3").endswith("Processed: 1 | Failed: 1 | Policies loaded: -1")
    live = state.live_policies().orderBy("policy_id").collect()
    assert [(row["policy_id"], row["section"]) for row in live] == [
        ("REG001", "Capital rules"), ("REG002", "Ratio"), ("REG003", "Asset rules"), ("REG004", "Scope"),
    ]
    log = {row["run_id"]: row["status"] for row in state.read_log().collect()}
    assert log == {"r1": "PARTIAL", "r2": "FAILED", "r3": "PARTIAL"}


def test_two_runs_at_a_time_lose_nothing(spark, folder, tmp_path, monkeypatch):
    base, other, write_batch = f"file://{tmp_path}/library", [], ingestion.Library.write

    def overtaken(self, *given):
        if not other:  # another run begins after this one has claimed its batch, and ends before it
            other.append("fast")
            write(folder, "policies/late.pdf", circular("Late rules", ("Start", "From April"), ("End", "In May")))
            other.append(run(spark, folder, base, "fast"))
        return write_batch(self, *given)

    monkeypatch.setattr(ingestion.Library, "write", overtaken)
    text = run(spark, folder, base, "slow")
    assert "Processed: 3" in other[1] and "New: 1 | Processed: 0 | Failed: 1" in text  # what is left is the broken file
    state, alone = ingestion.Library(spark, base), ingestion.Library(spark, f"file://{tmp_path}/alone")
    assert state.batches() == [2, 3]  # the first one, given up, is read by nobody
    run(spark, folder, f"file://{tmp_path}/alone", "only")
    rows = lambda library: sorted((r["policy_id"], r["title"], r["section"], r["content"]) for r in library.live_policies().collect())
    assert rows(state) == rows(alone) and len(rows(state)) == 8


def test_a_started_run_is_in_the_log(spark, tmp_path):
    state = ingestion.Library(spark, f"file://{tmp_path}/library")
    state.note(spark.range(1).selectExpr("'r1' AS run_id", "current_timestamp() AS run_started_at"))
    row = state.read_log().first()
    assert row["status"] == "RUNNING" and row["files_new"] == 0 and row["run_completed_at"] is None


def test_error_text_in_file_order(spark):
    docs = spark.range(25).select(
        F.format_string("f%03d", F.lit(24) - F.col("id")).alias("file_name"),
        F.lit("FAILED").alias("processing_status"),
        F.when(F.col("id") != 3, F.lit("bad")).alias("error_message"),
    ).repartition(4)
    lines = [f"f{n:03d}: {'' if n == 21 else 'bad'}" for n in range(25)]
    assert ingestion.error_text(docs).first()["error_summary"] == " | ".join(lines)
    assert sorted(row["line"] for row in ingestion.error_rows(docs).collect()) == lines
    assert ingestion.error_text(docs.limit(0)).first()["error_summary"] is None


def test_fields_from_a_provider(spark):
    def provider(texts):
        return texts.map(
            lambda text: "no json" if "two" in text else json.dumps(
                {"response": {"title": text.upper(), "effective_date": "2024-13-01", "category": "RESOLUTION"}}
            )
        )

    docs = spark.createDataFrame([("one",), ("two",)], "parsed_text string")
    found = {row["parsed_text"]: row for row in ingestion.with_fields(docs, provider=provider).collect()}
    assert found["one"]["title"] == "ONE" and found["one"]["category"] == "RESOLUTION"
    assert found["one"]["effective_date"] is None
    assert found["two"]["title"] is None


def test_title_skips_blank_lines_and_marks(spark):
    df = spark.createDataFrame([("\n  \n## The Title \nrest",), ("",)], "t string").coalesce(1)
    assert [row[0] for row in df.select(document_fields("t")["title"]).collect()] == ["The Title", None]


def test_markup_is_read_as_text(spark):
    html = "<html><head><title>A &amp; B</title><style>p{}</style><script>var x='<p>';</script></head><body><!-- no -->" \
        "<p>Hello &lt;you&gt;</p><p>again</p></body></html>"
    pages = [(html,), ("<table><td>12.50</td><td>100 %</td></table>",), ("<p> </p>",), ("<p>a\ufffdb</p>",), (None,)]
    row = parse_text(spark.createDataFrame(pages, "html string").coalesce(1), "html").collect()
    assert row[0]["parsed_text"] == "A & B Hello <you> again" and row[0]["processing_status"] == "SUCCESS"
    # Tables of numbers are text; nothing, and bytes that were not decoded, are not.
    assert row[1]["processing_status"] == "SUCCESS" and "12.50" in row[1]["parsed_text"]
    assert [(r["processing_status"], r["parsed_text"]) for r in row[2:]] == [("FAILED", None)] * 3


def test_recent_by_time(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS processed_at UNION ALL "
                   "SELECT 2, TIMESTAMP_NTZ '2024-01-01 11:30:00'")
    now = F.expr("TIMESTAMP_NTZ '2024-01-01 12:00:00'")
    assert [row["id"] for row in ingestion.recent(df, now).collect()] == [2]


def test_policy_reports(spark):
    df = spark.createDataFrame(
        [("REG002", "t", "A", None, "s", "x" * 300, None), ("REG001", "t", None, "C", "s", "short", None)],
        "policy_id string, title string, issuing_authority string, category string, section string, content string, "
        "effective_date date",
    )
    listed = library.policy_list(df).collect()
    assert [row["policy_id"] for row in listed] == ["REG001", "REG002"]
    assert listed[1]["content_preview"] == "x" * 200 + "..."
    assert library.policy_kpis(df).first().asDict() == {"policies": 2, "authorities": 1, "categories": 1}
    assert library.policies_filtered(df).count() == 2
    assert library.policies_filtered(df, ["C"]).count() == 1
    assert library.policies_filtered(df, ["C", None]).count() == 2


def test_long_documents_are_read_in_ranges(spark):
    rows = [("a", b"abcdefg", 7), ("b", b"xy", 2), ("c", b"", 0), ("d", b"0123456789", 10)]
    df = spark.createDataFrame(rows, "file_name string, content binary, page_count long")

    def parser(value, start, end):
        if value.startswith(b"0") and start >= 3:
            raise ValueError(f"page {start}")
        return value[start:end].decode()

    found = {row["file_name"]: row for row in parse_by_ranges(df, "file_name", "content", "page_count", parser, 3).collect()}
    assert found["a"]["parsed_text"] == "\n\nabc\n\ndef\n\ng" and found["b"]["parsed_text"] == "xy"
    assert found["c"]["parsed_text"] == "" and found["c"]["processing_status"] == "SUCCESS"
    assert found["d"]["processing_status"] == "FAILED" and found["d"]["error_message"] == "page 3"
    assert found["d"]["parsed_text"] is None


def test_parser_batches_keep_rows_apart(spark):
    df = spark.createDataFrame([(n, str(n).encode()) for n in range(50)], "id long, content binary")

    def parser(value):
        if int(value) % 7 == 0:
            raise ValueError(f"no {int(value)}")
        return value.decode() * 2

    found = parse_with(df, "content", parser).toPandas().sort_values("id").reset_index(drop=True)
    assert isinstance(found, pd.DataFrame) and len(found) == 50
    for _, row in found.iterrows():
        if row["id"] % 7 == 0:
            assert row["processing_status"] == "FAILED" and row["error_message"] == f"no {row['id']}"
        else:
            assert row["parsed_text"] == str(row["id"]) * 2
