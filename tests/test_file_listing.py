"""Document files are listed and opened by tasks: their number does not grow the driver's work."""

import os

from pyspark.sql import functions as F

from lendscope.checks import queries
from lendscope.sources import documents
from lendscope.sources.documents import Manifest, contents_of, list_documents, parse_by_ranges

NAMES = ["a.pdf", "b.txt", "deep/er/c.pdf", "_hidden/d.pdf", ".e.pdf", "_f.pdf", "k=1/_g=2.pdf", "deep/policies/h.pdf", "deep/i.PDF", "with space/j%20.pdf"]


def put(folder):
    for place, name in enumerate(NAMES):
        (folder / "policies" / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / "policies" / name).write_text("x" * place)
        os.utime(folder / "policies" / name, ns=(1, 1_700_000_000_123_456_789 + place * 10**9))


def test_listing_is_that_of_the_reader(spark, tmp_path):
    put(tmp_path)
    for folder in (f"file://{tmp_path}", str(tmp_path), f"file://{tmp_path}/"):
        for name in ("*.pdf", "*", "[a-c].{pdf,txt}"):
            columns = ["path", "length", "modified", "file_name"]
            want = documents._scanned(spark, folder, "policies/", name).select(*columns).collect()
            got = documents._files(spark, folder, "policies/", name).select(*columns).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 1


def test_driver_does_not_hold_the_files(spark, tmp_path):
    for place in range(40):
        (tmp_path / f"policies/part={place % 4}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"policies/part={place % 4}/{place}.txt").write_text(f"text {place}")
    folder = f"file://{tmp_path}"
    manifest = Manifest(spark, f"{folder}/manifest", folder, "policies/", "*.txt")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a reader's task for every file
    try:
        listing = list_documents(spark, folder, "policies/", "*.txt")
        assert listing.inputFiles() == [] and listing.rdd.getNumPartitions() <= 4 and listing.count() == 40
        assert manifest.refresh() == 40
        read = contents_of(manifest.read(), folder, "policies/", "*.txt")
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "binaryFile" not in plan and read.count() == 40
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_each_file_is_opened_once_for_parsing(spark, tmp_path):
    (tmp_path / "policies").mkdir()
    for place in range(3):
        (tmp_path / f"policies/{place}.pdf").write_text("ab" * (place + 1))
    folder = f"file://{tmp_path}"
    manifest = Manifest(spark, f"{folder}/manifest", folder)
    manifest.refresh()
    os.remove(tmp_path / "policies/0.pdf")  # listed, and gone since
    files = contents_of(manifest.read(), folder).withColumn("pages", F.length("content").cast("long"))
    plan = files.select("file_name")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan  # names alone open no file
    texts = parse_by_ranges(files, "file_name", "content", "pages", lambda content, start, end: content[start:end].decode(), 2)
    assert {row["file_name"]: row["parsed_text"] for row in texts.collect()} == {"policies/1.pdf": "\n\nab\n\nab", "policies/2.pdf": "\n\nab\n\nab\n\nab"}


def test_documents_are_written_where_they_lie(spark, tmp_path, monkeypatch):
    moved = []
    deal = queries.dealt_documents
    monkeypatch.setattr(queries, "dealt_documents", lambda docs: moved.append(sorted(row["text"] for row in docs.collect())) or deal(docs))
    rows = [(n, f"text {n}") for n in range(20)]
    queries.document_files(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}/a")
    assert moved == [] and len(list((tmp_path / "a").rglob("*.txt"))) == 20
    queries.document_files(spark.createDataFrame([*rows, (3, "again"), (None, "x"), (None, "y"), (21, None)], "doc_id long, text string"), f"file://{tmp_path}/b")
    assert moved == [["again", "text 3", "x", "y"]]
    files = {path.name: path.read_text() for path in (tmp_path / "b").rglob("*.txt")}
    assert len(files) == 22 and files["doc_id=3.txt"] == "again\ntext 3\n" and files["doc_id=4.txt"] == "text 4\n" and files["doc_id=21.txt"] == "\n"
    assert files["doc_id=__HIVE_DEFAULT_PARTITION__.txt"] == "x\ny\n"
