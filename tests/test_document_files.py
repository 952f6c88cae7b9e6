"""Document files by the thousand: folders, pieces written, and parses do not grow with the number of files."""

import os

from lendscope.checks.queries import document_files, file_number
from lendscope.sources.documents import Manifest, contents_of, list_documents, parse_by_ranges

COST = "spark.sql.files.openCostInBytes"


def docs(spark, numbers):
    return spark.createDataFrame([(n, None if n == 3 else f"text {n}\nä") for n in numbers], "doc_id long, text string")


def test_documents_share_folders(spark, tmp_path):
    folder = f"file://{tmp_path}"
    document_files(docs(spark, [*range(30), 5]), folder)
    document_files(docs(spark, range(30, 40)), folder)
    assert len(os.listdir(tmp_path / "policies")) == 2
    found = list_documents(spark, folder, "policies/", "*.txt").select(file_number().alias("doc_id"), "file_size")
    sizes = {row["doc_id"]: row["file_size"] for row in found.collect()}
    assert sorted(sizes) == list(range(40)) and sizes[3] == 1 and sizes[4] == len("text 4\nä\n".encode()) and sizes[5] == 2 * sizes[4]


def test_manifest_is_written_in_few_pieces(spark, tmp_path):
    folder = f"file://{tmp_path}"
    document_files(docs(spark, range(30)), folder)
    manifest = Manifest(spark, f"{folder}/manifest", folder, "policies/", "*.txt")
    spark.conf.set(COST, str(1 << 30))  # a task for every file
    try:
        assert manifest.refresh() == 30
        assert len(manifest.read().inputFiles()) <= 4
        contents_of(manifest.read(), folder, "policies/", "*.txt").write.parquet(f"{folder}/contents")
    finally:
        spark.conf.unset(COST)
    assert len(spark.read.parquet(f"{folder}/contents").inputFiles()) <= 4


def test_each_range_is_parsed_once(spark, tmp_path):
    def parser(content, start, end):
        (tmp_path / "calls").open("a").write(f"{start}\n")
        if start == 10 and content == b"bad":
            raise ValueError("torn page")
        return f"{start}-{end}"

    rows = spark.createDataFrame([("a", b"x", 25), ("b", b"bad", 30), ("c", b"", 0)], "name string, content binary, pages long")
    read = parse_by_ranges(rows, "name", "content", "pages", parser, 10).orderBy("name").collect()
    assert [tuple(row) for row in read] == [
        ("a", "\n\n0-10\n\n10-20\n\n20-25", "SUCCESS", None), ("b", None, "FAILED", "torn page"), ("c", "", "SUCCESS", None)
    ]
    assert len((tmp_path / "calls").read_text().split()) == 6
