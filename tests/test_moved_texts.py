"""What ingestion keeps in scratch tables, and which tables deliveries of changed facts are merged from."""

import pytest

from lendscope.checks import queries
from lendscope.operators import numbering
from lendscope.plans import ingestion, score_state
from lendscope.sources.derived import derived_book
from lendscope.sources.documents import parse_text


def test_ingestion_writes_texts_only_to_its_tables(spark, tmp_path, monkeypatch):
    kept = []
    for module in (ingestion, numbering):
        write = module.materialize
        monkeypatch.setattr(module, "materialize", lambda spark, df, purpose, write=write: kept.append(df.columns) or write(spark, df, purpose))
    text = "Asset rules\n## Scope\nApplies to all banks\n## Norms\nNinety days\n"
    docs = spark.createDataFrame([("a", 9, "h", text), (None, 9, "i", text), ("a", 9, "h", text)], "file_name string, file_size long, file_hash string, text string")
    ingestion.ingest(spark, f"file://{tmp_path}/library", docs, lambda new: parse_text(new, "text", markup=False).drop("text"), run_id="r1")
    state = ingestion.Library(spark, f"file://{tmp_path}/library")
    # Equal names and missing ones keep their sections, each under its own number.
    assert sorted(row["policy_id"] for row in state.live_policies("policy_id").collect()) == [f"REG{n:03d}" for n in range(1, 7)]
    assert state.live_policies().where("content IS NULL").count() == 0
    # The list of new files is what the caller listed.
    assert len(kept) > 2 and not {"parsed_text", "content"} & {name for columns in kept[1:] for name in columns}


def test_corrections_are_merged_from_stored_facts(spark, monkeypatch):
    books = []

    def refresh(self, book, *given):
        books.append(book)
        if len(books) == 2:
            raise StopIteration

    monkeypatch.setattr(score_state.ScoreState, "build", lambda self, book: None)
    monkeypatch.setattr(score_state.ScoreState, "refresh", refresh)
    with pytest.raises(StopIteration):
        queries.scores_from_changes(derived_book(spark, "/root/testdata/sf0.001"))
    for book in books:
        for name in (*queries.FACT_KEYS, "customers", "industry_trends", "macro_economic_indicators"):
            assert not [path for path in book[name].inputFiles() if "testdata" in path]
