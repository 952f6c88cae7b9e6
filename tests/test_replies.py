"""Providers: one failing row, named questions, replies that are asked for once."""

import json

import pytest
from pyspark.sql import functions as F

from lendscope.plans import ingestion
from lendscope.providers import Replies, classify, complete, extract_fields


@pytest.fixture
def calls(tmp_path):
    """A provider that notes every text it is asked, wherever its task runs, and a reader of the notes."""
    (tmp_path / "asked").mkdir()
    folder = str(tmp_path / "asked")

    def provider(texts):
        import os
        import uuid

        for text in texts:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as note:
                note.write(text)
        if any("bad" in text for text in texts):
            raise RuntimeError("no answer")
        return texts.str.upper()

    return provider, lambda: sorted(note.read_text() for note in (tmp_path / "asked").iterdir())


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)


def test_one_failing_row_stands_alone(spark, calls):
    provider, _ = calls
    found = complete(frame(spark, ["a", "bad", "b"]), "text", provider, "reply").orderBy("id").collect()
    assert [row["reply"] for row in found] == ["A", None, "B"]
    short = complete(frame(spark, ["a", "b"]), "text", lambda texts: texts.str.upper()[:1], "reply").orderBy("id").collect()
    assert [row["reply"] for row in short] == ["A", "B"]


def test_only_what_is_new_is_asked(spark, calls, tmp_path):
    provider, asked = calls
    replies = Replies(spark, f"file://{tmp_path}/r", "m1")
    first = replies.add(frame(spark, ["a", "b", "a", None]), "text", provider, "reply").orderBy("id").collect()
    assert [row["reply"] for row in first] == ["A", "B", "A", None] and asked() == ["a", "b"]
    again = replies.add(frame(spark, ["b", "c", "a"]), "text", provider, "reply").orderBy("id").collect()
    assert [row["reply"] for row in again] == ["B", "C", "A"] and asked() == ["a", "b", "c"]
    # Another model has replies of its own.
    other = Replies(spark, f"file://{tmp_path}/r", "m2")
    other.add(frame(spark, ["a"]), "text", provider, "reply")
    assert asked() == ["a", "a", "b", "c"]


def test_failures_are_kept_and_asked_again(spark, calls, tmp_path):
    provider, _ = calls
    replies = Replies(spark, f"file://{tmp_path}/r", "m1")
    found = replies.add(frame(spark, ["a", "bad"]), "text", provider, "reply").orderBy("id").collect()
    assert [row["reply"] for row in found] == ["A", None]
    assert [row["error"] for row in replies.failures().collect()] == ["RuntimeError: no answer"]
    found = replies.add(frame(spark, ["a", "bad"]), "text", lambda texts: texts + "!", "reply").orderBy("id").collect()
    assert [row["reply"] for row in found] == ["A", "bad!"] and replies.failures().count() == 0


def test_the_provider_is_told_the_questions(spark, tmp_path):
    def provider(requests):
        import json as js

        return requests.map(lambda request: js.dumps({"response": js.loads(request)["questions"] | {"text": js.loads(request)["text"]}}))

    docs = spark.createDataFrame([('a "text"\n',)], "parsed_text string")
    questions = {name: f"what {name}?" for name in ("title", "issuing_authority", "reference_number", "effective_date", "category")}
    row = ingestion.with_fields(docs, provider=provider, questions=questions, replies=Replies(spark, f"file://{tmp_path}/r", "m")).first()
    assert row["title"] == "what title?" and row["category"] == "what category?" and row["effective_date"] is None
    row = extract_fields(docs, "parsed_text", ("text",), provider, {"text": "?"}).first()
    assert row["text"] == 'a "text"\n' and row["parsed_text"] == 'a "text"\n'


def test_labels_from_stored_replies(spark, tmp_path):
    replies = Replies(spark, f"file://{tmp_path}/r", "m")
    provider = lambda texts: texts.map(lambda text: json.dumps({"labels": [text]}))
    found = classify(frame(spark, ["X", "Y", "X"]), "text", ("X",), provider, "label", replies).orderBy(F.col("id")).collect()
    assert [row["label"] for row in found] == ["X", None, "X"]
