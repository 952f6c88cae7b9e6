"""The macro feed as a stream: new files once, bad records aside, late reports, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from lendscope.operators.latest import latest, newest
from lendscope.operators.maintenance import Versions
from lendscope.streaming import macro_feed


def record(number, name="CPI_GENERAL", value=4.5, date="2024-01-01", **more):
    return {"indicator_id": f"i{number}", "indicator_name": name, "category": "INFLATION", "value": value,
            "report_date": date, **more}


@pytest.fixture
def feed(tmp_path):
    (tmp_path / "feed").mkdir()
    return tmp_path / "feed"


def run(spark, feed, tmp_path, **options):
    return macro_feed.run_feed(spark, f"file://{feed}", f"file://{tmp_path}/tables", **options)


def test_files_are_read_once(spark, feed, tmp_path):
    (feed / "a.json").write_text(json.dumps([record(1), record(2, region="EU")]))
    (feed / "b.json").write_text(json.dumps(record(3)) + "\n\n" + json.dumps(record(4)) + "\n")
    tables = run(spark, feed, tmp_path)
    found = {row["indicator_id"]: row for row in tables.indicators().collect()}
    assert sorted(found) == ["i1", "i2", "i3", "i4"]
    assert found["i1"]["region"] == "India" and found["i2"]["region"] == "EU"
    (feed / "c.json").write_text(json.dumps(record(5)))
    tables = run(spark, feed, tmp_path)
    assert sorted(row["indicator_id"] for row in tables.indicators().collect()) == ["i1", "i2", "i3", "i4", "i5"]


def test_nothing_new_runs_nothing(spark, feed, tmp_path):
    calls = []

    def refresh(indicators):
        calls.append(1)
        return indicators.groupBy().count()

    (feed / "a.json").write_text(json.dumps(record(1)))
    run(spark, feed, tmp_path, refresh=refresh)
    run(spark, feed, tmp_path, refresh=refresh)
    assert calls == [1]


def test_bad_records_go_aside_and_the_rest_counts(spark, feed, tmp_path):
    (feed / "a.json").write_text("\n".join([json.dumps(record(1)), "{broken", json.dumps(record(2, value="high")),
                                            json.dumps(record(3, date="someday")), "[]", "[1]"]))
    tables = run(spark, feed, tmp_path)
    assert [row["indicator_id"] for row in tables.indicators().collect()] == ["i1"]
    assert tables.raw().filter("source_file = 'a.json'").count() == 4
    reasons = sorted(row["reason"] for row in spark.read.parquet(tables.quarantine_path).collect())
    assert reasons == ["missing or mistyped column"] * 3 + ["not JSON"]


def test_line_files_and_whole_documents_in_one_folder(spark, feed, tmp_path):
    (feed / "a.json").write_text(json.dumps([record(1), record(2)], indent=2))
    (feed / "b.json").write_text(json.dumps(record(3), indent=2))
    (feed / "c.json").write_text(json.dumps(record(4)) + "\n" + json.dumps(record(5)) + " trailing\n" + json.dumps(record(6)))
    (feed / "d.json").write_text("[\n" + json.dumps(record(7)) + ",\n" + json.dumps(record(8)) + "\n]\n")
    tables = run(spark, feed, tmp_path)
    assert sorted(row["indicator_id"] for row in tables.indicators().collect()) == ["i1", "i2", "i3", "i4", "i6", "i7", "i8"]
    aside = spark.read.parquet(tables.quarantine_path).collect()
    assert [(row["source_file"], row["reason"]) for row in aside] == [("c.json", "not JSON")]


def test_a_revision_counts_and_nothing_is_dropped(spark, feed, tmp_path):
    (feed / "a.json").write_text(json.dumps([record(1, value=1.0), record(1, value=2.0)]))
    tables = run(spark, feed, tmp_path)
    assert [row["value"] for row in tables.current().collect()] == [2.0]
    (feed / "b.json").write_text(json.dumps(record(1, value=0.5)))
    tables = run(spark, feed, tmp_path)
    assert sorted(row["value"] for row in tables.indicators().collect()) == [0.5, 1.0, 2.0]
    assert [row["value"] for row in tables.current().collect()] == [0.5]


def test_late_report_does_not_displace(spark, feed, tmp_path):
    (feed / "a.json").write_text(json.dumps(record(1, value=5.0, date="2024-03-01")))
    run(spark, feed, tmp_path)
    (feed / "b.json").write_text(json.dumps(record(2, value=3.0, date="2024-01-01")))
    tables = run(spark, feed, tmp_path)
    best = latest(tables.indicators(), ["indicator_name"], [newest("report_date"), newest("indicator_id")])
    assert [row["value"] for row in best.collect()] == [5.0]


def test_late_report_in_streaming_state(spark, feed, tmp_path):
    target = f"file://{tmp_path}/latest"

    def step():
        stream = macro_feed.good_indicators(macro_feed.stream_feed(spark, f"file://{feed}"))
        query = (
            macro_feed.latest_per_indicator(stream)
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{target}/{number}"))
            .option("checkpointLocation", f"file://{tmp_path}/check")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    (feed / "a.json").write_text(json.dumps(record(1, value=5.0, date="2024-03-01")))
    step()
    (feed / "b.json").write_text(json.dumps(record(2, value=3.0, date="2024-01-01")))
    step()
    assert [row["value"] for row in spark.read.parquet(f"{target}/1").collect()] == [5.0]
    (feed / "c.json").write_text(json.dumps(record(3, value=7.0, date="2024-04-01")))
    step()
    assert [row["value"] for row in spark.read.parquet(f"{target}/2").collect()] == [7.0]


def test_only_news_is_merged_into_the_live_table(spark, feed, tmp_path):
    def step(name, *records):
        (feed / name).write_text("\n".join(map(json.dumps, records)))
        live = macro_feed.follow_latest(spark, f"file://{feed}", f"file://{tmp_path}/live")
        return live.published(), {row["indicator_name"]: row["value"] for row in live.read().collect()}

    assert step("a.json", record(1, value=5.0, date="2024-03-01"), record(2, "REPO_RATE", 6.5)) == (0, {"CPI_GENERAL": 5.0, "REPO_RATE": 6.5})
    # A late report, and one that came before, change nothing: no version is written.
    assert step("b.json", record(3, value=3.0, date="2024-01-01"), record(2, "REPO_RATE", 6.5))[0] == 0
    assert step("c.json", record(4, value=7.0, date="2024-04-01")) == (2, {"CPI_GENERAL": 7.0, "REPO_RATE": 6.5})
    live = Versions(spark, f"file://{tmp_path}/live/latest")
    assert not macro_feed.merge_news(live, live.read().limit(1), 2)  # a batch that is delivered again


def test_refresh_publishes_scores_after_the_last_batch(spark, feed, tmp_path):
    refresh = lambda indicators: indicators.groupBy("indicator_name").count()
    for number in range(3):
        (feed / f"{number}.json").write_text(json.dumps(record(number)))
    tables = run(spark, feed, tmp_path, refresh=refresh, files_per_batch=1)
    assert tables.scores.published() == 2
    assert tables.scores.read().first()["count"] == 3


def test_a_repeated_batch_changes_nothing(spark, feed, tmp_path):
    (feed / "a.json").write_text(json.dumps([record(1), record(2)]))
    tables = run(spark, feed, tmp_path)
    lines = spark.read.text(f"file://{feed}").selectExpr(
        "value", "_metadata.file_name AS source_file", "_metadata.file_path AS source_path"
    )
    tables.add(lines, 0)
    assert tables.indicators().count() == 2


def test_a_repeated_version_that_dies_leaves_the_published_one(spark, tmp_path):
    versions = Versions(spark, f"file://{tmp_path}/scores")
    versions.write(spark.range(3), version=0)
    opened = versions.read()
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("dies"))).alias("id"))
    with pytest.raises(Exception, match="dies"):
        versions.write(broken, version=0)
    assert versions.published() == 0 and versions.read().count() == 3 and opened.count() == 3
    versions.write(spark.range(4), version=0)
    assert versions.read().count() == 4 and opened.count() == 3


def test_empty_feed(spark, feed, tmp_path):
    assert run(spark, feed, tmp_path).indicators().count() == 0
