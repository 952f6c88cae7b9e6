"""How the searches deal their work out: words move once by range, and tasks hold a bounded number of pairs."""

from pyspark.sql import functions as F

from lendscope.operators import search
from lendscope.operators.word_index import WordIndex

COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def corpus(spark, rows):
    return spark.createDataFrame([(n, f"alpha beta w{n % 7} w{n % 11}") for n in range(rows)], "doc_id long, text string")


def test_a_range_is_written_by_one_task(spark, tmp_path):
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id")
    spark.conf.set(COALESCE, "false")
    try:
        index.refresh(corpus(spark, 600), "text")
    finally:
        spark.conf.unset(COALESCE)
    path = f"{index.base}/{index.segments()[0]['path']}/postings"
    pieces = spark.read.parquet(path).withColumn("file", F.input_file_name())
    found = pieces.groupBy("range").agg(F.count_distinct("file").alias("files"), F.sum("n").alias("n")).collect()
    assert {row["files"] for row in found} == {1}
    # Every document has four words, fewer where two of them are equal.
    assert sum(row["n"] for row in found) == sum(4 - (n % 7 == n % 11) for n in range(600))


def test_a_task_sums_a_bounded_number_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(search, "PAIRS_PER_TASK", 10)
    asked = spark.createDataFrame([(1, "alpha w3"), (2, "beta w4")], "query_id long, query string")
    best = search.bm25(corpus(spark, 35), asked, 3)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and "7), REPARTITION_BY_NUM" in plan
    assert [row["doc_id"] for row in best.where("query_id = 1").orderBy("rank").collect()] == [3, 10, 14]
