"""Policy library reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.text import preview
from lendscope.plans.applications import chosen


def policy_list(policies: DataFrame) -> DataFrame:
    return policies.select(
        "policy_id",
        "title",
        "issuing_authority",
        "category",
        "section",
        preview(F.col("content")).alias("content_preview"),
        "effective_date",
    ).orderBy("policy_id")


def policy_kpis(policies: DataFrame) -> DataFrame:
    """Counts of policies, issuing authorities and categories; NULL is not a value."""
    return policies.agg(
        F.count(F.lit(1)).alias("policies"),
        F.count_distinct("issuing_authority").alias("authorities"),
        F.count_distinct("category").alias("categories"),
    )


def policies_filtered(policies: DataFrame, categories: list | None = None) -> DataFrame:
    return chosen(policy_list(policies), "category", categories)
