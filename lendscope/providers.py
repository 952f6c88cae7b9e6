"""Text providers: pluggable batch callables that read text and return JSON or text.

A provider receives one pandas Series of texts and returns a Series of the same
length. Spark splits the table into Arrow batches and calls the provider in every
task, so a hosted model, a local model or a rule set can be used alike. The plans
fall back to column rules when no provider is given.

A request that the provider fails on has no reply (NULL); it harms no other row. With stored
`Replies`, only requests that were never answered before are asked, each once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.maintenance import read_or_empty

Provider = Callable[[pd.Series], pd.Series]


def _asked(requests: DataFrame, text: str, provider: Provider, reply: str, error: str | None = None) -> DataFrame:
    """Adds the reply, and why there is none. A batch that fails is asked again row by row."""
    added = [reply] if error is None else [reply, error]
    schema = T.StructType([*requests.schema.fields, *(T.StructField(name, T.StringType()) for name in added)])

    def one(value: str) -> tuple[str | None, str | None]:
        try:
            return provider(pd.Series([value])).iloc[0], None
        except Exception as failure:  # noqa: BLE001  whatever a provider raises concerns this request alone
            return None, f"{type(failure).__name__}: {failure}"

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            try:
                answers = [(answer, None) for answer in provider(frame[text])]
                if len(answers) != len(frame):
                    raise ValueError("as many replies as texts are needed")
            except Exception:  # noqa: BLE001
                answers = [one(value) for value in frame[text]]
            made = pd.DataFrame(answers, columns=["reply", "error"], index=frame.index, dtype=object)
            made = made.where(made.notna(), None)
            yield frame.assign(**{name: made[column] for name, column in zip(added, ("reply", "error"))})

    return requests.mapInPandas(batches, schema)


class Replies:
    """The replies of one model, stored below ``base`` by the digest of the request.

    A batch of replies is a folder that is read once Spark has written it to the end, so a run that dies has only to ask again
    what its last batch asked. Failures are kept beside them and asked again by the next run.
    """

    SCHEMA = "digest string, reply string, error string"

    def __init__(self, spark: SparkSession, base: str, model: str):
        self.spark, self.model = spark, model
        self.path = f"{base.rstrip('/')}/replies-of-{uuid.uuid5(uuid.NAMESPACE_URL, model).hex}"

    def digest(self, request: Column) -> Column:
        """A digest of model and request."""
        return F.sha2(F.concat_ws("\n", F.lit(self.model), request).cast("binary"), 256)

    def stored(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, T.StructType.fromDDL(self.SCHEMA))

    def answers(self) -> DataFrame:
        """(digest, reply): one reply for each request that was answered."""
        return self.stored().where("error IS NULL").groupBy("digest").agg(F.min("reply").alias("reply"))

    def failures(self) -> DataFrame:
        """(digest, error) of requests that have no answer yet."""
        failed = self.stored().where("error IS NOT NULL").groupBy("digest").agg(F.max("error").alias("error"))
        return failed.join(self.answers(), "digest", "left_anti")

    def add(self, df: DataFrame, text: str, provider: Provider, reply: str) -> DataFrame:
        """``df`` with the reply to ``text``: distinct requests without an answer are asked and stored, all are then read."""
        marked = df.withColumn("_digest", self.digest(F.col(text)))
        requests = marked.where(F.col(text).isNotNull()).select("_digest", text).dropDuplicates(["_digest"])
        known = self.answers().select(F.col("digest").alias("_digest"))
        new = _asked(requests.join(known, "_digest", "left_anti"), text, provider, "reply", "error")
        new.select(F.col("_digest").alias("digest"), "reply", "error").write.mode("append").parquet(self.path)
        found = self.answers().select(F.col("digest").alias("_digest"), F.col("reply").alias(reply))
        return marked.join(found, "_digest", "left").drop("_digest")


def _add_reply(df: DataFrame, text: str, provider: Provider, reply: str, replies: Replies | None = None) -> DataFrame:
    return _asked(df, text, provider, reply) if replies is None else replies.add(df, text, provider, reply)


def complete(df: DataFrame, text: str, provider: Provider, reply: str, replies: Replies | None = None) -> DataFrame:
    """Adds the provider's text answer to every row."""
    return _add_reply(df, text, provider, reply, replies)


def extract_fields(
    df: DataFrame,
    text: str,
    fields: tuple[str, ...],
    provider: Provider,
    questions: dict[str, str] | None = None,
    replies: Replies | None = None,
) -> DataFrame:
    """Adds one string column per field, read from the JSON reply ``{"response": {field: value}}``.

    With ``questions``, what is asked of each field, the request is the JSON ``{"questions": {field: question}, "text": text}``
    instead of the text alone. A reply that is not JSON, or lacks a field, gives NULL for it.
    """
    request = F.col(text)
    if questions is not None:
        asked = F.struct(*(F.lit(questions[name]).alias(name) for name in fields))
        request = F.to_json(F.struct(asked.alias("questions"), F.col(text).alias("text")))
    replied = _add_reply(df.withColumn("_request", request), "_request", provider, "_reply", replies)
    replied = replied.withColumn("_json", F.try_parse_json("_reply"))
    values = {name: F.try_variant_get("_json", f"$.response.{name}", "string") for name in fields}
    return replied.withColumns(values).drop("_request", "_reply", "_json")


def classify(
    df: DataFrame, text: str, labels: tuple[str, ...], provider: Provider, result: str, replies: Replies | None = None
) -> DataFrame:
    """Adds the first label of the JSON reply ``{"labels": [...]}``; labels outside the list become NULL."""
    replied = _add_reply(df, text, provider, "_reply", replies)
    label = F.try_variant_get(F.try_parse_json("_reply"), "$.labels[0]", "string")
    return replied.withColumn(result, F.when(label.isin(*labels), label)).drop("_reply")
