"""Scores kept current from changed facts: per-customer state that deltas are merged into."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.operators.commits import CommitLog, Conflict
from lendscope.operators.latest import latest, newest
from lendscope.operators.maintenance import Versions
from lendscope.plans import scoring
from lendscope.session import materialize
from lendscope.sources.tables import Book

#: Patches that are merged into one when a refresh finds as many.
MERGE_AT = 24


@dataclass(frozen=True)
class Summary:
    """How the state of one fact table follows from its rows and from changes of them.

    ``state`` makes one row per customer. Numbers in ``counts`` add up, the first of them says whether there is anything at all. ``sums``
    add up too, and are NULL where their own count is 0. ``least`` and ``most`` are extremes. ``order`` names the columns
    by which a newest row is chosen; such a state is that row, and its last column identifies it.
    """

    state: Callable[[DataFrame], DataFrame]
    counts: tuple[str, ...] = ()
    sums: tuple[tuple[str, str], ...] = ()
    least: tuple[str, ...] = ()
    most: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


SUMMARIES = {
    "company_financials": Summary(scoring.financial_state, order=scoring.FINANCIAL_ORDER),
    "loan_repayment": Summary(scoring.repayment_state, ("payments", "on_time"), most=("max_overdue",)),
    "bank_transactions": Summary(
        scoring.cashflow_state,
        ("transactions", "credits", "debits", "balances", "negative_rows"),
        (("credit", "credits"), ("debit", "debits"), ("balance", "balances")),
        least=("min_balance",),
    ),
    "loan_history": Summary(
        scoring.collateral_state,
        ("loans", "outstandings", "collaterals"),
        (("total_outstanding", "outstandings"), ("total_collateral", "collaterals")),
    ),
    "credit_ratings": Summary(scoring.rating_state, order=scoring.RATING_ORDER),
}


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(F.col("customer_id"), *(F.col(name).alias(f"{prefix}{name}") for name in df.columns if name != "customer_id"))


def merged(summary: Summary, old: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The new state of the customers in ``old`` or ``added`` (rows of the fact table), with ``again``: it must be read from the facts.

    What adds up is added and taken off. An extreme or a newest row that a removed row may have held is not
    known any more; only such customers are marked.
    """
    types = dict(old.dtypes)
    if summary.order:
        identity = summary.order[-1]
        lost = removed.select("customer_id", F.col(identity).alias("_lost"))
        both = old.withColumn("_old", F.lit(True)).unionByName(summary.state(added).select(*old.columns).withColumn("_old", F.lit(False)))
        held = both.where("_old").join(lost, "customer_id").where(F.col(identity).eqNullSafe(F.col("_lost"))).select("customer_id").distinct()
        best = latest(both, ["customer_id"], [newest(column) for column in summary.order])
        return best.drop("_old").join(held.withColumn("again", F.lit(True)), "customer_id", "left").withColumn(
            "again", F.coalesce("again", F.lit(False))
        )
    plus, minus = _prefixed(summary.state(added), "_plus_"), _prefixed(summary.state(removed), "_minus_")
    rows = old.join(plus, "customer_id", "full").join(minus, "customer_id", "full")

    def total(name: str) -> Column:
        parts = [F.coalesce(column, F.lit(0).cast(types[name])) for column in (name, f"_plus_{name}", f"_minus_{name}")]
        return (parts[0] + parts[1] - parts[2]).cast(types[name])

    fields = {name: total(name) for name in summary.counts}
    fields |= {name: F.when(total(counted) > 0, total(name)) for name, counted in summary.sums}
    fields |= {name: F.least(name, f"_plus_{name}") for name in summary.least}
    fields |= {name: F.greatest(name, f"_plus_{name}") for name in summary.most}
    again = F.lit(False)
    for name in summary.least:
        again = again | (F.col(f"_minus_{name}") <= F.col(name))
    for name in summary.most:
        again = again | (F.col(f"_minus_{name}") >= F.col(name))
    return rows.select(
        "customer_id", *(fields[name].alias(name) for name in old.columns if name != "customer_id"), F.coalesce(again, F.lit(False)).alias("again")
    )


class ScoreState:
    """The stored states and scores below ``base``.

    States are rows per customer in patches that never change; of a customer's rows the one of the last patch counts. A patch is one
    refresh: it is written, then committed under the next number, and then the scores of its customers are published as a new
    version. A run that dies in between is made up for by the next, because both sides know their number,
    and a repeated delivery of a number that is committed already merges nothing twice.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.log = CommitLog(spark, f"{self.base}/state/log", "path string, base boolean, delivery string")
        self.scores = Versions(spark, f"{self.base}/risk_scores")

    def _patches(self) -> list[dict]:
        rows = self.log.entries()
        start = max((place for place, row in enumerate(rows) if row["base"]), default=0)
        return rows[start:]

    def states(self, table: str, customers: DataFrame | None = None) -> DataFrame:
        """The state of one fact table, of all customers or of the given ones."""
        parts = []
        for row in self._patches():
            part = self.spark.read.parquet(f"{self.base}/state/{row['path']}/{table}")
            part = part if customers is None else part.join(customers, "customer_id", "left_semi")
            parts.append(part.withColumn("_number", F.lit(row["number"])))
        newest_patch = Window.partitionBy("customer_id").orderBy(F.desc("_number"))
        rows = reduce(DataFrame.unionByName, parts).withColumn("_n", F.row_number().over(newest_patch)).where("_n = 1 AND present")
        return rows.drop("_number", "_n", "present")

    def _write(self, path: str, table: str, state: DataFrame, present: Column) -> None:
        state.withColumn("present", present).write.parquet(f"{self.base}/state/{path}/{table}")

    def build(self, book: Book) -> None:
        """The states and scores of a whole book: the only time that the fact tables are read through."""
        path = uuid.uuid4().hex
        for table, summary in SUMMARIES.items():
            self._write(path, table, summary.state(book[table]).where("customer_id IS NOT NULL"), F.lit(True))
        book["customers"].select("customer_id").limit(0).write.parquet(f"{self.base}/state/{path}/touched")
        number = self.log.last() + 1
        if not self.log.commit(number, path=path, base=True, delivery="build"):
            raise Conflict(f"{self.base} was built by another run")
        states = {table: self.states(table) for table in SUMMARIES}
        scores = scoring.select_scores(scoring.composed(book, scoring.customer_components(book, states)))
        self.scores.write(scoring.stamped(scores), version=number)

    def refresh(self, book: Book, delivery: str, added: dict[str, DataFrame], removed: dict[str, DataFrame] | None = None) -> int:
        """Merge one delivery of changed rows, and publish the scores of the customers that it touches.

        ``book`` is what the tables are after the change; a changed row is a removed and an added one. Rows of customers and of
        industry trends touch their customers, macro indicators touch all. Fact tables are read only for customers whose
        extreme or newest row was removed. Returns the number of customers touched.
        """
        removed = removed or {}
        if any(row["delivery"] == delivery for row in self.log.entries()):
            return self.catch_up(book)
        after, path = self.log.last(), uuid.uuid4().hex
        changes = [(name, df) for part in (added, removed) for name, df in part.items()]
        own = (*SUMMARIES, "customers")
        ids = [df.select("customer_id") for name, df in changes if name in own]
        everybody = book["customers"].select("sector", "industry", "customer_id")
        ids += [everybody.join(df, ["sector", "industry"], "left_semi").select("customer_id") for name, df in changes if name == "industry_trends"]
        ids += [everybody.select("customer_id") for name, _ in changes if name == "macro_economic_indicators"]
        if not ids:
            return 0
        touched = reduce(DataFrame.unionByName, ids).where("customer_id IS NOT NULL").distinct()
        touched.write.parquet(f"{self.base}/state/{path}/touched")
        for table, summary in SUMMARIES.items():
            if table not in added and table not in removed:
                continue
            none = book[table].limit(0)
            plus, minus = added.get(table, none).select(*none.columns), removed.get(table, none).select(*none.columns)
            here = plus.select("customer_id").unionByName(minus.select("customer_id")).where("customer_id IS NOT NULL").distinct()
            new = materialize(self.spark, merged(summary, self.states(table, here), plus, minus), "score-states")
            new = new.where("customer_id IS NOT NULL")
            state, again = new.where("NOT again").drop("again"), new.where("again").select("customer_id")
            if not again.isEmpty():
                state = state.unionByName(summary.state(book[table].join(again, "customer_id", "left_semi")).select(*state.columns))
                gone = again.join(state, "customer_id", "left_anti")
                state = state.unionByName(gone, allowMissingColumns=True)
            present = F.lit(True)
            if summary.counts:
                present = F.coalesce(F.col(summary.counts[0]) > 0, F.lit(False))
            elif not again.isEmpty():
                present = F.col(summary.order[-1]).isNotNull()
            self._write(path, table, state, present)
        for table in SUMMARIES:
            if table not in added and table not in removed:
                none = self.states(table).limit(0)
                self._write(path, table, none, F.lit(True))
        if not self.log.commit(after + 1, path=path, base=False, delivery=delivery):
            raise Conflict(f"{self.base} was refreshed by another run meanwhile: deliver {delivery} again")
        return self.catch_up(book)

    def catch_up(self, book: Book) -> int:
        """Publish the scores of all customers whose states are newer than the published scores."""
        published, entries = self.scores.published(), self.log.entries()
        late = [row for row in entries if published is None or row["number"] > published]
        if not late:
            return 0
        parts = [self.spark.read.parquet(f"{self.base}/state/{row['path']}/touched") for row in late]
        touched = materialize(self.spark, reduce(DataFrame.unionByName, parts).distinct(), "touched")
        states = {table: self.states(table, touched) for table in SUMMARIES}
        here = book.replaced(customers=book["customers"].join(touched, "customer_id", "left_semi"))
        fresh = scoring.stamped(scoring.select_scores(scoring.composed(here, scoring.customer_components(here, states))))
        old = self.scores.read().join(touched, "customer_id", "left_anti")
        self.scores.write(old.unionByName(fresh), version=entries[-1]["number"])
        if len(self._patches()) >= MERGE_AT:
            self.merge()
        return touched.count()

    def merge(self) -> None:
        """All patches as one, with nobody touched."""
        after, path = self.log.last(), uuid.uuid4().hex
        for table in SUMMARIES:
            self._write(path, table, self.states(table), F.lit(True))
        self.states("loan_history").select("customer_id").limit(0).write.parquet(f"{self.base}/state/{path}/touched")
        self.log.commit(after + 1, path=path, base=True, delivery=f"merge-{after}")
