"""Scores kept current from deliveries of changed rows against full runs over the same tables."""

import random

import pytest
from conftest import make_table

from lendscope.plans import score_state, scoring
from lendscope.plans.score_state import SUMMARIES, ScoreState
from lendscope.sources.tables import Book

KEYS = {"company_financials": "financial_id", "loan_repayment": "repayment_id", "bank_transactions": "transaction_id",
        "loan_history": "loan_id", "credit_ratings": "rating_id"}


def one_row(rng, table, number, customer):
    number = f"{number:06d}"
    row = {KEYS[table]: number, "customer_id": customer}
    if table == "company_financials":
        return row | {"fiscal_year": rng.randint(2020, 2022), "fiscal_quarter": rng.choice(["Q1", "Q2", None]),
                      "debt_to_equity_ratio": rng.choice([0.4, 2, 9, None]), "net_profit_margin": rng.choice([0.01, 0.2])}
    if table == "loan_repayment":
        return row | {"payment_status": rng.choice(["ON_TIME", "LATE", None]), "days_overdue": rng.choice([0, 5, 40, 100, None])}
    if table == "bank_transactions":
        return row | {"credit_amount": rng.choice([None, 10, 500]), "debit_amount": rng.choice([None, 0, 100]), "running_balance": rng.choice([None, -5, 70, 900])}
    if table == "loan_history":
        return row | {"loan_status": rng.choice(["ACTIVE", "ACTIVE", "NPA"]), "outstanding_balance": rng.choice([None, 100]), "collateral_value": rng.choice([None, 50, 300])}
    return row | {"rating": rng.choice(["AAA", "B", "D"]), "rating_outlook": rng.choice(["Stable", "Negative"])}


class World:
    """The tables as lists of rows, changed delivery by delivery."""

    def __init__(self, spark, seed, customers=25):
        self.spark, self.rng, self.number = spark, random.Random(seed), 0
        self.names = [f"c{i}" for i in range(customers)]
        self.rows = {table: [] for table in KEYS} | {
            "customers": [{"customer_id": c, "company_name": c, "sector": "ST"[i % 2], "industry": "I"} for i, c in enumerate(self.names)],
            "industry_trends": [{"trend_id": "x", "sector": "S", "industry": "I", "outlook": "WATCHLIST", "default_rate_pct": 5.0}],
            "macro_economic_indicators": [],
        }

    def new(self, table, customer=None):
        self.number += 1
        return one_row(self.rng, table, self.number, customer or self.rng.choice(self.names))

    def deliver(self, added, removed):
        for table, rows in removed.items():
            self.rows[table] = [row for row in self.rows[table] if row not in rows]
        for table, rows in added.items():
            self.rows[table] += rows

    def frames(self, changes):
        return {table: make_table(self.spark, table, rows) for table, rows in changes.items()}

    def book(self):
        made = self.frames(self.rows)
        return Book(self.spark, {table: (lambda _, df=df: df) for table, df in made.items()})


def check(world, state):
    full = sorted(tuple(row) for row in scoring.risk_scores(world.book()).collect())
    found = state.scores.read()
    assert sorted(tuple(row) for row in found.drop("scored_at").collect()) == full
    for table, summary in SUMMARIES.items():
        stored = state.states(table)
        whole = summary.state(world.book()[table]).select(*stored.columns)
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, whole.collect())), table


def step(world, state, name, added, removed):
    before = state.scores.read().select("customer_id", "scored_at").collect()
    world.deliver(added, removed)
    state.refresh(world.book(), name, world.frames(added), world.frames(removed))
    check(world, state)
    return {row["customer_id"]: row["scored_at"] for row in before}


def test_deliveries_equal_full_runs(spark, tmp_path):
    world = World(spark, 4)
    for table in KEYS:
        world.rows[table] = [world.new(table) for _ in range(60)]
    state = ScoreState(spark, f"file://{tmp_path}")
    state.build(world.book())
    check(world, state)
    # Only new rows: what is touched is scored anew, the others keep their stamp.
    added = {table: [world.new(table, c) for c in ("c1", "c2")] for table in KEYS}
    stamps = step(world, state, "new rows", added, {})
    now = {row["customer_id"]: row["scored_at"] for row in state.scores.read().collect()}
    assert {c for c in now if now[c] != stamps[c]} == {"c1", "c2"}
    # Corrections of random rows, extremes and newest ones among them, and a customer that loses all rows.
    rng = world.rng
    removed = {table: rng.sample(world.rows[table], 15) for table in KEYS}
    removed = {table: rows + [r for r in world.rows[table] if r["customer_id"] == "c3" and r not in rows] for table, rows in removed.items()}
    added = {
        table: [one_row(rng, table, int(row[KEYS[table]]), row["customer_id"]) for row in rows if row["customer_id"] != "c3"]
        for table, rows in removed.items()
    }
    step(world, state, "corrections", added, removed)
    # A customer that comes, one that goes, a trend of a sector, and an indicator for all.
    gone = world.rows["customers"][0]
    step(world, state, "customers", {"customers": [{"customer_id": "c99", "company_name": "n", "sector": "S", "industry": "I"}],
                                     "loan_history": [world.new("loan_history", "c99")]}, {"customers": [gone]})
    step(world, state, "trend", {"industry_trends": [{"trend_id": "y", "sector": "T", "industry": "I", "outlook": "POSITIVE"}]}, {})
    cpi = {"indicator_id": "m", "indicator_name": "CPI_GENERAL", "indicator_category": "INFLATION", "value": 7.5}
    step(world, state, "macro", {"macro_economic_indicators": [cpi]}, {})
    # Merged patches are the same state.
    state.merge()
    check(world, state)
    step(world, state, "after", {"loan_repayment": [world.new("loan_repayment", "c5")]}, {})


def test_a_delivery_counts_once(spark, tmp_path, monkeypatch):
    world = World(spark, 5, 6)
    for table in KEYS:
        world.rows[table] = [world.new(table) for _ in range(10)]
    state = ScoreState(spark, f"file://{tmp_path}")
    state.build(world.book())
    added = {"loan_repayment": [world.new("loan_repayment", "c1")]}
    world.deliver(added, {})
    monkeypatch.setattr(state, "catch_up", lambda book: pytest.fail("dies"))  # after the states were committed
    with pytest.raises(pytest.fail.Exception):
        state.refresh(world.book(), "d1", world.frames(added))
    monkeypatch.undo()
    assert state.refresh(world.book(), "d1", world.frames(added)) == 1  # made up for, and not merged again
    check(world, state)
    assert state.refresh(world.book(), "d1", world.frames(added)) == 0


def test_no_fact_table_is_read_for_new_rows(spark, tmp_path):
    world = World(spark, 6, 6)
    for table in KEYS:
        world.rows[table] = [world.new(table) for _ in range(10)]
    state = ScoreState(spark, f"file://{tmp_path}")
    state.build(world.book())
    book = world.book()

    class Guarded(Book):
        def __getitem__(self, name):
            found = book[name]
            return found.where("raise_error('a fact table is read') IS NULL") if name in KEYS else found

        def replaced(self, **tables):
            guarded = Guarded(self.spark, {})
            return book.replaced(**{name: guarded[name] for name in KEYS}, **tables)

    added = {table: [world.new(table, "c1")] for table in KEYS}
    assert state.refresh(Guarded(spark, {}), "d1", world.frames(added)) == 1


def test_patches_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(score_state, "MERGE_AT", 3)
    world = World(spark, 7, 5)
    for table in KEYS:
        world.rows[table] = [world.new(table) for _ in range(10)]
    state = ScoreState(spark, f"file://{tmp_path}")
    state.build(world.book())
    for number in range(3):
        added = {"bank_transactions": [world.new("bank_transactions")]}
        world.deliver(added, {})
        state.refresh(world.book(), f"d{number}", world.frames(added))
        assert len(state._patches()) < 3
    check(world, state)
