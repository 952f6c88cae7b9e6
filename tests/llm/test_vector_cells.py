"""Exact top-k over approximations against the comparison of all pairs."""

import math
import random

import numpy as np
import pytest

from lendscope.llm import vector_cells

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def brute_force(rows, k, every):
    whole = set()
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        if all(abs(x) <= vector_cells.LARGEST for x in ints):
            whole.add((vec_id, ints))
    out = []
    for vec_id, ints in whole:
        if vec_id % every == 0:
            others = [(-sum(a * b for a, b in zip(ints, v)), i, v) for i, v in whole if len(v) == len(ints) and (i, v) != (vec_id, ints)]
            out += [(vec_id, at + 1, i, -s) for at, (s, i, _) in enumerate(sorted(others)[:k])]
    return sorted(out)


def found_in(spark, rows, k=5, every=50, tile=vector_cells.TILE):
    df = spark.createDataFrame([(i, v, 3, "x", "y") for i, v in rows], SCHEMA).repartition(5)
    found = vector_cells.nearest(df, k, every, tile)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in found.collect())


def made(seed, n, dim):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] * 0.5 + rng.normal(size=dim) * 0.2).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("tile,every", [(100, 10), (8192, 7)])
def test_against_all_pairs(spark, tile, every):
    rows = made(2, 700, 12)
    assert found_in(spark, rows, every=every, tile=tile) == brute_force(rows, 5, every)


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(300)]  # many ties
    rows += [(i, [0.25, 0.5, -0.125]) for i in range(1000, 1400)]  # copies, queries among them
    rows += rows[990:1010] + [(50, [2.0, 2.0, 2.0]), (50, [2.0, 2.0, 2.0])]  # repeated rows, an id with two vectors
    rows += [(None, [1.0, 1.0, 1.0]), (2000, None), (2050, [1.0, None, 1.0]), (2100, [float("nan"), 1.0, 1.0])]
    rows += [(2150, [float("inf"), 1.0, 1.0]), (2200, [1e30, 0.0, 0.0]), (2250, [65536.0, -65536.0, 1.0])]
    rows += [(3000, []), (3050, []), (3001, [1.0]), (3100, [2.0]), (3150, [0.0] * 40)]  # other lengths
    assert found_in(spark, rows) == brute_force(rows, 5, 50)


def test_fewer_rows_than_wanted_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (-50, [0.1, 0.9])]
    assert found_in(spark, rows) == brute_force(rows, 5, 50) and len(brute_force(rows, 5, 50)) == 4
    assert found_in(spark, [(0, [1.0])]) == []
    assert found_in(spark, []) == []


def test_bounds_hold_the_products():
    rng = np.random.default_rng(1)
    vectors, asked = rng.integers(-200, 200, (500, 9)), rng.integers(-200, 200, (20, 9)).astype(np.int32)
    borders = np.tile(np.array([-200, -90, -10, 0, 30, 100, 200]), (9, 1))
    codes = np.stack([np.searchsorted(b[1:-1], column, side="right") for b, column in zip(borders, vectors.T)], axis=1)
    least, most = vector_cells._bounds(codes, borders, asked)
    exact = asked.astype(np.int64) @ vectors.T
    assert (least <= exact).all() and (exact <= most).all()


def test_only_few_exact_vectors_are_read(spark):
    rows = made(3, 2000, 16)
    vectors = vector_cells.whole_vectors(spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>"))
    kinds = vector_cells.materialize(spark, vector_cells.distinct_vectors(vectors, 6), "test")
    asked = kinds.where("ids[0] % 50 = 0").select("key")
    read = vector_cells.best_kinds(kinds.select("key", "dim", "ints"), asked, 6, tile=500)
    assert read.count() < 0.1 * 2000 * asked.count()
