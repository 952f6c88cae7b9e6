"""Exact top-k by inner product over a vector-approximation file."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.session import materialize

#: Components are multiplied by this and floored before they are compared.
SCALE = 256
#: Components beyond this, floored, take no part: the sum of products of longer vectors would leave 64 bits.
LARGEST = 1 << 24
#: Every row whose id is divisible by this is a query.
QUERY_EVERY = 50
#: Bits of a cell's number in one dimension.
BITS = 6
#: About so many vectors, by their hashes, are what the inner cell borders are fitted to. The outer ones come from all vectors.
SAMPLE = 20_000
#: Vectors of one tile, which a task holds while the queries pass by in batches.
TILE = 8192
#: Vectors that each query reads in the first round, as a multiple of k + 1; every later round reads four times as many.
FIRST_READS = 4
#: Queries whose bounds are computed at once.
AT_ONCE = 128


def _whole(batches):
    """(vec_id, embedding) batches as (vec_id, dim, ints): the floored components, 4 bytes each."""
    for batch in batches:
        ids, sizes, packed = [], [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
            if vec_id is None or not vector.is_valid:
                continue
            values = vector.values
            if values.null_count:
                continue
            floored = np.floor(SCALE * np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64))
            if not np.all(np.abs(floored) <= LARGEST):  # false for what is not finite as well
                continue
            ids.append(vec_id)
            sizes.append(len(floored))
            packed.append(floored.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], ["vec_id", "dim", "ints"]
        )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A binary column of equal vectors as a matrix of int32."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(len(column), dim)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, ints) of every row that takes part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(_whole, "vec_id long, dim int, ints binary")


def distinct_vectors(vectors: DataFrame, members: int) -> DataFrame:
    """(key, dim, ints, ids) of every distinct vector: its ``members`` smallest ids, as no more of them can be in a result.

    The ids are limited inside each task before the exchange, so a vector that a third of all rows share moves little.
    """
    same = Window.partitionBy("dim", "ints").orderBy("vec_id")
    few = vectors.distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= members)
    kinds = few.groupBy("dim", "ints").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return kinds.select(F.monotonically_increasing_id().alias("key"), "dim", "ints", "ids")


def cell_borders(kinds: DataFrame, bits: int = BITS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """For every length of vectors an int32 matrix (length, 2 ** bits + 1) of the cells' first integers, and past the last.

    Cells hold about equally many vectors of the sample. The least and the largest integer of a dimension are taken over
    all vectors, so each one lies in a cell. As many numbers as dimensions reach the driver, for each length.
    """

    def extremes(batches):
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            dims = np.asarray(batch.column(0))
            for dim in np.unique(dims).tolist():
                block = _matrix(batch.column(1).filter(pa.array(dims == dim)), dim)
                low, high = block.min(axis=0), block.max(axis=0)
                if dim in seen:
                    low, high = np.minimum(low, seen[dim][0]), np.maximum(high, seen[dim][1])
                seen[dim] = [low, high]
        for dim, (low, high) in seen.items():
            place = pa.array(np.arange(dim), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), place, pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                ["dim", "place", "low", "high"],
            )

    ends = (
        kinds.select("dim", "ints")
        .mapInArrow(extremes, "dim int, place int, low int, high int")
        .groupBy("dim", "place")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    # A hash below the wanted share of its range: no task or driver sees more than about the sample.
    share = min(1.0, sample / max(1, kinds.count()))
    held = kinds.where(F.pmod(F.xxhash64("ints"), F.lit(1 << 30)) < int(share * (1 << 30))).select("dim", "ints").toArrow()
    borders = {0: np.zeros((0, (1 << bits) + 1), np.int64)}
    for dim in {row.dim for row in ends}:
        low, high = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for row in ends:
            if row.dim == dim:
                low[row.place], high[row.place] = row.low, row.high
        block = _matrix(held.column("ints").combine_chunks().filter(pa.array(np.asarray(held.column("dim")) == dim)), dim)
        steps = np.arange(1, 1 << bits) / (1 << bits)
        if len(block):
            inner = np.quantile(block, steps, axis=0, method="lower").T.astype(np.int64)
        else:  # a length that the sample does not have: even cells
            inner = (low[:, None] + np.floor((high - low)[:, None] * steps)).astype(np.int64)
        borders[dim] = np.column_stack([low, np.clip(inner, low[:, None], high[:, None]), high + 1])
    return borders


def approximations(kinds: DataFrame, borders: dict[int, np.ndarray]) -> DataFrame:
    """(key, dim, cells): one byte per dimension, the number of the cell that holds the integer."""

    def cells(batches):
        for batch in batches:
            dims = np.asarray(batch.column(1))
            for dim in np.unique(dims).tolist():
                chosen = batch.filter(pa.array(dims == dim))
                block, inner = _matrix(chosen.column(2), dim), borders[dim][:, 1:-1]
                codes = np.empty(block.shape, np.uint8)
                for place in range(dim):
                    codes[:, place] = np.searchsorted(inner[place], block[:, place], side="right")
                yield pa.RecordBatch.from_arrays(
                    [chosen.column(0), chosen.column(1), pa.array([row.tobytes() for row in codes], pa.binary())], ["key", "dim", "cells"]
                )

    return kinds.select("key", "dim", "ints").mapInArrow(cells, "key long, dim int, cells binary")


def _bounds(codes: np.ndarray, borders: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of every query with any vector of every cell, as float64 matrices (query, cell).

    Sums of products of integers below 2 ** 53 are exact; those beyond are widened by what rounding can take.
    """
    places = np.arange(codes.shape[1])
    low, high = borders[places, codes].astype(np.float64), borders[places, codes + 1].astype(np.float64) - 1
    up, down = np.maximum(asked, 0).astype(np.float64), np.minimum(asked, 0).astype(np.float64)
    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    size = np.abs(asked).sum(axis=1, dtype=np.float64) * max(np.abs(borders).max(initial=0), 1)
    slack = np.where(size < 2.0**52, 0.0, size * 2.0**-40)[:, None]
    return least - slack, most + slack


def _tiles(cells: DataFrame, asked: DataFrame, tiles: int) -> DataFrame:
    """Cells, then all queries, of every tile, in the order in which a task reads them: (dim, n, side, key, body, bound).

    A tile holds a share of the vectors of one length, and each query of that length goes to every tile in batches,
    so neither side is ever held whole by a task, however many rows there are.
    """
    number = F.pmod(F.xxhash64("key"), F.lit(tiles)).cast("int")
    none = F.lit(None).cast("long")
    left = cells.select(
        F.struct("dim", number.alias("n")).alias("tile"), F.lit(0).alias("side"), "key", F.col("cells").alias("body"), none.alias("bound")
    )
    everywhere = asked.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("n"), "dim", "key", "ints", "bound")
    right = everywhere.select(F.struct("dim", "n").alias("tile"), F.lit(1).alias("side"), "key", F.col("ints").alias("body"), "bound")
    rows = left.unionByName(right).repartition("tile").sortWithinPartitions("tile", "side", "key")
    return rows.select("tile.dim", "tile.n", "side", "key", "body", "bound")


def _scan(borders: dict[int, np.ndarray], answer):
    """A step over what ``_tiles`` makes: ``answer(keys, least, most, queries, bounds)`` for each tile and batch of queries."""

    def scan(batches):
        tile, held, ready = None, [], None

        def cells():
            nonlocal ready
            if ready is None:
                dim = tile[0]
                codes = np.frombuffer(b"".join(body for block in held for body in block[1]), np.uint8)
                keys = np.concatenate([block[0] for block in held])
                ready = keys, codes.reshape(len(keys), dim)
            return ready

        for batch in batches:
            dims, numbers = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            sides = np.asarray(batch.column(2))
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(numbers) != 0) | (np.diff(sides) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dims)]):
                if end == start:
                    continue
                now = (int(dims[start]), int(numbers[start]))
                if now != tile:
                    tile, held, ready = now, [], None
                keys = np.asarray(batch.column(3).slice(start, end - start))
                body = batch.column(4).slice(start, end - start)
                if sides[start] == 0:
                    held.append((keys, body.to_pylist()))
                    continue
                if not held:
                    continue
                own, codes = cells()
                bound = np.asarray(batch.column(5).slice(start, end - start).fill_null(np.iinfo(np.int64).min))
                for at in range(0, end - start, AT_ONCE):
                    few = body.slice(at, AT_ONCE)
                    least, most = _bounds(codes, borders[tile[0]], _matrix(few, tile[0]))
                    yield from answer(own, least, most, keys[at : at + AT_ONCE], bound[at : at + AT_ONCE])

    return scan


def _best_bounds(k: int):
    """Step of the first scan: of every query and tile the k largest lower bounds."""

    def answer(own, least, most, queries, bounds):
        width = min(k, least.shape[1])
        best = np.floor(-np.partition(-least, width - 1, axis=1)[:, :width]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(queries, width), pa.int64()), pa.array(best.ravel(), pa.int64())], ["query", "least"]
        )

    return answer


def _candidates(own, least, most, queries, bounds):
    """Step of the second scan: the cells whose upper bound reaches the query's threshold."""
    row, column = np.nonzero(most >= bounds[:, None])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(queries[row], pa.int64()),
            pa.array(own[column], pa.int64()),
            pa.array(np.ceil(most[row, column]).astype(np.int64), pa.int64()),
        ],
        ["query", "key", "most"],
    )


def _products(batches):
    """(query, key, ints of both) batches with their exact inner products."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        scores = np.zeros(len(left), np.int64)
        sizes = np.asarray(pc.binary_length(left))
        for size in np.unique(sizes).tolist():
            chosen = pa.array(sizes == size)
            a, b = _matrix(left.filter(chosen), size // 4), _matrix(right.filter(chosen), size // 4)
            scores[sizes == size] = np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], ["query", "key", "score"])


def _kth(scores: DataFrame, value: str, k: int) -> DataFrame:
    """(query, bound): the k-th largest value, for queries that have as many; limited in each task first."""
    best = Window.partitionBy("query").orderBy(F.col(value).desc())
    few = scores.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    return few.groupBy("query").agg(F.min(value).alias("bound"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") == k).drop("_n")


def best_kinds(kinds: DataFrame, asked: DataFrame, k: int, tile: int = TILE, bits: int = BITS, sample: int = SAMPLE) -> DataFrame:
    """(query, key, score): of the distinct vectors ``kinds`` (key, dim, ints) those that can be among each query's k best.

    ``asked`` holds the keys of the distinct query vectors, which are among ``kinds``. Two scans of the cells give each
    query its threshold, the k-th largest lower bound, and the candidates that reach it. Exact vectors are then
    read in the order of the upper bounds, in rounds, until no unread bound reaches the k-th exact score.
    """
    spark = kinds.sparkSession
    borders = cell_borders(kinds, bits, sample)
    cells = materialize(spark, approximations(kinds, borders), "vector-cells")
    exact = kinds.select("key", "ints")
    tiles = max(1, -(-cells.count() // tile))
    queries = materialize(spark, kinds.join(asked, "key", "left_semi").select("key", "dim", "ints"), "vector-queries")
    first = _tiles(cells, queries.withColumn("bound", F.lit(None).cast("long")), tiles)
    bounds = _kth(first.mapInArrow(_scan(borders, _best_bounds(k)), "query long, least long"), "least", k)
    armed = queries.join(bounds.withColumnRenamed("query", "key"), "key", "left")
    found = _tiles(cells, armed, tiles).mapInArrow(_scan(borders, _candidates), "query long, key long, most long")
    by_bound = Window.partitionBy("query").orderBy(F.col("most").desc(), "key")
    found = materialize(spark, found.withColumn("place", F.row_number().over(by_bound)), "vector-candidates")
    wanted = queries.select(F.col("key").alias("query"), F.col("ints").alias("wanted"))
    read, start, reads = None, 0, FIRST_READS * k
    while True:
        batch = found.where((F.col("place") > start) & (F.col("place") <= start + reads))
        left = found.where(F.col("place") > start + reads)
        if read is not None:
            bounds = materialize(spark, _kth(read, "score", k), "vector-bounds")
            reach = (F.col("most") >= F.col("bound")) | F.col("bound").isNull()
            batch, left = (part.join(bounds, "query", "left").where(reach).drop("bound") for part in (batch, left))
        pairs = batch.select("query", "key").join(exact, "key").join(wanted, "query").select("query", "key", "wanted", "ints")
        scored = materialize(spark, pairs.mapInArrow(_products, "query long, key long, score long"), "vector-scores")
        read = scored if read is None else read.unionByName(scored)
        if left.isEmpty():
            return read
        start, reads = start + reads, 4 * reads


def nearest(embeddings: DataFrame, k: int = 5, query_every: int = QUERY_EVERY, tile: int = TILE) -> DataFrame:
    """The k best other rows of every row whose vec_id is divisible by ``query_every``: query_id, rank (from 1), vec_id, score.

    The score is the integer inner product of the components, each floored after multiplication by SCALE; equal scores go by the smaller
    vec_id. A vector that is null, holds a null, a NaN or an infinite component, or one beyond LARGEST, takes no part, nor does
    a row without vec_id. Only vectors of equal length are compared; those without any component all score 0.
    Rows that repeat id and vector count as one; an id with several vectors is a row, and a query, for each. An empty
    table, or one without queries, gives no rows. Further columns are not read.

    Rows of one vector are searched for as one, and written out again at the end.
    """
    spark = embeddings.sparkSession
    vectors = materialize(spark, whole_vectors(embeddings), "vectors")
    kinds = materialize(spark, distinct_vectors(vectors, k + 1), "vector-kinds")
    keys = kinds.select("key", "dim", "ints")
    queries = vectors.where(F.col("vec_id") % query_every == 0).distinct().join(keys, ["dim", "ints"])
    queries = materialize(spark, queries.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query")), "vector-asked")
    # A result of k rows beside the query's own needs the k + 1 best of all rows.
    scores = best_kinds(keys, queries.select(F.col("query").alias("key")).distinct(), k + 1, tile)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "key")
    rows = scores.join(kinds.select("key", F.explode("ids").alias("vec_id")), "key")
    rows = rows.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    lists = rows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_n", "vec_id", "key", "score"))).alias("_list"))

    def other(row: Column) -> Column:
        return ~((row["vec_id"] == F.col("query_id")) & (row["key"] == F.col("query")))

    listed = queries.join(lists, "query").select("query_id", F.posexplode(F.slice(F.filter("_list", other), 1, k)).alias("_at", "_row"))
    return listed.select("query_id", (F.col("_at") + 1).cast("int").alias("rank"), "_row.vec_id", "_row.score")


SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id AND len(q.v) = len(r.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
