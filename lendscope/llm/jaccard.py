"""Documents linked by the Jaccard similarity of their word n-grams, with a tree over group counts.

Each n-gram's hash falls into one of `GROUPS` groups; a document is the point of its group
counts. Two documents cannot share more n-grams than the sum, over all groups, of the
smaller of their counts. A bulk-loaded tree of boxes over such points prunes whole boxes by this
bound, and the pairs that survive are verified on their full sets.

Points alone do not tell distributed tasks which documents to bring together, so trees are
built within blocks: in an order of all n-grams from rare to frequent, two linked documents
must share one of the first n - ceil(t * n) + 1. Blocks are worked through twice. First every
block links its members to its hub, and what passes bound and verification forms first
components. Then only pairs from different components are searched, so a large group of
near copies costs links in proportion to its size, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import buckets, texts
from lendscope.llm.components import components
from lendscope.llm.parcels import PARCEL, owners as entry_owners, pack, runs
from lendscope.llm.wordhash import mix, slices, text_buffers, windows, words
from lendscope.session import materialize

#: Words of an n-gram; a shorter text is one n-gram as a whole.
SHINGLE = 4
#: Two documents link at this percentage of shared n-grams.
PERCENT = 85
GROUPS = 256
#: A point's coordinate from here on is taken as unbounded.
_WIDEST = 65_535
#: Hash ranges whose document frequencies order the n-grams.
RANGES = 1 << 16
_RANGE_SLICES = 16
#: Points in a leaf and boxes in a box.
FAN_OUT = 16
#: Entries a task brings together before it sends them on.
HELD_ENTRIES = 2_000_000


def shingle_sets(found, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the distinct n-grams of a slice's documents, in this order."""
    counts = found.counts
    owner = found.owner
    place, codes = windows(found.hashes, found.first, size)
    owners, hashes = [owner[place]], [codes]
    for short in range(1, size):
        if (counts == short).any():
            place, codes = windows(found.hashes, found.first, short)
            whole = counts[owner[place]] == short
            owners.append(owner[place][whole])
            hashes.append(codes[whole])
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return owners[fresh], hashes[fresh]


def _slices(batch, column: str = "text"):
    offsets, data = text_buffers(batch.column(column))
    for at, end in slices(offsets):
        part = offsets[at : end + 1]
        yield at, end, words(part - part[0], data[part[0] : part[-1]], lower=True)


def _keys(owners: np.ndarray, hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, key) of each document of a slice; equal sets have equal keys."""
    n = np.bincount(owners, minlength=count)
    heads = runs(owners)
    keys = np.zeros(count, np.uint64)
    if len(owners):
        keys[owners[heads]] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), heads)
    return n, mix(keys + n.astype(np.uint64)).view(np.int64)


PROFILE = "doc_id long, n_shingles long, key long, point binary, part int, frequency binary"


def _profiler(size: int, groups: int):
    """A step from documents to their points, and from each task one row per part of the frequency table."""

    def step(batches):
        frequency = np.zeros(RANGES, np.int64)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        names = ["doc_id", "n_shingles", "key", "point", "part", "frequency"]
        for batch in batches:
            for at, end, found in _slices(batch):
                owners, hashes = shingle_sets(found, size)
                count = end - at
                n, keys = _keys(owners, hashes, count)
                group = (hashes % np.uint64(groups)).astype(np.int64)
                points = np.bincount(owners * groups + group, minlength=count * groups).reshape(count, groups)
                points = np.minimum(points, _WIDEST).astype(np.uint16)
                frequency += np.bincount((hashes >> np.uint64(48)).astype(np.int64), minlength=RANGES)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, count),
                        pa.array(n, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array([p.tobytes() for p in points], pa.binary()),
                        pa.nulls(count, pa.int32()),
                        pa.nulls(count, pa.binary()),
                    ],
                    names,
                )
        if frequency.any():
            parts = [p.tobytes() for p in frequency.reshape(_RANGE_SLICES, -1)]
            empty = [pa.nulls(_RANGE_SLICES, t) for t in types[:4]]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(_RANGE_SLICES), pa.int32()), pa.array(parts, pa.binary())], names)

    return step


def _adder(batches):
    """Sums frequency tables by part."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("frequency").to_pylist()):
            table = np.frombuffer(blob, np.int64)
            sums[part] = sums[part] + table if part in sums else table
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "frequency"]
        )


def _rarity(profile: DataFrame) -> np.ndarray:
    """The rank of each hash range by the documents that its n-grams occur in: a fixed 65,536 numbers."""
    tables = profile.where("part IS NOT NULL").select("part", "frequency")
    partial = tables.mapInArrow(_adder, "part int, frequency binary")
    rows = partial.repartition("part").mapInArrow(_adder, "part int, frequency binary").collect()  # _RANGE_SLICES rows
    counts = np.zeros((_RANGE_SLICES, RANGES // _RANGE_SLICES), np.int64)
    for row in rows:
        counts[row["part"]] = np.frombuffer(row["frequency"], np.int64)
    ranks = np.empty(RANGES, np.int32)
    ranks[np.argsort(counts.ravel(), kind="stable")] = np.arange(RANGES, dtype=np.int32)
    return ranks


def _poster(size: int, percent: int, ranks: np.ndarray, count: int):
    """A step from documents to parcels of their rarest n-grams, owned by the set's key."""

    def send(codes, keys):
        order = np.lexsort((keys, codes))
        codes, keys = codes[order], keys[order]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (keys[1:] != keys[:-1])
        codes, keys = codes[fresh], keys[fresh]
        bucket = ((codes >> np.uint64(24)) & np.uint64(0xFFFFFF)).astype(np.int64) % count
        unmarked = np.zeros(len(codes), np.uint8)
        return pack(bucket, unmarked.astype(np.int8), keys, codes, unmarked, 8)

    def step(batches):
        held, size_held = [], 0
        for batch in batches:
            for at, end, found in _slices(batch):
                owners, hashes = shingle_sets(found, size)
                n, keys = _keys(owners, hashes, end - at)
                rank = ranks[(hashes >> np.uint64(48)).astype(np.int64)]
                order = np.lexsort((hashes, rank, owners))
                owners, hashes = owners[order], hashes[order]
                place = np.arange(len(owners)) - (np.cumsum(n) - n)[owners]
                first = place < (n - -(-percent * n // 100) + 1)[owners]
                held.append((hashes[first], keys[owners[first]]))
                size_held += int(first.sum())
                if size_held >= HELD_ENTRIES:
                    yield send(*(np.concatenate(x) for x in zip(*held)))
                    held, size_held = [], 0
        if size_held:
            yield send(*(np.concatenate(x) for x in zip(*held)))

    return step


BLOCKS = "codes binary, sizes binary, members binary"


def _blocks(batches):
    """Parcels sorted by bucket -> blocks: the n-grams that several sets hold, with the sets' keys."""

    def settle(parcels):
        keys = np.concatenate([entry_owners(d, s) for d, s, _ in parcels])
        codes = np.concatenate([np.frombuffer(c, np.uint64) for *_, c in parcels])
        order = np.lexsort((keys, codes))
        codes, keys = codes[order], keys[order]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (keys[1:] != keys[:-1])
        codes, keys = codes[fresh], keys[fresh]
        heads = runs(codes)
        sizes = np.diff(np.append(heads, len(codes)))
        several = np.repeat(sizes > 1, sizes)
        if not several.any():
            return None
        made = codes[heads][sizes > 1], sizes[sizes > 1].astype(np.uint32), keys[several]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in made], ["codes", "sizes", "members"])

    bucket, held = None, []
    for batch in batches:
        columns = [batch.column(name) for name in ("bucket", "docs", "sizes", "codes")]
        for place in range(batch.num_rows):
            number, *parcel = (column[place].as_py() for column in columns)
            if number != bucket and held:
                if (made := settle(held)) is not None:
                    yield made
                held = []
            bucket = number
            held.append(parcel)
    if held and (made := settle(held)) is not None:
        yield made


def _members(batch):
    for codes, sizes, members in zip(*(batch.column(name).to_pylist() for name in ("codes", "sizes", "members"))):
        sizes = np.frombuffer(sizes, np.uint32).astype(np.int64)
        yield np.frombuffer(codes, np.uint64), sizes, np.frombuffer(members, np.int64)


def _spread(batches):
    """Blocks -> one row per member."""
    for batch in batches:
        for codes, sizes, members in _members(batch):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(codes, sizes).view(np.int64), pa.int64()), pa.array(members, pa.int64())], ["code", "key"]
            )


def point_rows(blobs: list[bytes], groups: int) -> np.ndarray:
    """Stored points as rows of numbers, whose sums of minima never fall below the true overlap."""
    points = np.frombuffer(b"".join(blobs), np.uint16).reshape(-1, groups).astype(np.int32)
    points[points == _WIDEST] = 1 << 24
    return points


def enough(shared, n_a, n_b, percent: int = PERCENT):
    """Whether ``shared`` of two sets' n-grams are the asked percentage of their union."""
    return (100 + percent) * shared >= percent * (n_a + n_b)


class CountTree:
    """Boxes over points of group counts, packed bottom-up from points in order of size and largest spread."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fan_out: int = FAN_OUT):
        count = len(sizes)
        order = np.argsort(sizes, kind="stable")
        strip = max(fan_out, int(np.ceil(np.sqrt(count / fan_out))) * fan_out)
        widest = int(np.argmax(points.max(0) - points.min(0))) if count else 0
        for a in range(0, count, strip):  # strips of similar size, each ordered by one coordinate
            part = order[a : a + strip]
            order[a : a + strip] = part[np.argsort(points[part, widest], kind="stable")]
        self.order, self.fan_out = order, fan_out
        #: From the points up to the root: (largest coordinate counts, least size, largest size).
        self.floors = [(points[order], sizes[order], sizes[order])]
        while len(self.floors[-1][1]) > fan_out:
            high, least, most = self.floors[-1]
            heads = np.arange(0, len(least), fan_out)
            self.floors.append(
                (np.maximum.reduceat(high, heads), np.minimum.reduceat(least, heads), np.maximum.reduceat(most, heads))
            )

    def pairs(self, percent: int, apart: np.ndarray, chunk: int = 4096):
        """Pairs of places whose bound reaches the percentage and whose labels in ``apart`` differ."""
        points, sizes, _ = self.floors[0]
        labels = apart[self.order]
        for a in range(0, len(sizes), 256):
            query = np.arange(a, min(len(sizes), a + 256))
            top = len(self.floors[-1][1])
            frontier = np.repeat(query, top), np.tile(np.arange(top), len(query))
            for floor in range(len(self.floors) - 1, -1, -1):
                high, least, most = self.floors[floor]
                q, box = frontier
                near = (100 * most[box] >= percent * sizes[q]) & (100 * sizes[q] >= percent * least[box])
                if floor == 0:  # each pair once
                    near &= (box > q) & (labels[box] != labels[q])
                q, box = q[near], box[near]
                keep = np.zeros(len(q), bool)
                for b in range(0, len(q), chunk):
                    shared = np.minimum(points[q[b : b + chunk]], high[box[b : b + chunk]]).sum(axis=1, dtype=np.int64)
                    least_here = np.maximum(least[box[b : b + chunk]], -(-percent * sizes[q[b : b + chunk]] // 100))
                    keep[b : b + chunk] = enough(shared, sizes[q[b : b + chunk]], least_here, percent)
                q, box = q[keep], box[keep]
                if floor:
                    below = len(self.floors[floor - 1][1])
                    q, box = np.repeat(q, self.fan_out), (box[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
                    q, box = q[box < below], box[box < below]
                frontier = q, box
            yield self.order[frontier[0]], self.order[frontier[1]]


def _groups_of(batches, names):
    """Rows that are sorted by ``code``, as one tuple of arrays per code."""
    held, code = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name) for name in names]
        codes = batch.column("code").to_numpy()
        stops = np.append(runs(codes), len(codes)).tolist()
        for a, b in zip(stops, stops[1:]):
            if held and codes[a] != code:
                yield code, held
                held = []
            code = codes[a]
            held.append([column.slice(a, b - a) for column in columns])
    if held:
        yield code, held


def _several_components(batches):
    """Rows sorted by block -> those of blocks whose members are of more than one component."""
    for code, held in _groups_of(batches, ["key", "component"]):
        labels = np.concatenate([x[1].to_numpy() for x in held])
        if (labels != labels[0]).any():
            keys = np.concatenate([x[0].to_numpy() for x in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), code), pa.int64()), pa.array(keys, pa.int64())], ["code", "key"]
            )


def _search(percent: int, groups: int):
    """Rows sorted by block -> pairs of different components that pass the tree of their block."""

    def step(batches):
        for _, held in _groups_of(batches, ["rep", "component", "n_shingles", "point"]):
            rep, component, size = (np.concatenate([x[i].to_numpy() for x in held]) for i in range(3))
            points = point_rows([p for x in held for p in x[3].to_pylist()], groups)
            for left, right in CountTree(points, size).pairs(percent, component):
                if len(left):
                    a, b = np.minimum(rep[left], rep[right]), np.maximum(rep[left], rep[right])
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return step


def _bounded(percent: int, groups: int):
    """Pairs with both points -> those whose bound reaches the percentage."""

    def step(batches):
        for batch in batches:
            if batch.num_rows:
                p, q = (point_rows(batch.column(name).to_pylist(), groups) for name in ("point_a", "point_b"))
                shared = np.minimum(p, q).sum(axis=1, dtype=np.int64)
                keep = enough(shared, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return step


def _verifier(size: int, percent: int):
    """Pairs with both texts -> those whose sets reach the percentage."""

    def sets(batch, column):
        found = [None] * batch.num_rows
        for at, end, slice_words in _slices(batch, column):
            owners, hashes = shingle_sets(slice_words, size)
            stops = np.searchsorted(owners, np.arange(end - at + 1))
            for i in range(end - at):
                found[at + i] = hashes[stops[i] : stops[i + 1]]
        return found

    def step(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                keep = []
                for one, other in zip(sets(part, "text_a"), sets(part, "text_b")):
                    shared = len(np.intersect1d(one, other, assume_unique=True))
                    keep.append(bool(shared and enough(shared, len(one), len(other), percent)))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return step


def _links(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b: ids) that are truly linked; texts are joined by id from one and the same exchange."""
    left = docs.select(F.col("doc_id").alias("id_a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("id_b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(_verifier(size, percent), "a long, b long")


def _stars(spread: DataFrame) -> DataFrame:
    """Each member of a block with the block's hub: the member that is in the most blocks.

    Of near copies, the least edited one shares the most n-grams with the others, and is the likeliest to link with them.
    """
    counts = spread.groupBy(F.col("key").alias("counted")).agg(F.count(F.lit(1)).alias("n"))
    weighed = spread.join(counts, F.col("key") == F.col("counted")).select("code", "key", "n")
    hubs = weighed.groupBy(F.col("code").alias("block")).agg(F.max(F.struct("n", "key")).alias("hub"))
    pairs = weighed.join(hubs, F.col("code") == F.col("block")).select(F.col("hub.key").alias("key_a"), F.col("key").alias("key_b"))
    return pairs.where("key_a != key_b").distinct()


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, groups: int = GROUPS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are maximal runs without blanks, A-Z lower-cased. A document's set holds its distinct n-grams of ``size``
    words; a shorter text is one n-gram, an empty or null one has no set and links with nothing. Documents link when
    100 * shared >= ``percent`` * union; component_id is the smallest id that links reach.
    Rows that share an id are linked with each other. A row without an id links with
    nothing and has no component. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    profile = materialize(spark, rows.mapInArrow(_profiler(size, groups), PROFILE), "jaccard-profile")
    sets = profile.where("part IS NULL")
    ranks = _rarity(profile)
    named = rows.where("doc_id IS NOT NULL")
    parcels = named.mapInArrow(_poster(size, percent, ranks, buckets(docs)), PARCEL)
    blocks = parcels.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_blocks, BLOCKS)
    blocks = materialize(spark, blocks, "jaccard-blocks")

    # Equal sets are one class, known by the least id.
    filled = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("point").alias("point")
    )
    classes = materialize(spark, classes, "jaccard-classes")
    side = lambda s: classes.select(*(F.col(c).alias(f"{n}_{s}") for c, n in (("key", "k"), ("rep", "rep"), ("n_shingles", "n"), ("point", "point"))))
    spread = blocks.mapInArrow(_spread, "code long, key long")
    own = materialize(
        spark,
        _stars(spread)
        .join(side("a"), F.col("key_a") == F.col("k_a"))
        .join(side("b"), F.col("key_b") == F.col("k_b"))
        .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"), "n_a", "n_b", "point_a", "point_b")
        .mapInArrow(_bounded(percent, groups), "a long, b long"),
        "jaccard-stars",
    )
    first = materialize(spark, _links(own, named, size, percent), "jaccard-links")
    labels = components(first, "jaccard-first")

    labelled = classes.join(labels, F.col("rep") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    members = spread.join(labelled.select("key", "component"), "key")
    mixed = members.repartition("code").sortWithinPartitions("code").mapInArrow(_several_components, "code long, key long")
    points = mixed.join(labelled.select("key", "rep", "component", "n_shingles", "point"), "key")
    pairs = points.repartition("code").sortWithinPartitions("code").mapInArrow(_search(percent, groups), "a long, b long")
    rest = materialize(spark, pairs.distinct().join(own, ["a", "b"], "left_anti"), "jaccard-rest")
    second = _links(rest, named, size, percent)
    # An id with several sets holds them together.
    repeated = filled.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high")
    bonds = filled.join(repeated.select("doc_id"), "doc_id", "left_semi").join(classes.select("key", "rep"), "key")
    bonds = bonds.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(first.unionByName(second).unionByName(bonds), "jaccard-components")

    whole = classes.select("key", "rep").join(final, F.col("rep") == F.col("node"), "left").select(
        F.col("key").alias("set_key"), F.coalesce("component", "rep").alias("component_id")
    )
    linked = filled.join(whole, F.col("key") == F.col("set_key")).select("doc_id", "n_shingles", "component_id")
    alone = sets.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that name their component, and rows without an id, with all their columns."""
    gone = jaccard_components(docs, size, percent).where("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s : s + 3], ' ')) AS code
  FROM texts, range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 2, 2) END) r(s)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_shared FROM shingles a JOIN shingles b ON a.code = b.code AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * n_shared >= 85 * (s.n + t.n - n_shared)),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM sides UNION SELECT reach.x, sides.y FROM reach JOIN sides ON sides.x = reach.y),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.x = doc_id
"""
