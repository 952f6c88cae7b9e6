"""A stored inverted index of a corpus, kept up from changed documents, and exact BM25 search by upper bounds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lendscope.operators.commits import CommitLog, Conflict
from lendscope.operators.latest import ranked
from lendscope.operators.search import LENGTH_WEIGHT, MAX_HITS, MAX_QUERY_WORDS, SATURATION, SCORE_DIGITS, words
from lendscope.session import materialize

#: Documents of one range: a posting list is cut by ranges, and each piece has its own bound.
RANGE_BITS = 8
#: Ranges that a query reads before it has a threshold, the one with the largest bound.
FIRST_RANGES = 1
#: Segments that are merged into one when a refresh finds as many.
MERGE_AT = 16
#: Refreshes that start again because another one was faster, before they give up.
ATTEMPTS = 5
#: Words of queries that are sought at a time: what a task and the driver hold of them.
ASKED_WORDS = 200_000
#: Changed keys and masks of ranges that are sent to every task, at most.
MAX_KEYS = 1_000_000
MAX_MASKS = 200_000
#: Hits that a task holds before it sends them on.
HITS_HELD = 1_000_000
#: What rounding a score may have added.
SLACK = 10.0**-SCORE_DIGITS

_PLACE = ["segment", "place"]
_POSTED = ["range", "word", "n", "most_times", "least_size", "least_times", "most_size", "entries"]
_ENTRIES = "array<struct<offset: smallint, size: int, times: int>>"
_POSTINGS = f"range long, word string, n int, most_times int, least_size int, least_times int, most_size int, entries {_ENTRIES}"


def _mark(columns: list[str]) -> Column:
    """A hash that changes with the document; NULLs are told from empty values."""
    return F.xxhash64(*(F.struct(F.col(name).isNull(), F.col(name)) for name in columns))


def _offset(place: str) -> Column:
    """A document's place within its range."""
    return F.col(place).bitwiseAND(F.lit((1 << RANGE_BITS) - 1)).cast("short")


def _place(number: str) -> Column:
    """The place of an entry, which has its offset, in a range."""
    return F.shiftleft(number, RANGE_BITS) + F.col("offset")


def _runs(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that cuts sorted batches into runs of equal values of the named columns, one batch each."""

    # Kept inside, like the steps below, so that they travel to the workers by value.
    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in names])
            borders = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *borders], [*borders, batch.num_rows]):
                if parts and tuple(values[:, start]) != last:
                    yield whole(parts)
                    parts = []
                last = tuple(values[:, start])
                parts.append(batch.slice(start, end - start))
        if parts:
            yield whole(parts)

    return runs


def _splitter(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch function that makes the postings of each range of documents, and a row without a word that lists the documents."""
    runs = _runs(["range"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = schema.field("docs").type.value_type
        entry = schema.field("entries").type.value_type
        for rows in runs(batches):
            lists = rows.column("words")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
            found = lists.flatten().dictionary_encode()
            held = [sizes if field.name == "size" else rows.column(field.name) for field in listed]
            docs = pa.StructArray.from_arrays([pa.array(values, field.type) for values, field in zip(held, listed)], fields=list(listed))
            # Every word of the dictionary occurs, so the pairs of word and document are in the order of the words.
            pairs = found.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sizes) + np.repeat(np.arange(len(sizes)), sizes)
            pairs, times = np.unique(pairs, return_counts=True)
            code, doc = np.divmod(pairs, len(sizes))
            starts = np.flatnonzero(np.diff(code, prepend=-1))
            ends, size, times = [*starts, len(pairs)], sizes[doc], times.astype(np.int32)
            place = rows.column("place").to_numpy(zero_copy_only=False)
            offset = (place - place[0] + rows.column("offset")[0].as_py()).astype(np.int16)[doc]
            n_words, none = len(starts), pa.nulls(1)
            most = (lambda values: np.maximum.reduceat(values, starts)) if n_words else (lambda values: values)
            least = (lambda values: np.minimum.reduceat(values, starts)) if n_words else (lambda values: values)
            numbers = np.diff(ends), most(times), least(size), least(times), most(size)
            alone = np.arange(n_words + 1) < n_words
            entries = pa.StructArray.from_arrays([offset, size, times], fields=list(entry))
            columns = [
                pa.array(np.full(n_words + 1, rows.column("range")[0].as_py())),
                pa.concat_arrays([found.dictionary.cast(schema.field("word").type), none.cast(schema.field("word").type)]),
                *(pa.array(np.append(values, 0).astype(np.int32), mask=~alone) for values in numbers),
                pa.ListArray.from_arrays(pa.array([*ends, len(pairs)], pa.int32()), entries, type=schema.field("entries").type, mask=pa.array(~alone)),
                pa.ListArray.from_arrays(pa.array([0] * (n_words + 1) + [len(sizes)], pa.int32()), docs, type=schema.field("docs").type, mask=pa.array(alone)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return split


class _Asked:
    """The queries of one portion as arrays: which queries ask for a word, how often, and how rare it is."""

    def __init__(self, rows: list, weights: list, known: dict):
        self.ids = sorted({row["query_id"] for row in rows})
        number = {query_id: place for place, query_id in enumerate(self.ids)}
        rare = {row["word"]: row for row in weights}
        wanted = sorted((row["word"], number[row["query_id"]], row["times"]) for row in rows if row["word"] in rare)
        self.words = sorted({word for word, *_ in wanted})
        code = {word: place for place, word in enumerate(self.words)}
        self.rarity = np.array([rare[word]["rarity"] for word in self.words], dtype=np.float64)
        self.query = np.array([query for _, query, _ in wanted], dtype=np.int64)
        self.times = np.array([times for *_, times in wanted], dtype=np.float64)
        self.start = np.searchsorted(np.array([code[word] for word, *_ in wanted], dtype=np.int64), np.arange(len(self.words) + 1))
        #: A score that ``k`` documents of the query reach.
        self.least = np.array([known.get(query_id, -np.inf) for query_id in self.ids], dtype=np.float64)
        for word, query, _ in wanted:
            if rare[word]["least"] is not None:
                self.least[query] = max(self.least[query], rare[word]["least"])


def _scorer(asked: _Asked, mean: float, k: int, bits: int, most_held: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch function over the pieces of ranges: exact scores of the documents that can be among a query's ``k`` best."""
    runs = _runs(["segment", "range"])
    vocabulary, rarity, asking, often, start = asked.words, asked.rarity, asked.query, asked.times, asked.start
    threshold, slack, saturation, length_weight = asked.least, SLACK, SATURATION, LENGTH_WEIGHT

    def weight(rare, times, size):
        return rare * times * (saturation + 1) / (times + saturation * (1 - length_weight + length_weight * size / mean))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, held, n_held = threshold.copy(), [], 0
        best = np.full((len(reached), k), -np.inf)

        def sent() -> Iterator[pa.RecordBatch]:
            for query, segment, place, score in held:
                kept = score >= reached[query] - slack
                yield pa.RecordBatch.from_pydict(
                    {
                        "_query": query[kept], "segment": np.full(kept.sum(), segment), "place": place[kept], "_sum": score[kept]
                    }
                )

        words_asked = pa.array(vocabulary, pa.string())
        for rows in runs(frames):
            segment, number = (rows.column(name)[0].as_py() for name in ("segment", "range"))
            code = pc.index_in(rows.column("word").cast(pa.string()), value_set=words_asked).to_numpy(zero_copy_only=False).astype(np.int64)
            number_of = start[code + 1] - start[code]
            piece = np.repeat(np.arange(len(code)), number_of)
            pair = np.arange(len(piece)) - np.repeat(np.cumsum(number_of) - number_of, number_of) + start[code][piece]
            most_times, least_size = (rows.column(name).to_numpy(zero_copy_only=False) for name in ("most_times", "least_size"))
            bound = weight(rarity[code], most_times, least_size)
            reach = np.bincount(asking[pair], weights=bound[piece] * often[pair], minlength=len(reached))
            wanted = np.zeros(len(reached), dtype=bool)
            wanted[asking[pair]] = True
            wanted &= reach + slack >= reached
            used = wanted[asking[pair]]
            piece, pair = piece[used], pair[used]
            if not len(pair):
                continue
            lists = rows.column("entries")
            entries, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            offset, size, times = (entries.field(name).to_numpy(zero_copy_only=False) for name in ("offset", "size", "times"))
            of = np.repeat(np.arange(len(code)), n)
            matrix = np.zeros((len(code), 1 << bits))
            matrix[of, offset] = weight(rarity[code][of], times, size)
            order = np.argsort(asking[pair], kind="stable")
            piece, pair = piece[order], pair[order]
            queries, first = np.unique(asking[pair], return_index=True)
            # So many queries at a time that what is gathered for them stays small.
            cuts = np.flatnonzero(np.diff(first // 16384, prepend=-1))
            for low, high in zip(cuts, [*cuts[1:], len(queries)]):
                begin, end = first[low], first[high] if high < len(queries) else len(pair)
                some = slice(begin, end)
                scores = np.add.reduceat(matrix[piece[some]] * often[pair[some], None], first[low:high] - begin, axis=0)
                mine = queries[low:high]
                shown = np.where(scores > 0, scores, -np.inf)
                best[mine] = np.partition(np.concatenate([best[mine], shown], axis=1), -k, axis=1)[:, -k:]
                reached[mine] = np.maximum(reached[mine], best[mine].min(axis=1))
                row, at = np.nonzero(shown >= np.maximum(reached[mine] - slack, np.finfo(float).tiny)[:, None])
                if len(row):
                    held.append((mine[row], segment, at + (number << bits), scores[row, at]))
                    n_held += len(row)
            if n_held > most_held:
                yield from sent()
                held, n_held = [], 0
        yield from sent()

    return batches


class WordIndex:
    """Posting lists of a corpus below ``base``, written in segments that never change.

    A segment holds what one refresh found new: ``documents`` (key, place, size, mark, attributes), ``postings`` (word, range, n,
    most_times, least_size, least_times, most_size, entries; and a row without a word for each range, that lists its documents),
    ``gone`` (the places in earlier segments that it replaces or removes) and ``counts`` (changes of the number of documents and of
    words). The texts are not kept. An entry has the document's place in its range, which is the one number that makes it small. A
    segment is read only after its entry in the log is written; runs that died leave nothing that is read, and a refresh that another
    one has overtaken starts again from the newer state. The key must identify a document and not be NULL.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, attributes: tuple[str, ...] = ()):
        self.spark = spark
        self.base = base.rstrip("/")
        self.key = key
        self.attributes = tuple(attributes)
        self.log = CommitLog(spark, f"{self.base}/log", "path string, base boolean, n_gone long")
        self._live: list[dict] | None = None
        self._frames: dict[str, DataFrame | None] = {}

    # --- segments ---

    def segments(self, again: bool = False) -> list[dict]:
        """The live segments (number, path, base) in order: the newest that holds a whole corpus, and those after it.

        One object reads one state; ``again`` looks for a newer one.
        """
        if self._live is None or again:
            rows = self.log.entries()
            start = max((place for place, row in enumerate(rows) if row["base"]), default=0)
            self._live, self._frames = rows[start:], {}
        return self._live

    def _read(self, table: str) -> DataFrame | None:
        segments = self.segments()
        if table not in self._frames:
            paths = [(row["number"], f"{self.base}/{row['path']}/{table}") for row in segments]
            parts = [self.spark.read.parquet(path).withColumn("segment", F.lit(number).cast("long")) for number, path in paths]
            self._frames[table] = reduce(DataFrame.unionByName, parts) if parts else None
        return self._frames[table]

    def _gone(self) -> DataFrame:
        """(segment, place) of documents that a later segment replaced or removed."""
        return self._read("gone").select(F.col("old_segment").alias("segment"), "place")

    def documents(self) -> DataFrame:
        """The live documents: segment, place, key, size, mark and attributes."""
        return self._read("documents").join(self._gone(), _PLACE, "left_anti")

    # --- writing ---

    def refresh(self, corpus: DataFrame, text: str) -> int:
        """Bring the index up to ``corpus``; the number of documents that were split into words.

        Documents are compared by the hash of their text and attributes. Only new and changed ones are split into words;
        those that are no longer delivered go. Without any change nothing is written.
        """

        def differences() -> tuple[DataFrame, DataFrame]:
            now = corpus.select(self.key, _mark([text, *self.attributes]).alias("_now"))
            stored = self.documents().select(F.col(self.key).alias("_key"), "mark", *_PLACE)
            both = now.join(stored, F.col(self.key) == F.col("_key"), "full").where(~F.col("_now").eqNullSafe(F.col("mark")))
            different = materialize(self.spark, both, "index-changes")
            keys = different.where("_now IS NOT NULL").select(self.key)
            # A bounded number of keys is sent to the corpus, so that no text moves.
            changed = corpus.join(F.broadcast(keys) if keys.count() <= MAX_KEYS else keys, self.key, "left_semi")
            return changed, different.where("mark IS NOT NULL").select(*_PLACE)

        return self._bring(corpus, text, differences)

    def update(self, changed: DataFrame, removed: DataFrame, text: str) -> int:
        """As ``refresh``, from the changed documents and the keys of the removed ones alone, without reading the corpus."""

        def differences() -> tuple[DataFrame, DataFrame]:
            touched = changed.select(self.key).unionByName(removed.select(self.key)).distinct()
            return changed, self.documents().join(touched, self.key, "left_semi").select(*_PLACE)

        return self._bring(changed, text, differences)

    def _bring(self, everything: DataFrame, text: str, differences) -> int:
        for _ in range(ATTEMPTS):
            live = self.segments(again=True)
            changed, gone = differences() if live else (everything, self.spark.createDataFrame([], "segment long, place long"))
            watched = [text, *self.attributes]
            rows = changed.select(
                self.key, *self.attributes, _mark(watched).alias("mark"), words(F.coalesce(text, F.lit(""))).alias("words")
            )
            path, added, lost = self._write(rows, gone)
            if live and not added and not lost:
                return 0
            if self._publish(path, not live, lost):
                if len(self.segments()) >= MERGE_AT:
                    self.merge()
                return added
        raise Conflict(f"{self.base} changed {ATTEMPTS} times while it was refreshed")

    def merge(self) -> bool:
        """One segment of all live documents, from their stored postings: no text is read. False if a refresh was faster."""
        renamed = self.documents().withColumnsRenamed({name: f"old_{name}" for name in _PLACE})
        # Written, so that a document's new place is the same for all of it.
        moved = materialize(self.spark, renamed.select("*", F.monotonically_increasing_id().alias("place")), "index-moved")
        old = self._read("postings").select("segment", "range", "word", F.inline("entries"))
        old = old.select("word", "size", "times", F.col("segment").alias("old_segment"), _place("range").alias("old_place"))
        old = old.join(moved.select("old_segment", "old_place", "place"), ["old_segment", "old_place"])
        # A group has at most as many entries as a range has documents, however frequent its word is.
        entry = F.struct(_offset("place").alias("offset"), "size", "times")
        pieces = old.groupBy(F.shiftright("place", RANGE_BITS).alias("range"), "word").agg(
            F.count(F.lit(1)).cast("int").alias("n"),
            F.max("times").alias("most_times"),
            F.min("size").alias("least_size"),
            F.min("times").alias("least_times"),
            F.max("size").alias("most_size"),
            F.sort_array(F.collect_list(entry)).alias("entries"),
        )
        listed = self._listed(moved.schema)
        docs = moved.groupBy(F.shiftright("place", RANGE_BITS).alias("range")).agg(F.collect_list(F.struct(*listed.names)).alias("docs"))
        path, *_ = self._store(pieces.unionByName(docs, allowMissingColumns=True).select(*_POSTED, "docs"), None)
        return self._publish(path, True, 0)

    def _publish(self, path: str, base: bool, n_gone: int) -> bool:
        after = self._live[-1]["number"] if self._live else 0
        done = self.log.commit(after + 1, path=path, base=base, n_gone=n_gone)
        self.segments(again=True)
        return done

    def _listed(self, schema: T.StructType) -> T.StructType:
        """What a segment keeps of a document, in the types that the documents come with."""
        own = [T.StructField("size", T.IntegerType())]
        return T.StructType([schema["place"], *own, *(T.StructField(name, schema[name].dataType) for name in (self.key, *self.attributes, "mark"))])

    def _write(self, rows: DataFrame, gone: DataFrame | None) -> tuple[str, int, int]:
        """A segment of documents (key, attributes, mark, words), not published yet: its path, documents, and how many it replaces.

        ``gone`` is None for a segment that stands for itself. The documents of a range lie together in a task, which makes their
        postings: no word is shuffled.
        """
        placed = rows.select("*", F.monotonically_increasing_id().alias("place"))
        placed = placed.select("*", F.shiftright("place", RANGE_BITS).alias("range"), _offset("place").alias("offset"))
        listed = T.StructField("docs", T.ArrayType(self._listed(placed.schema)))
        schema = T.StructType([*T.StructType.fromDDL(_POSTINGS).fields, listed])
        return self._store(placed.mapInArrow(_splitter(to_arrow_schema(schema)), schema), gone)

    def _store(self, pieces: DataFrame, gone: DataFrame | None) -> tuple[str, int, int]:
        path = f"segments/{uuid.uuid4().hex}"
        here = f"{self.base}/{path}"
        # Written before anything is derived, so that a document's place is the same for all of it.
        pieces.write.option("compression", "zstd").parquet(f"{here}/postings")
        kept = self.spark.read.parquet(f"{here}/postings").where("word IS NULL").select(F.inline("docs"))
        kept.write.parquet(f"{here}/documents")
        none = self.spark.createDataFrame([], "segment long, place long")
        (none if gone is None else gone).select(F.col("segment").alias("old_segment"), "place").write.parquet(f"{here}/gone")
        docs, left = (self.spark.read.parquet(f"{here}/{name}") for name in ("documents", "gone"))
        totals = F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("size"), F.lit(0)).alias("n_words")
        (n_docs, n_words), n_gone = docs.agg(*totals).first(), left.count()
        if not n_docs and not n_gone and gone is not None and self.segments():
            return path, 0, 0
        lost = 0, 0
        if n_gone:
            lost = self._read("documents").join(left.withColumnRenamed("old_segment", "segment"), _PLACE, "left_semi").agg(*totals).first()
        counts = self.spark.createDataFrame([(n_docs - lost[0], n_words - lost[1])], "docs long, n_words long")
        counts.write.parquet(f"{here}/counts")
        return path, n_docs, n_gone

    # --- searching ---

    def _within(self, pieces: DataFrame, places: DataFrame, inside: bool) -> DataFrame:
        """The pieces with those of their entries that are at the given (segment, place), or at none of them; none is left empty."""
        bits = [F.bit_or(F.when(F.col("_at") == block, F.expr("shiftleft(1L, _bit)")).otherwise(F.lit(0))) for block in range(max(1, (1 << RANGE_BITS) >> 6))]
        offset = _offset("place").cast("int")
        marked = places.select("segment", F.shiftright("place", RANGE_BITS).alias("range"), F.shiftright(offset, 6).alias("_at"), offset.bitwiseAND(63).alias("_bit"))
        masks = materialize(self.spark, marked.groupBy("segment", "range").agg(F.array(*bits).alias("_mask")), "index-masks")
        if masks.count() <= MAX_MASKS:
            masks = F.broadcast(masks)
        met = F.expr(f"filter(entries, e -> (shiftright(_mask[shiftright(int(e.offset), 6)], int(e.offset) & 63) & 1L) = {int(inside)})")
        if inside:
            joined = pieces.join(masks, ["segment", "range"]).withColumn("entries", met)
        else:
            joined = pieces.join(masks, ["segment", "range"], "left").withColumn("entries", F.when(F.col("_mask").isNull(), F.col("entries")).otherwise(met))
        return joined.withColumn("n", F.size("entries")).where("n > 0").select(*pieces.columns)

    def scored(self, queries: DataFrame, k: int, where: Column | None = None) -> DataFrame:
        """(query_id, segment, place, score) of the documents that can be among each query's ``k`` best.

        The pieces of the posting lists of all query words are taken out of the index once. Every piece knows its most and least
        frequent entries and its shortest and longest documents, which bound what its word adds to a score. ``k`` documents that
        hold one word score its lower bounds at least: a first threshold, which needs no entry. The query's range with the largest
        sum of upper bounds gives a better one; then the ranges whose sum reaches that, or the ``k`` best that the task has
        found so far, are scored. With ``where``, a condition on the attributes, no other document is scored at all.
        Queries are taken in portions of a bounded number of words, which are sent to every task.
        """
        spark = self.spark
        asked = queries.where("query_id IS NOT NULL").select("query_id", F.explode(F.array_distinct(words(F.col("query")))).alias("word"))
        # A query that comes several times asks several times for its words.
        asked = materialize(spark, asked.groupBy("query_id", "word").agg(F.count(F.lit(1)).alias("times")), "index-asked")
        n_words = asked.count()
        vocabulary = asked.select("word").distinct()
        pieces = self._read("postings").select("segment", *_POSTED)
        pieces = pieces.join(F.broadcast(vocabulary) if n_words <= MAX_QUERY_WORDS else vocabulary, "word", "left_semi")
        if any(row["n_gone"] for row in self.segments()):
            pieces = self._within(pieces, self._gone(), False)
        pieces = materialize(spark, pieces, "index-pieces")
        whole = self._read("counts").agg(F.sum("docs").alias("docs"), F.sum("n_words").alias("n_words")).first()
        mean = whole["n_words"] / whole["docs"] if whole["docs"] else 1.0
        holding = F.sum("n").alias("_holding")
        rarity = F.log(F.lit(1.0) + (F.lit(whole["docs"]) - F.col("_holding") + 0.5) / (F.col("_holding") + 0.5))
        weights = materialize(spark, pieces.groupBy("word").agg(holding).select("word", rarity.alias("rarity")), "index-weights")

        def weight(times: str, size: str) -> Column:
            length = F.lit(1 - LENGTH_WEIGHT) + F.lit(LENGTH_WEIGHT) * F.col(size) / F.lit(mean)
            return F.col("rarity") * F.col(times) * (SATURATION + 1) / (F.col(times) + SATURATION * length)

        known = ["segment", "range", "word", "n"]
        heads = pieces.select(*known, "most_times", "least_size", "least_times", "most_size").join(weights, "word")
        heads = heads.select(*known, weight("most_times", "least_size").alias("bound"), weight("least_times", "most_size").alias("floor"))
        if where is None:
            falling = [F.desc("floor"), F.asc("segment"), F.asc("range")]
            # A piece has an entry at least, so the first ``k`` of a word are enough.
            first = ranked(heads, ["word"], falling, k, "_n")
            held = first.withColumn("_held", F.sum("n").over(Window.partitionBy("word").orderBy(*falling)))
            held = held.where(F.col("_held") >= k).groupBy("word").agg(F.max("floor").alias("least"))
            weights = materialize(spark, weights.join(held, "word", "left"), "index-weights")
        else:
            weights = weights.withColumn("least", F.lit(None).cast("double"))
            pieces = self._within(pieces, self.documents().where(where), True)
        portions = -(-max(n_words, 1) // ASKED_WORDS)
        parts = []
        for portion in range(portions):
            mine = asked if portions == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(portions)) == portion)
            parts.append(self._scored(mine, pieces, heads, weights, mean, k, portions > 1))
        return reduce(DataFrame.unionByName, parts)

    def _scored(self, asked: DataFrame, pieces: DataFrame, heads: DataFrame, weights: DataFrame, mean: float, k: int, some: bool) -> DataFrame:
        """``scored`` for a portion of the queries."""
        spark, here = self.spark, ["segment", "range"]
        own = F.broadcast(asked.select("word").distinct())
        if some:
            pieces, weights = pieces.join(own, "word", "left_semi"), weights.join(own, "word", "left_semi")
        rows, rare = asked.collect(), weights.collect()
        name = asked.schema["query_id"]

        def scores(chosen: DataFrame, known: dict) -> DataFrame:
            dealt = chosen.repartition(*here).sortWithinPartitions(*here).select(*here, "word", "most_times", "least_size", "entries")
            held = _Asked(rows, rare, known)
            found = dealt.mapInArrow(_scorer(held, mean, k, RANGE_BITS, HITS_HELD), "_query long, segment long, place long, _sum double")
            ids = spark.createDataFrame(list(enumerate(held.ids)), T.StructType([T.StructField("_query", T.LongType()), name]))
            score = F.round("_sum", SCORE_DIGITS).alias("score")
            return found.join(F.broadcast(ids), "_query").select("query_id", *_PLACE, score)

        reach = heads.join(F.broadcast(asked), "word").groupBy("query_id", *here).agg(F.sum(F.col("bound") * F.col("times")).alias("reach"))
        tops = ranked(reach, ["query_id"], [F.desc("reach"), F.asc("segment"), F.asc("range")], FIRST_RANGES).select(*here).distinct()
        first = scores(pieces.join(F.broadcast(tops), here, "left_semi"), {})
        kth = ranked(first, ["query_id"], [F.desc("score")], k).groupBy("query_id")
        kth = kth.agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
        return scores(pieces, {row["query_id"]: row["score"] - SLACK for row in kth.collect()})

    def best(self, queries: DataFrame, k: int, where: Column | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
        """The ``k`` best documents per query (query_id, query): query_id, rank, key, score and the chosen attributes.

        Scores, ties and rounding are those of `operators.search.bm25` over the corpus.
        """
        if not self.segments():
            raise ValueError("the index holds no corpus yet: call refresh first")
        scored = self.scored(queries, k, where)
        # All that tie with the last one stay until their keys are known.
        order = Window.partitionBy("query_id").orderBy(F.desc("score"))
        few = materialize(self.spark, scored.withColumn("_n", F.rank().over(order)).where(F.col("_n") <= k).drop("_n"), "index-hits")
        named = self._read("documents").select(*_PLACE, self.key, *columns)
        hits = named.join(F.broadcast(few) if few.count() <= MAX_HITS else few, _PLACE)
        return ranked(hits, ["query_id"], [F.desc("score"), F.asc(self.key)], k).select("query_id", "rank", self.key, "score", *columns)


def where_any(filters: dict[str, list] | None) -> Column | None:
    """A condition: every attribute has one of its given values, of which None stands for NULL."""
    where = None
    for name, values in (filters or {}).items():
        met = F.col(name).isin([value for value in values if value is not None])
        met = met | F.col(name).isNull() if None in values else met
        where = met if where is None else where & met
    return where
