"""Removal of passages that earlier documents hold, by level-wise doubling of repeated windows.

Windows of a short length are compared first. Only where both ends of a longer window were found
repeated is the window of (at most) twice that length compared, and so on up to the length
asked for. What is compared is hashes, dealt by hash; texts move once, by document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import buckets, texts
from lendscope.llm.parcels import PARCEL, PARCEL_ARROW, owners, pack, runs
from lendscope.llm.wordhash import slices, text_buffers, windows, words

WINDOW = 13
#: The first level is the window's length, halved until it is no longer than this.
SHORTEST = 7
#: Windows of a task that are brought together before they are sent on.
HELD_WINDOWS = 3_000_000

#: What is known of a window of a document: it repeats, as its first place (REPEATED) or a later one (LATER).
REPEATED, LATER = 1, 2


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths from short to long, each at most twice the one before, the last being ``window``."""
    found = [window]
    while found[0] > shortest:
        found.insert(0, -(-found[0] // 2))
    return found


def judge(codes: np.ndarray, docs: np.ndarray, marks: np.ndarray | None = None):
    """Of (code, document) entries: distinct ones in order, each with its mark, 0 where no other document has the code."""
    order = np.lexsort((docs, codes))
    codes, docs = codes[order], docs[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1])
    starts = np.flatnonzero(fresh)
    merged = np.maximum.reduceat(marks[order], starts) if marks is not None and len(starts) else np.zeros(len(starts), np.uint8)
    codes, docs = codes[starts], docs[starts]
    heads = runs(codes)
    sizes = np.diff(np.append(heads, len(codes)))
    lone = np.repeat(sizes == 1, sizes)
    later = np.ones(len(codes), bool)
    later[heads] = False
    found = np.where(later, LATER, np.where(lone, 0, REPEATED)).astype(np.uint8)
    return codes, docs, np.maximum(found, merged)


class _Sender:
    """Gathers a task's windows; duplicates among them are settled before they are sent."""

    def __init__(self, width: int, count: int):
        self.width, self.count = width, count
        self.codes, self.docs, self.held = [], [], 0

    def add(self, codes: np.ndarray, docs: np.ndarray):
        self.codes.append(codes)
        self.docs.append(docs)
        self.held += len(codes)
        if self.held >= HELD_WINDOWS:
            yield from self.flush()

    def flush(self):
        if not self.held:
            return
        codes, docs, marks = judge(np.concatenate(self.codes), np.concatenate(self.docs))
        self.codes, self.docs, self.held = [], [], 0
        # The later places of a code are settled here; its first place must still hear from other tasks.
        kind = (marks == LATER).astype(np.int8)
        yield pack(self.bucket(codes), kind, docs, codes, marks, self.width)

    def bucket(self, codes: np.ndarray) -> np.ndarray:
        if self.width == 4:  # the lower half was kept as the code
            return (codes >> np.uint64(32)).astype(np.int64) % self.count
        return (codes >> np.uint64(40)).astype(np.int64) % self.count


def first_level(length: int, width: int, count: int):
    """A step from documents to parcels of all their windows of ``length`` words."""

    def step(batches):
        sender = _Sender(width, count)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            offsets, data = text_buffers(batch.column("text"))
            for at, end in slices(offsets):
                part = offsets[at : end + 1]
                found = words(part - part[0], data[part[0] : part[-1]], lower=False)
                place, hashes = windows(found.hashes, found.first, length)
                yield from sender.add(hashes, ids[at:end][found.owner[place]])
        yield from sender.flush()

    return step


def compare(width: int, last: bool, count: int):
    """A step over parcels sorted by bucket: the windows of each document that other documents hold too.

    At the last level only those that a document with a smaller id holds are told.
    """
    kind_of_code = np.uint32 if width == 4 else np.uint64
    least_mark = LATER if last else REPEATED

    def settle(parcels):
        """All parcels of one bucket at once."""
        docs = np.concatenate([owners(d, s) for d, s, *_ in parcels])
        codes = np.concatenate([np.frombuffer(c, kind_of_code) for _, _, c, _ in parcels])
        marks = np.concatenate([np.frombuffer(m, np.uint8) for *_, m in parcels])
        codes, docs, marks = judge(codes, docs, marks)
        return codes[marks >= least_mark], docs[marks >= least_mark]

    def rows(codes, docs):
        """Verdicts as parcels again, now for the buckets of their documents."""
        distinct, place = np.unique(docs, return_inverse=True)
        home = np.array([zlib.crc32(str(i).encode()) % count for i in distinct.tolist()], np.int64)[place]
        unmarked = np.zeros(len(codes), np.uint8)
        return pack(home, unmarked.astype(np.int8), docs, codes, unmarked, codes.dtype.itemsize)

    def step(batches):
        bucket, held, done, size = None, [], [], 0
        for batch in batches:
            columns = [batch.column(name) for name in ("bucket", "kind", "docs", "sizes", "codes", "marks")]
            for place in range(batch.num_rows):
                number, kind, *parcel = (column[place].as_py() for column in columns)
                if kind == 1:  # settled by the sender
                    done.append((np.frombuffer(parcel[2], kind_of_code), owners(parcel[0], parcel[1])))
                    size += len(done[-1][0])
                    continue
                if number != bucket and held:
                    done.append(settle(held))
                    size += len(done[-1][0])
                    held = []
                bucket = number
                held.append(parcel)
            if size >= HELD_WINDOWS:
                yield rows(*(np.concatenate(x) for x in zip(*done)))
                done, size = [], 0
        if held:
            done.append(settle(held))
        if sum(len(x[0]) for x in done):
            yield rows(*(np.concatenate(x) for x in zip(*done)))

    return step


def _verdicts(parcels: DataFrame, width: int, last: bool, count: int) -> DataFrame:
    """Parcels by the hash bucket of windows -> parcels of verdicts by the bucket of documents."""
    return parcels.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare(width, last, count), PARCEL)


def _told(parcels: pa.Table, width: int) -> dict[int, np.ndarray]:
    """The codes of each document that the parcels of its bucket name, in order."""
    kind_of_code = np.uint32 if width == 4 else np.uint64
    rows = list(zip(*(parcels.column(name).to_pylist() for name in ("docs", "sizes", "codes"))))
    if not rows:
        return {}
    docs = np.concatenate([owners(d, s) for d, s, _ in rows])
    codes = np.concatenate([np.frombuffer(c, kind_of_code) for *_, c in rows])
    order = np.lexsort((codes, docs))
    docs, codes = docs[order], codes[order]
    stops = np.append(runs(docs), len(docs)).tolist()
    return {int(docs[a]): codes[a:b] for a, b in zip(stops, stops[1:])}


def _documents(docs: pa.Table, told: dict[int, np.ndarray], length: int, width: int, every: bool):
    """For each document (of ``every`` bucket or only those that were told of): its row, its slice's words, its place there,
    and places and verdicts of its windows."""
    ids = docs.column("doc_id").to_pylist()
    if not every:
        docs = docs.filter(pa.array([i in told for i in ids], pa.bool_()))
        ids = docs.column("doc_id").to_pylist()
    offsets, data = text_buffers(docs.column("text"))
    for at, end in slices(offsets):
        part = offsets[at : end + 1]
        found = words(part - part[0], data[part[0] : part[-1]], lower=False)
        place, hashes = windows(found.hashes, found.first, length)
        codes = hashes.astype(np.uint32) if width == 4 else hashes
        bounds = np.searchsorted(place, found.first)
        for i in range(end - at):
            a, b = bounds[i], bounds[i + 1]
            known = told.get(ids[at + i])
            state = np.zeros(b - a, bool)
            if known is not None and b > a:
                state = known[np.minimum(np.searchsorted(known, codes[a:b]), len(known) - 1)] == codes[a:b]
            yield ids[at + i], found, i, place[a:b], state


def next_level(short: int, short_width: int, length: int, width: int, count: int):
    """A step from a bucket's documents and verdicts on shorter windows to parcels of the longer ones that may repeat."""

    def step(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        sender, made, last = _Sender(width, count), [], None
        for doc_id, found, i, place, state in _documents(docs, _told(verdicts, short_width), short, short_width, False):
            if found is not last:  # one pass over the windows of a slice
                long_place, long_hash = windows(found.hashes, found.first, length)
                bounds, last = np.searchsorted(long_place, found.first), found
            mine = long_hash[bounds[i] : bounds[i + 1]]
            if len(mine):
                shift = length - short
                alive = state[: len(mine)] & state[shift : shift + len(mine)]
                made += sender.add(mine[alive], np.full(int(alive.sum()), doc_id, np.int64))
        made += sender.flush()
        return pa.Table.from_batches(made, PARCEL_ARROW)

    return step


def _remover(window: int, width: int):
    """A step from a bucket's documents and verdicts to what is left of the documents."""

    def step(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        out = []
        for doc_id, found, i, place, state in _documents(docs, _told(verdicts, width), window, width, True):
            a, b = int(found.first[i]), int(found.first[i + 1])
            depth = np.zeros(b - a + 1, np.int64)
            later = place[state] - a
            np.add.at(depth, later, 1)
            np.add.at(depth, np.minimum(later + window, b - a), -1)
            gone = np.cumsum(depth[:-1]) > 0
            text = found.data
            kept = b" ".join(
                text[s:e].tobytes() for s, e in zip(found.starts[a:b][~gone].tolist(), found.ends[a:b][~gone].tolist())
            )
            out.append((doc_id, b - a, int(gone.sum()), kept.decode()))
        columns = list(zip(*out)) if out else [[]] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], ["doc_id", "n_words", "n_removed", "kept_text"])

    return step


def _untouched(batches):
    """Documents that take no part in the comparison, as they are."""
    step = _remover(1, 8)
    for batch in batches:
        yield from step(pa.Table.from_batches([batch]), PARCEL_ARROW.empty_table()).to_batches()


def remove_repeated(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text.

    Words are maximal runs without blanks, unchanged. A word goes when a window of
    ``window`` words that covers it also starts in a document with a smaller id; windows are judged on the input.
    Kept words are joined by one space. Null and empty texts have no words; rows that share an id
    count as one document when windows are compared; a row without an id is
    never compared and keeps its text. An empty table gives an empty result.

    Each level's windows are dealt to hash buckets whose number follows the input, packed by task and bucket, and what is found
    goes to the buckets of documents, packed likewise, where a bucket holds a few megabytes of text. A
    passage that a third of all documents share costs a task one entry to compare;
    its other places are settled where they are met. Levels below the last carry
    half hashes, which may keep a window too many alive but lose none.
    """
    rows = texts(docs)
    count = buckets(docs)
    home = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(count)).cast("int")
    named = rows.where("doc_id IS NOT NULL").withColumn("bucket", home)
    lengths = levels(window, shortest)
    widths = [4] * (len(lengths) - 1) + [8]
    parcels = named.select("doc_id", "text").mapInArrow(first_level(lengths[0], widths[0], count), PARCEL)
    verdicts = _verdicts(parcels, widths[0], len(lengths) == 1, count)
    # The same exchange of texts by bucket serves every level below and the removal itself.
    meet = lambda step, schema: named.groupBy("bucket").cogroup(verdicts.groupBy("bucket")).applyInArrow(step, schema)
    for place in range(1, len(lengths)):
        step = next_level(lengths[place - 1], widths[place - 1], lengths[place], widths[place], count)
        verdicts = _verdicts(meet(step, PARCEL), widths[place], place == len(lengths) - 1, count)
    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    nameless = rows.where("doc_id IS NULL").mapInArrow(_untouched, schema)
    return meet(_remover(window, widths[-1]), schema).unionByName(nameless)


SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 12], ' ')) AS code FROM texts, range(1, len(w) - 11) r(s)),
least AS (SELECT code, min(doc_id) AS first FROM windows GROUP BY code),
repeated AS (SELECT doc_id, s FROM windows JOIN least USING (code) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM repeated, range(13) r(o)),
words AS (SELECT doc_id, p, w[p] AS word FROM texts, range(1, len(w) + 1) r(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
