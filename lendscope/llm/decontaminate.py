"""Benchmark passages in documents: pigeonhole search for exact pieces, verified by bit-parallel edit distance.

An item that may differ by k edits is cut into k + 1 pieces, one of which must stand in the document
unchanged. All pieces of a block of items are sought at once with an Aho-Corasick
automaton; around each hit, Myers' bit-parallel algorithm finds the least edit distance between
the whole item and any part of the document there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lendscope.llm.common import texts

#: Edits allowed, as a part of an item's characters.
MAX_ERROR = 0.08
#: Below so many characters an item is short. Short ones are sought like all others; it is no limit of the search.
SHORTEST_ITEM = 40
#: Items go through the documents in blocks of so many characters, whose automaton every task can hold.
BLOCK_CHARS = 1 << 19

HITS = "doc_id long, item_id long, distance long, start long, end long"


_BLANK = re.compile(r"\s")
_BLANKS = re.compile(r"  +")
# Scripts without blanks between words: Thai to Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def _flat(text: str | None) -> str:
    """Lower case with every blank as a space, character for character."""
    text = text or ""
    plain = text.lower()
    if len(plain) != len(text):  # a few characters have longer lower-case forms and stay as they are
        plain = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    return _BLANK.sub(" ", plain)


def normalised(text: str | None) -> str:
    """Lower case with single spaces between words."""
    return _BLANKS.sub(" ", _flat(text)).strip(" ")


def places(text: str) -> list[int]:
    """Where each character of the normal form stood in the text."""
    flat = _flat(text)
    kept = [place for place, char in enumerate(flat) if char != " " or (place and flat[place - 1] != " ")]
    return kept


def pieces(item: str, budget: int) -> Iterator[tuple[int, str]]:
    """``budget`` + 1 pieces of about equal length, with their places in the item."""
    count = budget + 1
    for number in range(count):
        start, end = number * len(item) // count, (number + 1) * len(item) // count
        yield start, item[start:end]


class Pattern:
    """Myers' vectors of one item."""

    def __init__(self, item: str):
        self.length = len(item)
        self.masks: dict[str, int] = {}
        for place, char in enumerate(item):
            self.masks[char] = self.masks.get(char, 0) | 1 << place

    def best_end(self, text: str, anywhere: bool = True) -> tuple[int, int]:
        """(least distance of the item to a part of ``text``, where that part ends); parts start anywhere, or at 0."""
        full = (1 << self.length) - 1
        top = 1 << (self.length - 1)
        up, down, distance = full, 0, self.length
        best, end = distance, 0
        masks = self.masks
        for place, char in enumerate(text, 1):
            equal = masks.get(char, 0)
            vertical = equal | down
            horizontal = (((equal & up) + up) ^ up) | equal
            plus = down | ~(horizontal | up) & full
            minus = up & horizontal
            if plus & top:
                distance += 1
            elif minus & top:
                distance -= 1
            plus = (plus << 1 | (not anywhere)) & full
            minus = (minus << 1) & full
            up = minus | ~(vertical | plus) & full
            down = plus & vertical
            if distance < best:
                best, end = distance, place
        return best, end


def _in_word(text: str, place: int) -> bool:
    """Whether a word of a script with blanks between words goes on across ``place``."""
    if not 0 < place < len(text):
        return False
    pair = text[place - 1 : place + 1]
    return all(c.isalnum() and not _UNSPACED.match(c) for c in pair)


class Finder:
    """Searches documents for a block of items."""

    def __init__(self, items: list[tuple[int, str]], max_error: float):
        import ahocorasick

        self.items, found = [], {}
        for item_id, text in items:
            budget = int(max_error * len(text))
            number = len(self.items)
            self.items.append((item_id, text, budget))
            for start, piece in pieces(text, budget):
                found.setdefault(piece, []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the nearest occurrence of every item that the text holds."""
        around: dict[int, set[int]] = {}
        whole: set[int] = set()
        for last, (length, owners) in self.automaton.iter(text):
            begin = last + 1 - length
            for number, start in owners:
                item_id, _, budget = self.items[number]
                if budget:
                    around.setdefault(number, set()).add(begin - start)
                # An item that may not differ is its only piece; it must not be a part of longer words.
                elif number not in whole and not _in_word(text, begin) and not _in_word(text, last + 1):
                    whole.add(number)
                    yield item_id, 0, begin, last + 1
        for number, origins in around.items():
            item_id, item, budget = self.items[number]
            if number not in self.patterns:
                self.patterns[number] = Pattern(item), Pattern(item[::-1])
            forward, backward = self.patterns[number]
            best = None
            reach = -len(item) - budget - 1
            for origin in sorted(origins):
                # Hits of one occurrence lie within the budget of each other and share one stretch of text.
                if origin <= reach:
                    continue
                low = max(0, origin - budget)
                reach = origin + budget
                part = text[low : reach + len(item) + 2 * budget]
                distance, end = forward.best_end(part)
                if distance <= budget and (best is None or distance < best[0]):
                    best = distance, low, end, part
            if best:
                distance, low, end, part = best
                _, size = backward.best_end(part[:end][::-1], anywhere=False)
                yield item_id, distance, low + end - size, low + end


def _searcher(items: list[tuple[int, str]], max_error: float):
    def step(batches):
        finder = Finder(items, max_error)
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                plain, stood = normalised(text), None
                for item_id, distance, start, end in finder.search(plain):
                    if len(plain) != len(text):
                        stood = stood or places(text)
                        start, end = stood[start], stood[end - 1] + 1
                    rows.append((doc_id, item_id, distance, start, end))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "start", "end"]
            )

    return step


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Items in normal form, as blocks of bounded size; the driver holds one block at a time."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        item = normalised(row["text"])
        if item:
            held.append((row["item_id"], item))
            size += len(item)
            if size >= block_chars:
                yield held
                held, size = [], 0
    if held:
        yield held


def contaminations(
    docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, distance, start, end.

    The whole item must stand in the document with at most ``max_error`` of its characters edited, letter case and
    blanks apart. An item too short for a single edit must stand there as it is, between ends of words where its script has them.
    start and end are code points of the document's text, of the nearest occurrence.
    Documents without a hit have no row. Null
    and empty texts hold nothing; null and empty items are not sought; repeated rows and ids count each by themselves. Empty tables give an empty result.

    The benchmark is the stated set of queries: it passes in blocks of bounded size, each of which every
    document meets in its own task, so nothing is shuffled and no group of documents is gathered.
    """
    rows = texts(docs)
    found = None
    for block in item_blocks(benchmark, block_chars):
        hits = rows.mapInArrow(_searcher(block, max_error), HITS)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else docs.sparkSession.createDataFrame([], HITS)


def _keeper(items: list[tuple[int, str]], max_error: float):
    def step(batches):
        finder = Finder(items, max_error)
        for batch in batches:
            clean = [next(finder.search(normalised(text)), None) is None for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return step


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; each row is judged where it lies."""
    for block in item_blocks(benchmark, block_chars):
        docs = docs.mapInArrow(_keeper(block, max_error), docs.schema)
    return docs
