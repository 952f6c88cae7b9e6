"""Records of JSON files whose values run over many lines, found by a scan that holds one record at a time."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of one record; what is longer counts as broken. Beyond it no variant could hold it anyway.
MAX_RECORD = 16 << 20

# A string, a structural character, any other run; a quote alone opens a string that its line does not end.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:"]|[^\s{}\[\],:"]+')
_OPENS = {"}": "{", "]": "["}


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


class RecordScanner:
    """Lines of one file in, texts of records out, broken ones too.

    A JSON string holds no line break, so brackets are counted line by line. A record ends with the line that closes its
    first bracket. The elements of an outer array are records of their own, given out as
    soon as they end, so an array of any length is never held. A line that opens a value where JSON allows none shows that what
    is open is broken: that is given out as it is, and the line begins anew. So one broken line costs no other record.
    """

    def __init__(self, most: int = MAX_RECORD):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.stack: list[str] = []
        self.parts: list[str] = []
        self.size, self.last, self.outer = 0, "", False

    def _cut(self) -> list[str]:
        """What is open, as one text: a whole record, or a broken one."""
        text = "\n".join(self.parts)
        made = [text] if text.strip() else ["["] if self.outer else []
        self._clear()
        return made

    def _element(self, rest: str) -> list[str]:
        text = "\n".join([*self.parts, rest])
        self.parts, self.size = [], 0
        return [text] if text.strip() else []

    def _may_open(self) -> bool:
        return self.last in ("[", ":") or (self.last == "," and self.stack[-1:] == ["["])

    def line(self, text: str) -> list[str]:
        bare, made = text.strip(), []
        if not bare:
            return made
        if (self.parts or self.outer) and bare[0] in "{[" and not self._may_open():
            made += self._cut()
        if not self.parts and not self.outer and _is_json(bare):
            return [*made, text]
        start, good = 0, True
        for token in _TOKEN.finditer(text):
            kind = token.group()
            if kind == '"':
                good = False
            elif kind in "{[":
                if kind == "[" and not self.stack and not self.parts and not text[start : token.start()].strip():
                    self.outer, start = True, token.end()
                self.stack.append(kind)
            elif kind in "}]":
                good = self.stack[-1:] == [_OPENS[kind]]
                if good:
                    self.stack.pop()
                if good and self.outer and not self.stack:
                    made += self._element(text[start : token.start()])
                    self.outer, start = False, token.end()
            elif kind == "," and self.outer and len(self.stack) == 1:
                made += self._element(text[start : token.start()])
                start = token.end()
            self.last = kind if kind in "{}[],:" else "value"
            if not good:
                break
        rest = text[start:]
        if rest.strip():
            self.parts.append(rest)
            self.size += len(rest)
        if not good or (self.parts and not self.stack) or self.size > self.most:
            made += self._cut()
        return made

    def end(self) -> list[str]:
        """What the file leaves open."""
        return self._cut()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source_path, source_file, value) lines in the order of their files as (value, source_file, source_path) records."""
    scanner, here, name = RecordScanner(), None, None
    names = ["value", "source_file", "source_path"]

    def rows(made: list[tuple[str, str, str]]) -> pa.RecordBatch:
        columns = list(zip(*made)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(column, pa.string()) for column in columns], names)

    for batch in batches:
        made = []
        for path, file, value in zip(*(batch.column(place).to_pylist() for place in range(3))):
            if path != here:
                made += [(text, name, here) for text in scanner.end()]
                here, name = path, file
            made += [(text, file, path) for text in scanner.line(value)]
        yield rows(made)
    yield rows([(text, name, here) for text in scanner.end()])


def scanned_records(lines: DataFrame) -> DataFrame:
    """The records (value, source_file, source_path) of files given as lines with their file's block and ``_at``, their order in it.

    A file's lines meet in one task in their order, and pass through it one by one.
    """
    dealt = lines.repartition("source_path").sortWithinPartitions("source_path", "source_block", "_at")
    return dealt.select("source_path", "source_file", F.coalesce("value", F.lit("")).alias("value")).mapInArrow(
        _scan, "value string, source_file string, source_path string"
    )
