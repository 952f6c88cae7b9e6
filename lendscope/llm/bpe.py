"""Token ids of whole Arrow batches for a byte-level BPE file of the `tokenizers` library.

The library itself needs over a microsecond a byte, most of it spent on pieces it has seen
before. Here a batch is cut into the pre-tokenizer's pieces with array operations, each
distinct piece is encoded once, and ids are gathered by piece. A worker keeps the pieces
it has met, up to `KEPT_PIECES`; what is kept changes nothing but time.

The shortcut is taken only where it is known to give the library's ids: a plain byte-level BPE whose merges rank as their
ids do. Texts that hold an added token's string, or a character that tables of another age class
differently, and files of any other kind go through the library as they are.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import sys
import unicodedata

import numpy as np
import pyarrow as pa

from lendscope.llm.wordhash import slices, span_hashes, text_buffers

#: Distinct pieces a worker keeps between batches.
KEPT_PIECES = 1_500_000
#: A tokenizer file up to this size travels to the workers as a broadcast variable.
LARGEST_FILE = 64 << 20
_OTHER, _LETTER, _NUMBER, _SPACE, _UNSURE = range(5)
# The white space of the pre-tokenizer's pattern, and the endings it splits off after an apostrophe.
_WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def tokenizer_bytes(path: str) -> bytes:
    """The file's content; it must be small enough to be sent to every worker."""
    if os.path.getsize(path) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    with open(path, "rb") as file:
        return file.read()


def version(content: bytes) -> str:
    """A digest of the vocabulary file and of the library that reads it."""
    import tokenizers

    return hashlib.sha256(content + f"|tokenizers {tokenizers.__version__}".encode()).hexdigest()


@functools.lru_cache(1)
def _classes() -> np.ndarray:
    known = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    oldest = unicodedata.ucd_3_2_0.category
    for code in range(0x30000):  # the planes beyond hold no letters in the oldest table
        was, now = oldest(chr(code)), unicodedata.category(chr(code))
        # Another version of the tables can only matter for what is, was or may become a letter, number or blank.
        if now == "Cn" or was[0] != now[0] and (now[0] in "LNZ" or was[0] in "LNZ"):
            known[code] = _UNSURE
        elif now[0] == "L":
            known[code] = _LETTER
        elif now[0] == "N":
            known[code] = _NUMBER
    known[0x30000:] = _UNSURE
    known[list(_WHITE)] = _SPACE
    known[[0x1C, 0x1D, 0x1E, 0x1F, 0x180E, 0x200B, 0xFEFF]] = _UNSURE
    return known


def _starts(points: np.ndarray, kinds: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pieces of the pre-tokenizer begin; ``edges`` are the bounds of the texts."""
    count = len(points)
    edge = np.zeros(count + 1, bool)
    edge[edges] = True
    start = np.ones(count, bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | edge[1:count]
    # The last blank before something else stands alone, or is the head of the next piece if it is a plain space.
    last = np.flatnonzero((kinds[:-1] == _SPACE) & (kinds[1:] != _SPACE) & ~edge[1:count])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # An apostrophe that begins a piece takes one of the endings with it.
    for at in np.flatnonzero((points == 0x27) & start):
        if at + 1 < count and not edge[at + 1] and kinds[at + 1] == _LETTER:
            for ending in _ENDINGS:
                end = at + 1 + len(ending)
                if end <= count and not edge[at + 1 : end].any() and all(
                    points[at + 1 + place] == ord(letter) for place, letter in enumerate(ending)
                ):
                    start[at + 1] = False
                    if end < count:
                        start[end] = True
                    break
    return np.flatnonzero(start)


class BatchEncoder:
    """Ids of the texts of a batch, as one flat array and its offsets."""

    def __init__(self, content: bytes):
        # The worker is one of many on its machine: no threads of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(content)
        spec = json.loads(content)
        self.added = [token["content"] for token in spec.get("added_tokens", [])]
        self.piece_ids = self._plain_pieces(spec)
        self.seen = np.zeros(0, np.uint64)
        self.lengths = np.zeros(0, np.int64)
        self.offsets = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _plain_pieces(self, spec: dict):
        """A function from a piece's bytes to its ids, or None if the file isn't of the plain kind."""
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not spec.get("normalizer")
            and not spec.get("post_processor")
            and not spec.get("truncation")
            and not spec.get("padding")
        )
        if not plain:
            return None
        # The library writes a byte as a printable character: itself, or one counted on from 256.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [byte for byte in range(256) if byte not in printable]
        byte_of = {chr(byte): byte for byte in printable} | {chr(256 + n): byte for n, byte in enumerate(rest)}
        added = set(self.added)
        ranks = {bytes(byte_of[c] for c in word): place for word, place in model["vocab"].items() if word not in added}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        single = sum(len(word) == 1 for word in ranks)
        if single != 256 or any(a >= b for a, b in zip(merged, merged[1:])) or len(merged) + 256 != len(ranks):
            return None
        import tiktoken

        coder = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return coder._core_bpe.encode_single_piece

    def _by_library(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.library.encode_batch(texts, add_special_tokens=False)
        return [np.array(one.ids, np.uint32) for one in coded]

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Encode pieces that have not been met yet (hashes ascending); the table is emptied first when it is full."""
        if len(self.seen) + len(hashes) > KEPT_PIECES:
            self.seen, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.offsets, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        coded = list(map(self.piece_ids, pieces))
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(lengths.sum()))
        begins = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, flat])
        place = np.searchsorted(self.seen, hashes)
        self.seen = np.insert(self.seen, place, hashes)
        self.offsets = np.insert(self.offsets, place, begins)
        self.lengths = np.insert(self.lengths, place, lengths)

    def _slice(self, offsets: np.ndarray, data: np.ndarray, with_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per text) of the texts of one slice."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        if len(points) == len(data):
            edges = offsets
        else:
            heads = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
            edges = heads[offsets]
        kinds = _classes()[points]
        texts = len(offsets) - 1
        odd = np.zeros(texts, bool)
        if (unsure := np.flatnonzero(kinds == _UNSURE)).size:
            odd[np.searchsorted(edges, unsure, "right") - 1] = True
        for string in self.added:
            sought, at = string.encode(), -1
            while (at := raw.find(sought, at + 1)) >= 0:
                odd[np.searchsorted(offsets, at, "right") - 1] = True
        starts = _starts(points, kinds, edges) if len(points) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(points))
        hashes = span_hashes(points, starts, ends)
        distinct, index = np.unique(hashes, return_inverse=True)
        place = np.searchsorted(self.seen, distinct)
        found = place < len(self.seen)
        found[found] = self.seen[place[found]] == distinct[found]
        if not found.all():
            if len(self.seen) + int((~found).sum()) > KEPT_PIECES:
                found[:] = False
            sample = np.empty(len(distinct), np.int64)
            sample[index] = np.arange(len(hashes))
            new = sample[~found]
            heads = np.arange(len(points) + 1) if len(points) == len(data) else np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            bounds = zip(heads[starts[new]].tolist(), heads[ends[new]].tolist())
            self._learn(distinct[~found], [raw[a:b] for a, b in bounds])
            place = np.searchsorted(self.seen, distinct)
        each = self.lengths[place][index]
        bounds = np.searchsorted(starts, edges)
        sums = np.concatenate([[0], np.cumsum(each)])
        counts = sums[bounds[1:]] - sums[bounds[:-1]]
        ids = np.zeros(0, np.uint32)
        if with_ids:
            begin = self.offsets[place][index]
            ids = self.ids[np.repeat(begin - sums[:-1], each) + np.arange(sums[-1])]
        if odd.any():
            which = np.flatnonzero(odd)
            own = self._by_library([raw[offsets[i] : offsets[i + 1]].decode() for i in which])
            bound = np.concatenate([[0], np.cumsum(counts)])
            if with_ids:
                parts, at = [], 0
                for i, one in zip(which, own):
                    parts += [ids[at : bound[i]], one]
                    at = bound[i + 1]
                ids = np.concatenate([*parts, ids[at:]])
            counts[which] = [len(one) for one in own]
        return ids, counts

    def encode(self, column: pa.Array, with_ids: bool = True):
        """For each slice of the batch: (first text, one past the last, flat ids, ids per text)."""
        offsets, data = text_buffers(column)
        for at, end in slices(offsets):
            part = offsets[at : end + 1]
            texts = data[part[0] : part[-1]]
            if self.piece_ids is None:
                raw = texts.tobytes()
                own = self._by_library([raw[a:b].decode() for a, b in zip(part[:-1] - part[0], part[1:] - part[0])])
                yield at, end, np.concatenate([np.zeros(0, np.uint32), *own]), np.array([len(x) for x in own], np.int64)
            else:
                ids, counts = self._slice(part - part[0], texts, with_ids)
                yield at, end, ids, counts


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(content: bytes) -> BatchEncoder:
    """The worker's encoder for this file, built once."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = BatchEncoder(content)
    return _ENCODERS[key]
