"""Packed exchange: entries (code, owner) travel as one row per task and bucket instead of one row each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Entries of one bucket: owners in order, how many entries each has, and the entries' codes and marks. The
#: kind tells entries that the receiver must look at (0) from those it passes on (1).
PARCEL = "bucket int, kind int, docs binary, sizes binary, codes binary, marks binary"
PARCEL_ARROW = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), *((name, pa.binary()) for name in ("docs", "sizes", "codes", "marks"))]
)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """The first place of each run of equal values."""
    head = np.ones(len(sorted_values), bool)
    head[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(head)


def pack(bucket: np.ndarray, kind: np.ndarray, docs: np.ndarray, codes: np.ndarray, marks: np.ndarray, width: int):
    """Entries as one row per bucket and kind; an owner is written once for its entries, as the step from the one before."""
    order = np.lexsort((docs, kind, bucket))
    bucket, kind, docs, codes, marks = (x[order] for x in (bucket, kind, docs, codes, marks))
    stops = np.append(runs(bucket.astype(np.int64) * 2 + kind), len(bucket))
    rows = []
    short = codes.astype(np.uint32) if width == 4 else codes
    for a, b in zip(stops[:-1].tolist(), stops[1:].tolist()):
        heads = runs(docs[a:b])
        sizes = np.diff(np.append(heads, b - a)).astype(np.uint32)
        rows.append((int(bucket[a]), int(kind[a]), np.diff(docs[a:b][heads], prepend=0).tobytes(), sizes.tobytes(), short[a:b].tobytes(), marks[a:b].tobytes()))
    columns = list(zip(*rows)) if rows else [[] for _ in range(6)]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(x), t) for x, t in zip(columns, types)], ["bucket", "kind", "docs", "sizes", "codes", "marks"]
    )


def owners(docs: bytes, sizes: bytes) -> np.ndarray:
    """The owner of each entry of a parcel."""
    return np.repeat(np.cumsum(np.frombuffer(docs, np.int64)), np.frombuffer(sizes, np.uint32))
