"""Toxicity by a factorization machine over hashed terms.

A document's terms are its words and their beginnings, each hashed into a table. Besides a weight, every
term has a short vector; the product of two terms' vectors weighs their meeting in one document, which a
sum of weights alone can't express. Labels are learned from a bounded sample; the score of a document is
taken from its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import in_fold, texts
from lendscope.llm.learning import labelled_sample, sigmoid
from lendscope.llm.wordhash import slices, span_hashes, text_buffers, words

#: Labelled documents that training takes at most.
SAMPLE = 12_000
TABLE = 1 << 20
#: Bytes of a word's beginning that count as a term of their own.
BEGINNING = 5
#: Terms that the machine knows: those that tell the classes apart best in the sample.
TERMS = 4096
#: A term counts from so many documents of the sample on, and from so many standard errors of difference between the classes.
LEAST_DOCUMENTS = 4
LEAST_Z = 3.0
FACTORS = 4
ROUNDS = 300
RATE = 0.3
DECAY = 1e-4
#: A toxic document of the sample weighs as much as so many clean ones, of which there are far more.
TOXIC_WEIGHT = 4.0

# Bytes between words: everything ASCII that is no letter.
_NO_LETTER = np.array([byte < 128 and not chr(byte).isalpha() for byte in range(256)])


@dataclass
class Machine:
    #: For each hash of the table the place of its term among those known, or -1.
    places: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float


def document_terms(batch):
    """(first document, one past the last, document of each term, term) of the distinct terms of a batch, slice by slice."""
    offsets, data = text_buffers(batch.column("text"))
    for at, end in slices(offsets):
        part = offsets[at : end + 1]
        found = words(part - part[0], data[part[0] : part[-1]], lower=True, blank=_NO_LETTER)
        long = found.ends - found.starts > BEGINNING
        starts = found.starts[long]
        beginnings = span_hashes(found.data, starts, starts + BEGINNING) ^ np.uint64(0xA5A5)
        owner = np.concatenate([found.owner, found.owner[long]])
        term = (np.concatenate([found.hashes, beginnings]) % np.uint64(TABLE)).astype(np.int64)
        code = np.unique(owner * TABLE + term)
        yield at, end, code // TABLE, code % TABLE


def _term_lists(batches):
    for batch in batches:
        lists = [b""] * batch.num_rows
        for at, end, owner, term in document_terms(batch):
            stops = np.searchsorted(owner, np.arange(end - at + 1))
            for i in range(end - at):
                lists[at + i] = term[stops[i] : stops[i + 1]].astype(np.uint32).tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(lists, pa.binary())], ["label", "terms"])


def _gather(places: np.ndarray, lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of the known terms of each list."""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    place = places[np.concatenate([np.zeros(0, np.int64), *lists])]
    return owner[place >= 0], place[place >= 0]


def machine_scores(machine: Machine, owner: np.ndarray, place: np.ndarray, count: int) -> np.ndarray:
    """bias + sum of weights + half of (squared sum - sum of squares) of the vectors, for each document."""
    scores = machine.bias + np.bincount(owner, machine.weights[place], count)
    for k in range(machine.factors.shape[1]):
        own = machine.factors[place, k]
        scores += 0.5 * (np.bincount(owner, own, count) ** 2 - np.bincount(owner, own**2, count))
    return scores


def train(lists: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Machine:
    """A machine for documents given as their distinct terms."""
    # A text that the sample holds many times tells no more than once.
    lists, labels = zip(*{(x.tobytes(), y): (x, y) for x, y in zip(lists, labels)}.values()) if len(lists) else ((), ())
    labels = np.array(labels, float)
    toxic, clean = labels.sum(), len(labels) - labels.sum()
    flat = np.concatenate([np.zeros(0, np.int64), *lists])
    mark = np.repeat(labels, [len(x) for x in lists]) if len(lists) else np.zeros(0)
    held = np.bincount(flat, minlength=TABLE)
    with_label = np.bincount(flat, mark, TABLE)
    share = held / max(1, len(labels))
    z = np.abs(with_label / max(1, toxic) - (held - with_label) / max(1, clean)) / np.sqrt(
        np.maximum(share * (1 - share), 1e-12) * (1 / max(1, toxic) + 1 / max(1, clean))
    )
    z[(held < LEAST_DOCUMENTS) | (z < LEAST_Z)] = 0
    known = np.sort(np.argsort(-z, kind="stable")[: min(TERMS, int((z > 0).sum()))])
    places = np.full(TABLE, -1, np.int32)
    places[known] = np.arange(len(known))
    rng = np.random.default_rng(seed)
    prior = (TOXIC_WEIGHT * toxic + 0.5) / (TOXIC_WEIGHT * toxic + clean + 1)
    machine = Machine(places, np.zeros(len(known)), rng.normal(0, 0.02, (len(known), FACTORS)), float(np.log(prior / (1 - prior))))
    if not len(known):
        return machine
    owner, place = _gather(places, list(lists))
    count, size = len(labels), len(known)
    squares = np.full(size, 1e-8), np.full((size, FACTORS), 1e-8)
    bias_square = 1e-8
    for _ in range(ROUNDS):
        error = (sigmoid(machine_scores(machine, owner, place, count)) - labels) * np.where(labels > 0, TOXIC_WEIGHT, 1.0) / count
        each = error[owner]
        step = np.bincount(place, each, size) + DECAY * machine.weights
        squares[0][:] += step**2
        for k in range(FACTORS):
            own = machine.factors[place, k]
            rest = np.bincount(owner, own, count)[owner] - own
            turn = np.bincount(place, each * rest, size) + DECAY * machine.factors[:, k]
            squares[1][:, k] += turn**2
            machine.factors[:, k] -= 0.5 * RATE * turn / np.sqrt(squares[1][:, k])
        machine.weights -= RATE * step / np.sqrt(squares[0])
        shift = float(error.sum())
        bias_square += shift**2
        machine.bias -= 0.5 * RATE * shift / float(np.sqrt(bias_square))
    return machine


def _scorer(machine: Machine):
    def step(batches):
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for at, end, owner, term in document_terms(batch):
                place = machine.places[term]
                own = machine_scores(machine, owner[place >= 0], place[place >= 0], end - at)
                scores[at:end] = sigmoid(own)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return step


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    ``labels`` (doc_id, toxic) counts only outside the held-out fold; a score depends on the text alone. Null
    and empty texts have the score of a document without known terms; without labels all scores are the prior of
    one half. Null and repeated ids are scored like all others. An empty table gives an empty result.
    """
    rows = texts(docs)
    known = labelled_sample(rows, labels, "toxic", sample).select("label", "text")
    found = known.mapInArrow(_term_lists, "label int, terms binary").collect()  # at most ``sample`` lists of numbers
    found = sorted((bytes(r["terms"]), r["label"]) for r in found)
    machine = train([np.frombuffer(t, np.uint32).astype(np.int64) for t, _ in found], np.array([y for _, y in found], float))
    scored = rows.mapInArrow(_scorer(machine), "doc_id long, score double")
    return scored.select(
        "doc_id", in_fold("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
