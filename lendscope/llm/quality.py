"""Document quality by co-training of two views: what the text is like, and what is known about the document.

Each view has a classifier of its own. Round by round each classifier labels the documents of an unlabelled pool that
it is surest of, and hands them to the other as training rows. Both are then calibrated on labelled rows kept back from
training, and a document's score joins the two calibrated views.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import in_fold
from lendscope.llm.learning import labelled_sample, logistic, sigmoid, weighted_sum
from lendscope.llm.wordhash import runs_of_lines, slices, text_buffers, words

#: Labelled documents and documents of the unlabelled pool that training takes at most.
SAMPLE = 10_000
POOL = 10_000
ROUNDS = 8
#: Part of the pool that a view hands over in a round.
HANDED = 0.02
#: Every so-manieth labelled row calibrates instead of training.
KEPT_BACK = 4
SOURCES, LANGUAGES = 32, 8

_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_MARK = np.array([b < 128 and not chr(b).isalnum() and not chr(b).isspace() for b in range(256)])
_SYMBOL = np.array([chr(b) in "!#$%&*|<>{}[]=~^\\/_" for b in range(256)])
_WIDE = np.array([b >= 128 for b in range(256)])

TEXT_VIEW, META_VIEW = 14, 3 + SOURCES + LANGUAGES
FEATURES = "doc_id long, text_view array<double>, meta_view array<double>"


def text_view(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Features of the texts of a slice."""
    count = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    share = lambda table: np.bincount(owner[table[data]], minlength=count) / size
    found = words(offsets, data, lower=True)
    n = np.maximum(found.counts, 1).astype(float)
    pairs = np.stack([found.owner, found.hashes.view(np.int64)]) if len(found.hashes) else np.zeros((2, 0), np.int64)
    distinct, times = np.unique(pairs, axis=1, return_counts=True) if pairs.shape[1] else (pairs, np.zeros(0, int))
    commonest = np.zeros(count)
    np.maximum.at(commonest, distinct[0], times)
    lines, distinct_lines = runs_of_lines(offsets, data)
    marked = np.zeros(len(found.starts), bool)
    if len(found.starts):
        marked = _SYMBOL[data[found.ends - 1]]
    upper_words = np.zeros(len(found.starts), bool)
    if len(found.starts):
        total = np.concatenate([[0], np.cumsum(_UPPER[data])])
        upper_words = (total[found.ends] - total[found.starts]) * 2 > found.ends - found.starts
    width = (found.ends - found.starts).astype(float)
    return np.stack(
        [
            share(_UPPER),
            share(_DIGIT),
            share(_MARK),
            share(_SYMBOL),
            share(_WIDE),
            np.bincount(found.owner, width, count) / n / 10,
            np.bincount(distinct[0], minlength=count) / n,
            commonest / n,
            np.log1p(found.counts) / 8,
            np.log1p(lines) / 6,
            distinct_lines / np.maximum(lines, 1),
            np.bincount(found.owner, marked, count) / n,
            np.bincount(found.owner, upper_words, count) / n,
            (found.counts == 0).astype(float),
        ],
        axis=1,
    )


def meta_view(source: list, lang: list, n_chars: list) -> np.ndarray:
    """Features of what is known about documents; unknown values have places of their own."""
    import zlib

    def place(value, size):
        return 0 if value is None else 1 + zlib.crc32(value.encode()) % (size - 1)

    made = np.zeros((len(source), META_VIEW))
    for row, (s, g, n) in enumerate(zip(source, lang, n_chars)):
        made[row, 0] = np.log1p(max(0, n or 0)) / 10
        made[row, 1] = n is None
        made[row, 2] = (n or 0) < 200
        made[row, 3 + place(s, SOURCES)] = 1
        made[row, 3 + SOURCES + place(g, LANGUAGES)] = 1
    return made


def _views(batch):
    offsets, data = text_buffers(batch.column("text"))
    for at, end in slices(offsets):
        part = offsets[at : end + 1]
        meta = [batch.column(name).slice(at, end - at).to_pylist() for name in ("source", "lang", "n_chars")]
        yield at, end, text_view(part - part[0], data[part[0] : part[-1]]), meta_view(*meta)


def _listed(values: np.ndarray) -> pa.Array:
    stops = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(values.ravel()))


def _extract(batches):
    for batch in batches:
        for at, end, text, meta in _views(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, end - at), _listed(text), _listed(meta)], ["doc_id", "text_view", "meta_view"]
            )


@dataclass
class View:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, features: np.ndarray) -> np.ndarray:
        return weighted_sum((features - self.mean) / self.scale, self.weights) + self.bias

    def logit(self, features: np.ndarray) -> np.ndarray:
        """The calibrated view."""
        return self.slope * self.raw(features) + self.shift


def fit(features: np.ndarray, labels: np.ndarray) -> View:
    mean, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)
    weights, bias = logistic((features - mean) / scale, labels)
    return View(mean, scale, weights, bias)


def co_train(views: list[np.ndarray], labels: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS) -> list[View]:
    """Two calibrated views from labelled rows and an unlabelled pool, given by view."""
    back = np.arange(len(labels)) % KEPT_BACK == 0
    if not len(labels) or len(np.unique(labels[~back])) < 2:
        # One class or none: nothing to tell apart, the prior stands for every document.
        prior = (labels.sum() + 1) / (len(labels) + 2)
        flat = [View(np.zeros(v.shape[1]), np.ones(v.shape[1]), np.zeros(v.shape[1]), 0.0) for v in views]
        for view in flat:
            view.shift = float(np.log(prior / (1 - prior)))
        return flat
    own = [[v[~back]] for v in views]
    known = [[labels[~back]] for _ in views]
    free = np.ones(len(pool[0]), bool)
    prior = labels.mean()
    for _ in range(rounds):
        fitted = [fit(np.concatenate(own[i]), np.concatenate(known[i])) for i in range(2)]
        if not free.any():
            break
        for i in range(2):
            open_ = np.flatnonzero(free)
            scores = fitted[i].raw(pool[i][open_])
            many = max(1, int(HANDED * len(free)))
            good = int(round(many * prior))
            order = np.argsort(scores, kind="stable")
            picked = [(order[::-1][:good], 1.0), (order[: many - good], 0.0)]
            for places, label in picked:
                sure = places[(scores[places] > 0) == (label > 0)]  # only what the view itself believes
                own[1 - i].append(pool[1 - i][open_[sure]])
                known[1 - i].append(np.full(len(sure), label))
                free[open_[sure]] = False
    fitted = [fit(np.concatenate(own[i]), np.concatenate(known[i])) for i in range(2)]
    for view, features in zip(fitted, views):
        slope, shift = logistic(view.raw(features[back])[:, None] / 4, labels[back].astype(float))
        view.slope, view.shift = float(slope[0]) / 4, shift
    return fitted


def _scorer(fitted: list[View], prior_logit: float):
    def step(batches):
        for batch in batches:
            for at, end, text, meta in _views(batch):
                logits = fitted[0].logit(text), fitted[1].logit(meta)
                # Independent views: their evidence adds up, the prior counts once.
                both = logits[0] + logits[1] - prior_logit
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - at), *(pa.array(sigmoid(x)) for x in (*logits, both))],
                    ["doc_id", "text_score", "meta_score", "score"],
                )

    return step


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pool: int = POOL) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, text_score, meta_score, score, predicted (1: good).

    ``labels`` (doc_id, quality) counts only outside the held-out fold. Null texts are empty ones; null metadata have features of
    their own; null and repeated ids are scored like all others. Without labels every score is the prior of
    one half. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    known = labelled_sample(rows, labels, "quality", sample)
    marks = known.select("doc_id", "label").distinct()
    features = known.select("doc_id", "text", "source", "lang", "n_chars").mapInArrow(_extract, FEATURES)
    # ``sample`` and ``pool`` rows of a few dozen numbers reach the driver.
    labelled = sorted(
        (r["doc_id"], r["label"], r["text_view"], r["meta_view"]) for r in features.join(F.broadcast(marks), "doc_id").collect()
    )
    named = rows.where(F.col("doc_id").isNotNull() & ~in_fold("doc_id"))
    judged = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").cast("long").alias("judged"))
    ids = named.select("doc_id").join(judged, F.col("doc_id") == F.col("judged"), "left_anti").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool).select(F.col("doc_id").alias("pooled"))
    free = named.join(F.broadcast(ids), F.col("doc_id") == F.col("pooled"), "left_semi").mapInArrow(_extract, FEATURES)
    unlabelled = sorted((r["doc_id"], r["text_view"], r["meta_view"]) for r in free.collect())
    shape = lambda found, size: np.array(found, float).reshape(len(found), size)
    views = [shape([r[2] for r in labelled], TEXT_VIEW), shape([r[3] for r in labelled], META_VIEW)]
    spare = [shape([r[1] for r in unlabelled], TEXT_VIEW), shape([r[2] for r in unlabelled], META_VIEW)]
    truth = np.array([r[1] for r in labelled], float)
    fitted = co_train(views, truth, spare)
    prior = (truth.sum() + 1) / (len(truth) + 2)
    scored = rows.mapInArrow(
        _scorer(fitted, float(np.log(prior / (1 - prior)))), "doc_id long, text_score double, meta_score double, score double"
    )
    return scored.select(
        "doc_id", in_fold("doc_id").alias("held_out"), "text_score", "meta_score", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
