"""Language of documents by a linear-chain conditional random field over their words.

Each word of a text gets a language; its features are prefixes, suffixes, byte trigrams and the word itself, each
hashed into a table of weights, and a matrix of learned transitions couples neighbours, so that words of
code-switched text lean on those around them. Marginals come from forward-backward
over stretches of words, all stretches of a batch at once. A document's scores are its words' mean marginals.

The field is trained here by gradient ascent of the conditional likelihood, on a bounded sample of labelled documents, in
one task of an executor; only its weights reach the driver. Labels are per document; so that transitions are learned
from more than unbroken runs, training stretches are also spliced from documents of different languages.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lendscope.llm.common import in_fold
from lendscope.llm.wordhash import mix, slices, text_buffers, words

#: Labelled documents that training takes of each language, those with the least hash of their id.
SAMPLE_PER_LANGUAGE = 250
#: Words of one stretch: the chain that forward-backward runs over.
STRETCH = 32
#: Stretches that training takes of one document, evenly over its length.
STRETCHES_PER_DOCUMENT = 6
ROUNDS = 12
RATE = 0.35
DECAY = 1e-4
#: Hash buckets of each kind of feature.
TABLE = 1 << 15
NO_LANGUAGE = "und"


@dataclass
class Model:
    languages: list[str]
    trigrams: np.ndarray  # TABLE x languages
    affixes: np.ndarray
    lexicon: np.ndarray
    bias: np.ndarray
    start: np.ndarray
    transitions: np.ndarray


def word_features(found) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: trigram buckets (flat, with each word's first one), four affix buckets, one lexicon bucket."""
    data = found.data.astype(np.uint64)
    count = len(found.starts)
    # Trigrams of the word with one mark in front and behind; a word of n bytes has n of them.
    padded = np.concatenate([[np.uint64(32)], data, [np.uint64(32)]])
    code = (padded[:-2] << np.uint64(16)) | (padded[1:-1] << np.uint64(8)) | padded[2:]
    inside = np.zeros(len(data) + 1, np.int64)
    inside[found.starts] += 1
    inside[found.ends] -= 1
    solid = np.cumsum(inside[:-1]) > 0
    trigram = (mix(code[solid]) % np.uint64(TABLE)).astype(np.int64)
    first = np.cumsum(found.ends - found.starts) - (found.ends - found.starts)
    affixes = np.empty((count, 4), np.int64)
    length = found.ends - found.starts
    for column, size in enumerate((2, 4)):
        for side in range(2):
            key = np.full(count, 2 * size + side, np.uint64)
            for step in range(size):
                at = np.minimum(found.starts + step, found.ends - 1) if side == 0 else np.maximum(found.ends - 1 - step, found.starts)
                key = key * np.uint64(257) + np.where(step < length, data[at], 0).astype(np.uint64)
            affixes[:, 2 * column + side] = (mix(key) % np.uint64(TABLE)).astype(np.int64)
    lexicon = (found.hashes % np.uint64(TABLE)).astype(np.int64)
    return trigram, first, affixes, lexicon


def emissions(model: Model, features) -> np.ndarray:
    trigram, first, affixes, lexicon = features
    if not len(first):
        return np.zeros((0, len(model.languages)))
    size = np.diff(np.append(first, len(trigram)))[:, None]
    scores = np.add.reduceat(model.trigrams[trigram], first, axis=0) / np.sqrt(size)
    for column in range(affixes.shape[1]):
        scores += model.affixes[affixes[:, column]]
    return scores + model.lexicon[lexicon] + model.bias


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def forward_backward(scores: np.ndarray, mask: np.ndarray, model: Model, pairs: bool = False):
    """Marginals of each place of the stretches (stretch x place x language), and expected transitions if asked for."""
    count, length, size = scores.shape
    ahead = np.empty_like(scores)
    behind = np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + model.start
    for t in range(1, length):
        step = _log_sum(ahead[:, t - 1, :, None] + model.transitions, 1) + scores[:, t]
        ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = _log_sum(model.transitions + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(mask[:, t + 1, None], step, behind[:, t + 1])
    total = _log_sum(ahead[:, -1], 1)
    marginals = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
    if not pairs:
        return marginals, None
    expected = np.zeros((size, size))
    for t in range(1, length):
        joint = ahead[:, t - 1, :, None] + model.transitions + (scores[:, t] + behind[:, t])[:, None, :] - total[:, None, None]
        expected += (np.exp(joint) * mask[:, t, None, None]).sum(axis=0)
    return marginals, expected


def stretches(counts: np.ndarray, length: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, place) of each word, when every document is cut into stretches of ``length`` words."""
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    per = -(-counts // length)
    base = np.repeat(np.cumsum(per) - per, counts)
    return base + inside // length, inside % length


def train(sample: list[tuple[str, str]], rounds: int = ROUNDS, seed: int = 17) -> Model | None:
    """A field for the languages of ``sample``, (stretch of words, language) rows in a fixed order; None without any."""
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return None
    size = len(languages)
    rng = np.random.default_rng(seed)
    offsets, data = text_buffers(pa.array([text for text, _ in sample]))
    found = words(offsets, data, lower=True)
    labels = np.array([languages.index(lang) for _, lang in sample])
    counts = found.counts
    stretch, _ = stretches(counts)
    label = np.repeat(labels, counts)
    pieces = np.split(np.arange(len(stretch)), np.flatnonzero(np.diff(stretch)) + 1)
    chosen = [pieces[i] for i in rng.permutation(len(pieces))]
    # A third of the stretches is spliced from two, which mostly differ in language.
    for i in range(0, len(chosen) - 1, 3):
        a, b = chosen[i], chosen[i + 1]
        cut_a, cut_b = int(rng.integers(0, len(a) + 1)), int(rng.integers(0, len(b) + 1))
        chosen[i], chosen[i + 1] = np.append(a[:cut_a], b[cut_b:])[:STRETCH], np.append(b[:cut_b], a[cut_a:])[:STRETCH]
    chosen = [piece for piece in chosen if len(piece)]
    model = Model(
        languages,
        *(np.zeros((TABLE, size), np.float32) for _ in range(3)),
        bias=np.zeros(size, np.float32),
        start=np.zeros(size, np.float32),
        transitions=np.eye(size, dtype=np.float32),
    )
    if not chosen:
        return model
    rows = np.concatenate(chosen)
    length = np.array([len(piece) for piece in chosen])
    row = np.repeat(np.arange(len(chosen)), length)
    column = np.arange(len(rows)) - np.repeat(np.cumsum(length) - length, length)
    mask = np.zeros((len(chosen), STRETCH), bool)
    mask[row, column] = True
    trigram, first, affixes, lexicon = word_features(found)
    wide = np.diff(np.append(first, len(trigram)))
    taken = np.repeat(first[rows] - (np.cumsum(wide[rows]) - wide[rows]), wide[rows]) + np.arange(int(wide[rows].sum()))
    features = trigram[taken], np.cumsum(wide[rows]) - wide[rows], affixes[rows], lexicon[rows]
    truth = np.eye(size, dtype=np.float32)[label[rows]]
    follows = np.flatnonzero(column > 0)
    seen = np.zeros((size, size))
    np.add.at(seen, (label[rows][follows - 1], label[rows][follows]), 1)
    begins = truth[column == 0].sum(axis=0)
    weights = [model.trigrams, model.affixes, model.lexicon, model.bias, model.start, model.transitions]
    squares = [np.full_like(w, 1e-6) for w in weights]
    share = (1 / np.sqrt(np.repeat(wide[rows], wide[rows]))).astype(np.float32)

    def summed(index, values):
        return np.stack([np.bincount(index, values[:, k], TABLE) for k in range(size)], axis=1)

    for _ in range(rounds):
        scores = np.zeros((len(chosen), STRETCH, size), np.float32)
        scores[row, column] = emissions(model, features)
        marginals, expected = forward_backward(scores, mask, model, pairs=True)
        error = truth - marginals[row, column]
        gradients = [
            summed(features[0], np.repeat(error, wide[rows], axis=0) * share[:, None]),
            sum(summed(features[2][:, k], error) for k in range(features[2].shape[1])),
            summed(features[3], error),
            error.sum(axis=0),
            begins - marginals[:, 0].sum(axis=0),
            seen - expected,
        ]
        for weight, square, gradient in zip(weights, squares, gradients):
            gradient = (gradient - DECAY * len(rows) / TABLE * weight).astype(np.float32)
            square += gradient**2
            weight += RATE * gradient / np.sqrt(square)
    return model


def _labeller(model: Model):
    """A step from documents to the mean marginals of their words."""
    narrow = Model(model.languages, *(w.astype(np.float32) for w in (model.trigrams, model.affixes, model.lexicon, model.bias, model.start, model.transitions)))

    def step(batches):
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            best, score, switched = [], [], []
            for at, end in slices(offsets):
                part = offsets[at : end + 1]
                found = words(part - part[0], data[part[0] : part[-1]], lower=True)
                counts = found.counts
                means = np.zeros((end - at, len(narrow.languages)))
                if len(found.starts):
                    line, place = stretches(counts)
                    scores = np.zeros((int(line[-1]) + 1, STRETCH, len(narrow.languages)), np.float32)
                    mask = np.zeros(scores.shape[:2], bool)
                    scores[line, place] = emissions(narrow, word_features(found))
                    mask[line, place] = True
                    marginals = forward_backward(scores, mask, narrow)[0][line, place]
                    heads = found.first[:-1][counts > 0]
                    means[counts > 0] = np.add.reduceat(marginals.astype(float), heads, axis=0) / counts[counts > 0, None]
                best += means.argmax(axis=1).tolist()
                score += np.clip(means.max(axis=1), 0, 1).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([narrow.languages[i] for i in best], pa.string()), pa.array(score, pa.float64())],
                [*batch.schema.names, "_lang_pred", "_lang_score"],
            )

    return step


def _cutter(most: int):
    """A step from labelled documents to ``most`` of their stretches, as texts: (lang, order, part, stretch)."""

    def step(batches):
        for batch in batches:
            langs, orders, parts, texts = [], [], [], []
            for lang, order, text in zip(*(batch.column(n).to_pylist() for n in range(3))):
                offsets, data = text_buffers(pa.array([text]))
                found = words(offsets, data, lower=False)
                count = -(-len(found.starts) // STRETCH)
                for part in sorted({i * count // most for i in range(most)} if count > most else range(count)):
                    first, last = part * STRETCH, min((part + 1) * STRETCH, len(found.starts)) - 1
                    langs.append(lang)
                    orders.append(order)
                    parts.append(part)
                    texts.append(data[found.starts[first] : found.ends[last]].tobytes().decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(orders, pa.int64()), pa.array(parts, pa.int64()), pa.array(texts, pa.string())],
                ["lang", "order", "part", "stretch"],
            )

    return step


def _train_all(batches):
    """The one task that trains: all stretches of the sample, in their order, to the model's weights."""
    sample = [row for batch in batches for row in zip(batch.column(3).to_pylist(), batch.column(0).to_pylist())]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(sample))], pa.binary())], ["model"])


def sample_of(docs: DataFrame, held_out, per_language: int = SAMPLE_PER_LANGUAGE, per_document: int = STRETCHES_PER_DOCUMENT) -> DataFrame:
    """(lang, order, part, stretch): up to ``per_document`` stretches of each of at most ``per_language`` labelled documents a language.

    The documents are those outside the held-out fold with the least hash of their id. So every language
    trains on a like share, whatever the lengths of its texts, and no whole text leaves its task.
    """
    named = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    order = F.xxhash64("doc_id")
    ranked = named.select("doc_id", "lang").withColumn(
        "n", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))
    )
    chosen = ranked.where(F.col("n") <= per_language).select(F.col("doc_id").alias("chosen"))
    # A few hundred ids a language, whatever the table holds.
    rows = named.join(F.broadcast(chosen.distinct()), F.col("doc_id") == F.col("chosen"), "left_semi")
    rows = rows.select("lang", F.col("doc_id").cast("long").alias("order"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_cutter(per_document), "lang string, order long, part long, stretch string")


def trained(docs: DataFrame, held_out, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """The field for the labels of ``docs``. The sample, which has a fixed bound, meets in one task; a lost one trains the same again."""
    sample = sample_of(docs, held_out, per_language).repartition(1).sortWithinPartitions("order", "part", "lang", "stretch")
    found = sample.mapInArrow(_train_all, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def labelled(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with _lang_pred and _lang_score; a text that is null or holds no letter is ``und`` with score 0."""
    if model is None:
        return docs.withColumn("_lang_pred", F.lit(NO_LANGUAGE)).withColumn("_lang_score", F.lit(0.0))
    schema = docs.withColumn("_lang_pred", F.lit("")).withColumn("_lang_score", F.lit(0.0)).schema
    made = docs.mapInArrow(_labeller(model), schema)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return made.withColumns(
        {
            "_lang_pred": F.when(lettered, F.col("_lang_pred")).otherwise(NO_LANGUAGE),
            "_lang_score": F.when(lettered, F.col("_lang_score")).otherwise(0.0),
        }
    )


def languages(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Languages are those of the labels outside the held-out fold; nothing but the text decides on a document. A null text,
    or one without a letter, is ``und`` with score 0, and so are all when no label can be learned from. Null and
    repeated ids are judged like all others; documents without an id or a label are not learned from.
    """
    model = trained(docs, in_fold("doc_id"), per_language)
    return labelled(docs.select("doc_id", "text"), model).select(
        "doc_id", in_fold("doc_id").alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score")
    )


def keep_known(docs: DataFrame, least_score: float, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` whose language is known with ``least_score`` at least, with their own columns."""
    model = trained(docs, in_fold("doc_id"), per_language)
    return labelled(docs, model).where(
        (F.col("_lang_pred") != NO_LANGUAGE) & (F.col("_lang_score") >= least_score)
    ).select(*docs.columns)
