"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Every labelled document counts towards the document frequencies. The weights are trained by follow-the-regularised-
leader with elastic-net penalties on at most ``SAMPLE_PER_LANGUAGE`` documents per language; part of them is held back
to fit one temperature, so that scores are calibrated. The model is a table of ``FEATURES`` rows and one column per
language, whatever the size of the corpus, and every text is scored whole where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.textarrays import slices, utf8

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
ORDERS = (1, 2, 3)
#: Bound of the labelled sample on which the weights are fitted.
SAMPLE_PER_LANGUAGE = 400
UNKNOWN = "und"
SLICE_BYTES = 1 << 20
#: Rows whose features are marked together: 16 MB of marks.
_ROWS_AT_ONCE = 256
_BUCKETS = 64

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass
class Model:
    """Weights of each hashed n-gram, its inverse document frequency included."""

    languages: list[str]
    weights: np.ndarray  # FEATURES x languages
    bias: np.ndarray
    temperature: float = 1.0


@dataclass
class Penalties:
    """Of the optimiser: learning rate, its offset, and the elastic net's two weights."""

    alpha: float = 0.05
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-2
    epochs: int = 4


@dataclass
class _Letters:
    """Unicode letters of the basic plane; others are looked up one by one."""

    low: np.ndarray = field(default_factory=lambda: np.array([chr(i).isalpha() for i in range(1 << 16)]))

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(points, (1 << 16) - 1)]
        for i in np.flatnonzero(points >= 1 << 16):
            out[i] = chr(points[i]).isalpha()
        return out


_letters: list[_Letters] = []


def ngrams(column: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per order, the text and hashed feature of each n-gram; and the number of letters in each text.

    Texts are lower-cased, and each run of what is not a letter is one space.
    """
    if not _letters:
        _letters.append(_Letters())
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    first = starts[offsets]
    letter = _letters[0](points)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    total = np.concatenate([[0], np.cumsum(letter)])
    after_letter = np.zeros(len(points), dtype=bool)
    after_letter[1:] = letter[:-1] & (text[1:] == text[:-1])
    keep = np.flatnonzero(letter | after_letter)
    points, text = np.where(letter[keep], points[keep], np.uint32(32)), text[keep]
    grams, hashed = [], np.zeros(len(points), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        n = max(0, len(points) - order + 1)
        hashed = (hashed[:n] + points[order - 1 :]) * _MULTIPLIERS[order - 1]
        hashed ^= hashed >> np.uint32(15)
        if order in ORDERS:
            same = text[:n] == text[order - 1 :]
            value = (hashed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - FEATURE_BITS)
            grams.append((text[:n][same], value[same]))
    return grams, total[first[1:]] - total[first[:-1]]


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Over all rows of ``docs`` (column text): how many texts have each feature; the last entry counts texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, dtype=np.int64)
        seen = np.zeros((_ROWS_AT_ONCE, FEATURES), dtype=bool)
        for batch in slices(batches, max_bytes=SLICE_BYTES):
            grams, _ = ngrams(batch.column("text"))
            for begin in range(0, batch.num_rows, _ROWS_AT_ONCE):
                seen[:] = False
                for text, feature in grams:
                    own = slice(*np.searchsorted(text, [begin, begin + _ROWS_AT_ONCE]))
                    seen[text[own] - begin, feature[own]] = True
                total[:-1] += np.count_nonzero(seen, axis=0)
            total[-1] += batch.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["feature", "texts"])

    counted = docs.select("text").mapInArrow(run, "feature long, texts long")
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for row in counted.groupBy("feature").agg(F.sum("texts").alias("texts")).toLocalIterator():
        out[row.feature] = row.texts
    return out


def sample_features(docs: DataFrame, per_language: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, features and relative frequencies of at most ``per_language`` documents of each, by a hash of their id.

    Documents are chosen by narrow rows, first in ``_BUCKETS`` parts of each language and then in all, so that no task
    gets more than so many choices of a language; only texts of the chosen ones are read.
    """
    narrow = docs.select("lang", "doc_id", F.xxhash64("doc_id").alias("order"), F.xxhash64("text").alias("version"))
    bucket = F.pmod(F.xxhash64("order", "version"), F.lit(_BUCKETS))
    for part in ([bucket], []):
        rank = F.row_number().over(Window.partitionBy("lang", *part).orderBy("order", "doc_id", "version"))
        narrow = narrow.withColumn("rank", rank).filter(F.col("rank") <= per_language).drop("rank")
    chosen = narrow.distinct().select(*[F.col(c).alias(f"__{c}") for c in ("lang", "doc_id", "version")])
    same = (
        (docs["lang"] == F.col("__lang")) & docs["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.xxhash64(docs["text"]) == F.col("__version"))
    )
    sample = docs.join(chosen, same).select("lang", "text", "__doc_id", "__version").dropDuplicates(["lang", "__doc_id", "__version"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("feature", pa.binary()), ("share", pa.binary())])

        def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
            offsets = pa.py_buffer((ends * values.itemsize).astype(np.int32))
            return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(values)])

        for batch in slices(batches, max_bytes=SLICE_BYTES):
            grams, letters = ngrams(batch.column("text"))
            key = np.concatenate([t * FEATURES + f for t, f in grams])
            key, count = np.unique(key, return_counts=True)
            text, feature = key // FEATURES, key % FEATURES
            share = count / np.maximum(1, np.bincount(text, count, minlength=batch.num_rows))[text]
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            arrays = [
                batch.column("lang"),
                packed(feature.astype(np.int32), ends),
                packed(share.astype(np.float32), ends),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema).filter(pa.array(letters > 0))

    rows = sample.select("lang", "text")
    # Numbers come packed: as lists they would be an object each on the driver.
    rows = rows.mapInArrow(run, "lang string, feature binary, share binary").collect()
    found = [(r.lang, np.frombuffer(r.feature, np.int32).astype(np.int64), np.frombuffer(r.share, np.float32).astype(np.float64)) for r in rows]
    return sorted(found, key=lambda x: (x[0], len(x[1]), x[2].sum(), x[1].tobytes(), x[2].tobytes()))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(
    examples: Sequence[tuple[int, np.ndarray, np.ndarray]], languages: int, penalties: Penalties
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by per-coordinate follow-the-regularised-leader; examples are (language, features, values)."""
    z = np.zeros((FEATURES + 1, languages))
    n = np.zeros((FEATURES + 1, languages))
    p = penalties

    def weights(at):
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= p.l1, 0.0, -(zs - np.sign(zs) * p.l1) / ((p.beta + np.sqrt(ns)) / p.alpha + p.l2))

    random = np.random.default_rng(7)
    for _ in range(p.epochs):
        for i in random.permutation(len(examples)):
            language, at, values = examples[i]
            at, values = np.append(at, FEATURES), np.append(values, 1.0)
            w = weights(at)
            error = softmax(values @ w)
            error[language] -= 1
            gradient = values[:, None] * error
            squared = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(squared) - np.sqrt(n[at])) / p.alpha * w
            n[at] = squared
    w = weights(slice(None))
    return w[:-1], w[-1]


def best_temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss; the truth is smoothed by one example, so that no score becomes certain."""
    if not len(truth):
        return 1.0
    classes = scores.shape[1]
    target = np.full(scores.shape, 1 / (len(truth) + classes))
    target[np.arange(len(truth)), truth] += len(truth) / (len(truth) + classes)
    grid = np.geomspace(0.05, 20, 121)
    loss = [-(target * np.log(softmax(scores / t) + 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, penalties: Penalties | None = None) -> Model:
    """Fit a model on doc_id, text and lang of ``docs``; rows without language or text teach nothing.

    An empty table gives a model without languages, which answers ``und``.
    """
    labelled = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    frequency = document_frequencies(labelled)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    sample = sample_features(labelled, per_language)
    languages = sorted({language for language, _, _ in sample})
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32))
    number = {language: i for i, language in enumerate(languages)}
    scale = 100.0  # of relative frequencies, so that values are near 1
    examples = [(number[language], at, share * idf[at] * scale) for language, at, share in sample]
    random = np.random.default_rng(11).permutation(len(examples))
    back, fit = random[: len(examples) // 5], random[len(examples) // 5 :]
    weights, bias = follow_the_leader([examples[i] for i in fit], len(languages), penalties or Penalties())
    scores = np.array([examples[i][2] @ weights[examples[i][1]] + bias for i in back]).reshape(len(back), len(languages))
    temperature = best_temperature(scores, np.array([examples[i][0] for i in back], dtype=np.int64))
    return Model(languages, (weights * idf[:, None] * scale).astype(np.float32), bias.astype(np.float32), temperature)


def predict(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and calibrated probability of each text."""
    grams, letters = ngrams(column)
    count, classes = len(column), len(model.languages)
    if not classes:
        return [UNKNOWN] * count, np.zeros(count)
    total, size = np.zeros((count, classes)), np.zeros(count)
    for text, feature in grams:
        ends = np.searchsorted(text, np.arange(count + 1))
        filled = np.flatnonzero(np.diff(ends))
        if len(filled):
            total[filled] += np.add.reduceat(model.weights[feature], ends[:-1][filled], axis=0, dtype=np.float64)
            size += np.diff(ends)
    chance = softmax((total / np.maximum(1, size)[:, None] + model.bias) / model.temperature)
    best = chance.argmax(axis=1)
    score = np.where(letters > 0, chance[np.arange(count), best], 0.0)
    return [model.languages[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)], score


def identify(docs: DataFrame, model: Model, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred and score of every whole text.

    A text that is null or has no letter is ``und`` with score 0, an empty table gives no rows. Rows are judged one by one: copies get the same
    answer, and a lang_pred or score that ``docs`` already has is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = T.StructType([source.schema[c] for c in keep])
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE_BYTES):
            languages, score = predict(batch.column("text"), shared.value)
            arrays = [batch.column(c) for c in keep] + [pa.array(languages, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "lang_pred", "score"])

    return source.mapInArrow(run, schema)


def rejected(min_score: float):
    """Condition under which a document's language counts as unknown."""
    return (F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score)
