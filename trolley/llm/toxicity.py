"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a logistic score from its words; noisy-or joins
them: the document is toxic unless all its sentences are innocent. Weights are learned from document
labels alone, and the sentence scores then show where a document offends.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents the model is fitted on, at most, by label; the rows with the smallest hash.
SAMPLE = {1: 2_000, 0: 6_000}
#: Features that the fitted model has at most; they occur in at least so many sampled documents.
FEATURES, SUPPORT = 8_192, 4
THRESHOLD = 0.3
HELD_OUT = 2
SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")
#: A word counts as a whole and by beginnings of these lengths.
STEMS = (4, 5, 6, 7)
#: Words whose weight a task keeps at once.
CACHE = 1 << 15


def sentences(text: str | None) -> list[str]:
    return [s for s in SENTENCE.split((text or "").lower()) if s.strip()]


def words(sentence: str) -> list[str]:
    """The distinct words of a sentence, in order."""
    return list(dict.fromkeys(WORD.findall(sentence)))


def word_features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    return [xxhash.xxh64_intdigest(f"={word}") >> 1] + [xxhash.xxh64_intdigest(f"{word[:n]}") >> 1 for n in STEMS if len(word) >= n]


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT


@dataclass
class Model:
    """Weights by feature, and the score of a sentence without any."""

    weights: dict[int, float]
    bias: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer(dict):
    """Weight of a word, kept once worked out."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        known = self.model.weights
        self[word] = weight = sum(known.get(f, 0.0) for f in word_features(word))
        return weight

    def innocence(self, sentence: str) -> float:
        """Minus the log of the chance that a sentence is innocent."""
        z = self.model.bias + sum(map(self.__getitem__, words(sentence)))
        return math.log1p(math.exp(z)) if z < 30 else z

    def score(self, text: str | None) -> float:
        return -math.expm1(-sum(map(self.innocence, sentences(text))))


def sample(docs: DataFrame, labels: DataFrame, sizes: dict[int, int] = SAMPLE) -> DataFrame:
    """(text, label) of at most ``sizes[label]`` labelled documents outside the held-out part.

    A document with several label rows is toxic if one says so. The ids that are chosen are bounded by
    ``sizes``, hence broadcast.
    """
    known = labels.where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = [known.where(F.col("label") == y).orderBy(*order).limit(n) for y, n in sizes.items()]
    ids = chosen[0].unionAll(chosen[1])
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "label")


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each label have a feature, added up within a task."""
    found: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found[label].update({f for w in words((text or "").lower()) for f in word_features(w)})
    features = [*(found[0].keys() | found[1].keys())]
    yield pa.RecordBatch.from_arrays(
        [pa.array(features, pa.int64()), *(pa.array([found[y][f] for f in features], pa.int64()) for y in (0, 1))], ["feature", "clean", "toxic"]
    )


def choose_features(rows: DataFrame, sizes: dict[int, int], most: int = FEATURES) -> list[int]:
    """The features whose document counts differ most between the labels (signed root of G)."""
    counts = rows.mapInArrow(_document_counts, "feature bigint, clean bigint, toxic bigint")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    best = counts.where(F.col("clean") + F.col("toxic") >= SUPPORT).withColumn("gain", F.abs(odds) * F.sqrt(F.col("clean") + F.col("toxic")))
    return [r[0] for r in best.where(F.abs(odds) > 0.7).orderBy(F.desc("gain"), "feature").limit(most).collect()]


def _bags(rows: DataFrame, features: list[int]) -> DataFrame:
    """Per document: label, number of sentences, and the places of the chosen features in each
    sentence that has any."""
    place = {f: i for i, f in enumerate(features)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = [[place[f] for w in words(s) for f in word_features(w) if f in place] for s in sentences(text)]
                out.append((label, len(own), [x for x in own if x]))
            columns = zip(*out, strict=True) if out else ((), (), ())
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["label", "n", "found"])

    return rows.mapInArrow(run, "label int, n bigint, found array<array<int>>")


def fit(docs: DataFrame, labels: DataFrame, sizes: dict[int, int] = SAMPLE, steps: int = 300, decay: float = 3e-3) -> Model:
    """Fit on a bounded sample: noisy-or likelihood of the document labels, by gradient steps (Adam).

    Of the sample, only the chosen features of its sentences come to the driver. Without documents of
    both labels the model calls everything innocent.
    """
    rows = sample(docs, labels, sizes)
    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not seen.get(0) or not seen.get(1):
        return Model({}, -12.0)
    features = choose_features(rows, seen)
    bags = _bags(rows, features).toArrow()
    label, n = (bags.column(c).to_numpy() for c in ("label", "n"))
    found = bags.column("found").combine_chunks()
    per_doc = np.diff(found.offsets.to_numpy())
    inner = found.flatten()
    per_sentence = np.diff(inner.offsets.to_numpy()) if len(inner) else np.empty(0, int)
    column = inner.flatten().to_numpy() if len(inner) else np.empty(0, int)
    sentence = np.repeat(np.arange(len(per_sentence)), per_sentence)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    plain = n - per_doc
    weights = np.zeros(len(features) + 1)
    weights[-1] = -6.0
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        bias = weights[-1]
        z = bias + np.bincount(sentence, weights[column], len(per_sentence))
        total = np.bincount(doc, np.logaddexp(0, z), len(per_doc)) + plain * np.logaddexp(0, bias)
        push = np.where(label == 1, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        slope = push[doc] / (1 + np.exp(-z))
        gradient = np.append(
            np.bincount(column, slope[sentence], len(features)), slope.sum() + (push * plain).sum() / (1 + np.exp(-bias))
        ) / len(label)
        gradient[:-1] += decay / len(label) * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        weights -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Model({f: float(w) for f, w in zip(features, weights, strict=False) if abs(w) > 1e-4}, float(weights[-1]))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Only ``text`` is looked at; equal texts score alike, and a text without sentences, or NULL, scores
    0. Columns of these names are replaced, others stay. Rows go one to one; nothing is shuffled.
    """
    plain = docs.drop("score", "predicted")
    at = plain.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            score = [scorer.score(t.as_py()) for t in batch.column(at)]
            flags = [int(s >= threshold) for s in score]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score, pa.float64()), pa.array(flags, pa.int32())], [*batch.schema.names, "score", "predicted"]
            )

    return plain.mapInArrow(run, f"{schema}, score double, predicted int")


def offending(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence number, sentence, score) of the sentences that score at least ``least``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            rows = [
                {"doc_id": d, "sentence_no": i, "sentence": s, "score": p}
                for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for i, s in enumerate(sentences(t))
                if (p := -math.expm1(-scorer.innocence(s))) >= least
            ]
            kinds = pa.schema([("doc_id", pa.int64()), ("sentence_no", pa.int64()), ("sentence", pa.string()), ("score", pa.float64())])
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, sentence_no bigint, sentence string, score double")
