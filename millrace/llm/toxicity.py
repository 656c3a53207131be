"""Toxicity: FTRL-proximal logistic regression over hashed word grams.

Features are the distinct hashed words, word pairs and pairs around one word of
the whole text. Each coordinate has its own learning rate; the L1 term leaves
few non-zero weights, so the model that is sent to every task is small and in no
case larger than 2**bits weights.

The model is fitted on at most ``max_rows`` labelled rows, chosen by the hash of
their id, in one task; scoring reads every row. Nulls: a null text scores as an
empty one, rows with a null label or id are not learned from; of several labels
for an id the highest counts. Without labels of both kinds the model has no
weights and scores the smoothed base rate, 0 if there are no labels at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.hashed import gram_sets, weighted_sums


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 0.2
    beta: float = 1.0
    #: Times the root of the number of rows: the sum of chance gradients grows so.
    l1: float = 0.3
    l2: float = 0.1
    rounds: int = 3
    #: Most labelled rows to learn from.
    max_rows: int = 16_000


@dataclass(frozen=True)
class Model:
    bias: float
    slots: np.ndarray
    weights: np.ndarray
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.slots] = self.weights
        return out


class Ftrl:
    """Weights over 2**bits slots and a bias that is not regularised."""

    def __init__(self, s: Settings, base: float, rows: int) -> None:
        self.s = s
        self.l1 = s.l1 * rows**0.5
        self.z = np.zeros(1 << s.bits)
        self.n = np.zeros(1 << s.bits)
        self.bias = base
        self.bias_n = 0.0

    def at(self, slots) -> np.ndarray:
        z, s = self.z[slots], self.s
        rate = (s.beta + np.sqrt(self.n[slots])) / s.alpha + s.l2
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / rate, 0.0)

    def learn(self, slots: np.ndarray, label: float) -> None:
        weights = self.at(slots)
        g = 1 / (1 + np.exp(-np.clip(self.bias + weights.sum(), -35, 35))) - label
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * weights
        self.n[slots] = n + g * g
        self.bias_n += g * g
        self.bias -= self.s.alpha / (self.s.beta + np.sqrt(self.bias_n)) * g


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the documents, by the checksum of the id's text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, column: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled rows that are not held out."""
    known = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(column).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, labels_seen, ids = [], [], []
        for batch in batches:
            sets += gram_sets(batch["text"], s.bits)
            labels_seen += batch["label"].tolist()
            ids += batch["doc_id"].tolist()
        positive = sum(labels_seen)
        base = np.log((positive + 0.5) / (len(labels_seen) - positive + 0.5))
        model = Ftrl(s, base, len(sets))
        if 0 < positive < len(labels_seen):
            order = np.lexsort((ids, np.array(ids, np.int64) * np.int64(-7046029254386353131)))
            for _ in range(s.rounds):
                for i in order:
                    model.learn(sets[i], labels_seen[i])
        weights = model.at(slice(None))
        slots = np.flatnonzero(weights)
        if labels_seen:
            yield pd.DataFrame({"slot": [-1], "weight": [model.bias]})
        yield pd.DataFrame({"slot": slots, "weight": weights[slots]})

    sample = training_sample(docs, labels, "toxic", s.max_rows)
    rows = sample.repartition(1).mapInPandas(learn, "slot long, weight double").collect()
    bias = next((r.weight for r in rows if r.slot < 0), -35.0)
    kept = sorted((r.slot, r.weight) for r in rows if r.slot >= 0)
    return Model(
        float(bias),
        np.array([x for x, _ in kept], np.int64),
        np.array([x for _, x in kept], float),
        s.bits,
    )


def scored(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """The documents with a score from 0 to 1 in a column of that name."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = sent.value.dense()
        for texts in batches:
            sums = sent.value.bias + weighted_sums(texts, weights, sent.value.bits)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -35, 35))))

    return docs.withColumn(name, score(F.col("text").cast("string")))
