"""Quality by co-training a text view and a metadata view.

The text view is a logistic regression over hashed words and word pairs; the
metadata view one over source, language, size and layout figures, which are
column expressions. Both start from the labelled rows; in each round each view
names the unlabelled rows it is surest of, in the labels' proportion, and the
other view learns from them. Each view's score is then calibrated by Platt's
scaling on rows it did not learn from, and the calibrated log-odds are averaged
by their weight on these rows.

Each round scores every row that is not held out and names the surest unlabelled ones by
a distributed top-k, so the pool is the whole table. Rows of labels meet ids and scores,
never texts. Fitting is in one task, on at most
``max_rows`` labelled rows, chosen by the hash of their id, and ``named`` rows per view
and round. Weights are bounded by their tables' sizes.

Nulls: a null text is an empty one, null metadata is a value of its own, rows
with a null label or id are not learned from; of several labels for an id the
highest counts. Without labels of both kinds every score is the smoothed base
rate, 0 if there are no labels at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.common import text_or_empty, written
from millrace.llm.hashed import gram_sets, weighted_sums


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    rounds: int = 2
    #: Share of the unlabelled rows that each view names per round, and at most so many rows.
    grow: float = 0.08
    named: int = 320
    #: Part of the labelled rows kept for calibration.
    calibration: float = 0.2
    max_rows: int = 8_000
    text: toxicity.Settings = toxicity.Settings(bits=18, rounds=3)


_SOURCES = 256
_LANGUAGES = 32
_FIGURES = 9
_WIDTH = _SOURCES + _LANGUAGES + _FIGURES
_VIEWS = ("quality_text", "quality_metadata")
#: ASCII characters that layout figures count: digits, line ends, capitals, signs, sentence ends.
_MARKS = ("0123456789", "\n", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "|#%&*$<>{}", ".!?")
_MARK_OF_BYTE = np.array([[chr(byte) in kind for kind in _MARKS] for byte in range(256)], float)


def _bucket(column: str, size: int) -> Column:
    """A name's bucket; null has one of its own."""
    known = F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(size - 1)).cast("int")
    return F.when(F.col(column).isNull(), F.lit(size - 1)).otherwise(known)


def mark_counts(texts) -> np.ndarray:
    """How many characters of each kind of marks each text holds, from its bytes in one pass."""
    out = np.zeros((len(texts), len(_MARKS)))
    for row, text in enumerate(texts):
        of_byte = np.bincount(np.frombuffer((text or "").encode(), np.uint8), minlength=256)
        out[row] = of_byte @ _MARK_OF_BYTE
    return out


def _counted() -> Column:
    @F.pandas_udf("array<double>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series(list(mark_counts(texts)))

    return counted(F.col("text").cast("string"))


def figures(docs: DataFrame, marks: Column | None = None) -> dict[str, Column]:
    """Metadata of a document: buckets of source and language, and layout figures.

    ``marks`` are its mark counts, if something else counts them.
    """
    text = text_or_empty()
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    marks = _counted() if marks is None else marks

    def share(kind: int) -> Column:
        return marks[kind] / n

    words = F.size(F.split(text, r"\s+"))
    values = [
        F.log(n) / 10,
        F.log(words + 1.0) / 10,
        n / words / 20,
        share(0),
        F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", "")) / n,
        share(1) * 10,
        share(2),
        share(3) * 5,
        share(4) * 10,
    ]
    return {
        "quality_source": _bucket("source", _SOURCES) if "source" in docs.columns else F.lit(0),
        "quality_lang": _bucket("lang", _LANGUAGES) if "lang" in docs.columns else F.lit(0),
        "quality_figures": F.array(*values),
    }


@dataclass(frozen=True)
class Model:
    bits: int
    slots: np.ndarray
    weights: np.ndarray
    bias: float
    metadata: np.ndarray
    #: Slope and offset of each view's calibration, and the views' shares.
    text_scale: tuple[float, float]
    metadata_scale: tuple[float, float]
    shares: tuple[float, float]
    #: Share of ones among the labels, None if they are not of both kinds.
    rate: float | None = None


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of x is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _metadata_rows(source, lang, values) -> np.ndarray:
    out = np.zeros((len(source), _WIDTH + 1))
    at = np.arange(len(source))
    out[at, source] = 1
    out[at, _SOURCES + lang] = 1
    out[:, _SOURCES + _LANGUAGES : -1] = values
    out[:, -1] = 1
    return out


def _fit_views(texts, metadata: np.ndarray, labels: np.ndarray, named: list, s: Settings) -> Model:
    """Fit both views on labels and, per view, on what the other named; nan where nothing is."""
    sets = gram_sets(texts, s.bits, skips=False)
    known = np.flatnonzero(~np.isnan(labels))
    every = max(2, round(1 / s.calibration))
    kept = known[::every]
    learned = np.setdiff1d(known, kept)
    rate = labels[learned].mean()
    given = []
    for pseudo in named:
        of_view = pseudo.copy()
        of_view[known] = np.nan
        of_view[learned] = labels[learned]
        given.append(of_view)

    rows = np.flatnonzero(~np.isnan(given[0]))
    text = toxicity.Ftrl(s.text, np.log(rate / (1 - rate)), len(rows))
    order = np.random.default_rng(0).permutation(rows)
    for _ in range(s.text.rounds):
        for i in order.tolist():
            text.learn(sets[i], given[0][i])
    rows = np.flatnonzero(~np.isnan(given[1]))
    meta = _logistic(metadata[rows], given[1][rows], 1.0)

    weights = text.at(slice(None))
    scores = [np.array([text.bias + weights[x].sum() for x in sets]), metadata @ meta]
    scales, worth = [], []
    for score in scores:
        x = np.stack([score[kept], np.ones(len(kept))], axis=1)
        slope, offset = _logistic(x, labels[kept], 0.01)
        scales.append((max(float(slope), 0.0), float(offset)))
        worth.append(max(float(slope), 0.0) * float(score[kept].std()))
    total = sum(worth)
    shares = tuple(w / total for w in worth) if total else (0.5, 0.5)
    slots = np.flatnonzero(weights)
    return Model(
        s.bits, slots, weights[slots], float(text.bias), meta, scales[0], scales[1], shares, float(rate)
    )


def _flat(bias: float, s: Settings) -> Model:
    """A model that scores ``bias`` everywhere."""
    empty = np.empty(0, np.int64)
    return Model(
        s.bits, empty, np.empty(0), 0.0, np.zeros(_WIDTH + 1), (1.0, bias), (1.0, bias), (0.5, 0.5)
    )


def surest(odds: DataFrame, column: str, number: int, rate: float) -> list[tuple[int, float]]:
    """(doc_id, label) of the rows a view is surest of, at least one of either kind, by ``rate``.

    Each kind is a top-k over all rows; ties go to the smaller id. A row that is among both,
    as there are few, counts as the likelier kind.
    """
    high, low = max(1, round(number * rate)), max(1, round(number * (1 - rate)))
    sure = F.col(column)
    ones = odds.orderBy(sure.desc(), "doc_id").limit(high).collect()
    zeros = odds.orderBy(sure, "doc_id").limit(low).collect()
    found = {row.doc_id: 0.0 for row in zeros if row[column] < 0}
    found |= {row.doc_id: 1.0 for row in ones if row[column] >= 0}
    found |= {row.doc_id: 0.0 for row in zeros if row.doc_id not in found and row not in ones}
    found |= {row.doc_id: 1.0 for row in ones if row.doc_id not in found}
    return sorted(found.items())


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit both views, then let each name unlabelled rows for the other, ``rounds`` times."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~toxicity.held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(s.max_rows)
        .select("doc_id", "label", *(F.lit(None).cast("double").alias(v) for v in _VIEWS))
    )
    learned = written(known, "labels")
    model = _fitted(docs, learned, s)
    if model.rate is None or not s.rounds:
        return model
    pool = docs.where(F.col("doc_id").isNotNull() & ~toxicity.held_out())
    parts = figures(pool)
    metadata = _unlabelled(pool.select("doc_id", *(c.alias(n) for n, c in parts.items())), labels)
    stored = {n: F.col(n) for n in parts}
    number = min(s.named, int(s.grow * metadata.count()))
    named: dict[int, dict[str, float]] = {}
    for _ in range(s.rounds if number else 0):
        of_view = {
            "quality_text": _unlabelled(pool.select("doc_id", _text_odds(pool, model).alias("quality_text")), labels),
            "quality_metadata": metadata.select("doc_id", _metadata_odds(stored, model).alias("quality_metadata")),
        }
        for view, other in zip(_VIEWS, reversed(_VIEWS)):
            # At most 2 x rounds x (named + 1) rows were named.
            taken = docs.sparkSession.createDataFrame([(i,) for i in named], "doc_id long")
            free = of_view[view].join(F.broadcast(taken), "doc_id", "left_anti")
            for doc_id, label in surest(free, view, number, model.rate):
                named[doc_id] = {other: label}
        pseudo = docs.sparkSession.createDataFrame(
            [(i, None, *(of.get(v) for v in _VIEWS)) for i, of in named.items()], learned.schema
        )
        model = _fitted(docs, learned.unionByName(pseudo), s)
    return model


def _unlabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose id has no label, written; doc_id as long.

    The rows are written before the join as well, or the optimizer joins first and texts
    are shuffled where only ids and numbers need be.
    """
    free = written(rows, "scored").join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    return written(free.withColumn("doc_id", F.col("doc_id").cast("long")), "unlabelled")


def _fitted(docs: DataFrame, learned: DataFrame, s: Settings) -> Model:
    """Fit both views in one task on the rows ``learned`` names, whose number is bounded."""
    names = [c for c in ("source", "lang") if c in docs.columns]
    rows = docs.select("doc_id", "text", *names).join(F.broadcast(learned), "doc_id")
    rows = rows.withColumns(figures(rows)).drop(*names)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        every = pd.concat(frames) if frames else pd.DataFrame({"label": []})
        labels = every["label"].to_numpy(float)
        seen = labels[~np.isnan(labels)]
        if len(seen) and 0 < seen.sum() < len(seen) and len(seen) >= 20:
            order = np.argsort(every["doc_id"].to_numpy(), kind="stable")
            every, labels = every.iloc[order], labels[order]
            meta = _metadata_rows(
                every["quality_source"].to_numpy(),
                every["quality_lang"].to_numpy(),
                np.stack(every["quality_figures"].to_list()),
            )
            named = [every[v].to_numpy(float) for v in _VIEWS]
            model = _fit_views(every["text"], meta, labels, named, s)
        elif len(seen):
            model = _flat(float(np.log((seen.sum() + 0.5) / (len(seen) - seen.sum() + 0.5))), s)
        else:
            model = _flat(-35.0, s)
        rate = -1.0 if model.rate is None else model.rate
        numbers = [model.bias, *model.text_scale, *model.metadata_scale, *model.shares, rate]
        parts = (
            ("text", model.slots, model.weights),
            ("metadata", np.arange(len(model.metadata)), model.metadata),
            ("numbers", np.arange(len(numbers)), np.array(numbers)),
        )
        for name, at, values in parts:
            yield pd.DataFrame({"part": name, "at": at, "value": values})

    found = rows.repartition(1).mapInPandas(learn, "part string, at long, value double").collect()
    if not found:
        return _flat(-35.0, s)
    part: dict[str, list] = {"text": [], "metadata": [], "numbers": []}
    for row in sorted(found):
        part[row.part].append((row["at"], row.value))
    numbers = [v for _, v in part["numbers"]]
    return Model(
        s.bits,
        np.array([a for a, _ in part["text"]], np.int64),
        np.array([v for _, v in part["text"]], float),
        numbers[0],
        np.array([v for _, v in part["metadata"]]),
        (numbers[1], numbers[2]),
        (numbers[3], numbers[4]),
        (numbers[5], numbers[6]),
        numbers[7] if numbers[7] >= 0 else None,
    )


def _text_odds(docs: DataFrame, model: Model) -> Column:
    """Log-odds of the text view, not calibrated."""
    return _text_figures(docs, model, False)[0] + model.bias


def _text_figures(docs: DataFrame, model: Model, marks: bool = True) -> Column:
    """The sum of a text's weights and, if asked for, its mark counts: an array made in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights))
    bits = model.bits

    @F.pandas_udf("array<double>")
    def summed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(1 << bits)
        weights[sent.value[0]] = sent.value[1]
        for texts in batches:
            found = weighted_sums(texts, weights, bits, skips=False)[:, None]
            yield pd.Series(list(np.hstack([found, mark_counts(texts)]) if marks else found))

    return summed(F.col("text").cast("string"))


def _metadata_odds(parts: dict[str, Column], model: Model) -> Column:
    """Log-odds of the metadata view, not calibrated, from :func:`figures`."""
    w = [float(x) for x in model.metadata]
    layout = sum(
        (F.element_at(parts["quality_figures"], i + 1) * w[_SOURCES + _LANGUAGES + i])
        for i in range(_FIGURES)
    )
    return (
        F.element_at(F.lit(w[:_SOURCES]), parts["quality_source"] + 1)
        + F.element_at(F.lit(w[_SOURCES : _SOURCES + _LANGUAGES]), parts["quality_lang"] + 1)
        + layout
        + w[-1]
    )


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with quality, quality_text and quality_metadata from 0 to 1."""

    def chance(odds: Column) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), odds))))

    scales = (model.text_scale, model.metadata_scale)
    found = _text_figures(docs, model)
    parts = figures(docs, F.slice(found, 2, len(_MARKS)))
    odds = (found[0] + model.bias, _metadata_odds(parts, model))
    rows = docs.withColumns(dict(zip(_VIEWS, odds))).withColumns(
        {view: F.col(view) * slope + offset for view, (slope, offset) in zip(_VIEWS, scales)}
    )
    both = F.col("quality_text") * model.shares[0] + F.col("quality_metadata") * model.shares[1]
    return rows.withColumn("quality", chance(both)).withColumns({v: chance(F.col(v)) for v in _VIEWS})
