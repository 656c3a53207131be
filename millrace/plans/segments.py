"""A logistic model for every segment at once, by Newton steps on aggregated sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.running import same_keys
from millrace.session import stored


def _probability(features: list[Column], weights: Column) -> Column:
    terms = [weights[i] * x for i, x in enumerate(features)]
    return 1 / (1 + F.exp(-sum(terms[1:], terms[0])))


def fit_segments(
    rows: DataFrame,
    segment: Sequence[str],
    features: Sequence[str],
    label: str,
    penalty: float = 0.0,
    rounds: int = 15,
    tolerance: float = 1e-9,
) -> DataFrame:
    """(segment, ``weights``, ``n_rows``): intercept first, then one weight per feature.

    Minimises the summed logistic loss plus ``penalty`` / 2 times the squared weights
    (not the intercept). A round is one aggregation: per segment the gradient and the Gram
    matrix of the weighted features, d + d * (d + 1) / 2 sums with map-side partials; then a
    small solve per segment. A segment may hold any share of the rows. Where a
    segment's rows are separable the weights grow by about one a round until ``rounds``
    end them. Rows with a null label or feature are left out; features that do not vary
    share their weight with the intercept (least squares of smallest norm).
    """
    x = ["_x0", *(f"_x{i + 1}" for i in range(len(features)))]
    d = len(x)
    given = rows.select(
        *segment,
        F.lit(1.0).alias("_x0"),
        *(F.col(f).cast("double").alias(f"_x{i + 1}") for i, f in enumerate(features)),
        F.col(label).cast("double").alias("_y"),
    ).dropna(subset=[*x, "_y"])
    given = stored(given, "segments")
    of = [f"_of_{s}" for s in segment]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    ridge = np.diag([0.0] + [penalty] * (d - 1))
    models = given.groupBy(*segment).agg(
        F.array(*([F.lit(0.0)] * d)).alias("weights"), F.count("*").alias("n_rows"), F.lit(1.0).alias("step")
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, steps = [], []
            for weights, sums in zip(batch["weights"], batch["sums"]):
                weights, sums = np.array(weights, float), np.array(sums, float)
                gram = np.zeros((d, d))
                for n, (i, j) in enumerate(pairs):
                    gram[i, j] = gram[j, i] = sums[d + n]
                move = np.linalg.lstsq(gram + ridge, sums[:d] - ridge @ weights, rcond=1e-12)[0]
                # No step beyond what a probability can show.
                move = np.clip(move, -5, 5)
                out.append(weights + move)
                steps.append(float(np.abs(move).max()))
            yield batch.drop(columns=["sums", "weights"]).assign(weights=out, step=steps)

    shape = ", ".join(f"`{s}` {t}" for s, t in rows.select(*segment).dtypes)
    for _ in range(rounds):
        models = stored(models, "models")
        if not models.where(F.col("step") > tolerance).limit(1).count():
            break
        now = models.select(*(F.col(s).alias(o) for s, o in zip(segment, of)), "weights", "n_rows")
        joined = given.join(now, same_keys(segment, of))
        p = _probability([F.col(c) for c in x], F.col("weights"))
        scored = joined.withColumn("_p", p).withColumn("_w", F.col("_p") * (1 - F.col("_p")))
        sums = [F.sum(F.col(c) * (F.col("_y") - F.col("_p"))) for c in x]
        sums += [F.sum(F.col("_w") * F.col(x[i]) * F.col(x[j])) for i, j in pairs]
        models = (
            scored.groupBy(*segment)
            .agg(F.first("weights").alias("weights"), F.first("n_rows").alias("n_rows"), F.array(*sums).alias("sums"))
            .mapInPandas(solve, f"{shape}, n_rows long, weights array<double>, step double")
        )
    return stored(models, "models").select(*segment, "weights", "n_rows")


def score_segments(rows: DataFrame, models: DataFrame, segment: Sequence[str], features: Sequence[str]) -> DataFrame:
    """The rows with ``probability``; null where their segment has no model."""
    of = [f"_of_{s}" for s in segment]
    now = models.select(*(F.col(s).alias(o) for s, o in zip(segment, of)), F.col("weights").alias("_weights"))
    x = [F.lit(1.0), *(F.col(f).cast("double") for f in features)]
    return rows.join(now, same_keys(segment, of), "left").select(
        *rows.columns, _probability(x, F.col("_weights")).alias("probability")
    )
