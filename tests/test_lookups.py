"""As-of lookups, hot keys and segment models against plain versions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millrace.operators import aggregates, asof, hot_keys
from millrace.plans import segments

QUICK = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEYS = st.sampled_from(["hot", "hot", "hot", "b", None])
TIMES = st.none() | st.integers(0, 12)


@QUICK
@given(st.lists(st.tuples(KEYS, TIMES, st.integers(0, 99)), max_size=30), st.lists(st.tuples(KEYS, TIMES), max_size=30))
def test_as_of_equals_a_search(spark, history, asked):
    past = spark.createDataFrame([(*h, n) for n, h in enumerate(history)], "k string, t int, v int, n int")
    questions = spark.createDataFrame([(*a, n) for n, a in enumerate(asked)], "k string, t int, q int")
    got = asof.as_of(questions.repartition(4), "t", past.repartition(5), "t", ["v"], ["k"], ["n"]).collect()
    expected = []
    for n, (key, at) in enumerate(asked):
        known = [(t, i, v) for i, (k, t, v) in enumerate(history) if k == key and None not in (t, at) and t <= at]
        expected.append((key, at, n, max(known)[2] if known else None))
    assert sorted(map(tuple, got), key=lambda r: r[2]) == expected


def test_as_of_without_keys_and_with_clashing_names(spark):
    past = spark.createDataFrame([(5, "a"), (7, "b")], "t int, v string")
    got = asof.as_of(spark.range(4, 9).selectExpr("CAST(id AS int) AS t"), "t", past, "t", ["v"])
    assert sorted(map(tuple, got.collect())) == [(4, None), (5, "a"), (6, "a"), (7, "b"), (8, "b")]
    with pytest.raises(ValueError, match="already"):
        asof.as_of(past, "t", past, "t", ["v"])


def test_states_of_batches_name_the_keys_of_all(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, None).otherwise(F.col("id").cast("string"))
    rows = spark.range(30_000).select(key.alias("k"), F.col("id").alias("n"), (F.col("id") % 4).alias("batch"))
    whole = hot_keys.hot_digests(hot_keys.hot_key_state(rows, ["k"]), 0.02)
    parts = hot_keys.hot_digests(hot_keys.hot_key_state(rows, ["k"], ["batch"]), 0.02)
    named = spark.createDataFrame([("hot",), (None,)], "k string").select(F.xxhash64("k")).collect()
    assert set(whole) == set(parts) == {r[0] for r in named}
    assert hot_keys.hot_digests(hot_keys.hot_key_state(rows.limit(0), ["k"]), 0.02) == []

    measures = {"n_rows": aggregates.Measure("count"), "total": aggregates.Measure("sum", "n")}
    salted = hot_keys.selectively_salted_agg(rows, ["k"], measures, ["n"], share=0.02)
    plain = aggregates.keyed_agg(rows, ["k"], measures)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    # Only the branch of the hot keys has a second aggregation, over salted keys.
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    rest, hot = plan.split("\n+- ", 1)
    assert rest.count("Aggregate [") == 1
    assert hot.count("Aggregate [") == 2


def test_one_segment_equals_mllib(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.5, -0.7] + 0.3)))).astype(int)
    rows = spark.createDataFrame([("s", *map(float, r), int(t)) for r, t in zip(x, y)], "s string, a double, b double, y int")
    ours = segments.fit_segments(rows, ["s"], ["a", "b"], "y", penalty=1.0).first()
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    theirs = LogisticRegression(labelCol="y", regParam=1 / 400, standardization=False, tol=1e-12, maxIter=200).fit(vectors)
    assert ours.n_rows == 400
    assert np.allclose(ours.weights, [theirs.intercept, *theirs.coefficients], atol=1e-6)


def test_segments_with_one_class_constant_features_and_nulls(spark):
    rows = [("all", 1, 1)] * 5 + [("none", 0, 0)] * 5 + [(None, 0, 1), (None, 0, 0), (None, 1, 0), ("gap", None, 1)]
    df = spark.createDataFrame(rows, "s string, x int, y int")
    models = segments.fit_segments(df, ["s"], ["x"], "y")
    got = {(r.s, r.x): r.probability for r in segments.score_segments(df.distinct(), models, ["s"], ["x"]).collect()}
    assert got["all", 1] > 0.9999 and got["none", 0] < 0.0001 and got["gap", None] is None
    assert math.isclose(got[None, 0], 0.5, abs_tol=1e-6) and got[None, 1] < 0.0001
    assert segments.fit_segments(df.limit(0), ["s"], ["x"], "y").collect() == []
