"""Profiles of batches against those of all their rows."""

from __future__ import annotations

import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.profiles import drift_from_profiles, issues, merged, moments, profile
from millrace.operators.quality import drift_report, quality_report
from millrace.settings import Settings

FEW = Settings(drift_features=("v", "w"), non_negative_columns=("v",), max_missing_fraction=0.2)
NUMBERS = st.one_of(st.none(), st.just(float("nan")), st.integers(-5, 5).map(float), st.just(1e9))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), NUMBERS, st.integers(0, 3), st.none() | st.just("x")), max_size=30))
def test_merged_profiles_are_that_of_all_rows(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double, w int, s string")
    whole = {r.feature: r for r in moments(profile(df, ["v", "w", "s"])).collect()}
    parts = {r.feature: r for r in moments(merged(profile(df, groups=["g"]))).collect()}
    assert set(whole) == {"v", "w", "s"} and set(parts) == (set(whole) if rows else set())
    for name, one in whole.items():
        if not rows:
            assert one.n_rows == one.n == 0 and one.mean is None
            continue
        two = parts[name]
        assert (one.position, one.n_rows, one.n, one.missing, one.negative) == (
            two.position, two.n_rows, two.n, two.missing, two.negative,
        )
        values = [r[{"v": 1, "w": 2, "s": 3}[name]] for r in rows]
        values = [] if name == "s" else [v for v in values if v is not None and not math.isnan(v)]
        assert one.n == len(values) and one.negative == sum(v < 0 for v in values)
        for found in (one, two):
            assert (found.mean is None) == (not values)
            if values:
                assert math.isclose(found.mean, statistics.mean(values), rel_tol=1e-12, abs_tol=1e-12)
            if len(values) > 1:
                assert math.isclose(found.std, statistics.stdev(values), rel_tol=1e-9, abs_tol=1e-9)
            else:
                assert found.std is None


def test_a_large_common_offset_does_not_cancel(spark):
    df = spark.range(3000).selectExpr("1e12D + id % 3 AS v", "id % 7 AS g")
    row = moments(merged(profile(df, groups=["g"]))).first()
    assert math.isclose(row.std, statistics.stdev([i % 3 for i in range(3000)]), rel_tol=1e-6)


def test_reports_from_profiles_equal_those_from_rows(spark):
    train = spark.range(40).selectExpr("CAST(id AS double) AS v", "CAST(3 AS int) AS w", "'x' AS s")
    recent = spark.createDataFrame([(90.0, 1, None), (-1.0, 3, "x"), (None, 3, None)], "v double, w int, s string")
    by_row = lambda df: sorted(map(str, df.collect()))
    assert by_row(drift_from_profiles(profile(train), profile(recent), FEW)) == by_row(
        drift_report(train, recent, FEW)
    )
    assert by_row(issues(profile(recent), FEW)) == by_row(quality_report(recent, FEW))
    assert by_row(issues(profile(recent.limit(0)), FEW)) == by_row(quality_report(recent.limit(0), FEW))
    groups = recent.withColumn("g", F.lit(None).cast("string")).unionByName(recent.withColumn("g", F.lit("b")))
    both = drift_from_profiles(profile(train), profile(groups, groups=["g"]), FEW, ["g"])
    assert by_row(both) == by_row(drift_report(train, groups, FEW, ["g"]))
