import json

import numpy as np
import pytest

from millrace.operators.quality import (
    drift_report,
    drift_summary,
    missing_fractions,
    quality_issues,
    quality_report,
)
from millrace.plans.monitoring import latest_drift, monitor, write_reports
from millrace.settings import Settings

TWO = Settings(drift_features=("tenure_months", "monthly_charges"))


@pytest.fixture()
def sample(spark):
    def build(n, charges=65.0, seed=0):
        rng = np.random.default_rng(seed)
        columns = (
            rng.normal(30, 15, n).clip(0),
            rng.normal(charges, 20, n).clip(15),
            rng.normal(2000, 1500, n).clip(0),
        )
        rows = [(i, *map(float, row)) for i, row in enumerate(zip(*columns))]
        return spark.createDataFrame(
            rows, "n int, tenure_months double, monthly_charges double, total_charges double"
        )

    return build


def by_feature(report):
    return {r.feature: r for r in report.collect()}


def test_clean_batch_passes(sample):
    report = quality_report(sample(200)).first()
    assert (report.n_rows_checked, report.issues, report.passed) == (200, [], True)


def test_missing_values_above_the_limit(sample):
    holed = sample(200).selectExpr(
        "n", "tenure_months", "if(n <= 40, NULL, monthly_charges) AS monthly_charges"
    )
    (issue,) = quality_issues(holed).collect()
    assert (issue.column_name, issue.kind) == ("monthly_charges", "missing")
    assert issue.message == (
        "Column 'monthly_charges' has 20.50% missing values (> 5% threshold)"
    )
    assert not quality_report(holed).first().passed


def test_missing_exactly_at_the_limit_passes(spark):
    rows = spark.createDataFrame([(None if i == 0 else 1.0,) for i in range(20)], "a double")
    assert quality_issues(rows).collect() == []


def test_nan_counts_as_missing(spark):
    rows = spark.createDataFrame([(float("nan"), 1), (1.0, None)], "a double, b int")
    got = {r.column_name: r.missing_fraction for r in missing_fractions(rows).collect()}
    assert got == {"a": 0.5, "b": 0.5}


def test_negative_values(sample):
    bad = sample(200).selectExpr("if(n = 0, -5D, tenure_months) AS tenure_months")
    (issue,) = quality_issues(bad).collect()
    assert issue.message == "Column 'tenure_months' has 1 out-of-range (negative) values"


def test_equal_distributions_do_not_drift(sample):
    report = drift_report(sample(2000, seed=1), sample(400, seed=2), TWO)
    assert not any(r.flagged for r in report.collect())
    assert not drift_summary(report).first().drift_detected


def test_shifted_feature_is_flagged_alone(sample):
    report = drift_report(sample(2000, seed=1), sample(400, 200.0, seed=2), TWO)
    rows = by_feature(report)
    assert rows["monthly_charges"].flagged and not rows["tenure_months"].flagged
    assert drift_summary(report).first().drift_detected


def test_no_spread_scores_zero(spark):
    same = spark.createDataFrame([(5, 50.0)] * 100, "tenure_months int, monthly_charges double")
    report = drift_report(same, same.limit(50), TWO)
    assert {r.drift_zscore for r in report.collect()} == {0.0}


def test_undefined_score_is_null_and_not_flagged(spark):
    one = spark.createDataFrame([(5, 50.0)], "tenure_months int, monthly_charges double")
    nan = spark.createDataFrame(
        [(5, float("nan"))] * 3 + [(7, float("nan"))], "tenure_months int, monthly_charges double"
    )
    for train, recent in ((one, one), (nan, nan)):
        row = by_feature(drift_report(train, recent, TWO))["monthly_charges"]
        assert row.drift_zscore is None and row.flagged is False
    assert drift_summary(drift_report(one, one, TWO)).first().max_drift_zscore == 0.0


def test_flag_needs_more_than_the_threshold(spark):
    names = "tenure_months double, monthly_charges double"
    train = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0)], names)
    deviation = 2**0.5
    at = spark.createDataFrame([(1.0 + 2 * deviation, 3.9)], train.schema)
    rows = by_feature(drift_report(train, at, TWO))
    assert rows["tenure_months"].drift_zscore == 2.0
    assert rows["monthly_charges"].flagged
    assert rows["monthly_charges"].drift_zscore > 2.0


def test_missing_feature_is_an_error(sample):
    with pytest.raises(Exception, match="senior_citizen"):
        drift_report(sample(5), sample(5), Settings()).collect()


def test_combined_run_and_stored_reports(spark, sample, tmp_path):
    quality, drift = monitor(sample(500), ["n"], TWO)
    assert quality.first().n_rows_checked == 400
    for row in [*quality.toJSON().collect(), *drift.toJSON().collect()]:
        json.loads(row)
    path = str(tmp_path / "reports")
    assert latest_drift(spark, path).count() == 0
    write_reports(quality, drift, path, 0)
    shifted = drift_report(sample(2000), sample(400, 200.0), TWO)
    write_reports(quality, shifted, path, 1)
    newest = latest_drift(spark, path).first()
    assert newest.batch_id == 1 and newest.drift_detected
