import pytest
from pyspark.sql import functions as F

from millrace.operators import promotion
from millrace.plans.monitoring import retrain_check
from millrace.settings import Settings

SIGNALS = (
    "days_since_last_training int, recent_labeled_auc double, production_auc double, "
    "drift_zscore double"
)


def decide(spark, candidate, baseline):
    df = spark.createDataFrame([(candidate, baseline)], "c double, b double")
    promoted, reason = promotion.candidate_vs_baseline(F.col("c"), F.col("b"))
    return tuple(df.select(promoted, reason).first())


def test_strong_candidate(spark):
    assert decide(spark, 0.85, 0.75) == (
        True,
        "Promoted candidate: val ROC AUC 0.85 >= 0.8 and within 0.01 of baseline (0.75).",
    )


def test_weak_candidate_gets_both_reasons(spark):
    assert decide(spark, 0.6, 0.75) == (
        False,
        "Kept baseline: candidate val ROC AUC 0.6 < floor 0.8; "
        "candidate val ROC AUC 0.6 regresses more than 0.01 vs baseline 0.75",
    )


@pytest.mark.parametrize(
    ("candidate", "baseline", "promoted"),
    [
        (0.8, 0.8, True),
        (0.7999, 0.7, False),
        # 0.85 - 0.84 is a little more than 0.01 as doubles.
        (0.84, 0.85, False),
        (0.8263, 0.8314, True),
        (None, 0.8, False),
    ],
)
def test_limits(spark, candidate, baseline, promoted):
    assert decide(spark, candidate, baseline)[0] is promoted


def segment_decision(spark, base_val, cand_val, base_test, cand_test, incumbent):
    metrics = spark.createDataFrame(
        [(None, base_val, cand_val, base_test, cand_test)],
        "segment string, baseline_val_auc double, candidate_val_auc double, "
        "baseline_test_auc double, candidate_test_auc double",
    )
    rows = [] if incumbent is None else [(None, incumbent)]
    incumbents = spark.createDataFrame(rows, "segment string, production_auc double")
    return promotion.decide_segments(metrics, incumbents, ["segment"], Settings()).first()


def test_first_model_needs_no_floor(spark):
    row = segment_decision(spark, 0.5, 0.4, 0.3, 0.2, None)
    assert (row.model_type, row.promoted, row.new_test_auc) == ("logistic_regression", True, 0.3)
    assert row.promotion_reason.startswith("No model currently in production")


def test_tie_with_production_is_promoted_with_the_published_text(spark):
    row = segment_decision(spark, 0.8314, 0.8263, 0.8518, 0.8473, 0.8473)
    assert row.model_type == "random_forest" and row.promoted
    assert row.promotion_reason == (
        "Promoted retrained model: test ROC AUC 0.8473 >= 0.8 and within 0.01 of "
        "current production model (0.8473)."
    )


def test_stronger_production_stays(spark):
    row = segment_decision(spark, 0.8314, 0.8263, 0.8518, 0.8473, 0.95)
    assert not row.promoted
    assert row.promotion_reason == (
        "Kept current production model: retrained model's test ROC AUC 0.8473 "
        "regresses more than 0.01 vs current production model 0.95"
    )


@pytest.mark.parametrize(
    ("signals", "reasons"),
    [
        ((2, 0.85, 0.85, 0.1), []),
        ((8, None, 0.85, 0.1), ["8 days of new data >= minimum 7"]),
        ((1, 0.80, 0.85, 0.1), ["recent labeled AUC dropped by 0.050 >= threshold 0.03"]),
        ((1, 0.83, 0.85, 0.1), []),
        ((1, None, 0.85, 2.5), ["drift z-score 2.50 >= threshold 2.0"]),
        (
            (10, 0.70, 0.85, 3.0),
            [
                "10 days of new data >= minimum 7",
                "recent labeled AUC dropped by 0.150 >= threshold 0.03",
                "drift z-score 3.00 >= threshold 2.0",
            ],
        ),
        ((1, None, 0.85, 0.1), []),
        (
            (7, None, None, 2.0),
            ["7 days of new data >= minimum 7", "drift z-score 2.00 >= threshold 2.0"],
        ),
    ],
)
def test_trigger_table(spark, signals, reasons):
    row = promotion.retrain_decisions(spark.createDataFrame([signals], SIGNALS)).first()
    assert row.triggered_by == reasons
    assert row.should_retrain is bool(reasons)


def test_signals_from_reports(spark):
    registry = spark.createDataFrame([], promotion.REGISTRY)
    drift = spark.createDataFrame([], "max_drift_zscore double")
    row = retrain_check(1, None, registry, drift).first()
    assert (row.production_auc, row.drift_zscore, row.should_retrain) == (0.0, 0.0, False)
    production = spark.createDataFrame(
        [(0, "v", "random_forest", True, "", None, [], (0.7938, 0.8473, 1057), "")],
        promotion.REGISTRY,
    )
    drift = spark.createDataFrame([(0.036,)], "max_drift_zscore double")
    row = retrain_check(8, None, production, drift).first()
    assert (row.production_auc, row.drift_zscore) == (0.8473, 0.036)
    assert row.triggered_by == ["8 days of new data >= minimum 7"]


def test_registry_status(spark):
    rows = spark.createDataFrame(
        [("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 4, False), (None, 5, True)],
        "segment string, sequence long, promoted boolean",
    )
    status = promotion.with_status(rows, ["segment"]).orderBy("sequence").collect()
    expected = ["archived", "rejected", "production", "rejected", "production"]
    assert [r.status for r in status] == expected
    current = promotion.production_models(rows, ["segment"]).collect()
    assert {(r.segment, r.sequence) for r in current} == {("a", 3), (None, 5)}
    assert promotion.production_models(rows.where("sequence > 9")).count() == 0
