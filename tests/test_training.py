from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.features import to_model_matrix
from millrace.operators.promotion import REGISTRY, with_status
from millrace.plans import catalog, training, views
from millrace.settings import Settings
from millrace.sources.tables import read_or_empty
from millrace.streaming.monitoring import start_monitoring
from millrace.streaming.scoring import incoming_records, start_quarantine, start_scoring


@pytest.fixture(scope="module")
def customers(spark):
    table = views.customers(spark, "/root/testdata/sf0.01").select(*schemas.CUSTOMER_COLUMNS)
    return table.persist()


@pytest.fixture(scope="module")
def baseline(spark, customers):
    rows = training.split_matrix(customers, Settings()).where("split = 'train'").persist()
    return training.baseline_pipeline(rows.count(), Settings()).fit(rows), rows


def test_logistic_regression_solves_the_l2_problem(baseline):
    """Newton's method on sum(loss) + |w|^2 / 2 over population-scaled columns."""
    model, rows = baseline
    data = rows.toPandas()
    x = data[schemas.MODEL_FEATURES].to_numpy(float)
    y = data["churn"].to_numpy(float)
    spread = x.std(axis=0)
    x = (x - x.mean(axis=0)) / np.where(spread == 0, 1, spread)
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * len(schemas.MODEL_FEATURES) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) + penalty @ w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, gradient)
    fitted = model.stages[-1]
    got = np.append(fitted.coefficients.toArray(), fitted.intercept)
    assert np.abs(got - w).max() < 1e-4


def test_both_models_fit_and_score_well(customers, few_trees):
    fitted = training.fit_and_evaluate(customers, few_trees)
    n = customers.count()
    assert fitted.n_rows == n
    for model in ("baseline", "candidate"):
        for split, rows in (("val", 226), ("test", 225)):
            m = fitted.metrics[model, split]
            assert m["n_samples"] == rows
            assert 0.75 < m["roc_auc"] <= 1.0 and 0.7 < m["accuracy"] <= 1.0


def forged(store, auc):
    row = store.spark.createDataFrame(
        [(0, "v_forged", "random_forest", True, "given", None, [], (0.5, auc, 100), "nowhere")],
        REGISTRY,
    )
    store.add(row)


@pytest.fixture()
def store(spark, tmp_path):
    return training.ModelStore(spark, str(tmp_path / "models"))


def statuses(store):
    rows = with_status(store.registry()).orderBy("sequence").collect()
    return [(r.sequence, r.status) for r in rows]


def test_first_retrain_becomes_production(customers, store, few_trees):
    row = training.retrain(customers, store, few_trees)
    assert row.promoted and "No model currently in production" in row.reason
    assert store.production().model_version == row.model_version
    assert row.feature_columns == schemas.MODEL_FEATURES
    assert store.evaluations().count() == 4
    report = store.reports().first()
    assert (report.model_version, report.reason, report.incumbent_version) == (row.model_version, row.reason, None)
    assert (report.n_rows, report.n_left_out) == (customers.count(), 0)
    for path in (report.baseline_path, report.candidate_path):
        assert PipelineModel.load(path).transform(to_model_matrix(customers.limit(3))).count() == 3
    assert {r.feature: r.n for r in store.profile(row).collect()}["tenure_months"] == customers.count()
    assert store.load(row).transform(to_model_matrix(customers.limit(3))).count() == 3


def test_rows_outside_the_domain_are_left_out(customers, store, few_trees):
    odd = customers.limit(2).withColumns(
        {"customer_id": F.concat(F.lit("odd"), "customer_id"), "tenure_months": F.lit(-1)}
    )
    row = training.train(customers.unionByName(odd), store, few_trees)
    report = store.reports().first()
    assert row.promoted and (report.n_rows, report.n_left_out) == (customers.count(), 2)


def test_much_stronger_production_is_kept(customers, store, few_trees):
    forged(store, 0.999)
    row = training.retrain(customers, store, few_trees)
    assert not row.promoted and row.reason.startswith("Kept current production model")
    assert store.production().model_version == "v_forged"
    assert statuses(store) == [(0, "production"), (1, "rejected")]


def test_weak_production_is_archived(customers, store, few_trees):
    forged(store, 0.01)
    row = training.retrain(customers, store, few_trees)
    assert row.promoted and row.reason.startswith("[retrain] Promoted retrained model")
    assert statuses(store) == [(0, "archived"), (1, "production")]


def test_first_training_needs_no_comparison(customers, store, few_trees):
    row = training.train(customers, store, replace(few_trees, min_roc_auc=0.999))
    assert row.promoted and row.model_type == "logistic_regression"
    assert row.reason.startswith("Kept baseline")


def test_scores(baseline, records):
    model, _ = baseline
    rows = records(
        {"customer_id": "new", "tenure_months": 1},
        {
            "customer_id": "loyal",
            "tenure_months": 70,
            "contract_type": "two_year",
            "internet_service": "dsl",
        },
        {"customer_id": "bad", "contract_type": "not_a_real_contract"},
    )
    scored = {r.customer_id: r for r in training.score(model, rows, "v1", "lr").collect()}
    assert set(scored) == {"new", "loyal"}
    assert all(0 <= r.churn_probability <= 1 for r in scored.values())
    assert scored["new"].churn_probability > scored["loyal"].churn_probability
    assert (scored["new"].model_version, scored["new"].model_type) == ("v1", "lr")


def test_prediction_is_one_at_one_half(spark, records):
    """A model with no slope gives exactly one half: predicted 1, unlike MLlib's own."""
    rows = to_model_matrix(
        records(*({"customer_id": str(i)} for i in range(4))), ("customer_id",)
    ).withColumn("churn", (F.col("customer_id") < "2").cast("int"))
    model = training.baseline_pipeline(4, Settings()).fit(rows)
    assert model.transform(rows).first().prediction == 0.0
    scored = training.score(model, records(), "v", "lr").first()
    assert (scored.churn_probability, scored.churn_prediction) == (0.5, 1)


def test_stream_scores_equal_batch_scores(spark, customers, baseline, tmp_path):
    model, _ = baseline
    customers.repartition(3).write.parquet(f"{tmp_path}/in")
    start_scoring(
        model,
        incoming_records(spark, f"{tmp_path}/in"),
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
        "v1",
        "lr",
    ).awaitTermination()
    stream = spark.read.parquet(f"{tmp_path}/out")
    batch = training.score(model, customers, "v1", "lr")
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))
    assert 0 < stream.count() < customers.count()

    start_quarantine(
        incoming_records(spark, f"{tmp_path}/in"), f"{tmp_path}/bad", f"{tmp_path}/checkpoint2"
    ).awaitTermination()
    bad = spark.read.parquet(f"{tmp_path}/bad")
    assert bad.count() + stream.count() == customers.count()
    assert {tuple(r.failed_fields) for r in bad.collect()} == {("contract_type",)}


def test_stream_monitoring_writes_one_report_per_batch(spark, customers, tmp_path):
    def arrive():
        customers.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start_monitoring(
            incoming_records(spark, f"{tmp_path}/in"),
            customers,
            f"{tmp_path}/reports",
            f"{tmp_path}/checkpoint",
        ).awaitTermination()

    arrive()
    arrive()
    report = "feature string, drift_zscore double, batch_id long"
    drift = read_or_empty(spark, f"{tmp_path}/reports/drift", report)
    scores = sorted((r.batch_id, r.drift_zscore) for r in drift.collect())
    assert scores == [(0, 0.0)] * 4 + [(1, 0.0)] * 4
    quality = spark.read.parquet(f"{tmp_path}/reports/quality")
    assert [r.n_rows_checked for r in quality.collect()] == [customers.count()] * 2


@pytest.fixture()
def one_file(spark, tmp_path):
    """A folder with 400 customers in one file."""
    rows = spark.range(400).select(
        F.col("id").alias("c_custkey"),
        (F.col("id") % 25).cast("int").alias("c_nationkey"),
        F.lit("BUILDING").alias("c_mktsegment"),
        F.lit(1.5).alias("c_acctbal"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_customers_of_one_file_are_dealt_to_all_cores(spark, one_file):
    cores = spark.sparkContext.defaultParallelism
    plain, dealt = (views.customers(spark, one_file, spread=x) for x in (False, True))
    assert plain.rdd.getNumPartitions() < cores == dealt.rdd.getNumPartitions()
    assert sorted(plain.collect(), key=str) == sorted(dealt.collect(), key=str)
    assert views.spread_out(dealt) is dealt
    assert catalog.batch_scores_two_groups(spark, one_file).rdd.getNumPartitions() == cores


def test_split_computes_the_features_once(spark, one_file):
    computed = spark.sparkContext.accumulator(0)

    def counted(charges):
        computed.add(1)
        return charges

    rows = views.customers(spark, one_file).select(*schemas.CUSTOMER_COLUMNS)
    rows = rows.withColumn("monthly_charges", F.udf(counted, "double")("monthly_charges"))
    split = training.split_matrix(rows, Settings())
    assert split.select("customer_id").distinct().count() == split.count() == computed.value == 400


def test_forest_keeps_the_node_of_each_row():
    assert training.candidate_pipeline(Settings()).getStages()[-1].getCacheNodeIds()
