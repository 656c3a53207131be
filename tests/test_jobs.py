"""The jobs one after the other, as a user would run them."""

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.__main__ import main
from millrace.operators.promotion import with_status
from millrace.plans import training, views
from millrace.settings import Settings
from millrace.sources.tables import BucketedTable


@pytest.fixture()
def quick(monkeypatch):
    monkeypatch.setattr(Settings, "__init__", _few_trees(Settings.__init__))
    monkeypatch.setattr(training.fit_and_evaluate, "__defaults__", (Settings(),))
    monkeypatch.setattr(training.train, "__defaults__", (Settings(),))
    monkeypatch.setattr(training.retrain, "__defaults__", (Settings(),))


def _few_trees(init):
    def quick_init(self, *args, **kwargs):
        init(self, *args, **{"trees": 10, "min_roc_auc": 0.0, **kwargs})

    return quick_init


def test_customer_jobs(spark, tmp_path, quick, capsys):
    path = lambda name: str(tmp_path / name)
    raw = views.raw_customers(spark, "/root/testdata/sf0.01").select(*schemas.RENAMES)
    # Positions follow the files, so write one ordered file.
    raw.orderBy(F.substring("customerID", 2, 9).cast("int")).coalesce(1).write.option(
        "header", True
    ).option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(
        path("raw")
    )

    main(["prepare", path("raw"), path("clean")])
    initial = spark.read.option("header", True).csv(path("clean/part=initial"))
    assert initial.count() == 1350
    assert initial.agg(F.max(F.substring("customer_id", 2, 9).cast("int"))).first()[0] == 1349

    ingest = ["ingest", path("table"), path("clean/part=incoming")]
    main([*ingest, "--seed", path("clean/part=initial")])
    main(ingest)
    table = BucketedTable(spark, path("table"))
    expected = views.customers(spark, "/root/testdata/sf0.01").select(*schemas.CUSTOMER_COLUMNS)
    got = table.read().select(*schemas.CUSTOMER_COLUMNS)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    assert [r.n_rows for r in table.commits().groupBy("batch_id").agg(
        F.sum("n_rows").alias("n_rows")).orderBy("batch_id").collect()] == [1350, 150]

    main(["train", path("table"), path("models")])
    main(["monitor", path("table"), path("reports")])
    capsys.readouterr()
    main(["retrain-check", path("models"), path("reports"), "--days", "8"])
    assert "8 days of new data >= minimum 7" in capsys.readouterr().out
    main(["retrain", path("table"), path("models")])
    registry = training.ModelStore(spark, path("models")).registry()
    assert with_status(registry).where("status = 'production'").count() == 1

    main(["score", path("table"), path("models"), path("out")])
    scores, invalid = (spark.read.parquet(path(f"out/{n}")) for n in ("scores", "invalid"))
    assert (scores.count(), invalid.count()) == (1485, 15)


    log = spark.read.parquet(path("models/retrain_checks")).first()
    assert log.should_retrain and log.checked_at and log.triggered_by[0].startswith("8 days")

    table.read().select(*schemas.CUSTOMER_COLUMNS).write.parquet(path("arrived"))
    main(["score-stream", path("arrived"), path("models"), path("out2"), path("c1")])
    assert spark.read.parquet(path("out2/scores")).count() == scores.count()
    assert spark.read.parquet(path("out2/invalid")).count() == invalid.count()
    main(["monitor-stream", path("arrived"), path("models"), path("reports2"), path("c2")])
    assert spark.read.parquet(path("reports2/drift")).agg(F.max("drift_zscore")).first()[0] == 0
    main(["ingest-stream", path("table"), path("clean/part=incoming"), path("c3")])
    assert table.commits().agg(F.max("batch_id")).first()[0] == 1
    main(["compact", path("table")])
    assert table.read().count() == 1500


def test_settings_come_from_a_file(tmp_path):
    (tmp_path / "s.json").write_text('{"trees": 7, "drift_features": ["tenure_months"]}')
    found = Settings.read(str(tmp_path / "s.json"))
    assert (found.trees, found.drift_features, found.seed) == (7, ("tenure_months",), 42)
    (tmp_path / "bad.json").write_text('{"tree": 7}')
    with pytest.raises(ValueError, match="tree"):
        Settings.read(str(tmp_path / "bad.json"))


def test_score_needs_a_model(spark, tmp_path):
    with pytest.raises(SystemExit, match="run train first"):
        main(["score", str(tmp_path / "t"), str(tmp_path / "m"), str(tmp_path / "o")])


def test_telemetry_job(spark, folder, tmp_path, capsys):
    pings = views.telemetry(spark, folder).select(
        "vehicle_id",
        "vehicle_model",
        F.col("event_time").cast("timestamp").alias("timestamp"),
        "engine_temp_c",
        "speed_kmph",
        F.lit(1.5).alias("latitude"),
        F.lit(2.5).alias("longitude"),
        F.lit(0.75).alias("battery_efficiency"),
        "miles_driven",
    )
    pings.write.option("header", True).csv(str(tmp_path / "pings"))
    main(["telemetry", str(tmp_path / "pings"), str(tmp_path / "out")])
    written = spark.read.parquet(str(tmp_path / "out" / "model_summary"))
    assert written.agg(F.sum("reading_count")).first()[0] == pings.where(
        "engine_temp_c is not null"
    ).count()
    assert "VHOT000" in capsys.readouterr().out
