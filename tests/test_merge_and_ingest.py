import os
import csv

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.merge import concat, keep_last, merge_latest
from millrace.plans import views
from millrace.plans.ingestion import Ingestion
from millrace.sources import files as ingestion_files
from millrace.sources.files import list_csv, read_raw_customers, read_telemetry_csv
from millrace.sources.tables import BucketedTable, latest, read_or_empty, write_batch
from millrace.streaming.ingest import ingest_folder, start_ingest
from tests.conftest import RECORD

ROWS = "id string, v int, b int, n int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_concat_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([(2, 5)], "id int, only_b int")
    assert rows_of(concat(a, b)) == [(1, "x", None), (2, None, 5)]


@pytest.mark.parametrize("unique", [False, True])
def test_last_row_wins_within_and_across_batches(spark, unique):
    base = spark.createDataFrame([("a", 1, 0, 0), ("b", 2, 0, 1), (None, 3, 0, 2)], ROWS)
    batch = spark.createDataFrame(
        [("b", 20, 1, 0), ("b", None, 1, 1), ("c", 30, 1, 2), (None, 31, 1, 3)], ROWS
    )
    merged = merge_latest(base, batch, "id", ["b", "n"], unique)
    assert rows_of(merged.select("id", "v")) == rows_of(
        spark.createDataFrame([("a", 1), ("b", None), ("c", 30), (None, 31)], "id string, v int")
    )


def test_duplicates_in_the_base_go_when_a_batch_arrives(spark):
    base = spark.createDataFrame([("a", 1, 0, 0), ("a", 2, 0, 1)], ROWS)
    batch = spark.createDataFrame([("z", 9, 1, 0)], ROWS)
    merged = merge_latest(base, batch, "id", ["b", "n"])
    assert rows_of(merged.select("id", "v")) == [("a", 2), ("z", 9)]


def test_a_hot_key_is_limited_before_the_shuffle(spark):
    key = F.when(F.col("id") < 1000, "k").otherwise("other")
    df = spark.range(100).select(key.alias("id"), F.col("id").alias("n"))
    plan = keep_last(df, "id", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert keep_last(df, "id", ["n"]).collect() == [("k", 99)]


def test_incremental_merge_does_not_shuffle_the_base(spark, tmp_path):
    spark.range(1000).select(
        F.col("id").cast("string").alias("id"),
        F.lit(0).alias("v"),
        F.lit(0).alias("b"),
        F.lit(0).alias("n"),
    ).write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    batch = spark.createDataFrame([("5", 1, 1, 0)], ROWS)
    merged = merge_latest(base, batch, "id", ["b", "n"], base_keys_unique=True)
    assert merged.count() == 1000
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    # Too many keys to broadcast: the same rows by a shuffle.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = merge_latest(base, batch, "id", ["b", "n"], base_keys_unique=True)
        assert rows_of(large) == rows_of(merged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def write_records(path, records, rename=None, order=None, extra=None):
    names = list(order or [*RECORD, "churn"])
    with open(path, "w", newline="") as file:
        out = csv.writer(file)
        out.writerow([(rename or {}).get(n, n) for n in names] + list(extra or {}))
        for record in records:
            row = {**RECORD, "churn": 0, **record}
            out.writerow([row[n] for n in names] + list((extra or {}).values()))


@pytest.fixture()
def inbox(tmp_path):
    (tmp_path / "in" / "_processed").mkdir(parents=True)
    return tmp_path / "in"


def ids(ingestion):
    rows = ingestion.table.read().select("customer_id", "tenure_months").collect()
    return {r.customer_id: r.tenure_months for r in rows}


def test_ingestion_end_to_end(spark, tmp_path, inbox):
    seed = tmp_path / "seed.csv"
    write_records(seed, [{"customer_id": "a"}, {"customer_id": "b"}, {"customer_id": "a"}])
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    ingestion.seed([str(seed)])
    # The seed goes in as it is; duplicates leave with the first batch.
    assert ingestion.table.read().count() == 3

    write_records(
        inbox / "1 first.csv",
        [{"customer_id": "b", "tenure_months": 5}, {"customer_id": "c"}],
        order=reversed([*RECORD, "churn"]),
    )
    write_records(inbox / "2.csv", [{"customer_id": "b", "tenure_months": 6}], extra={"note": "x"})
    write_records(inbox / "3bad.csv", [{"customer_id": "d"}], rename={"contract_type": "contract"})
    write_records(inbox / "4empty.csv", [])
    write_records(inbox / "_processed" / "old.csv", [{"customer_id": "old"}])
    (inbox / "readme.txt").write_text("not a table")

    def run():
        ingest_folder(ingestion, str(inbox))

    run()
    usual = RECORD["tenure_months"]
    assert ids(ingestion) == {"a": usual, "b": 6, "c": usual}
    assert ingestion.table.read().where("customer_id = 'b'").first().note == "x"
    log = {
        r.source_file.split("/")[-1]: (r.n_rows, r.status, r.missing_columns)
        for r in ingestion.table.ingestion_log().collect()
    }
    assert log == {
        "seed.csv": (3, "ingested", None),
        "1 first.csv": (2, "ingested", None),
        "2.csv": (1, "ingested", None),
        "3bad.csv": (None, "rejected", ["contract_type"]),
        "4empty.csv": (0, "ingested", None),
    }

    commits = ingestion.table.commits().count()
    run()
    assert ingestion.table.commits().count() == commits

    write_records(inbox / "5.csv", [{"customer_id": "a", "tenure_months": 9}])
    run()
    assert ids(ingestion) == {"a": 9, "b": 6, "c": RECORD["tenure_months"]}


def test_a_batch_delivered_twice_counts_once(spark, tmp_path, inbox):
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    path = inbox / "1.csv"
    write_records(path, [{"customer_id": "a"}, {"customer_id": "a", "tenure_months": 4}])
    ingestion.run_batch([str(path)])
    ingestion.run_batch([str(path)])
    assert ids(ingestion) == {"a": 4}
    assert ingestion.table.commits().count() == 1


def test_another_run_loses_and_repeats_nothing(spark, tmp_path, inbox):
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    write_records(inbox / "1.csv", [{"customer_id": "a"}])
    ingest_folder(ingestion, str(inbox))
    write_records(inbox / "2.csv", [{"customer_id": "b"}])
    ingest_folder(ingestion, str(inbox))
    assert ids(ingestion) == {"a": RECORD["tenure_months"], "b": RECORD["tenure_months"]}
    log = ingestion.table.commits().orderBy("batch_id").collect()
    assert [(r.batch_id, r.source_file.split("/")[-1]) for r in log] == [(1, "1.csv"), (2, "2.csv")]


def test_done_files_can_be_archived(spark, tmp_path, inbox):
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    for number, name in enumerate(("1.csv", "2.csv", "3.csv")):
        write_records(inbox / name, [{"customer_id": name, "tenure_months": number}])
        ingest_folder(ingestion, str(inbox), files_per_batch=1, archive=str(tmp_path / "done"))
    assert ids(ingestion) == {"1.csv": 0, "2.csv": 1, "3.csv": 2}
    assert [p.name for p in sorted((tmp_path / "done").rglob("*.csv"))] == ["1.csv", "2.csv", "3.csv"]
    assert not list(inbox.glob("*.csv"))


def test_crash_before_the_commit_leaves_the_old_version(spark, tmp_path, inbox):
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    write_records(inbox / "1.csv", [{"customer_id": "a"}])
    write_records(inbox / "2.csv", [{"customer_id": "b"}])
    ingestion.run_batch([str(inbox / "1.csv")])

    def lost(*rows):
        raise RuntimeError("lost")

    commit, ingestion.table.commit = ingestion.table.commit, lost
    with pytest.raises(RuntimeError):
        ingestion.run_batch([str(inbox / "2.csv")])
    assert ids(ingestion) == {"a": RECORD["tenure_months"]}
    ingestion.table.commit = commit
    ingestion.run_batch([str(inbox / "2.csv")])
    assert ids(ingestion) == {"a": RECORD["tenure_months"], "b": RECORD["tenure_months"]}


def test_quarantine_keeps_the_faulty_rows(spark, tmp_path, inbox):
    path = inbox / "1.csv"
    write_records(path, [{"customer_id": "a"}, {"customer_id": "b", "partner": 7}])
    ingestion = Ingestion(spark, str(tmp_path / "table"), quarantine=str(tmp_path / "bad"))
    ingestion.run_batch([str(path)])
    assert ids(ingestion) == {"a": RECORD["tenure_months"]}
    bad = spark.read.parquet(str(tmp_path / "bad")).first()
    assert (bad.customer_id, bad.failed_fields) == ("b", ["partner"])


def test_seed_with_a_bad_header_is_an_error(spark, tmp_path):
    write_records(tmp_path / "seed.csv", [{}], rename={"churn": "left"})
    with pytest.raises(ValueError, match="churn"):
        Ingestion(spark, str(tmp_path / "t")).seed([str(tmp_path / "seed.csv")])


def test_reading_before_the_first_commit(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing committed"):
        BucketedTable(spark, str(tmp_path / "none")).read()
    assert read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_old_versions_stay_readable_for_a_while(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "v", keep=2)
    for version in range(3):
        table.commit(written=table.replace(spark.createDataFrame([(version,)], "v int")))
    assert [table.read().first().v, table.read(1).first().v] == [2, 1]
    for gone in (0, 3):
        with pytest.raises(ValueError, match="not kept"):
            table.read(gone)


def test_latest_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "reports")
    for batch, value in ((0, 1), (1, 2), (1, 3)):
        write_batch(spark.createDataFrame([(value,)], "v int"), path, batch)
    table = read_or_empty(spark, path, "v int, batch_id long")
    assert rows_of(table) == [(1, 0), (3, 1)]
    assert rows_of(latest(table, "batch_id")) == [(3, 1)]
    assert latest(table.where("v > 5"), "batch_id").count() == 0


def test_telemetry_header_is_compared(spark, tmp_path):
    names = schemas.TELEMETRY.names
    values = ["V1", "M", "2024-01-01T00:00:00", "80.5", "1.0", "1.0", "1.0", "0.9", "2.5"]
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    bad.write_text(",".join(n.replace("speed", "pace") for n in names) + "\n" + ",".join(values) + "\n")
    assert read_telemetry_csv(spark, str(good)).first().engine_temp_c == 80.5
    with pytest.raises(Exception, match="pace"):
        read_telemetry_csv(spark, str(bad)).collect()


def test_raw_customers_by_name_with_an_unused_column(spark, folder, tmp_path):
    raw = views.raw_customers(spark, folder).select(*schemas.RENAMES)
    shuffled = raw.select(*sorted(raw.columns), F.lit("x").alias("gender"))
    shuffled.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(str(tmp_path / "raw"))
    files = list_csv(spark, str(tmp_path / "raw"))
    assert files == sorted(files) and files
    back = read_raw_customers(spark, str(tmp_path / "raw"))
    assert rows_of(back.select(*raw.columns)) == rows_of(raw)
    assert "gender" in back.columns


def test_corrected_renewed_and_late_files_are_taken(spark, tmp_path, inbox):
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    usual = RECORD["tenure_months"]
    write_records(inbox / "a.csv", [{"customer_id": "a"}])
    write_records(inbox / "b.csv", [{"customer_id": "b"}], rename={"contract_type": "contract"})
    ingest_folder(ingestion, str(inbox))
    assert ids(ingestion) == {"a": usual}

    # A corrected file, new contents under a used name, and a file a month old.
    write_records(inbox / "b.csv", [{"customer_id": "b"}])
    write_records(inbox / "a.csv", [{"customer_id": "d"}, {"customer_id": "a", "tenure_months": 3}])
    write_records(inbox / "old.csv", [{"customer_id": "l"}])
    month_ago = (inbox / "old.csv").stat().st_mtime - 30 * 86_400
    os.utime(inbox / "old.csv", (month_ago, month_ago))
    ingest_folder(ingestion, str(inbox))
    assert ids(ingestion) == {"a": 3, "b": usual, "d": usual, "l": usual}

    commits = ingestion.table.commits().count()
    assert ingest_folder(ingestion, str(inbox)) == 0
    assert ingestion.table.commits().count() == commits == 5


def test_an_uncommitted_write_changes_no_readable_version(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "v", keep=2)
    for version in range(3):
        table.commit(written=table.replace(spark.createDataFrame([(version,)], "v int")))
    table.replace(spark.createDataFrame([(3,)], "v int"))
    assert [table.read(n).first().v for n in (1, 2)] == [1, 2]
    assert table.read().first().v == 2


def test_a_blank_file_is_rejected_and_an_empty_one_waits(spark, tmp_path, inbox):
    (inbox / "none.csv").write_text("")
    (inbox / "blank.csv").write_text("\n")
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    ingest_folder(ingestion, str(inbox))
    assert [r.status for r in ingestion.table.commits().collect()] == ["rejected"]


def test_telemetry_columns_in_any_order_with_extras(spark, tmp_path):
    names = [*reversed(schemas.TELEMETRY.names), "note"]
    values = ["2.5", "0.9", "1.0", "1.0", "1.0", "80.5", "2024-01-01T00:00:00", "M", "V1", "x"]
    (tmp_path / "t.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    row = read_telemetry_csv(spark, str(tmp_path / "t.csv")).first()
    assert (row.engine_temp_c, row.vehicle_id, row.miles_driven) == (80.5, "V1", 2.5)


def test_a_file_that_cannot_be_read_holds_up_no_other(spark, tmp_path, inbox, monkeypatch):
    for name in ("a", "b[1]", "c", "d"):
        write_records(inbox / f"{name}.csv", [{"customer_id": name}])
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    opened = ingestion_files.open_headers

    class Unreadable(PySparkException):
        def getCondition(self):
            return "FAILED_READ_FILE.NO_HINT"

    def broken(spark, paths):
        if any(path.endswith("c.csv") for path in paths):
            raise Unreadable("lost")
        return opened(spark, paths)

    monkeypatch.setattr(ingestion_files, "open_headers", broken)
    ingest_folder(ingestion, str(inbox))
    assert set(ids(ingestion)) == {"a", "b[1]", "d"}
    status = {r.source_file.split("/")[-1]: r.status for r in ingestion.table.commits().collect()}
    assert status["c.csv"] == "unreadable" and status["b[1].csv"] == "ingested"
    # It is taken once it is another file.
    monkeypatch.setattr(ingestion_files, "open_headers", opened)
    assert ingest_folder(ingestion, str(inbox)) == 0
    write_records(inbox / "c.csv", [{"customer_id": "c"}, {"customer_id": "e"}])
    ingest_folder(ingestion, str(inbox))
    assert set(ids(ingestion)) == {"a", "b[1]", "c", "d", "e"}


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path, inbox):
    ingestion = Ingestion(spark, str(tmp_path / "table"))
    write_records(inbox / "b{x,y}.csv", [{"customer_id": "a"}])

    def run(failing=None):
        batch, ingestion.run_batch = ingestion.run_batch, failing or ingestion.run_batch
        try:
            start_ingest(ingestion, str(inbox), str(tmp_path / "checkpoint")).awaitTermination()
        finally:
            ingestion.run_batch = batch

    def lost(paths):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(lost)
    run()
    assert set(ids(ingestion)) == {"a"}
    write_records(inbox / "b{x,y}.csv", [{"customer_id": "a", "tenure_months": 3}, {"customer_id": "z"}])
    run()
    run()
    assert ids(ingestion) == {"a": 3, "z": RECORD["tenure_months"]}
    assert len(list((tmp_path / "checkpoint" / "files").glob("*.json"))) == 2
