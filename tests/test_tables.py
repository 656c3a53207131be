"""The bucketed table and its commit log, by the files they write and read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.sources.commits import CommitLog
from millrace.sources.tables import BucketedTable

ROWS = "id long, v int, n int"


def files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}


def batch(spark, first, last, n):
    return spark.range(first, last).select("id", F.lit(n).alias("v"), F.lit(n).alias("n"))


def values(df):
    return {r.id: r.v for r in df.collect()}


def test_a_batch_writes_and_moves_only_the_buckets_it_touches(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", ["n"], buckets=16)
    table.commit(written=table.upsert(batch(spark, 0, 1000, 0)))
    before = files(tmp_path)
    assert {p.parent.name for p in before} == {f"_bucket={b}" for b in range(16)}

    changed = batch(spark, 0, 3, 1)
    touched = {f"_bucket={r[0]}" for r in changed.select(F.pmod(F.xxhash64("id"), F.lit(16))).collect()}
    table.commit(written=table.upsert(changed))
    after = files(tmp_path)
    assert {p: t for p, t in after.items() if p in before} == before
    assert {p.parent.name for p in after.keys() - before.keys()} == touched
    assert values(table.read()) == {i: int(i < 3) for i in range(1000)}

    # Compaction writes these buckets anew and no other; the old ones stay while readable.
    assert table.compact() == len(touched)
    compacted = files(tmp_path)
    assert {p.parent.name for p in compacted.keys() - after.keys()} == touched
    assert {p: t for p, t in compacted.items() if p in before} == before
    assert values(table.read()) == values(table.read(1)) == {i: int(i < 3) for i in range(1000)}
    for n in (2, 3):
        table.commit(written=table.upsert(batch(spark, n, n + 1, n)))
    left = files(tmp_path)
    replaced = {p for p in before if p.parent.name in touched}
    assert not replaced & left.keys() and (before.keys() - replaced) <= left.keys()
    assert table.compact(least_deltas=9) == 0


def test_only_buckets_with_deltas_are_joined(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", ["n"], buckets=4)
    table.commit(written=table.upsert(batch(spark, 0, 100, 0)))
    assert "Join" not in table.read()._jdf.queryExecution().optimizedPlan().toString()
    table.commit(written=table.upsert(batch(spark, 7, 8, 1)))
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "Window" not in plan


def test_many_deltas_are_compacted_by_themselves(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", ["n"], buckets=1, most_deltas=2, snapshot_every=3)
    for n in range(8):
        table.commit(written=table.upsert(batch(spark, n, n + 2, n)), batch_id=n)
    assert values(table.read()) == {**{i: i for i in range(8)}, 8: 7}
    (layout,) = [table._current()]
    assert len(layout.deltas.get(0, [])) <= 2
    assert table.state().batch_id == 7 and table.state().keys_unique


def test_null_keys_repeats_new_columns_and_nothing(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", ["n"], buckets=3)
    seed = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (None, 2, 2)], ROWS)
    table.commit(written=table.replace(seed, keys_unique=False))
    assert table.read().count() == 3 and not table.state().keys_unique
    late = spark.createDataFrame([(None, 3, 3, "x"), (None, 4, 4, "y"), (2, 5, 5, None)], ROWS + ", note string")
    table.commit(written=table.upsert(late))
    assert sorted(map(tuple, table.read().collect()), key=str) == [
        (1, 1, 1, None), (2, 5, 5, None), (None, 4, 4, "y"),
    ]
    version = table.state().version
    table.commit(written=table.upsert(late.limit(0)))
    assert table.state().version == version and table.read().count() == 3
    # Reopened without its settings.
    again = BucketedTable(spark, str(tmp_path / "t"))
    again.commit(written=again.upsert(spark.createDataFrame([(2, 6, 6)], ROWS)))
    assert values(table.read()) == {1: 1, 2: 6, None: 4}
    empty = BucketedTable(spark, str(tmp_path / "e"), "id")
    empty.commit(written=empty.replace(seed.limit(0)))
    assert empty.read().schema.names == ["id", "v", "n"] and empty.read().count() == 0
    with pytest.raises(ValueError, match="needs a key"):
        BucketedTable(spark, str(tmp_path / "none")).upsert(seed)


def test_a_long_log_is_read_from_few_files(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), spark.range(0).schema, every=4)
    assert log.read().count() == 0
    for n in range(40):
        log.append(spark.createDataFrame([(n,)], "id long"))
        assert len(log.files()) <= 4
        if n in (2, 17, 39):
            assert sorted(r.id for r in log.read().collect()) == list(range(n + 1))
    # Files on disk are bounded too: two snapshots and the commits since the older one.
    assert len([p for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")]) <= 2 + 8


def test_a_crash_while_a_commit_is_written_leaves_the_log(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), spark.range(0).schema, every=2)
    log.append(spark.range(1))
    rename, log.folder.rename = log.folder.rename, lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        log.append(spark.range(1, 2))
    assert log.read().count() == 1
    log.folder.rename = rename
    log.append(spark.range(1, 2))
    assert sorted(r.id for r in log.read().collect()) == [0, 1]
