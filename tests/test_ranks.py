import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import ranks
from millrace.sources.files import POSITION, with_position


@pytest.fixture()
def narrow(monkeypatch):
    """Force many descent passes on small data."""
    monkeypatch.setattr(ranks, "_FEW", 4)
    for name, value in (("_SKETCH", 8), ("_QUANTILES", 8), ("_SLACK", 1)):
        monkeypatch.setattr(ranks, name, value)


def part_of(df, order, fraction):
    return {tuple(r[:-1]): r[-1] for r in ranks.positional_split(df, order, fraction).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=60), st.sampled_from([0.0, 0.37, 0.9, 1.0]))
def test_cut_of_integers_equals_sorting(spark, narrow, keys, fraction):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = part_of(df, ["k"], fraction)
    first = sorted(keys)[: int(len(keys) * fraction)]
    assert {k for (k,), part in got.items() if part == "initial"} == set(first)


def passes(spark, monkeypatch):
    """Counts the aggregations whose rows come to the driver."""
    frame = type(spark.range(0))
    counted, collect = [], frame.collect

    def counting(df):
        counted.append(df)
        return collect(df)

    monkeypatch.setattr(frame, "collect", counting)
    return counted


@pytest.mark.parametrize(
    "key",
    ["id * 7919 % 300007", "date_add(DATE'1990-01-01', CAST(id % 20011 AS int))", "id / 7.0D", "timestamp_seconds(id)", "CAST(id AS decimal(20, 3)) / 3"],
)
def test_numbers_and_dates_take_two_passes(spark, monkeypatch, key):
    df = spark.range(300_000).selectExpr(f"{key} AS k", "id")
    counted = passes(spark, monkeypatch)
    limits = ranks.key_limits(df, "k", F.lit(0))
    ((value, place, equals),) = ranks._locate(df, "k", F.lit(0), [(0, 270_000)], limits).values()
    assert len(counted) == 2
    below = df.where(F.col("k") < F.lit(value)).count()
    assert below + place == 270_000 and df.where(F.col("k") == F.lit(value)).count() == equals


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_cut_of_doubles_with_infinite_ones(spark, narrow, bad):
    values = [bad] * 3 + [x / 3 for x in range(-20, 20)] + [1e300, -1e300, 0.0]
    df = spark.createDataFrame([(v, n) for n, v in enumerate(values)], "k double, n int")
    got = {k[1] for k, part in part_of(df, ["k", "n"], 0.9).items() if part == "initial"}
    order = sorted(range(len(values)), key=lambda n: (values[n] != values[n], values[n], n))
    assert got == set(order[: int(len(values) * 0.9)])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sets(
        st.tuples(st.sampled_from(["dir/a", "dir/ab", "dir/b", "", "é"]), st.integers(0, 30)),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([0.25, 0.5, 0.9]),
)
def test_cut_of_text_then_number(spark, narrow, keys, fraction):
    df = spark.createDataFrame(list(keys), "f string, n int")
    got = part_of(df, ["f", "n"], fraction)
    first = sorted(keys)[: int(len(keys) * fraction)]
    assert {k for k, part in got.items() if part == "initial"} == set(first)


def test_rows_equal_in_every_key_are_still_counted_exactly(spark, narrow):
    """A third of all rows and more share one key: the cut goes through them."""
    df = spark.createDataFrame([(1,)] * 40 + [(i,) for i in range(2, 62)], "k long")
    split = ranks.positional_split(df, ["k"], 0.25)
    counts = {r["part"]: r["count"] for r in split.groupBy("part").count().collect()}
    assert counts == {"initial": 25, "incoming": 75}
    assert split.where("part = 'initial' and k <> 1").count() == 0
    assert split.columns == ["k", "part"]


def test_null_order_key_is_an_error(spark):
    df = spark.createDataFrame([(1,), (None,)], "k long")
    with pytest.raises(ValueError, match="no place"):
        ranks.positional_split(df, ["k"], 0.5)


def test_positional_split_follows_the_files(spark, tmp_path):
    for name, start in (("b.csv", 100), ("a.csv", 0)):
        lines = ["v"] + [str(start + i) for i in range(50)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = with_position(spark.read.schema("v int").option("header", True).csv(str(tmp_path)))
    split = ranks.positional_split(rows, list(POSITION), 0.7)
    first = sorted(r.v for r in split.where("part = 'initial'").collect())
    assert first == [*range(50), *range(100, 120)]


def test_published_split_sizes():
    n, positive = 7043, 1869
    sizes = ranks.split_sizes({0: n - positive, 1: positive}, 0.15, 0.15)
    test, val, train = (sum(part) for part in zip(*sizes.values()))
    assert (train, val, test) == (4929, 1057, 1057)
    assert int(n * 0.9) == 6338


def test_stratified_split_is_exact_and_stable(spark, narrow):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 5 == 0).cast("int").alias("y")
    )
    split = ranks.stratified_split(df, "y", "id", 0.15, 0.15, seed=7)
    counts = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    sizes = ranks.split_sizes({0: 800, 1: 200}, 0.15, 0.15)
    assert counts == {
        (y, name): n for y in sizes for name, n in zip(("test", "val", "train"), sizes[y])
    }
    assert (counts[0, "test"], counts[1, "test"]) == (120, 30)
    again = ranks.stratified_split(df.repartition(9), "y", "id", 0.15, 0.15, seed=7)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))
    other = ranks.stratified_split(df, "y", "id", 0.15, 0.15, seed=8)
    assert sorted(map(tuple, split.collect())) != sorted(map(tuple, other.collect()))


def test_stratified_split_with_repeated_keys(spark, narrow):
    rows = [("same", 0)] * 60 + [(str(i), i % 2) for i in range(140)]
    df = spark.createDataFrame(rows, "id string, y int")
    split = ranks.stratified_split(df, "y", "id")
    sizes = ranks.split_sizes({0: 130, 1: 70}, 0.15, 0.15)
    counts = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    for label, expected in sizes.items():
        assert tuple(counts[label, s] for s in ("test", "val", "train")) == expected


def test_recent_rows(spark):
    df = spark.range(1000).repartition(7)
    got = sorted(r.id for r in ranks.recent_rows(df, ["id"], 5).collect())
    assert got == [995, 996, 997, 998, 999]


def test_recent_rows_with_several_keys_ties_and_nulls(spark):
    rows = [(b, f, i) for b in (0, 1, 2) for f in ("a", "b") for i in range(4)]
    df = spark.createDataFrame(rows, "b int, f string, i int").repartition(5)
    for n in (1, 3, 4, 9, 24, 30):
        got = sorted(map(tuple, ranks.recent_rows(df, ["b", "f", "i"], n).collect()))
        assert got == sorted(rows)[-n:]
    assert ranks.recent_rows(df, ["b"], 5).count() == 5
    holed = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    assert sorted(map(repr, ranks.recent_rows(holed, ["k"], 3).collect())) == sorted(
        map(repr, holed.collect())
    )
    assert ranks.recent_rows(holed.limit(0), ["k"], 3).count() == 0


def test_recent_rows_prunes_by_the_order_key(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    recent = ranks.recent_rows(spark.read.parquet(str(tmp_path / "t")), ["id"], 7)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,93)" in plan
    assert recent.count() == 7


def test_long_shared_paths_take_few_passes(spark, monkeypatch):
    name = F.concat(F.lit("store:/a/long/folder/of/exports/part-"), F.col("id") % 4, F.lit("-x.csv"))
    df = spark.range(200_000).select(name.alias("path"), "id")
    passes = []
    finer = ranks._Texts.finer
    monkeypatch.setattr(ranks._Texts, "finer", lambda *a: passes.append(1) or finer(*a))
    split = ranks.positional_split(df, ["path", "id"], 0.9)
    assert len(passes) <= 8
    initial = split.where("part = 'initial'")
    assert initial.count() == 180_000
    # 150,000 rows stand in the first three paths, so the cut is inside the fourth.
    assert initial.where("path like '%-3-x.csv'").agg(F.max("id")).first()[0] == 4 * 30_000 - 1


def test_latest_batch(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d")], "batch int, v string")
    assert sorted(r.v for r in ranks.latest_batch(df, "batch").collect()) == ["b", "c"]
    assert ranks.latest_batch(df.where("batch is null"), "batch").count() == 0
    assert ranks.latest_batch(df.limit(0), "batch").count() == 0
