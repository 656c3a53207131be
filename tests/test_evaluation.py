import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from millrace.operators.evaluation import accuracy, latency_summary, roc_auc
from millrace.operators.running import running_totals

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def pairwise_auc(rows):
    """Brute force over all (positive, negative) pairs."""
    positive = [s for s, y in rows if y == 1]
    negative = [s for s, y in rows if y == 0]
    if not positive or not negative:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


@QUICK
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "hot", "b", None]),
            st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5, 0.9, -1e300, 1e300, float("inf"), float("-inf")]),
            st.integers(0, 1),
        ),
        max_size=40,
    )
)
def test_auc_equals_counting_pairs(spark, rows):
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r.g: r.roc_auc for r in roc_auc(df, "s", "y", ["g"]).collect()}
    for group in {g for g, _, _ in rows}:
        assert got[group] == pairwise_auc([(s, y) for g, s, y in rows if g == group])
    assert roc_auc(df, "s", "y").first().roc_auc == pairwise_auc([(s, y) for _, s, y in rows])


def test_auc_agrees_with_the_evaluator(spark):
    df = spark.range(5000).select(
        (F.pmod(F.xxhash64("id"), F.lit(700)) / 700.0).alias("s"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("double").alias("y"),
    )
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert abs(roc_auc(df, "s", "y").first().roc_auc - evaluator.evaluate(df)) < 1e-12


def test_auc_leaves_out_rows_without_score_or_label(spark):
    rows = [(0.9, 1), (0.1, 0), (None, 1), (float("nan"), 0), (0.5, None)]
    row = roc_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    assert (row.roc_auc, row.n_positive, row.n_negative) == (1.0, 1, 1)


def test_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (None, 1), (0, 0)], "p int, y int")
    assert tuple(accuracy(df, "p", "y").first()) == (0.5, 4)


def test_running_totals_cross_ranges(spark):
    rows = [("hot", float(i), i % 3) for i in range(300)] + [("b", 5.0, 2)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = running_totals(df, ["g"], "v", {"n": F.col("n")}, ranges=7).collect()
    assert len(got) == 301
    for row in got:
        same = [(v, n) for g, v, n in rows if g == row.g]
        assert row.n_before == sum(n for v, n in same if v < row.v)
        assert row.n_total == sum(n for _, n in same)


def test_running_totals_read_their_source_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("id % 3 AS g", "id % 100 AS v").mapInArrow(counted, "g long, v long")
    got = running_totals(rows, ["g"], "v", {"n": F.lit(1)}).collect()
    assert sum(r.n for r in got) == 1000 and read.value == 1000


def test_infinite_scores_have_their_place(spark):
    far = float("inf")
    rows = [(far, 1), (far, 0), (5.0, 1), (0.0, 0), (-0.0, 1), (-far, 0), (-far, 1), (1e308, 0)] * 3
    got = roc_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    assert got.roc_auc == pairwise_auc(rows)


@QUICK
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "a", "b"]), st.integers(0, 9999), st.booleans()),
        min_size=1,
        max_size=50,
    )
)
def test_latency_statistics(spark, rows):
    shaped = [(g, c / 100, failed, i) for i, (g, c, failed) in enumerate(rows)]
    df = spark.createDataFrame(shaped, "g string, ms double, failed boolean, i long").withColumn(
        "at", F.timestamp_seconds("i")
    )
    got = {r.g: r for r in latency_summary(df, "ms", "failed", "at", ["g"], scale=2).collect()}
    for group in {g for g, *_ in shaped}:
        ours = [r for r in shaped if r[0] == group]
        good = sorted(ms for _, ms, failed, _ in ours if not failed)
        row = got[group]
        assert (row.n_requests, row.n_errors) == (len(ours), len(ours) - len(good))
        if not good:
            assert row.mean_ms is row.p50_ms is row.p95_ms is row.max_ms is None
            continue
        assert abs(row.mean_ms - statistics.mean(good)) < 1e-9
        assert row.p50_ms == statistics.median(good)
        assert row.p95_ms == good[min(int(len(good) * 0.95), len(good) - 1)]
        assert row.max_ms == good[-1]


def test_floor_index_of_the_95th_percentile(spark):
    df = spark.range(20).select(
        F.col("id").cast("double").alias("ms"),
        F.lit(False).alias("failed"),
        F.timestamp_seconds("id").alias("at"),
    )
    row = latency_summary(df, "ms", "failed", "at").first()
    assert (row.p95_ms, row.p50_ms, row.n_requests) == (19.0, 9.5, 20)
    assert abs(row.wall_seconds - 19.019) < 1e-9
    assert abs(row.requests_per_second - 20 / 19.019) < 1e-9
