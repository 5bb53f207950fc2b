"""Two-level scans and sessions equal their one-window forms on skewed data."""

import random

import pytest
from pyspark.sql import functions as F

from compare import same
from keyflow.operators import windows as W
from keyflow.plans.scan import Agg, prefix_scan, simple_scan


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        # key "hot" holds a third of the rows; a null key is its own group
        k = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rnd.randint(0, 40)}")
        rows.append((k, i, rnd.randint(-50, 50), 1_700_000_000_000_000 + i * 1_000_000
                     + rnd.randint(0, 900_000)))
    df = spark.createDataFrame(rows, "k string, id long, x long, us long")
    return df.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))


def aggs():
    return [Agg("s", "sum", F.col("x")), Agg("lo", "min", F.col("x")),
            Agg("hi", "max", F.struct("x", "id"))]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("rpb", [5, 64, 10_000])
def test_prefix_scan_equals_window(spark, skewed, inclusive, rpb):
    got = prefix_scan(skewed, ["k"], ["ts", "id"], aggs(), inclusive=inclusive,
                      rows_per_bucket=rpb).toPandas()
    want = simple_scan(skewed, ["k"], ["ts", "id"], aggs(), inclusive=inclusive).toPandas()
    assert same(got, want)


def test_global_prefix_scan(spark, skewed):
    got = prefix_scan(skewed, [], ["id"], aggs(), rows_per_bucket=13).toPandas()
    want = simple_scan(skewed, [], ["id"], aggs()).toPandas()
    assert same(got, want)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("rpb", [9, 1_000_000])
def test_sessions_equal_session_window(spark, skewed, keys, rpb):
    d = skewed.where(F.col("k").isNotNull()) if keys else skewed
    got = W.sessions(d, "ts", "1500 milliseconds", keys=keys, value="x", order=["ts", "id"],
                     carry=["id"], rows_per_bucket=rpb).toPandas()
    want = W.session_reduce_simple(d, "ts", "1500 milliseconds", keys=keys, value="x",
                                   order=["ts", "id"], carry=["id"]).toPandas()
    assert len(got) == len(want)
    assert same(got, want)


def test_hot_key_is_spread_over_slices(spark, skewed):
    from keyflow.plans.scan import assign_buckets
    d, pairs = assign_buckets(skewed, ["k"], "ts", rows_per_bucket=100)
    sizes = d.groupBy("k", "__kf_bucket").count().toPandas()
    hot = sizes[sizes["k"] == "hot"]
    assert len(hot) >= 8 and pairs >= len(hot)
    assert hot["count"].max() <= 2 * 100
    # keys with at most rows_per_bucket rows are never split
    per_key = sizes.groupby("k", dropna=False)["count"].transform("sum")
    assert (sizes.loc[per_key <= 100, "__kf_bucket"] == 0).all()


def test_website_metrics_sketch_close_to_exact(spark):
    from conftest import SF_SMALL
    from keyflow import sources as S
    from keyflow.operators import aggregates as AG
    c = S.clicks(spark, SF_SMALL)
    approx = {r.website: r for r in AG.website_metrics_sketch(c).collect()}
    exact = {r.website: r for r in AG.website_metrics(c).collect()}
    assert approx.keys() == exact.keys()
    for w, e in exact.items():
        assert approx[w].clicks == e.clicks and approx[w].total_time == e.total_time
        assert abs(approx[w].distinct_users_approx - e.distinct_users) <= max(1, 0.05 * e.distinct_users)


def test_prefix_scan_random_shapes(spark):
    """Random key skew, bucket sizes and aggregate kinds (fixed seeds)."""
    import pandas as pd
    for seed in range(3):
        rnd = random.Random(100 + seed)
        n = rnd.randint(200, 800)
        hot_share = rnd.choice([0.0, 0.3, 0.9])
        keys = [("h" if rnd.random() < hot_share else f"c{rnd.randint(0, 9)}") for _ in range(n)]
        pdf = pd.DataFrame({"k": keys, "id": range(n),
                            "x": [rnd.randint(-9, 9) for _ in range(n)]})
        df = spark.createDataFrame(pdf)
        kind = rnd.choice(["sum", "min", "max"])
        aggs = [Agg("r", kind, F.col("x"))]
        got = prefix_scan(df, ["k"], ["id"], aggs, rows_per_bucket=rnd.randint(3, 60),
                          inclusive=bool(seed % 2)).toPandas()
        want = simple_scan(df, ["k"], ["id"], aggs, inclusive=bool(seed % 2)).toPandas()
        assert same(got, want), (seed, kind)


def test_prefix_scan_null_order_values_sort_first(spark):
    rows = [("h", None if i % 50 == 0 else i, i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    aggs = [Agg("s", "sum", F.col("id"))]
    got = prefix_scan(df, ["k"], ["t", "id"], aggs, rows_per_bucket=30).toPandas()
    want = simple_scan(df, ["k"], ["t", "id"], aggs).toPandas()
    assert same(got, want)
    got = prefix_scan(df, [], ["t", "id"], aggs, rows_per_bucket=30).toPandas()
    want = simple_scan(df, [], ["t", "id"], aggs).toPandas()
    assert same(got, want)


def test_many_hot_keys_take_the_checkpointed_path(spark, skewed, monkeypatch):
    import keyflow.plans.scan as scan
    monkeypatch.setattr(scan, "LOCAL_HOT_ROWS", 2)
    got = prefix_scan(skewed, ["k"], ["ts", "id"], aggs(), rows_per_bucket=20).toPandas()
    want = simple_scan(skewed, ["k"], ["ts", "id"], aggs()).toPandas()
    assert same(got, want)


def _largest_bucket(spark, stamps, limit):
    from keyflow.plans.scan import assign_buckets
    df = spark.createDataFrame([("h", t, i) for i, t in enumerate(stamps)], "k string, t long, id long")
    d, pairs = assign_buckets(df, ["k"], "t", rows_per_bucket=limit, then=["id"])
    sizes = [r["count"] for r in d.groupBy("k", "__kf_bucket").count().collect()]
    got = prefix_scan(df, ["k"], ["t", "id"], [Agg("s", "sum", F.col("id"))], rows_per_bucket=limit).toPandas()
    want = simple_scan(df, ["k"], ["t", "id"], [Agg("s", "sum", F.col("id"))]).toPandas()
    assert same(got, want) and len(sizes) <= pairs
    return max(sizes)


def test_outliers_ties_and_bursts_do_not_unbalance_buckets(spark):
    now = 1_700_000_000_000
    n, limit = 6_000, 200
    assert _largest_bucket(spark, [0] + [now + i for i in range(n - 1)], limit) <= 2 * limit  # one row at epoch 0
    assert _largest_bucket(spark, [now] * n, limit) <= 2 * limit  # all rows on one timestamp
    burst = [now + i // 1000 if i % 10 else now - 10_000 * i for i in range(n)]  # 90 % in a burst
    assert _largest_bucket(spark, burst, limit) <= 2 * limit


def test_size_check_sends_one_row_per_task(spark):
    from keyflow.plans.sizing import has_at_most, rows_and_bytes
    df = spark.range(0, 100_000, numPartitions=20).select(F.col("id").cast("string").alias("s"))
    n, size = rows_and_bytes(df)
    assert n == 100_000 and size > 100_000 * 16
    assert has_at_most(df, 100_000) and not has_at_most(df, 99_999) and not has_at_most(df, 200_000, n_bytes=1000)
    plan = df.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit" not in plan
