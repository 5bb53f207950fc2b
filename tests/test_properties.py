"""Invariants over generated rows (fixed seeds) and the test tables."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from keyflow import sources as S
from keyflow.operators import counts as C
from keyflow.operators import windows as W


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(11)
    data, t = [], 1_704_067_200_000_000
    for i in range(2000):
        t += rnd.choice([1, 5, 50, 400, 3_000, 90_000]) * 1_000
        data.append((i, rnd.choice(["a", "a", "a", "b", "c"]), rnd.randint(-1000, 1000), t))
    df = spark.createDataFrame(data, "event_id long, k string, v long, us long")
    return df.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))


@pytest.mark.parametrize("size", ["1 second", "7 seconds", "1 minute"])
def test_tumbling_sums_to_total(rows, size):
    g = W.window_reduce(rows, "ts", size, keys=["k"], value="v").agg(
        F.sum("total").alias("s"), F.sum("n").alias("n")).first()
    t = rows.agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert (g.s, g.n) == (t.s, t.n)


@pytest.mark.parametrize("size,slide,k", [("6 seconds", "2 seconds", 3),
                                          ("1 minute", "15 seconds", 4)])
def test_each_row_in_size_over_slide_windows(rows, size, slide, k):
    g = W.window_reduce(rows, "ts", size, slide, value="v").agg(
        F.sum("n").alias("n"), F.sum("total").alias("s")).first()
    t = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).first()
    assert g.n == k * t.n and g.s == k * t.s


@pytest.mark.parametrize("rpb", [13, 1_000_000])
def test_sessions_are_more_than_gap_apart(rows, rpb):
    s = W.sessions(rows, "ts", "2 seconds", keys=["k"], value="v", rows_per_bucket=rpb)
    pdf = s.toPandas().sort_values(["k", "window_start"])
    for _, g in pdf.groupby("k"):
        starts, ends = g["window_start"].to_numpy(), g["window_end"].to_numpy()
        # window_end = last row + gap, so the next start must lie beyond it
        assert (starts[1:] > ends[:-1]).all()
    assert pdf["n"].sum() == rows.count()


def test_count_windows_plus_remainder_is_total(spark):
    nums = S.numbers(spark, SF_SMALL)
    w = C.count_windows(nums, "key", "num", ["ts", "event_id"], size=10).groupBy("key").agg(
        F.sum("sum").alias("s"), F.count(F.lit(1)).alias("w"))
    per_key = nums.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    j = per_key.join(w, "key", "left").fillna(0, subset=["w"]).collect()
    assert all(r.w == r.n // 10 for r in j)


def test_text_file_stream_through_parser(spark, scratch):
    import os
    from keyflow.catalog import CLICK_FIELDS
    from keyflow.functions.parse import parse_click
    from keyflow.operators.filters import filter_country
    from keyflow.sources.text import read_lines, to_lines
    src = os.path.join(scratch, "lines")
    clicks = S.clicks(spark, SF_SMALL)
    to_lines(clicks, CLICK_FIELDS).repartition(3).write.text(src)
    st = filter_country(parse_click(read_lines(spark, src, streaming=True,
                                               max_files_per_trigger=1)))
    out = os.path.join(scratch, "out")
    q = (st.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    want = filter_country(clicks).select(*CLICK_FIELDS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
