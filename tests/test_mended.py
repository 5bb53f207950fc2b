"""Behaviour that a review found wrong, pinned."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from keyflow import jobs
from keyflow.functions import parse as P
from keyflow.operators import counts as C
from keyflow.operators import exclude as X
from keyflow.operators import rolling as R
from keyflow.operators import windows as W
from keyflow.streaming import exclude as LX
from keyflow.streaming import rolling as SR
from keyflow.streaming import windows as SW


def _stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(folder)


def _run(df, mode, name):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _files(folder, parts):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(parts):
        with open(os.path.join(folder, f"{i}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(folder, f"{i}.csv"), (1_700_000_000 + 10 * i,) * 2)


def test_clicks_job_writes_every_us_click(spark, scratch):
    lines = [f"u{i % 7},net,site{i % 3},{'US' if i % 4 else 'FR'},2020-01-01 00:00:00,{i}" for i in range(120)]
    parsed = P.parse_click(spark.createDataFrame([(x,) for x in lines], "value string"), strict=False)
    _files(os.path.join(scratch, "in"), [lines[:70], lines[70:]])
    for q in jobs.clicks_job(spark, os.path.join(scratch, "in"), os.path.join(scratch, "out")):
        q.awaitTermination()
    last = {}
    for f in sorted(glob.glob(os.path.join(scratch, "out/clicks_per_website/epoch=*/part-*"))):
        for line in open(f):
            site, start, end, n = line.strip().strip("()").split(",")
            last[site, start, end] = max(int(n), last.get((site, start, end), 0))
    us = parsed.where(F.col("country") == "US").count() if "country" in parsed.columns else sum("US" in x for x in lines)
    assert sum(last.values()) == us > 0


def test_live_exclusion_continues_counts(spark, scratch):
    folder = os.path.join(scratch, "in")
    rules = spark.createDataFrame([("x",)], "id string")
    out = f"file:{scratch}/out"

    def run():
        q = LX.exclude_running_count_live(_stream(spark, folder, "id string, dep string, ts long"), lambda s: rules, "dep", ["ts"],
                                          out, "live", checkpoint=f"file:{scratch}/ck", available_now=True)
        q.awaitTermination()

    _files(folder, [["a,d1,1", "b,,2", "x,d1,3"]])
    run()
    _files(folder, [["a,d1,1", "b,,2", "x,d1,3"], ["c,d1,4", "d,,5"], ["e,d1,6"]])
    run()
    got = sorted((r["ts"], r["dep"], r["count"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "d1", 1), (2, None, 1), (4, "d1", 2), (5, None, 2), (6, "d1", 3)]


def test_live_exclusion_fails_rather_than_restart(spark, scratch):
    with pytest.raises(Exception):
        LX._counts_before(spark, f"file:{scratch}/none", 3, "k").count()
    assert LX._counts_before(spark, f"file:{scratch}/none", 0, "k") is None


def test_live_extremes_keep_the_earliest(spark, scratch):
    _files(scratch, [["k,9,1,first", "k,9,2,second"], ["k,9,3,third", "k,,4,none"]])
    df = _stream(spark, scratch, "k string, v long, ts long, tag string")
    for kind in ("max_by", "min_by"):
        _run(SR.rolling_update(df, "k", "v", kind, order=["ts"], carry=["tag"]), "complete", f"by_{kind}")
        assert [r["tag"] for r in spark.table(f"by_{kind}").collect()] == ["first"]


def test_missing_values_never_hold(spark):
    df = spark.createDataFrame([("k", 1, 5, "a"), ("k", 2, None, "b"), ("k", 3, 3, "c")], "k string, ts long, v long, tag string")
    got = [r["tag"] for r in R.rolling_by(df, "k", "v", ["ts"], ["tag"], "min").orderBy("at_ts").collect()]
    assert got == ["a", "a", "c"]


def test_doubles_are_not_cut(spark):
    df = spark.createDataFrame([("k", i, 0.6) for i in range(10)], "k string, ts long, v double")
    assert [round(r["total"], 6) for r in C.count_trigger(df, "k", "v", ["ts"]).orderBy("rn").collect()] == [3.0, 6.0]
    assert round(C.count_windows(df, "k", "v", ["ts"]).first()["sum"], 6) == 6.0
    assert [round(r["total"], 6) for r in C.count_evictor(df, "k", "v", ["ts"]).orderBy("rn").collect()] == [2.4, 2.4]


def test_strict_parsing_fails_without_ansi(spark):
    df = spark.createDataFrame([("x,5",)], "value string")
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a valid|no field"):
            P.parse_timed(df).collect()
        assert P.parse_timed(df, strict=False).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_rule_time_needs_record_time(spark):
    df = spark.createDataFrame([(1, 2)], "id long, ts long")
    with pytest.raises(ValueError):
        X.exclude(df, df, rule_time="ts")


def test_sliding_windows_expand_after_the_first_aggregate(spark):
    df = spark.range(0, 5000).select(F.timestamp_seconds(F.col("id") * 7).alias("ts"), (F.col("id") % 5).alias("k"), "id")
    got = W.window_reduce(df, "ts", "1 hour", "10 minutes", keys=["k"], value="id", order=["ts"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Expand") < plan.rindex("Aggregate")
    want = df.groupBy("k", F.window("ts", "1 hour", "10 minutes").alias("w")).agg(F.sum("id").alias("total"), F.count("*").alias("n"))
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(got.select("k", "window_start", "total", "n")) == rows(want.select("k", "w.start", "total", "n"))


def test_live_sessions_with_first_row_and_average(spark, scratch):
    _files(scratch, [["k,1,10,a", "k,2,20,b"], ["k,4,60,c", "k,9,1,d"], ["k,60,1,z"]])
    df = _stream(spark, scratch, "k string, s long, v long, tag string").withColumn("ts", F.timestamp_seconds("s"))
    out = SW.stream_sessions(df, "ts", "3 seconds", keys=[], value="v", bound="3500 milliseconds", order=["s"], carry=["tag"], with_avg=True)
    _run(out, "append", "live_sessions")
    got = sorted((r["tag"], r["total"], r["n"], r["avg_v"]) for r in spark.table("live_sessions").collect())
    assert got == [("a", 90, 3, 30.0), ("d", 1, 1, 1.0)]


def test_live_extreme_and_average_per_key(spark, scratch):
    _files(scratch, [[f"s{i % 2},{600 * i},{i}" for i in range(20)], ["s0,400000,1"]])
    df = _stream(spark, scratch, "website string, s long, time_spent long").withColumn("ts", F.timestamp_seconds("s"))
    counts = SW.stream_clicks_per_key(df, size="1 hour")
    for kind, want in (("max", {"s0": 3, "s1": 3}), ("min", {"s0": 1, "s1": 1})):
        _run(SW.stream_extreme_per_key(counts, size="1 day", kind=kind), "append", f"ext_{kind}")
        assert {r["website"]: r["clicks"] for r in spark.table(f"ext_{kind}").collect()} == want
    _run(SW.stream_int_avg_per_key(df, size="1 hour"), "append", "avgs")
    first = {r["website"]: r["avg_time_spent"] for r in spark.table("avgs").where("window_start < timestamp_seconds(1)").collect()}
    assert first == {"s0": 2, "s1": 3}


@pytest.mark.parametrize("kind", ["long", "double"])
def test_live_numbers_equal_batch_with_nulls_and_ties(spark, scratch, kind):
    """Two files, a missing number first, ties, and doubles: live forms give the batch rows."""
    import pandas as pd

    from keyflow.streaming import processors as SP
    vals = ["", "3", "3", "", "1.5" if kind == "double" else "1", "7", "7", "", "0", "2", "2", "9", ""]
    lines = [f"k{i % 2},{i},{v},t{i}" for i, v in enumerate(vals * 3)]
    _files(scratch, [lines[:17], lines[17:]])
    schema = f"k string, ts long, v {kind}, tag string"
    batch = spark.read.schema(schema).csv(scratch)
    cases = {
        "win": (SP.count_windows_stream, C.count_windows, dict(size=5, reducers=["sum", "min", "max"])),
        "trig": (SP.count_trigger_stream, C.count_trigger, dict(every=3, carry=["tag"])),
        "evict": (SP.count_evictor_stream, C.count_evictor, dict(every=4, keep=2, carry=["tag"])),
    }
    for name, (live, plain, args) in cases.items():
        _run(live(_stream(spark, scratch, schema), "k", "v", ["ts"], **args), "append", f"n_{name}_{kind}")
        got, want = spark.table(f"n_{name}_{kind}").toPandas(), plain(batch, "k", "v", ["ts"], **args).toPandas()
        keys = ["k", "win" if name == "win" else "rn"]
        pd.testing.assert_frame_equal(got.sort_values(keys)[list(want.columns)].reset_index(drop=True),
                                      want.sort_values(keys).reset_index(drop=True), check_dtype=False)
    for how in ("sum", "min", "max"):
        _run(SP.rolling_stream(_stream(spark, scratch, schema), "k", "v", ["ts"], how), "append", f"r_{how}_{kind}")
        got = spark.table(f"r_{how}_{kind}").toPandas().sort_values("ts").reset_index(drop=True)
        want = R.rolling_reduce(batch, "k", "v", how, ["ts"]).toPandas().sort_values("ts").reset_index(drop=True)
        pd.testing.assert_frame_equal(got[list(want.columns)], want, check_dtype=False)
    for how in ("min", "max"):
        _run(SP.rolling_stream(_stream(spark, scratch, schema), "k", "v", ["ts"], f"{how}_by", carry=["tag", "v"]), "append", f"b_{how}_{kind}")
        got = spark.table(f"b_{how}_{kind}").toPandas().sort_values("at_ts").reset_index(drop=True)
        want = R.rolling_by(batch, "k", "v", ["ts"], ["tag", "v"], how).toPandas().sort_values("at_ts").reset_index(drop=True)
        pd.testing.assert_frame_equal(got[list(want.columns)], want, check_dtype=False)
