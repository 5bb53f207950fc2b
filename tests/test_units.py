"""Hand-computed cases, including every quirk the operators keep."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keyflow.functions import parse as P
from keyflow.functions.text import tuple_text
from keyflow.operators import counts as C
from keyflow.operators import exclude as X
from keyflow.operators import filters as FL
from keyflow.operators import rolling as R
from keyflow.operators import windows as W
from keyflow.operators.iterate import IterationLimitError, iterate
from keyflow.sources import sequence


def T(s):
    return dt.datetime.fromisoformat(s)


def test_parse_profit_sample_line(spark):
    df = spark.createDataFrame([("01-06-2018,June,Category5,Bat,12",)], "value string")
    row = P.parse_profit(df).first()
    assert tuple(row) == ("June", "Category5", "Bat", 12, 1)


def test_parse_trip_null_sentinels(spark):
    df = spark.createDataFrame([("t1,P1,Sedan,D1,yes,'null','null','null'",),
                                ("t2,P2,SUV,D2,no,A,B,3",)], "value string")
    rows = {r.id: r for r in P.parse_trip(df).collect()}
    assert rows["t1"].ongoing is True and rows["t1"].pickup is None
    assert rows["t1"].dropoff is None and rows["t1"].passengers == 0
    assert rows["t2"].ongoing is False and rows["t2"].passengers == 3


def test_parse_strict_fails_lenient_nulls(spark):
    df = spark.createDataFrame([("x,5",)], "value string")
    with pytest.raises(Exception):
        P.parse_keyed(df).collect()
    assert P.parse_keyed(df, strict=False).first().key is None


def test_parse_timed_epoch_millis(spark):
    df = spark.createDataFrame([("1704067207179,5",)], "value string")
    r = P.parse_timed(df).first()
    assert r.ts == T("2024-01-01 00:00:07.179") and r.num == 5


def test_tuple_text_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(tuple_text(["x", "y", "z"]).alias("t")).first().t == "(a,null,3)"


def test_split_negative_odd(spark):
    df = spark.createDataFrame([(-3,), (-2,), (0,), (7,)], "n int")
    out = FL.split_by(df, FL.parity("n"))
    assert sorted(r.n for r in out["even"].collect()) == [-2, 0]
    assert sorted(r.n for r in out["odd"].collect()) == [-3, 7]


def test_rolling_min_by_tie_keeps_earliest(spark):
    df = spark.createDataFrame(
        [("k", T("2024-01-01 00:00:01"), 1, 5), ("k", T("2024-01-01 00:00:02"), 2, 3),
         ("k", T("2024-01-01 00:00:03"), 3, 3), ("k", T("2024-01-01 00:00:04"), 4, 9)],
        "k string, ts timestamp_ntz, event_id long, v int")
    got = R.rolling_by(df, "k", "v", ["ts", "event_id"], ["event_id", "v"], "min")
    held = [r.event_id for r in got.orderBy("at_event_id").collect()]
    assert held == [1, 2, 2, 2]
    got = R.rolling_by(df, "k", "v", ["ts", "event_id"], ["event_id", "v"], "max")
    held = [r.event_id for r in got.orderBy("at_event_id").collect()]
    assert held == [1, 1, 1, 4]


def test_rolling_sum_keeps_first_row_fields(spark):
    df = spark.createDataFrame([("m", 1, "a", 10), ("m", 2, "b", 5), ("n", 3, "c", 1)],
                               "m string, id long, cat string, p int")
    got = R.rolling_reduce(df, "m", "p", "sum", ["id"], carry=["cat"]).orderBy("id").collect()
    assert [(r.cat, r.sum_p) for r in got] == [("a", 10), ("a", 15), ("c", 1)]


def test_session_rows_exactly_gap_apart_merge(spark):
    df = spark.createDataFrame(
        [(T("2024-01-01 00:00:00"), 1, 1), (T("2024-01-01 00:00:01"), 2, 1),
         (T("2024-01-01 00:00:02.000001"), 3, 1)], "ts timestamp_ntz, event_id long, v long")
    got = W.sessions(df, "ts", "1 second", value="v").orderBy("window_start").collect()
    assert [(r.n, r.total) for r in got] == [(2, 2), (1, 1)]
    assert got[0].window_end == T("2024-01-01 00:00:02")


def test_one_row_window_and_epoch_alignment(spark):
    df = spark.createDataFrame([(T("2024-01-01 00:00:07"), 1, 4)],
                               "ts timestamp_ntz, event_id long, v long")
    r = W.window_reduce(df, "ts", "5 seconds", value="v").first()
    assert (r.window_start, r.window_end, r.total, r.n) == (
        T("2024-01-01 00:00:05"), T("2024-01-01 00:00:10"), 4, 1)


def test_count_window_trailing_partial_not_emitted(spark):
    df = spark.range(25).select(F.lit(1).alias("k"), F.col("id"), F.col("id").alias("x"))
    got = C.count_windows(df, "k", "x", ["id"], size=10, reducers=("sum",), as_text=True)
    rows = got.orderBy("win").collect()
    assert [r.sum for r in rows] == [45, 145]
    assert rows[0]["items"] == " 0 1 2 3 4 5 6 7 8 9"


def test_count_trigger_and_evictor(spark):
    df = spark.range(1, 11).select(F.lit("m").alias("k"), F.col("id"), F.col("id").alias("x"))
    trig = C.count_trigger(df, "k", "x", ["id"], every=5).orderBy("rn").collect()
    assert [(r.rn, r.total) for r in trig] == [(5, 15), (10, 55)]
    ev = C.count_evictor(df, "k", "x", ["id"], every=5, keep=4).orderBy("rn").collect()
    assert [(r.rn, r.total, r.n) for r in ev] == [(5, 14, 4), (10, 34, 4)]
    long = C.count_evictor(df, "k", "x", ["id"], every=3, keep=5).orderBy("rn").collect()
    assert [(r.rn, r.total, r.n) for r in long] == [(3, 6, 3), (6, 20, 5), (9, 35, 5)]


def test_exclude_asof_only_later_records(spark):
    emp = spark.createDataFrame([(1, "a"), (5, "a"), (9, "a")], "id long, department string")
    rules = spark.createDataFrame([(5, 3), (9, 10)], "id long, effective_ts long")
    plain = X.exclude(emp, rules)
    assert sorted(r.id for r in plain.collect()) == [1]
    asof = X.exclude(emp, rules, rule_time="effective_ts", record_time="id")
    assert sorted(r.id for r in asof.collect()) == [1, 9]


def test_iterate_sequence_to_ten(spark):
    start = sequence(spark, 0, 5).select(F.col("value").alias("v"), F.lit(0).cast("long").alias("n"))

    def step(d):
        at = F.col("v") == 10
        return d.select(F.when(at, F.col("v")).otherwise(F.col("v") + 1).alias("v"),
                        F.when(at, F.col("n")).otherwise(F.col("n") + 1).alias("n"))

    first = sorted(tuple(r) for r in step(start).collect())
    assert first == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1)]
    out = iterate(start, step, lambda d: F.col("v") == 10, max_iter=20)
    assert sorted(tuple(r) for r in out.collect()) == [(10, n) for n in range(5, 11)]


def test_iterate_raises_when_rows_never_leave(spark):
    start = spark.createDataFrame([(11, 0)], "v long, n long")
    with pytest.raises(IterationLimitError):
        iterate(start, lambda d: d.select((F.col("v") + 1).alias("v"), "n"),
                lambda d: F.col("v") == 10, max_iter=3)


def test_parse_employee_fields(spark):
    df = spark.createDataFrame([("7,a,b,Sales",)], "value string")
    r = P.parse_employee(df).first()
    assert (r.id, r.department, r.line) == ("7", "Sales", "7,a,b,Sales")


def test_text_sink_rolls_files_by_records(spark, scratch):
    import os
    from keyflow.streaming.sinks import write_text
    df = spark.range(25).select(F.col("id"), (F.col("id") * 2).alias("x")).coalesce(1)
    out = os.path.join(scratch, "rolled")
    write_text(df, out, max_records_per_file=10)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 3
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert len(lines) == 25 and "(3,6)" in lines


def test_processing_time_window_smoke(spark, scratch):
    import os
    from keyflow.functions.time import with_ingest_time
    from keyflow.streaming.windows import stream_window_reduce
    src = os.path.join(scratch, "in")
    spark.range(20).select(F.col("id").alias("event_id"),
                           F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
                           F.col("id").alias("num")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    st = spark.readStream.schema(schema).parquet(src)
    q = (stream_window_reduce(st, "ts", "1 hour", value="num", processing_time=True)
         .writeStream.format("memory").queryName("ingest_windows").outputMode("update")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT sum(total) AS s, sum(n) AS n FROM ingest_windows").first()
    assert (got.s, got.n) == (190, 20)
    assert "ingest_ts" in with_ingest_time(st).columns
