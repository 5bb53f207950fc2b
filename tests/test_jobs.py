"""End-to-end jobs on text files derived from the sf0.001 tables."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from keyflow import jobs as J
from keyflow import sources as S
from keyflow.catalog import trip_lines
from keyflow.operators import aggregates as AG
from keyflow.operators import counts as C
from keyflow.operators import filters as FL


def _text(df, path):
    df.coalesce(1).write.mode("overwrite").text(path)


def _read(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_trips_job(spark, scratch):
    src = os.path.join(scratch, "trips")
    _text(trip_lines(spark, SF_SMALL), src)
    out = os.path.join(scratch, "out")
    J.trips_job(spark, src, out)
    got = _read(spark, os.path.join(out, "destinations"))
    trips = FL.ongoing_with_dropoff(S.trips(spark, SF_SMALL))
    want = sorted(f"({r.dropoff},{r.total_passengers})"
                  for r in AG.passengers_per_destination(trips).collect())
    assert got == want
    assert len(_read(spark, os.path.join(out, "avg_per_driver"))) == \
        trips.select("driver").distinct().count()


def test_rolling_and_trigger_jobs_follow_line_order(spark, scratch):
    sales = S.sales(spark, SF_SMALL).orderBy("ts", "event_id")
    lines = sales.select(F.concat_ws(",", F.lit("01-01-2024"), "month", "category", "product",
                                     F.col("profit").cast("string")).alias("value"))
    src = os.path.join(scratch, "profit")
    _text(lines, src)
    out = os.path.join(scratch, "out")
    J.rolling_profit_job(spark, src, out)
    sums = _read(spark, os.path.join(out, "sum"))
    assert len(sums) == sales.count()
    total = sales.agg(F.sum("profit")).first()[0]
    assert any(v.split(",")[3] == str(total) for v in sums)
    J.count_trigger_job(spark, src, out)
    got = spark.read.text(os.path.join(out, "count_trigger")).count()
    want = C.count_trigger(sales, "month", "profit", ["ts", "event_id"]).count()
    assert got == want


def test_exclusion_and_iteration_jobs(spark, scratch):
    emp = S.employees(spark, SF_SMALL).orderBy("id")
    e_src, r_src = os.path.join(scratch, "emp"), os.path.join(scratch, "rules")
    _text(emp.select(F.concat_ws(",", F.col("id").cast("string"), F.lit("a"), F.lit("b"),
                                 "department").alias("value")), e_src)
    _text(S.rules(spark, SF_SMALL).select(F.concat_ws(",", F.col("id").cast("string"),
                                                      F.lit("x")).alias("value")), r_src)
    out = os.path.join(scratch, "out")
    J.exclusion_job(spark, e_src, r_src, out)
    n_rules = S.rules(spark, SF_SMALL).count()
    assert len(_read(spark, os.path.join(out, "emp_count"))) == emp.count() - n_rules
    J.iteration_job(spark, out)
    assert _read(spark, os.path.join(out, "iteration")) == sorted(
        f"(10,{n})" for n in range(5, 11))


def test_streaming_jobs(spark, scratch):
    nums = S.numbers(spark, SF_SMALL).orderBy("ts", "event_id")
    src = os.path.join(scratch, "nums")
    _text(nums.select(F.concat_ws(",", F.col("key").cast("string"),
                                  F.col("num").cast("string")).alias("value")), src)
    out = os.path.join(scratch, "out")
    J.count_window_job(spark, src, out).awaitTermination()
    got = sorted(int(v.strip("()")) for v in _read(spark, os.path.join(out, "sums")))
    want = sorted(r["sum"] for r in C.count_windows(nums, "key", "num", ["ts", "event_id"],
                                                    size=10).collect())
    assert got == want
    ints = os.path.join(scratch, "ints")
    _text(S.integers(spark, SF_SMALL).select(F.col("n").cast("string").alias("value")), ints)
    J.split_job(spark, ints, os.path.join(scratch, "split")).awaitTermination()
    even = spark.read.parquet(os.path.join(scratch, "split", "even")).count()
    odd = spark.read.parquet(os.path.join(scratch, "split", "odd")).count()
    assert even + odd == S.integers(spark, SF_SMALL).count()
    clicks = os.path.join(scratch, "clicks")
    from keyflow.catalog import CLICK_FIELDS
    from keyflow.sources.text import to_lines
    _text(to_lines(S.clicks(spark, SF_SMALL), CLICK_FIELDS), clicks)
    for q in J.clicks_job(spark, clicks, os.path.join(scratch, "c")):
        q.awaitTermination()
    users = _read(spark, os.path.join(scratch, "c", "users"))
    assert len(users) == 5


def _tuples(df):
    from keyflow.functions import tuple_text
    return sorted(r[0] for r in df.select(tuple_text(df.columns)).collect())


def test_window_jobs_equal_their_operators(spark, scratch):
    from keyflow.functions.time import epoch_millis
    from keyflow.operators import windows as W
    sales = S.sales(spark, SF_SMALL).orderBy("ts", "event_id")
    src, out = os.path.join(scratch, "timed"), os.path.join(scratch, "out")
    _text(sales.select(F.concat_ws(",", epoch_millis("ts").cast("string"), "month", "category", "product",
                                   F.col("profit").cast("string")).alias("value")), src)
    J.tumbling_profit_job(spark, src, out, "2 hours")
    J.sliding_profit_job(spark, src, out, "3 hours", "1 hour")
    J.session_profit_job(spark, src, out, "10 minutes")
    how = {"keys": ["month"], "value": "profit", "order": ["ts", "event_id"], "carry": ["category", "product"],
           "total": "profit_sum", "with_avg": True}
    whole = sales.withColumn("ts", F.date_trunc("millisecond", "ts").cast("timestamp_ntz"))
    for name, want in (("tumbling", W.window_reduce(whole, "ts", "2 hours", **how)),
                       ("sliding", W.window_reduce(whole, "ts", "3 hours", "1 hour", **how)),
                       ("session", W.sessions(whole, "ts", "10 minutes", **how))):
        assert _read(spark, os.path.join(out, name)) == _tuples(want)


def test_late_session_evictor_and_list_jobs(spark, scratch):
    from keyflow.catalog import disordered
    from keyflow.functions.time import epoch_millis
    from keyflow.operators import lateness as L
    out = os.path.join(scratch, "out")
    d = disordered(spark, SF_SMALL).withColumn("ts", F.date_trunc("millisecond", "ts").cast("timestamp_ntz"))
    src = os.path.join(scratch, "timed")
    _text(d.orderBy("arrival", "event_id").select(F.concat_ws(",", epoch_millis("ts").cast("string"),
                                                              F.col("num").cast("string")).alias("value")), src)
    J.late_session_job(spark, src, out, "10 minutes", "30 minutes")
    want = L.sessions_drop_late(d, "ts", ["arrival", "event_id"], "10 minutes", "30 minutes", "num")
    assert _read(spark, os.path.join(out, "sessions")) == _tuples(want)
    late = L.late_rows(d, "ts", ["arrival", "event_id"], "30 minutes").where("late").count()
    assert late and len(_read(spark, os.path.join(out, "late"))) == late

    sales = S.sales(spark, SF_SMALL).orderBy("ts", "event_id")
    profit = os.path.join(scratch, "profit")
    _text(sales.select(F.concat_ws(",", F.lit("x"), "month", "category", "product",
                                   F.col("profit").cast("string")).alias("value")), profit)
    J.count_evictor_job(spark, profit, out)
    assert _read(spark, os.path.join(out, "count_evictor")) == _tuples(
        C.count_evictor(sales, "month", "profit", ["ts", "event_id"], carry=["category", "product"]))

    nums = S.numbers(spark, SF_SMALL).orderBy("ts", "event_id")
    keyed = os.path.join(scratch, "keyed")
    _text(nums.select(F.concat_ws(",", F.col("key").cast("string"), F.col("num").cast("string")).alias("value")), keyed)
    J.list_window_job(spark, keyed, out)
    want = C.count_windows(nums, "key", "num", ["ts", "event_id"], 10, reducers=(), as_text=True)
    assert _read(spark, os.path.join(out, "lists")) == _tuples(want.select("items"))


def test_live_click_windows_and_dead_letters(spark, scratch):
    import time
    from keyflow.catalog import CLICK_FIELDS
    clicks, out = os.path.join(scratch, "clicks"), os.path.join(scratch, "out")
    lines = S.to_lines(S.clicks(spark, SF_SMALL), CLICK_FIELDS)
    _text(lines, clicks)
    q = J.click_windows_job(spark, clicks, out, "2 seconds")
    want = FL.filter_country(S.clicks(spark, SF_SMALL)).agg(F.count("*"), F.sum("time_spent")).first()
    try:
        stop, got = time.time() + 90, []
        while time.time() < stop and sum(int(r[-1]) for r in got) < want[0]:
            time.sleep(1)
            try:
                got = [r.strip("()").split(",") for r in _read(spark, os.path.join(out, "click_windows"))]
            except Exception:  # noqa: BLE001 - nothing written yet
                pass
    finally:
        q.stop()
    assert (sum(int(r[-1]) for r in got), sum(int(r[-2]) for r in got)) == tuple(want)

    bad = spark.createDataFrame([("u1,n,ip,US,w,xx",), ("u1,n,ip",), ("",)], "value string")
    mixed = os.path.join(scratch, "mixed")
    _text(lines.unionByName(bad), mixed)
    J.dead_letter_job(spark, mixed, out).awaitTermination()
    read = spark.read.option("recursiveFileLookup", "true")
    rejects = read.parquet(os.path.join(out, "rejected")).select("reject_line", "reject_field", "reject_cause").collect()
    assert sorted(map(tuple, rejects)) == [("", "network", "missing"), ("u1,n,ip", "country", "missing"),
                                           ("u1,n,ip,US,w,xx", "time_spent", "not int")]
    assert read.parquet(os.path.join(out, "accepted")).count() == lines.count()
