"""Live operators that keep state: each equals its batch twin, over several triggers and a restart."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from compare import same
from conftest import SF_SMALL
from keyflow import sources as S
from keyflow.operators import counts as C
from keyflow.operators import exclude as X
from keyflow.operators import lateness as L
from keyflow.operators import parts as PT
from keyflow.operators import reduce as RD
from keyflow.operators import rolling as R
from keyflow.streaming import buffers as B
from keyflow.streaming import distinct as D
from keyflow.streaming import feedback as FB
from keyflow.streaming import lateness as SL
from keyflow.streaming import processors as SP
from keyflow.streaming import rules as SR
from keyflow.streaming import state as ST
from keyflow.streaming import timers as TM
from test_streaming import _run, _split_files, _stream

ORDER = ["ts", "event_id"]


def _files(spark, folder, schema, per):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(per)).parquet(folder)


@pytest.fixture(scope="module")
def numbers(spark):
    like = S.numbers(spark, SF_SMALL)
    return like, like.orderBy(*ORDER).toPandas()


# --- buffered sink ------------------------------------------------------------

def _groups(spark, path):
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return rows, rows.groupBy("key", "grp").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("event_id", "pos").alias("first_id"),
        F.max_by("event_id", "pos").alias("last_id")).toPandas()


@pytest.mark.parametrize("per, restart", [(1, False), (7, False), (1, True)])
def test_buffer_gives_full_groups_whatever_the_trigger(spark, scratch, numbers, per, restart):
    like, pdf = numbers
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))

    def start():
        B.start_buffered(_files(spark, src, like.schema, per), ORDER, 5, out, "buffered", key="key", checkpoint=ck,
                         available_now=True).awaitTermination()

    if restart:
        half = len(pdf) // 2 + 3
        _split_files(pdf.iloc[:half], src, 3)
        start()
        _split_files(pdf.iloc[half:], src, 4, start=3)
    else:
        _split_files(pdf, src, 7)
    start()
    rows, got = _groups(spark, out)
    want = C.buffered_groups(like, "key", ORDER, 5, "event_id").toPandas()
    assert len(got) and same(got, want)
    # what was not written waits in the checkpoint: nothing is lost, nothing doubled
    waiting = ST.remainders(spark, ck, ["key"])
    ids = [r["event_id"] for r in rows.select("event_id").collect()] + [r["event_id"] for r in waiting.collect()]
    assert sorted(ids) == sorted(pdf["event_id"])
    assert waiting.groupBy("key").count().agg(F.max("count")).first()[0] < 5


def test_buffers_without_a_key_are_lanes(spark, scratch, numbers):
    like, pdf = numbers
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    _split_files(pdf, src, 2)
    _run(B.buffered_stream(_files(spark, src, like.schema, 1), ORDER, 7, lanes=3), out, out + "-ck")
    got = spark.read.parquet(out).groupBy("lane", "grp").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("p")).toPandas()
    assert set(got["lane"]) == {0, 1, 2} and (got["n"] == 7).all() and (got["p"] == 6).all()


# --- rules and records as one stream ------------------------------------------

def test_rules_in_state_equal_the_batch_join(spark, scratch):
    e, r = S.employees(spark, SF_SMALL), S.rules(spark, SF_SMALL)
    folders = [os.path.join(scratch, x) for x in ("e", "r", "out", "ck")]
    # rules are read whole with the first files, so the arrival order is that of the batch join
    ep = e.orderBy("id").toPandas()
    third = len(ep) // 3
    _split_files(ep.iloc[:third], folders[0], 2)
    _split_files(r.orderBy("effective_ts").toPandas(), folders[1], 1)
    history = spark.createDataFrame([("BUILDING", 100)], "department string, count long")

    def start():
        out = SR.exclude_count_stream(_stream(spark, folders[0], e.schema), _stream(spark, folders[1], r.schema),
                                      "department", ["id"], "id", "effective_ts", initial=history)
        _run(out, folders[2], folders[3])

    start()
    _split_files(ep.iloc[third:], folders[0], 2, start=2)
    start()
    kept = X.exclude(e, r, rule_time="effective_ts", record_time="id")
    want = X.running_count(kept, "department", ["id"]).toPandas()
    want.loc[want["department"] == "BUILDING", "count"] += 100
    assert same(spark.read.parquet(folders[2]).toPandas(), want)
    # the counters of the stopped query are those of the batch run
    got = ST.counters(spark, folders[3], "department", operator=0).toPandas()
    if set(got["department"]) != set(want["department"]):
        got = ST.counters(spark, folders[3], "department", operator=1).toPandas()
    assert same(got, want.groupby("department", as_index=False)["count"].max())


def test_a_rule_applies_from_its_arrival_on(spark, scratch):
    records = pd.DataFrame({"id": [1, 2, 1, 1, 2], "at": [1, 2, 3, 5, 6], "department": list("aabab")})
    rules = pd.DataFrame({"id": [1], "effective_ts": [3]})
    e, r = (os.path.join(scratch, x) for x in ("e", "r"))
    _split_files(records, e, 1)
    _split_files(rules, r, 1)
    es, rs = (spark.read.parquet(x).schema for x in (e, r))
    out = SR.exclude_count_stream(_stream(spark, e, es), _stream(spark, r, rs), "department", ["at"], "at", "effective_ts")
    _run(out, os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    got = spark.read.parquet(os.path.join(scratch, "out")).collect()
    assert sorted(tuple(x) for x in got) == [("a", 1, 1), ("a", 2, 2), ("b", 6, 1)]


# --- processing time ----------------------------------------------------------

def _until(path, spark, done, limit=90):
    stop = time.time() + limit
    while time.time() < stop:
        try:
            rows = spark.read.parquet(path)
            if done(rows):
                return rows.collect()
        except Exception:  # noqa: BLE001 - nothing written yet
            pass
        time.sleep(1)
    raise AssertionError("no output in time")


@pytest.mark.parametrize("make, key", [
    (lambda s: TM.processing_windows(s, "2 seconds", "num", ORDER, key="k", carry=["event_id"]), True),
    (lambda s: TM.processing_sessions(s, "2 seconds", "num", ORDER, key="k", carry=["event_id"]), True),
    (lambda s: TM.processing_windows(s, "4 seconds", "num", ORDER, slide="2 seconds"), False),
])
def test_silent_stream_still_closes_its_windows(spark, scratch, make, key):
    like = S.timed(spark, SF_SMALL).withColumn("k", F.col("event_id") % 3)
    pdf = like.orderBy("event_id").limit(300).toPandas()
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    _split_files(pdf, src, 1)
    q = (make(_files(spark, src, like.schema, 1)).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-ck").trigger(processingTime="300 milliseconds").start())
    times = 1 if key else 2  # a sliding row is in two windows
    try:
        rows = _until(out, spark, lambda r: r.agg(F.sum("n")).first()[0] == times * len(pdf))
        time.sleep(3)
        assert spark.read.parquet(out).count() == len(rows)  # once
    finally:
        q.stop()
    assert sum(r["total"] for r in rows) == times * int(pdf["num"].sum())
    if key:
        assert sorted((r["k"], r["event_id"]) for r in rows) == [(k, pdf.loc[pdf["k"] == k, "event_id"].min()) for k in range(3)]


# --- exact late rows ----------------------------------------------------------

@pytest.mark.parametrize("per", [1, 5])
def test_live_late_rows_equal_the_replay(spark, scratch, per):
    from keyflow.catalog import disordered
    like = disordered(spark, SF_SMALL)
    pdf = like.orderBy("arrival", "event_id").toPandas()
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))

    def start():
        SL.start_exact_windows(_files(spark, src, like.schema, per), "ts", ["arrival", "event_id"], "1 hour", "30 minutes",
                               "num", out, "exact", checkpoint=ck, available_now=True).awaitTermination()

    half = len(pdf) // 2 + 1
    _split_files(pdf.iloc[:half], src, 3)
    start()
    _split_files(pdf.iloc[half:], src, 2, start=3)
    start()
    late = L.late_flag(like, "ts", ["arrival", "event_id"], "1 hour", "30 minutes").where("late")
    want = late.select(*like.columns, "watermark").toPandas()
    read = spark.read.option("recursiveFileLookup", "true")
    assert len(want) and same(read.parquet(f"{out}/late").toPandas(), want)
    # all windows but those the last watermark leaves open
    all_windows = L.tumbling_drop_late(like, "ts", ["arrival", "event_id"], "1 hour", "30 minutes", "num")
    top = pdf["ts"].max() - pd.Timedelta("30 minutes")
    done = all_windows.where(F.col("window_end") <= F.lit(top)).toPandas()
    assert len(done) and same(read.parquet(f"{out}/windows").toPandas(), done)
    last = max(int(x.split("=")[1]) for x in os.listdir(f"{ck}/open") if x.startswith("epoch="))
    left = SL.open_windows(spark, ck, last, "kf_end long, total long, n long").toPandas()
    assert left["n"].sum() + done["n"].sum() + len(want) == len(pdf)


# --- distinct values ----------------------------------------------------------

def test_live_distinct_equals_batch_over_a_restart(spark, scratch):
    like = S.clicks(spark, SF_SMALL).select("event_id", "ts", "website", "user_id")
    pdf = like.orderBy(*ORDER).toPandas()
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    half = len(pdf) // 2
    for part, at in ((pdf.iloc[:half], 0), (pdf.iloc[half:], 2)):
        _split_files(part, src, 2, start=at)
        _run(D.distinct_stream(_stream(spark, src, like.schema), "website", "user_id", ORDER), out, ck)
    want = R.running_distinct(like, "website", "user_id", ORDER, out="distinct_count").drop("user_id").toPandas()
    assert same(spark.read.parquet(out).toPandas(), want)
    # state holds each pair once, and one counter per key
    pairs = len(pdf.drop_duplicates(["website", "user_id"]))
    sizes = sorted(ST.read_state(spark, ck, v, operator=o).count() for o, v in _operators(spark, ck, {"seen", "count"}))
    assert sizes == sorted([pairs, pdf["website"].nunique()])


def _operators(spark, ck, variables):
    found = []
    for r in ST.operators(spark, ck).collect():
        for v in variables:
            try:
                ST.read_state(spark, ck, v, operator=r["operatorId"]).count()
                found.append((r["operatorId"], v))
            except Exception:  # noqa: BLE001 - the operator has no such variable
                pass
    return found


# --- any associative reducer --------------------------------------------------

P = 1_000_003


def composing():
    """Composition of affine maps, the earlier first: associative, not commutative."""
    p = P  # a function of its own, which workers get by value

    def then(a, b):
        return a[0] * b[0] % p, (a[1] * b[0] + b[1]) % p

    return then


then = composing()


def then_columns(a, b):
    return F.struct(F.pmod(a["a"] * b["a"], F.lit(P)).alias("a"), F.pmod(a["b"] * b["a"] + b["b"], F.lit(P)).alias("b"))


def maps(spark):
    n = S.numbers(spark, SF_SMALL)
    return n.select("event_id", "ts", "key", (F.col("key") % 97 + 2).alias("a"), (F.col("event_id") % 101).alias("b"))


def brute(pdf, key):
    out, acc = [], {}
    for r in pdf.itertuples():
        k = getattr(r, key) if key else 0
        now = (r.a, r.b)
        acc[k] = then(acc[k], now) if k in acc else now
        out.append((r.event_id, *acc[k]))
    return sorted(out), {k: v for k, v in acc.items()}


@pytest.mark.parametrize("columns", [None, then_columns])
@pytest.mark.parametrize("keys, block", [([], 7), (["key"], 3), ([], 256)])
def test_reducer_of_the_caller(spark, columns, keys, block):
    df = maps(spark)
    rows, last = brute(df.orderBy(*ORDER).toPandas(), keys[0] if keys else None)
    reducer = RD.Reducer(then, columns)
    got = RD.reduce_running(df, keys, ORDER, ["a", "b"], reducer, block=block, rows_per_bucket=50).collect()
    assert sorted((r["event_id"], r["a"], r["b"]) for r in got) == rows
    got = RD.reduce_all(df, keys, ORDER, ["a", "b"], reducer, block=block).collect()
    assert {(r["key"] if keys else 0): (r["a"], r["b"]) for r in got} == last


def test_live_reducer_equals_batch(spark, scratch):
    df = maps(spark)
    pdf = df.orderBy(*ORDER).toPandas()
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    half = len(pdf) // 2
    for part, at in ((pdf.iloc[:half], 0), (pdf.iloc[half:], 2)):
        _split_files(part, src, 2, start=at)
        for size in (None, 10):
            _run(SP.reduced_stream(_stream(spark, src, df.schema), "key", ORDER, ["a", "b"], then, size),
                 os.path.join(scratch, f"out{size}"), f"{ck}{size}")
    reducer = RD.Reducer(then)
    assert same(spark.read.parquet(os.path.join(scratch, "outNone")).toPandas(),
                RD.reduce_running(df, ["key"], ORDER, ["a", "b"], reducer, block=5).toPandas())
    want = RD.count_windows_by(df, "key", ORDER, ["a", "b"], reducer, 10).toPandas()
    assert len(want) and same(spark.read.parquet(os.path.join(scratch, "out10")).toPandas(), want)


def test_strings_joined_in_order(spark):
    df = spark.createDataFrame([(1, i, f"{i},") for i in range(40)] + [(2, 0, None)], "k int, t long, s string")
    reducer = RD.Reducer(lambda a, b: ((a[0] or "") + (b[0] or ""),))
    got = {r["k"]: r["s"] for r in RD.reduce_all(df, ["k"], ["t"], ["s"], reducer, block=4).collect()}
    assert got == {1: "".join(f"{i}," for i in range(40)), 2: None}
    assert RD.reduce_all(df.limit(0), ["k"], ["t"], ["s"], reducer).count() == 0


# --- parts by bytes and age ---------------------------------------------------

def _skewed(spark, n=400):
    rows = [(i, "x" * (i * 7919 % 37 if i % 50 else 600 * (1 + i % 3)), i * 1_000_000) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, n * 1_000_000)], "id long, line string, at long")


def test_no_part_is_over_the_limit(spark, scratch):
    df = _skewed(spark)
    for age in (None, "100 seconds"):
        p = PT.assign_parts(df, "line", ["id"], 256, time_col="at" if age else None, max_age=age, rows_per_bucket=30)
        sizes = PT.part_sizes(p, "id").collect()
        alone = {r["first_row"] for r in sizes if r["rows"] == 1}
        assert all(r["bytes"] <= 256 or r["first_row"] in alone for r in sizes)
        assert sum(r["rows"] for r in sizes) == 401
        if age:
            assert all(r["last_row"] - r["first_row"] < 100 for r in sizes)
        else:
            mean = sum(r["bytes"] for r in sizes if r["bytes"] <= 256) / sum(r["bytes"] <= 256 for r in sizes)
            assert mean > 64
    PT.write_parts(df, "line", ["id"], scratch, 256, time_col="at", max_age="100 seconds")
    want = {(r["period"], r["part"]): r["bytes"] for r in sizes}
    got = {}
    for root, _, files in os.walk(scratch):
        for f in files:
            if f.endswith(".txt"):
                period, part = (x.split("=")[1] for x in root.split("/")[-2:])
                assert (int(period), part) not in got  # one file a part
                got[int(period), part] = os.path.getsize(os.path.join(root, f))
    assert got == want


def test_live_parts_go_on_over_restarts(spark, scratch):
    df = _skewed(spark).withColumn("k", F.lit("a"))
    pdf = df.orderBy("id").toPandas()
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    for part, at in ((pdf.iloc[:150], 0), (pdf.iloc[150:], 2)):
        _split_files(part, src, 2, start=at)
        _run(B.rolled_stream(_stream(spark, src, df.schema), "line", ["id"], 256, "at", "20 seconds", key="k"), out, ck)
    got = {r["id"]: (r["part"], r["bytes"]) for r in spark.read.parquet(out).collect()}
    part, size = 0, 0
    for r in pdf.itertuples():
        if size >= 256:
            part, size = part + 1, 0
        n = 1 + len(r.line or "")
        size += n
        assert got[r.id] == (part, n)


# --- feedback -----------------------------------------------------------------

def test_feedback_edge_finishes_over_a_restart(spark, scratch):
    pdf = pd.DataFrame({"event_id": range(6), "v": [5, 6, 7, 8, 9, 10], "n": [5, 6, 7, 8, 9, 10]})
    pdf["n"] = 0
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    _split_files(pdf.iloc[:4], src, 1)
    schema = spark.read.parquet(src).schema

    def step(df):
        return df.select("event_id", (F.col("v") + 1).alias("v"), (F.col("n") + 1).alias("n"))

    def done(df):
        return F.col("v") >= 10

    def start():
        return FB.start_feedback(_stream(spark, src, schema), step, done, out, "loop", tick="300 milliseconds", checkpoint=ck)

    q = start()
    _until(f"{out}/epoch=1", spark, lambda r: True)
    q.stop()  # rows are still in the loop
    left = FB.unfinished(spark, "loop", schema, checkpoint=ck)
    kept = [tuple(r) for r in left.collect()]
    read = spark.read.option("recursiveFileLookup", "true")
    before = read.parquet(out).count()
    assert kept and before + len(kept) == 4
    drained = FB.drain(spark, "loop", schema, step, done, 20, checkpoint=ck)
    assert sorted(r["v"] for r in drained.collect()) == [10] * len(kept)
    _split_files(pdf.iloc[4:], src, 1, start=1)
    q = start()
    try:
        stop = time.time() + 90
        while time.time() < stop and read.parquet(out).count() < 6:
            time.sleep(0.5)
    finally:
        q.stop()
    got = sorted(tuple(r) for r in read.parquet(out).select("event_id", "v", "n").collect())
    assert got == [(i, 10, 5 - i) for i in range(6)]


# --- state read back ----------------------------------------------------------

def test_open_count_windows_are_read_back(spark, scratch, numbers):
    like, pdf = numbers
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    _split_files(pdf, src, 3)
    _run(SP.count_windows_stream(_stream(spark, src, like.schema), "key", "num", ORDER, 10), out, ck)
    got = ST.remainders(spark, ck, ["key"]).toPandas().rename(columns={"x": "num"})
    n = pdf.groupby("key").cumcount()
    full = pdf.groupby("key")["num"].transform("size") // 10 * 10
    want = pdf.loc[n >= full, ["key", "num"]]
    assert len(want) and same(got, want)
    assert ST.operators(spark, ck).count() == 1


# --- recursive slices ---------------------------------------------------------

@pytest.mark.parametrize("cap, n, limit, tied", [(16, 20_000, 100, False), (4, 4_000, 50, False), (4, 4_000, 50, True)])
def test_slices_of_slices_keep_the_bound(spark, monkeypatch, cap, n, limit, tied):
    import keyflow.plans.scan as scan
    from keyflow.plans.scan import Agg, assign_buckets, prefix_scan, simple_scan
    monkeypatch.setattr(scan, "MAX_SLICES", cap)
    t = F.lit(5) if tied else F.col("id") * 3
    df = spark.range(n).select(F.lit("h").alias("k"), t.cast("long").alias("t"), "id")
    d, pairs = assign_buckets(df, ["k"], "t", limit, then=["id"])
    largest, slices = d.groupBy("k", "__kf_bucket").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert largest <= 2 * limit and slices <= pairs
    total = [Agg("s", "sum", F.col("id"))]
    got = prefix_scan(df, ["k"], ["t", "id"], total, rows_per_bucket=limit)
    want = simple_scan(df, ["k"], ["t", "id"], total)
    assert got.exceptAll(want).isEmpty() and got.count() == n


def test_sessions_over_slices_of_slices(spark, monkeypatch):
    import keyflow.plans.scan as scan
    from keyflow.operators import windows as W
    monkeypatch.setattr(scan, "MAX_SLICES", 3)
    df = S.timed(spark, SF_SMALL)
    got = W.sessions(df, "ts", "10 minutes", value="num", rows_per_bucket=20).toPandas()
    assert same(got, W.session_reduce_simple(df, "ts", "10 minutes", value="num").toPandas())


def test_sessions_with_most_rows_on_one_time(spark):
    from keyflow.operators import windows as W
    df = S.timed(spark, SF_SMALL).withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"))
                                             .otherwise(F.col("ts")))
    got = W.sessions(df, "ts", "10 minutes", value="num", order=ORDER, carry=["event_id"], rows_per_bucket=20).toPandas()
    assert same(got, W.session_reduce_simple(df, "ts", "10 minutes", value="num", order=ORDER, carry=["event_id"]).toPandas())
    L_ = L.sessions_drop_late(df, "ts", ["event_id"], "10 minutes", "1 day", "num", rows_per_bucket=20).toPandas()
    assert same(L_, L.sessions_drop_late(df, "ts", ["event_id"], "10 minutes", "1 day", "num").toPandas())


# --- live forms of operators that had none ------------------------------------

@pytest.mark.parametrize("keys", [["category"], []])
def test_live_sliding_windows_equal_batch(spark, scratch, keys):
    from keyflow.operators import windows as W
    from keyflow.streaming import windows as SW
    from test_streaming import _naive, _with_sentinel
    like = S.sales(spark, SF_SMALL)
    pdf = like.orderBy(*ORDER).toPandas()
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    _split_files(pdf, src, 3)
    _split_files(_with_sentinel(pdf), src, 1, start=3)
    _run(SW.stream_window_reduce(_stream(spark, src, like.schema), "ts", "3 hours", "1 hour", keys=keys, value="profit"),
         out, out + "-ck")
    want = W.window_reduce(like, "ts", "3 hours", "1 hour", keys=keys, value="profit").toPandas()
    assert same(_naive(spark.read.parquet(out).toPandas()), want)


def test_live_running_average_and_sequence(spark, scratch):
    from keyflow.sources import sequence
    from keyflow.streaming import rolling as SRL
    like = S.sales(spark, SF_SMALL)
    src = os.path.join(scratch, "in")
    _split_files(like.orderBy(*ORDER).toPandas(), src, 3)
    q = (SRL.running_avg_update(_stream(spark, src, like.schema), "category", "profit").writeStream.format("memory")
         .queryName("running_avg").outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r[0]: tuple(r)[1:] for r in spark.table("running_avg").collect()}
    want = like.groupBy("category").agg(F.sum("profit"), F.count(F.lit(1)), F.avg("profit")).collect()
    for r in want:
        assert any(abs(x - r[3]) < 1e-6 for x in got[r[0]] if x is not None)
    q = (sequence(spark, 3, 8, streaming=True, rows_per_batch=2).writeStream.format("memory").queryName("seq")
         .trigger(processingTime="100 milliseconds").start())
    try:
        stop = time.time() + 60
        while time.time() < stop and spark.table("seq").count() < 6:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted(r["value"] for r in spark.table("seq").collect()) == [3, 4, 5, 6, 7, 8]
