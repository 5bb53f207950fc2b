"""Streaming forms equal the batch forms; a restarted query resumes exactly.

Input: the sf0.001 events split into ordered parquet files, read one file
per micro-batch (``maxFilesPerTrigger=1``).
"""

import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from compare import same
from conftest import SF_SMALL
from keyflow import sources as S
from keyflow.operators import counts as C
from keyflow.operators import exclude as X
from keyflow.operators import windows as W
from keyflow.streaming import processors as SP
from keyflow.streaming import sinks as SK
from keyflow.streaming import windows as SW


def _split_files(pdf: pd.DataFrame, folder: str, parts: int, start: int = 0) -> None:
    os.makedirs(folder, exist_ok=True)
    n = len(pdf)
    bounds = [round(n * i / parts) for i in range(parts + 1)]
    for i in range(parts):
        chunk = pdf.iloc[bounds[i]:bounds[i + 1]]
        p = os.path.join(folder, f"part-{start + i:04d}.parquet")
        t = pa.Table.from_pandas(chunk, preserve_index=False)
        t = t.cast(pa.schema([pa.field(f.name, pa.timestamp("us"))
                              if pa.types.is_timestamp(f.type) else f for f in t.schema]))
        pq.write_table(t, p)
        os.utime(p, (1_000_000 + start + i, 1_000_000 + start + i))


@pytest.fixture(scope="module")
def numbers(spark):
    src = S.numbers(spark, SF_SMALL)
    return src, src.orderBy("event_id").toPandas()


def _stream(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
            .parquet(folder))


def _run(df, out, ck):
    q = (df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_count_windows_stream_equals_batch(spark, scratch, numbers):
    like, numbers_pdf = numbers
    src = os.path.join(scratch, "in")
    _split_files(numbers_pdf, src, 4)
    schema = like.schema
    for reducers, as_text in [(("sum",), False), (("sum", "max"), False), ((), True)]:
        out = os.path.join(scratch, f"out-{len(reducers)}-{as_text}")
        s = SP.count_windows_stream(_stream(spark, src, schema), "key", "num",
                                    ["ts", "event_id"], 10, reducers, as_text)
        _run(s, out, out + "-ck")
        got = spark.read.parquet(out).toPandas()
        want = C.count_windows(like, "key", "num", ["ts", "event_id"],
                               10, reducers, as_text).toPandas()
        assert len(got) > 0
        assert same(got, want)


def test_count_trigger_and_evictor_stream_equal_batch(spark, scratch):
    bdf = S.sales(spark, SF_SMALL)
    sales = bdf.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "sales")
    _split_files(sales, src, 3)
    st = _stream(spark, src, bdf.schema)
    out1 = os.path.join(scratch, "trig")
    _run(SP.count_trigger_stream(st, "month", "profit", ["ts", "event_id"], 5,
                                 ["category", "product"]), out1, out1 + "-ck")
    want = C.count_trigger(bdf, "month", "profit", ["ts", "event_id"], 5,
                           ["category", "product"]).toPandas()
    assert same(spark.read.parquet(out1).toPandas(), want)
    out2 = os.path.join(scratch, "evict")
    _run(SP.count_evictor_stream(st, "month", "profit", ["ts", "event_id"], 5, 4,
                                 ["category", "product"]), out2, out2 + "-ck")
    want = C.count_evictor(bdf, "month", "profit", ["ts", "event_id"], 5, 4,
                           ["category", "product"]).toPandas()
    assert same(spark.read.parquet(out2).toPandas(), want)


def test_evictor_stream_recovers_after_restart(spark, scratch):
    bdf = S.sales(spark, SF_SMALL)
    sales = bdf.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "in")
    half = len(sales) // 2
    _split_files(sales.iloc[:half], src, 2, start=0)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def start():
        st = _stream(spark, src, bdf.schema)
        return _run(SP.count_evictor_stream(st, "month", "profit", ["ts", "event_id"], 5, 4,
                                            ["category", "product"]), out, ck)

    start()
    first = spark.read.parquet(out).count()
    _split_files(sales.iloc[half:], src, 2, start=2)
    start()  # same checkpoint: resumes with the saved per-key state
    got = spark.read.parquet(out).toPandas()
    want = C.count_evictor(bdf, "month", "profit", ["ts", "event_id"], 5, 4,
                           ["category", "product"]).toPandas()
    assert 0 < first < len(want)
    assert same(got, want)


def test_exclusion_running_count_stream(spark, scratch):
    like = S.employees(spark, SF_SMALL)
    emp = like.orderBy("id").toPandas()
    src = os.path.join(scratch, "emp")
    _split_files(emp, src, 3)
    rules = S.rules(spark, SF_SMALL)
    st = _stream(spark, src, like.schema)
    kept = X.exclude(st, rules)
    out = os.path.join(scratch, "out")
    _run(SP.running_count_stream(kept, "department", ["id"]), out, out + "-ck")
    want = X.running_count(X.exclude(S.employees(spark, SF_SMALL), rules), "department", ["id"])
    assert same(spark.read.parquet(out).toPandas(), want.toPandas())


def test_tumbling_stream_with_watermark_equals_batch(spark, scratch):
    like = S.timed(spark, SF_SMALL)
    timed = like.orderBy("event_id").toPandas()
    # a far-future sentinel row in a last file moves the watermark past every real window
    sentinel = pd.DataFrame({"event_id": [10**9], "ts": [pd.Timestamp("2030-01-01")],
                             "num": [0]}).astype(timed.dtypes.to_dict())
    src = os.path.join(scratch, "timed")
    _split_files(timed, src, 3)
    _split_files(sentinel, src, 1, start=3)
    st = _stream(spark, src, like.schema)
    out = os.path.join(scratch, "out")
    _run(SW.stream_window_reduce(st, "ts", "5 hours", value="num"), out, out + "-ck")
    got = spark.read.parquet(out).toPandas()
    got["window_start"] = got["window_start"].dt.tz_localize(None)
    got["window_end"] = got["window_end"].dt.tz_localize(None)
    want = W.window_reduce(S.timed(spark, SF_SMALL), "ts", "5 hours", value="num").toPandas()
    assert same(got, want)


def test_split_sink_one_pass(spark, scratch):
    like = S.integers(spark, SF_SMALL)
    ints = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "ints")
    _split_files(ints, src, 2)
    st = _stream(spark, src, like.schema)
    even, odd = os.path.join(scratch, "even"), os.path.join(scratch, "odd")
    pred = {"even": F.col("n") % 2 == 0, "odd": F.col("n") % 2 != 0}
    q = SK.write_split(st, pred, {"even": even, "odd": odd}, "split",
                       checkpoint=os.path.join(scratch, "ck"), available_now=True)
    q.awaitTermination()
    got_even = spark.read.parquet(even).drop("epoch").toPandas()
    got_odd = spark.read.parquet(odd).drop("epoch").toPandas()
    assert len(got_even) + len(got_odd) == len(ints)
    assert (got_even["n"] % 2 == 0).all() and (got_odd["n"] % 2 != 0).all()


def test_tuple_text_query_sink(spark, scratch):
    like = S.timed(spark, SF_SMALL)
    timed = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "t")
    _split_files(timed, src, 2)
    st = _stream(spark, src, like.schema)
    out = os.path.join(scratch, "text")
    q = SK.start_query(st.select("event_id", "num"), out, "text_sink", available_now=True,
                       checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    lines = spark.read.text(out).collect()
    assert len(lines) == len(timed)
    assert all(r.value.startswith("(") and r.value.endswith(")") for r in lines)


def _with_sentinel(pdf: pd.DataFrame, **over) -> pd.DataFrame:
    row = {c: pdf[c].iloc[0] for c in pdf.columns}
    row.update({"event_id": 10**9, "ts": pd.Timestamp("2030-01-01")}, **over)
    return pd.DataFrame([row]).astype(pdf.dtypes.to_dict())


def _naive(df: pd.DataFrame) -> pd.DataFrame:
    for c in df.columns:
        if hasattr(df[c], "dt") and getattr(df[c].dt, "tz", None) is not None:
            df[c] = df[c].dt.tz_localize(None)
    return df


def test_global_sessions_stream_equal_batch(spark, scratch):
    like = S.timed(spark, SF_SMALL)
    timed = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "timed")
    _split_files(timed, src, 3)
    _split_files(_with_sentinel(timed, num=0), src, 1, start=3)
    st = _stream(spark, src, like.schema)
    out = os.path.join(scratch, "out")
    _run(SW.stream_sessions(st, "ts", "10 minutes", value="num"), out, out + "-ck")
    got = _naive(spark.read.parquet(out).toPandas())
    want = W.sessions(like, "ts", "10 minutes", value="num").toPandas()
    assert same(got, want)


def test_chained_top_website_stream_equals_batch(spark, scratch):
    like = S.clicks(spark, SF_SMALL).where(F.col("country") == "US")
    clicks = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "clicks")
    _split_files(clicks, src, 3)
    _split_files(_with_sentinel(clicks), src, 1, start=3)
    st = _stream(spark, src, like.schema)
    # the sentinel's own window never closes, so it is never emitted
    counts = SW.stream_clicks_per_key(st, "website", "ts", "1 hour")
    q = (SW.stream_top_key(counts, "website", "1 hour", "max").writeStream.format("memory")
         .queryName("top_site").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = _naive(spark.sql("SELECT * FROM top_site").toPandas())
    want = W.extreme_key(W.clicks_per_key(like, "website", "ts", "1 hour"), "max",
                         size="1 hour").toPandas()
    assert same(got, want)


def test_rolling_update_final_state_equals_batch(spark, scratch):
    like = S.sales(spark, SF_SMALL)
    sales = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "sales")
    _split_files(sales, src, 3)
    st = _stream(spark, src, like.schema)
    from keyflow.streaming.rolling import distinct_count_update, rolling_update
    q = (rolling_update(st, "category", "profit", "sum").writeStream.format("memory")
         .queryName("roll_sum").outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM roll_sum").toPandas()
    want = like.groupBy("category").agg(F.sum("profit").alias("sum_profit")).toPandas()
    assert same(got, want)
    q = (distinct_count_update(st, "category", "product").writeStream.format("memory")
         .queryName("roll_distinct").outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM roll_distinct").toPandas()
    want = like.groupBy("category").agg(
        F.count_distinct("product").alias("distinct_count")).toPandas()
    assert same(got, want)


def test_buffered_sink_groups(spark, scratch):
    like = S.numbers(spark, SF_SMALL)
    nums = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "nums")
    _split_files(nums, src, 2)
    st = _stream(spark, src, like.schema)
    out = os.path.join(scratch, "groups")

    def write_group(df, epoch_id):
        (df.groupBy("grp").agg(F.count(F.lit(1)).alias("rows"))
           .write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch_id}")))

    q = (st.writeStream.foreachBatch(SK.buffered_sink(7, write_group, ["ts", "event_id"]))
         .option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    g = spark.read.parquet(out).toPandas()
    assert g["rows"].sum() == len(nums)
    assert (g["rows"] <= 7).all()
    # only the last group of each micro-batch may be partial
    assert (g.groupby("epoch")["rows"].apply(lambda r: (r < 7).sum()) <= 1).all()


def test_live_exclusion_rules_change_between_batches(spark, scratch):
    from keyflow.streaming.exclude import exclude_running_count_live
    like = S.employees(spark, SF_SMALL)
    emp = like.orderBy("id").toPandas()
    src, rules_dir = os.path.join(scratch, "emp"), os.path.join(scratch, "rules")
    first, second = emp.iloc[:75], emp.iloc[75:]
    _split_files(first, src, 1, start=0)
    # batch 0 sees rule for ids 3 and 100; id 120 is ruled out only from batch 1 on
    spark.createDataFrame([(3,), (100,)], "id long").write.mode("overwrite").parquet(
        os.path.join(rules_dir, "r0"))
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def load_rules(s):
        return s.read.parquet(os.path.join(rules_dir, "*"))

    def run():
        st = _stream(spark, src, like.schema)
        exclude_running_count_live(st, load_rules, "department", ["id"], out, "live_excl",
                                   checkpoint=ck, available_now=True).awaitTermination()

    run()
    spark.createDataFrame([(120,), (70,)], "id long").write.parquet(os.path.join(rules_dir, "r1"))
    _split_files(second, src, 1, start=1)
    run()
    got = spark.read.parquet(out).drop("epoch")
    rules_all = spark.createDataFrame([(3,), (100,), (120,)], "id long")
    # 70 arrived in batch 0, before its rule: it stays counted
    want = X.running_count(X.exclude(like, rules_all), "department", ["id"])
    assert same(got.toPandas(), want.toPandas())


@pytest.mark.parametrize("kind", ["sum", "min", "max", "min_by", "max_by"])
def test_per_record_rolling_stream_equals_batch(spark, scratch, kind):
    from keyflow.operators import rolling as R
    like = S.sales(spark, SF_SMALL).withColumn("profit", F.col("profit").cast("long"))
    sales = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "sales")
    _split_files(sales, src, 3)
    st = _stream(spark, src, like.schema)
    out = os.path.join(scratch, "out")
    order = ["ts", "event_id"]
    if kind.endswith("_by"):
        record = ["event_id", "ts", "product", "profit"]
        s = SP.rolling_stream(st, "category", "profit", order, kind, carry=record)
        want = R.rolling_by(like, "category", "profit", order, record, kind[:3])
    else:
        s = SP.rolling_stream(st, "category", "profit", order, kind, carry=["product"])
        want = R.rolling_reduce(like, "category", "profit", kind, order, carry=["product"])
    _run(s, out, out + "-ck")
    got = spark.read.parquet(out).toPandas()
    assert same(got, want.toPandas())


def test_keyed_tumbling_with_first_row_fields_stream(spark, scratch):
    like = S.sales(spark, SF_SMALL)
    sales = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "sales")
    _split_files(sales, src, 3)
    _split_files(_with_sentinel(sales, month="zz"), src, 1, start=3)
    st = _stream(spark, src, like.schema)
    out = os.path.join(scratch, "out")
    s = SW.stream_window_reduce(st, "ts", "2 hours", keys=["month"], value="profit",
                                order=["ts", "event_id"], carry=["category", "product"],
                                total="profit_sum")
    _run(s, out, out + "-ck")
    got = _naive(spark.read.parquet(out).toPandas())
    want = W.window_reduce(like, "ts", "2 hours", keys=["month"], value="profit",
                           order=["ts", "event_id"], carry=["category", "product"],
                           total="profit_sum").toPandas()
    assert same(got, want)


def test_website_metrics_update_stream(spark, scratch):
    from keyflow.operators import aggregates as AG
    from keyflow.streaming.rolling import website_metrics_update
    like = S.clicks(spark, SF_SMALL)
    clicks = like.orderBy("event_id").toPandas()
    src = os.path.join(scratch, "clicks")
    _split_files(clicks, src, 3)
    st = _stream(spark, src, like.schema)
    q = (website_metrics_update(st).writeStream.format("memory").queryName("site_metrics")
         .outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.website: r for r in spark.sql("SELECT * FROM site_metrics").collect()}
    want = {r.website: r for r in AG.website_metrics(like).collect()}
    assert got.keys() == want.keys()
    for w, e in want.items():
        g = got[w]
        assert (g.clicks, g.total_time, g.avg_time) == (e.clicks, e.total_time, e.avg_time)
        assert abs(g.distinct_users_approx - e.distinct_users) <= max(1, 0.05 * e.distinct_users)


def test_count_windows_stream_recovers_after_restart(spark, scratch, numbers):
    """C4: count windows of 10 with checkpointing; stop after part of the input,
    restart from the checkpoint, result equals the uninterrupted batch form."""
    like, pdf = numbers
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    third = len(pdf) // 3
    _split_files(pdf.iloc[:third], src, 1, start=0)

    def start():
        st = _stream(spark, src, like.schema)
        _run(SP.count_windows_stream(st, "key", "num", ["ts", "event_id"], 10), out, ck)

    start()
    _split_files(pdf.iloc[third:2 * third], src, 1, start=1)
    start()
    _split_files(pdf.iloc[2 * third:], src, 1, start=2)
    start()
    got = spark.read.parquet(out).toPandas()
    want = C.count_windows(like, "key", "num", ["ts", "event_id"], 10).toPandas()
    assert same(got, want)
