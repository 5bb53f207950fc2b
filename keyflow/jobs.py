"""End-to-end jobs: text lines in, tuple-text files out.

Thin compositions of the operators, shaped like the analytics jobs they
replace: read delimited lines (a file or folder; a folder stream when
``streaming=True``), parse, compute, write one ``(f0,f1,...)`` line per
result row.  Batch jobs take the arrival order of text input from
``monotonically_increasing_id()`` taken right after the read: it follows
the split order and the line order inside each split, so for one input file
(the jobs' usual input) it is the order the lines appear in the file.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow.functions import parse as P
from keyflow.functions import rejects as RJ
from keyflow.functions.time import from_epoch_millis
from keyflow.operators import aggregates as AG
from keyflow.operators import counts as C
from keyflow.operators import exclude as X
from keyflow.operators import filters as FL
from keyflow.operators import lateness as L
from keyflow.operators import rolling as R
from keyflow.operators import windows as W
from keyflow.operators.iterate import iterate
from keyflow.sources.sequence import sequence
from keyflow.sources.text import read_lines, with_line_number
from keyflow.streaming import processors as SP
from keyflow.streaming import timers as TM
from keyflow.streaming.sinks import start_query, write_split, write_text

ARRIVAL = "arrival"


def with_arrival(lines: DataFrame) -> DataFrame:
    """Arrival order of batch text input (file split order, then line order)."""
    return lines.withColumn(ARRIVAL, F.monotonically_increasing_id())


def rolling_profit_job(spark: SparkSession, in_path: str, out_dir: str) -> None:
    """Profit lines -> per-month rolling sum, min, min-by, max, max-by (five outputs)."""
    rec = P.parse_profit(with_arrival(read_lines(spark, in_path)), with_count=False,
                         keep=[ARRIVAL])
    carry = ["category", "product"]
    for kind in ("sum", "min", "max"):
        out = R.rolling_reduce(rec, "month", "profit", kind, [ARRIVAL], carry=carry)
        write_text(out, os.path.join(out_dir, kind),
                   ["month", *carry, f"{kind}_profit", ARRIVAL])
    for kind in ("min", "max"):
        out = R.rolling_by(rec, "month", "profit", [ARRIVAL], ["category", "product", "profit"],
                           kind)
        write_text(out, os.path.join(out_dir, f"{kind}_by"),
                   ["month", "category", "product", "profit", f"at_{ARRIVAL}"])


def trips_job(spark: SparkSession, in_path: str, out_dir: str) -> None:
    """Trip lines -> passengers per destination, average passengers per pickup
    and per driver, over ongoing trips with a drop-off."""
    trips = FL.ongoing_with_dropoff(P.parse_trip(read_lines(spark, in_path)))
    write_text(AG.passengers_per_destination(trips), os.path.join(out_dir, "destinations"))
    write_text(AG.avg_passengers_by(trips, "pickup").select("pickup", "avg_passengers"),
               os.path.join(out_dir, "avg_per_pickup"))
    write_text(AG.avg_passengers_by(trips, "driver").select("driver", "avg_passengers"),
               os.path.join(out_dir, "avg_per_driver"))


def clicks_job(spark: SparkSession, in_dir: str, out_dir: str, window: str = "5 seconds",
               checkpoint: str | None = None, available_now: bool = True) -> list:
    """Live click lines (folder stream) -> US clicks per website per ingest-time
    window, and the running distinct users per website (exact, update mode).

    Both are written in update mode, a folder per micro-batch: a window's row
    is its count so far and replaces the one of an earlier batch, so the last
    window's clicks are there too when the job ends."""
    lines = read_lines(spark, in_dir, streaming=True)
    us = FL.filter_country(P.parse_click(lines))
    counts = (us.withColumn("ingest_ts", F.current_timestamp())
                .withWatermark("ingest_ts", "0 seconds")
                .groupBy("website", F.window("ingest_ts", window).alias("w"))
                .agg(F.count(F.lit(1)).alias("clicks"))
                .select("website", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "clicks"))
    ck = checkpoint or os.path.join(out_dir, "_checkpoints")
    c = (counts.writeStream.outputMode("update")
         .foreachBatch(lambda b, e: write_text(b, os.path.join(out_dir, "clicks_per_website", f"epoch={e}")))
         .option("checkpointLocation", os.path.join(ck, "clicks")))
    q1 = (c.trigger(availableNow=True) if available_now else c).start()
    users = us.dropDuplicates(["website", "user_id"]).groupBy("website").agg(
        F.count(F.lit(1)).alias("distinct_users"))
    w = (users.writeStream.outputMode("update")
         .foreachBatch(lambda b, e: write_text(b, os.path.join(out_dir, "users", f"epoch={e}")))
         .option("checkpointLocation", os.path.join(ck, "users")))
    q2 = (w.trigger(availableNow=True) if available_now else w).start()
    return [q1, q2]


def exclusion_job(spark: SparkSession, emp_path: str, rules_path: str, out_dir: str) -> None:
    """Employee lines minus excluded ids -> running count per department."""
    emp = with_arrival(read_lines(spark, emp_path))
    emp = P.parse_employee(emp, keep=[ARRIVAL])
    rules = read_lines(spark, rules_path).select(F.split("value", ",")[0].alias("id"))
    kept = X.exclude(emp, rules)
    write_text(X.running_count(kept, "department", [ARRIVAL]),
               os.path.join(out_dir, "emp_count"), ["department", "count"])


def count_window_job(spark: SparkSession, in_dir: str, out_dir: str, size: int = 10,
                     checkpoint: str | None = None, available_now: bool = True):
    """Live ``key,number`` lines -> sum of every ``size`` numbers per key
    (managed state, checkpointed: a restart resumes from the last batch).

    Arrival order is (file, place in the file's split)."""
    lines = read_lines(spark, in_dir, streaming=True, max_files_per_trigger=1)
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("pos"))
    rec = P.parse_keyed(with_line_number(placed), keep=["file", "pos", "line"])
    out = SP.count_windows_stream(rec, "key", "num", ["file", "pos", "line"], size=size)
    return start_query(out.select("sum"), os.path.join(out_dir, "sums"), "count_window_job",
                       available_now=available_now,
                       checkpoint=checkpoint or os.path.join(out_dir, "_checkpoint"))


def split_job(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str | None = None):
    """Live integer lines -> even and odd outputs in one pass."""
    nums = P.parse_int(read_lines(spark, in_dir, streaming=True))
    preds = FL.parity("n")
    return write_split(nums, preds, {k: os.path.join(out_dir, k) for k in preds}, "split_job",
                       checkpoint=checkpoint or os.path.join(out_dir, "_checkpoint"),
                       available_now=True)


def iteration_job(spark: SparkSession, out_dir: str, start: int = 0, end: int = 5,
                  target: int = 10) -> None:
    """``(v, 0)`` for v in start..end, stepped until v reaches ``target``."""
    s = sequence(spark, start, end).select(F.col("value").alias("v"),
                                           F.lit(0).cast("long").alias("n"))

    def step(df: DataFrame) -> DataFrame:
        at = F.col("v") == target
        return df.select(F.when(at, F.col("v")).otherwise(F.col("v") + 1).alias("v"),
                         F.when(at, F.col("n")).otherwise(F.col("n") + 1).alias("n"))

    out = iterate(s, step, lambda df: F.col("v") == target, max_iter=abs(target - start) + 1)
    write_text(out, os.path.join(out_dir, "iteration"))


def _timed_profit(spark: SparkSession, in_path: str) -> DataFrame:
    """Timed profit lines ``epoch_millis,month,category,product,profit`` with their arrival."""
    parts = F.split("value", ",")
    return with_arrival(read_lines(spark, in_path)).select(
        from_epoch_millis(parts[0].cast("long")).alias("ts"), parts[1].alias("month"), parts[2].alias("category"),
        parts[3].alias("product"), parts[4].cast("int").alias("profit"), ARRIVAL)


_PROFIT = {"keys": ["month"], "value": "profit", "order": ["ts", ARRIVAL], "carry": ["category", "product"],
           "total": "profit_sum", "with_avg": True}


def tumbling_profit_job(spark: SparkSession, in_path: str, out_dir: str,
                        size: str = "2 seconds") -> None:
    """Timed profit lines -> per-month tumbling-window profit sum, count and average."""
    write_text(W.window_reduce(_timed_profit(spark, in_path), "ts", size, **_PROFIT), os.path.join(out_dir, "tumbling"))


def sliding_profit_job(spark: SparkSession, in_path: str, out_dir: str, size: str = "3 seconds",
                       slide: str = "1 second") -> None:
    """Timed profit lines -> per-month sliding-window profit sum, count and average."""
    write_text(W.window_reduce(_timed_profit(spark, in_path), "ts", size, slide, **_PROFIT), os.path.join(out_dir, "sliding"))


def session_profit_job(spark: SparkSession, in_path: str, out_dir: str, gap: str = "1 second") -> None:
    """Timed profit lines -> per-month session profit sum, count and average."""
    write_text(W.sessions(_timed_profit(spark, in_path), "ts", gap, **_PROFIT), os.path.join(out_dir, "session"))


def late_session_job(spark: SparkSession, in_path: str, out_dir: str, gap: str = "1 second",
                     bound: str = "3500 milliseconds") -> None:
    """Timed number lines in arrival order -> sums of global sessions and, beside them, the late lines."""
    rec = P.parse_timed(with_arrival(read_lines(spark, in_path)), keep=[ARRIVAL])
    write_text(L.sessions_drop_late(rec, "ts", [ARRIVAL], gap, bound, "num"), os.path.join(out_dir, "sessions"))
    late = L.late_rows(rec, "ts", [ARRIVAL], bound).where("late")
    write_text(late.select("ts", "num"), os.path.join(out_dir, "late"))


def count_evictor_job(spark: SparkSession, in_path: str, out_dir: str, every: int = 5, keep: int = 4) -> None:
    """Profit lines -> per month, at every ``every``-th record the profit of the last ``keep``."""
    rec = P.parse_profit(with_arrival(read_lines(spark, in_path)), keep=[ARRIVAL])
    out = C.count_evictor(rec, "month", "profit", [ARRIVAL], every=every, keep=keep, carry=["category", "product"])
    write_text(out, os.path.join(out_dir, "count_evictor"))


def list_window_job(spark: SparkSession, in_path: str, out_dir: str, size: int = 10) -> None:
    """``key,number`` lines -> the numbers of every ``size`` lines of a key, as text."""
    rec = P.parse_keyed(with_arrival(read_lines(spark, in_path)), keep=[ARRIVAL])
    out = C.count_windows(rec, "key", "num", [ARRIVAL], size, reducers=(), as_text=True)
    write_text(out.select("items"), os.path.join(out_dir, "lists"))


def click_windows_job(spark: SparkSession, in_dir: str, out_dir: str, size: str = "5 seconds",
                      checkpoint: str | None = None) -> StreamingQuery:
    """Live click lines -> US clicks and time spent per website and window of processing time, each written
    once when its window is over, also if the input falls silent.  Runs until stopped."""
    lines = read_lines(spark, in_dir, streaming=True)
    us = FL.filter_country(P.parse_click(lines), "US")
    out = TM.processing_windows(us, size, "time_spent", ["user_id"], key="website", total="total_time")
    return start_query(out, os.path.join(out_dir, "click_windows"), "click_windows_job", interval="500 milliseconds",
                       checkpoint=checkpoint or os.path.join(out_dir, "_checkpoint_click_windows"))


def dead_letter_job(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str | None = None) -> StreamingQuery:
    """Live click lines -> records, and lines that are none with field and cause, in one pass."""
    checked = RJ.check(read_lines(spark, in_dir, streaming=True), RJ.CLICK)
    parts = RJ.outputs()
    return write_split(checked, parts, {k: os.path.join(out_dir, k) for k in parts}, "dead_letter_job",
                       checkpoint=checkpoint or os.path.join(out_dir, "_checkpoint_dead_letters"), available_now=True)


def count_trigger_job(spark: SparkSession, in_path: str, out_dir: str, every: int = 5) -> None:
    """Profit lines -> per month, at every ``every``-th record the profit sum so far."""
    rec = P.parse_profit(with_arrival(read_lines(spark, in_path)), keep=[ARRIVAL])
    out = C.count_trigger(rec, "month", "profit", [ARRIVAL], every=every,
                          carry=["category", "product"])
    write_text(out, os.path.join(out_dir, "count_trigger"))
