"""Registered queries: one per operator of the analytics jobs, on the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Window sizes are the reference's second-sized windows scaled to
the test data's event spacing (minutes to hours); all are parameters of the
operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow import sources as S
from keyflow.functions import parse as P
from keyflow.functions import rejects as RJ
from keyflow.operators import aggregates as AG
from keyflow.operators import counts as C
from keyflow.operators import exclude as X
from keyflow.operators import filters as FL
from keyflow.operators import lateness as L
from keyflow.operators import parts as PT
from keyflow.operators import reduce as RD
from keyflow.operators import rolling as R
from keyflow.operators import windows as W
from keyflow.operators.iterate import iterate

SALES_ORDER = ["ts", "event_id"]
SALES_CARRY = ["category", "product"]

# window settings used by the registered queries
KEYED_TUMBLE = "2 hours"          # reference: 2 s
ALL_TUMBLE = "5 hours"            # reference: 5 s
KEYED_SLIDE = ("3 hours", "1 hour")   # reference: 3 s / 1 s
ALL_SLIDE = ("4 hours", "2 hours")    # reference: 4 s / 2 s
SESSION_GAP = "10 minutes"        # reference: 1 s
CLICK_WINDOW = "1 hour"           # reference: 5 ms
LATE_WINDOW = "1 hour"
LATE_BOUND = "30 minutes"         # reference: 3500 ms
ARRIVAL_SPREAD_S = 7200           # arrival = ts + (event_id * 7919 % 7200) s


Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        _Q[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_Q)


# --- parsing -------------------------------------------------------------------

@query("parse_profit")
def q_parse_profit(spark, d):
    lines = S.to_lines(S.profit(spark, d), ["date", "month", "category", "product", "profit"])
    return P.parse_profit(lines)


@query("parse_profit_fields")
def q_parse_profit_fields(spark, d):
    lines = S.to_lines(S.profit(spark, d), ["date", "month", "category", "product", "profit"])
    return P.parse_profit(lines, with_count=False)


def employee_lines(spark, d) -> DataFrame:
    """Employee lines ``id,name,mail,department`` (one per customer)."""
    name = F.concat(F.lit("n"), F.col("id").cast("string"))
    return S.to_lines(S.employees(spark, d), ["id", name, F.concat(name, F.lit("@x")), "department"])


@query("parse_employees")
def q_parse_employees(spark, d):
    return P.parse_employee(employee_lines(spark, d))


@query("tuple_text_trips")
def q_tuple_text_trips(spark, d):
    from keyflow.functions.text import tuple_text
    t = S.trips(spark, d)
    return t.select("id", tuple_text(["id", "license_plate", "ongoing", "pickup", "dropoff", "passengers"]).alias("text"))


@query("parse_timed")
def q_parse_timed(spark, d):
    from keyflow.functions.time import epoch_millis
    t = S.timed(spark, d)
    lines = S.to_lines(t, [epoch_millis("ts"), "num"], keep=["event_id"])
    return P.parse_timed(lines, keep=["event_id"])


def trip_lines(spark, d) -> DataFrame:
    t = S.trips(spark, d)
    pax = F.when(F.col("passengers") == 0, F.lit(None)).otherwise(F.col("passengers"))
    ongoing = F.when(F.col("ongoing"), "yes").otherwise("no")
    return S.to_lines(t, ["id", "license_plate", "car_type", "driver", ongoing, "pickup",
                          "dropoff", pax])


@query("parse_trips")
def q_parse_trips(spark, d):
    return P.parse_trip(trip_lines(spark, d))


CLICK_FIELDS = ["user_id", "network", "ip", "country", "website", "time_spent"]


@query("parse_clicks")
def q_parse_clicks(spark, d):
    lines = S.to_lines(S.clicks(spark, d), CLICK_FIELDS, keep=["event_id"])
    return P.parse_click(lines, keep=["event_id"])


# --- dead letters ---------------------------------------------------------------

def _damaged(lines: DataFrame, number: str) -> DataFrame:
    """Lines of which some are cut short, hold a word in place of a number, or are missing."""
    n = F.col(number)
    last = F.regexp_replace("value", ",[^,]*$", "")
    return lines.withColumn("value", F.when(n % 7 == 0, last).when(n % 11 == 0, F.concat(last, F.lit(",abc")))
                            .when(n % 13 == 0, F.lit("")).when(n % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("value")))


def checked_clicks(spark, d) -> DataFrame:
    lines = S.to_lines(S.clicks(spark, d), CLICK_FIELDS, keep=["event_id"])
    return RJ.check(_damaged(lines, "event_id"), RJ.CLICK, keep=["event_id"])


@query("rejected_clicks")
def q_rejected_clicks(spark, d):
    return RJ.rejected(checked_clicks(spark, d), keep=["event_id"])


@query("accepted_clicks")
def q_accepted_clicks(spark, d):
    return RJ.accepted(checked_clicks(spark, d))


@query("rejected_trips")
def q_rejected_trips(spark, d):
    lines = trip_lines(spark, d).select(F.split("value", ",")[0].cast("long").alias("trip"), "value")
    return RJ.rejected(RJ.check(_damaged(lines, "trip"), RJ.TRIP, keep=["trip"]), keep=["trip"])


# --- output parts by bytes and age ------------------------------------------------

PART_BYTES = 65_536
SALES_PART_BYTES = 2_048
PART_AGE = "6 hours"


@query("rolled_parts_documents")
def q_rolled_parts_documents(spark, d):
    """Lines of very uneven width (whole documents) in parts of at most 64 KB."""
    docs = S.table(spark, d, "documents").select("doc_id", F.col("text").alias("line"))
    parts = PT.assign_parts(docs, "line", ["doc_id"], PART_BYTES)
    return PT.part_sizes(parts, "doc_id")


@query("rolled_parts_sales")
def q_rolled_parts_sales(spark, d):
    """Tuple-text lines per category in parts of at most 2 KB and six hours."""
    from keyflow.functions.text import tuple_text
    sales = S.sales(spark, d).withColumn("line", tuple_text(["month", "category", "product", "profit"]))
    parts = PT.assign_parts(sales, "line", SALES_ORDER, SALES_PART_BYTES, keys=["category"], time_col="ts", max_age=PART_AGE)
    return PT.part_sizes(parts, "event_id", keys=["category"])


# --- reducers of the caller -------------------------------------------------------

MODULUS = 1_000_003


def affine_maps(spark, d) -> DataFrame:
    """Affine maps ``x -> a x + b`` (modulo a prime) per user and type: composing them is associative, not commutative."""
    ev = S.table(spark, d, "events")
    return ev.select("event_id", "ts", F.col("user_id").alias("key"), F.col("event_type").alias("category"),
                     (F.col("user_id") % 97 + 2).cast("long").alias("a"), (F.col("event_id") % 101).cast("long").alias("b"))


COMPOSE = RD.Reducer(
    lambda f, g: (f[0] * g[0] % MODULUS, (f[1] * g[0] + g[1]) % MODULUS),
    lambda f, g: F.struct(((f["a"] * g["a"]) % MODULUS).alias("a"), ((f["b"] * g["a"] + g["b"]) % MODULUS).alias("b")))


@query("count10_composed")
def q_count10_composed(spark, d):
    return RD.count_windows_by(affine_maps(spark, d), "key", SALES_ORDER, ["a", "b"], COMPOSE, size=10)


@query("composed_by_category")
def q_composed_by_category(spark, d):
    return RD.reduce_all(affine_maps(spark, d), ["category"], SALES_ORDER, ["a", "b"], COMPOSE)


@query("composed_running_by_user")
def q_composed_running(spark, d):
    return RD.reduce_running(affine_maps(spark, d), ["key"], SALES_ORDER, ["a", "b"], COMPOSE)


# --- filters and split ---------------------------------------------------------

@query("filter_us")
def q_filter_us(spark, d):
    return FL.filter_country(S.clicks(spark, d), "US")


@query("filter_trips")
def q_filter_trips(spark, d):
    return FL.ongoing_with_dropoff(S.trips(spark, d))


def parsed_integers(spark, d) -> DataFrame:
    """Integer lines (one number per line) parsed back into ``n``."""
    lines = S.to_lines(S.integers(spark, d), ["n"], keep=["event_id"])
    return P.parse_int(lines, keep=["event_id"])


@query("split_even")
def q_split_even(spark, d):
    return FL.split_by(parsed_integers(spark, d), FL.parity("n"))["even"]


@query("split_odd")
def q_split_odd(spark, d):
    return FL.split_by(parsed_integers(spark, d), FL.parity("n"))["odd"]


# --- rolling keyed aggregates (positional sum/min/max, minBy/maxBy) -----------

def _rolling(kind):
    def q(spark, d):
        return R.rolling_reduce(S.sales(spark, d), "month", "profit", kind, SALES_ORDER,
                                carry=SALES_CARRY)
    return q


query("rolling_sum")(_rolling("sum"))
query("rolling_min")(_rolling("min"))
query("rolling_max")(_rolling("max"))

# The month is one key; the same operators over several keys of unequal size.
TYPE_CARRY = ["month", "product"]


@query("rolling_sum_by_category")
def q_rolling_sum_by_category(spark, d):
    return R.rolling_reduce(S.sales(spark, d), "category", "profit", "sum", SALES_ORDER, carry=TYPE_CARRY)


@query("rolling_max_record_by_category")
def q_rolling_max_record_by_category(spark, d):
    return R.rolling_by(S.sales(spark, d), "category", "profit", SALES_ORDER,
                        record=["event_id", "ts", "product", "profit"], kind="max")


@query("count_trigger_by_category")
def q_count_trigger_by_category(spark, d):
    return C.count_trigger(S.sales(spark, d), "category", "profit", SALES_ORDER, every=5, carry=TYPE_CARRY)


@query("tumbling_by_category")
def q_tumbling_by_category(spark, d):
    return W.window_reduce(S.sales(spark, d), "ts", KEYED_TUMBLE, keys=["category"], value="profit", order=SALES_ORDER,
                           carry=TYPE_CARRY, total="profit_sum", with_avg=True)


@query("sliding_by_category")
def q_sliding_by_category(spark, d):
    return W.window_reduce(S.sales(spark, d), "ts", *KEYED_SLIDE, keys=["category"], value="profit", order=SALES_ORDER,
                           carry=TYPE_CARRY, total="profit_sum", with_avg=True)


@query("session_by_category")
def q_session_by_category(spark, d):
    return W.sessions(S.sales(spark, d), "ts", SESSION_GAP, keys=["category"], value="profit", order=SALES_ORDER,
                      carry=TYPE_CARRY, total="profit_sum", with_avg=True)


def _rolling_by(kind):
    def q(spark, d):
        return R.rolling_by(S.sales(spark, d), "month", "profit", SALES_ORDER,
                            record=["event_id", "ts", "category", "product", "profit"],
                            kind=kind)
    return q


query("rolling_min_by")(_rolling_by("min"))
query("rolling_max_by")(_rolling_by("max"))


# --- trips analytics -----------------------------------------------------------

def ongoing_trips(spark, d) -> DataFrame:
    return FL.ongoing_with_dropoff(S.trips(spark, d))


@query("popular_destinations")
def q_popular(spark, d):
    return AG.passengers_per_destination(ongoing_trips(spark, d))


@query("popular_destinations_running")
def q_popular_running(spark, d):
    return AG.passengers_per_destination_running(ongoing_trips(spark, d))


@query("top_destination")
def q_top_destination(spark, d):
    return AG.top_destinations(ongoing_trips(spark, d), k=3)


@query("avg_passengers_per_pickup")
def q_avg_pickup(spark, d):
    return AG.avg_passengers_by(ongoing_trips(spark, d), "pickup")


@query("avg_passengers_per_pickup_running")
def q_avg_pickup_running(spark, d):
    return AG.avg_passengers_by_running(ongoing_trips(spark, d), "pickup")


@query("avg_passengers_per_driver")
def q_avg_driver(spark, d):
    return AG.avg_passengers_by(ongoing_trips(spark, d), "driver")


# --- distinct users ------------------------------------------------------------

def us_clicks(spark, d) -> DataFrame:
    return FL.filter_country(S.clicks(spark, d), "US")


@query("distinct_users_running")
def q_distinct_running(spark, d):
    return R.running_distinct(us_clicks(spark, d), "website", "user_id", SALES_ORDER,
                              out="distinct_users")


@query("distinct_users")
def q_distinct(spark, d):
    return us_clicks(spark, d).groupBy("website").agg(
        F.count_distinct("user_id").alias("distinct_users"))


@query("distinct_lines_running")
def q_distinct_lines(spark, d):
    c = us_clicks(spark, d)
    lines = S.to_lines(c, CLICK_FIELDS, keep=["website", "ts", "event_id"])
    return R.running_distinct(lines, "website", "value", SALES_ORDER,
                              out="distinct_lines").drop("value")


# --- group aggregates ----------------------------------------------------------

@query("avg_profit_per_month")
def q_avg_profit(spark, d):
    return AG.profit_per_month(S.profit(spark, d))


@query("website_metrics")
def q_website_metrics(spark, d):
    return AG.website_metrics(S.clicks(spark, d))


@query("website_metrics_merge")
def q_website_metrics_merge(spark, d):
    return AG.merge_website_metrics(AG.website_metrics_partials(S.clicks(spark, d)))


# --- time windows --------------------------------------------------------------

def _sales_window(**kw):
    def q(spark, d):
        return W.window_reduce(S.sales(spark, d), "ts", keys=["month"], value="profit",
                               order=SALES_ORDER, carry=SALES_CARRY, total="profit_sum",
                               with_avg=True, **kw)
    return q


query("tumbling_keyed")(_sales_window(size=KEYED_TUMBLE))
query("sliding_keyed")(_sales_window(size=KEYED_SLIDE[0], slide=KEYED_SLIDE[1]))


@query("session_keyed")
def q_session_keyed(spark, d):
    return W.sessions(S.sales(spark, d), "ts", SESSION_GAP, keys=["month"], value="profit",
                      order=SALES_ORDER, carry=SALES_CARRY, total="profit_sum",
                      with_avg=True)


@query("tumbling_all")
def q_tumbling_all(spark, d):
    return W.window_reduce(S.timed(spark, d), "ts", ALL_TUMBLE, value="num")


@query("sliding_all")
def q_sliding_all(spark, d):
    return W.window_reduce(S.timed(spark, d), "ts", ALL_SLIDE[0], ALL_SLIDE[1], value="num")


@query("session_all")
def q_session_all(spark, d):
    return W.sessions(S.timed(spark, d), "ts", SESSION_GAP, value="num")


# --- count windows -------------------------------------------------------------

@query("count_trigger")
def q_count_trigger(spark, d):
    return C.count_trigger(S.sales(spark, d), "month", "profit", SALES_ORDER, every=5,
                           carry=SALES_CARRY)


@query("count_evictor")
def q_count_evictor(spark, d):
    return C.count_evictor(S.sales(spark, d), "month", "profit", SALES_ORDER, every=5,
                           keep=4, carry=SALES_CARRY)


def keyed_numbers(spark, d) -> DataFrame:
    """``key,number`` lines (the keyed-state jobs' input) parsed back, with the
    arrival order carried next to each line."""
    lines = S.to_lines(S.numbers(spark, d), ["key", "num"], keep=SALES_ORDER)
    return P.parse_keyed(lines, keep=SALES_ORDER)


@query("count10_sum")
def q_count10_sum(spark, d):
    return C.count_windows(keyed_numbers(spark, d), "key", "num", SALES_ORDER, size=10)


@query("count10_list")
def q_count10_list(spark, d):
    return C.count_windows(keyed_numbers(spark, d), "key", "num", SALES_ORDER, size=10,
                           reducers=(), as_text=True)


@query("count10_reduce")
def q_count10_reduce(spark, d):
    return C.count_windows(keyed_numbers(spark, d), "key", "num", SALES_ORDER, size=10,
                           reducers=("sum", "max"))


@query("buffered_groups")
def q_buffered_groups(spark, d):
    return C.buffered_groups(S.numbers(spark, d), "key", SALES_ORDER, size=5, id_col="event_id")


# --- click windows -------------------------------------------------------------

def _click_counts(spark, d):
    return W.clicks_per_key(us_clicks(spark, d), "website", "ts", CLICK_WINDOW)


@query("clicks_per_website")
def q_clicks_per_website(spark, d):
    return _click_counts(spark, d)


@query("max_clicks_per_site")
def q_max_clicks_per_site(spark, d):
    return W.extreme_per_key(_click_counts(spark, d), "max", size=CLICK_WINDOW)


@query("min_clicks_per_site")
def q_min_clicks_per_site(spark, d):
    return W.extreme_per_key(_click_counts(spark, d), "min", size=CLICK_WINDOW)


@query("max_clicks_per_site_daily")
def q_max_clicks_per_site_daily(spark, d):
    return W.extreme_per_key(_click_counts(spark, d), "max", size="1 day")


@query("min_clicks_per_site_daily")
def q_min_clicks_per_site_daily(spark, d):
    return W.extreme_per_key(_click_counts(spark, d), "min", size="1 day")


@query("top_website")
def q_top_website(spark, d):
    return W.extreme_key(_click_counts(spark, d), "max", size=CLICK_WINDOW)


@query("bottom_website")
def q_bottom_website(spark, d):
    return W.extreme_key(_click_counts(spark, d), "min", size=CLICK_WINDOW)


@query("avg_time_per_website")
def q_avg_time(spark, d):
    return W.int_avg_per_key(us_clicks(spark, d), "website", "time_spent", "ts", CLICK_WINDOW)


# --- late data -----------------------------------------------------------------

def disordered(spark, d) -> DataFrame:
    """Timed numbers with a replayed arrival time (rows arrive out of order)."""
    t = S.timed(spark, d)
    delay = (F.col("event_id") * 7919) % ARRIVAL_SPREAD_S
    return t.withColumn("arrival", F.timestamp_add("SECOND", delay, F.col("ts")))


@query("late_flag")
def q_late_flag(spark, d):
    return L.late_flag(disordered(spark, d), "ts", ["arrival", "event_id"], LATE_WINDOW,
                       LATE_BOUND).select("event_id", "ts", "arrival", "watermark", "late")


@query("tumbling_drop_late")
def q_drop_late(spark, d):
    return L.tumbling_drop_late(disordered(spark, d), "ts", ["arrival", "event_id"],
                                LATE_WINDOW, LATE_BOUND, "num")


@query("session_drop_late")
def q_session_drop_late(spark, d):
    return L.sessions_drop_late(disordered(spark, d), "ts", ["arrival", "event_id"],
                                SESSION_GAP, LATE_BOUND, "num")


# --- exclusion joins -----------------------------------------------------------

@query("exclude_running_count")
def q_exclude_running(spark, d):
    kept = X.exclude(S.employees(spark, d), S.rules(spark, d))
    return X.running_count(kept, "department", ["id"])


@query("exclude_total")
def q_exclude_total(spark, d):
    kept = X.exclude(S.employees(spark, d), S.rules(spark, d))
    return X.total_count(kept, "department")


@query("exclude_asof")
def q_exclude_asof(spark, d):
    kept = X.exclude(S.employees(spark, d), S.rules(spark, d), rule_time="effective_ts",
                     record_time="id")
    return X.running_count(kept, "department", ["id"])


# --- iteration -----------------------------------------------------------------

def step_to_ten(df: DataFrame) -> DataFrame:
    """One loop step: ``(v, n) -> (v + 1, n + 1)`` unless v is already 10."""
    at = F.col("v") == 10
    return df.select("event_id", F.when(at, F.col("v")).otherwise(F.col("v") + 1).alias("v"),
                     F.when(at, F.col("n")).otherwise(F.col("n") + 1).alias("n"))


@query("iterate_to_ten")
def q_iterate(spark, d):
    ev = S.table(spark, d, "events")
    start = ev.select("event_id", (F.col("event_id") % 6).alias("v"),
                      F.lit(0).cast("long").alias("n"))
    return iterate(start, step_to_ten, lambda df: F.col("v") == 10, max_iter=20)
