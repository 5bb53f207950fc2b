"""DuckDB SQL for every registered query (the correctness oracle).

Views here restate ``keyflow.sources.tables`` in DuckDB SQL; window starts use
epoch arithmetic (``epoch_us(ts) // width``) so they are epoch-aligned like
Spark's ``window()``.  ``epoch_ms`` rounds in DuckDB while Spark floors, hence
``epoch_us(ts) // 1000``.
"""

from __future__ import annotations

from keyflow.plans.time import interval_micros

SALES = """SELECT event_id, ts, strftime(ts, '%B') AS month, event_type AS category,
  'u' || user_id AS product, CAST(ROUND(value * 100) AS INTEGER) AS profit FROM events"""
TIMED = "SELECT event_id, ts, CAST(ROUND(value * 100) AS BIGINT) AS num FROM events"
NUMBERS = """SELECT event_id, ts, user_id AS key, CAST(ROUND(value * 100) AS BIGINT) AS num
  FROM events"""
CLICKS = """SELECT event_id, ts, 'u' || user_id AS user_id, 'net' || (user_id % 4) AS network,
  '10.' || (user_id % 256) || '.' || (event_id % 256) || '.1' AS ip,
  CASE WHEN user_id % 3 = 0 THEN 'US' WHEN user_id % 3 = 1 THEN 'IN' ELSE 'DE' END AS country,
  event_type AS website, CAST(ROUND(value * 100) AS INTEGER) AS time_spent FROM events"""
TRIPS = """SELECT o_orderkey AS id, 'P' || o_custkey AS license_plate, o_orderpriority AS car_type,
  'D' || (o_custkey % 50) AS driver, o_orderstatus = 'O' AS ongoing,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE n_name END AS pickup,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'Z' || (o_custkey % 20) END AS dropoff,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 5 + 1 END AS INTEGER) AS passengers
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
ONGOING = f"SELECT * FROM ({TRIPS}) WHERE ongoing AND dropoff IS NOT NULL"
EMPLOYEES = "SELECT c_custkey AS id, c_mktsegment AS department FROM customer"
RULES = """SELECT c_custkey AS id, (c_custkey * 7919) % 1500 AS effective_ts FROM customer
  WHERE c_acctbal < 0"""
INTEGERS = """SELECT event_id, CAST(CAST(ROUND(value * 100) AS BIGINT) - 20000 AS INTEGER) AS n
  FROM events"""
PROFIT = """SELECT strftime(l_shipdate, '%d-%m-%Y') AS date, strftime(l_shipdate, '%B') AS month,
  l_returnflag AS category, l_linestatus AS product,
  CAST(ROUND(l_extendedprice * 100) AS INTEGER) AS profit FROM lineitem"""
US_CLICKS = f"SELECT * FROM ({CLICKS}) WHERE country = 'US'"
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _us(size: str) -> int:
    return interval_micros(size)


def _start(size: str, ts: str = "ts") -> str:
    w = _us(size)
    return f"make_timestamp((epoch_us({ts}) // {w}) * {w})"


def _tumbling(src: str, size: str, keys: str, body: str, extra_from: str = "") -> str:
    w = _us(size)
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}make_timestamp(ws) AS window_start, make_timestamp(ws + {w}) AS window_end,
  {body} FROM (SELECT *, (epoch_us(ts) // {w}) * {w} AS ws FROM ({src}) {extra_from})
  GROUP BY {k}ws"""


def _sliding(src: str, size: str, slide: str, keys: str, body: str) -> str:
    w, s = _us(size), _us(slide)
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}make_timestamp(ws) AS window_start, make_timestamp(ws + {w}) AS window_end,
  {body} FROM (SELECT *, (epoch_us(ts) // {s}) * {s} - i * {s} AS ws
               FROM ({src}) CROSS JOIN range({w // s}) r(i))
  GROUP BY {k}ws"""


SALES_BODY = """arg_min(category, {'t': ts, 'e': event_id}) AS category,
  arg_min(product, {'t': ts, 'e': event_id}) AS product,
  CAST(sum(profit) AS BIGINT) AS profit_sum, count(*) AS n,
  CAST(sum(profit) AS BIGINT) / count(*) AS avg_profit"""
NUM_BODY = "CAST(sum(num) AS BIGINT) AS total, count(*) AS n"


def _sessions(src: str, gap: str, keys: str, body: str) -> str:
    g = _us(gap)
    part = f"PARTITION BY {keys}" if keys else ""
    k = f"{keys}, " if keys else ""
    return f"""WITH s AS (SELECT *, CASE WHEN lag(ts) OVER ({part} ORDER BY ts, event_id) IS NULL
      OR epoch_us(ts) - epoch_us(lag(ts) OVER ({part} ORDER BY ts, event_id)) > {g}
      THEN 1 ELSE 0 END AS new FROM ({src})),
  t AS (SELECT *, sum(new) OVER ({part} ORDER BY ts, event_id {RUN}) AS sid FROM s)
SELECT {k}min(ts) AS window_start, make_timestamp(epoch_us(max(ts)) + {g}) AS window_end,
  {body} FROM t GROUP BY {k}sid"""


def _rolling(kind: str, key: str = "month", first: str = "category") -> str:
    return f"""SELECT {key}, ts, event_id,
  first_value({first}) OVER w AS {first}, first_value(product) OVER w AS product,
  CAST({kind}(profit) OVER w AS {'BIGINT' if kind == 'sum' else 'INTEGER'}) AS {kind}_profit
FROM ({SALES}) WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id {RUN})"""


def _extreme_daily(kind: str, counts: str) -> str:
    day = _us("1 day")
    return f"""SELECT website, make_timestamp(d) AS window_start, make_timestamp(d + {day}) AS window_end, {kind}(clicks) AS clicks
FROM (SELECT *, (epoch_us(window_start) // {day}) * {day} AS d FROM ({counts})) GROUP BY website, d"""


def _rolling_by(kind: str) -> str:
    sign = "" if kind == "min" else "-"
    return f"""SELECT month, ts AS at_ts, event_id AS at_event_id, h.e AS event_id, h.t AS ts,
  h.category AS category, h.product AS product, h.v AS profit
FROM (SELECT *, {kind}({{'v': profit, 'o0': {sign}epoch_us(ts), 'o1': {sign}event_id,
                      'e': event_id, 't': ts, 'category': category, 'product': product}})
           OVER (PARTITION BY month ORDER BY ts, event_id {RUN}) AS h
      FROM ({SALES}))"""


def _count_windows(select: str) -> str:
    return f"""SELECT key, win, {select} FROM (
  SELECT *, (row_number() OVER (PARTITION BY key ORDER BY ts, event_id) - 1) // 10 AS win,
         row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn
  FROM ({NUMBERS})) GROUP BY key, win HAVING count(*) = 10"""


AFFINE = """SELECT event_id, ts, user_id AS key, event_type AS category, CAST(user_id % 97 + 2 AS BIGINT) AS a,
  CAST(event_id % 101 AS BIGINT) AS b FROM events"""
TRIP_LINES = f"""SELECT id AS trip, id || ',' || license_plate || ',' || car_type || ',' || driver || ',' || CASE WHEN ongoing THEN 'yes' ELSE 'no' END
  || ',' || coalesce(pickup, '''null''') || ',' || coalesce(dropoff, '''null''') || ','
  || CASE WHEN passengers = 0 THEN '''null''' ELSE CAST(passengers AS VARCHAR) END AS value FROM ({TRIPS})"""


def _damaged(lines: str, number: str) -> str:
    last = "regexp_replace(value, ',[^,]*$', '')"
    return f"""SELECT * REPLACE (CASE WHEN {number} % 7 = 0 THEN {last} WHEN {number} % 11 = 0 THEN {last} || ',abc'
      WHEN {number} % 13 = 0 THEN '' WHEN {number} % 17 = 0 THEN NULL ELSE value END AS value) FROM ({lines})"""


def _checked_clicks() -> str:
    lines = f"""SELECT *, user_id || ',' || network || ',' || ip || ',' || country || ',' || website || ',' || time_spent AS value
      FROM ({CLICKS})"""
    return f"""SELECT *, CASE WHEN value IS NULL OR reject_cause IS NULL THEN NULL WHEN value = '' THEN 'network'
      ELSE 'time_spent' END AS reject_field FROM (
      SELECT *, CASE WHEN value IS NULL THEN 'no line' WHEN value = '' OR event_id % 7 = 0 THEN 'missing'
        WHEN event_id % 11 = 0 THEN 'not int' END AS reject_cause FROM ({_damaged(lines, "event_id")}))"""


def _parts(src: str, order: str, limit: int, keys: str) -> str:
    """Parts of ``src`` (``n``, ``line``, ``period``): lines that begin in one cell of the endless file."""
    half, k = limit // 2, f"{keys}, " if keys else ""
    return f"""SELECT {k}period, part, count(*) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes, min(n) AS first_row, max(n) AS last_row FROM (
      SELECT *, CASE WHEN bytes <= {half} THEN 'n' || CAST((ends - bytes) // {limit - half} AS BIGINT) ELSE 'w' || CAST(wide - 1 AS BIGINT) END AS part
      FROM (SELECT *, sum(CASE WHEN bytes <= {half} THEN bytes ELSE 0 END) OVER w AS ends,
              sum(CASE WHEN bytes <= {half} THEN 0 ELSE 1 END) OVER w AS wide
            FROM (SELECT *, coalesce(strlen(line), 0) + 1 AS bytes FROM ({src}))
            WINDOW w AS (PARTITION BY {k}period ORDER BY {order} {RUN}))) GROUP BY {k}period, part"""


def _click_counts(size: str) -> str:
    return _tumbling(US_CLICKS, size, "website", "count(*) AS clicks")


def _exclude_running(cond: str) -> str:
    return f"""SELECT department, id, count(*) OVER (PARTITION BY department ORDER BY id {RUN}) AS count
FROM ({EMPLOYEES}) e WHERE NOT EXISTS (SELECT 1 FROM ({RULES}) r WHERE {cond})"""


def _late_base(bound: str) -> str:
    from keyflow.catalog import ARRIVAL_SPREAD_S
    b = _us(bound)
    return f"""SELECT event_id, ts, arrival, watermark,
  COALESCE(window_end <= watermark, false) AS late, num FROM (
  SELECT *, make_timestamp(max(epoch_us(ts)) OVER (ORDER BY arrival, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {b}) AS watermark
  FROM (SELECT *, ts + to_seconds((event_id * 7919) % {ARRIVAL_SPREAD_S}) AS arrival,
               make_timestamp((epoch_us(ts) // {{w}}) * {{w}} + {{w}}) AS window_end
        FROM ({TIMED})))"""


def _late_rows(bound: str) -> str:
    from keyflow.catalog import ARRIVAL_SPREAD_S
    b = _us(bound)
    return f"""SELECT event_id, ts, num FROM (
  SELECT *, max(epoch_us(ts)) OVER (ORDER BY arrival, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {b} AS wm_us
  FROM (SELECT *, ts + to_seconds((event_id * 7919) % {ARRIVAL_SPREAD_S}) AS arrival
        FROM ({TIMED})))
  WHERE wm_us IS NULL OR epoch_us(ts) >= wm_us"""


def oracle_sql() -> dict[str, str]:
    from keyflow import catalog as Q
    compose = f"lambda f, g: {{'a': (f.a * g.a) % {Q.MODULUS}, 'b': (f.b * g.a + g.b) % {Q.MODULUS}}}"

    late = _late_base(Q.LATE_BOUND).replace("{w}", str(_us(Q.LATE_WINDOW)))
    sql = {
        "parse_profit": f"SELECT month, category, product, profit, 1 AS n FROM ({PROFIT})",
        "parse_timed": f"""SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, num
            FROM ({TIMED})""",
        "parse_trips": f"""SELECT CAST(id AS VARCHAR) AS id, license_plate, car_type, driver, ongoing,
            pickup, dropoff, passengers FROM ({TRIPS})""",
        "parse_clicks": f"""SELECT event_id, user_id, network, ip, country, website, time_spent
            FROM ({CLICKS})""",
        "filter_us": US_CLICKS,
        "filter_trips": ONGOING,
        "split_even": f"SELECT * FROM ({INTEGERS}) WHERE n % 2 = 0",
        "split_odd": f"SELECT * FROM ({INTEGERS}) WHERE n % 2 <> 0",
        "rolling_sum": _rolling("sum"),
        "rolling_min": _rolling("min"),
        "rolling_max": _rolling("max"),
        "rolling_min_by": _rolling_by("min"),
        "rolling_max_by": _rolling_by("max"),
        "popular_destinations": f"""SELECT dropoff, CAST(sum(passengers) AS BIGINT) AS total_passengers
            FROM ({ONGOING}) GROUP BY dropoff""",
        "popular_destinations_running": f"""SELECT dropoff, id,
            CAST(sum(passengers) OVER (PARTITION BY dropoff ORDER BY id {RUN}) AS BIGINT)
              AS total_passengers FROM ({ONGOING})""",
        "top_destination": f"""SELECT dropoff, CAST(sum(passengers) AS BIGINT) AS total_passengers
            FROM ({ONGOING}) GROUP BY dropoff ORDER BY total_passengers DESC, dropoff LIMIT 3""",
        "avg_passengers_per_pickup": f"""SELECT pickup, sum(passengers) / count(*) AS avg_passengers,
            count(*) AS trips FROM ({ONGOING}) GROUP BY pickup""",
        "avg_passengers_per_pickup_running": f"""SELECT pickup, id,
            sum(passengers) OVER w / count(*) OVER w AS avg_passengers, count(*) OVER w AS trips
            FROM ({ONGOING}) WINDOW w AS (PARTITION BY pickup ORDER BY id {RUN})""",
        "avg_passengers_per_driver": f"""SELECT driver, sum(passengers) / count(*) AS avg_passengers,
            count(*) AS trips FROM ({ONGOING}) GROUP BY driver""",
        "distinct_users_running": f"""SELECT website, ts, event_id, user_id,
            CAST(sum(f) OVER (PARTITION BY website ORDER BY ts, event_id {RUN}) AS BIGINT)
              AS distinct_users
            FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY website, user_id
                                 ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS f
                  FROM ({US_CLICKS}))""",
        "distinct_users": f"""SELECT website, count(DISTINCT user_id) AS distinct_users
            FROM ({US_CLICKS}) GROUP BY website""",
        "distinct_lines_running": f"""SELECT website, ts, event_id,
            CAST(sum(f) OVER (PARTITION BY website ORDER BY ts, event_id {RUN}) AS BIGINT)
              AS distinct_lines
            FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY website, line
                                 ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS f
                  FROM (SELECT *, concat_ws(',', user_id, network, ip, country, website,
                                            time_spent) AS line FROM ({US_CLICKS})))""",
        "avg_profit_per_month": f"""SELECT month, CAST(sum(profit) AS BIGINT) AS profit_sum,
            count(*) AS n, CAST(sum(profit) AS BIGINT) / count(*) AS avg_profit
            FROM ({PROFIT}) GROUP BY month""",
        "tumbling_keyed": _tumbling(SALES, Q.KEYED_TUMBLE, "month", SALES_BODY),
        "sliding_keyed": _sliding(SALES, Q.KEYED_SLIDE[0], Q.KEYED_SLIDE[1], "month", SALES_BODY),
        "session_keyed": _sessions(SALES, Q.SESSION_GAP, "month", SALES_BODY),
        "tumbling_all": _tumbling(TIMED, Q.ALL_TUMBLE, "", NUM_BODY),
        "sliding_all": _sliding(TIMED, Q.ALL_SLIDE[0], Q.ALL_SLIDE[1], "", NUM_BODY),
        "session_all": _sessions(TIMED, Q.SESSION_GAP, "", NUM_BODY),
        "count_trigger": f"""SELECT month, rn, category, product, total, rn AS n FROM (
            SELECT month, row_number() OVER w AS rn,
              first_value(category) OVER w AS category, first_value(product) OVER w AS product,
              CAST(sum(profit) OVER w AS BIGINT) AS total
            FROM ({SALES}) WINDOW w AS (PARTITION BY month ORDER BY ts, event_id {RUN}))
            WHERE rn % 5 = 0""",
        "count_evictor": f"""SELECT month, rn, category, product, total, n FROM (
            SELECT month, row_number() OVER w AS rn,
              first_value(category) OVER w4 AS category, first_value(product) OVER w4 AS product,
              CAST(sum(profit) OVER w4 AS BIGINT) AS total, count(*) OVER w4 AS n
            FROM ({SALES})
            WINDOW w AS (PARTITION BY month ORDER BY ts, event_id {RUN}),
                   w4 AS (PARTITION BY month ORDER BY ts, event_id
                          ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
            WHERE rn % 5 = 0""",
        "count10_sum": _count_windows("CAST(sum(num) AS BIGINT) AS sum"),
        "count10_list": _count_windows("' ' || string_agg(CAST(num AS VARCHAR), ' ' ORDER BY rn) AS items"),
        "count10_reduce": _count_windows("CAST(sum(num) AS BIGINT) AS sum, max(num) AS max"),
        "buffered_groups": f"""SELECT key, grp, count(*) AS rows, arg_min(event_id, rn) AS first_id,
            arg_max(event_id, rn) AS last_id FROM (
              SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn,
                (row_number() OVER (PARTITION BY key ORDER BY ts, event_id) - 1) // 5 AS grp
              FROM ({NUMBERS})) GROUP BY key, grp HAVING count(*) = 5""",
        "clicks_per_website": _click_counts(Q.CLICK_WINDOW),
        "max_clicks_per_site": _click_counts(Q.CLICK_WINDOW),
        "min_clicks_per_site": _click_counts(Q.CLICK_WINDOW),
        "top_website": f"""SELECT website, window_start, window_end, clicks FROM (
            SELECT *, row_number() OVER (PARTITION BY window_start
                                         ORDER BY clicks DESC, website DESC) AS r
            FROM ({_click_counts(Q.CLICK_WINDOW)})) WHERE r = 1""",
        "bottom_website": f"""SELECT website, window_start, window_end, clicks FROM (
            SELECT *, row_number() OVER (PARTITION BY window_start
                                         ORDER BY clicks ASC, website ASC) AS r
            FROM ({_click_counts(Q.CLICK_WINDOW)})) WHERE r = 1""",
        "avg_time_per_website": _tumbling(
            US_CLICKS, Q.CLICK_WINDOW, "website",
            "CAST(sum(time_spent) AS BIGINT) // count(*) AS avg_time_spent"),
        "website_metrics": f"""SELECT website, count(*) AS clicks,
            CAST(sum(time_spent) AS BIGINT) AS total_time, count(DISTINCT user_id) AS distinct_users,
            COALESCE(CAST(sum(time_spent) AS BIGINT) / count(*), 0.0) AS avg_time
            FROM ({CLICKS}) GROUP BY website""",
        "late_flag": f"SELECT event_id, ts, arrival, watermark, late FROM ({late})",
        "tumbling_drop_late": _tumbling(f"SELECT * FROM ({late}) WHERE NOT late", Q.LATE_WINDOW,
                                        "", NUM_BODY),
        "session_drop_late": _sessions(_late_rows(Q.LATE_BOUND), Q.SESSION_GAP, "", NUM_BODY),
        "exclude_running_count": _exclude_running("r.id = e.id"),
        "exclude_total": f"""SELECT department, count(*) AS count FROM ({EMPLOYEES}) e
            WHERE NOT EXISTS (SELECT 1 FROM ({RULES}) r WHERE r.id = e.id) GROUP BY department""",
        "exclude_asof": _exclude_running("r.id = e.id AND r.effective_ts <= e.id"),
        "iterate_to_ten": """WITH RECURSIVE it(event_id, v, n) AS (
              SELECT event_id, event_id % 6, CAST(0 AS BIGINT) FROM events
              UNION ALL
              SELECT event_id, v + 1, n + 1 FROM it WHERE v <> 10)
            SELECT event_id, v, n FROM it WHERE v = 10""",
    }
    sql["website_metrics_merge"] = sql["website_metrics"]
    sql |= {
        "parse_profit_fields": f"SELECT month, category, product, profit FROM ({PROFIT})",
        "parse_employees": f"""SELECT CAST(id AS VARCHAR) AS id, department,
            id || ',n' || id || ',n' || id || '@x,' || department AS line FROM ({EMPLOYEES})""",
        "tuple_text_trips": f"""SELECT id, '(' || id || ',' || license_plate || ',' || CASE WHEN ongoing THEN 'true' ELSE 'false' END
            || ',' || coalesce(pickup, 'null') || ',' || coalesce(dropoff, 'null') || ',' || passengers || ')' AS text FROM ({TRIPS})""",
        "rolling_sum_by_category": _rolling("sum", "category", "month"),
        "rolling_max_record_by_category": f"""SELECT category, ts AS at_ts, event_id AS at_event_id, h.e AS event_id, h.t AS ts,
            h.product AS product, h.v AS profit
            FROM (SELECT *, max({{'v': profit, 'o0': -epoch_us(ts), 'o1': -event_id, 'e': event_id, 't': ts, 'product': product}})
                  OVER (PARTITION BY category ORDER BY ts, event_id {RUN}) AS h FROM ({SALES}))""",
        "count_trigger_by_category": f"""SELECT category, rn, month, product, total, rn AS n FROM (
            SELECT category, row_number() OVER w AS rn, first_value(month) OVER w AS month,
              first_value(product) OVER w AS product, CAST(sum(profit) OVER w AS BIGINT) AS total
            FROM ({SALES}) WINDOW w AS (PARTITION BY category ORDER BY ts, event_id {RUN})) WHERE rn % 5 = 0""",
        "max_clicks_per_site_daily": _extreme_daily("max", _click_counts(Q.CLICK_WINDOW)),
        "min_clicks_per_site_daily": _extreme_daily("min", _click_counts(Q.CLICK_WINDOW)),
    }
    sql |= {
        "rejected_clicks": f"""SELECT event_id, value AS reject_line, reject_field, reject_cause
            FROM ({_checked_clicks()}) WHERE reject_cause IS NOT NULL""",
        "accepted_clicks": f"""SELECT event_id, user_id, network, ip, country, website, time_spent
            FROM ({_checked_clicks()}) WHERE reject_cause IS NULL""",
        "rejected_trips": f"""SELECT trip, value AS reject_line,
            CASE WHEN value IS NULL THEN NULL WHEN value = '' THEN 'license_plate' ELSE 'passengers' END AS reject_field,
            CASE WHEN value IS NULL THEN 'no line' WHEN value = '' OR trip % 7 = 0 THEN 'missing' ELSE 'not int' END AS reject_cause
            FROM ({_damaged(TRIP_LINES, "trip")}) WHERE trip % 7 = 0 OR trip % 11 = 0 OR trip % 13 = 0 OR trip % 17 = 0""",
        "rolled_parts_documents": _parts("SELECT doc_id AS n, text AS line, CAST(0 AS BIGINT) AS period FROM documents", "n", Q.PART_BYTES, ""),
        "rolled_parts_sales": _parts(
            f"""SELECT event_id AS n, ts, category, '(' || month || ',' || category || ',' || product || ',' || profit || ')' AS line,
                epoch_us(ts) // {_us(Q.PART_AGE)} AS period FROM ({SALES})""", "ts, n", Q.SALES_PART_BYTES, "category"),
        "count10_composed": f"""SELECT key, win, f.a AS a, f.b AS b FROM (
            SELECT key, win, list_reduce(list({{'a': a, 'b': b}} ORDER BY rn), {compose}) AS f FROM (
              SELECT *, (rn - 1) // 10 AS win FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn FROM ({AFFINE})))
            GROUP BY key, win HAVING count(*) = 10)""",
        "composed_by_category": f"""SELECT category, f.a AS a, f.b AS b FROM (
            SELECT category, list_reduce(list({{'a': a, 'b': b}} ORDER BY ts, event_id), {compose}) AS f FROM ({AFFINE}) GROUP BY category)""",
        "composed_running_by_user": f"""SELECT key, ts, event_id, f.a AS a, f.b AS b FROM (
            SELECT key, ts, event_id, list_reduce(list({{'a': a, 'b': b}}) OVER (PARTITION BY key ORDER BY ts, event_id {RUN}), {compose}) AS f
            FROM ({AFFINE}))""",
    }
    by_category = SALES_BODY.replace("arg_min(category,", "arg_min(month,").replace("AS category", "AS month")
    sql["tumbling_by_category"] = _tumbling(SALES, Q.KEYED_TUMBLE, "category", by_category)
    sql["sliding_by_category"] = _sliding(SALES, *Q.KEYED_SLIDE, "category", by_category)
    sql["session_by_category"] = _sessions(SALES, Q.SESSION_GAP, "category", by_category)
    return sql
