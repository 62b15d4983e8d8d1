"""Queries on the event log: sequences, matching, windows, running values."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.functions.scalars import equals_ignore_case
from tidemark.operators.joins import interval_join, latest_per_key, lookup
from tidemark.operators.matching import MATCHED, one_to_one_match, with_outcome
from tidemark.operators.periods import PASSED, click_cap, throttle
from tidemark.operators.running import (
    count_window_average,
    global_count,
    keyed_sum_with_global_count,
    running,
    running_average,
)
from tidemark.operators.sequences import sequence_timeout
from tidemark.operators.windows import sliding_count
from tidemark.plans.registry import ORACLES, query
from tidemark.session import scratch
from tidemark.sources.sinks import write_outputs
from tidemark.sources.tables import table

SIX_HOURS, FIVE_DAYS = timedelta(hours=6), timedelta(days=5)
HOUR, FIVE_MINUTES = timedelta(hours=1), timedelta(minutes=5)
LEFT_ONLY, RIGHT_ONLY = "click_without_purchase", "purchase_without_click"


def events(spark, sf, *kinds):
    rows = table(spark, sf, "events")
    return rows.filter(F.col("event_type").isin(*kinds)) if kinds else rows


def priced(spark, sf):
    return events(spark, sf).select("user_id", "ts", "event_id", F.col("value").cast("decimal(18,2)").alias("value"))


# --- sequences -----------------------------------------------------------------------------

SEQUENCE_SQL = """
WITH n AS (
  SELECT user_id, event_id, event_type, ts,
         lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)
SELECT user_id, event_id, ts AS started_at,
       CASE WHEN next_ts < ts + INTERVAL 6 HOUR THEN next_ts END AS done_at,
       CASE WHEN next_ts IS NULL OR next_ts >= ts + INTERVAL 6 HOUR THEN 'timed_out' ELSE 'done' END AS outcome
FROM n
WHERE event_type = 'view'
  AND (next_ts IS NULL OR next_ts >= ts + INTERVAL 6 HOUR OR next_type = 'purchase')
"""


@query("sequence_timeout", SEQUENCE_SQL)
def view_then_purchase(spark, sf):
    return sequence_timeout(
        events(spark, sf), "user_id", "event_type", "ts", "event_id", "view", "purchase", SIX_HOURS
    )


# --- matching ------------------------------------------------------------------------------

MATCH_CTE = """
WITH e AS (
  SELECT user_id, ts, event_id, CASE event_type WHEN 'click' THEN 0 ELSE 1 END AS side
  FROM events WHERE event_type IN ('click', 'purchase')
), s AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR lag(side) OVER w = side
                   OR ts - lag(ts) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh,
         lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_id, lead(side) OVER w AS next_side
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id, side)
), i AS (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id, side ROWS UNBOUNDED PRECEDING) AS island
  FROM s
), r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id, side) AS pos FROM i
), o AS (
  SELECT *, CASE WHEN next_ts - ts <= INTERVAL 6 HOUR AND next_side <> side THEN 'matched'
                 WHEN next_ts - ts <= INTERVAL 6 HOUR THEN 'superseded'
                 WHEN side = 0 THEN 'click_without_purchase'
                 ELSE 'purchase_without_click' END AS outcome
  FROM r WHERE pos % 2 = 1
), m AS (
  SELECT user_id,
    CASE WHEN side = 0 THEN event_id WHEN outcome = 'matched' THEN next_id END AS left_id,
    CASE WHEN side = 0 THEN ts WHEN outcome = 'matched' THEN next_ts END AS left_time,
    CASE WHEN side = 1 THEN event_id WHEN outcome = 'matched' THEN next_id END AS right_id,
    CASE WHEN side = 1 THEN ts WHEN outcome = 'matched' THEN next_ts END AS right_time,
    outcome
  FROM o
)
"""


def matches(spark, sf):
    return one_to_one_match(
        events(spark, sf, "click"), events(spark, sf, "purchase"), "user_id", "ts", "event_id", SIX_HOURS,
        LEFT_ONLY, RIGHT_ONLY,
    )


@query("two_stream_match", MATCH_CTE + "SELECT * FROM m")
def two_stream_match(spark, sf):
    return matches(spark, sf)


@query("unmatched_left", MATCH_CTE + f"SELECT user_id, left_id, left_time FROM m WHERE outcome = '{LEFT_ONLY}'")
def unmatched_left(spark, sf):
    return with_outcome(matches(spark, sf), LEFT_ONLY).select("user_id", "left_id", "left_time")


@query("unmatched_right", MATCH_CTE + f"SELECT user_id, right_id, right_time FROM m WHERE outcome = '{RIGHT_ONLY}'")
def unmatched_right(spark, sf):
    return with_outcome(matches(spark, sf), RIGHT_ONLY).select("user_id", "right_id", "right_time")


@query("side_outputs", MATCH_CTE + "SELECT user_id, left_id, right_id, outcome FROM m WHERE outcome <> 'superseded'")
def side_outputs(spark, sf):
    """All outputs are written in one pass, then each is read on its own."""
    path = scratch(spark, "outputs")
    write_outputs(matches(spark, sf), path)
    written = spark.read.parquet(path)
    return with_outcome(written, MATCHED, LEFT_ONLY, RIGHT_ONLY).select("user_id", "left_id", "right_id", "outcome")


# --- joins ---------------------------------------------------------------------------------


def sides(spark, sf):
    click = events(spark, sf, "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")
    )
    purchase = events(spark, sf, "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    return click, purchase


@query("interval_join", """
SELECT c.user_id, c.event_id AS click_id, c.ts AS click_ts, p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events c JOIN events p ON c.user_id = p.user_id
 AND p.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts + INTERVAL 6 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def click_purchase_pairs(spark, sf):
    click, purchase = sides(spark, sf)
    return interval_join(click, purchase, "user_id", "click_ts", "purchase_ts", SIX_HOURS, SIX_HOURS)


@query("interval_join_unmatched", """
SELECT c.user_id, c.event_id AS click_id, c.ts AS click_ts FROM events c
WHERE c.event_type = 'click' AND NOT EXISTS (
  SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND c.user_id = p.user_id
   AND p.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts + INTERVAL 6 HOUR)
""")
def clicks_without_any_purchase(spark, sf):
    click, purchase = sides(spark, sf)
    return interval_join(click, purchase, "user_id", "click_ts", "purchase_ts", SIX_HOURS, SIX_HOURS, "left_anti")


LATEST_SQL = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1 AND event_type <> 'error'
"""


def latest(spark, sf):
    return latest_per_key(
        events(spark, sf), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"],
        F.col("event_type") == "error",
    )


@query("kv_latest", LATEST_SQL)
def kv_latest(spark, sf):
    return latest(spark, sf)


@query("kv_lookup", f"""
SELECT c.c_custkey, c.c_name, k.event_type, k.value
FROM customer c LEFT JOIN ({LATEST_SQL}) k ON k.user_id = c.c_custkey
""")
def kv_lookup(spark, sf):
    probe = table(spark, sf, "customer").select("c_custkey", "c_name")
    return lookup(probe, latest(spark, sf), "c_custkey", "user_id", ["event_type", "value"])


@query("lookup_enrich", """
SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def lookup_enrich(spark, sf):
    probe = events(spark, sf).select("event_id", "user_id")
    return lookup(probe, table(spark, sf, "customer"), "user_id", "c_custkey", ["c_name", "c_mktsegment"])


# --- running values ------------------------------------------------------------------------

RUNNING_CTE = """
WITH r AS (
  SELECT user_id, event_id, ts, CAST(round(value * 100) AS BIGINT) AS cents,
         count(*) OVER w AS n, sum(CAST(round(value * 100) AS BIGINT)) OVER w AS total
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
)
"""


@query("running_count", RUNNING_CTE + "SELECT user_id, event_id, n AS running_count FROM r")
def running_count(spark, sf):
    rows = running(events(spark, sf).select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return rows.select("user_id", "event_id", "running_count")


@query("running_sum", RUNNING_CTE + """
SELECT user_id, event_id, CAST(total AS DOUBLE) / 100 AS running_sum FROM r""")
def running_sum(spark, sf):
    rows = running(priced(spark, sf), ["user_id"], ["ts", "event_id"], "value")
    return rows.select("user_id", "event_id", F.col("running_sum").cast("double").alias("running_sum"))


@query("running_avg", RUNNING_CTE + """
SELECT user_id, event_id, CAST((2 * total * 10000 + n) // (2 * n) AS DOUBLE) / 1000000 AS running_avg
FROM r WHERE n >= 2""")
def running_avg(spark, sf):
    rows = running_average(priced(spark, sf), ["user_id"], ["ts", "event_id"], "value")
    return rows.select("user_id", "event_id", F.col("running_avg").cast("double").alias("running_avg"))


@query("count_window_avg", RUNNING_CTE + """
SELECT user_id, (n - 1) // 2 AS group_no, CAST(sum(cents) AS DOUBLE) / 200 AS group_avg
FROM r GROUP BY user_id, (n - 1) // 2 HAVING count(*) = 2""")
def count_window_avg(spark, sf):
    rows = count_window_average(priced(spark, sf), ["user_id"], ["ts", "event_id"], "value", 2)
    return rows.select("user_id", "group_no", F.col("group_avg").cast("double").alias("group_avg"))


@query("operator_count", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS operator_count FROM events")
def operator_count(spark, sf):
    rows = global_count(events(spark, sf).select("ts", "event_id"), ["ts", "event_id"])
    return rows.select("event_id", "operator_count")


@query("keyed_sum_operator_count", """
SELECT user_id, event_id,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 100 AS running_sum,
  row_number() OVER (ORDER BY ts, event_id) AS operator_count
FROM events""")
def keyed_sum_operator_count(spark, sf):
    rows = keyed_sum_with_global_count(priced(spark, sf), ["user_id"], ["ts", "event_id"], "value")
    total = F.col("running_sum").cast("double").alias("running_sum")
    return rows.select("user_id", "event_id", total, "operator_count")


# --- windows, caps, throttling -------------------------------------------------------------

SLIDING_SQL = """
SELECT {key}, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n
FROM (SELECT {key}, unnest([time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * k) FOR k IN range(12)])
        AS window_start FROM {rows})
GROUP BY {key}, window_start
"""


@query("sliding_count", SLIDING_SQL.format(key="event_type", rows="events"))
def events_per_hour(spark, sf):
    return sliding_count(events(spark, sf), "event_type", "ts", HOUR, FIVE_MINUTES)


CAP_SQL = """
SELECT user_id, event_id, ts, CASE WHEN rn <= 10 THEN 'passed' WHEN rn = 11 THEN 'flagged' ELSE 'dropped' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type = 'click')
"""


def capped(spark, sf, ttl=None):
    clicks = events(spark, sf, "click").select("user_id", "event_id", "ts")
    return click_cap(clicks, ["user_id"], "ts", "event_id", 10, ttl)


@query("click_blacklist", CAP_SQL)
def click_blacklist(spark, sf):
    return capped(spark, sf)


PERIODS_CTE = """
WITH RECURSIVE e AS (SELECT user_id, event_id, ts FROM events WHERE event_type = '{kind}'),
f AS (SELECT user_id, ts, min(event_id) AS event_id FROM e GROUP BY user_id, ts),
n AS (
  SELECT a.user_id, a.ts, min(b.ts) AS next_ts
  FROM f a JOIN f b ON a.user_id = b.user_id AND b.ts >= a.ts + INTERVAL {length}
  GROUP BY a.user_id, a.ts
), p AS (
  SELECT user_id, min(ts) AS ts FROM e GROUP BY user_id
  UNION ALL
  SELECT n.user_id, n.next_ts FROM p JOIN n ON n.user_id = p.user_id AND n.ts = p.ts
)
"""


@query("click_blacklist_ttl", PERIODS_CTE.format(kind="click", length="5 DAY") + """
, g AS (
  SELECT e.user_id, e.event_id, e.ts, max(p.ts) AS start FROM e JOIN p ON p.user_id = e.user_id AND p.ts <= e.ts
  GROUP BY e.user_id, e.event_id, e.ts
), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, start ORDER BY ts, event_id) AS rn FROM g)
SELECT user_id, event_id, ts, CASE WHEN rn <= 2 THEN 'passed' WHEN rn = 3 THEN 'flagged' ELSE 'dropped' END AS outcome
FROM r""")
def click_blacklist_ttl(spark, sf):
    clicks = events(spark, sf, "click").select("user_id", "event_id", "ts")
    return click_cap(clicks, ["user_id"], "ts", "event_id", 2, FIVE_DAYS)


@query("click_blacklist_ttl_cut", ORACLES["click_blacklist_ttl"])
def click_blacklist_ttl_cut(spark, sf):
    """The same with every key of more than five clicks cut into chunks."""
    clicks = events(spark, sf, "click").select("user_id", "event_id", "ts")
    return click_cap(clicks, ["user_id"], "ts", "event_id", 2, FIVE_DAYS, chunk_rows=5)


@query("running_count_cut", """
SELECT event_type, ts, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS running_count FROM events""")
def running_count_cut(spark, sf):
    """Few large keys, cut into chunks of a thousand rows."""
    rows = events(spark, sf).select("event_type", "ts", "event_id")
    return running(rows, ["event_type"], ["ts", "event_id"], None, 1_000).select(*rows.columns, "running_count")


@query("click_blacklist_untimed", """
SELECT user_id, event_id, ts, CASE WHEN ts IS NULL THEN NULL WHEN rn <= 10 THEN 'passed' WHEN rn = 11 THEN 'flagged'
  ELSE 'dropped' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) AS rn
      FROM (SELECT user_id, event_id, CASE WHEN value >= 20 THEN ts END AS ts FROM events WHERE event_type = 'click'))""")
def click_blacklist_untimed(spark, sf):
    """Clicks of little value have lost their time: they count for nothing and stay with a null outcome."""
    timed = F.when(F.col("value") >= 20, F.col("ts")).alias("ts")
    clicks = events(spark, sf, "click").select("user_id", "event_id", timed)
    return click_cap(clicks, ["user_id"], "ts", "event_id", 10)


@query("throttle", PERIODS_CTE.format(kind="error", length="6 HOUR") + """
SELECT f.user_id, f.event_id, f.ts FROM p JOIN f ON f.user_id = p.user_id AND f.ts = p.ts""")
def throttled_errors(spark, sf):
    errors = events(spark, sf, "error").select("user_id", "event_id", "ts")
    return throttle(errors, ["user_id"], "ts", "event_id", SIX_HOURS)


@query("capped_sliding_count", SLIDING_SQL.format(key="c_nationkey", rows=f"""(
  SELECT c.c_nationkey, k.ts FROM ({CAP_SQL}) k JOIN customer c ON c.c_custkey = k.user_id
  WHERE k.outcome = 'passed')"""))
def capped_clicks_per_hour(spark, sf):
    """Clicks within the cap, counted per nation of the customer in sliding hours."""
    passed = with_outcome(capped(spark, sf), PASSED)
    customers = table(spark, sf, "customer")
    placed = lookup(passed, customers, "user_id", "c_custkey", ["c_nationkey"])
    return sliding_count(placed.filter("c_nationkey IS NOT NULL"), "c_nationkey", "ts", HOUR, FIVE_MINUTES)


@query("filter_ci_equals", "SELECT event_id, event_type FROM events WHERE lower(event_type) = 'view'")
def filter_ci_equals(spark, sf):
    return events(spark, sf).filter(equals_ignore_case("event_type", "VIEW")).select("event_id", "event_type")
