"""The event queries as streams: the log arrives in slices of time, one to a micro-batch, until it is drained.

Each gives the rows of its batch twin. A last event far in the future follows the log in a batch of its own, because
a stream never knows that its input has ended: the watermark has to pass the open windows and
timers first.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.scalars import micros
from tidemark.plans import events as batch
from tidemark.plans.registry import ORACLES, query
from tidemark.session import is_scratch, scratch
from tidemark.sources.sinks import setting
from tidemark.sources.tables import table
from tidemark.streaming import operators, processors
from tidemark.streaming.microbatch import Incremental, match_step, period_step, running_step, sequence_step
from tidemark.streaming.sources import batch_files, read_stream, run_batches, run_to_files, with_event_time

BOUND = "10 seconds"
TEN_SECONDS = timedelta(seconds=10)
SENTINEL = "sentinel"
PARTITIONS = "spark.sql.shuffle.partitions"
#: Slices of time in which the log arrives; the rows of a file, and of texts the bytes, at most.
SLICES, FILE_ROWS, FILE_BYTES = 4, 250_000, 32_000_000


def sentinel(spark, schema):
    return spark.createDataFrame([(-1, datetime(2124, 1, 1), -1, SENTINEL, 0.0, "")], schema).coalesce(1)


def time_slices(log, slices=SLICES, file_rows=FILE_ROWS):
    """The log in slices of time, and the files that each is to have; rows without a time come first.

    All slices get the same number of files, so that a trigger which takes as many takes just one slice. A cut that would
    leave a slice with too few rows for that is left out.
    """
    us = micros("ts")
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(log.agg(F.percentile_approx(us, shares, 1000)).first()[0] or []))
    place = sum((F.when(us > c, 1).otherwise(0) for c in cuts), F.lit(0))
    # A row for each slice.
    counts = {r["at"]: r["n"] for r in log.groupBy(place.alias("at")).agg(F.count("*").alias("n")).collect()}
    files = max(1, -(-max(counts.values(), default=0) // file_rows))
    kept = [c for i, c in enumerate(cuts) if counts.get(i, 0) >= 100 * files and counts.get(i + 1, 0) >= 100 * files]
    edges = [None, *kept, None]
    bounds = [(us > a if a is not None else F.lit(True)) & (us <= b if b is not None else F.lit(True)) for a, b in zip(edges, edges[1:])]
    return [log.filter(F.coalesce(b, F.lit(i == 0))) for i, b in enumerate(bounds)], files


def arrive(folder, slices, files):
    for rows in slices:
        rows.repartition(files).write.mode("append").parquet(folder)


ARRIVED = {}


def arrivals(spark, sf):
    """A folder with the slices of the log and the closing event, written once for a session; and the files of a slice."""
    name = (spark.sparkContext.applicationId, sf)
    if name not in ARRIVED or not is_scratch(ARRIVED[name][0]):
        log, folder = table(spark, sf, "events"), scratch(spark, "arrivals")
        slices, files = time_slices(log)
        arrive(folder, slices, files)
        sentinel(spark, log.schema).write.mode("append").parquet(folder)
        ARRIVED[name] = folder, files
    return ARRIVED[name]


def event_stream(spark, sf):
    """The log and the closing event, a slice to a micro-batch, times zoned, no watermark yet."""
    folder, files = arrivals(spark, sf)
    rows = read_stream(spark, folder, table(spark, sf, "events").schema, maxFilesPerTrigger=files)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def kinds(rows, *names):
    """Rows of some kinds; the closing event always passes."""
    return rows.filter(F.col("event_type").isin(*names, SENTINEL))


def drained(spark, stream, checkpoint=None, path=None):
    """Run the stream to its end and read what it wrote."""
    path = path or scratch(spark, "stream")
    # State is kept per shuffle partition: one per core instead of the batch default.
    with setting(spark, PARTITIONS, str(spark.sparkContext.defaultParallelism)):
        run_to_files(stream, path, checkpoint or scratch(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def unzoned(rows, *columns):
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- per-key operators, a batch job per micro-batch -------------------------------------------


def drained_by_batch(spark, stream, step):
    path = scratch(spark, "stream")
    handler = Incremental(path, "ts", TEN_SECONDS, step)
    run_batches(stream, handler, scratch(spark, "checkpoint"))
    found = handler.results(spark)
    return found.filter("user_id <> -1") if "user_id" in found.columns else found


@query("stream_sequence", ORACLES["sequence_timeout"])
def stream_sequence(spark, sf):
    step = sequence_step("user_id", "event_type", "ts", "event_id", "view", "purchase", batch.SIX_HOURS)
    return unzoned(drained_by_batch(spark, event_stream(spark, sf), step), "started_at", "done_at")


@query("stream_match", ORACLES["two_stream_match"])
def stream_match(spark, sf):
    rows = kinds(event_stream(spark, sf), "click", "purchase")
    rows = rows.withColumn("side", F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    step = match_step("user_id", "ts", "event_id", "side", batch.SIX_HOURS, batch.LEFT_ONLY, batch.RIGHT_ONLY)
    return unzoned(drained_by_batch(spark, rows, step), "left_time", "right_time")


CAPPED_SQL = f"SELECT user_id, event_id, outcome FROM ({batch.CAP_SQL}) WHERE outcome <> 'dropped'"


@query("stream_blacklist", CAPPED_SQL)
def stream_blacklist(spark, sf):
    clicks = kinds(event_stream(spark, sf), "click")
    found = drained_by_batch(spark, clicks, running_step("user_id", "ts", "event_id", cap=10))
    return found.select("user_id", "event_id", "outcome")


@query("stream_blacklist_ttl", f"SELECT * FROM ({ORACLES['click_blacklist_ttl']}) WHERE outcome <> 'dropped'")
def stream_blacklist_ttl(spark, sf):
    clicks = kinds(event_stream(spark, sf), "click")
    step = period_step("user_id", "ts", "event_id", batch.FIVE_DAYS, cap=2)
    return unzoned(drained_by_batch(spark, clicks, step), "ts")


@query("stream_throttle", ORACLES["throttle"])
def stream_throttle(spark, sf):
    errors = kinds(event_stream(spark, sf), "error")
    step = period_step("user_id", "ts", "event_id", batch.SIX_HOURS)
    return unzoned(drained_by_batch(spark, errors, step), "ts")


RUNNING_SQL = batch.RUNNING_CTE + """
SELECT user_id, event_id, n AS running_count, CAST(total AS DOUBLE) / 100 AS running_sum FROM r"""


@query("stream_running", RUNNING_SQL)
def stream_running(spark, sf):
    rows = event_stream(spark, sf).withColumn("value", F.col("value").cast("decimal(18,2)"))
    found = drained_by_batch(spark, rows, running_step("user_id", "ts", "event_id", "value"))
    total = F.col("running_sum").cast("double").alias("running_sum")
    return found.select("user_id", "event_id", "running_count", total)


@query("stream_running_avg", ORACLES["running_avg"])
def stream_running_avg(spark, sf):
    rows = event_stream(spark, sf).withColumn("value", F.col("value").cast("decimal(18,2)"))
    found = drained_by_batch(spark, rows, running_step("user_id", "ts", "event_id", "value"))
    average = F.round(F.col("running_sum") / F.col("running_count"), 6).cast("double").alias("running_avg")
    return found.filter("running_count >= 2").select("user_id", "event_id", average)


LATE_SQL = """
WITH d AS (SELECT *, event_id % 50 = 7 AS delayed FROM events),
  l AS (SELECT *, delayed AND ts <= (SELECT max(ts) FROM d WHERE NOT delayed) - INTERVAL 10 SECONDS AS late FROM d)
SELECT user_id, event_id, NULL AS running_count, late FROM l WHERE late
UNION ALL SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id), late FROM l WHERE NOT late
"""


@query("stream_late", LATE_SQL)
def stream_late(spark, sf):
    """Every fiftieth event comes after all others: it is counted if the watermark allows it, else it is a late row."""
    log, folder, path = table(spark, sf, "events"), scratch(spark, "arrivals"), scratch(spark, "stream")
    delayed = F.col("event_id") % 50 == 7
    slices, files = time_slices(log.filter(~delayed))
    arrive(folder, slices, files)
    handler = Incremental(path, "ts", TEN_SECONDS, running_step("user_id", "ts", "event_id"))

    def run():
        rows = read_stream(spark, folder, log.schema, maxFilesPerTrigger=files)
        run_batches(rows.withColumn("ts", F.col("ts").cast("timestamp")), handler, f"{path}/checkpoint")

    run()
    # The delayed rows fill a batch of their own, however many files they are, and so does the closing event.
    for last in (log.filter(delayed).repartition(files), sentinel(spark, log.schema)):
        last.write.mode("append").parquet(folder)
        run()
    counted = handler.results(spark).select("user_id", "event_id", "running_count", F.lit(False).alias("late"))
    late = handler.late(spark).select("user_id", "event_id", F.lit(None).cast("long").alias("running_count"), F.lit(True).alias("late"))
    return counted.unionByName(late).filter("user_id <> -1")


# --- the same with keyed state and timers ------------------------------------------------------


@query("timer_sequence", ORACLES["sequence_timeout"])
def timer_sequence(spark, sf):
    rows = with_event_time(event_stream(spark, sf), "ts", BOUND)
    found = processors.stream_sequence(
        rows, "user_id", "event_type", "ts", "event_id", "view", "purchase", batch.SIX_HOURS
    )
    return unzoned(drained(spark, found).withColumnRenamed("id", "event_id"), "started_at", "done_at")


@query("timer_match", ORACLES["two_stream_match"])
def timer_match(spark, sf):
    rows = event_stream(spark, sf)
    found = processors.stream_match(
        kinds(rows, "click"), rows.filter("event_type = 'purchase'"), "user_id", "ts", "event_id",
        batch.SIX_HOURS, BOUND, batch.LEFT_ONLY, batch.RIGHT_ONLY,
    )
    return unzoned(drained(spark, found).filter("user_id <> -1"), "left_time", "right_time")


@query("timer_blacklist", CAPPED_SQL)
def timer_blacklist(spark, sf):
    clicks = with_event_time(kinds(event_stream(spark, sf), "click"), "ts", BOUND)
    found = processors.stream_click_cap(clicks, "user_id", "ts", "event_id", 10)
    return drained(spark, found).filter("user_id <> -1").withColumnRenamed("id", "event_id")


@query("timer_throttle", f"SELECT user_id, event_id FROM ({ORACLES['throttle']})")
def timer_throttle(spark, sf):
    errors = with_event_time(kinds(event_stream(spark, sf), "error"), "ts", BOUND)
    found = processors.stream_throttle(errors, "user_id", "ts", "event_id", batch.SIX_HOURS)
    return drained(spark, found).filter("user_id <> -1").withColumnRenamed("id", "event_id")


@query("timer_running", batch.RUNNING_CTE + """
SELECT user_id, event_id, n AS running_count, CAST(total AS BIGINT) AS running_cents FROM r""")
def timer_running(spark, sf):
    rows = with_event_time(event_stream(spark, sf), "ts", BOUND)
    found = processors.stream_running(rows, "user_id", "ts", "event_id", F.round(F.col("value") * 100))
    found = drained(spark, found).filter("user_id <> -1")
    return found.toDF("user_id", "event_id", "running_count", "running_cents")


@query("timer_running_avg", batch.RUNNING_CTE + """
SELECT user_id, event_id, CAST(total AS DOUBLE) / CAST(n AS DOUBLE) AS running_avg FROM r WHERE n >= 2""")
def timer_running_avg(spark, sf):
    rows = with_event_time(event_stream(spark, sf), "ts", BOUND)
    found = processors.stream_running_average(rows, "user_id", "ts", "event_id", F.round(F.col("value") * 100))
    found = drained(spark, found).filter("user_id <> -1")
    return found.select("user_id", F.col("id").alias("event_id"), "running_avg")


FIVE_HOURS = timedelta(hours=5)
EXPIRY_SQL = """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 5 HOURS THEN 1 ELSE 0 END AS anew FROM events
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(anew) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS life FROM g),
  p AS (SELECT user_id, event_id, 'running' AS operator, row_number() OVER (PARTITION BY user_id, life ORDER BY ts, event_id) AS place FROM s
        UNION ALL SELECT user_id, event_id, 'throttle', 1 FROM ({throttle}))
SELECT user_id, event_id, operator, place, 0 AS states FROM p
""".format(throttle=ORACLES["throttle"])


def states_left(spark, checkpoint, variable="state"):
    """Keys that still have a state after a stream's last batch, the closing event's left out."""
    store = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    return store.filter("key.user_id <> -1").count()


@query("timer_state_expiry", EXPIRY_SQL)
def timer_state_expiry(spark, sf):
    """Counts that start anew after five hours without a row, and throttled errors; with the states that are left in the
    store when the watermark has passed everything."""
    found = []
    for name, kind in (("running", None), ("throttle", "error")):
        rows = event_stream(spark, sf)
        rows = with_event_time(rows if kind is None else kinds(rows, kind), "ts", BOUND)
        if kind is None:
            made = processors.stream_running(rows, "user_id", "ts", "event_id", F.lit(0), FIVE_HOURS).select("user_id", "id", F.col("running_count").alias("place"))
        else:
            made = processors.stream_throttle(rows, "user_id", "ts", "event_id", batch.SIX_HOURS).select("user_id", "id", F.lit(1).cast("long").alias("place"))
        checkpoint = scratch(spark, "checkpoint")
        done = drained(spark, made, checkpoint)
        left = sum(states_left(spark, checkpoint, v) for v in ("state", "waiting"))
        found.append(done.select("user_id", F.col("id").alias("event_id"), F.lit(name).alias("operator"), "place", F.lit(left).alias("states")))
    return found[0].unionByName(found[1]).filter("user_id <> -1")


# --- Spark's own stream operators ---------------------------------------------------------------


@query("stream_sliding_count", ORACLES["sliding_count"])
def stream_sliding_count(spark, sf):
    rows = with_event_time(event_stream(spark, sf), "ts", BOUND)
    found = operators.stream_sliding_count(rows, "event_type", "ts", batch.HOUR, batch.FIVE_MINUTES)
    return unzoned(drained(spark, found), "window_start", "window_end").filter(F.col("event_type") != SENTINEL)


@query("stream_interval_join", ORACLES["interval_join"])
def stream_interval_join(spark, sf):
    rows = with_event_time(event_stream(spark, sf), "ts", BOUND)
    click = rows.filter("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")
    )
    purchase = rows.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("buyer"), F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    found = operators.stream_interval_join(
        click, purchase, "user_id", "buyer", "click_ts", "purchase_ts", batch.SIX_HOURS, batch.SIX_HOURS
    )
    return unzoned(drained(spark, found.drop("buyer")), "click_ts", "purchase_ts")


def enriched(spark, sf, lookup, columns, on_batch=None):
    """All micro-batches of the log, enriched by the customer's columns and the version of the lookup."""
    path = scratch(spark, "enriched")
    write = batch_files(path)

    def handle(rows, batch_id):
        if on_batch:
            on_batch(batch_id)
        made = lookup.enrich(rows.select("event_id", "user_id"), "user_id", "c_custkey", columns)
        write(made.withColumn("version", F.lit(lookup.version)), batch_id)

    run_batches(event_stream(spark, sf), handle, scratch(spark, "checkpoint"))
    lookup.close()
    return spark.read.parquet(path).filter("event_id <> -1")


@query("stream_lookup_enrich", ORACLES["lookup_enrich"])
def stream_lookup_enrich(spark, sf):
    """Events enriched from a cached copy of the customers, read again when half a minute old."""
    customers = operators.RefreshingLookup(lambda: table(spark, sf, "customer"), 30)
    return enriched(spark, sf, customers, ["c_name", "c_mktsegment"]).drop("batch", "version")


@query("stream_lookup_refresh", """
SELECT 'batch ' || made || ': ' || c_mktsegment AS segment, version, 3 AS loads, true AS timely
FROM (SELECT DISTINCT c_mktsegment FROM customer), (VALUES (1, 0), (2, 1), (3, 3)) AS v(version, made)
""")
def stream_lookup_refresh(spark, sf):
    """The lookup's table is another one in every batch, and is read again when 30 seconds old: in batches 1 and 3 here.

    The result are the versions that the events met, by segment: each read once, its values those of the batch it was read in.
    """
    seen, place, seconds = {"batch": 0}, scratch(spark, "customers"), [0, 30, 45, 60]

    def load():
        """The table of this batch in the place of the one before: whoever looked again at an older one would see this."""
        changed = F.concat(F.lit(f"batch {seen['batch']}: "), "c_mktsegment").alias("c_mktsegment")
        table(spark, sf, "customer").select("c_custkey", changed).write.mode("overwrite").parquet(place)
        return spark.read.parquet(place)

    def on_batch(batch_id):
        seen["batch"] = batch_id

    lookup = operators.RefreshingLookup(load, 30, lambda: float(seconds[min(seen["batch"], 3)]))
    found = enriched(spark, sf, lookup, ["c_mktsegment"], on_batch)
    timely = F.min(F.col("version") == F.element_at(F.array(*map(F.lit, (1, 2, 2, 3, 3))), F.col("batch") + 1))
    met = found.filter("c_mktsegment IS NOT NULL").groupBy(F.col("c_mktsegment").alias("segment"), "version").agg(timely.alias("timely"))
    return met.select("segment", "version", F.lit(lookup.loads).alias("loads"), "timely")


@query("stream_kv_latest", ORACLES["kv_latest"])
def stream_kv_latest(spark, sf):
    """Each micro-batch reports the keys it changed; the last report of a key counts."""
    latest = operators.stream_latest_per_key(
        event_stream(spark, sf), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"],
        F.col("event_type") == "error",
    )
    path = scratch(spark, "reports")
    with setting(spark, PARTITIONS, str(spark.sparkContext.defaultParallelism)):
        run_batches(latest, batch_files(path), scratch(spark, "checkpoint"), "update")
    reports = spark.read.parquet(path)
    values = F.struct("event_id", "event_type", "value", "deleted")
    last = reports.groupBy("user_id").agg(F.max_by(values, F.col("batch")).alias("_last"))
    return last.select("user_id", "_last.*").filter("NOT deleted AND user_id <> -1").drop("deleted")


def files_of_a_slice(rows, text, file_rows=FILE_ROWS, file_bytes=FILE_BYTES):
    """Files that each of the slices needs when the rows are dealt evenly to all of them."""
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    return max(1, -(-n // (SLICES * file_rows)), -(-size // (SLICES * file_bytes)))


@query("stream_word_count", ORACLES["word_count"])
def stream_word_count(spark, sf):
    """The documents in four micro-batches, in no order: counts need none."""
    documents, folder = table(spark, sf, "documents"), scratch(spark, "arrivals")
    # Files of a bounded number of rows and, on average, bytes of text; a trigger takes a quarter of them.
    files = files_of_a_slice(documents, "text")
    documents.repartition(SLICES * files).write.parquet(folder)
    counted = operators.stream_word_count(read_stream(spark, folder, documents.schema, maxFilesPerTrigger=files), "text")
    path = scratch(spark, "reports")
    with setting(spark, PARTITIONS, str(spark.sparkContext.defaultParallelism)):
        run_batches(counted, batch_files(path), scratch(spark, "checkpoint"), "update")
    return spark.read.parquet(path).groupBy("word").agg(F.max_by("n", "batch").alias("n"))


@query("stream_resume", ORACLES["sliding_count"])
def stream_resume(spark, sf):
    """The sliding count stopped half-way and started again from its checkpoint."""
    log = table(spark, sf, "events")
    folder, path, checkpoint = scratch(spark, "arrivals"), scratch(spark, "stream"), scratch(spark, "checkpoint")
    slices, files = time_slices(log)

    def run():
        rows = with_event_time(read_stream(spark, folder, log.schema, maxFilesPerTrigger=files), "ts", BOUND)
        found = operators.stream_sliding_count(rows, "event_type", "ts", batch.HOUR, batch.FIVE_MINUTES)
        return drained(spark, found, checkpoint, path)

    half = len(slices) // 2
    arrive(folder, slices[:half], files)
    if half:
        run()
    arrive(folder, slices[half:], files)
    sentinel(spark, log.schema).write.mode("append").parquet(folder)
    return unzoned(run(), "window_start", "window_end").filter(F.col("event_type") != SENTINEL)
