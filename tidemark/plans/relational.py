"""Queries on the order tables: scans, filters, counts, the work queue, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import paths, scalars
from tidemark.operators.groups import coverage_class, partition_counts, sorted_merge
from tidemark.operators.joins import count_reconcile
from tidemark.operators.running import word_count as count_words
from tidemark.operators.upkeep import copy_outcomes
from tidemark.operators.upkeep import verify_subpartitions as checked_subpartitions
from tidemark.operators.workqueue import claim, current_status, largest_first, next_record, pending, status_summary
from tidemark.plans.registry import query
from tidemark.sources import tables
from tidemark.sources.inventory import rewrite_decision as decide
from tidemark.sources.tables import table

FLAGS = ["l_returnflag", "l_linestatus"]

# --- scans and filters -----------------------------------------------------------------------


@query("parse_delimited", """
SELECT CAST(split_part(line, ',', 1) AS BIGINT) AS user_id, CAST(split_part(line, ',', 2) AS BIGINT) AS ad_id,
       split_part(line, ',', 3) AS province, split_part(line, ',', 4) AS city,
       CAST(split_part(line, ',', 5) AS BIGINT) AS click_time
FROM (SELECT concat(user_id, ',', event_id, ',', event_type, ',,', epoch_us(ts) // 1000) AS line FROM events)
""")
def parse_delimited(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    line = F.concat_ws(",", "user_id", "event_id", "event_type", F.lit(""), millis)
    lines = table(spark, sf, "events").select(line.alias("line"))
    return tables.parse_delimited(lines, "line", tables.CLICK_SCHEMA)


# The order states and what they are called.
STATES = [("F", "finished"), ("O", "open"), ("P", "partial")]


@query("inline_rows", """
SELECT s.label, count(o.o_orderkey) AS n
FROM (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) s(state, label)
LEFT JOIN orders o ON o.o_orderstatus = s.state GROUP BY s.label
""")
def inline_rows(spark, sf):
    states = tables.inline_rows(spark, STATES, "state string, label string")
    counted = partition_counts(table(spark, sf, "orders"), ["o_orderstatus"])
    joined = states.join(counted, states["state"] == counted["o_orderstatus"], "left")
    return joined.select("label", F.coalesce("n", F.lit(0)).alias("n"))


@query("range_scan", """
SELECT k.id, count(l.l_orderkey) AS n_lines
FROM (SELECT unnest(generate_series((SELECT min(o_orderkey) FROM orders),
                                    (SELECT max(o_orderkey) - 1 FROM orders))) AS id) k
LEFT JOIN lineitem l ON l.l_orderkey = k.id GROUP BY k.id
""")
def range_scan(spark, sf):
    """Lines of each whole number in the key range of the orders, the last one left out."""
    # One row: the ends of the range.
    low, high = table(spark, sf, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    keys = tables.range_scan(spark, low, high)
    lines = partition_counts(table(spark, sf, "lineitem"), ["l_orderkey"], "n_lines")
    joined = keys.join(lines, keys["id"] == lines["l_orderkey"], "left")
    return joined.select("id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


@query("project_rename", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS order_type, o_orderdate AS order_time FROM orders
""")
def project_rename(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderstatus").alias("order_type"),
        F.col("o_orderdate").alias("order_time"),
    )


@query("filter_nonempty", """
SELECT event_id, tx_id FROM (
  SELECT event_id, CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE event_type END AS tx_id FROM events)
WHERE coalesce(tx_id, '') <> ''
""")
def filter_nonempty(spark, sf):
    kind = F.col("event_type")
    tx_id = F.when(kind == "error", "").when(kind != "signup", kind)
    rows = table(spark, sf, "events").select("event_id", tx_id.alias("tx_id"))
    return rows.filter(scalars.non_empty("tx_id"))


@query("filter_arith", """
SELECT o_orderkey, o_orderkey * 2 AS doubled, o_orderkey % 2 AS odd FROM orders WHERE o_orderkey > 2
""")
def filter_arith(spark, sf):
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").filter(key > 2)
    return rows.select(key, (key * 2).alias("doubled"), (key % 2).alias("odd"))


@query("drop_columns", "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def drop_columns(spark, sf):
    return table(spark, sf, "lineitem").drop("l_tax", "l_discount")


@query("period_filter", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dt FROM orders
WHERE strftime(o_orderdate, '%Y%m%d') LIKE '199803%' AND strftime(o_orderdate, '%Y%m%d') NOT IN ('19980313', '19980314')
""")
def period_filter(spark, sf):
    day = F.date_format("o_orderdate", "yyyyMMdd").alias("dt")
    rows = table(spark, sf, "orders").select("o_orderkey", day)
    return rows.filter(F.col("dt").startswith("199803") & ~F.col("dt").isin("19980313", "19980314"))


PRIORITY_SQL = "nullif(o_orderpriority, '4-NOT SPECIFIED')"


@query("filter_status", f"""
SELECT o_orderkey, {PRIORITY_SQL} AS backup_path FROM orders
WHERE o_orderstatus = 'F' AND {PRIORITY_SQL} IS NOT NULL AND o_totalprice > 1000
""")
def filter_status(spark, sf):
    queue = table(spark, sf, "orders").withColumn(
        "backup_path", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    )
    rows = pending(queue, "o_orderstatus", "F", F.col("backup_path").isNotNull(), F.col("o_totalprice") > 1000)
    return rows.select("o_orderkey", "backup_path")


DIGIT_SQL = "regexp_extract(props, ': ([^}]*)', 1)"


@query("filter_regex", f"""
SELECT event_id, {DIGIT_SQL} AS k FROM events WHERE regexp_full_match({DIGIT_SQL}, '[0-9]')
""")
def filter_regex(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.regexp_extract("props", ": ([^}]*)", 1).alias("k"))
    return rows.filter(scalars.is_digit("k"))


# --- counts ----------------------------------------------------------------------------------


@query("partition_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def counts_by_flags(spark, sf):
    return partition_counts(table(spark, sf, "lineitem"), FLAGS)


@query("word_count", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def word_count(spark, sf):
    return count_words(table(spark, sf, "documents"), "text")


@query("coverage_class", """
SELECT c.c_custkey AS o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_with,
       count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS n_without,
       CASE WHEN count(o_orderkey) = 0 THEN 'empty'
            WHEN count(CASE WHEN o_orderstatus = 'F' THEN 1 END) = 0 THEN 'none'
            WHEN count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) = 0 THEN 'all' ELSE 'partial' END AS coverage
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey
""")
def finished_orders_by_customer(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return coverage_class(table(spark, sf, "orders"), "o_custkey", F.col("o_orderstatus") == "F", customers)


@query("count_reconcile", """
WITH s AS (SELECT l_returnflag, l_linestatus, count(*) AS source_rows FROM lineitem GROUP BY ALL),
t AS (SELECT l_returnflag, l_linestatus, count(*) AS target_rows FROM lineitem
      WHERE (l_returnflag = 'A' OR l_discount < 0.05) AND l_returnflag <> 'N' GROUP BY ALL)
SELECT l_returnflag, l_linestatus, source_rows, target_rows,
  CASE WHEN target_rows IS NULL THEN 'missing_target' WHEN source_rows = target_rows THEN 'ok'
       ELSE 'count_mismatch' END AS status
FROM s LEFT JOIN t USING (l_returnflag, l_linestatus)
""")
def reconcile_flags(spark, sf):
    source = table(spark, sf, "lineitem")
    kept = (F.col("l_returnflag") == "A") | (F.col("l_discount") < 0.05)
    return count_reconcile(source, source.filter(kept & (F.col("l_returnflag") != "N")), FLAGS)


@query("verify_copy", """
WITH e AS (SELECT f.l_returnflag, s.l_linestatus FROM (SELECT DISTINCT l_returnflag FROM lineitem) f,
           (SELECT DISTINCT l_linestatus FROM lineitem UNION SELECT 'X') s),
s AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL),
t AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
      WHERE l_returnflag <> 'R' OR l_quantity > 1 GROUP BY ALL)
SELECT l_returnflag, l_linestatus, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
  CASE WHEN s.n IS NULL THEN 'empty_source' WHEN s.n = t.n THEN 'ok' ELSE 'count_mismatch' END AS outcome
FROM e LEFT JOIN s USING (l_returnflag, l_linestatus) LEFT JOIN t USING (l_returnflag, l_linestatus)
""")
def verify_copy(spark, sf):
    source = table(spark, sf, "lineitem")
    target = source.filter((F.col("l_returnflag") != "R") | (F.col("l_quantity") > 1))
    return copy_outcomes(source, target, FLAGS, expected_flags(source))


def expected_flags(rows):
    """The partitions of the table and, for each flag, one status that never occurs."""
    known = rows.select(*FLAGS).distinct()
    never = known.select("l_returnflag", F.lit("X").alias("l_linestatus")).distinct()
    return known.unionByName(never)


@query("verify_subpartitions", """
WITH e AS (SELECT f.l_returnflag, s.l_linestatus FROM (SELECT DISTINCT l_returnflag FROM lineitem) f,
           (SELECT DISTINCT l_linestatus FROM lineitem UNION SELECT 'X') s),
s AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, coalesce(n, 0) AS n, coalesce(n, 0) > 0 AS verified
FROM e LEFT JOIN s USING (l_returnflag, l_linestatus)
""")
def verify_subpartitions(spark, sf):
    rows = table(spark, sf, "lineitem")
    return checked_subpartitions(rows, expected_flags(rows), FLAGS)


# --- the work queue --------------------------------------------------------------------------

OPEN_SQL = "FROM orders WHERE o_orderstatus = 'O'"


def open_orders(spark, sf):
    return pending(table(spark, sf, "orders"), "o_orderstatus", "O")


@query("status_pending", f"SELECT count(*) AS n {OPEN_SQL}")
def status_pending(spark, sf):
    return open_orders(spark, sf).agg(F.count("*").alias("n"))


@query("top_pending", f"SELECT o_orderkey, o_totalprice {OPEN_SQL} ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def top_pending(spark, sf):
    return largest_first(open_orders(spark, sf), "o_totalprice", "o_orderkey").select("o_orderkey", "o_totalprice")


@query("next_pending", f"SELECT o_orderkey, o_totalprice {OPEN_SQL} ORDER BY o_orderkey LIMIT 1")
def next_pending(spark, sf):
    return next_record(open_orders(spark, sf), "o_orderkey").select("o_orderkey", "o_totalprice")


@query("batch_pick", f"SELECT o_orderkey, o_totalprice {OPEN_SQL} ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def batch_pick(spark, sf):
    rows = largest_first(open_orders(spark, sf), "o_totalprice", "o_orderkey", 10)
    return rows.select("o_orderkey", "o_totalprice")


@query("queue_status", """
WITH log AS (
  SELECT o_orderkey AS id, 1 AS seq, 'claimed' AS status FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL SELECT o_orderkey, 2, 'done' FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 2, 'pending' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
), cur AS (
  SELECT o.o_orderkey AS id, o.o_totalprice, coalesce(arg_max(l.status, l.seq), 'pending') AS status
  FROM orders o LEFT JOIN log l ON l.id = o.o_orderkey GROUP BY ALL
), picked AS (SELECT id FROM cur WHERE status = 'pending' ORDER BY o_totalprice DESC, id LIMIT 10)
SELECT CASE WHEN id IN (SELECT id FROM picked) THEN 'claimed' ELSE status END AS status, count(*) AS n
FROM cur GROUP BY 1
""")
def queue_status(spark, sf):
    """The state of the queue after one more claim of ten records."""
    orders = table(spark, sf, "orders")
    state = F.col("o_orderstatus")

    def entry(rows, seq, status):
        return rows.select(
            F.col("o_orderkey").alias("id"), F.lit(seq).cast("long").alias("seq"), F.lit(status).alias("status")
        )

    retried = (state == "P") & (F.col("o_orderpriority") == "1-URGENT")
    log = (
        entry(orders.filter(state.isin("F", "P")), 1, "claimed")
        .unionByName(entry(orders.filter(state == "F"), 2, "done"))
        .unionByName(entry(orders.filter(retried), 2, "pending"))
    )
    records = orders.select(F.col("o_orderkey").alias("id"), "o_totalprice")
    claimed = claim(records, log, "id", "seq", "status", "o_totalprice", 10, "pending", "claimed")
    now = current_status(log.unionByName(claimed), "id", "seq", "status")
    current = records.join(now, "id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))
    return status_summary(current, "status")


@query("sorted_merge", """
SELECT name, balance FROM (SELECT c_name AS name, c_acctbal AS balance FROM customer
  UNION ALL SELECT s_name, s_acctbal FROM supplier) ORDER BY balance, name
""")
def merge_balances(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return sorted_merge(customers, suppliers, "balance", "name")


# --- scalar functions --------------------------------------------------------------------------


@query("epoch_ms", "SELECT event_id, date_trunc('millisecond', ts) AS event_time FROM events")
def epoch_ms(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = table(spark, sf, "events").select("event_id", millis.alias("ms"))
    return rows.select("event_id", scalars.event_time("ms").cast("timestamp_ntz").alias("event_time"))


SPEC_SQL = """
(SELECT l_orderkey, l_linenumber, concat('l_returnflag=', l_returnflag, '/l_linestatus=', l_linestatus,
        '/dt=', strftime(l_shipdate, '%Y%m%d')) AS spec FROM lineitem)
"""


def specs(spark, sf):
    spec = F.concat(
        F.lit("l_returnflag="), "l_returnflag", F.lit("/l_linestatus="), "l_linestatus",
        F.lit("/dt="), F.date_format("l_shipdate", "yyyyMMdd"),
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", spec.alias("spec"))


@query("partition_spec", f"""
SELECT l_orderkey, l_linenumber,
  split_part(split_part(spec, '/', 1), '=', 1) AS first_field, split_part(split_part(spec, '/', 1), '=', 2) AS first_value,
  split_part(split_part(spec, '/', -1), '=', 1) AS last_field, split_part(split_part(spec, '/', -1), '=', 2) AS last_value
FROM {SPEC_SQL}
""")
def partition_spec(spark, sf):
    return specs(spark, sf).select(
        "l_orderkey", "l_linenumber",
        paths.spec_field("spec").alias("first_field"), paths.spec_value("spec").alias("first_value"),
        paths.spec_field("spec", -1).alias("last_field"), paths.spec_value("spec", -1).alias("last_value"),
    )


@query("spec_predicate", f"""
SELECT l_orderkey, l_linenumber,
  replace(replace(spec, '=', '='''), '/', ''' and ') || '''' AS predicate
FROM {SPEC_SQL}
""")
def spec_predicate(spark, sf):
    return specs(spark, sf).select("l_orderkey", "l_linenumber", paths.spec_predicate("spec").alias("predicate"))


@query("spec_levels", f"""
SELECT l_orderkey, l_linenumber, split_part(spec, '/', 1) || '/' || split_part(spec, '/', 2) AS head,
  CAST(len(string_split(spec, '/')) AS INTEGER) AS levels
FROM {SPEC_SQL}
""")
def spec_levels(spark, sf):
    return specs(spark, sf).select(
        "l_orderkey", "l_linenumber", paths.spec_head("spec").alias("head"),
        paths.spec_level_count("spec").alias("levels"),
    )


@query("path_parts", """
SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS cluster,
  array_to_string(string_split(url, '/')[:-2], '/') AS parent, split_part(url, '/', -1) AS name,
  CASE WHEN contains(split_part(url, '/', -1), '.') THEN split_part(split_part(url, '/', -1), '.', -1) ELSE '' END AS extension
FROM pages
""")
def path_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", paths.path_cluster("url").alias("cluster"), paths.path_parent("url").alias("parent"),
        paths.path_name("url").alias("name"), paths.path_extension("url").alias("extension"),
    )


@query("path_rewrite", """
SELECT page_id, concat('/warehouse/backup/check_failed/dt=', strftime(DATE '2021-01-01' + CAST(page_id AS INTEGER), '%Y%m%d'),
  '/', split_part(split_part(url, '://', 2), '/', 1)) AS path
FROM pages
""")
def path_rewrite(spark, sf):
    path = F.concat(F.lit("/warehouse/backup/"), paths.path_cluster("url"))
    day = F.date_add(F.to_date(F.lit("2021-01-01")), F.col("page_id").cast("int"))
    moved = paths.dated_path(path, "backup", "check_failed", day)
    return table(spark, sf, "pages").select("page_id", moved.alias("path"))


@query("mode_octal", """
SELECT p_partkey, concat((p_partkey // 64) % 8, (p_partkey // 8) % 8, p_partkey % 8) AS octal FROM part
""")
def mode_octal(spark, sf):
    """The nine low bits of each part key, written as a mode and read back."""
    flags = [
        F.when(F.shiftright("p_partkey", bit) % 2 == 1, "rwx"[2 - bit % 3]).otherwise("-") for bit in range(8, -1, -1)
    ]
    mode = F.concat(F.lit("d"), *flags)
    return table(spark, sf, "part").select("p_partkey", paths.mode_octal(mode).alias("octal"))


BRAND_SQL = """
(SELECT p_brand AS partition, count(*) AS files, sum(CAST(floor(p_retailprice * 10000) AS BIGINT)) AS total_bytes,
        max(CAST(floor(p_retailprice * 10000) AS BIGINT)) AS max_file_bytes FROM part GROUP BY p_brand)
"""


def brand_sizes(spark, sf):
    """Parts as files of a partition per brand, sized by their price."""
    size = F.floor(F.col("p_retailprice") * 10000).cast("long")
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("partition")).agg(
        F.count("*").alias("files"), F.sum(size).alias("total_bytes"), F.max(size).alias("max_file_bytes"),
        F.floor(F.sum(size) / F.count("*")).alias("avg_file_bytes"),
    )


@query("target_files", f"""
SELECT partition, greatest(1, least(files, CAST(total_bytes AS BIGINT) // greatest(max_file_bytes, 100000000))) AS target_files
FROM {BRAND_SQL}
""")
def target_files(spark, sf):
    wanted = paths.target_files("total_bytes", "max_file_bytes", "files", 100_000_000)
    return brand_sizes(spark, sf).select("partition", wanted.alias("target_files"))


@query("rewrite_decision", f"""
SELECT partition, CAST(total_bytes AS BIGINT) // files AS avg_file_bytes,
  CASE WHEN CAST(total_bytes AS BIGINT) // files > 9900000 THEN 'copy' ELSE 'rewrite' END AS decision
FROM {BRAND_SQL}
""")
def rewrite_decision(spark, sf):
    return decide(brand_sizes(spark, sf), 9_900_000).select("partition", "avg_file_bytes", "decision")


# --- text --------------------------------------------------------------------------------------


@query("lenient_int", r"""
WITH d AS (SELECT doc_id, regexp_extract(text, '-?[0-9]+') AS found FROM documents),
n AS (SELECT doc_id, found, starts_with(found, '-') AS neg, ltrim(ltrim(found, '-'), '0') AS digits FROM d)
SELECT doc_id, CAST(CASE WHEN found = '' THEN NULL WHEN len(digits) > 10 THEN CASE WHEN neg THEN -2147483648 ELSE 2147483647 END
  ELSE greatest(-2147483648, least(2147483647, CASE WHEN neg THEN -1 ELSE 1 END * CAST('0' || digits AS BIGINT))) END AS INTEGER) AS number
FROM n
""")
def lenient_int(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalars.lenient_int("text").alias("number"))


@query("bracket_check", r"""
WITH RECURSIVE b AS (
  SELECT doc_id, regexp_replace(text, '[^()\[\]{}]', '', 'g') AS left_over FROM documents
  UNION ALL
  SELECT doc_id, replace(replace(replace(left_over, '()', ''), '[]', ''), '{}', '') FROM b
  WHERE contains(left_over, '()') OR contains(left_over, '[]') OR contains(left_over, '{}')
)
SELECT doc_id, min(len(left_over)) = 0 AS well_bracketed FROM b GROUP BY doc_id
""")
def bracket_check(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", scalars.well_bracketed("text", ignore_other=True).alias("well_bracketed")
    )


PHRASE = ["the", "ren"]


@query("phrase_search", """
SELECT doc_id, CAST(unnest([i FOR i IN range(len(text) - 5)
  IF substr(text, CAST(i + 1 AS BIGINT), 6) IN ('theren', 'renthe')]) AS INTEGER) AS start
FROM documents WHERE contains(text, 'theren') OR contains(text, 'renthe')
""")
def phrase_search(spark, sf):
    starts = F.explode(scalars.phrase_starts("text", PHRASE)).alias("start")
    return table(spark, sf, "documents").select("doc_id", starts)
