"""Registered queries: drains, state that is folded forward, and tables kept in partitions
(E2 E7 E9 E6 S11 S12 W1-W3 W5 J16 J17 R1 R7).

Each lands its driver table in several batches below a folder of its own in the
shared checkpoint folder, runs the operator batch by batch, and returns what the
operator's tables then hold. The oracle states the result over the whole table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import partitioned
from ..operators.bridge import match_next_rows
from ..operators.identity import identities
from ..operators.incremental import fold_latest, latest_state
from ..operators.joins import bounded_broadcast, interval_join
from ..session import checkpoint_dir, written_once
from ..sources import seeds
from ..sources.nested import child_tables
from ..streaming import events as stream
from ..streaming.drain import GuardedLog, RetryDrain
from ..streaming.late import LateAwareDrain
from ..streaming.stateful import silence_stream
from .catalog import query, table
from .event_queries import DELIVERIES_SQL, REPLAY_DELAY_SECONDS, deliveries
from .publish import current, publish
from .resolution_queries import LATEST_BY_SOURCE_SQL
from .roles import INSTANCES_SQL

N_DRAINS = 3
LATENESS_SECONDS = 3600


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of a query."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drained(rows: DataFrame, arrival: Column, n: int = N_DRAINS) -> list[DataFrame]:
    """``rows`` in ``n`` batches of equal arrival time, in order (written once, so that a batch is what it was)."""
    held = written_once(rows.withColumn("_at", F.unix_micros(arrival)))
    lo, hi = held.agg(F.min("_at"), F.max("_at")).first()
    if lo is None:
        return [held.drop("_at")]
    part = F.least(F.floor((F.col("_at") - lo) * n / F.lit(hi - lo + 1)), F.lit(n - 1))
    return [held.filter(part == i).drop("_at") for i in range(n)]


def _drain_sql(arrival: str, source: str, n: int = N_DRAINS) -> str:
    """The batch that a row lands in: what ``drained`` does, as SQL over ``source``."""
    return f"""SELECT *, least(floor((epoch_us({arrival}) - lo) * {n} / (hi - lo + 1)::DOUBLE), {n - 1}) AS drain
  FROM {source}, (SELECT min(epoch_us({arrival})) AS lo, max(epoch_us({arrival})) AS hi FROM {source})"""


def _run_drains(spark: SparkSession, batches: list[DataFrame], base: str, build, out: str) -> None:
    """Land a batch, run the stream over what is new, and so on: state and watermark carry over."""
    name = uuid.uuid4().hex
    for batch in batches:
        batch.write.mode("append").parquet(f"{base}/landed")
        feed = stream.event_stream(spark, f"{base}/landed", schema=batch.schema, fmt="parquet")
        stream.run_available(build(feed), name, stream.batch_writer(out))


# ------------------------------------------------------------------------ E2
_CHAIN_SQL = f"""
n AS (SELECT delivery_id, hash, received_at, row_number() OVER (PARTITION BY hash ORDER BY received_at, delivery_id) AS i FROM h),
k AS (
  SELECT i, hash, delivery_id, received_at, received_at AS last_kept, TRUE AS kept FROM n WHERE i = 1
  UNION ALL
  SELECT n.i, n.hash, n.delivery_id, n.received_at,
         CASE WHEN epoch_us(n.received_at) - epoch_us(k.last_kept) > {REPLAY_DELAY_SECONDS * 1_000_000} THEN n.received_at ELSE k.last_kept END,
         epoch_us(n.received_at) - epoch_us(k.last_kept) > {REPLAY_DELAY_SECONDS * 1_000_000}
  FROM k JOIN n ON n.hash = k.hash AND n.i = k.i + 1)
"""

DEDUPE_DRAINS_SQL = (
    f"WITH RECURSIVE {DELIVERIES_SQL}, {_CHAIN_SQL}"
    f"SELECT delivery_id, hash, received_at FROM k WHERE kept"
    f" AND received_at <= (SELECT date_trunc('milliseconds', max(received_at)) - to_seconds({LATENESS_SECONDS}) FROM h)"
)


@query("dedupe_drains", DEDUPE_DRAINS_SQL, "E2 E1 E9 T2")
def dedupe_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with its re-deliveries, arriving up to an hour out of order in three drains: the
    stream keeps what the batch form keeps, up to the watermark."""
    base = scratch(spark, "dedupe")
    d = deliveries(spark, sf_dir).select("delivery_id", "hash", "received_at")
    arrival = F.col("received_at") + F.make_interval(secs=(F.col("delivery_id") * 7919 % LATENESS_SECONDS).cast("decimal(18,6)"))
    buckets = stream.buckets_for(table(spark, sf_dir, "events", "event_id").count())  # a delivery's copies share its hash
    dedupe = lambda feed: stream.dedupe_stream(feed, "7 days", key="hash", lateness=f"{LATENESS_SECONDS} seconds", tiebreak="delivery_id", buckets=buckets)
    _run_drains(spark, drained(d, arrival), base, dedupe, f"{base}/out")
    return spark.read.schema(d.schema).parquet(f"{base}/out").select(*d.columns)


# ------------------------------------------------------------------------ E7
N_FEEDS = 50
SILENCE_LATENESS_MINUTES = 10

SILENCE_ALERTS_SQL = f"""
WITH e AS (
  SELECT user_id % {N_FEEDS} AS feed, i.timezone AS tz, ts, date_trunc('hour', timezone(i.timezone, ts AT TIME ZONE 'UTC')) AS h
  FROM events JOIN {INSTANCES_SQL} ON i.r_regionkey = user_id % 5
), u AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {SILENCE_LATENESS_MINUTES} MINUTE AS until FROM events),
span AS (
  SELECT feed, tz, min(h) AS f, date_trunc('hour', timezone(tz, any_value(until) AT TIME ZONE 'UTC')) - INTERVAL 1 HOUR AS t FROM e, u GROUP BY feed, tz
), hours AS (SELECT feed, tz, unnest(generate_series(f, t, INTERVAL 1 HOUR)) AS h FROM span)
SELECT feed, timezone('UTC', h AT TIME ZONE tz) AS hour_start FROM hours
WHERE hour(h) BETWEEN 8 AND 17 AND isodow(h) BETWEEN 1 AND 5
  AND NOT EXISTS (SELECT 1 FROM e WHERE e.feed = hours.feed AND e.h = hours.h)
"""


@query("silence_alerts", SILENCE_ALERTS_SQL, "E7 X24")
def silence_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business hours, in each feed's own zone, that passed without an event: alerts raised by timers."""
    base = scratch(spark, "silence")
    e = table(spark, sf_dir, "events", "ts", "user_id")
    inst = seeds.instances(spark)
    feed = e.join(bounded_broadcast(inst, 100_000), (F.col("user_id") % 5) == inst["r_regionkey"]).select(
        (F.col("user_id") % N_FEEDS).alias("feed"), "timezone", F.col("ts").alias("received_at")
    )
    watch = lambda f: silence_stream(f, ["feed"], "timezone", lateness=f"{SILENCE_LATENESS_MINUTES} minutes")
    _run_drains(spark, drained(feed, F.col("received_at")), base, watch, f"{base}/out")
    return spark.read.schema("feed bigint, hour_start timestamp").parquet(f"{base}/out").select("feed", "hour_start")


# --------------------------------------------------------------------- W2 R1
@query("latest_folded", LATEST_BY_SOURCE_SQL, "W2 R1 N1")
def latest_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user and type, folded forward over three generations that arrive in no order."""
    path = f"{scratch(spark, 'latest')}/state"
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    obs = ev.select("user_id", F.col("event_type").alias("source"), "event_id", F.col("ts").alias("observed_at"), "value")
    for generation in range(3):
        fold_latest(spark, path, obs.filter(F.col("event_id") % 3 == generation), ["user_id"], priority=None, tiebreak=["event_id"], buckets=16)
    return latest_state(spark, path, obs.schema).select(*obs.columns)


# ----------------------------------------------------------------------- S12
UPSERT_PARTITIONS_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
       CASE WHEN o_orderkey % 5 = 0 THEN 'updated' ELSE o_orderstatus END AS status
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 = 0
"""


@query("upsert_partitions", UPSERT_PARTITIONS_SQL, "S12")
def upsert_partitions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept by month: a load, an upsert of every fifth order, and its replay, which writes nothing."""
    path = f"{scratch(spark, 'orders')}/table"
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    o = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("status"))
    change = o.filter(F.col("o_orderkey") % 5 == 0).withColumn("status", F.lit("updated"))
    for batch in (o.filter(F.col("o_orderkey") % 3 != 0), change, change):
        n = partitioned.upsert_partitions(spark, path, batch, ["month", "o_orderkey"], ["month"])
    if n:
        raise AssertionError(f"a replay rewrote {n} partitions")
    return partitioned.read_partitioned(spark, path, o.schema).select(*o.columns)


# -------------------------------------------------------------------- J16 R7
GENERATIONS_AS_OF = "2024-01-31 00:00:00"

DROP_GENERATIONS_SQL = f"""
WITH r AS (
  SELECT e.event_id, i.instance_id AS source_instance_id, i.timezone,
         time_bucket(INTERVAL 12 HOUR, e.ts, TIMESTAMP '1970-01-01') AS generated_at
  FROM events e JOIN {INSTANCES_SQL} ON i.r_regionkey = e.user_id % 5),
g AS (SELECT DISTINCT source_instance_id, timezone, generated_at FROM r),
k AS (
  SELECT *, row_number() OVER (PARTITION BY source_instance_id, CAST(timezone(timezone, generated_at AT TIME ZONE 'UTC') AS DATE)
                               ORDER BY generated_at DESC) AS n FROM g)
SELECT r.event_id, r.source_instance_id, r.generated_at FROM r JOIN k USING (source_instance_id, generated_at)
WHERE k.n = 1 OR k.generated_at >= TIMESTAMP '{GENERATIONS_AS_OF}' - INTERVAL 10 DAY
"""


@query("drop_generations", DROP_GENERATIONS_SQL, "J16 R7 N6")
def drop_generations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows kept by instance and generation: retention removes whole generations, unread."""
    path = f"{scratch(spark, 'generations')}/table"
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    inst = seeds.instances(spark)
    half_day = F.window("ts", "12 hours")["start"]
    rows = ev.join(bounded_broadcast(inst, 100_000), (F.col("user_id") % 5) == inst["r_regionkey"]).select(
        "event_id", F.col("instance_id").alias("source_instance_id"), half_day.alias("generated_at"), partitioned.generation_name(half_day).alias("generated")
    )
    by = ["source_instance_id", "generated"]
    partitioned.overwrite_partitions(rows, path, by)
    zones = inst.select(F.col("instance_id").alias("source_instance_id"), "timezone")
    partitioned.drop_generations(spark, path, GENERATIONS_AS_OF, zones)
    return partitioned.read_partitioned(spark, path, rows.schema).select("event_id", "source_instance_id", "generated_at")


# --------------------------------------------------------------------- W1 W3
PUBLISHED_SQL = """
SELECT 1 AS version, o_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
UNION ALL
SELECT 2, o_custkey, count(*) FROM orders GROUP BY o_custkey
"""


@query("published_versions", PUBLISHED_SQL, "W1 W3 Q9")
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader's version stays whole while the next one is built and published."""
    base = scratch(spark, "published")
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus")
    count = lambda df: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    publish(count(o.filter("o_orderstatus = 'F'")), base)
    reader = current(spark, base)
    publish(count(o), base)
    return reader.select(F.lit(1).alias("version"), "*").unionByName(current(spark, base).select(F.lit(2).alias("version"), "*"))


# ----------------------------------------------------------------------- S11
GUARDED_LOG_SQL = f"WITH RECURSIVE {DELIVERIES_SQL}, {_CHAIN_SQL} SELECT delivery_id, hash, received_at FROM k WHERE kept"


@query("guarded_log", GUARDED_LOG_SQL, "S11 E2")
def guarded_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only log over three drains, the second one delivered twice: a replay in any batch lands once."""
    log = GuardedLog(scratch(spark, "log"), key="hash", tiebreak=["delivery_id"])
    d = deliveries(spark, sf_dir).select("delivery_id", "hash", "received_at")
    for i, batch in enumerate(drained(d, F.col("received_at"))):
        for _ in range(2 if i == 1 else 1):
            log(batch, i)
    return log.events(spark, d.schema).select(*d.columns)


# --------------------------------------------------------------------- E6 W5
RETRY_DRAINS = 6

RETRY_SQL = f"""
WITH d AS ({_drain_sql("ts", "events", RETRY_DRAINS)}),
t AS (SELECT event_id, event_id % 7 AS r, {RETRY_DRAINS} - drain AS tries FROM d)
SELECT event_id,
       CASE WHEN r = 6 AND tries >= 5 THEN 'dead' WHEN r = 6 OR r = 5 AND tries < 3 THEN 'queued' ELSE 'processed' END AS outcome,
       CAST(CASE WHEN r = 6 THEN least(tries, 5) WHEN r = 5 THEN least(tries, 2) ELSE 0 END AS INTEGER) AS attempts
FROM t
"""


def _fails(rows: DataFrame) -> DataFrame:
    """The fixed rule of the query: one event in seven always fails, another one twice."""
    tried = F.coalesce("process_attempts", F.lit(0))
    wrong = (F.col("event_id") % 7 == 6) | ((F.col("event_id") % 7 == 5) & (tried < 2))
    return rows.withColumn("error", F.when(wrong, F.lit("timeout")))


@query("retry_drains", RETRY_SQL, "E6 W5")
def retry_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six drains with failures: attempts rise from drain to drain, the fifth failure is a dead letter, once."""
    e = table(spark, sf_dir, "events", "event_id", "ts").withColumnRenamed("ts", "received_at")
    drain = RetryDrain(scratch(spark, "retry"), _fails, e.schema)
    for i, batch in enumerate(drained(e, F.col("received_at"), RETRY_DRAINS)):
        drain(batch, i)
    tried = F.coalesce("process_attempts", F.lit(0)).alias("attempts")
    rows = lambda name: drain.table(spark, name).select("event_id", F.lit(name).alias("outcome"), tried)
    dead = drain.table(spark, "dead_letter").select("event_id", F.lit("dead").alias("outcome"), "attempts")
    return rows("processed").unionByName(rows("queue").withColumn("outcome", F.lit("queued"))).unionByName(dead)


# ------------------------------------------------------------------ E9 E8 E3
LATE_DAYS = 2

LATE_WINDOWS_SQL = f"""
WITH a AS (SELECT *, ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL {LATE_DAYS} DAY ELSE INTERVAL 0 DAY END AS arrival FROM events),
d AS ({_drain_sql("arrival", "a")}),
w AS (SELECT drain, max(max(ts)) OVER (ORDER BY drain) - INTERVAL 1 HOUR AS passed FROM d GROUP BY drain),
r AS (SELECT d.*, coalesce(ts <= (SELECT max(passed) FROM w WHERE w.drain < d.drain), FALSE) AS late FROM d)
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
       count(*) FILTER (NOT late) AS n_on_time, count(*) FILTER (late) AS n_late, count(*) AS n_events,
       time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR <= (SELECT max(passed) FROM w) AS closed
FROM r GROUP BY ALL
"""


@query("late_windows", LATE_WINDOWS_SQL, "E8 E9")
def late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts over three drains, some events two days late: late rows are kept and revise closed windows."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type").withColumnRenamed("ts", "received_at")
    arrival = F.col("received_at") + F.make_interval(days=F.when(F.col("event_id") % 50 == 0, LATE_DAYS).otherwise(0))
    drain = LateAwareDrain(scratch(spark, "late"), e.schema, "1 HOUR", "1 hour", ["event_type"])
    for i, batch in enumerate(drained(e, arrival)):
        drain(batch, i)
    return drain.windows(spark).select("event_type", "window_start", "n_on_time", "n_late", "n_events", "closed")


# ----------------------------------------------------------------------- J17
ORDER_AT_SHIPMENT_SQL = """
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, max(o_orderkey) AS current_order FROM orders GROUP BY ALL),
iv AS (
  SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) - 1, DATE '9999-12-31') AS valid_to FROM d)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_shipdate AS DATE) AS ship_date, iv.current_order
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN iv ON iv.o_custkey = o.o_custkey AND CAST(l.l_shipdate AS DATE) BETWEEN iv.valid_from AND iv.valid_to
"""


@query("order_at_shipment", ORDER_AT_SHIPMENT_SQL, "J17")
def order_at_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer's newest order on the day a line ships: as many validity intervals as orders."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    days = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("valid_from")).agg(F.max("o_orderkey").alias("current_order"))
    # one customer's distinct order days: a window over days, not orders
    later = F.expr("date_sub(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from), 1)")
    iv = days.withColumn("valid_to", F.coalesce(later, F.lit("9999-12-31").cast("date")))
    lines = li.join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).withColumn("ship_date", F.to_date("l_shipdate"))
    out = interval_join(lines, iv, "ship_date", "valid_from", "valid_to", ["o_custkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ship_date", "current_order")


# ------------------------------------------------------- tier 2 (lead map)
#: Contacts of a row, by fixed rules: an e-mail of the user, a phone that two users share; some rows have one, some none.
LEAD_CONTACTS_SQL = """
  SELECT event_id, user_id, ts, event_type,
         CASE WHEN event_id % 3 <> 0 THEN 'u' || user_id END AS email,
         CASE WHEN event_id % 4 = 1 THEN 'p' || (user_id // 2) END AS phone
  FROM events WHERE event_type IN ('signup', 'purchase')
"""

LEAD_IDENTITY_SQL = f"""
WITH RECURSIVE c AS ({LEAD_CONTACTS_SQL}),
e AS (SELECT DISTINCT email AS a, phone AS b FROM c WHERE email IS NOT NULL AND phone IS NOT NULL),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
v AS (SELECT email AS v FROM c WHERE email IS NOT NULL UNION SELECT phone FROM c WHERE phone IS NOT NULL),
reach AS (SELECT v, v AS w FROM v UNION SELECT r.v, l.b FROM reach r JOIN l ON l.a = r.w),
comp AS (SELECT v, min(w) AS comp FROM reach GROUP BY v),
r AS (SELECT c.*, coalesce(comp.comp, 'row' || event_id) AS comp FROM c LEFT JOIN comp ON comp.v = coalesce(email, phone)),
m AS (
  SELECT s.event_id, min(p.ts) AS at FROM r s JOIN r p ON p.comp = s.comp AND p.event_type = 'purchase'
    AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL 7 DAY
  WHERE s.event_type = 'signup' GROUP BY s.event_id)
SELECT s.event_id AS lead_id, s.ts AS lead_at, m.at AS opportunity_at
FROM r s LEFT JOIN m USING (event_id) WHERE s.event_type = 'signup'
"""


@query("lead_identity", LEAD_IDENTITY_SQL, "tier-2 fuzzy lead map (e-mail or phone)")
def lead_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signup's first purchase within 7 days by the same person, known by e-mail or phone."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type").filter(F.col("event_type").isin("signup", "purchase"))
    k = F.col("event_id")
    rows = written_once(
        e.withColumns(
            {
                "email": F.when(k % 3 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))),
                "phone": F.when(k % 4 == 1, F.concat(F.lit("p"), F.floor(F.col("user_id") / 2).cast("string"))),
            }
        )
    )
    known = rows.join(identities(rows, "event_id", ["email", "phone"]), "event_id")
    out = match_next_rows(known, ["identity"], "ts", "event_id", F.col("event_type") == "purchase", 7 * 24 * 3600)
    return out.select("lead_id", "lead_at", "opportunity_at")


# ------------------------------------------------------------------------ S2
_LINE = T.StructType().add("l_linenumber", T.LongType()).add("l_partkey", T.LongType()).add("flags", T.ArrayType(T.StringType()))
ORDER_PAYLOAD = T.StructType().add("o_orderkey", T.LongType()).add("lines", T.ArrayType(_LINE))

PAYLOAD_TABLES_SQL = """
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS i
  FROM lineitem)
SELECT l_orderkey AS order_key, i AS line, CAST(NULL AS BIGINT) AS flag, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(NULL AS VARCHAR) AS value,
       '{"supplier":' || l_suppkey || '}' AS surplus FROM l
UNION ALL
SELECT l_orderkey, i, CAST(f.k AS BIGINT), NULL, NULL, CASE f.k WHEN 0 THEN l_returnflag ELSE l_linestatus END, NULL FROM l, (VALUES (0), (1)) f(k)
"""


@query("payload_tables", PAYLOAD_TABLES_SQL, "S2 J1 J2")
def payload_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON payloads, taken apart into lines and the lines' flags; an unknown field is kept."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    line = F.struct("l_linenumber", "l_partkey", F.col("l_suppkey").alias("supplier"), F.array("l_returnflag", "l_linestatus").alias("flags"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("line")))), lambda x: x["line"])
    payload = F.to_json(F.struct(F.col("l_orderkey").alias("o_orderkey"), ordered.alias("lines")))
    docs = li.groupBy("l_orderkey").agg(payload.alias("payload")).withColumnRenamed("l_orderkey", "order_key")
    t = child_tables(docs, "payload", ["order_key"], ORDER_PAYLOAD)
    key = F.col("_root_order_key").alias("order_key")
    lines = t["lines"].select(key, F.col("_list_idx").alias("line"), F.lit(None).cast("bigint").alias("flag"), "l_linenumber", "l_partkey", F.lit(None).cast("string").alias("value"), F.to_json("_surplus").alias("surplus"))
    flags = t["lines.flags"].select(key, F.col("_parent_idx")[0].alias("line"), F.col("_list_idx").alias("flag"), F.lit(None).cast("bigint").alias("l_linenumber"), F.lit(None).cast("bigint").alias("l_partkey"), "value", F.lit(None).cast("string").alias("surplus"))
    return lines.unionByName(flags)
