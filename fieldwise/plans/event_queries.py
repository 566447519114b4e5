"""Registered queries over the event log (E2-E8, F8, A-4, A-11, A-12, Q6, Q7, W5).

``events`` plays the webhook log: ``event_type`` is the event type,
``user_id`` the resource, ``ts`` the receive time, ``props`` the payload.
Re-deliveries are derived from the log by a fixed rule (every sixth event is
delivered again within the hour, every 35th again eight days later, every 40th
four times more, six days apart).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev_ops
from ..operators.bridge import match_next_rows
from ..operators.joins import bounded_broadcast
from ..sources import seeds
from .catalog import query, table
from .roles import INSTANCES_SQL, values_sql

# Fixed values for the driver-table roles: the allowlisted event types.
DRIVER_ENRICH_TYPES = ["purchase", "signup"]
REPLAY_DELAY_SECONDS = 7 * 24 * 3600
DEBOUNCE_GAP_SECONDS = 2 * 3600
AS_OF = "2024-01-31 00:00:00"


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, plus its re-deliveries, from ONE scan of the log."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    k = F.col("event_id")
    first = F.struct(k.alias("delivery_id"), F.col("ts").alias("received_at"))
    soon = F.when(
        k % 6 == 0,
        F.struct(
            (k + 1_000_000_000).alias("delivery_id"),
            (F.col("ts") + F.make_interval(mins=(k % 50).cast("int")) + F.expr("INTERVAL 1 SECOND")).alias("received_at"),
        ),
    )
    late = F.when(
        k % 35 == 0,
        F.struct((k + 2_000_000_000).alias("delivery_id"), (F.col("ts") + F.expr("INTERVAL 8 DAYS")).alias("received_at")),
    )
    chain = [
        F.when(
            k % 40 == 0,
            F.struct(
                (k + (2 + i) * 1_000_000_000).alias("delivery_id"), (F.col("ts") + F.make_interval(days=F.lit(6 * i))).alias("received_at")
            ),
        )
        for i in range(1, 5)
    ]
    copies = F.filter(F.array(first, soon, late, *chain), lambda x: x.isNotNull())
    d = e.select("event_type", "user_id", "props", F.explode(copies).alias("d"))
    return d.select(
        F.col("d.delivery_id").alias("delivery_id"),
        F.col("d.received_at").alias("received_at"),
        "event_type",
        "user_id",
        "props",
        ev_ops.delivery_hash("event_type", "user_id", "props").alias("hash"),
    )


DELIVERIES_SQL = """
d AS (
  SELECT event_id AS delivery_id, ts AS received_at, event_type, user_id, props FROM events
  UNION ALL
  SELECT event_id + 1000000000, ts + to_minutes(CAST(event_id % 50 AS INTEGER)) + INTERVAL 1 SECOND,
         event_type, user_id, props FROM events WHERE event_id % 6 = 0
  UNION ALL
  SELECT event_id + 2000000000, ts + INTERVAL 8 DAY, event_type, user_id, props FROM events WHERE event_id % 35 = 0
  UNION ALL
  SELECT event_id + (2 + i) * 1000000000::BIGINT, ts + to_days(CAST(6 * i AS INTEGER)), event_type, user_id, props
  FROM events, (VALUES (1), (2), (3), (4)) c(i) WHERE event_id % 40 = 0),
h AS (SELECT *, sha1(event_type || '|' || CAST(user_id AS VARCHAR) || '|' || props) AS hash FROM d)
"""

DEDUPE_SQL = (
    "WITH RECURSIVE "
    + DELIVERIES_SQL
    + f""",
n AS (SELECT delivery_id, hash, received_at, row_number() OVER (PARTITION BY hash ORDER BY received_at, delivery_id) AS i FROM h),
k AS (
  SELECT i, hash, delivery_id, received_at, received_at AS last_kept, TRUE AS kept FROM n WHERE i = 1
  UNION ALL
  SELECT n.i, n.hash, n.delivery_id, n.received_at,
         CASE WHEN epoch_us(n.received_at) - epoch_us(k.last_kept) > {REPLAY_DELAY_SECONDS * 1_000_000} THEN n.received_at ELSE k.last_kept END,
         epoch_us(n.received_at) - epoch_us(k.last_kept) > {REPLAY_DELAY_SECONDS * 1_000_000}
  FROM k JOIN n ON n.hash = k.hash AND n.i = k.i + 1)
SELECT delivery_id, hash, received_at FROM k WHERE kept
"""
)


@query("dedupe_events", DEDUPE_SQL, "E2 X20 T2")
def dedupe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-deliveries within 7 days of the last kept delivery of the same hash are dropped."""
    d = deliveries(spark, sf_dir)
    kept = ev_ops.dedupe_replays(d, "hash", "received_at", REPLAY_DELAY_SECONDS, tiebreak=["delivery_id"])
    return kept.select("delivery_id", "hash", "received_at")


DEBOUNCE_SQL = f"""
WITH e AS (SELECT user_id, ts, event_id,
                  lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > {DEBOUNCE_GAP_SECONDS * 1_000_000}
                     THEN 1 ELSE 0 END AS st FROM e),
g AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events
FROM g GROUP BY user_id, sid
"""


@query("debounce", DEBOUNCE_SQL, "E3")
def debounce_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one resource closer than 2 hours collapse into one unit of work."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    return ev_ops.debounce(e, ["user_id"], "ts", DEBOUNCE_GAP_SECONDS, tiebreak=["event_id"]).select(
        "user_id", "session_start", "session_end", "n_events"
    )


EVENT_RATE_SQL = """
SELECT event_type, time_bucket(INTERVAL 25 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL 25 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 25 MINUTE AS window_end,
       count(*) AS n_events
FROM events GROUP BY 1, 2, 3
"""


@query("event_rate", EVENT_RATE_SQL, "E8")
def event_rate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25-minute tumbling counts per event type (bursts)."""
    e = table(spark, sf_dir, "events", "ts", "event_type")
    return ev_ops.event_rate(e, "ts", "25 minutes", ["event_type"])


EVENT_VOLUME_SQL = """
WITH c AS (SELECT event_type, count(*) AS n_events FROM events GROUP BY 1)
SELECT event_type, n_events, n_events / sum(n_events) OVER () AS share FROM c
"""


@query("event_volume", EVENT_VOLUME_SQL, "A-12")
def event_volume_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev_ops.event_volume(table(spark, sf_dir, "events", "event_type"), "event_type")


ENRICH_QUEUE_SQL = f"""
SELECT user_id, event_type, min(ts) AS first_seen, count(*) AS n_events
FROM events WHERE event_type IN ({", ".join(f"'{t}'" for t in DRIVER_ENRICH_TYPES)})
GROUP BY 1, 2
"""


@query("enrich_queue", ENRICH_QUEUE_SQL, "A-4 F8")
def enrich_queue_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All resources to enrich, with the time that orders them."""
    e = table(spark, sf_dir, "events", "ts", "user_id", "event_type")
    return ev_ops.enrich_queue(e, ["user_id", "event_type"], "ts", "event_type", DRIVER_ENRICH_TYPES)


ROUTE_SQL = f"""
SELECT event_type, CASE WHEN event_type IN ({", ".join(f"'{t}'" for t in DRIVER_ENRICH_TYPES)})
                        THEN 'enrich' ELSE 'drain' END AS route, count(*) AS n_events
FROM events GROUP BY 1, 2
"""


@query("event_route", ROUTE_SQL, "E4 F8")
def event_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_type")
    return ev_ops.route(e, "event_type", DRIVER_ENRICH_TYPES).groupBy("event_type", "route").agg(
        F.count(F.lit(1)).alias("n_events")
    )


DEAD_LETTER_SQL = """
SELECT DISTINCT event_id, CAST(event_id % 7 AS INTEGER) AS process_attempts, 'timeout' AS error
FROM events WHERE event_id % 7 >= 5
"""


@query("dead_letter", DEAD_LETTER_SQL, "E6 W5")
def dead_letter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that failed five times, unique on (id, error)."""
    e = table(spark, sf_dir, "events", "event_id").select(
        "event_id", (F.col("event_id") % 7).cast("int").alias("process_attempts"), F.lit("timeout").alias("error")
    )
    _, dead = ev_ops.split_retries(e)
    return ev_ops.dead_letter(dead, "event_id", "error")


SILENCE_SQL = """
WITH span AS (SELECT event_type, date_trunc('hour', min(ts)) AS f, date_trunc('hour', max(ts)) AS t
              FROM events GROUP BY 1),
hours AS (SELECT event_type, unnest(generate_series(f, t, INTERVAL 1 HOUR)) AS hour_start FROM span),
biz AS (SELECT * FROM hours WHERE hour(hour_start) BETWEEN 8 AND 17 AND isodow(hour_start) BETWEEN 1 AND 5)
SELECT b.event_type, b.hour_start FROM biz b
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = b.event_type
                  AND date_trunc('hour', e.ts) = b.hour_start)
"""


@query("silent_hours", SILENCE_SQL, "E7")
def silent_hours_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday business hours in which an event type was silent."""
    e = table(spark, sf_dir, "events", "ts", "event_type")
    return ev_ops.silent_hours(e, "ts", ["event_type"])


# Freshness targets per entity, in minutes (15 min, 4 h, 7 d).
FRESHNESS_TARGETS = [("purchase", 15), ("signup", 240), ("click", 10080), ("view", 10080), ("error", 10080)]

FRESHNESS_SQL = f"""
WITH f AS (SELECT event_type, count(*) AS n_rows, max(ts) AS max_ts FROM events GROUP BY 1)
SELECT f.event_type, f.n_rows, f.max_ts,
       (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(f.max_ts)) / 3.6e9 AS age_hours,
       t.target_minutes,
       f.n_rows = 0 OR (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(f.max_ts)) > CAST(93600000000 AS BIGINT) AS is_stale,
       (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(f.max_ts)) > CAST(t.target_minutes AS BIGINT) * 60000000 AS breaches_target
FROM f LEFT JOIN {values_sql(FRESHNESS_TARGETS, ['event_type', 'target_minutes'], 't')} ON t.event_type = f.event_type
"""


@query("freshness", FRESHNESS_SQL, "Q6 Q7 A-8")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and newest time per entity, stale after 26 h, and per-entity targets."""
    from ..operators.quality import freshness_report

    e = table(spark, sf_dir, "events", "ts", "event_type")
    targets = seeds.frame(spark, FRESHNESS_TARGETS, "event_type string, target_minutes int")
    return freshness_report(e, "event_type", "ts", AS_OF, targets, stale_hours=26)


QUOTA = 125_000
QUOTA_AS_OF = "2024-01-20 00:00:00"

QUOTA_SQL = f"""
WITH c AS (
  SELECT i.instance_id AS source_instance_id, date_trunc('month', e.ts) AS month, count(*) AS calls
  FROM events e JOIN {INSTANCES_SQL} ON i.r_regionkey = e.user_id % 5
  WHERE e.ts < TIMESTAMP '{QUOTA_AS_OF}'
  GROUP BY 1, 2)
SELECT source_instance_id, CAST(month AS DATE) AS month, calls, calls / {QUOTA}.0 AS quota_share,
  CAST(CASE WHEN month = date_trunc('month', TIMESTAMP '{QUOTA_AS_OF}')
            THEN {QUOTA} * 85 * (day(TIMESTAMP '{QUOTA_AS_OF}') - 1) // (100 * day(last_day(month)))
            ELSE {QUOTA} * 85 // 100 END AS BIGINT) AS prorated_limit,
  calls > CASE WHEN month = date_trunc('month', TIMESTAMP '{QUOTA_AS_OF}')
               THEN {QUOTA} * 85 * (day(TIMESTAMP '{QUOTA_AS_OF}') - 1) // (100 * day(last_day(month)))
               ELSE {QUOTA} * 85 // 100 END AS switch_to_prorated
FROM c
"""


@query("quota_share", QUOTA_SQL, "A-11")
def quota_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API calls per instance and month against the monthly quota and its 85 % prorated line."""
    from ..operators.aggregates import quota_usage

    e = table(spark, sf_dir, "events", "ts", "user_id")
    inst = seeds.instances(spark)
    calls = e.join(bounded_broadcast(inst, 100_000), (F.col("user_id") % 5) == inst["r_regionkey"], "inner").select(
        F.col("instance_id").alias("source_instance_id"), "ts"
    )
    return quota_usage(calls, "source_instance_id", "ts", QUOTA_AS_OF, quota=QUOTA)


LEAD_MATCH_SQL = """
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
m AS (SELECT s.event_id AS lead_id, arg_min(p.event_id, p.ts) AS opportunity_id, min(p.ts) AS opportunity_at
      FROM s JOIN p ON p.user_id = s.user_id AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL 7 DAY
      GROUP BY s.event_id)
SELECT s.user_id, s.event_id AS lead_id, s.ts AS lead_at, m.opportunity_id, m.opportunity_at,
       CAST((epoch_us(m.opportunity_at) - epoch_us(s.ts)) // 1000000 AS BIGINT) AS delay_seconds
FROM s LEFT JOIN m ON m.lead_id = s.event_id
"""


@query("lead_to_opportunity", LEAD_MATCH_SQL, "tier-2 fuzzy lead map (as-of, skew-safe)")
def lead_to_opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signup's first purchase by the same user within 7 days (as-of lookup, no pairs)."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    rows = e.filter(F.col("event_type").isin("signup", "purchase"))
    return match_next_rows(rows, ["user_id"], "ts", "event_id", F.col("event_type") == "purchase", 7 * 24 * 3600)
