"""Registered queries: observation, collapse and per-field resolution.

Driver-table roles: ``events`` is the observation log; ``event_type`` is the
source, ``user_id`` the entity key, ``ts`` the observation time. Values are
made nullable by a fixed rule (``value`` is unknown to a source on every
third event id, ``k`` on every fifth) so that the null-skip and the T4
"newest row hides older value" rules are exercised on every row of the table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import json_field
from ..operators.resolve import Candidates, latest_by_source, newest_row, resolve_arms
from ..operators.union import ArmSpec, stack_observations
from ..sources.tables import spread
from .catalog import query, table
from .roles import ORDERS_IN_BRANCHES_SQL, branches, orders_in_branches, status_code, status_code_sql

# Candidate lists per field, most authoritative first.
EVENT_CANDIDATES = Candidates(
    fields={
        "value": ["purchase", "click", "view", "signup", "error"],
        "k": ["view", "error", "click", "purchase"],
    }
)
EVENT_SOURCES = ["purchase", "click", "view", "signup", "error"]


EVENT_SCHEMA = {"event_id": "bigint", "value": "double", "k": "bigint"}


def event_arms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[ArmSpec]]:
    """The event log and one arm per event type, values nulled by a fixed rule."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    values = {
        "event_id": F.col("event_id"),
        "value": F.when(F.col("event_id") % 3 != 0, F.col("value")),
        "k": F.when(F.col("event_id") % 5 != 0, json_field("props", "k").cast("bigint")),
    }
    # each arm carries only the fields its source is a candidate for
    arms = [
        ArmSpec(
            source, prio, F.col("ts"),
            {f: v for f, v in values.items() if f == "event_id" or source in EVENT_CANDIDATES.fields[f]},
            when=F.col("event_type") == source,
        )
        for prio, source in enumerate(EVENT_SOURCES, start=1)
    ]
    return ev, arms


PICK_LATEST_SQL = """
WITH obs AS (
  SELECT user_id, event_type AS source, ts AS observed_at, event_id,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 5 = 0 THEN NULL
              ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
  FROM events
), latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, source
                                 ORDER BY observed_at DESC NULLS FIRST, event_id DESC) AS rn
    FROM obs) WHERE rn = 1
), ranked AS (
  SELECT *,
    CASE source WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS pos_value,
    CASE source WHEN 'view' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3
                WHEN 'purchase' THEN 4 END AS pos_k
  FROM latest
)
SELECT user_id,
  arg_max(value, {'t': observed_at, 'p': -pos_value})
    FILTER (WHERE value IS NOT NULL AND observed_at IS NOT NULL AND pos_value IS NOT NULL) AS value,
  arg_max(k, {'t': observed_at, 'p': -pos_k})
    FILTER (WHERE k IS NOT NULL AND observed_at IS NOT NULL AND pos_k IS NOT NULL) AS k,
  max(observed_at) AS synced_at,
  count(*) AS n_sources
FROM ranked GROUP BY user_id
"""


@query("pick_latest_users", PICK_LATEST_SQL, "U1 R1 R2 R5")
def pick_latest_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resolved row per user: per-field newest non-null value, freshness."""
    ev, arms = event_arms(spark, sf_dir)
    out = resolve_arms(ev, ["user_id"], arms, EVENT_SCHEMA, EVENT_CANDIDATES, tiebreak=["event_id"], count_col="n_sources")
    return out.withColumn("n_sources", F.col("n_sources").cast("bigint"))


LATEST_BY_SOURCE_SQL = """
SELECT user_id, event_type AS source, event_id, ts AS observed_at, value
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
  FROM events) WHERE rn = 1
"""


@query("latest_by_source", LATEST_BY_SOURCE_SQL, "N1 R1 N7")
def latest_by_source_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest whole event per user and event type."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    obs = ev.select(
        "user_id",
        F.col("event_type").alias("source"),
        "event_id",
        F.col("ts").alias("observed_at"),
        "value",
    )
    return latest_by_source(obs, ["user_id"], priority=None, tiebreak=["event_id"])


# ------------------------------------------------------------ R3 R5 R6 R10
ORDER_KEYS = ["source_instance_id", "o_orderkey"]
ORDER_FIELDS = {
    "quote_number": "string",
    "status_code": "int",
    "pipeline_status": "string",
    "service_date": "date",
    "estimated_final_total": "decimal(18,2)",
    "sales_assignee_name": "string",
    "customer_address": "string",
    "branch_name": "string",
    "invoiced_amount": "decimal(18,2)",
    "is_deleted": "boolean",
    "deleted_at": "timestamp",
}
# The candidate table of the resolved order (most authoritative first).
ORDER_CANDIDATES = Candidates(
    fields={
        "quote_number": ["api_enrichment", "api_sweep", "report_lead_status"],
        "status_code": ["api_enrichment", "api_sweep"],
        "pipeline_status": ["api_enrichment", "report_lead_status", "report_booked"],
        "service_date": ["api_enrichment", "report_lead_status"],
        "estimated_final_total": ["api_enrichment", "report_lead_status", "report_booked"],
        "sales_assignee_name": ["api_enrichment", "report_lead_status", "jobs_attribution"],
        "customer_address": ["api_sweep"],
        "branch_name": ["api_enrichment"],
        "invoiced_amount": ["report_booked"],
        "is_deleted": ["deletions", "api_enrichment"],
        "deleted_at": ["deletions"],
    },
    freshness_sources=["api_enrichment", "api_sweep", "report_lead_status", "report_booked", "deletions"],
)


def order_arms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[ArmSpec]]:
    """The orders with their newest job row (R10: J6 + N4), and every source's arm."""
    o = orders_in_branches(spark, sf_dir, "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    at = lambda days: F.col("o_orderdate") + F.make_interval(days=F.lit(days))
    quote = F.when(k % 5 != 0, F.floor(k / 3).cast("string"))
    dec = F.col("o_totalprice").cast("decimal(18,2)")
    arms = [
        ArmSpec("api_enrichment", 1, at(30), {
            "quote_number": quote, "status_code": status_code(), "pipeline_status": F.col("o_orderpriority"),
            "service_date": day, "estimated_final_total": dec,
            "sales_assignee_name": F.when(k % 4 != 1, F.concat(F.lit("rep_"), (k % 17).cast("string"))),
            "branch_name": F.col("branch_name"), "is_deleted": F.lit(False),
        }, when=k % 3 != 0),
        # an older detail snapshot: its assignee is hidden by the newer null (T4)
        ArmSpec("api_enrichment", 1, at(10), {
            "quote_number": quote, "pipeline_status": F.lit("stale status"),
            "sales_assignee_name": F.concat(F.lit("old_rep_"), (k % 7).cast("string")), "is_deleted": F.lit(False),
        }, when=k % 8 == 1),
        ArmSpec("api_sweep", 2, at(40), {
            "quote_number": quote,
            "status_code": F.when(k % 6 == 0, F.lit(20)).otherwise(status_code()),
            "customer_address": F.concat(F.lit("addr "), F.col("o_custkey").cast("string")),
        }, when=k % 2 == 0),
        # equal observation time with the detail call on every 11th order
        ArmSpec("report_lead_status", 3, F.when(k % 11 == 0, at(30)).otherwise(at(35)), {
            "quote_number": quote, "pipeline_status": F.lower("o_orderpriority"),
            "service_date": F.date_add(day, (k % 3).cast("int")),
            "estimated_final_total": F.when(k % 7 == 0, F.round(dec * F.lit(Decimal("1.1")), 2)).otherwise(dec),
            "sales_assignee_name": F.concat(F.lit("Rep "), (k % 13).cast("string")),
        }, when=k % 5 != 2),
        ArmSpec("report_booked", 4, at(45), {
            "pipeline_status": F.lit("Booked"), "estimated_final_total": dec,
            "invoiced_amount": dec + (k % 100),
        }, when=F.col("o_orderstatus") == "F"),
        # deletion markers: after the detail snapshot, or (every 58th) before it
        ArmSpec("deletions", 0, F.when(k % 58 == 0, at(20)).otherwise(at(50)), {
            "is_deleted": F.lit(True), "deleted_at": F.when(k % 58 == 0, at(20)).otherwise(at(50)),
        }, when=k % 29 == 0),
    ]
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    newest_job = newest_row(
        li, ["l_orderkey"],
        [F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")],
        keep=["l_shipdate", "l_suppkey"],
    )
    arms.append(
        ArmSpec("jobs_attribution", 5, F.col("l_shipdate"), {
            "sales_assignee_name": F.concat(F.lit("job_rep_"), (F.col("l_suppkey") % 11).cast("string")),
        }, when=F.col("l_orderkey").isNotNull())
    )
    return o.join(newest_job, o["o_orderkey"] == newest_job["l_orderkey"], "left"), arms


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 in long form: one row for each observation of an order."""
    o, arms = order_arms(spark, sf_dir)
    return stack_observations(o, ORDER_KEYS, arms, ORDER_FIELDS, candidates=ORDER_CANDIDATES)


def _pick_sql(candidates: Candidates) -> str:
    parts = []
    for fld, sources in candidates.fields.items():
        pos = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(sources, start=1))
        parts.append(
            f"arg_max({fld}, {{'t': observed_at, 'p': -(CASE source {pos} END)}}) "
            f"FILTER (WHERE {fld} IS NOT NULL AND observed_at IS NOT NULL AND source IN "
            f"({', '.join(repr(s) for s in sources)})) AS {fld}"
        )
    fresh = ", ".join(repr(s) for s in (candidates.freshness_sources or candidates.sources))
    parts.append(f"max(observed_at) FILTER (WHERE source IN ({fresh})) AS synced_at")
    return ",\n  ".join(parts)


RESOLVE_ORDERS_SQL = f"""
WITH o AS ({ORDERS_IN_BRANCHES_SQL}),
q AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey // 3 AS VARCHAR) END AS quote,
             CAST(o_totalprice AS DECIMAL(18,2)) AS dec, {status_code_sql()} AS code FROM o),
arms AS (
  SELECT source_instance_id, o_orderkey, 'api_enrichment' AS source, 1 AS source_priority,
         o_orderdate + INTERVAL 30 DAY AS observed_at, quote AS quote_number, code AS status_code,
         o_orderpriority AS pipeline_status, CAST(o_orderdate AS DATE) AS service_date, dec AS estimated_final_total,
         CASE WHEN o_orderkey % 4 <> 1 THEN 'rep_' || CAST(o_orderkey % 17 AS VARCHAR) END AS sales_assignee_name,
         CAST(NULL AS VARCHAR) AS customer_address, branch_name, CAST(NULL AS DECIMAL(18,2)) AS invoiced_amount,
         FALSE AS is_deleted, CAST(NULL AS TIMESTAMP) AS deleted_at
  FROM q WHERE o_orderkey % 3 <> 0
  UNION ALL
  SELECT source_instance_id, o_orderkey, 'api_enrichment', 1, o_orderdate + INTERVAL 10 DAY, quote, NULL,
         'stale status', NULL, NULL, 'old_rep_' || CAST(o_orderkey % 7 AS VARCHAR), NULL, NULL, NULL, FALSE, NULL
  FROM q WHERE o_orderkey % 8 = 1
  UNION ALL
  SELECT source_instance_id, o_orderkey, 'api_sweep', 2, o_orderdate + INTERVAL 40 DAY, quote,
         CASE WHEN o_orderkey % 6 = 0 THEN 20 ELSE code END, NULL, NULL, NULL, NULL,
         'addr ' || CAST(o_custkey AS VARCHAR), NULL, NULL, NULL, NULL
  FROM q WHERE o_orderkey % 2 = 0
  UNION ALL
  SELECT source_instance_id, o_orderkey, 'report_lead_status', 3,
         CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate + INTERVAL 35 DAY END,
         quote, NULL, lower(o_orderpriority), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER),
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(round(dec * 1.1, 2) AS DECIMAL(18,2)) ELSE dec END,
         'Rep ' || CAST(o_orderkey % 13 AS VARCHAR), NULL, NULL, NULL, NULL, NULL
  FROM q WHERE o_orderkey % 5 <> 2
  UNION ALL
  SELECT source_instance_id, o_orderkey, 'report_booked', 4, o_orderdate + INTERVAL 45 DAY, NULL, NULL,
         'Booked', NULL, dec, NULL, NULL, NULL, CAST(dec + o_orderkey % 100 AS DECIMAL(18,2)), NULL, NULL
  FROM q WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT source_instance_id, o_orderkey, 'deletions', 0,
         CASE WHEN o_orderkey % 58 = 0 THEN o_orderdate + INTERVAL 20 DAY ELSE o_orderdate + INTERVAL 50 DAY END,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TRUE,
         CASE WHEN o_orderkey % 58 = 0 THEN o_orderdate + INTERVAL 20 DAY ELSE o_orderdate + INTERVAL 50 DAY END
  FROM q WHERE o_orderkey % 29 = 0
  UNION ALL
  SELECT q.source_instance_id, q.o_orderkey, 'jobs_attribution', 5, j.l_shipdate, NULL, NULL, NULL, NULL, NULL,
         'job_rep_' || CAST(j.l_suppkey % 11 AS VARCHAR), NULL, NULL, NULL, NULL, NULL
  FROM q JOIN (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1
  ) j ON j.l_orderkey = q.o_orderkey),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_instance_id, o_orderkey, source
                                              ORDER BY observed_at DESC NULLS FIRST, source_priority) AS rn
                 FROM arms) WHERE rn = 1),
picked AS (
  SELECT source_instance_id, o_orderkey,
  {_pick_sql(ORDER_CANDIDATES)}
  FROM latest GROUP BY source_instance_id, o_orderkey)
SELECT * REPLACE (coalesce(is_deleted, FALSE) AS is_deleted) FROM picked
"""


@query("resolve_orders", RESOLVE_ORDERS_SQL, "R3 R5 R6 R10 U1 R1 R2 J6 N4")
def resolve_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resolved row per order from six complementary sources, with soft delete and freshness."""
    o, arms = order_arms(spark, sf_dir)
    out = resolve_arms(o, ORDER_KEYS, arms, ORDER_FIELDS, ORDER_CANDIDATES)
    return out.withColumn("is_deleted", F.coalesce(F.col("is_deleted"), F.lit(False)))


# ------------------------------------------------------------------- R4 N3
JOB_KEYS = ["source_instance_id", "l_orderkey", "l_linenumber"]
JOB_FIELDS = {
    "external_opportunity_id": "bigint",
    "job_number": "string",
    "service_date": "date",
    "service_type_id": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "billable_hours": "decimal(18,4)",
    "tip_rate": "decimal(18,2)",
}
# The candidate table of the resolved job.
JOB_CANDIDATES = Candidates(
    fields={
        "external_opportunity_id": ["api_enrichment", "api_sweep"],
        "job_number": ["api_enrichment", "api_sweep", "report_all_jobs"],
        "service_date": ["api_enrichment", "api_sweep", "report_all_jobs"],
        "service_type_id": ["api_enrichment", "api_sweep"],
        # single-source report fields: they ride in the report source's newest-row
        # struct of the same aggregation (no second aggregation, no join back)
        "billable_hours": ["report_all_jobs"],
        "tip_rate": ["report_all_jobs"],
    }
)


def job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as jobs, each with its instance (the supplier's branch region)."""
    li = spread(table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_linestatus", "l_shipdate",
    ))
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    b = branches(spark, sf_dir).select("n_nationkey", "source_instance_id")
    return li.join(s, li["l_suppkey"] == s["s_suppkey"], "inner").join(b, F.col("s_nationkey") == b["n_nationkey"], "inner")


def job_arms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[ArmSpec]]:
    """The jobs and the arms of their three sources."""
    j = job_rows(spark, sf_dir)
    day = F.to_date("l_shipdate")
    at = lambda days: F.col("l_shipdate") + F.make_interval(days=F.lit(days))
    jn = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    tb = {"l_partkey": F.col("l_partkey"), "l_suppkey": F.col("l_suppkey")}
    arms = [
        ArmSpec("api_enrichment", 1, at(5), {
            "external_opportunity_id": F.col("l_orderkey"), "job_number": jn, "service_date": day,
            "service_type_id": F.col("l_partkey") % 50, **tb,
        }, when=F.col("l_orderkey") % 3 != 0),
        ArmSpec("api_sweep", 2, at(7), {
            "external_opportunity_id": F.col("l_orderkey"), "job_number": jn,
            "service_date": F.date_add(day, (F.col("l_partkey") % 2).cast("int")),
            "service_type_id": F.col("l_partkey") % 50 + F.col("l_suppkey") % 2, **tb,
        }, when=F.col("l_orderkey") % 2 == 0),
        ArmSpec("report_all_jobs", 3, at(6), {
            "job_number": jn, "service_date": day, **tb,
            "billable_hours": F.col("l_quantity"), "tip_rate": F.col("l_tax"),
        }, when=F.col("l_linestatus") == "F"),
    ]
    return j, arms


JOBS_ARMS_SQL = """
WITH j AS (
  SELECT l.*, b.source_instance_id FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN (SELECT n.n_nationkey, i.instance_id AS source_instance_id FROM nation n
        JOIN (VALUES (0, 'africa'), (1, 'america'), (2, 'asia'), (3, 'europe'), (4, 'middle_east')) i(r, instance_id)
          ON n.n_regionkey = i.r) b ON s.s_nationkey = b.n_nationkey),
arms AS (
  SELECT source_instance_id, l_orderkey, l_linenumber, 'api_enrichment' AS source, 1 AS source_priority,
         l_shipdate + INTERVAL 5 DAY AS observed_at, l_orderkey AS external_opportunity_id,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS job_number,
         CAST(l_shipdate AS DATE) AS service_date, l_partkey % 50 AS service_type_id, l_partkey, l_suppkey
  FROM j WHERE l_orderkey % 3 <> 0
  UNION ALL
  SELECT source_instance_id, l_orderkey, l_linenumber, 'api_sweep', 2, l_shipdate + INTERVAL 7 DAY, l_orderkey,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR),
         CAST(l_shipdate AS DATE) + CAST(l_partkey % 2 AS INTEGER), l_partkey % 50 + l_suppkey % 2, l_partkey, l_suppkey
  FROM j WHERE l_orderkey % 2 = 0
  UNION ALL
  SELECT source_instance_id, l_orderkey, l_linenumber, 'report_all_jobs', 3, l_shipdate + INTERVAL 6 DAY, NULL,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), CAST(l_shipdate AS DATE), NULL,
         l_partkey, l_suppkey
  FROM j WHERE l_linestatus = 'F'),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY source_instance_id, l_orderkey, l_linenumber, source
      ORDER BY observed_at DESC NULLS FIRST, source_priority, l_partkey DESC, l_suppkey DESC) AS rn FROM arms)
  WHERE rn = 1),
rpt AS (
  SELECT * FROM (SELECT source_instance_id, l_orderkey, l_linenumber,
                        CAST(l_quantity AS DECIMAL(18,4)) AS billable_hours, CAST(l_tax AS DECIMAL(18,2)) AS tip_rate,
                        row_number() OVER (PARTITION BY source_instance_id, l_orderkey, l_linenumber
                                           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
                 FROM j WHERE l_linestatus = 'F') WHERE rn = 1),
"""


# The oracle keeps the report-only fields as a join to the newest report row.
_RESOLVED_JOB_FIELDS = Candidates(
    fields={f: srcs for f, srcs in JOB_CANDIDATES.fields.items() if f not in ("billable_hours", "tip_rate")}
)


def _jobs_sql() -> str:
    return (
        JOBS_ARMS_SQL
        + f"""picked AS (
  SELECT source_instance_id, l_orderkey, l_linenumber,
  {_pick_sql(_RESOLVED_JOB_FIELDS)}
  FROM latest GROUP BY source_instance_id, l_orderkey, l_linenumber)
SELECT p.*, r.billable_hours, r.tip_rate FROM picked p
LEFT JOIN rpt r ON r.source_instance_id = p.source_instance_id AND r.l_orderkey = p.l_orderkey
               AND r.l_linenumber = p.l_linenumber
"""
    )


@query("resolve_jobs", _jobs_sql(), "R4 N3 R5 U2")
def resolve_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved jobs from three sources, report-only fields from the newest report row.

    The single-source report fields take the value of the report's newest row
    per job, like a direct join to that row would - but they are carried in
    the same aggregation as the resolved fields, so there is one shuffle and
    no join back.
    """
    j, arms = job_arms(spark, sf_dir)
    return resolve_arms(j, JOB_KEYS, arms, JOB_FIELDS, JOB_CANDIDATES, tiebreak=["l_partkey", "l_suppkey"])
