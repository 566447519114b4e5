"""Registered queries that run single operators over the driver tables.

Sources and stamps (S3-S7, S12, X15), keys and hashes (X6, X14, X20, C1, C2,
C11), joins (J10, R10), publication (A2, A3), quarantine (W5) and the ordered
scan. Each calls the library's operator; nothing is re-implemented here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import rpt_bool
from ..functions.text import compact_stamp, surrogate_key
from ..operators import access, bridge, change, merge, sequence
from ..operators.joins import bounded_broadcast, keep_bound
from ..sources import seeds
from ..sources.tables import attach_tenant, read_detail, read_window, spread, stamp
from . import all_jobs, crm
from .catalog import query, table
from .roles import INSTANCES_SQL, ORDERS_IN_BRANCHES_SQL, orders_in_branches, values_sql

WINDOW_SQL = f"""
SELECT o.o_orderkey, o.o_orderdate, o.source_instance_id, i.entity_id, '19980702063000' AS extracted_stamp
FROM ({ORDERS_IN_BRANCHES_SQL}) o LEFT JOIN {INSTANCES_SQL} ON i.instance_id = o.source_instance_id
WHERE o.o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-06-30'
"""


@query("window_stamp", WINDOW_SQL, "S3 S4 S5 X15")
def window_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one business window, stamped with instance, tenant and the run's instant."""
    o = orders_in_branches(spark, sf_dir, "o_orderdate").select("o_orderkey", "o_orderdate", "source_instance_id")
    rows = read_window(o, "o_orderdate", dt.datetime(1998, 1, 1), dt.datetime(1998, 6, 30))
    rows = stamp(rows, F.col("source_instance_id"), "1998-07-02 06:30:00")
    rows = attach_tenant(rows, seeds.instances(spark))
    return rows.select(
        "o_orderkey", "o_orderdate", "source_instance_id", "entity_id", compact_stamp("_extracted_at").alias("extracted_stamp")
    )


DETAIL_SQL = """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
"""


@query("detail_by_id", DETAIL_SQL, "S6")
def detail_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows of an explicit id list: the lines of partly open orders."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    ids = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").filter("o_orderstatus = 'P'")
    return read_detail(li, ids.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])


UPSERT_SQL = """
WITH t AS (SELECT 'n' || (c_nationkey % 5) AS source_instance_id, c_custkey AS id, c_mktsegment AS name, 0 AS version FROM customer),
b AS (
  SELECT source_instance_id, id, name || ' v1' AS name, 1 AS version FROM t WHERE name = 'BUILDING'
  UNION ALL SELECT source_instance_id, id, name || ' v2', 2 FROM t WHERE name = 'BUILDING'
  UNION ALL SELECT source_instance_id, id + 100000000, name || ' new', 1 FROM t WHERE name = 'MACHINERY'),
w AS (SELECT source_instance_id, id, arg_max(name, version) AS name, max(version) AS version FROM b GROUP BY 1, 2)
SELECT * FROM w UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.source_instance_id = t.source_instance_id AND w.id = t.id)
"""


@query("upsert_dimension", UPSERT_SQL, "S7 S12")
def upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a reference list: changed rows in two versions, and new ones."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    inst = F.concat(F.lit("n"), (F.col("c_nationkey") % 5).cast("string"))
    t = c.select(
        inst.alias("source_instance_id"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), F.lit(0).alias("version")
    )
    versions = t.filter("name = 'BUILDING'").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    versions = versions.withColumn("name", F.concat_ws(" v", "name", F.col("version").cast("string")))
    new = t.filter("name = 'MACHINERY'").select(
        "source_instance_id", (F.col("id") + 100_000_000).alias("id"), F.concat("name", F.lit(" new")).alias("name"), F.lit(1).alias("version")
    )
    return merge.upsert(t, versions.unionByName(new), ["source_instance_id", "id"], order=["version"])


CHILDREN_SQL = """
WITH p AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM p)
UNION ALL SELECT k, 1, 'only' FROM p
"""


@query("replace_children", CHILDREN_SQL, "S12")
def replace_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every urgent order's lines give way to one new line."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").filter("o_orderpriority = '1-URGENT'")
    kind = li.schema["l_linenumber"].dataType
    batch = o.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).cast(kind).alias("l_linenumber"), F.lit("only").alias("l_returnflag"))
    return merge.replace_children(li, batch.distinct(), ["l_orderkey"])


BOOL_SQL = """
WITH t AS (SELECT CASE l_returnflag WHEN 'A' THEN ' Yes' WHEN 'N' THEN '0' ELSE 'maybe' END AS t FROM lineitem)
SELECT CASE WHEN lower(trim(t)) IN ('1', 'true', 'yes', 'y') THEN TRUE WHEN lower(trim(t)) IN ('0', 'false', 'no', 'n') THEN FALSE END AS flag,
       count(*) AS n FROM t GROUP BY 1
"""


@query("rpt_bool", BOOL_SQL, "X6")
def rpt_bool_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    text = F.when(flag == "A", " Yes").when(flag == "N", "0").otherwise("maybe")
    li = table(spark, sf_dir, "lineitem", "l_returnflag")
    return li.select(rpt_bool(text).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


KEY_SQL = """
SELECT o_orderkey, o_orderstatus || ':' || nullif(o_orderpriority, '5-LOW') || ':' || o_orderkey AS key FROM orders
"""


@query("surrogate_key", KEY_SQL, "X14")
def surrogate_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of three parts, null where a part is null."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    part = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return o.select("o_orderkey", surrogate_key("o_orderstatus", part, "o_orderkey").alias("key"))


SWEEP_SQL = """
WITH j AS (
  SELECT l_orderkey, list_sort(list(l_linenumber::VARCHAR || l_returnflag)) AS jobs,
         min(CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT)) AS lo, max(CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT)) AS hi
  FROM lineitem GROUP BY 1)
SELECT o_orderkey,
       sha1('{"jobs":["' || array_to_string(jobs, '","') || '"],"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}') AS h,
       least(lo, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT)) AS sd, greatest(hi, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT)) AS sdx
FROM orders JOIN j ON l_orderkey = o_orderkey
"""


@query("sweep_hash_span", SWEEP_SQL, "X20 C1 C2")
def sweep_hash_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content hash and service span of every order with its lines (in any order)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    jobs = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(F.concat(F.col("l_linenumber").cast("string"), "l_returnflag")).alias("jobs"),
        F.collect_list(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("dates"),
    )
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate").join(jobs, "o_orderkey")
    sd, sdx = change.service_span(F.to_date("o_orderdate"), F.col("dates"))
    return o.select("o_orderkey", change.sweep_hash(["o_orderstatus", "o_orderpriority"], "jobs").alias("h"), sd.alias("sd"), sdx.alias("sdx"))


MIGRATE_SQL = """
SELECT o_orderkey, sha1(o_orderstatus) AS h, TIMESTAMP '1998-06-15 12:00:00' AS t, CAST(NULL AS TIMESTAMP) AS seen, CAST(NULL AS BIGINT) AS sd,
       CAST(NULL AS BIGINT) AS sdx, CAST(NULL AS VARCHAR) AS ls, CAST(NULL AS TIMESTAMP) AS gone, CAST(NULL AS BOOLEAN) AS gp,
       CAST(NULL AS BOOLEAN) AS g404 FROM orders
"""


@query("migrate_legacy", MIGRATE_SQL, "C11")
def migrate_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old ``id -> hash`` layout as state rows."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return change.migrate_legacy(o.select("o_orderkey", F.sha1("o_orderstatus").alias("h")), ["o_orderkey"], "1998-06-15 12:00:00")


TARGETED_SQL = f"""
WITH s AS (
  SELECT o_orderkey, o_orderstatus = 'F' AS ok, o_orderstatus = 'P' AS missing, o_orderpriority AS ls,
         CASE WHEN o_orderpriority = '5-LOW' THEN TIMESTAMP '1998-06-01' END AS gone FROM orders)
SELECT o_orderkey,
       CASE WHEN ok THEN TIMESTAMP '1998-06-15 12:00:00' END AS t,
       CASE WHEN missing THEN TIMESTAMP '1998-06-15 12:00:00' WHEN NOT ok THEN gone END AS gone,
       CASE WHEN missing THEN TRUE END AS g404, CASE WHEN ok THEN ls END AS ls FROM s
"""


@query("targeted_details", TARGETED_SQL, "C6 C7 S6")
def targeted_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details read by id, without a sweep: a 404 marks at once, a success clears the marker."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    null = lambda kind: F.lit(None).cast(kind)
    gone = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("1998-06-01 00:00:00").cast("timestamp"))
    state = o.select(
        "o_orderkey", F.lit("h").alias("h"), null("timestamp").alias("t"), null("timestamp").alias("seen"), null("bigint").alias("sd"),
        null("bigint").alias("sdx"), null("string").alias("ls"), gone.alias("gone"), null("boolean").alias("gp"), null("boolean").alias("g404"),
    )
    details = o.select(
        "o_orderkey", (F.col("o_orderstatus") == "F").alias("ok"), (F.col("o_orderstatus") == "P").alias("missing"), F.col("o_orderpriority").alias("ls")
    )
    swept = state.select("o_orderkey", "h", "sd", "sdx", null("string").alias("reason")).filter(F.lit(False))
    new = change.fold_state(state, swept, details.filter(F.lit(False)), ["o_orderkey"], "1998-06-15 12:00:00", targeted=details)
    return new.select("o_orderkey", "t", "gone", "g404", "ls")


CHARGES_SQL = """
SELECT l.l_orderkey || '' AS opportunity_key, l.l_linenumber AS line, o.o_orderpriority AS entity_id
FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o.o_orderkey = l.l_orderkey
"""


@query("charges_left", CHARGES_SQL, "J10")
def charges_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge lines keep their rows where the core has no opportunity."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    charges = li.select(F.col("l_orderkey").cast("string").alias(crm.OPP_KEY), F.col("l_linenumber").alias("line"))
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate").filter("o_orderstatus = 'F'")
    core = o.select(
        F.col("o_orderkey").cast("string").alias(crm.OPP_KEY), F.col("o_orderpriority").alias("entity_id"),
        F.col("o_orderstatus").alias("source_instance_id"), F.col("o_orderdate").alias("synced_at"),
    )
    return crm.core_opportunity_charges(charges, core).select(F.col(crm.OPP_KEY).alias("opportunity_key"), "line", "entity_id")


ATTRIBUTION_SQL = """
SELECT l_orderkey AS o_orderkey, arg_max(l_suppkey, (l_shipdate, l_linenumber, l_suppkey)) AS estimator, max(l_shipdate) AS observed_at
FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1
"""


@query("recover_attribution", ATTRIBUTION_SQL, "R10 J6 N4")
def recover_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job report rows bridged to their opportunity; the newest row gives the estimator."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    job = surrogate_key("l_orderkey", "l_linenumber").alias("job_key")
    rows = li.select(job, F.col("l_suppkey").alias("estimator"), F.col("l_shipdate").alias("observed_at"), "l_linenumber")
    api = li.filter("l_linenumber <= 3").select(job, F.col("l_orderkey").alias("o_orderkey"))
    got = bridge.recover_attribution(rows, api, "job_key", ["o_orderkey"], "observed_at", ["estimator"], tiebreak=["l_linenumber", "estimator"])
    return got.select("o_orderkey", "estimator", "observed_at")


PUBLISH_SQL = f"""
WITH a AS (SELECT entity_id FROM {values_sql(seeds.ENTITY_ACCESS, ["role_name", "entity_id"], "a")} WHERE role_name = 'analyst_west'),
o AS ({ORDERS_IN_BRANCHES_SQL})
SELECT t AS published, o.entity_id, count(*) AS n FROM o JOIN a USING (entity_id), (VALUES ('core.orders'), ('serving.open_orders')) v(t)
WHERE t = 'core.orders' OR o_orderstatus = 'O' GROUP BY 1, 2
"""


@query("publish_for_role", PUBLISH_SQL, "A2 A3")
def publish_for_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one role sees: tenant rows of consumer layers only, no staging, no control table."""
    o = orders_in_branches(spark, sf_dir, "o_orderstatus").select("o_orderkey", "o_orderstatus", "entity_id")
    allowed = spark.createDataFrame(seeds.ENTITY_ACCESS, seeds.ENTITY_ACCESS_SCHEMA)
    tables = {
        "orders": ("core", o), "open_orders": ("serving", o.filter("o_orderstatus = 'O'")), "raw": ("staging", o),
        "untenanted": ("core", o.drop("entity_id")), "entity_access": ("core", allowed),
    }
    out = None
    for name, df in sorted(access.publish_for_role(tables, allowed, "analyst_west").items()):
        part = df.groupBy(F.lit(name).alias("published"), "entity_id").agg(F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


QUARANTINE_SQL = """
SELECT DISTINCT l_orderkey AS message_id, l_returnflag AS error FROM lineitem WHERE l_returnflag IN ('A', 'R')
"""


@query("quarantine_append", QUARANTINE_SQL, "W5")
def quarantine_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects appended twice: the second, larger batch adds only what is new."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag").select(
        F.col("l_orderkey").alias("message_id"), F.col("l_returnflag").alias("error")
    )
    first = merge.append_unique(li.filter(F.lit(False)), li.filter("error = 'A'"), ["message_id", "error"])
    return merge.append_unique(first, li.filter("error in ('A', 'R')"), ["message_id", "error"])


PREVIOUS_SQL = """
SELECT event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events
"""


@query("previous_event", PREVIOUS_SQL, "N1 E2")
def previous_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's previous event of the same user, by the skew-safe ordered scan."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    return sequence.previous_in_key(e, ["user_id"], "ts", ["event_id"]).select("event_id", "prev_ts")


ALL_JOBS_SQL = f"""
WITH r AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS job, l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_returnflag, l_quantity, i.instance_id
  FROM lineitem JOIN {INSTANCES_SQL} ON i.r_regionkey = l_orderkey % 5),
w AS (SELECT *, row_number() OVER (PARTITION BY instance_id, job ORDER BY l_shipdate DESC, l_extendedprice DESC, l_quantity DESC, l_returnflag DESC) AS k FROM r)
SELECT instance_id || ':' || job AS job_key, CAST(l_orderkey AS VARCHAR) AS quote_number, CAST(l_shipdate AS DATE) AS service_date_local,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS total_actual_cost, CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'N' THEN FALSE END AS move_date_is_tbd,
       CAST(l_quantity AS DECIMAL(18,4)) AS volume_cuft, l_shipdate + INTERVAL 15 HOUR AS start_at_utc, CAST(NULL AS VARCHAR) AS crew_member_names
FROM w WHERE k = 1
"""


@query("report_all_jobs", ALL_JOBS_SQL, "X2 X4 X5 X6 X8 X13 X14 N2")
def report_all_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items rendered as rows of the all-jobs report, typed, newest row of each job."""
    li = spread(table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_returnflag", "l_quantity"
    ))
    # five keys: a shuffled join would put the whole report into five tasks
    inst = seeds.instances(spark)
    inst = bounded_broadcast(keep_bound(inst.select("r_regionkey", "instance_id", "entity_id"), inst), 100_000)
    li = li.join(inst, F.col("l_orderkey") % 5 == F.col("r_regionkey"))
    flag = F.col("l_returnflag")
    job = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    cents = F.col("l_extendedprice").cast("decimal(18,2)")
    cells = F.create_map(
        F.lit("Job Id"), job,
        F.lit("Job Number"), job,
        F.lit("Job Date"), F.date_format("l_shipdate", "M/d/yyyy"),
        F.lit("Total Actual Cost"), F.concat(F.lit("$"), cents.cast("string")),
        F.lit("Move Date Is TBD"), F.when(flag == "A", "Yes").when(flag == "N", "no").otherwise("--"),
        F.lit("Volume"), F.concat(F.col("l_quantity").cast("decimal(18,4)").cast("string"), F.lit(" cuft / 9 lbs")),
        F.lit("Start Time Utc"), F.concat(F.date_format("l_shipdate", "M/d/yyyy"), F.lit(" 8:00:00 AM -07:00")),
    )
    # the newest row of a job: by ship date, then by a rendering that sorts like the oracle's order
    order = F.concat_ws("|", F.lpad(cents.cast("string"), 20, "0"), F.lpad(F.col("l_quantity").cast("decimal(18,4)").cast("string"), 20, "0"), flag)
    report = li.select(
        F.col("instance_id").alias("source_instance_id"), "entity_id", F.col("l_shipdate").alias("report_generated_at"), job.alias("row_key"),
        F.to_json(F.map_concat(F.create_map(F.lit("_order"), order), cells)).alias("row_data"),
    )
    latest = all_jobs.int_report_all_jobs_latest(report)
    return latest.select(
        "job_key", "quote_number", "service_date_local", "total_actual_cost", "move_date_is_tbd", "volume_cuft", "start_at_utc", "crew_member_names"
    )
