"""Registered queries: unions, bridges, rules, windows and access over the driver tables.

Operators: U3 A-7 (charges), R8 R9 J12 J13 (crosswalk / unmatched), J8 X16
X25 (status flags), A-5 (conversion), X22 (disposition), X23 F9 F10 (line of
business), J17 (SCD2), A-1 J14 F11 (attachment counts), F6 F7 X9 X10 X19 X24
(zone-aware windows), A1 J15 (row access).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.time import days_until, entity_today, in_window, local_date, local_timestamp, zone_of
from ..operators import access, aggregates, bridge, rules
from ..operators.joins import bounded_broadcast, keep_bound, norm_key_join, range_join, with_counts
from ..operators.union import ArmSpec, stack_arms, stack_observations
from ..sources import seeds
from ..sources.tables import read_leads_window, read_service_window
from .catalog import query, table
from .roles import (
    BRANCHES_SQL,
    INSTANCES_SQL,
    ORDERS_IN_BRANCHES_SQL,
    STATUS_SQL,
    branches,
    norm_sql,
    orders_in_branches,
    status_code,
    status_code_sql,
    values_sql,
)

# --------------------------------------------------------------------- U3 A-7
CHARGES_SQL = """
WITH c AS (
  SELECT l_orderkey, 'estimated' AS charge_kind, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem
  UNION ALL
  SELECT l_orderkey, 'actual' AS charge_kind,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2)
              AS DECIMAL(18,2)) AS amount
  FROM lineitem)
SELECT l_orderkey, charge_kind, count(*) AS n_lines, sum(amount) AS total
FROM c GROUP BY l_orderkey, charge_kind
"""


@query("charges_union", CHARGES_SQL, "U3 A-7")
def charges_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated and actual charges in one table with a discriminator, totalled per order.

    Both kinds are summed in one aggregation of the lines; only the totals are stacked.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    est = F.col("l_extendedprice").cast("decimal(18,2)")
    act = F.round(est * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")), 2).cast("decimal(18,2)")
    sums = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(est).alias("_est"), F.sum(act).alias("_act"))
    kinds = {k: {"n_lines": F.col("n_lines"), "total": F.col(c)} for k, c in (("estimated", "_est"), ("actual", "_act"))}
    return stack_arms(sums, "charge_kind", kinds, keep=["l_orderkey"])


# ------------------------------------------------------------- R8 R9 J12 J13
def _api_arms(spark: SparkSession, sf_dir: str, o: DataFrame | None = None) -> DataFrame:
    """U4: the detail arm (priority 1) and the sweep arm (priority 2) of the crosswalk,
    both emitted from one scan of the orders join (``o``, shared when given)."""
    if o is None:
        o = orders_in_branches(spark, sf_dir, "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    quote = F.when(k % 5 != 0, F.floor(k / 3).cast("string"))
    values = {"quote_number": quote, "opportunity_id": k}
    arms = [
        ArmSpec("api_enrichment", 1, F.col("o_orderdate"), values, when=F.col("o_orderstatus") != "P"),
        ArmSpec("api_sweep", 2, F.col("o_orderdate"), values, when=F.col("o_orderstatus") != "F"),
    ]
    return stack_observations(o, ["source_instance_id"], arms, {"quote_number": "string", "opportunity_id": "bigint"})


CROSSWALK_ARMS_SQL = f"""
WITH o AS ({ORDERS_IN_BRANCHES_SQL}),
arms AS (
  SELECT 'api_enrichment' AS source, 1 AS source_priority, o_orderdate AS observed_at, source_instance_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey // 3 AS VARCHAR) END AS quote_number,
         o_orderkey AS opportunity_id
  FROM o WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT 'api_sweep', 2, o_orderdate, source_instance_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey // 3 AS VARCHAR) END, o_orderkey
  FROM o WHERE o_orderstatus <> 'F'),
xw AS (
  SELECT source_instance_id, quote_number, opportunity_id, source, observed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY source_instance_id, quote_number
                                 ORDER BY observed_at DESC, source_priority ASC, opportunity_id DESC) AS rn
    FROM arms WHERE nullif(trim(quote_number), '') IS NOT NULL) WHERE rn = 1)
"""

CROSSWALK_SQL = CROSSWALK_ARMS_SQL + "SELECT * FROM xw"


@query("crosswalk", CROSSWALK_SQL, "R8 U4 N2 F5")
def crosswalk_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instance, quote) -> opportunity id from the API arms; newest wins, detail breaks ties."""
    return bridge.crosswalk(_api_arms(spark, sf_dir))


UNMATCHED_SQL = (
    CROSSWALK_ARMS_SQL
    + f""",
rpt AS (
  SELECT o.source_instance_id, CAST(o.o_orderkey AS VARCHAR) AS row_key,
         nullif(trim(CASE WHEN o.o_orderkey % 4 = 0 THEN ''
              WHEN o.o_orderpriority = '5-LOW' THEN CAST(o.o_orderkey + 1000000 AS VARCHAR)
              ELSE CAST(o.o_orderkey // 3 AS VARCHAR) END), '') AS quote_number,
         date_trunc('quarter', o.o_orderdate) + INTERVAL 6 HOUR AS report_generated_at
  FROM ({ORDERS_IN_BRANCHES_SQL}) o),
newest AS (
  SELECT r.* FROM rpt r JOIN (SELECT source_instance_id, max(report_generated_at) AS g FROM rpt GROUP BY 1) m
    ON r.source_instance_id = m.source_instance_id AND r.report_generated_at = m.g)
SELECT n.source_instance_id, n.row_key, n.quote_number, n.report_generated_at,
       CASE WHEN n.quote_number IS NULL THEN 'no_quote_number' ELSE 'quote_not_in_api' END AS reason
FROM newest n LEFT JOIN xw ON xw.source_instance_id = n.source_instance_id AND xw.quote_number = n.quote_number
WHERE xw.opportunity_id IS NULL
"""
)


@query("unmatched_reasons", UNMATCHED_SQL, "R9 J12 J13 J5")
def unmatched_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each instance's newest report generation the crosswalk cannot bridge."""
    o = orders_in_branches(spark, sf_dir, "o_orderstatus", "o_orderpriority", "o_orderdate")
    xw = bridge.crosswalk(_api_arms(spark, sf_dir, o))
    k = F.col("o_orderkey")
    quote = (
        F.when(k % 4 == 0, F.lit(""))
        .when(F.col("o_orderpriority") == "5-LOW", (k + 1000000).cast("string"))
        .otherwise(F.floor(k / 3).cast("string"))
    )
    gen = F.date_trunc("quarter", "o_orderdate") + F.expr("INTERVAL 6 HOURS")
    report = o.select(
        "source_instance_id",
        k.cast("string").alias("row_key"),
        quote.alias("quote_number"),
        gen.alias("report_generated_at"),
    )
    return bridge.unmatched(report, xw).select(
        "source_instance_id", "row_key", "quote_number", "report_generated_at", "reason"
    )


# ----------------------------------------------------------- J8 X16 X25 A-5
STATUS_FLAGS_SQL = f"""
WITH o AS (SELECT o_orderkey, {status_code_sql()} AS status_code FROM orders)
SELECT o.o_orderkey, o.status_code,
       coalesce(se.status_name, 'status_' || CAST(o.status_code AS VARCHAR)) AS status_label,
       se.status_category,
       coalesce(se.is_valid_lead, TRUE) AS is_valid_lead,
       coalesce(se.is_booked, FALSE) AS is_booked,
       coalesce(se.is_completed, FALSE) AS is_completed,
       coalesce(se.is_cancelled, FALSE) AS is_cancelled,
       coalesce(se.is_open, FALSE) AS is_open,
       coalesce(se.is_lost, FALSE) AS is_lost,
       coalesce(se.is_bad_lead, FALSE) AS is_bad_lead
FROM o LEFT JOIN {STATUS_SQL} ON o.status_code = se.status_code
"""


def _orders_with_status(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", *cols)
    o = o.withColumn("status_code", status_code())
    return rules.with_status(o, seeds.status_enum(spark))


@query("status_flags", STATUS_FLAGS_SQL, "J8 X16 X25")
def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status label and flags from the enum; unknown code visible, counted valid."""
    return _orders_with_status(spark, sf_dir).select(
        "o_orderkey", "status_code", "status_label", "status_category",
        "is_valid_lead", "is_booked", "is_completed", "is_cancelled", "is_open", "is_lost", "is_bad_lead",
    )


CONVERSION_SQL = f"""
WITH o AS (
  SELECT b.source_instance_id, year(o.o_orderdate) AS order_year, {status_code_sql('o.o_orderstatus', 'o.o_orderpriority')} AS status_code
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN (SELECT n.n_nationkey, i.instance_id AS source_instance_id FROM nation n JOIN {INSTANCES_SQL} ON n.n_regionkey = i.r_regionkey) b
    ON c.c_nationkey = b.n_nationkey),
f AS (
  SELECT o.*, coalesce(se.is_valid_lead, TRUE) AS is_valid_lead, coalesce(se.is_booked, FALSE) AS is_booked
  FROM o LEFT JOIN {STATUS_SQL} ON o.status_code = se.status_code),
g AS (
  SELECT source_instance_id, order_year, count(*) AS n_opportunities,
         count(*) FILTER (WHERE is_valid_lead) AS n_valid,
         count(*) FILTER (WHERE is_booked) AS n_booked
  FROM f GROUP BY 1, 2)
SELECT *, CASE WHEN n_valid = 0 THEN NULL
               ELSE ((2000 * n_booked + n_valid) // (2 * n_valid)) / 10.0 END AS conversion_pct
FROM g
"""


@query("conversion", CONVERSION_SQL, "A-5 F11 J8")
def conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booked / valid leads per instance and year, in percent rounded half-up to 0.1."""
    o = orders_in_branches(spark, sf_dir, "o_orderstatus", "o_orderpriority", "o_orderdate")
    o = o.withColumn("status_code", status_code()).withColumn("order_year", F.year("o_orderdate").cast("bigint"))
    f = rules.with_status(o.select("source_instance_id", "order_year", "status_code"), seeds.status_enum(spark))
    g = f.groupBy("source_instance_id", "order_year").agg(
        F.count(F.lit(1)).alias("n_opportunities"),
        F.count_if("is_valid_lead").alias("n_valid"),
        F.count_if("is_booked").alias("n_booked"),
    )
    return g.withColumn("conversion_pct", aggregates.conversion_pct(F.col("n_booked"), F.col("n_valid")))


DISPOSITION_SQL = f"""
WITH o AS (
  SELECT o_orderkey, {status_code_sql()} AS status_code,
    CASE WHEN {status_code_sql()} = 50 THEN 'spam' END AS bad_lead_reason,
    CASE WHEN {status_code_sql()} = 30 OR o_orderkey % 11 = 0 THEN 'price' END AS lost_reason
  FROM orders)
SELECT o.o_orderkey, o.status_code, o.bad_lead_reason, o.lost_reason,
  CASE WHEN o.bad_lead_reason IS NOT NULL THEN 'Bad Lead'
       WHEN o.lost_reason IS NOT NULL THEN 'Lost'
       WHEN o.status_code = 1 THEN 'In Progress'
       WHEN o.status_code = 0 THEN 'New'
       ELSE coalesce(se.status_name, 'status_' || CAST(o.status_code AS VARCHAR)) END AS lead_disposition
FROM o LEFT JOIN {STATUS_SQL} ON o.status_code = se.status_code
"""


@query("lead_disposition", DISPOSITION_SQL, "X22 X16")
def lead_disposition_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    o = o.withColumn("status_code", status_code())
    o = o.withColumn("bad_lead_reason", F.when(F.col("status_code") == 50, F.lit("spam"))).withColumn(
        "lost_reason",
        F.when((F.col("status_code") == 30) | (F.col("o_orderkey") % 11 == 0), F.lit("price")),
    )
    se = seeds.status_enum(spark)
    enum = bounded_broadcast(keep_bound(se.select("status_code", "status_name"), se), 10_000)
    j = o.join(enum, "status_code", "left")
    disp = rules.lead_disposition(F.col("bad_lead_reason"), F.col("lost_reason"), F.col("status_code"), F.col("status_name"))
    return j.select("o_orderkey", "status_code", "bad_lead_reason", "lost_reason", disp.alias("lead_disposition"))


# ------------------------------------------------------------ X23 F9 F10 J9
LOB_SQL = f"""
WITH j AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CASE l.l_returnflag WHEN 'R' THEN 'Office - COMMERCIAL' WHEN 'A' THEN 'Residential' END AS job_type_name,
         st.service_type_name, b.branch_name, b.source_instance_id, b.lob_hint
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN {values_sql(seeds.SERVICE_TYPES, ['p_type', 'service_type_name'], 'st')} ON st.p_type = p.p_type
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN ({BRANCHES_SQL}) b ON s.s_nationkey = b.n_nationkey),
bm AS (
  SELECT source_instance_id, {norm_sql('branch_name')} AS k, line_of_business
  FROM {values_sql(seeds.LOB_BRANCH, ['source_instance_id', 'branch_name', 'line_of_business'], 'lb')}),
c AS (
  SELECT j.*, bm.line_of_business AS branch_lob,
    coalesce({norm_sql('j.job_type_name')} LIKE '%commercial%', FALSE)
      OR coalesce({norm_sql('j.service_type_name')} LIKE '%commercial%', FALSE) AS is_commercial,
    CASE WHEN j.lob_hint IN ('local', 'long_distance', 'commercial') THEN j.lob_hint END AS hint
  FROM j LEFT JOIN bm ON bm.source_instance_id = j.source_instance_id AND bm.k = {norm_sql('j.branch_name')})
SELECT l_orderkey, l_linenumber,
  CASE WHEN is_commercial THEN 'commercial' WHEN branch_lob IS NOT NULL THEN branch_lob
       WHEN hint IS NOT NULL THEN hint ELSE 'local' END AS line_of_business,
  CASE WHEN is_commercial THEN 'service_type' WHEN branch_lob IS NOT NULL THEN 'branch'
       WHEN hint IS NOT NULL THEN 'instance' ELSE 'fallback_default' END AS lob_source,
  NOT is_commercial AND branch_lob IS NULL AND hint IS NULL AS is_unclassified
FROM c
"""


@query("lob_ladder", LOB_SQL, "X23 F9 F10 J9")
def lob_ladder_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line of business per job with its provenance (service type > branch > instance > default)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    p = table(spark, sf_dir, "part", "p_partkey", "p_type")
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    st = bounded_broadcast(seeds.frame(spark, seeds.SERVICE_TYPES, seeds.SERVICE_TYPES_SCHEMA, unique_on=[0]), 10_000)
    b = branches(spark, sf_dir)
    jobs = (
        li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
        .join(st, "p_type", "left")
        .join(s, li["l_suppkey"] == s["s_suppkey"], "inner")
        .join(b, F.col("s_nationkey") == b["n_nationkey"], "inner")
        .withColumn(
            "job_type_name",
            F.when(F.col("l_returnflag") == "R", F.lit("Office - COMMERCIAL")).when(
                F.col("l_returnflag") == "A", F.lit("Residential")
            ),
        )
        .select("l_orderkey", "l_linenumber", "job_type_name", "service_type_name", "branch_name", "source_instance_id")
    )
    bm = seeds.frame(spark, seeds.LOB_BRANCH, seeds.LOB_BRANCH_SCHEMA)
    inst = seeds.instances(spark)
    out = rules.classify_lob(jobs, bm, inst, "job_type_name", "service_type_name", "branch_name")
    return out.select("l_orderkey", "l_linenumber", "line_of_business", "lob_source", "is_unclassified")


# ------------------------------------------------------------------------ J17
SCD2_SQL = f"""
WITH o AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date, c.c_mktsegment AS segment,
         {norm_sql('c.c_mktsegment')} AS k
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
a AS (
  SELECT {norm_sql('name')} AS k, team, CAST(valid_from AS DATE) AS valid_from, CAST(valid_to AS DATE) AS valid_to
  FROM {values_sql(seeds.ASSIGNMENTS, ['name', 'team', 'valid_from', 'valid_to'], 'asg')})
SELECT o.o_orderkey, o.order_date, o.segment, a.team
FROM o LEFT JOIN a ON a.k = o.k AND o.order_date BETWEEN a.valid_from AND a.valid_to
"""


@query("scd2_assignment", SCD2_SQL, "J17 X1")
def scd2_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The team assigned to an order's segment on the order date (validity intervals)."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("order_date"),
        F.col("c_mktsegment").alias("segment"),
        text.norm_text("c_mktsegment").alias("_k"),
    )
    asg = seeds.assignments(spark)
    iv = keep_bound(asg.select(text.norm_text("name").alias("_k"), "team", "valid_from", "valid_to"), asg)
    out = range_join(oc, iv, "order_date", "valid_from", "valid_to", keys=["_k"], max_rows=100_000)
    return out.select("o_orderkey", "order_date", "segment", "team")


# ----------------------------------------------------------------- A-1 J14
ATTACH_SQL = """
WITH c AS (
  SELECT l_orderkey, count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
         count(*) FILTER (WHERE l_linestatus = 'O') AS n_open
  FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_returned, 0) AS n_returned,
       coalesce(c.n_open, 0) AS n_open
FROM orders o LEFT JOIN c ON c.l_orderkey = o.o_orderkey
"""


@query("attachment_counts", ATTACH_SQL, "A-1 F11 J14")
def attachment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per order, pre-aggregated before the join; absent counts are 0."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus")
    counts = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("n_open"),
    )
    o = table(spark, sf_dir, "orders", "o_orderkey")
    return with_counts(o, counts, ["o_orderkey"], ["n_lines", "n_returned", "n_open"])


# ------------------------------------------------------ F6 F7 X9 X10 X19 X24
UPCOMING_AS_OF = "1998-06-15 03:00:00"
LEADS_AS_OF = "2001-07-31 20:00:00"

ZONED_ORDERS_SQL = f"""
SELECT o.*, coalesce(bz.timezone, o.instance_tz) AS timezone
FROM ({ORDERS_IN_BRANCHES_SQL}) o
LEFT JOIN (SELECT source_instance_id, {norm_sql('branch_name')} AS k, timezone
           FROM {values_sql(seeds.BRANCH_ZONES, ['source_instance_id', 'branch_name', 'timezone'], 'bz0')}) bz
  ON bz.source_instance_id = o.source_instance_id AND bz.k = {norm_sql('o.branch_name')}
"""


def _zoned_orders(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """An order's zone is its branch override, else its instance default."""
    o = orders_in_branches(spark, sf_dir, *cols)
    bz0 = seeds.frame(spark, seeds.BRANCH_ZONES, seeds.BRANCH_ZONES_SCHEMA)
    bz = keep_bound(bz0.withColumnRenamed("timezone", "_bz").withColumnRenamed("branch_name", "_bz_branch"), bz0)
    z = norm_key_join(
        o, bz, "branch_name", "_bz_branch",
        extra_keys=["source_instance_id"], key_name="_bz_key", max_rows=100_000,
    )
    return z.withColumn("timezone", zone_of("_bz", "instance_tz")).drop("_bz", "_bz_key")


UPCOMING_SQL = f"""
WITH z AS ({ZONED_ORDERS_SQL}),
t AS (SELECT o_orderkey, timezone, CAST(o_orderdate AS DATE) AS service_date,
             CAST(timezone(timezone, TIMESTAMPTZ '{UPCOMING_AS_OF}+00') AS DATE) AS today_local FROM z)
SELECT o_orderkey, timezone, service_date, today_local, CAST(service_date - today_local AS INTEGER) AS days_until
FROM t WHERE service_date >= today_local AND service_date < today_local + 11
"""


@query("upcoming_window", UPCOMING_SQL, "F6 X9 X19 X24")
def upcoming_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs in the next 11 local days, "today" evaluated per row in its own zone."""
    z = _zoned_orders(spark, sf_dir, "o_orderdate")
    today = entity_today(UPCOMING_AS_OF, F.col("timezone"))
    t = z.select("o_orderkey", "timezone", F.to_date("o_orderdate").alias("service_date"), today.alias("today_local"))
    return t.filter(in_window("service_date", F.col("today_local"), 11)).withColumn(
        "days_until", days_until("service_date", F.col("today_local"))
    )


SERVICE_WINDOW_DAYS = 30
SERVICE_WINDOW_SQL = f"""
WITH z AS ({ZONED_ORDERS_SQL}),
t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS service_date,
             CAST(timezone(timezone, TIMESTAMPTZ '{UPCOMING_AS_OF}+00') AS DATE) AS today_local FROM z)
SELECT o_orderkey, service_date, CAST(strftime(today_local, '%Y%m%d') AS INTEGER) AS sweep_from,
       CAST(strftime(today_local + {SERVICE_WINDOW_DAYS}, '%Y%m%d') AS INTEGER) AS sweep_to
FROM t WHERE service_date BETWEEN today_local AND today_local + {SERVICE_WINDOW_DAYS}
"""


@query("service_window", SERVICE_WINDOW_SQL, "S5 X9 X18")
def service_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders due within 30 local days, each with the window it was read in."""
    z = _zoned_orders(spark, sf_dir, "o_orderdate").select("o_orderkey", "timezone", F.to_date("o_orderdate").alias("service_date"))
    rows = read_service_window(z, "service_date", UPCOMING_AS_OF, F.col("timezone"), SERVICE_WINDOW_DAYS)
    return rows.select("o_orderkey", "service_date", F.col("_sweep_from").alias("sweep_from"), F.col("_sweep_to").alias("sweep_to"))


LEADS_TODAY_SQL = f"""
WITH z AS ({ZONED_ORDERS_SQL}),
t AS (
  SELECT o_orderkey, timezone,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS created_at
  FROM z),
l AS (
  SELECT *, timezone(timezone, created_at AT TIME ZONE 'UTC') AS created_at_local,
         CAST(timezone(timezone, TIMESTAMPTZ '{LEADS_AS_OF}+00') AS DATE) AS today_local FROM t)
SELECT o_orderkey, timezone, created_at, created_at_local, CAST(created_at_local AS DATE) AS created_date_local
FROM l WHERE CAST(created_at_local AS DATE) = today_local
"""


@query("leads_today", LEADS_TODAY_SQL, "S4 F7 X9 X10 X24")
def leads_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads created today in their own zone, with local timestamp and date."""
    z = _zoned_orders(spark, sf_dir, "o_orderdate")
    k = F.col("o_orderkey")
    created = F.col("o_orderdate") + F.make_interval(hours=(k % 24).cast("int"), mins=(k % 60).cast("int"))
    t = z.select("o_orderkey", "timezone", created.alias("created_at"))
    t = t.withColumn("created_at_local", local_timestamp("created_at", F.col("timezone"))).withColumn(
        "created_date_local", local_date("created_at", F.col("timezone"))
    )
    return read_leads_window(t, "created_at", LEADS_AS_OF, F.col("timezone"))


# -------------------------------------------------------------------- A1 J15
ACCESS_ROLE = "analyst_west"
ACCESS_SQL = f"""
WITH o AS ({ORDERS_IN_BRANCHES_SQL})
SELECT o_orderkey, source_instance_id, entity_id FROM o
WHERE EXISTS (SELECT 1 FROM {values_sql(seeds.ENTITY_ACCESS, ['role_name', 'entity_id'], 'ea')}
              WHERE ea.role_name = '{ACCESS_ROLE}' AND ea.entity_id = o.entity_id)
"""


@query("entity_access", ACCESS_SQL, "A1 J15")
def entity_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows one role may see (semi join with the role's tenants)."""
    o = orders_in_branches(spark, sf_dir).select("o_orderkey", "source_instance_id", "entity_id")
    acc = seeds.frame(spark, seeds.ENTITY_ACCESS, seeds.ENTITY_ACCESS_SCHEMA)
    return access.secure_view(o, acc, ACCESS_ROLE)


# ------------------------------------------------------------- tier-2 rules
# A rule table - (priority, field, match type, match value, category).
PART_RULES = [
    (1, "p_name", "contains", "Ring", "jewelry"),
    (1, "p_type", "equals", "PROMO", "promotional"),
    (2, "p_name", "contains", "bolt", "hardware"),
    (2, "p_brand", "contains", "Brand#1", "house_brand"),
    (99, "p_type", "default", "*", "general"),
]


def _rules_sql() -> str:
    arms = []
    for i, (_p, fld, mtype, mval, cat) in sorted(enumerate(PART_RULES), key=lambda x: (x[1][0], x[0])):
        if mtype == "default":
            continue
        needle = norm_sql(f"'{mval}'")
        hay = norm_sql(fld)
        cond = f"{hay} LIKE '%' || {needle} || '%'" if mtype == "contains" else f"{hay} = {needle}"
        arms.append(f"WHEN coalesce({cond}, FALSE) THEN '{cat}'")
    default = next(c for (_p, _f, m, _v, c) in PART_RULES if m == "default")
    return f"SELECT p_partkey, CASE {' '.join(arms)} ELSE '{default}' END AS category FROM part"


@query("rule_table_classify", _rules_sql(), "X23 F9 tier-2 rule engine")
def rule_table_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify parts by a priority-ordered rule table (contains / equals / default)."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    return rules.rule_engine(p, PART_RULES).select("p_partkey", "category")
