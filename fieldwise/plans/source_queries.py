"""Registered queries: sources and nested data (S2, S14, X26, R11, A-6, J2, N5, F3).

* ``report_manifest``: one delivery mail per (instance, report generation)
  of the orders report, rendered from the landed counts, with planted
  problems (unknown alias, missing link, unknown file, bad date header).
* ``contact_addresses``: e-mail addresses in every whole document.
* ``webhook_status_latest`` / ``status_counts``: the status ledger from the
  event feed only, labelled, and live counts by label.
* ``flatten_children`` / ``flatten_job_charges``: arrays as child tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import has_key, json_int
from ..functions.text import addresses
from ..operators import rules
from ..operators.resolve import latest_by_source
from ..sources import seeds
from ..sources.nested import flatten, grandchildren
from ..sources import reports
from ..sources.reports import report_manifest
from .catalog import query, table
from .roles import ORDERS_IN_BRANCHES_SQL, STATUS_SQL, orders_in_branches

# Recipient alias -> (instance, tenant) for the driver-table roles.
MAIL_ALIASES = {
    "africa.reports@example.com": ("africa", "south_co"),
    "america.reports@example.com": ("america", "west_co"),
    "asia.reports@example.com": ("asia", "east_co"),
    "europe.reports@example.com": ("europe", "west_co"),
}


def delivery_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mail per (instance, quarterly generation), body stating the row count."""
    o = orders_in_branches(spark, sf_dir, "o_orderdate")
    gen = F.date_trunc("quarter", "o_orderdate") + F.expr("INTERVAL 6 HOURS")
    g = o.groupBy("source_instance_id", gen.alias("g")).agg(F.count(F.lit(1)).alias("n"))
    inst, year = F.col("source_instance_id"), F.year("g")
    stamp = F.date_format("g", "yyyyMMddHH")
    file_name = F.when((inst == "asia") & (year == 1997), F.concat(F.lit("summary-"), stamp, F.lit(".xlsx"))).otherwise(
        F.concat(F.lit("Lead-Status-"), stamp, F.lit(".xlsx"))
    )
    link = F.concat(F.lit(" https://app.example.com/report-exports/"), file_name)
    body = F.concat(
        F.lit("Your Lead Status report, containing "),
        F.format_number(F.col("n"), 0),
        F.lit(" records, is ready to download."),
        F.when(year == 1996, F.lit("")).otherwise(link),
    )
    alias = F.concat(inst, F.lit(".reports@example.com"))
    date_header = F.when((inst == "africa") & (year == 2000), F.lit("Date: soon")).otherwise(
        F.concat(F.lit("Date: "), F.date_format("g", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    )
    return g.select(
        F.concat(inst, F.lit("-"), stamp).alias("message_id"),
        F.concat(F.lit("Delivered-To: "), alias).alias("delivered_to"),
        F.upper(alias).alias("to_header"),
        F.lit("Ops <ops@example.com>").alias("cc"),
        body.alias("body"),
        F.concat(F.lit("Report for "), inst).alias("subject"),
        F.lit("reports@crm.example.com").alias("sender"),
        date_header.alias("date_header"),
    )


MANIFEST_SQL = f"""
WITH g AS (
  SELECT source_instance_id, date_trunc('quarter', o_orderdate) + INTERVAL 6 HOUR AS g, count(*) AS n
  FROM ({ORDERS_IN_BRANCHES_SQL}) GROUP BY 1, 2),
m AS (
  SELECT *, source_instance_id || '.reports@example.com' AS alias, strftime(g, '%Y%m%d%H') AS stamp,
         source_instance_id <> 'middle_east' AS known_alias,
         year(g) <> 1996 AS has_link,
         NOT (source_instance_id = 'asia' AND year(g) = 1997) AS known_file,
         NOT (source_instance_id = 'africa' AND year(g) = 2000) AS good_date
  FROM g),
e AS (
  SELECT *, CASE WHEN known_file THEN 'lead-status-' ELSE 'summary-' END || stamp || '.xlsx' AS fname,
    list_filter([
      CASE WHEN NOT known_alias THEN 'no known alias among the recipients: ' || alias || ', ops@example.com' END,
      CASE WHEN NOT has_link THEN 'body holds no report link' END,
      CASE WHEN NOT has_link THEN 'file name fits no report type: -'
           WHEN NOT known_file THEN 'file name fits no report type: summary-' || stamp || '.xlsx' END,
      CASE WHEN NOT good_date THEN 'no usable date header' END], lambda x: x IS NOT NULL) AS errs
  FROM m)
SELECT len(errs) = 0 AS is_valid, nullif(array_to_string(errs, ' | '), '') AS error,
  CASE WHEN known_alias THEN alias END AS matched_alias,
  CASE WHEN known_alias THEN source_instance_id END AS source_instance_id,
  CASE WHEN known_alias THEN CASE source_instance_id WHEN 'africa' THEN 'south_co' WHEN 'america' THEN 'west_co'
       WHEN 'asia' THEN 'east_co' WHEN 'europe' THEN 'west_co' END END AS entity_id,
  CASE WHEN has_link AND known_file THEN 'lead_status' END AS report_type,
  CASE WHEN has_link AND known_file THEN 'report_lead_status' END AS target_table,
  CASE WHEN has_link AND known_file THEN 'Quote #' END AS row_key_field,
  CASE WHEN good_date THEN g END AS report_generated_at,
  CAST(n AS INTEGER) AS expected_records,
  CASE WHEN has_link THEN fname END AS file_name,
  CASE WHEN has_link THEN 'https://app.example.com/report-exports/' || CASE WHEN known_file THEN 'Lead-Status-' ELSE 'summary-' END || stamp || '.xlsx' END AS download_url,
  'Report for ' || source_instance_id AS subject, 'reports@crm.example.com' AS sender,
  source_instance_id || '-' || stamp AS message_id,
  alias || ', ops@example.com' AS to_address
FROM e
"""


@query("report_manifest", MANIFEST_SQL, "S14 X26 W5")
def report_manifest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delivery attributed to instance and report type, or every problem listed."""
    mails = delivery_mails(spark, sf_dir)
    return report_manifest(mails, MAIL_ALIASES, ["delivered_to", "to_header", "cc"], carry=["subject", "sender"])


ADDR = r"""[^\s<>,;"]+@[^\s<>,;"]+"""
ADDRESSES_SQL = f"""
WITH a AS (SELECT doc_id, regexp_extract_all(lower(text), '{ADDR}') AS l FROM documents),
d AS (SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM a)
SELECT doc_id, nullif(array_to_string(l, ', '), '') AS to_address, CAST(len(l) AS INTEGER) AS n_addresses FROM d
"""


@query("contact_addresses", ADDRESSES_SQL, "X26")
def contact_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail addresses in each whole document, lower-cased, first-seen order, deduplicated."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("_a", addresses("text"))
    return d.select(
        "doc_id", F.nullif(F.array_join("_a", ", "), F.lit("")).alias("to_address"), F.size("_a").alias("n_addresses")
    )


# Status code carried by a status event, by the payload's k mod 10.
STATUS_OF_K = [0, 1, 3, 4, 10, 11, 20, 30, 50, 77]
STATUS_EVENT_TYPES = ["signup", "purchase", "error"]


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events: allowlisted types whose payload carries the status key."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    e = e.filter(F.col("event_type").isin(STATUS_EVENT_TYPES) & has_key("props", "k"))
    code = F.element_at(F.array(*[F.lit(c) for c in STATUS_OF_K]), (json_int("props", "k") % 10 + 1).cast("int"))
    return e.select(
        "user_id", F.lit("webhook").alias("source"), "event_id", F.col("ts").alias("observed_at"), code.alias("status_code")
    )


STATUS_LATEST_SQL = f"""
WITH e AS (
  SELECT user_id, event_id, ts AS observed_at,
         [{', '.join(str(c) for c in STATUS_OF_K)}][CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 + 1] AS status_code
  FROM events WHERE event_type IN ({', '.join(repr(t) for t in STATUS_EVENT_TYPES)}) AND json_exists(props, '$.k')),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY observed_at DESC NULLS FIRST, event_id DESC) AS rn
                     FROM e) WHERE rn = 1)
SELECT l.user_id, l.status_code, l.observed_at,
       coalesce(se.status_name, 'status_' || CAST(l.status_code AS VARCHAR)) AS status_label
FROM l LEFT JOIN {STATUS_SQL} ON se.status_code = l.status_code
"""


def _status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_by_source(status_events(spark, sf_dir), ["user_id"], priority=None, tiebreak=["event_id"])
    labelled = rules.with_status(latest.select("user_id", "status_code", "observed_at"), seeds.status_enum(spark))
    return labelled.select("user_id", "status_code", "observed_at", "status_label")


@query("webhook_status_latest", STATUS_LATEST_SQL, "R11 E5 F3 X12 J8 X16")
def webhook_status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest status per resource from the event feed only, labelled."""
    return _status_latest(spark, sf_dir)


STATUS_COUNTS_SQL = f"""
WITH s AS ({STATUS_LATEST_SQL})
SELECT status_label, count(*) AS n FROM s GROUP BY 1
"""


@query("status_counts", STATUS_COUNTS_SQL, "A-6")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts by status label."""
    return _status_latest(spark, sf_dir).groupBy("status_label").agg(F.count(F.lit(1)).alias("n"))


FLATTEN_SQL = """
SELECT vec_id AS _parent_vec_id, unnest(generate_series(0, len(embedding) - 1)) AS _list_idx,
       CAST(len(embedding) AS INTEGER) AS _n_siblings, unnest(embedding) AS value
FROM embeddings
"""


@query("flatten_children", FLATTEN_SQL, "S2 N5")
def flatten_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array column as a child table with parent key, position and sibling count."""
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return flatten(e, "embedding", ["vec_id"])


GRANDCHILD_SQL = """
SELECT o_orderkey, o_orderkey AS job_o_orderkey, CAST(j.i - 1 AS BIGINT) AS job_idx,
       CAST(c.jj - 1 AS BIGINT) AS _list_idx, CAST(j.i AS INTEGER) AS _n_siblings,
       CAST(c.jj AS INTEGER) AS line,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * c.jj * 0.1, 2) AS DECIMAL(18,2)) AS amount
FROM orders, range(1, CAST(2 + o_orderkey % 3 AS BIGINT)) j(i), range(1, j.i + 1) c(jj)
"""


@query("flatten_job_charges", GRANDCHILD_SQL, "S2 J1 J2 N5")
def flatten_job_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order -> jobs -> charges: a two-level payload (derived per order) as a charge table."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    dec = F.col("o_totalprice").cast("decimal(18,2)")
    jobs = F.transform(
        F.sequence(F.lit(1), (F.col("o_orderkey") % 3 + 1).cast("int")),
        lambda i: F.struct(
            i.alias("job_seq"),
            F.transform(
                F.sequence(F.lit(1), i),
                lambda j: F.struct(j.alias("line"), F.round(dec * j * F.lit(Decimal("0.1")), 2).cast("decimal(18,2)").alias("amount")),
            ).alias("charges"),
        ),
    )
    nested = o.select("o_orderkey", jobs.alias("jobs"))
    kids = grandchildren(nested, "jobs", "charges", ["o_orderkey"])
    return kids.select(
        F.col("_root_o_orderkey").alias("o_orderkey"),
        F.col("_parent_job_o_orderkey").alias("job_o_orderkey"),
        F.col("_parent_job_idx").alias("job_idx"),
        "_list_idx",
        "_n_siblings",
        "line",
        "amount",
    )


LANDING_SQL = """
WITH r AS (
  SELECT CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS k,
         '{"Quote #":"' || CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END || '","Return Flag":"' || l_returnflag || '"}' AS row_data
  FROM lineitem),
landed AS (SELECT k, min(row_data) AS row_data, 'landed' AS outcome, 1 AS copies FROM r WHERE k <> '' GROUP BY k),
again AS (
  SELECT r.k, r.row_data, 'repeated_key' AS outcome, count(*) - CASE WHEN r.row_data = l.row_data THEN 1 ELSE 0 END AS copies
  FROM r JOIN landed l ON l.k = r.k GROUP BY r.k, r.row_data, l.row_data)
SELECT k AS row_key, row_data, outcome, CAST(copies AS BIGINT) AS copies FROM landed
UNION ALL SELECT k, row_data, outcome, CAST(copies AS BIGINT) FROM again WHERE copies > 0
UNION ALL SELECT NULL, row_data, 'blank_key', count(*) FROM r WHERE k = '' GROUP BY row_data
"""


@query("land_report", LANDING_SQL, "S9 S10 W5")
def land_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as report rows keyed by order: one row a key lands, the rest is quarantined with its reason."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    key = F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(F.col("l_orderkey").cast("string"))
    rows = li.select(F.create_map(F.lit("Quote #"), key, F.lit("Return Flag"), F.col("l_returnflag")).alias("row"))
    landed, bad = reports.split_landing(rows, "i1", "1998-08-01 06:00:00", "Quote #", ["Quote #", "Return Flag"])
    return landed.select("row_key", "row_data", F.lit("landed").alias("outcome"), F.lit(1).cast("bigint").alias("copies")).unionByName(
        bad.select("row_key", "row_data", F.col("reason").alias("outcome"), F.col("copies").cast("bigint"))
    )
