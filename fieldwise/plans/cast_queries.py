"""Registered queries: typing of text report cells.

Each query renders real columns of the driver tables as report text (the way
a vendor export prints them), plants the vendor's sentinels and malformed
cells by a fixed rule on the row key, and parses the text back with the
engine's casts. The oracle computes the expected typed value straight from
the source column under the same rule, so a parser bug shows up as a value
mismatch on the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts, text
from ..functions.json import has_key, json_field, json_int, json_struct
from ..operators.joins import bounded_broadcast, keep_bound
from ..sources import seeds
from .catalog import query, table

RPT_DATE_SQL = """
SELECT o_orderkey,
  CASE o_orderkey % 7
    WHEN 0 THEN '0/0/0'
    WHEN 1 THEN ''
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 3 THEN '2/31/' || strftime(o_orderdate, '%Y')
    ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS cell,
  CASE WHEN o_orderkey % 7 IN (0, 1, 3) THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed
FROM orders
"""


@query("rpt_date_roundtrip", RPT_DATE_SQL, "X2")
def rpt_date_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    m = F.col("o_orderkey") % 7
    cell = (
        F.when(m == 0, F.lit("0/0/0"))
        .when(m == 1, F.lit(""))
        .when(m == 2, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(m == 3, F.concat(F.lit("2/31/"), F.date_format("o_orderdate", "yyyy")))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    )
    return o.select("o_orderkey", cell.alias("cell")).withColumn("parsed", casts.rpt_date("cell"))


RPT_NUM_SQL = """
WITH r AS (
  SELECT o_orderkey, o_totalprice, '$' || format('{:,.2f}', o_totalprice) AS money,
         format('{:.2f}', o_totalprice) AS plain FROM orders)
SELECT o_orderkey,
  CASE o_orderkey % 5
    WHEN 0 THEN '--'
    WHEN 1 THEN ''
    WHEN 2 THEN ' ' || plain || ' '
    WHEN 3 THEN '(' || plain || ')'
    ELSE money END AS cell,
  CASE WHEN o_orderkey % 5 IN (0, 1, 3) THEN NULL
       ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
FROM r
"""


@query("rpt_num_roundtrip", RPT_NUM_SQL, "X5")
def rpt_num_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    m = F.col("o_orderkey") % 5
    dec = F.col("o_totalprice").cast("decimal(18,2)")
    plain = dec.cast("string")
    money = F.concat(F.lit("$"), F.format_number(dec, 2))
    cell = (
        F.when(m == 0, F.lit("--"))
        .when(m == 1, F.lit(""))
        .when(m == 2, F.concat(F.lit(" "), plain, F.lit(" ")))
        .when(m == 3, F.concat(F.lit("("), plain, F.lit(")")))
        .otherwise(money)
    )
    return o.select("o_orderkey", cell.alias("cell")).withColumn("amount", casts.rpt_num("cell"))


RPT_MINUTES_SQL = """
WITH d AS (
  SELECT l_orderkey, l_linenumber,
         CAST(l_quantity AS BIGINT) * 53 + l_linenumber AS total,
         l_returnflag = 'R' AS neg FROM lineitem),
t AS (
  SELECT *, total // 1440 AS dd, (total % 1440) // 60 AS hh, total % 60 AS mm FROM d),
c AS (
  SELECT l_orderkey, l_linenumber, total, neg,
    CASE l_orderkey % 9
      WHEN 0 THEN '--'
      WHEN 1 THEN ''
      WHEN 2 THEN CAST(total AS VARCHAR)
      ELSE (CASE WHEN neg THEN '-' ELSE '' END) ||
           concat_ws(' ', CASE WHEN dd > 0 THEN dd || 'd' END,
                          CASE WHEN hh > 0 THEN hh || 'h' END,
                          CASE WHEN mm > 0 THEN mm || 'm' END) END AS cell
  FROM t)
SELECT l_orderkey, l_linenumber, cell,
  CASE WHEN l_orderkey % 9 IN (0, 1, 2) THEN NULL
       ELSE CAST(CASE WHEN neg THEN -total ELSE total END AS INTEGER) END AS minutes
FROM c
"""


@query("rpt_minutes", RPT_MINUTES_SQL, "X7")
def rpt_minutes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    total = F.col("l_quantity").cast("bigint") * 53 + F.col("l_linenumber")
    dd, hh, mm = F.floor(total / 1440), F.floor((total % 1440) / 60), total % 60
    body = F.concat_ws(
        " ",
        F.when(dd > 0, F.concat(dd.cast("string"), F.lit("d"))),
        F.when(hh > 0, F.concat(hh.cast("string"), F.lit("h"))),
        F.when(mm > 0, F.concat(mm.cast("string"), F.lit("m"))),
    )
    sign = F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(F.lit(""))
    m = F.col("l_orderkey") % 9
    cell = (
        F.when(m == 0, F.lit("--"))
        .when(m == 1, F.lit(""))
        .when(m == 2, total.cast("string"))
        .otherwise(F.concat(sign, body))
    )
    return li.select("l_orderkey", "l_linenumber", cell.alias("cell")).withColumn(
        "minutes", casts.rpt_minutes("cell")
    )


RPT_UNITS_SQL = """
WITH u AS (
  SELECT p_partkey, CAST(p_size * 11 AS VARCHAR) AS cu,
         CAST(CAST(p_retailprice AS DECIMAL(10,1)) AS VARCHAR) AS lb,
         p_size * 11 AS cu_v, CAST(p_retailprice AS DECIMAL(10,1)) AS lb_v FROM part)
SELECT p_partkey,
  CASE p_partkey % 6
    WHEN 0 THEN '-- cuft / ' || lb || ' lbs'
    WHEN 1 THEN cu || ' cuft / -- lbs'
    WHEN 2 THEN '-- cuft / -- lbs'
    WHEN 3 THEN '1.2.' || cu || ' cuft / ' || lb || ' lbs'
    ELSE cu || ' cuft / ' || lb || ' lbs' END AS cell,
  CASE WHEN p_partkey % 6 IN (0, 2, 3) THEN NULL ELSE CAST(cu_v AS DECIMAL(18,4)) END AS cuft,
  CASE WHEN p_partkey % 6 IN (1, 2) THEN NULL ELSE CAST(lb_v AS DECIMAL(18,4)) END AS lbs
FROM u
"""


@query("rpt_units", RPT_UNITS_SQL, "X8")
def rpt_units_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    cu = (F.col("p_size") * 11).cast("string")
    lb = F.col("p_retailprice").cast("decimal(10,1)").cast("string")
    m = F.col("p_partkey") % 6
    cell = (
        F.when(m == 0, F.concat(F.lit("-- cuft / "), lb, F.lit(" lbs")))
        .when(m == 1, F.concat(cu, F.lit(" cuft / -- lbs")))
        .when(m == 2, F.lit("-- cuft / -- lbs"))
        .when(m == 3, F.concat(F.lit("1.2."), cu, F.lit(" cuft / "), lb, F.lit(" lbs")))
        .otherwise(F.concat(cu, F.lit(" cuft / "), lb, F.lit(" lbs")))
    )
    return p.select("p_partkey", cell.alias("cell")).select(
        "p_partkey", "cell", casts.rpt_cuft("cell").alias("cuft"), casts.rpt_lbs("cell").alias("lbs")
    )


# Three zones without a DST change inside the January event log.
ZONES_SQL_CASE = (
    "CASE user_id % 3 WHEN 0 THEN 'America/Los_Angeles' WHEN 1 THEN 'America/New_York' "
    "ELSE 'Europe/Berlin' END"
)
ZONES = ["America/Los_Angeles", "America/New_York", "Europe/Berlin"]

RPT_TS_ZONE_SQL = f"""
WITH z AS (SELECT event_id, ts, {ZONES_SQL_CASE} AS zone FROM events)
SELECT event_id, zone,
  CASE WHEN event_id % 10 = 0 THEN ''
       WHEN event_id % 10 = 1 THEN strftime(timezone(zone, ts AT TIME ZONE 'UTC'), '%-m/%-d/%Y') || ' 13:05 PM'
       ELSE strftime(timezone(zone, ts AT TIME ZONE 'UTC'), '%-m/%-d/%Y %-I:%M %p') END AS cell,
  CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE date_trunc('minute', ts) END AS observed_at
FROM z
"""


def _zone_of_user() -> F.Column:
    u = F.col("user_id") % 3
    return F.when(u == 0, F.lit(ZONES[0])).when(u == 1, F.lit(ZONES[1])).otherwise(F.lit(ZONES[2]))


@query("rpt_ts_zone", RPT_TS_ZONE_SQL, "X3 X10")
def rpt_ts_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id").withColumn("zone", _zone_of_user())
    wall = F.from_utc_timestamp("ts", F.col("zone"))
    m = F.col("event_id") % 10
    cell = (
        F.when(m == 0, F.lit(""))
        .when(m == 1, F.concat(F.date_format(wall, "M/d/yyyy"), F.lit(" 13:05 PM")))
        .otherwise(F.date_format(wall, "M/d/yyyy h:mm a"))
    )
    return ev.select("event_id", "zone", cell.alias("cell")).withColumn(
        "observed_at", casts.rpt_ts("cell", F.col("zone"))
    )


RPT_TS_OFFSET_SQL = """
WITH o AS (SELECT event_id, ts, CAST(user_id % 7 AS INTEGER) - 8 AS off_h FROM events),
t AS (SELECT event_id, ts, off_h,
        CASE WHEN off_h < 0 THEN '-' ELSE '+' END || printf('%02d', abs(off_h)) || ':00' AS off_txt,
        ts + to_hours(off_h) AS wall FROM o)
SELECT event_id,
  CASE WHEN event_id % 8 = 0 THEN strftime(wall, '%-m/%-d/%Y %-I:%M:%S %p')
       WHEN event_id % 8 = 1 THEN ''
       ELSE strftime(wall, '%-m/%-d/%Y %-I:%M:%S %p') || ' ' || off_txt END AS cell,
  CASE WHEN event_id % 8 IN (0, 1) THEN NULL ELSE date_trunc('second', ts) END AS observed_at
FROM t
"""


@query("rpt_ts_offset", RPT_TS_OFFSET_SQL, "X4")
def rpt_ts_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    off_h = (F.col("user_id") % 7).cast("int") - 8
    off_txt = F.concat(
        F.when(off_h < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(off_h).cast("string"), 2, "0"),
        F.lit(":00"),
    )
    wall = F.col("ts") + F.make_interval(hours=off_h)
    m = F.col("event_id") % 8
    shown = F.date_format(wall, "M/d/yyyy h:mm:ss a")
    cell = (
        F.when(m == 0, shown)
        .when(m == 1, F.lit(""))
        .otherwise(F.concat(shown, F.lit(" "), off_txt))
    )
    return ev.select("event_id", cell.alias("cell")).withColumn("observed_at", casts.rpt_ts_offset("cell"))


JSON_FIELD_SQL = """
SELECT event_id,
  json_extract_string(props, '$.k') AS k_text,
  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_exists(props, '$.k') AS has_k,
  json_exists(props, '$.z') AS has_z
FROM events
"""


@query("json_field", JSON_FIELD_SQL, "X11 X12 F3")
def json_field_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "props")
    return ev.select(
        "event_id",
        json_field("props", "k").alias("k_text"),
        json_int("props", "k").alias("k"),
        has_key("props", "k").alias("has_k"),
        has_key("props", "z").alias("has_z"),
    )


# The declared headers of the rendered order report.
ORDER_REPORT_HEADERS = ["Quote #", "Job #", "Status", "Priority", "Service Date", "Estimated Revenue"]

REPORT_ROW_SQL = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS quote_number,
  CAST(o_orderkey AS VARCHAR) AS job_quote,
  o_orderstatus AS status,
  o_orderpriority AS priority,
  CAST(o_orderdate AS DATE) AS service_date,
  CAST(o_totalprice AS DECIMAL(18,2)) AS estimated_revenue
FROM orders
"""


def order_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render ``orders`` as a landed report: one JSON text document per row.

    Every value is text in the vendor's formats; the quote number is blank on
    every fourth row (a report row that cannot be bridged).
    """
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    doc = F.to_json(
        F.struct(
            F.when(k % 4 == 0, F.lit("")).otherwise(k.cast("string")).alias("Quote #"),
            F.concat(k.cast("string"), F.lit("-"), (k % 3 + 1).cast("string")).alias("Job #"),
            F.col("o_orderstatus").alias("Status"),
            F.col("o_orderpriority").alias("Priority"),
            F.date_format("o_orderdate", "M/d/yyyy").alias("Service Date"),
            F.concat(F.lit("$"), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)).alias(
                "Estimated Revenue"
            ),
        )
    )
    return o.select("o_orderkey", doc.alias("row_data"))


@query("report_row_parse", REPORT_ROW_SQL, "X11 X13 X2 X5 F2")
def report_row_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse each JSON report row once into declared headers, then type the cells."""
    rows = order_report_rows(spark, sf_dir).withColumn("r", json_struct("row_data", ORDER_REPORT_HEADERS))
    return rows.select(
        "o_orderkey",
        text.blank_to_null(F.col("r")["Quote #"]).alias("quote_number"),
        text.quote_of(F.col("r")["Job #"]).alias("job_quote"),
        text.blank_to_null(F.col("r")["Status"]).alias("status"),
        text.blank_to_null(F.col("r")["Priority"]).alias("priority"),
        casts.rpt_date(F.col("r")["Service Date"]).alias("service_date"),
        casts.rpt_num(F.col("r")["Estimated Revenue"]).alias("estimated_revenue"),
    )


INT_DATES_SQL = """
WITH y AS (
  SELECT o_orderkey, o_orderdate,
    CASE o_orderkey % 9
      WHEN 0 THEN 0
      WHEN 1 THEN CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) * 100 + 31
      ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS ymd
  FROM orders)
SELECT o_orderkey, ymd,
  CASE WHEN ymd > 0 THEN CAST(try_strptime(CAST(ymd AS VARCHAR), '%Y%m%d') AS DATE) END AS service_date,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso_text,
  CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS ymd_from_iso,
  CASE WHEN ymd > 19000000 THEN CAST(ymd AS BIGINT) END AS ymd_checked
FROM y
"""


@query("int_dates", INT_DATES_SQL, "X17 X18")
def int_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    m = F.col("o_orderkey") % 9
    ymd = (
        F.when(m == 0, F.lit(0))
        .when(m == 1, F.date_format("o_orderdate", "yyyyMM").cast("int") * 100 + 31)
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd").cast("int"))
    )
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return o.select("o_orderkey", ymd.alias("ymd"), iso.alias("iso_text")).select(
        "o_orderkey",
        "ymd",
        casts.int_date("ymd").alias("service_date"),
        "iso_text",
        casts.to_ymd("iso_text").alias("ymd_from_iso"),
        casts.to_ymd("ymd", numeric=True).alias("ymd_checked"),
    )


# A hand-kept segment dimension spelled unlike the data.
SEGMENT_SEED = [
    ("Automobile ", "vehicle"),
    ("building", "construction"),
    ("MACHINERY", "industrial"),
    ("Furniture!", "home"),
]

NORM_JOIN_SQL = """
WITH c AS (
  SELECT c_custkey,
    CASE c_custkey % 4
      WHEN 0 THEN lower(c_mktsegment) || ' '
      WHEN 1 THEN '  ' || c_mktsegment || '!!'
      WHEN 2 THEN '--' || lower(c_mktsegment) || '--'
      ELSE c_mktsegment END AS segment_raw FROM customer),
ck AS (SELECT *, nullif(trim(regexp_replace(lower(coalesce(segment_raw, '')), '[^a-z0-9]+', ' ', 'g')), '') AS segment_key FROM c),
s AS (SELECT * FROM (VALUES ('Automobile ', 'vehicle'), ('building', 'construction'),
                            ('MACHINERY', 'industrial'), ('Furniture!', 'home')) t(seg, segment_group)),
sk AS (SELECT nullif(trim(regexp_replace(lower(coalesce(seg, '')), '[^a-z0-9]+', ' ', 'g')), '') AS segment_key,
              segment_group FROM s)
SELECT ck.c_custkey, ck.segment_raw, ck.segment_key, sk.segment_group
FROM ck LEFT JOIN sk ON ck.segment_key = sk.segment_key
"""


@query("norm_text_join", NORM_JOIN_SQL, "X1 J9 S8")
def norm_text_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join a mangled text column to a seed by the normalised key on both sides."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    m = F.col("c_custkey") % 4
    seg = F.col("c_mktsegment")
    raw = (
        F.when(m == 0, F.concat(F.lower(seg), F.lit(" ")))
        .when(m == 1, F.concat(F.lit("  "), seg, F.lit("!!")))
        .when(m == 2, F.concat(F.lit("--"), F.lower(seg), F.lit("--")))
        .otherwise(seg)
    )
    left = c.select("c_custkey", raw.alias("segment_raw")).withColumn("segment_key", text.norm_text("segment_raw"))
    raw_seed = seeds.frame(spark, SEGMENT_SEED, "seg string, segment_group string")
    seed = keep_bound(raw_seed.select(text.norm_text("seg").alias("segment_key"), "segment_group"), raw_seed)
    return left.join(bounded_broadcast(seed, max_rows=10_000), "segment_key", "left").select(
        "c_custkey", "segment_raw", "segment_key", "segment_group"
    )


NORM_DOCS_SQL = """
WITH n AS (
  SELECT doc_id, nullif(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), '') AS norm
  FROM documents)
SELECT doc_id,
  CASE WHEN norm IS NULL THEN 0 ELSE len(string_split(norm, ' ')) END AS n_words,
  md5(coalesce(norm, '')) AS norm_md5
FROM n
"""


@query("norm_text_documents", NORM_DOCS_SQL, "X1")
def norm_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalise every whole document; word count and digest of the key."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("norm", text.norm_text("text"))
    n_words = F.when(F.col("norm").isNull(), F.lit(0)).otherwise(F.size(F.split("norm", " ")))
    return d.select("doc_id", n_words.cast("bigint").alias("n_words"), F.md5(F.coalesce("norm", F.lit(""))).alias("norm_md5"))
