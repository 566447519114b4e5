"""Registered queries: data tests and contracts (Q1-Q5, Q8, Q10, Q11, A-7, A-9, A-10).

Violations are planted by fixed rules (a fifth of the quotes missing, a
status outside the accepted set, a delivery announced with more rows than
landed) and the driver tables bring their own: ``(l_orderkey,
l_linenumber)`` is not unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts
from ..operators import aggregates, bridge, quality
from .business_queries import CROSSWALK_ARMS_SQL, _api_arms
from .catalog import query, table
from .roles import ORDERS_IN_BRANCHES_SQL, orders_in_branches

QUOTE_SQL = "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey // 3 AS VARCHAR) END"

QUALITY_SQL = f"""
SELECT 'not_null' AS check_name, 'orders' AS table_name, 'quote_number' AS column_name,
       count(*) AS failing_rows, min(CAST(o_orderkey AS VARCHAR)) AS sample
FROM orders WHERE ({QUOTE_SQL}) IS NULL
UNION ALL
SELECT 'unique', 'lineitem', 'l_orderkey,l_linenumber', count(*),
       min(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR))
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL
SELECT 'unique', 'orders', 'o_orderkey', count(*), min(CAST(o_orderkey AS VARCHAR))
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'accepted_values', 'orders', 'o_orderstatus', count(*), min(CAST(o_orderkey AS VARCHAR))
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
UNION ALL
SELECT 'relationships', 'lineitem', 'l_orderkey', count(*), min(CAST(l_orderkey AS VARCHAR))
FROM lineitem l WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'relationships', 'orders', 'o_custkey', count(*), min(CAST(o_orderkey AS VARCHAR))
FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'not_null', 'customer', 'c_mktsegment', count(*), min(CAST(c_custkey AS VARCHAR))
FROM customer WHERE c_mktsegment IS NULL
"""

CHECKS = [
    quality.Check("not_null", "orders", ("quote_number",), ("o_orderkey",)),
    quality.Check("unique", "lineitem", ("l_orderkey", "l_linenumber"), ()),
    quality.Check("unique", "orders", ("o_orderkey",), ()),
    quality.Check("accepted_values", "orders", ("o_orderstatus",), ("o_orderkey",), values=("F", "O")),
    quality.Check("relationships", "lineitem", ("l_orderkey",), ("l_orderkey",), parent="orders", parent_column="o_orderkey"),
    quality.Check("relationships", "orders", ("o_custkey",), ("o_orderkey",), parent="customer", parent_column="c_custkey"),
    quality.Check("not_null", "customer", ("c_mktsegment",), ("c_custkey",)),
]


@query("quality_report", QUALITY_SQL, "Q1 Q2 Q3 Q4")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared checks, one result row each, with the smallest failing key as sample."""
    k = F.col("o_orderkey")
    tables = {
        "orders": table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus").withColumn(
            "quote_number", F.when(k % 5 != 0, F.floor(k / 3).cast("string"))
        ),
        "lineitem": table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber"),
        "customer": table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment"),
    }
    return quality.run_checks(CHECKS, tables)


GEN_SQL = "date_trunc('quarter', o_orderdate) + INTERVAL 6 HOUR"

LANDED_SQL = f"""
WITH r AS (SELECT source_instance_id, {GEN_SQL} AS report_generated_at FROM ({ORDERS_IN_BRANCHES_SQL})),
landed AS (SELECT source_instance_id, report_generated_at, count(*) AS landed_records FROM r GROUP BY 1, 2),
manifest AS (
  SELECT source_instance_id, report_generated_at,
         landed_records + CASE WHEN source_instance_id = 'asia'
                                AND report_generated_at = TIMESTAMP '1999-01-01 06:00:00' THEN 3 ELSE 0 END
           AS expected_records
  FROM landed
  UNION ALL
  SELECT 'africa', TIMESTAMP '2005-01-01 06:00:00', 10)
SELECT m.source_instance_id, m.report_generated_at, m.expected_records, coalesce(l.landed_records, 0) AS landed_records
FROM manifest m LEFT JOIN landed l
  ON l.source_instance_id = m.source_instance_id AND l.report_generated_at = m.report_generated_at
WHERE coalesce(l.landed_records, 0) <> m.expected_records
"""


@query("landed_vs_expected", LANDED_SQL, "A-9 Q5")
def landed_vs_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose landed row count differs from the announced one."""
    o = orders_in_branches(spark, sf_dir, "o_orderdate")
    gen = F.date_trunc("quarter", "o_orderdate") + F.expr("INTERVAL 6 HOURS")
    rows = o.select("source_instance_id", gen.alias("report_generated_at"))
    keys = ["source_instance_id", "report_generated_at"]
    announced = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    planted = (F.col("source_instance_id") == "asia") & (
        F.col("report_generated_at") == F.lit("1999-01-01 06:00:00").cast("timestamp")
    )
    announced = announced.select(
        *keys, (F.col("n") + F.when(planted, F.lit(3)).otherwise(F.lit(0))).alias("expected_records")
    )
    empty_delivery = spark.createDataFrame(
        [("africa", "2005-01-01 06:00:00", 10)], "source_instance_id string, report_generated_at string, expected_records long"
    ).withColumn("report_generated_at", F.col("report_generated_at").cast("timestamp"))
    manifest = announced.unionByName(empty_delivery)
    return quality.landed_vs_expected(rows, manifest, keys).select(*keys, "expected_records", "landed_records")


def _report_cells(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Order dates and totals rendered as report text with the vendor's sentinels."""
    o = orders_in_branches(spark, sf_dir, "o_orderdate", "o_totalprice", *cols)
    k = F.col("o_orderkey")
    d7, m5 = k % 7, k % 5
    date_cell = (
        F.when(d7 == 0, F.lit("0/0/0"))
        .when(d7 == 1, F.lit(""))
        .when(d7 == 2, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(d7 == 3, F.concat(F.lit("2/31/"), F.date_format("o_orderdate", "yyyy")))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    )
    dec = F.col("o_totalprice").cast("decimal(18,2)")
    money_cell = (
        F.when(m5 == 0, F.lit("--"))
        .when(m5 == 1, F.lit(""))
        .when(m5 == 2, F.concat(F.lit(" "), dec.cast("string"), F.lit(" ")))
        .when(m5 == 3, F.concat(F.lit("("), dec.cast("string"), F.lit(")")))
        .otherwise(F.concat(F.lit("$"), F.format_number(dec, 2)))
    )
    return o.withColumn("date_cell", date_cell).withColumn("money_cell", money_cell)


PARSE_LOSS_SQL = f"""
WITH o AS ({ORDERS_IN_BRANCHES_SQL})
SELECT 'service_date' AS column_name, count(*) FILTER (WHERE o_orderkey % 7 <> 1) AS n_nonblank,
       count(*) FILTER (WHERE o_orderkey % 7 IN (0, 3)) AS n_lost FROM o
UNION ALL
SELECT 'estimated_revenue', count(*) FILTER (WHERE o_orderkey % 5 <> 1),
       count(*) FILTER (WHERE o_orderkey % 5 IN (0, 3)) FROM o
"""


@query("parse_losses", PARSE_LOSS_SQL, "Q8 X2 X5")
def parse_losses_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank report cells per column and how many typed to null, in one pass."""
    c = _report_cells(spark, sf_dir)
    return quality.parse_losses(
        c,
        {
            "service_date": ("date_cell", casts.rpt_date("date_cell")),
            "estimated_revenue": ("money_cell", casts.rpt_num("money_cell")),
        },
    )


RECONCILE_SQL = f"""
WITH o AS ({ORDERS_IN_BRANCHES_SQL}),
api AS (SELECT source_instance_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS api_total FROM o GROUP BY 1),
rpt AS (SELECT source_instance_id,
               sum(CASE WHEN o_orderkey % 5 IN (0, 1, 3) THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END)
                 AS report_total FROM o GROUP BY 1)
SELECT coalesce(a.source_instance_id, r.source_instance_id) AS source_instance_id, a.api_total, r.report_total,
       coalesce(a.api_total, 0) - coalesce(r.report_total, 0) AS difference
FROM api a FULL OUTER JOIN rpt r ON a.source_instance_id = r.source_instance_id
WHERE abs(coalesce(a.api_total, 0) - coalesce(r.report_total, 0)) > 0
"""


@query("reconcile_layers", RECONCILE_SQL, "Q10 A-7")
def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API totals against report totals per instance, to the cent; mismatches only."""
    c = _report_cells(spark, sf_dir)
    api = c.select("source_instance_id", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    rpt = c.select("source_instance_id", casts.rpt_num("money_cell").alias("amount"))
    return quality.reconcile(api, rpt, ["source_instance_id"], "amount", "api_total", "report_total")


DRIFT_SQL = f"""
WITH o AS (SELECT *, {GEN_SQL} AS report_generated_at FROM orders),
d AS (
  SELECT report_generated_at,
    CASE WHEN o_orderkey % 97 = 0 AND year(o_orderdate) = 1999
         THEN json_object('Quote #', CAST(o_orderkey AS VARCHAR), 'Status', o_orderstatus, 'Notes', 'x')
         ELSE json_object('Quote #', CAST(o_orderkey AS VARCHAR), 'Status', o_orderstatus) END AS row_data
  FROM o),
s AS (SELECT report_generated_at, array_to_string(list_sort(json_keys(row_data)), chr(1)) AS sig FROM d
      GROUP BY 1, 2)
SELECT report_generated_at, count(*) AS n_header_sets FROM s GROUP BY 1 HAVING count(*) > 1
"""


@query("header_drift", DRIFT_SQL, "Q11 X11")
def header_drift_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report generations whose rows do not share one header set."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    base = [k.cast("string").alias("Quote #"), F.col("o_orderstatus").alias("Status")]
    drift = (k % 97 == 0) & (F.year("o_orderdate") == 1999)
    doc = F.when(drift, F.to_json(F.struct(*base, F.lit("x").alias("Notes")))).otherwise(F.to_json(F.struct(*base)))
    rows = o.select((F.date_trunc("quarter", "o_orderdate") + F.expr("INTERVAL 6 HOURS")).alias("report_generated_at"), doc.alias("row_data"))
    return quality.header_drift(rows, ["report_generated_at"])


def _resolution_rate_sql() -> str:
    return (
        CROSSWALK_ARMS_SQL
        + f""",
rpt AS (
  SELECT o.source_instance_id,
         nullif(trim(CASE WHEN o.o_orderkey % 4 = 0 THEN ''
              WHEN o.o_orderpriority = '5-LOW' THEN CAST(o.o_orderkey + 1000000 AS VARCHAR)
              ELSE CAST(o.o_orderkey // 3 AS VARCHAR) END), '') AS quote_number
  FROM ({ORDERS_IN_BRANCHES_SQL}) o)
SELECT r.source_instance_id, count(*) AS n_rows, count(xw.opportunity_id) AS n_matched,
       count(xw.opportunity_id) / count(*) AS match_rate,
       count(r.quote_number) / count(*) AS quote_number__share
FROM rpt r LEFT JOIN xw ON xw.source_instance_id = r.source_instance_id AND xw.quote_number = r.quote_number
GROUP BY 1
"""
    )


@query("resolution_rate", _resolution_rate_sql(), "A-10 J5")
def resolution_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of report rows the crosswalk bridges, and the quote column's non-null share."""
    o = orders_in_branches(spark, sf_dir, "o_orderstatus", "o_orderpriority", "o_orderdate")
    xw = bridge.crosswalk(_api_arms(spark, sf_dir, o)).select("source_instance_id", "quote_number", "opportunity_id")
    k = F.col("o_orderkey")
    quote = (
        F.when(k % 4 == 0, F.lit(""))
        .when(F.col("o_orderpriority") == "5-LOW", (k + 1000000).cast("string"))
        .otherwise(F.floor(k / 3).cast("string"))
    )
    rpt = o.select("source_instance_id", "o_orderkey", bridge.quote_key(quote).alias("quote_number"))
    # null quotes match nothing; keys of their own keep them from meeting in one task of the join
    spread = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("o_orderkey"), F.lit(4096)).cast("string"))
    rpt = rpt.withColumn("_key", F.coalesce("quote_number", spread))
    j = rpt.join(xw.withColumnRenamed("quote_number", "_key"), ["source_instance_id", "_key"], "left")
    return aggregates.coverage(j, ["source_instance_id"], F.col("opportunity_id").isNotNull(), ["quote_number"])
