"""Driver-table roles: how the TPC-H-like tables play the CRM's parts.

``orders`` = opportunity, ``lineitem`` = charge lines / jobs, ``customer`` =
customer, ``nation`` = branch, ``region`` = instance, ``part`` = service type,
``events`` = event log. Seeds are rendered into the oracle SQL from the same
Python rows, so Spark and DuckDB read one definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast, probe_rows
from ..sources import seeds
from .catalog import table

# Integer status code of an order by (o_orderstatus, o_orderpriority).
# One code (77) is deliberately not in the enum and one pair has no code.
STATUS_CODE_OF = {
    ("F", "1-URGENT"): 10,
    ("F", "2-HIGH"): 10,
    ("F", "3-MEDIUM"): 11,
    ("F", "4-NOT SPECIFIED"): 10,
    ("F", "5-LOW"): 11,
    ("O", "1-URGENT"): 4,
    ("O", "2-HIGH"): 3,
    ("O", "3-MEDIUM"): 1,
    ("O", "4-NOT SPECIFIED"): 0,
    ("O", "5-LOW"): 30,
    ("P", "1-URGENT"): 50,
    ("P", "2-HIGH"): 20,
    ("P", "3-MEDIUM"): 11,
    ("P", "4-NOT SPECIFIED"): 77,
}


def status_code(status: str = "o_orderstatus", priority: str = "o_orderpriority") -> Column:
    expr = None
    for (s, p), code in STATUS_CODE_OF.items():
        cond = (F.col(status) == s) & (F.col(priority) == p)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def status_code_sql(status: str = "o_orderstatus", priority: str = "o_orderpriority") -> str:
    arms = " ".join(
        f"WHEN {status} = '{s}' AND {priority} = '{p}' THEN {code}" for (s, p), code in STATUS_CODE_OF.items()
    )
    return f"CAST(CASE {arms} END AS INTEGER)"


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def values_sql(rows, columns: list[str], alias: str = "t") -> str:
    """``(VALUES ...) AS alias(cols)`` for a seed held in code."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(columns)})"


def norm_sql(expr: str) -> str:
    """The SQL form of ``norm_text`` (for the DuckDB oracles)."""
    return f"nullif(trim(regexp_replace(lower(coalesce({expr}, '')), '[^a-z0-9]+', ' ', 'g')), '')"


INSTANCE_COLS = ["r_regionkey", "instance_id", "entity_id", "timezone", "lob_hint"]
INSTANCES_SQL = values_sql(seeds.INSTANCES, INSTANCE_COLS, "i")
STATUS_COLS = [
    "status_code", "status_name", "status_category", "is_valid_lead", "is_booked", "is_completed",
    "is_cancelled", "is_lost", "is_bad_lead", "is_open", "sort_order",
]
STATUS_SQL = values_sql(seeds.STATUS_ENUM, STATUS_COLS, "se")


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as branch, with its instance (region) from the seed. Bounded: one row per nation,
    counted, since Spark has no size for a join with rows held in code: unhinted, the jobs would be
    shuffled by nation before it could see how small this side is, into as many tasks as nations."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    inst = seeds.instances(spark)
    b = n.join(bounded_broadcast(inst, 100_000), n["n_regionkey"] == inst["r_regionkey"], "inner")
    b = b.select(
        "n_nationkey",
        F.col("n_name").alias("branch_name"),
        F.col("instance_id").alias("source_instance_id"),
        "entity_id",
        F.col("timezone").alias("instance_tz"),
        "lob_hint",
    )
    return bounded_broadcast(b, 100_000, bound=probe_rows(n, 100_000))  # regions are unique: no more rows than nations


BRANCHES_SQL = f"""
SELECT n.n_nationkey, n.n_name AS branch_name, i.instance_id AS source_instance_id, i.entity_id,
       i.timezone AS instance_tz, i.lob_hint
FROM nation n JOIN {INSTANCES_SQL} ON n.n_regionkey = i.r_regionkey
"""


def orders_in_branches(spark: SparkSession, sf_dir: str, *order_cols: str) -> DataFrame:
    """orders -> customer -> branch -> instance (J2/J3 chain; inner joins).

    ``customer`` grows with the data and is joined by key (the planner and
    AQE pick broadcast or shuffle from the runtime size); the branch table is
    one row per nation, counted and broadcast.
    """
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", *order_cols)
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    b = branches(spark, sf_dir)
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").drop("c_custkey")
    return oc.join(b, oc["c_nationkey"] == b["n_nationkey"], "inner").drop("n_nationkey")


ORDERS_IN_BRANCHES_SQL = f"""
SELECT o.*, c.c_nationkey, c.c_mktsegment, b.branch_name, b.source_instance_id, b.entity_id,
       b.instance_tz, b.lob_hint
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN ({BRANCHES_SQL}) b ON c.c_nationkey = b.n_nationkey
"""
