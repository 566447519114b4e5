"""Registered queries: change detection (C1-C10), retention.

The previous run's state and the current sweep are derived from ``orders``
by fixed rules on the key: a quarter of the orders were never tracked, some
were soft-deleted before, some hashes changed, some enrichments are old, and
one order in ten vanished from the sweep. The sweep covers the 1998 service
window and is complete; a later truncated sweep exists and must be ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import change
from ..operators.joins import bounded_broadcast
from ..operators.retention import prune_generations
from ..sources import seeds
from .catalog import query, table
from .roles import INSTANCES_SQL, ORDERS_IN_BRANCHES_SQL, orders_in_branches

AS_OF = "1998-06-15 12:00:00"
TODAY = "1998-06-15"
SWEEP_FROM, SWEEP_TO = 19980101, 19981231
KEYS = ["source_instance_id", "o_orderkey"]


def _hash(changed) -> F.Column:
    base = F.concat_ws("|", "o_orderstatus", "o_orderpriority")
    return F.sha1(F.when(changed, F.concat(base, F.lit("|v2"))).otherwise(base))


def _span():
    sd = change.ymd(F.col("o_orderdate"))
    sdx = change.ymd(F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")))
    return sd, sdx


def change_inputs(spark: SparkSession, sf_dir: str):
    """(state, sweep, details, manifest) for one run, all derived from orders."""
    o = orders_in_branches(spark, sf_dir, "o_orderstatus", "o_orderpriority", "o_orderdate")
    k = F.col("o_orderkey")
    now = F.lit(AS_OF).cast("timestamp")
    sd, sdx = _span()
    state = o.filter(k % 4 != 3).select(
        *KEYS,
        _hash(F.lit(False)).alias("h"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(now - F.make_interval(hours=(k % 500).cast("int"))).alias("t"),
        (now - F.expr("INTERVAL 1 DAY")).alias("seen"),
        sd.alias("sd"),
        sdx.alias("sdx"),
        F.lit(None).cast("string").alias("ls"),
        F.when(k % 13 == 0, now - F.expr("INTERVAL 2 DAYS")).alias("gone"),
        F.lit(None).cast("boolean").alias("gp"),
        F.lit(None).cast("boolean").alias("g404"),
    )
    in_window = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")) & (
        F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")
    )
    sweep = o.filter(in_window & (k % 10 != 9)).select(*KEYS, _hash(k % 7 == 0).alias("h"), sd.alias("sd"), sdx.alias("sdx"))
    details = o.select(
        *KEYS,
        (k % 19 != 0).alias("ok"),
        (k % 17 == 0).alias("missing"),
        F.col("o_orderpriority").alias("ls"),
    )
    # One complete sweep per instance and a later, truncated one that must be ignored.
    runs = [(AS_OF, True), ("1998-06-15 13:00:00", False)]
    manifest = spark.createDataFrame(
        [(inst[1], at, SWEEP_FROM, SWEEP_TO, done) for inst in seeds.INSTANCES for at, done in runs],
        "source_instance_id string, at string, from long, to long, complete boolean",
    ).withColumn("at", F.col("at").cast("timestamp"))
    return state, sweep, details, manifest


STATE_SQL = f"""
o AS ({ORDERS_IN_BRANCHES_SQL}),
state AS (
  SELECT source_instance_id, o_orderkey, sha1(o_orderstatus || '|' || o_orderpriority) AS h,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL
         ELSE TIMESTAMP '{AS_OF}' - to_hours(CAST(o_orderkey % 500 AS INTEGER)) END AS t,
    TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS seen,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS sd,
    CAST(strftime(o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)), '%Y%m%d') AS BIGINT) AS sdx,
    CAST(NULL AS VARCHAR) AS ls,
    CASE WHEN o_orderkey % 13 = 0 THEN TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY END AS gone
  FROM o WHERE o_orderkey % 4 <> 3),
sweep AS (
  SELECT source_instance_id, o_orderkey,
    sha1(o_orderstatus || '|' || o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN '|v2' ELSE '' END) AS h,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS sd,
    CAST(strftime(o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)), '%Y%m%d') AS BIGINT) AS sdx
  FROM o WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderkey % 10 <> 9),
j AS (
  SELECT s.source_instance_id, s.o_orderkey, s.h, coalesce(s.sd, st.sd) AS sd, coalesce(s.sdx, st.sdx) AS sdx,
         st.h AS old_h, st.t AS old_t, st.seen AS old_seen, st.gone AS old_gone
  FROM sweep s LEFT JOIN state st ON st.source_instance_id = s.source_instance_id AND st.o_orderkey = s.o_orderkey),
obs AS (
  SELECT *,
    CASE WHEN old_gone IS NOT NULL THEN 'resurrected'
         WHEN old_seen IS NULL AND old_h IS NULL AND old_t IS NULL THEN 'new'
         WHEN old_h IS DISTINCT FROM h THEN 'changed'
         WHEN old_t IS NULL OR (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(old_t)) / 3.6e9 >=
              CASE WHEN sd BETWEEN {int(TODAY.replace('-', '')) - 3} AND 19980706 THEN 24.0 ELSE 336.0 END
           THEN 'stale' END AS reason
  FROM j)
"""

CANDIDATES_SQL = (
    "WITH "
    + STATE_SQL
    + """
SELECT source_instance_id, o_orderkey, reason,
  CAST(CASE reason WHEN 'resurrected' THEN 1 WHEN 'new' THEN 2 WHEN 'changed' THEN 3
                   WHEN 'stale' THEN 4 WHEN 'forced' THEN 5 END AS BIGINT) AS reason_rank
FROM obs WHERE reason IS NOT NULL
"""
)


@query("enrichment_candidates", CANDIDATES_SQL, "C1 C2 C3 C4 C7 J18")
def enrichment_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who gets the costly detail call this run, and why."""
    state, sweep, _, _ = change_inputs(spark, sf_dir)
    obs = change.observe_sweep(state, sweep, KEYS, AS_OF, F.lit(TODAY).cast("date"))
    return change.enrichment_candidates(obs, KEYS)


FOLD_SQL = (
    "WITH "
    + STATE_SQL
    + f""",
det AS (
  SELECT source_instance_id, o_orderkey, o_orderkey % 19 <> 0 AS ok, o_orderkey % 17 = 0 AS missing,
         o_orderpriority AS d_ls FROM o),
f AS (
  SELECT coalesce(st.source_instance_id, b.source_instance_id) AS source_instance_id,
         coalesce(st.o_orderkey, b.o_orderkey) AS o_orderkey,
         st.h AS h0, st.t AS t0, st.seen AS seen0, st.sd AS sd0, st.sdx AS sdx0, st.ls AS ls0, st.gone AS gone0,
         b.o_orderkey IS NOT NULL AS swept, b.h AS h1, b.sd AS sd1, b.sdx AS sdx1, b.reason
  FROM state st FULL OUTER JOIN obs b
    ON st.source_instance_id = b.source_instance_id AND st.o_orderkey = b.o_orderkey),
g AS (
  SELECT f.*, d.ok, d.missing, d.d_ls,
    f.swept AND f.reason IS NOT NULL AND coalesce(d.ok, FALSE) AND NOT coalesce(d.missing, FALSE) AS okc,
    f.swept AND f.reason IS NOT NULL AND coalesce(d.missing, FALSE) AS miss
  FROM f LEFT JOIN det d ON d.source_instance_id = f.source_instance_id AND d.o_orderkey = f.o_orderkey),
folded AS (
  SELECT source_instance_id, o_orderkey,
    CASE WHEN okc THEN h1 ELSE h0 END AS h,
    CASE WHEN okc THEN TIMESTAMP '{AS_OF}' ELSE t0 END AS t,
    CASE WHEN swept THEN TIMESTAMP '{AS_OF}' ELSE seen0 END AS seen,
    CASE WHEN swept THEN sd1 ELSE sd0 END AS sd,
    CASE WHEN swept THEN sdx1 ELSE sdx0 END AS sdx,
    CASE WHEN okc THEN nullif(trim(d_ls), '') ELSE ls0 END AS ls,
    CASE WHEN miss THEN TIMESTAMP '{AS_OF}' WHEN swept THEN NULL ELSE gone0 END AS gone,
    CASE WHEN miss THEN TRUE WHEN swept THEN NULL ELSE NULL END AS gp,
    CASE WHEN miss THEN TRUE WHEN swept THEN NULL ELSE NULL END AS g404
  FROM g),
marked AS (
  SELECT * EXCLUDE (gone, gp),
    CASE WHEN vanished THEN TIMESTAMP '{AS_OF}' ELSE gone END AS gone,
    CASE WHEN vanished THEN TRUE ELSE gp END AS gp
  FROM (SELECT *, gone IS NULL AND seen IS NOT NULL AND seen < TIMESTAMP '{AS_OF}'
                 AND sd IS NOT NULL AND sdx IS NOT NULL
                 AND NOT (sdx < {SWEEP_FROM} OR sd > {SWEEP_TO}) AS vanished FROM folded))
"""
)

DELETIONS_SQL = (
    FOLD_SQL
    + f"""
SELECT source_instance_id, o_orderkey, TIMESTAMP '{AS_OF}' AS deleted_at,
       CASE WHEN coalesce(g404, FALSE) THEN 'detail_404' ELSE 'sweep_disappearance' END AS delete_source
FROM marked WHERE coalesce(gp, FALSE)
"""
)


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, sweep, details, manifest = change_inputs(spark, sf_dir)
    today = F.lit(TODAY).cast("date")
    new_state = change.decide_and_fold(state, sweep, details, KEYS, AS_OF, today)
    sweeps = change.last_complete_sweep(manifest)
    return change.detect_deletions(new_state, sweeps, KEYS, AS_OF)


@query("deletions", DELETIONS_SQL, "C5 C6 C8 U5 J18")
def deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletion markers: 404 from the detail call, or absent from a complete sweep that should have seen it."""
    out = change.emit_deletions(_folded(spark, sf_dir), KEYS, AS_OF)
    return out.withColumnRenamed("_deleted_at", "deleted_at").withColumnRenamed("_delete_source", "delete_source")


STATE_FOLD_SQL = (
    FOLD_SQL
    + f"""
SELECT source_instance_id, o_orderkey, h, t, seen, sd, sdx, ls, gone, g404
FROM marked
WHERE NOT ((sdx IS NOT NULL AND sdx < {int('19980215')})
           OR (sdx IS NULL AND coalesce((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(t)) / 3.6e9, 0) > 120 * 24))
"""
)


@query("state_fold", STATE_FOLD_SQL, "C7 C9 C10 C5 C6")
def state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after the run: sightings, banked watermarks, markers, pruned."""
    st = change.clear_pending(_folded(spark, sf_dir))
    st = change.prune_state(st, AS_OF, F.lit(TODAY).cast("date"))
    return st.select(*KEYS, "h", "t", "seen", "sd", "sdx", "ls", "gone", "g404")


# -------------------------------------------------------------------- R7 N6
RETENTION_AS_OF = "2024-01-31 00:00:00"

RETENTION_SQL = f"""
WITH r AS (
  SELECT e.event_id, i.instance_id AS source_instance_id, i.timezone, date_trunc('hour', e.ts) AS report_generated_at
  FROM events e JOIN {INSTANCES_SQL} ON i.r_regionkey = e.user_id % 5),
gens AS (SELECT DISTINCT source_instance_id, timezone, report_generated_at FROM r),
ranked AS (
  SELECT *, dense_rank() OVER (
      PARTITION BY source_instance_id, CAST(timezone(timezone, report_generated_at AT TIME ZONE 'UTC') AS DATE)
      ORDER BY report_generated_at DESC) AS rk
  FROM gens)
SELECT r.event_id, r.source_instance_id, r.report_generated_at
FROM r JOIN ranked k ON k.source_instance_id = r.source_instance_id AND k.report_generated_at = r.report_generated_at
WHERE k.report_generated_at >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 10 DAY OR k.rk = 1
"""


@query("retention", RETENTION_SQL, "R7 N6")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by the policy: all generations of the last 10 days, then the
    latest generation of each instance-local day."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    inst = seeds.instances(spark)
    rows = ev.join(bounded_broadcast(inst, 100_000), (F.col("user_id") % 5) == inst["r_regionkey"], "inner").select(
        "event_id",
        F.col("instance_id").alias("source_instance_id"),
        "timezone",
        F.date_trunc("hour", "ts").alias("report_generated_at"),
    )
    return prune_generations(rows, RETENTION_AS_OF, keep_days=10).select(
        "event_id", "source_instance_id", "report_generated_at"
    )
