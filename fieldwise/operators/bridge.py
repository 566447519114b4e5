"""Identity bridges.

Reports identify an object by a text quote number that is unique only inside
an instance; the API by an id. The crosswalk maps ``(instance, quote) -> id``
from the API arms only; report rows that cannot be bridged are kept in an
explicit unmatched table with a reason, never dropped silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import small_table
from .resolve import newest_row
from .sequence import ordered_scan

# The two reasons a report row is unmatched.
NO_QUOTE = "no_quote_number"
NOT_IN_API = "quote_not_in_api"


def quote_key(c: str | Column) -> Column:
    """The text-normalised quote key (trimmed text, blank -> null)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def crosswalk(
    arms: DataFrame,
    instance: str = "source_instance_id",
    quote: str = "quote_number",
    id_col: str = "opportunity_id",
    observed_at: str = "observed_at",
    priority: str = "source_priority",
    source: str = "source",
) -> DataFrame:
    """Newest ``(instance, quote) -> id`` over the API arms.

    Newest observation wins, lower priority breaks ties, then the larger id
    (deterministic). Rows without a quote are not candidates (F5).
    """
    cands = arms.withColumn(quote, quote_key(quote)).filter(F.col(quote).isNotNull())
    order = [F.col(observed_at), -F.col(priority), F.col(id_col)]
    return newest_row(cands, [instance, quote], order, keep=[id_col, source, observed_at])


def newest_generation(
    rows: DataFrame,
    instance: str = "source_instance_id",
    generated_at: str = "report_generated_at",
    max_instances: int = 100_000,
) -> DataFrame:
    """Only the rows of each instance's newest report generation.

    The per-instance maxima are one row per instance, computed once while the plan is
    built, and broadcast up to ``max_instances`` of them.
    """
    latest = rows.groupBy(instance).agg(F.max(generated_at).alias(generated_at))
    return rows.join(small_table(latest, max_instances), [instance, generated_at], "inner")


def unmatched(
    report: DataFrame,
    xwalk: DataFrame,
    instance: str = "source_instance_id",
    quote: str = "quote_number",
    generated_at: str = "report_generated_at",
) -> DataFrame:
    """Rows of the newest generation that the crosswalk cannot bridge, with a reason.

    ``left_anti`` keeps rows whose ``(instance, quote)`` has no crosswalk entry.
    A null quote never matches: those rows (often a large share) take keys of
    their own that no crosswalk entry has, spread over many values, so that
    they neither share one key in the join nor need a second read of the rows.
    """
    rows = newest_generation(report.withColumn(quote, quote_key(quote)), instance, generated_at)
    keys = xwalk.select(instance, quote)
    spread = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*rows.columns), F.lit(4096)).cast("string"))
    keyed = rows.withColumn("_quote_key", F.coalesce(F.col(quote), spread))
    miss = keyed.join(keys.withColumnRenamed(quote, "_quote_key"), [instance, "_quote_key"], "left_anti").drop("_quote_key")
    return miss.withColumn("reason", F.when(F.col(quote).isNull(), F.lit(NO_QUOTE)).otherwise(F.lit(NOT_IN_API)))


def matched(report: DataFrame, xwalk: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Report rows bridged to the API id (inner join on the composite key)."""
    return report.join(xwalk.select(*keys, id_col), list(keys), "inner")


def recover_attribution(
    job_rows: DataFrame,
    api_jobs: DataFrame,
    job_key: str,
    opp_key: Sequence[str],
    observed_at: str,
    fields: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """R10 (J6 + N4): attribution fields from the newest related job report row.

    Report job rows carry salesperson and friends but no opportunity id; the
    API job table maps ``job_key`` to the opportunity. The newest job row per
    opportunity (ties by ``tiebreak``) becomes a candidate source ``ajo``.
    """
    bridged = job_rows.join(api_jobs.select(job_key, *opp_key), job_key, "inner")
    order = [F.col(observed_at), *[F.col(c) for c in tiebreak]]
    return newest_row(bridged, list(opp_key), order, keep=[observed_at, *fields])


def match_next(
    leads: DataFrame,
    opps: DataFrame,
    keys: Sequence[str],
    lead_ts: str,
    opp_ts: str,
    lead_id: str,
    opp_id: str,
    within_seconds: float,
) -> DataFrame:
    """Tier 2 fuzzy map: each lead's first opportunity with the same key (e.g.
    instance + branch + normalised e-mail or phone) created at or after it,
    within ``within_seconds``; null when there is none.

    An as-of lookup, not a join: leads and opportunities are stacked, scanned
    in descending time per key (range-partitioned, so a hot contact key is
    split across tasks), and each lead takes the newest opportunity seen so
    far - no pair of rows is ever formed.
    """
    le = leads.select(*keys, F.col(lead_ts).alias("_ts"), F.col(lead_id).alias("_id"), F.lit(False).alias("_is_opp"))
    op = opps.select(*keys, F.col(opp_ts).alias("_ts"), F.col(opp_id).alias("_id"), F.lit(True).alias("_is_opp"))
    return match_next_rows(le.unionByName(op), keys, "_ts", "_id", F.col("_is_opp"), within_seconds)


def match_next_rows(
    rows: DataFrame, keys: Sequence[str], ts: str, id_col: str, is_opp: Column, within_seconds: float
) -> DataFrame:
    """``match_next`` over one stacked input (leads and opportunities of one
    table, told apart by ``is_opp``) - a single scan of that table."""
    stacked = rows.select(
        *keys,
        (-F.unix_micros(ts)).alias("_neg_t"),
        F.when(is_opp, F.lit(0)).otherwise(F.lit(1)).alias("_rank"),
        F.col(id_col).cast("bigint").alias("_rid"),
        is_opp.alias("_is_opp"),
        F.when(is_opp, F.col(id_col).cast("bigint")).alias("_oid"),
    )
    scanned = ordered_scan(
        stacked, list(keys), "_neg_t", ["_rank", "_rid"], mark="_is_opp", mark_value="_oid"
    ).filter(~F.col("_is_opp"))
    delay_us = F.col("_neg_t") - F.col("last_mark_ts")
    ok = F.col("last_mark_value").isNotNull() & (delay_us <= F.lit(int(within_seconds * 1_000_000)))
    return scanned.select(
        *keys,
        F.col("_rid").alias("lead_id"),
        F.timestamp_micros(-F.col("_neg_t")).alias("lead_at"),
        F.when(ok, F.col("last_mark_value")).alias("opportunity_id"),
        F.when(ok, F.timestamp_micros(-F.col("last_mark_ts"))).alias("opportunity_at"),
        F.when(ok, F.floor(delay_us / F.lit(1_000_000)).cast("bigint")).alias("delay_seconds"),
    )
