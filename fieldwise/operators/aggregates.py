"""Business aggregates (A-1 .. A-12 not covered elsewhere).

All are grouped aggregations with built-in functions, so Spark combines on
the map side before the shuffle; ratios are computed from the aggregated
counts, never from a window over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conversion_pct(booked: Column, valid: Column) -> Column:
    """A-5: ``100 * booked / nullif(valid, 0)`` rounded half-up to one decimal.

    Computed in integers (tenths of a percent), then divided once, so the
    rounding does not depend on binary fractions.
    """
    permille = (F.lit(2000) * booked + valid).cast("bigint")
    tenths = F.floor(permille / (F.lit(2) * valid))
    return F.when(valid == 0, F.lit(None)).otherwise(tenths / F.lit(10.0))


def coverage(df: DataFrame, group: Sequence[str], matched: Column, columns: Sequence[str] = ()) -> DataFrame:
    """A-10: rows, matched rows and the match rate per group, plus each column's
    non-null share."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(matched).alias("n_matched")]
    aggs += [F.count(F.col(c)).alias(f"{c}__nonnull") for c in columns]
    out = df.groupBy(*group).agg(*aggs).withColumn("match_rate", F.col("n_matched") / F.col("n_rows"))
    for c in columns:
        out = out.withColumn(f"{c}__share", F.col(f"{c}__nonnull") / F.col("n_rows")).drop(f"{c}__nonnull")
    return out


def quota_usage(
    calls: DataFrame,
    instance: str,
    ts: str,
    as_of,
    quota: int = 125_000,
    switch_pct: int = 85,
) -> DataFrame:
    """A-11: calls per instance and month, share of the monthly quota, and the
    prorated switch line: ``switch_pct`` % of the quota times the elapsed
    share of the month (full months for past months). Only calls before
    ``as_of`` count.
    """
    now = F.lit(as_of).cast("timestamp")
    c = (
        calls.filter(F.col(ts) < now)
        .groupBy(instance, F.date_trunc("month", ts).alias("_month"))
        .agg(F.count(F.lit(1)).alias("calls"))
    )
    current = F.col("_month") == F.date_trunc("month", now)
    elapsed = (F.dayofmonth(now) - 1).cast("bigint")
    days = F.dayofmonth(F.last_day("_month")).cast("bigint")
    limit_now = F.floor(F.lit(quota * switch_pct) * elapsed / (F.lit(100) * days)).cast("bigint")
    limit_full = F.lit(quota * switch_pct // 100).cast("bigint")
    limit = F.when(current, limit_now).otherwise(limit_full)
    return c.select(
        instance,
        F.to_date("_month").alias("month"),
        "calls",
        (F.col("calls") / F.lit(float(quota))).alias("quota_share"),
        limit.alias("prorated_limit"),
        (F.col("calls") > limit).alias("switch_to_prorated"),
    )


def counts_by(df: DataFrame, group: Sequence[str], name: str = "n") -> DataFrame:
    """A-6: live counts by a label."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))
