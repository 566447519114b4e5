"""Event-log operators in batch form (E2-E8, F8, A-4, A-12, W5).

The same semantics run continuously in ``fieldwise.streaming``; the batch
forms serve backfills, the driver-table checks and the streaming = batch
tests. Order-dependent operators (replay dedup, debounce) use the skew-safe
ordered scan, so one hot resource does not end up in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import ordered_scan, within
# The pandas function of this module runs in Python workers. Pickle it by
# value so executors need numpy and pandas only, not this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The event types that trigger a targeted detail read; all
# others are only marked processed.
ENRICH_TYPES = ["job-closed", "job-finalized", "payment-made"]
MAX_ATTEMPTS = 5


def delivery_hash(*parts: str | Column) -> Column:
    """The replay key, sha1 over ``type|resource|payload``.

    It has no time in it on purpose (a status that leaves and returns hashes
    the same), which is why dedup is bounded in time (trap T2).
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha1(F.concat_ws("|", *[c.cast("string") for c in cols]))


def dedupe_replays(
    df: DataFrame, hash_col: str, ts: str, delay_seconds: float, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """E2 (batch): drop a delivery that arrives at most ``delay_seconds`` after the
    last *kept* one of its hash; later repeats are new events (trap T2: a status
    that returns every few days comes through again, it does not extend its ban).

    Runs of deliveries without a longer pause begin with a kept one, and only a
    run that itself lasts longer than the delay holds more. Those rows alone are
    sorted by run and kept greedily, in one pass with the state of one row.
    """
    scanned = ordered_scan(df, [hash_col], ts, tiebreak, gap_seconds=delay_seconds)
    first = F.col("prev_ts").isNull() | ~within(F.col("prev_ts"), F.col(ts), delay_seconds)
    late = ~first & ~within(F.col("session_start"), F.col(ts), delay_seconds)
    run = [hash_col, "session_start"]
    later = scanned.filter(late).repartition(*run).sortWithinPartitions(*run, ts, *tiebreak)
    later = later.withColumn("_t", F.unix_micros(ts)).withColumn("_s", F.unix_micros("session_start"))
    kept = later.mapInPandas(keep_apart(hash_col, int(delay_seconds * 1_000_000)), later.schema)
    return scanned.filter(first).unionByName(kept.drop("_t", "_s")).drop("prev_ts", "session_start")


def keep_apart(key: str, delay_us: int):
    """Of rows sorted by (key, run start ``_s``, time ``_t``) keep those more than the
    delay after the last kept row of their run; a run's start counts as kept."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, last = None, 0
        for pdf in batches:
            keys, starts, times = pdf[key].tolist(), pdf["_s"].tolist(), pdf["_t"].tolist()
            rows = []
            for i, (k, s, t) in enumerate(zip(keys, starts, times, strict=True)):
                if (k, s) != run:
                    run, last = (k, s), s
                if t - last > delay_us:
                    rows.append(i)
                    last = t
            yield pdf.iloc[rows]

    return keep


def debounce(
    df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """E3 (batch): events of one resource less than ``gap_seconds`` apart
    collapse into one unit of work (count, first, last)."""
    s = ordered_scan(df, keys, ts, tiebreak, gap_seconds=gap_seconds)
    return s.groupBy(*keys, "session_start").agg(
        F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n_events")
    )


def route(df: DataFrame, type_col: str, allowlist: Sequence[str] = ENRICH_TYPES) -> DataFrame:
    """E4 + F8: tag each event ``enrich`` (allowlisted) or ``drain`` (mark processed only)."""
    return df.withColumn(
        "route", F.when(F.col(type_col).isin(list(allowlist)), F.lit("enrich")).otherwise(F.lit("drain"))
    )


def split_retries(df: DataFrame, attempts_col: str = "process_attempts", max_attempts: int = MAX_ATTEMPTS):
    """(retry, dead_letter) - an event that failed ``max_attempts`` times is dead-lettered."""
    dead = F.col(attempts_col) >= max_attempts
    return df.filter(~dead), df.filter(dead)


def dead_letter(df: DataFrame, id_col: str, error_col: str) -> DataFrame:
    """Dead-letter rows, unique on ``(message id, error)`` (replays append nothing)."""
    return df.dropDuplicates([id_col, error_col])


def event_rate(df: DataFrame, ts: str, width: str, by: Sequence[str] = ()) -> DataFrame:
    """Tumbling-window counts, windows aligned to the epoch."""
    return (
        df.groupBy(F.window(ts, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events")
    )


def event_volume(df: DataFrame, type_col: str) -> DataFrame:
    """A-12: events per type and their share of all events.

    The share's denominator is a window over the per-type counts (one row per
    type after partial aggregation), never over raw events.
    """
    counts = df.groupBy(type_col).agg(F.count(F.lit(1)).alias("n_events"))
    total = F.sum("n_events").over(Window.partitionBy())
    return counts.select(type_col, "n_events", (F.col("n_events") / total).alias("share"))


def enrich_queue(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    type_col: str,
    allowlist: Sequence[str],
) -> DataFrame:
    """A-4: every distinct resource to enrich, with the columns a drain orders by
    (first event time, then key). The whole queue is returned; how many of its
    oldest rows one drain takes is the caller's budget."""
    wanted = df.filter(F.col(type_col).isin(list(allowlist)))
    return wanted.groupBy(*keys).agg(F.min(ts).alias("first_seen"), F.count(F.lit(1)).alias("n_events"))


def silent_hours(
    df: DataFrame,
    ts: str,
    by: Sequence[str],
    first_hour: int = 8,
    last_hour: int = 17,
    weekdays_only: bool = True,
    zone_col: str | None = None,
    until: Column | None = None,
) -> DataFrame:
    """Business hours with no event, per group, between the group's first and last
    event, or up to the last hour that ends by the instant ``until``.

    Hours are UTC, or those of the group's own zone (``zone_col``, one zone a group);
    ``hour_start`` is an instant either way. The calendar is generated per group from
    its own range (a generator over one row per group), not by a cross join.
    """
    zone = F.col(zone_col) if zone_col else F.lit("UTC")
    local_hour = F.date_trunc("hour", F.from_utc_timestamp(ts, zone))
    last = F.max(local_hour) if until is None else F.max(F.date_trunc("hour", F.from_utc_timestamp(until, zone)) - F.expr("INTERVAL 1 HOUR"))
    span = df.groupBy(*by).agg(F.min(local_hour).alias("_from"), last.alias("_to"), F.max(zone).alias("_zone"))
    hours = span.filter("_from <= _to").select(
        *by, "_zone", F.explode(F.sequence("_from", "_to", F.expr("INTERVAL 1 HOUR"))).alias("_local")
    )
    h = F.hour("_local")
    business = (h >= first_hour) & (h <= last_hour)
    if weekdays_only:
        business = business & (F.dayofweek("_local").between(2, 6))
    hours = hours.filter(business)
    seen = df.select(*by, local_hour.alias("_local")).distinct()  # never raw events on the build side
    silent = hours.join(seen, [*by, "_local"], "left_anti")
    return silent.select(*by, F.to_utc_timestamp("_local", F.col("_zone")).alias("hour_start"))


def changes_without_events(
    changes: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    change_ts: str,
    event_ts: str,
    min_changes: int = 10,
) -> DataFrame:
    """E7 (second form): days on which the sweep saw at least ``min_changes``
    changed objects but the event feed delivered nothing for that key - a
    silent webhook. Both sides are counted per (key, day) first; only the
    small per-day counts are joined."""
    c = changes.groupBy(*keys, F.to_date(change_ts).alias("day")).agg(F.count(F.lit(1)).alias("n_changes"))
    e = events.groupBy(*keys, F.to_date(event_ts).alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    j = c.join(e, [*keys, "day"], "left").withColumn("n_events", F.coalesce(F.col("n_events"), F.lit(0).cast("bigint")))
    return j.filter((F.col("n_changes") >= min_changes) & (F.col("n_events") == 0))
