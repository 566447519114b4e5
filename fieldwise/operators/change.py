"""Change, presence and deletion detection over keyed state.

The cheap sweep shows every object in a service-date window but is blind to
money; the costly detail call shows everything. Per object the engine keeps a
state row and decides, per run, who gets the costly call:

    candidate = hash changed  OR  stale (tiered TTL)  OR  forced  OR  resurrected

Absence is only evidence when a *complete* sweep whose window covers the
object's service span did not see it. Everything is a DataFrame function:
state in, state out; the fold is a full outer join on the key, so it
partitions by key and replaying the same batch twice is a no-op.

State columns (besides the key): ``h`` sweep hash, ``t`` last successful
detail time, ``seen`` last sighting, ``sd``/``sdx`` service span as YYYYMMDD
ints, ``ls`` lead status, ``gone`` deletion time, ``gp`` deletion pending
emission, ``g404`` deletion came from a 404.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import to_ymd
from ..functions.json import canonical_hash
from ..functions.time import hours_since

STATE_SCHEMA = T.StructType(
    [
        T.StructField("h", T.StringType()),
        T.StructField("t", T.TimestampType()),
        T.StructField("seen", T.TimestampType()),
        T.StructField("sd", T.LongType()),
        T.StructField("sdx", T.LongType()),
        T.StructField("ls", T.StringType()),
        T.StructField("gone", T.TimestampType()),
        T.StructField("gp", T.BooleanType()),
        T.StructField("g404", T.BooleanType()),
    ]
)
STATE_COLS = [f.name for f in STATE_SCHEMA.fields]

# Default TTLs (hours), the hot window around today (days),
# and the state retention horizon (days).
HOT_TTL_HOURS = 24
COLD_TTL_HOURS = 336
HOT_BEFORE_DAYS = 3
HOT_AFTER_DAYS = 21
PRUNE_DAYS = 120

# Candidate reasons, strongest first.
REASONS = ["resurrected", "new", "changed", "stale", "forced"]


def ymd(d: Column) -> Column:
    """A date as a YYYYMMDD long."""
    return F.date_format(d, "yyyyMMdd").cast("bigint")


def sweep_hash(cols: Sequence[str], jobs_col: str | None = None) -> Column:
    """sha1 over everything the sweep shows (field names sorted, jobs sorted)."""
    names = list(cols) + ([jobs_col] if jobs_col else [])
    return canonical_hash(*names, sort_arrays=[jobs_col] if jobs_col else [])


def service_span(own_date: Column, job_dates: Column | None = None) -> tuple[Column, Column]:
    """(min, max) service date (YYYYMMDD) over the object and its jobs' dates.

    ``job_dates`` is an array of date-ish values (ISO text or YYYYMMDD); values
    that do not parse are ignored, as is a missing own date.
    """
    own = to_ymd(own_date.cast("string"))
    if job_dates is None:
        return own, own
    parsed = F.filter(F.transform(job_dates, lambda x: to_ymd(x.cast("string"))), lambda x: x.isNotNull())
    dates = F.when(own.isNotNull(), F.concat(parsed, F.array(own))).otherwise(parsed)
    return (
        F.when(F.size(dates) > 0, F.array_min(dates)),
        F.when(F.size(dates) > 0, F.array_max(dates)),
    )


def is_stale(
    t: Column,
    sd: Column,
    now,
    today: Column,
    hot_ttl_hours: float = HOT_TTL_HOURS,
    cold_ttl_hours: float = COLD_TTL_HOURS,
) -> Column:
    """Never enriched, or older than the TTL; the TTL is hot when the first
    service date lies in ``[today - 3, today + 21]``, else cold."""
    hot_from = ymd(F.date_sub(today, HOT_BEFORE_DAYS))
    hot_to = ymd(F.date_add(today, HOT_AFTER_DAYS))
    ttl = F.when(sd.isNotNull() & sd.between(hot_from, hot_to), F.lit(float(hot_ttl_hours))).otherwise(
        F.lit(float(cold_ttl_hours))
    )
    age = hours_since(t, now)
    return age.isNull() | (age >= ttl)


def _now(now) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def observe_sweep(
    state: DataFrame,
    sweep: DataFrame,
    keys: Sequence[str],
    now,
    today: Column,
    hot_ttl_hours: float = HOT_TTL_HOURS,
    cold_ttl_hours: float = COLD_TTL_HOURS,
    refresh_stale_hours: float | None = None,
) -> DataFrame:
    """C3 + C4 + C7: sweep rows joined to their state, with the decision.

    ``sweep`` has ``keys``, ``h`` (C1) and ``sd``/``sdx`` (C2). Output: one row
    per swept key with the old state columns prefixed ``old_``, the span to
    keep (new if known, else old) and ``reason`` (null = no detail call).
    """
    return _decided(_sighted(state, sweep, keys, "left"), now, today, hot_ttl_hours, cold_ttl_hours, refresh_stale_hours)


def _sighted(state: DataFrame, sweep: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Sweep rows with their state (``old_`` columns), joined ``how``."""
    old = state.select(*keys, *[F.col(c).alias(f"old_{c}") for c in STATE_COLS])
    new = sweep.select(*keys, "h", F.col("sd").alias("new_sd"), F.col("sdx").alias("new_sdx"), F.lit(True).alias("_swept"))
    return new.join(old, list(keys), how)


def _decided(
    j: DataFrame, now, today: Column, hot_ttl_hours: float, cold_ttl_hours: float, refresh_stale_hours: float | None
) -> DataFrame:
    """C3 + C4: the span to keep and the reason for a detail call of each joined row."""
    n = _now(now)
    sd = F.coalesce(F.col("new_sd"), F.col("old_sd"))
    sdx = F.coalesce(F.col("new_sdx"), F.col("old_sdx"))
    tracked = F.col("old_seen").isNotNull() | F.col("old_h").isNotNull() | F.col("old_t").isNotNull()
    resurrected = F.col("old_gone").isNotNull()
    changed = ~F.col("old_h").eqNullSafe(F.col("h"))
    stale = is_stale(F.col("old_t"), sd, n, today, hot_ttl_hours, cold_ttl_hours)
    if refresh_stale_hours is None:
        forced = F.lit(False)
    else:
        age = hours_since(F.col("old_t"), n)
        forced = age.isNull() | (age >= F.lit(float(refresh_stale_hours)))
    reason = (
        F.when(resurrected, F.lit("resurrected"))
        .when(~tracked, F.lit("new"))
        .when(changed, F.lit("changed"))
        .when(stale, F.lit("stale"))
        .when(forced, F.lit("forced"))
    )
    return j.withColumn("sd", sd).withColumn("sdx", sdx).withColumn("reason", reason)


def decide_and_fold(
    state: DataFrame,
    sweep: DataFrame,
    details: DataFrame,
    keys: Sequence[str],
    now,
    today: Column,
    hot_ttl_hours: float = HOT_TTL_HOURS,
    cold_ttl_hours: float = COLD_TTL_HOURS,
    refresh_stale_hours: float | None = None,
    targeted: DataFrame | None = None,
) -> DataFrame:
    """``observe_sweep`` and ``fold_state`` over one full outer join of state and sweep."""
    j = _decided(_sighted(state, sweep, keys, "full_outer"), now, today, hot_ttl_hours, cold_ttl_hours, refresh_stale_hours)
    j = j.select(
        *keys,
        *[F.col(f"old_{c}").alias(c) for c in STATE_COLS],
        "_swept",
        F.col("h").alias("_h"),
        F.col("sd").alias("_sd"),
        F.col("sdx").alias("_sdx"),
        F.when(F.col("_swept"), F.col("reason")).alias("reason"),
    )
    return _fold(j, details, keys, now, targeted)


def enrichment_candidates(observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C4: all keys that get the costly detail call, with the rank of their reason.

    A caller with a budget takes them by ``reason_rank``, then key; the rest
    waits for the next run, because their state is not advanced.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in REASONS]), F.col("reason"))
    return observed.filter(F.col("reason").isNotNull()).select(*keys, "reason", rank.alias("reason_rank"))


def fold_state(
    state: DataFrame,
    observed: DataFrame,
    details: DataFrame,
    keys: Sequence[str],
    now,
    targeted: DataFrame | None = None,
) -> DataFrame:
    """C7 + C10 + C6: the new state after one sweep and its detail results.

    ``details`` has ``keys``, ``ok`` (detail fetched), ``missing`` (404) and
    ``ls`` (lead status); keys without a result keep their watermark (retry
    next run). Sighting records ``seen``, keeps the freshest span and clears a
    deletion marker; only a successful detail call advances ``h`` and ``t``.
    A 404 marks the key gone with ``g404``.

    ``targeted`` (same columns as ``details``) holds details read by id, swept
    or not: a 404 marks the key gone at once; a success advances ``t`` and
    ``seen``, keeps the hash of the last sweep and clears a deletion marker.
    """
    obs = observed.select(
        *keys, F.lit(True).alias("_swept"), F.col("h").alias("_h"), F.col("sd").alias("_sd"), F.col("sdx").alias("_sdx"), "reason"
    )
    return _fold(state.join(obs, list(keys), "full_outer"), details, keys, now, targeted)


def _fold(j: DataFrame, details: DataFrame, keys: Sequence[str], now, targeted: DataFrame | None) -> DataFrame:
    """The new state from state and sweep side by side, and the detail results."""
    n = _now(now)
    det = details.select(*keys, F.col("ok").alias("_ok"), F.col("missing").alias("_missing"), F.col("ls").alias("_ls"))
    j = j.join(det, list(keys), "left")
    swept = F.coalesce(F.col("_swept"), F.lit(False))
    called = swept & F.col("reason").isNotNull()
    ok = called & F.coalesce(F.col("_ok"), F.lit(False)) & ~F.coalesce(F.col("_missing"), F.lit(False))
    missing = called & F.coalesce(F.col("_missing"), F.lit(False))
    lead_status = F.nullif(F.trim(F.col("_ls")), F.lit(""))
    if targeted is not None:
        by_id = targeted.select(
            *keys, F.col("ok").alias("_tok"), F.col("missing").alias("_tmissing"), F.col("ls").alias("_tls")
        )
        j = j.join(by_id, list(keys), "full_outer")
        swept = F.coalesce(F.col("_swept"), F.lit(False))
        t_missing = F.coalesce(F.col("_tmissing"), F.lit(False))
        t_ok = F.coalesce(F.col("_tok"), F.lit(False)) & ~t_missing
        missing = (missing | t_missing) & ~t_ok
        sighted = swept | t_ok
        lead_status = F.when(t_ok, F.nullif(F.trim(F.col("_tls")), F.lit(""))).otherwise(lead_status)
    else:
        t_ok, sighted = F.lit(False), swept
    return j.select(
        *keys,
        F.when(ok, F.col("_h")).otherwise(F.col("h")).alias("h"),
        F.when(ok | t_ok, n).otherwise(F.col("t")).alias("t"),
        F.when(sighted, n).otherwise(F.col("seen")).alias("seen"),
        F.when(swept, F.col("_sd")).otherwise(F.col("sd")).alias("sd"),
        F.when(swept, F.col("_sdx")).otherwise(F.col("sdx")).alias("sdx"),
        F.when(ok | t_ok, lead_status).otherwise(F.col("ls")).alias("ls"),
        F.when(missing, n).when(sighted, F.lit(None).cast("timestamp")).otherwise(F.col("gone")).alias("gone"),
        F.when(missing, F.lit(True)).when(sighted, F.lit(None).cast("boolean")).otherwise(F.col("gp")).alias("gp"),
        F.when(missing, F.lit(True)).when(sighted, F.lit(None).cast("boolean")).otherwise(F.col("g404")).alias("g404"),
    )


def last_complete_sweep(manifest: DataFrame, instance: str = "source_instance_id") -> DataFrame:
    """Per instance, the newest sweep that paginated to completion.

    ``manifest`` rows: instance, ``at``, ``from``/``to`` (YYYYMMDD), ``complete``.
    A truncated sweep never advances the reference point.
    """
    done = manifest.filter(F.col("complete"))
    row = F.struct("at", F.col("from").alias("from"), F.col("to").alias("to"))
    return done.groupBy(instance).agg(F.max_by(row, F.col("at")).alias("_s")).select(
        instance,
        F.col("_s.at").alias("sweep_at"),
        F.col("_s.from").alias("sweep_from"),
        F.col("_s.to").alias("sweep_to"),
    )


def detect_deletions(
    state: DataFrame, sweeps: DataFrame, keys: Sequence[str], now, instance: str = "source_instance_id"
) -> DataFrame:
    """Mark keys the last complete sweep should have seen but did not.

    Not already gone, last seen before that sweep, with a service span that
    overlaps the sweep window. Returns the state with ``gone``/``gp`` set.
    ``sweeps`` (C8 output) is one row per instance - broadcast-sized.
    """
    n = _now(now)
    j = state.join(sweeps, instance, "left")
    vanished = (
        F.col("gone").isNull()
        & F.col("sweep_at").isNotNull()
        & F.col("seen").isNotNull()
        & (F.col("seen") < F.col("sweep_at"))
        & F.col("sd").isNotNull()
        & F.col("sdx").isNotNull()
        & ~((F.col("sdx") < F.col("sweep_from")) | (F.col("sd") > F.col("sweep_to")))
    )
    return j.select(
        *keys,
        *[c for c in STATE_COLS if c not in ("gone", "gp")],
        F.when(vanished, n).otherwise(F.col("gone")).alias("gone"),
        F.when(vanished, F.lit(True)).otherwise(F.col("gp")).alias("gp"),
    ).select(*keys, *STATE_COLS)


def emit_deletions(state: DataFrame, keys: Sequence[str], extracted_at) -> DataFrame:
    """C5 + C6: deletion rows for pending markers, labelled by how they were found."""
    n = _now(extracted_at)
    return state.filter(F.coalesce(F.col("gp"), F.lit(False))).select(
        *keys,
        n.alias("_deleted_at"),
        F.when(F.coalesce(F.col("g404"), F.lit(False)), F.lit("detail_404"))
        .otherwise(F.lit("sweep_disappearance"))
        .alias("_delete_source"),
    )


def clear_pending(state: DataFrame) -> DataFrame:
    """After emission the pending flag is consumed."""
    return state.withColumn("gp", F.lit(None).cast("boolean"))


def prune_state(state: DataFrame, now, today: Column, days: int = PRUNE_DAYS) -> DataFrame:
    """Drop keys whose span ended more than ``days`` ago, or that have no
    span and were last enriched more than ``days`` ago."""
    n = _now(now)
    before = ymd(F.date_sub(today, days))
    old_span = F.col("sdx").isNotNull() & (F.col("sdx") < before)
    old_unspanned = F.col("sdx").isNull() & (F.coalesce(hours_since(F.col("t"), n), F.lit(0.0)) > days * 24)
    return state.filter(~(old_span | old_unspanned))


def migrate_legacy(
    hashes: DataFrame, keys: Sequence[str], now, seen: DataFrame | None = None, prior: DataFrame | None = None, state: DataFrame | None = None
) -> DataFrame:
    """C11: the old layout as state rows, ``t`` seeded to now so the first run after migration
    does not re-enrich everything at once.

    The old layout is three maps: ``id -> hash`` and the ids ``seen`` and ``prior``. The hashes
    alone become rows: an id that was only seen has no hash to compare with, so the
    next sweep finds it new. A ``state`` that has rows is the new layout already and
    is returned as it is, with ids of the old maps that it lacks left out.
    """
    if state is not None and not state.isEmpty():
        return state
    for ids in (seen, prior):
        if ids is not None and set(keys) - set(ids.columns):
            raise ValueError(f"a legacy id map lacks {sorted(set(keys) - set(ids.columns))}")
    n = _now(now)
    cols = {c: F.lit(None).cast(STATE_SCHEMA[c].dataType) for c in STATE_COLS}
    cols["h"] = F.col("h")
    cols["t"] = n
    return hashes.select(*keys, *[v.alias(k) for k, v in cols.items()])
