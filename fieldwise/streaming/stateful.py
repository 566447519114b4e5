"""Event-feed operators that keep their own state for each key.

Both decide in event-time order, once the watermark has passed, whatever order rows
arrive in: rows that are not behind the watermark wait in the key's state, and a
timer at their time settles them. The results are those of the batch forms in
``fieldwise.operators.events`` over everything the watermark has passed.

A replay guard holds something of each delivery, so its states travel in bulk, with the
rows (``applyInPandasWithState``); a watch has one for each feed and uses timers of its
own (``transformWithState``, which needs Spark's RocksDB store). Either keeps its
checkpoints in the shared folder.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections.abc import Iterator, Sequence
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

# The processors run in Python workers: pickled by value, so executors need pandas only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_US = 3_600_000_000
#: Timestamps as text that keeps microseconds.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def ensure_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store; a session that names one of its own keeps it."""
    current = spark.conf.get(STATE_STORE, None)
    if current is None or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKS_DB)


def _ms(us: int) -> int:
    """The first millisecond that is not before a time in microseconds."""
    return -(-us // 1000)


#: Hashes that share a bucket: its state is a few hundred kB, and as much again in a Python worker.
HASHES_PER_BUCKET = 2_000


def buckets_for(hashes: int, least: int = 64) -> int:
    """As many buckets as that many delivery hashes need, so that a bucket does not grow with the feed."""
    return max(least, -(-hashes // HASHES_PER_BUCKET))


def settle_replays(delay_us: int):
    """The step of one bucket of delivery hashes. Its state, as JSON: of each hash the time of its
    last kept delivery, and the deliveries that wait for the watermark, ``[last, [[at, tie, row], ...]]``."""

    def settle(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        hashes = json.loads(state.get[0]) if state.exists else {}
        passed = state.getCurrentWatermarkMs() * 1000
        for pdf in batches:
            columns = [pdf[c].tolist() for c in ("hash_key", "at_us", "tie", "row_json")]
            for name, at, tie, row in zip(*columns, strict=True):
                held = hashes.setdefault(name, [None, []])
                if held[0] is None or at - held[0] > delay_us:  # else it is a replay, whatever comes
                    held[1].append([at, tie, row])
        out, due = [], []
        for name, (last, waiting) in list(hashes.items()):
            waiting.sort()
            rest = [w for w in waiting if w[0] > passed]
            for at, _, row in waiting[: len(waiting) - len(rest)]:
                if last is None or at - last > delay_us:
                    out.append(row)
                    last = at
            # of interest again once the watermark has passed the next row, or the bound
            next_at = _ms(rest[0][0]) - 1 if rest else _ms(last + delay_us)
            if rest or next_at * 1000 > passed:
                hashes[name] = [last, rest]
                due.append(next_at)
            else:
                del hashes[name]  # whatever comes now is behind the bound
        if hashes:
            state.update((json.dumps(hashes),))
            state.setTimeoutTimestamp(max(min(due), passed // 1000))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"row_json": pd.Series(out, dtype=object)})

    return settle


def dedupe_stream(
    df: DataFrame,
    delay: str = "7 days",
    ts: str = "received_at",
    key: str = "dedupe_hash",
    lateness: str = "0 seconds",
    tiebreak: str | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Drop a delivery at most ``delay`` after the last *kept* one of its hash.

    The rule of ``operators.events.dedupe_replays``, row by row: a replay does not
    extend the ban, and a status that returns after the bound comes through (trap
    T2). Rows may arrive out of order by ``lateness``; each is settled once the
    watermark has passed it, equal times by ``tiebreak``. Of a hash the state holds
    one time and the rows not yet settled that may be kept, and goes when the bound
    is over. Hashes share ``buckets`` states, since a call a state costs far more than
    a hash does; a bucket's state is read and written whole, so choose some thousand hashes a
    bucket (``buckets_for``; a feed keeps the number it began with). Rows without a key or a time are dropped, as they cannot be settled.
    """
    tie = F.col(tiebreak) if tiebreak else F.lit(0)
    integral = not tiebreak or isinstance(df.schema[tiebreak].dataType, T.IntegralType)
    delay_us = int(pd.Timedelta(delay).total_seconds() * 1_000_000)
    rows = df.withWatermark(ts, lateness).filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), F.col(key).cast("string").alias("hash_key"), F.col(ts), F.unix_micros(ts).alias("at_us"), tie.cast("bigint" if integral else "string").alias("tie"),
        F.to_json(F.struct(*df.columns), JSON_TIMES).alias("row_json"),
    )
    kept = rows.groupBy("bucket").applyInPandasWithState(
        settle_replays(delay_us), "row_json string", "hashes string", "append", GroupStateTimeout.EventTimeTimeout
    )
    return kept.select(F.from_json("row_json", df.schema, JSON_TIMES).alias("r")).select("r.*")


class SilenceWatch(StatefulProcessor):
    """State of one feed: hours with events that are not settled yet, and the next hour to settle."""

    def __init__(self, first_hour: int, last_hour: int, weekdays_only: bool) -> None:
        self.first_hour, self.last_hour, self.weekdays_only = first_hour, last_hour, weekdays_only

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "hour bigint", "n bigint")
        self.next = handle.getValueState("next", "hour bigint, zone string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours: set[int] = set()
        zone = None
        for pdf in rows:
            hours.update(pdf["hour_us"].unique().tolist())
            zone = pdf["zone"].iloc[-1]
        for hour in hours:
            self.seen.updateValue((hour,), (1,))
        if not self.next.exists():
            self.next.update((min(hours), zone))
            self.handle.registerTimer(_ms(min(hours) + HOUR_US))
        elif min(hours) < self.next.get()[0]:  # out of order before anything was settled
            self.next.update((min(hours), self.next.get()[1]))
            self.handle.registerTimer(_ms(min(hours) + HOUR_US))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        hour, zone = self.next.get()
        silent = []
        seen = {h for (h,) in self.seen.keys()}
        while hour + HOUR_US <= passed:
            if hour not in seen and self.is_business(hour, zone):
                silent.append(hour)
            hour += HOUR_US
        for h in seen:
            if h < hour:
                self.seen.removeKey((h,))
        self.next.update((hour, zone))
        self.handle.registerTimer(_ms(self.next_business(hour, zone) + HOUR_US))  # fires without an event
        k = key[0] if isinstance(key, tuple) else key
        yield pd.DataFrame({"feed": pd.Series([k] * len(silent), dtype=object), "hour_us": pd.Series(silent, dtype="int64")})

    def is_business(self, hour_us: int, zone: str) -> bool:
        local = dt.datetime.fromtimestamp(hour_us // 1_000_000, ZoneInfo(zone))
        return self.first_hour <= local.hour <= self.last_hour and not (self.weekdays_only and local.weekday() > 4)

    def next_business(self, hour_us: int, zone: str) -> int:
        while not self.is_business(hour_us, zone):
            hour_us += HOUR_US
        return hour_us

    def close(self) -> None:
        pass


def silence_stream(
    df: DataFrame,
    by: Sequence[str],
    zone_col: str,
    ts: str = "received_at",
    lateness: str = "10 minutes",
    first_hour: int = 8,
    last_hour: int = 17,
    weekdays_only: bool = True,
) -> DataFrame:
    """An alert row for every business hour of a feed without an event, as soon as the
    watermark has passed the hour's end.

    Feeds are named by ``by``; hours are those of the feed's own zone (``zone_col``,
    one zone a feed). A timer at the end of the next business hour raises the alert,
    so it needs no event of its own feed: events of other feeds move the watermark.
    The rows are those of ``operators.events.silent_hours`` with ``until`` set to the
    watermark: (by ..., hour_start).
    """
    ensure_state_store(df.sparkSession)
    # an hour of the wall clock, as an instant: zones are offset by parts of an hour
    into_hour = F.unix_micros(F.from_utc_timestamp(F.col(ts), F.col(zone_col))) % HOUR_US
    feed = F.to_json(F.struct(*by)).alias("state_key")
    rows = df.withWatermark(ts, lateness).select(feed, F.col(ts), F.col(zone_col).alias("zone"), (F.unix_micros(ts) - into_hour).alias("hour_us"))
    alerts = rows.groupBy("state_key").transformWithStateInPandas(
        statefulProcessor=SilenceWatch(first_hour, last_hour, weekdays_only),
        outputStructType="feed string, hour_us bigint",
        outputMode="append",
        timeMode="eventTime",
    )
    names = T.StructType([df.schema[c] for c in by])
    return alerts.select(F.from_json("feed", names).alias("k"), F.timestamp_micros("hour_us").alias("hour_start")).select("k.*", "hour_start")
