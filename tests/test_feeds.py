"""Feeds with state: stream = batch, guards across batches, late rows that are not lost."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from fieldwise.operators import events as ops
from fieldwise.streaming import events as st
from fieldwise.streaming.drain import GuardedLog, RetryDrain
from fieldwise.streaming.late import LateAwareDrain
from fieldwise.streaming.stateful import silence_stream

D = dt.datetime
DAY = dt.timedelta(days=1)
T0 = D(2026, 6, 1, 12)
EVENTS = "event_id bigint, received_at timestamp, dedupe_hash string, payload string"


def run(spark, tmp_path, batches, schema, build, name):
    """Each batch lands and is drained; what the stream has put out at the end."""
    land, out, query = f"{tmp_path}/{name}-in", f"{tmp_path}/{name}-out", f"{name}-{uuid.uuid4().hex}"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        feed = st.event_stream(spark, land, spark.createDataFrame([], schema).schema, "parquet")
        st.run_available(build(feed), query, st.batch_writer(out))
    return spark.read.parquet(out)


def chain_rows():
    rows = [(i, T0 + 6 * i * DAY, "chain", None) for i in range(9)]  # six days apart: every second one is kept
    rows += [(20, T0, "tie", "a"), (21, T0, "tie", "b"), (22, T0 + 7 * DAY, "tie", "c"), (23, T0 + 7 * DAY + dt.timedelta(microseconds=1), "tie", "d")]
    rows += [(30 + i, T0 + i * dt.timedelta(hours=5), "busy", 'x "quoted"') for i in range(100)]
    return sorted(rows, key=lambda r: r[1])


def test_the_replay_rule_is_one_in_stream_and_batch(spark, tmp_path):
    rows = chain_rows()
    end = [(999, T0 + 100 * DAY, "end", None)]
    batch = spark.createDataFrame(rows, EVENTS)
    want = sorted(r.event_id for r in ops.dedupe_replays(batch, "dedupe_hash", "received_at", 7 * 86_400, ["event_id"]).collect())
    assert {0, 2, 4, 6, 8, 20, 23} <= set(want) and not {1, 3, 21, 22} & set(want)
    dedupe = lambda f: st.dedupe_stream(f, "7 days", tiebreak="event_id", buckets=3)
    cut = [rows[:40], rows[40:90], rows[90:], end]
    got = run(spark, tmp_path, cut, EVENTS, dedupe, "a").filter("event_id <> 999")
    assert sorted(r.event_id for r in got.collect()) == want
    kept = {r.event_id: tuple(r) for r in got.select("event_id", "received_at", "dedupe_hash", "payload").collect()}
    assert kept[23] == rows[[r[0] for r in rows].index(23)]  # whole rows, to the microsecond
    # a batch that is delivered again, and rows that arrive out of order within the lateness
    late = lambda f: st.dedupe_stream(f, "7 days", lateness="20 days", tiebreak="event_id", buckets=3)
    mixed = [rows[60:90], rows[:60], rows[:60], rows[90:], end]
    got = run(spark, tmp_path, mixed, EVENTS, late, "b").filter("event_id <> 999")
    settled = [r[0] for r in rows if r[0] in want and r[1] <= T0 + 80 * DAY]
    assert sorted(r.event_id for r in got.collect()) == sorted(settled)


FEED = "received_at timestamp, feed string, tz string"


def test_silence_is_an_alert_without_an_event(spark, tmp_path):
    la, kolkata = "America/Los_Angeles", "Asia/Kolkata"
    hours = lambda day, *hs: [D(2026, 6, day, h, 20) for h in hs]
    rows = [(t, "west", la) for t in hours(1, 16, 17, 23)] + [(t, "india", kolkata) for t in hours(1, 3, 9)] + [(t, "clock", "UTC") for t in hours(1, 0, 23)]
    more = [(t, "clock", "UTC") for t in [*hours(2, 6, 12), *hours(6, 12), *hours(8, 20)]]  # the other feeds are silent for a week
    watch = lambda f: silence_stream(f, ["feed"], "tz", lateness="10 minutes")
    got = run(spark, tmp_path, [rows, more[:2], more[2:]], FEED, watch, "s")
    until = F.lit(max(t for t, *_ in more) - dt.timedelta(minutes=10))
    batch = spark.createDataFrame(rows + more, FEED)
    want = ops.silent_hours(batch, "received_at", ["feed"], zone_col="tz", until=until)
    rows_of = lambda df: sorted((r.feed, r.hour_start) for r in df.collect())
    assert rows_of(got) == rows_of(want)
    west = [h for f, h in rows_of(got) if f == "west"]
    assert D(2026, 6, 1, 18) in west and D(2026, 6, 1, 17) not in west and D(2026, 6, 6, 18) not in west  # a Saturday
    assert D(2026, 6, 2, 2, 30) in [h for f, h in rows_of(got) if f == "india"]  # 08:00 in Kolkata


def test_a_replay_in_another_batch_lands_once(spark, tmp_path):
    log, rows = GuardedLog(f"{tmp_path}/log"), chain_rows()
    frames = [spark.createDataFrame(x, EVENTS) for x in (rows[:50], rows[50:], rows[30:60])]
    for i, frame in enumerate(frames):
        log(frame, i)
    log(frames[1], 1)  # the engine runs a batch again
    got = sorted(r.event_id for r in log.events(spark, frames[0].schema).collect())
    want = ops.dedupe_replays(spark.createDataFrame(rows, EVENTS), "dedupe_hash", "received_at", 7 * 86_400, ["event_id"])
    assert got == sorted(r.event_id for r in want.collect())
    # a status that returns after the bound is an event again; the days before are not read
    log(spark.createDataFrame([(500, T0 + 60 * DAY, "chain", None)], EVENTS), 3)
    assert 500 in [r.event_id for r in log.events(spark, frames[0].schema).collect()]


def test_the_fifth_failure_is_a_dead_letter_once(spark, tmp_path):
    schema = "event_id bigint, received_at timestamp"
    fails = lambda rows: rows.withColumn("error", F.when(F.col("event_id") == 1, "timeout").when((F.col("event_id") == 2) & (F.coalesce("process_attempts", F.lit(0)) < 3), "busy"))
    drain = RetryDrain(f"{tmp_path}/retry", fails, spark.createDataFrame([], schema).schema)
    first = spark.createDataFrame([(1, T0), (2, T0), (3, T0)], schema)
    nothing = first.limit(0)
    seen = []
    for i in range(7):
        drain(first if i in (0, 5) else nothing, i)
        seen.append(sorted((r.event_id, r.process_attempts) for r in drain.table(spark, "queue").collect()))
    assert seen[:4] == [[(1, 1), (2, 1)], [(1, 2), (2, 2)], [(1, 3), (2, 3)], [(1, 4)]] and seen[4] == []
    dead = lambda: [tuple(r) for r in drain.table(spark, "dead_letter").collect()]
    assert dead() == [(1, "timeout", 5)]
    for i in range(7, 11):  # event 1 came once more in batch 5 and fails five times again
        drain(nothing, i)
    drain(nothing, 9)  # run again
    assert dead() == [(1, "timeout", 5)] and drain.table(spark, "queue").isEmpty()


def test_late_rows_are_counted_and_revise_windows(spark, tmp_path):
    schema = "event_id bigint, received_at timestamp, event_type string"
    at = lambda h, m=0: T0 + dt.timedelta(hours=h, minutes=m)
    batches = [
        [(1, at(0), "a"), (2, at(0, 30), "a"), (3, at(5), "b"), (4, None, "a")],
        [(5, at(0, 40), "a"), (6, at(4, 30), "b"), (7, at(9), "a")],  # 5 is late: the watermark is at hour 4
        [(8, at(8, 0), "a"), (9, at(8, 1), "a"), (10, at(1), "c"), (11, at(20), "a")],
    ]
    drain = LateAwareDrain(f"{tmp_path}/late", spark.createDataFrame([], schema).schema, "1 HOUR", "1 hour", ["event_type"])
    for i, rows in enumerate(batches):
        for _ in range(2 if i == 1 else 1):
            drain(spark.createDataFrame(rows, schema), i)
    ids = lambda name: sorted(r.event_id for r in drain.rows(spark, name).collect())
    assert ids("late") == [5, 8, 10] and ids("on_time") == [1, 2, 3, 4, 6, 7, 9, 11]
    got = {(r.event_type, r.window_start): (r.n_on_time, r.n_late, r.n_events, r.closed) for r in drain.windows(spark).collect()}
    assert got["a", at(0)] == (2, 1, 3, True) and got["c", at(1)] == (0, 1, 1, True) and got["a", at(8)] == (1, 1, 2, True)
    assert got["a", at(20)] == (1, 0, 1, False) and sum(n for *_, n, _ in got.values()) == 10
    sessions = {(r.event_type, r.session_start): r.n_events for r in drain.revised_sessions(spark, ["event_type"], 3600, ["event_id"]).collect()}
    assert sessions["a", at(0)] == 3 and sessions["c", at(1)] == 1 and not any(k == "b" for k, _ in sessions)
