import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from fieldwise.operators.resolve import latest_by_source
from fieldwise.streaming import events as st


def _write_events(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as fh:
            for r in rows:
                fh.write(json.dumps(r) + "\n")
        # the file source takes files in modification-time order: make arrival explicit
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def _ev(eid, ts, res, status, etype="opportunity-status-changed", attempts=0, err=None):
    return {
        "event_id": eid,
        "received_at": ts.strftime("%Y-%m-%dT%H:%M:%S"),
        "source_instance_id": "a",
        "entity_id": "t",
        "event_type": etype,
        "resource_id": res,
        "payload": json.dumps({"id": res, "status": status}),
        "process_attempts": attempts,
        "last_error": err,
    }


BASE = dt.datetime(2026, 8, 1, 9, 0, 0)


def _batches():
    h = dt.timedelta(hours=1)
    return [
        [_ev(1, BASE, "r1", 1), _ev(2, BASE + h, "r1", 3), _ev(3, BASE, "r2", 4)],
        # late event for r1 (older than the state) and a replay of event 3
        [_ev(4, BASE + 0.5 * h, "r1", 30), _ev(5, BASE, "r2", 4), _ev(6, BASE + 2 * h, "r2", 10)],
        [_ev(7, BASE + 3 * h, "r1", 1), _ev(8, BASE + 3 * h, "r3", 0, "job-closed", attempts=5, err="timeout")],
        # a later event moves the watermark past the bound; the same status
        # returning after that is a new event again
        [_ev(10, BASE + 15 * 24 * h, "r4", 0)],
        [_ev(11, BASE + 15 * 24 * h, "r5", 0)],
        [_ev(9, BASE + 15 * 24 * h + h, "r1", 1)],
    ]


def test_status_ledger_streaming_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="fw-stream-", dir="/tmp")
    src, out = os.path.join(root, "in"), os.path.join(root, "out")
    _write_events(src, _batches())
    stream = st.event_stream(spark, src, max_files_per_trigger=1).withColumn(
        "status_code", F.get_json_object("payload", "$.status").cast("int")
    )
    st.run_available(st.status_ledger_stream(stream), "ledger-test-" + os.path.basename(root), st.batch_writer(out), "update")
    emitted = spark.read.parquet(out)
    final = latest_by_source(
        emitted.withColumn("source", F.lit("ledger")), ["key"], priority=None, tiebreak=["event_id"]
    ).select("key", "status_code")
    batch = spark.read.schema(st.EVENT_SCHEMA).json(src).withColumn(
        "status_code", F.get_json_object("payload", "$.status").cast("int")
    )
    want = latest_by_source(
        batch.select(F.col("resource_id").alias("key"), F.lit("w").alias("source"), F.col("received_at").alias("observed_at"), "event_id", "status_code"),
        ["key"], priority=None, tiebreak=["event_id"],
    ).select("key", "status_code")
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, want.collect()))
    # the late status 30 for r1 never became current
    assert 30 not in [r.status_code for r in emitted.filter("key = 'r1'").collect()]


def test_drain_routes_and_dead_letters(spark):
    root = tempfile.mkdtemp(prefix="fw-drain-", dir="/tmp")
    src, out = os.path.join(root, "in"), os.path.join(root, "out")
    _write_events(src, _batches())
    stream = st.event_stream(spark, src)
    st.run_available(stream, "drain-test-" + os.path.basename(root), st.drain_writer(out))
    dead = spark.read.parquet(os.path.join(out, "dead_letter")).collect()
    assert [(r.event_id, r.error) for r in dead] == [(8, "timeout")]
    processed = spark.read.parquet(os.path.join(out, "processed")).count()
    assert processed == 10


def test_debounce_and_rate_streams_equal_batch(spark):
    from fieldwise.operators import events as ev_ops

    root = tempfile.mkdtemp(prefix="fw-sess-", dir="/tmp")
    src = os.path.join(root, "in")
    _write_events(src, _batches())
    # debounce: sessions of one resource (gap 2 hours); the last session closes only
    # when the watermark passes it, so compare the sessions that are closed
    out_s = os.path.join(root, "sessions")
    stream = st.event_stream(spark, src, max_files_per_trigger=1)
    st.run_available(
        st.debounce_stream(stream, ["resource_id"], gap="2 hours", watermark="1 hour"),
        "sess-" + os.path.basename(root), st.batch_writer(out_s),
    )
    got = {(r.resource_id, r.first_at, r.n_events) for r in spark.read.parquet(out_s).collect()}
    batch = spark.read.schema(st.EVENT_SCHEMA).json(src)
    want = {
        (r.resource_id, r.session_start, r.n_events)
        for r in ev_ops.debounce(batch, ["resource_id"], "received_at", 2 * 3600, tiebreak=["event_id"]).collect()
    }
    assert got and got <= want
    # rate: 25-minute tumbling windows aligned to the epoch, same counts as batch
    out_r = os.path.join(root, "rate")
    st.run_available(
        st.event_rate_stream(st.event_stream(spark, src, max_files_per_trigger=1), "25 minutes", watermark="1 hour"),
        "rate-" + os.path.basename(root), st.batch_writer(out_r),
    )
    got_r = {(r.event_type, r.window_start, r.n_events) for r in spark.read.parquet(out_r).collect()}
    want_r = {
        (r.event_type, r.window_start, r.n_events)
        for r in ev_ops.event_rate(batch, "received_at", "25 minutes", ["event_type"]).collect()
    }
    assert got_r and got_r <= want_r
