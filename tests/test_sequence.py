import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from fieldwise.operators.sequence import ordered_scan


def _brute(rows, gap):
    df = pd.DataFrame(rows, columns=["k", "ts", "id"]).sort_values(["k", "ts", "id"])
    out = {}
    for k, g in df.groupby("k", dropna=False, sort=False):
        prev = None
        start = None
        for _, r in g.iterrows():
            if prev is None or (r.ts - prev).total_seconds() > gap:
                start = r.ts
            out[r.id] = (prev, start)
            prev = r.ts
    return out


def test_ordered_scan_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 40)}"
        ts = base + dt.timedelta(minutes=rnd.randint(0, 20000))
        rows.append((k, ts, i))
    # equal timestamps in one key, settled by the tiebreak
    rows.append(("hot", rows[0][1], 10_000))
    gap = 3600.0
    df = spark.createDataFrame(rows, "k string, ts timestamp, id long")
    got = ordered_scan(df, ["k"], "ts", ["id"], gap_seconds=gap, num_partitions=17).collect()
    want = _brute(rows, gap)
    assert len(got) == len(rows)
    for r in got:
        p, s = want[r.id]
        assert r.prev_ts == (None if p is None else p.to_pydatetime()), r
        assert r.session_start == s.to_pydatetime(), r


def test_ordered_scan_small_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        test_ordered_scan_matches_brute_force_with_hot_key(spark)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_last_mark_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(2500):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        rows.append((k, rnd.randint(0, 5000), i, rnd.random() < 0.3))
    df = spark.createDataFrame(rows, "k string, t long, id long, is_opp boolean")
    got = ordered_scan(df, ["k"], "t", ["id"], num_partitions=13, mark="is_opp", mark_value="id").collect()
    by_key = {}
    for k, t, i, m in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(k, []).append((t, i, m))
    want = {}
    for k, seq in by_key.items():
        last = (None, None)
        for t, i, m in seq:
            if m:
                last = (t, i)
            want[i] = last
    assert len(got) == len(rows)
    for r in got:
        assert (r.last_mark_ts, r.last_mark_value) == want[r.id], r


def test_last_mark_small_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        test_last_mark_matches_brute_force(spark)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_orders_over_2_to_53_stay_exact(spark):
    base = 9_007_199_254_740_993
    rows = [("a", base + i, i, i == 0) for i in range(5)] + [("b", base, 9, False)]
    df = spark.createDataFrame(rows, "k string, t long, id long, is_opp boolean")
    got = {r.id: r for r in ordered_scan(df, ["k"], "t", ["id"], num_partitions=3, mark="is_opp", mark_value="t").collect()}
    assert [got[i].prev_ts for i in range(5)] == [None, base, base + 1, base + 2, base + 3]
    assert {(got[i].last_mark_ts, got[i].last_mark_value) for i in range(5)} == {(base, base)}
    nullable = df.withColumn("v", F.when(F.col("is_opp"), F.col("t")))
    got = {r.id: r for r in ordered_scan(nullable, ["k"], "t", ["id"], num_partitions=3, mark="is_opp", mark_value="v").collect()}
    assert {got[i].last_mark_value for i in range(5)} == {base}
    assert got[9].prev_ts is None and got[9].last_mark_value is None


def test_results_do_not_hang_on_exchange_reuse(spark):
    """Without exchange reuse each branch of a plan draws its own range bounds."""
    old = spark.conf.get("spark.sql.exchange.reuse")
    try:
        for reuse in ("false", "true"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            test_ordered_scan_matches_brute_force_with_hot_key(spark)
            test_last_mark_matches_brute_force(spark)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
