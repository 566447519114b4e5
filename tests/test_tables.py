"""Tables kept in partitions and versions: what a write touches, and what readers see meanwhile."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fieldwise.operators import partitioned
from fieldwise.operators.incremental import fold_latest, latest_state
from fieldwise.operators.joins import interval_join, range_join
from fieldwise.operators.resolve import latest_by_source
from fieldwise.plans import publish
from fieldwise.plans import registry as reg
from fieldwise.sources import files

D = dt.datetime


def parquet_files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def partitions(names):
    return {os.path.dirname(n) for n in names}


ORDERS = "id bigint, month string, v string"


def test_an_upsert_rewrites_the_partitions_it_touches(spark, tmp_path):
    path = f"{tmp_path}/t"
    load = spark.createDataFrame([(i, f"2026-{i % 5 + 1:02d}", "a") for i in range(50)], ORDERS)
    assert partitioned.upsert_partitions(spark, path, load, ["month", "id"], ["month"]) == 5
    before = parquet_files(path)
    batch = spark.createDataFrame([(0, "2026-01", "b"), (100, "2026-01", "c"), (1, "2026-02", "a"), (7, "2026-09", None)], ORDERS)
    assert partitioned.upsert_partitions(spark, path, batch, ["month", "id"], ["month"]) == 2  # 2026-02 holds its row already
    after = parquet_files(path)
    assert partitions(before - after) == {"month=2026-01"} and partitions(after - before) == {"month=2026-01", "month=2026-09"}
    rows = {(r.id, r.month): r.v for r in partitioned.read_partitioned(spark, path, load.schema).collect()}
    assert len(rows) == 52 and rows[0, "2026-01"] == "b" and rows[100, "2026-01"] == "c" and rows[7, "2026-09"] is None and rows[1, "2026-02"] == "a"
    assert partitioned.upsert_partitions(spark, path, batch, ["month", "id"], ["month"]) == 0  # a replay
    assert parquet_files(path) == after


def test_upserts_beyond_the_named_partitions_and_batch_duplicates(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    monkeypatch.setattr(partitioned, "MAX_NAMED", 2)
    rows = spark.createDataFrame([(i, f"{i % 4}", "a", i) for i in range(20)], "id bigint, p string, v string, n bigint")
    partitioned.upsert_partitions(spark, path, rows, ["p", "id"], ["p"])
    twice = spark.createDataFrame([(1, "1", "old", 1), (1, "1", "new", 2), (2, "2", "x", 1), (3, "3", "y", 1)], rows.schema)
    for most in (2, 10_000):
        touched = twice.select("p").distinct()
        assert partitioned.in_partitions(rows, touched, ["p"], most).count() == 15
    assert partitioned.upsert_partitions(spark, path, twice, ["p", "id"], ["p"], order=["n"]) == 3
    got = {r.id: r.v for r in partitioned.read_partitioned(spark, path, rows.schema).collect()}
    assert (got[1], got[2], got[3], got[0], len(got)) == ("new", "x", "y", "a", 20)


def test_retention_removes_whole_generations(spark, tmp_path):
    path = f"{tmp_path}/g"
    times = [D(2026, 7, 1, 8), D(2026, 7, 1, 12), D(2026, 7, 2, 5), D(2026, 7, 2, 20), D(2026, 8, 12, 6), D(2026, 8, 12, 7)]
    rows = spark.createDataFrame([(i, inst, t) for inst in ("a", "b") for i, t in enumerate(times)], "id int, source_instance_id string, at timestamp")
    rows = rows.withColumn("generated", partitioned.generation_name("at"))
    partitioned.overwrite_partitions(rows, path, ["source_instance_id", "generated"])
    before = parquet_files(path)
    zones = spark.createDataFrame([("a", "America/Los_Angeles")], "source_instance_id string, timezone string")
    gone = partitioned.drop_generations(spark, path, "2026-08-13 00:00:00", zones)
    left = partitioned.read_partitioned(spark, path, rows.schema).groupBy("source_instance_id").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
    # in Los Angeles the third one (22:00 the day before) is the newest of July 1; in UTC it is of July 2
    assert {r[0]: r[1] for r in left} == {"a": [2, 3, 4, 5], "b": [1, 3, 4, 5]}
    assert len(gone) == 4 and parquet_files(path) < before
    assert partitioned.drop_generations(spark, path, "2026-08-13 00:00:00", zones) == []


OBS = "k bigint, source string, observed_at timestamp, n bigint, a string"


def test_latest_folded_forward_equals_latest_over_all(spark, tmp_path):
    path, r = f"{tmp_path}/latest", random.Random(4)
    rows = [(r.randrange(40), r.choice("xyz"), None if r.random() < 0.05 else D(2026, 1, 1) + dt.timedelta(hours=r.randrange(90)), n, r.choice(["p", None])) for n in range(600)]
    obs = spark.createDataFrame(rows, OBS)
    for i in range(4):
        fold_latest(spark, path, obs.filter(F.col("n") % 4 == i), ["k"], priority=None, tiebreak=["n"], buckets=8)
    want = sorted(map(tuple, latest_by_source(obs, ["k"], priority=None, tiebreak=["n"]).select("k", "source", "observed_at", "n", "a").collect()), key=repr)
    state = lambda: latest_state(spark, path, obs.schema)
    assert sorted(map(tuple, state().select("k", "source", "observed_at", "n", "a").collect()), key=repr) == want
    before = parquet_files(path)
    assert fold_latest(spark, path, obs.filter(F.col("n") % 4 == 1), ["k"], priority=None, tiebreak=["n"], buckets=8) == 0
    one = spark.createDataFrame([(3, "x", D(2027, 1, 1), 9_999, "new")], OBS)
    assert fold_latest(spark, path, one, ["k"], priority=None, tiebreak=["n"], buckets=8) == 1
    after = parquet_files(path)
    assert len(partitions(before - after)) == 1 == len(partitions(after - before))
    assert state().filter("k = 3 and source = 'x'").first().a == "new"


def test_a_reader_keeps_its_version_through_builds_and_failures(spark, tmp_path):
    base = f"{tmp_path}/p"
    first = publish.publish(spark.createDataFrame([(1, "a")], "id bigint, v string"), base)
    reader = publish.current(spark, base)
    broken = spark.range(3).select("id", F.assert_true(F.col("id") < 2).cast("string").alias("v"))
    with pytest.raises(Exception):
        publish.publish(broken, base)  # fails while it is written
    with pytest.raises(publish.ContractError):
        publish.publish(spark.createDataFrame([(1,)], "id bigint"), base)  # a column is missing
    assert publish.current_version(spark, base) == 1 and publish.current(spark, base).collect() == first.collect()
    publish.publish(spark.createDataFrame([(2, "b", 1.0)], "id bigint, v string, w double"), base)  # an addition
    assert reader.collect() == first.collect() and [r.id for r in publish.current(spark, base).collect()] == [2]
    gone = publish.expire(spark, base, keep=2)
    assert all(g.startswith("v=2-") for g in gone)  # what the failed build left
    publish.publish(spark.createDataFrame([(3, "c", 1.0)], "id bigint, v string, w double"), base)
    assert [g[:4] for g in publish.expire(spark, base, keep=1)] == ["v=1-", "v=2-"]
    assert [r.id for r in publish.current(spark, base).collect()] == [3] and len(files.folders(spark, base)) == 1


def test_a_failed_rebuild_leaves_the_published_model(spark, tmp_path):
    r = reg.Registry()
    r.source("raw")
    r.add(reg.Model("core_t", "core", lambda raw: raw.select("id", F.assert_true(F.col("id") < 5).alias("ok"), "p"), ["raw"], partition_by=["p"]))
    reg.run(spark, r, {"raw": spark.range(5).withColumn("p", F.lit("i"))}, str(tmp_path))
    with pytest.raises(Exception):
        reg.run(spark, r, {"raw": spark.range(50).withColumn("p", F.lit("i"))}, str(tmp_path))
    assert publish.current(spark, f"{tmp_path}/core/core_t").count() == 5


def test_interval_join_equals_range_join(spark):
    r = random.Random(9)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=r.randrange(3000))
    iv = []
    for i in range(800):
        a, b = day(), day()
        iv.append((r.choice(["k1", "k2", None]), i, min(a, b), r.choice([max(a, b), min(a, b), dt.date(9999, 12, 31), None])))
    iv.append(("k1", 9_000, dt.date(2022, 1, 2), dt.date(2022, 1, 1)))  # ends before it begins
    points = [(r.choice(["k1", "k1", "k2", "k3", None]), i, r.choice([day(), day(), None])) for i in range(400)]
    intervals = spark.createDataFrame(iv, "k string, team int, valid_from date, valid_to date")
    pts = spark.createDataFrame(points, "k string, id int, d date")
    for how in ("left", "inner"):
        rows = lambda df: sorted(((x.id, x.k, x.d, x.team) for x in df.collect()), key=repr)
        got = rows(interval_join(pts, intervals, "d", "valid_from", "valid_to", ["k"], how))
        assert got == rows(range_join(pts, intervals, "d", "valid_from", "valid_to", ["k"], how)) and len(got) > 10_000


def test_interval_join_has_no_pairs_of_a_key(spark):
    hot = spark.range(200_000).select(F.lit("hot").alias("k"), F.expr("date_add(date'2020-01-01', cast(id % 700 as int))").alias("d"))
    iv = spark.range(100_000).select(F.lit("hot").alias("k"), F.expr("date_add(date'1900-01-01', cast(id as int))").alias("f"), F.col("id").alias("team")).withColumn("t", F.col("f"))
    out = interval_join(hot, iv, "d", "f", "t", ["k"], "inner")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.count() == 200_000
