"""What tables larger than the fixtures need: tasks whose size does not follow the table's, narrow shuffles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldwise.functions.text import mentions, norm_text
from fieldwise.operators.joins import interval_join, range_join
from fieldwise.operators.resolve import newest_row
from fieldwise.operators.rules import lob_ladder
from fieldwise.plans import feed_queries
from fieldwise.plans.registry_all import all_queries
from fieldwise.sources.tables import spread
from fieldwise.streaming.stateful import HASHES_PER_BUCKET, buckets_for

D = dt.datetime


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few jobs of every branch and region, with copies and nulls."""
    base = str(tmp_path_factory.mktemp("tables"))
    put = lambda name, df: df.write.parquet(f"{base}/{name}.parquet")
    n = F.col("id").cast("int")
    put("nation", spark.range(25).select(n.alias("n_nationkey"), F.concat(F.lit("BRANCH "), n).alias("n_name"), (n % 5).alias("n_regionkey")))
    put("supplier", spark.range(50).select(F.col("id").alias("s_suppkey"), (n % 25).alias("s_nationkey")))
    put("part", spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("TYPE "), n % 7).alias("p_type")))
    put("orders", spark.range(90).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 13 != 0, F.col("id") % 7).alias("o_custkey"),
        F.expr("cast(date_add(date'1997-01-01', cast(id * 5 % 61 as int)) as timestamp_ntz)").alias("o_orderdate"),
    ))
    lines = spark.range(600).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 97).alias("l_orderkey"), (n % 3).alias("l_linenumber"),
        (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 50).alias("l_suppkey"),
        (n % 9 + 1).cast("double").alias("l_quantity"), (n * 1.25).cast("double").alias("l_extendedprice"), F.lit(0.04).alias("l_tax"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), n % 3 + 1).alias("l_returnflag"),
        F.when(n % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.expr("cast(date_add(date'1997-01-01', cast(id % 80 as int)) as timestamp_ntz)").alias("l_shipdate"),
    )
    put("lineitem", lines.unionByName(lines.limit(60)))
    return base


def query(spark, tables, name):
    return all_queries()[name].build(spark, tables)


def test_a_scan_is_dealt_over_as_many_tasks_as_its_rows_need(spark, tables):
    scan = spark.read.parquet(f"{tables}/lineitem.parquet").withColumn("l_orderkey", F.lit(1))  # one hot key
    parts = spread(scan, 100)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert parts.rdd.getNumPartitions() == max(7, scan.rdd.getNumPartitions()) and max(sizes) < 250
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, scan.collect())) and parts.columns == scan.columns
    assert "Exchange" not in plan_of(spread(scan, 10_000))


def test_report_rows_are_not_shuffled_by_their_five_instances(spark, tables):
    df = query(spark, tables, "report_all_jobs")
    plan = plan_of(df)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert df.count() == df.select("job_key").distinct().count() > 200


def test_a_newest_row_by_kept_columns_holds_them_once(spark):
    rows = spark.createDataFrame([(1, None, "z", 1), (1, 5, "a", 2), (1, 5, "b", 3), (1, 5, "b", 4), (2, None, None, 5)], "k int, t int, text string, id int")
    got = newest_row(rows, ["k"], ["t", "text"], keep=["id", "t", "text"])
    assert sorted(map(tuple, got.collect())) == [(1, 4, 5, "b"), (2, 5, None, None)]
    by_columns = newest_row(rows, ["k"], [F.col("t"), F.col("text"), F.col("id")], keep=["id", "t", "text"])
    assert sorted(map(tuple, by_columns.collect())) == sorted(map(tuple, got.collect()))
    assert plan_of(got).count("text#") < plan_of(by_columns).count("text#")


@pytest.mark.parametrize("name", ["resolve_jobs", "lob_ladder"])
def test_jobs_are_not_shuffled_by_their_branch(spark, tables, name):
    df = query(spark, tables, name)
    plan = plan_of(df)
    assert "n_nationkey" in plan and "SortMergeJoin" not in plan
    assert df.count() > 200


def test_intervals_that_do_not_overlap_are_looked_up_without_bins(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    history = [(k, i, day(100 * i + 3 * k), day(100 * i + 3 * k + 60 + 20 * (i % 2)) if i < 9 else dt.date(9999, 12, 31)) for k in range(5) for i in range(10)]
    history += [(None, 1, day(0), day(900)), (1, 77, day(500), day(400)), (2, 78, None, day(3)), (7, 79, day(5), day(5))]
    points = [(k, i, day(i) if i % 11 else None) for k in (0, 1, 2, 3, 4, 7, 8, None) for i in range(0, 1300, 7)]
    pts = spark.createDataFrame(points * 2, "k int, id int, d date")
    rows = lambda df: sorted(map(repr, df.select("k", "id", "d", "team").collect()))
    schema = "k bigint, team int, f date, t date"
    apart = spark.createDataFrame(history, schema)
    got = interval_join(pts, apart, "d", "f", "t", ["k"])
    assert "Generate" not in plan_of(got) and "explode" not in plan_of(got)
    # two of one day, and one that reaches into the next but one
    mixed = spark.createDataFrame([*history, (3, 80, day(309), day(320)), (4, 81, day(12), day(240))], schema)
    for iv in (apart, mixed):
        for how in ("left", "inner"):
            got, want = (rows(f(pts, iv, "d", "f", "t", ["k"], how)) for f in (interval_join, range_join))
            assert got == want and len(got) > 500
    for iv in (apart.filter("k = 1"), mixed.filter("k = 4")):  # no keys: one history
        iv = iv.drop("k")
        assert rows(interval_join(pts, iv, "d", "f", "t")) == rows(range_join(pts, iv, "d", "f", "t"))


TEXTS = ["Office - COMMERCIAL", "office commercialized!", "com mercial", "COMMERCİAL", "Kommercial", "a\ncommercialé", "non-commercial", "commerc", "", " ", None]


def test_a_word_is_found_in_a_text_as_in_its_normalised_form(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    want = F.coalesce(norm_text("t").contains("commercial"), F.lit(False))
    got = df.select(mentions("t", "commercial").alias("got"), want.alias("want"), "t").collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got] and {r.got for r in got} == {True, False}
    ladder = lob_ladder(F.col("t"), F.col("t"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert "regexp_replace" not in plan_of(df.select(ladder.alias("lob")))
    with pytest.raises(ValueError):
        mentions("t", "two words")


def test_a_bucket_of_the_replay_guard_does_not_grow_with_the_feed(spark, tmp_path, monkeypatch):
    assert buckets_for(100) == 64 and buckets_for(36_000_000) * HASHES_PER_BUCKET >= 36_000_000
    rows = [(i, D(2026, 6, 1) + dt.timedelta(minutes=7 * i), i % 5, "call", f"p{i}") for i in range(240)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    given, guard = [], feed_queries.stream.dedupe_stream
    monkeypatch.setattr(feed_queries.stream, "dedupe_stream", lambda *a, buckets, **k: given.append(buckets) or guard(*a, buckets=3, **k))
    monkeypatch.setattr("fieldwise.streaming.stateful.HASHES_PER_BUCKET", 2)
    got = query(spark, str(tmp_path), "dedupe_drains")
    assert set(given) == {120}
    assert got.count() == got.select("delivery_id").distinct().count() > 240
