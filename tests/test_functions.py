import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import one
from fieldwise.functions import casts, text, time as ftime
from fieldwise.functions.json import canonical_hash, has_key, json_field, json_int, json_map


def test_norm_text(spark):
    vals = ["Booked ", "Follow up 3 - No Response", "Lost follow up 3 no response", "---", None]
    got = one(spark, text.norm_text("x"), "x string", vals)
    assert got == ["booked", "follow up 3 no response", "lost follow up 3 no response", None, None]


def test_rpt_date(spark):
    vals = ["6/1/2026", "06/01/2026", "0/0/0", "", "2/31/2026", "6/1/2026\n", None]
    got = one(spark, casts.rpt_date("x"), "x string", vals)
    assert got == [dt.date(2026, 6, 1), dt.date(2026, 6, 1), None, None, None, None, None]


def test_rpt_ts_zone_and_dst(spark):
    la = "America/Los_Angeles"
    vals = ["8/7/2026 7:16 AM", "8/7/2026 13:16 PM", "8/7/2026 0:16 AM", "11/1/2026 1:30 AM", "3/8/2026 2:30 AM", ""]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(F.date_format(casts.rpt_ts("x", la), "yyyy-MM-dd HH:mm")).collect()]
    # ambiguous hour -> standard time (09:30Z), skipped hour -> 10:30Z
    assert got == ["2026-08-07 14:16", None, None, "2026-11-01 09:30", "2026-03-08 10:30", None]


def test_rpt_ts_offset(spark):
    vals = ["6/20/2026 8:45:00 AM -07:00", "6/20/2026 8:45:00 AM +02:00", "12/31/2025 11:30:00 PM -08:00", "6/20/2026 8:45:00 AM", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(F.date_format(casts.rpt_ts_offset("x"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2026-06-20 15:45", "2026-06-20 06:45", "2026-01-01 07:30", None, None, None]


def test_rpt_num(spark):
    vals = ["$1,234.56", "0.00", "", "--", " 12.50 ", "(5.00)", None]
    got = one(spark, casts.rpt_num("x"), "x string", vals)
    assert got == [Decimal("1234.56"), Decimal("0.00"), None, None, Decimal("12.50"), None, None]


def test_rpt_bool(spark):
    vals = ["1", " TRUE ", "yes", "Y", "0", "false", "No", "n", "maybe", "", None]
    got = one(spark, casts.rpt_bool("x"), "x string", vals)
    assert got == [True] * 4 + [False] * 4 + [None] * 3


def test_rpt_minutes(spark):
    vals = ["9m", "1h 47m", "23h 5m", "1d 8m", "1d 13h 41m", "8h", "-9m", "--", "", "5", "9m\n", None]
    got = one(spark, casts.rpt_minutes("x"), "x string", vals)
    assert got == [9, 107, 1385, 1448, 2261, 480, -9, None, None, None, None, None]


def test_rpt_units(spark):
    vals = ["525 cuft / 3698 lbs", "-- cuft / -- lbs", "525 cuft / -- lbs", "-- cuft / 3698 lbs", "1.2.3 cuft / 5 lbs", None]
    cu = one(spark, casts.rpt_cuft("x"), "x string", vals)
    lb = one(spark, casts.rpt_lbs("x"), "x string", vals)
    assert cu == [Decimal("525.0000"), None, Decimal("525.0000"), None, None, None]
    assert lb == [Decimal("3698.0000"), None, None, Decimal("3698.0000"), Decimal("5.0000"), None]


def test_int_date_and_to_ymd(spark):
    got = one(spark, casts.int_date("x"), "x int", [20260819, 0, None, 20260231])
    assert got == [dt.date(2026, 8, 19), None, None, None]
    got = one(spark, casts.to_ymd("x"), "x string", ["2026-07-20", "20260720", " 20260720 ", "2026-07-20T10:00", "123", "", None])
    assert got == [20260720, 20260720, 20260720, 20260720, None, None, None]
    got = one(spark, casts.to_ymd("x", numeric=True), "x bigint", [20260720, 5, None])
    assert got == [20260720, None, None]


def test_keys_and_labels(spark):
    df = spark.createDataFrame([("a", "1", None, 7), (None, "2", "Booked", None)], "a string, b string, n string, code int")
    r = df.select(
        text.surrogate_key("a", "b").alias("k"),
        text.label_or_code("n", "code").alias("lbl"),
        text.quote_of(F.lit("1234-2")).alias("q"),
    ).collect()
    assert [x.k for x in r] == ["a:1", None]
    assert [x.lbl for x in r] == ["status_7", "Booked"]
    assert r[0].q == "1234"


def test_addresses(spark):
    df = spark.createDataFrame(
        [("Delivered-To: LD.Reporting@x.com", "a@b.com, <ld.reporting@x.com>", ["c@d.org", "A@B.com"])],
        "h string, to string, cc array<string>",
    )
    got = df.select(text.addresses("h", "to", F.array_join("cc", " "))).first()[0]
    assert got == ["ld.reporting@x.com", "a@b.com", "c@d.org"]


def test_json_helpers(spark):
    df = spark.createDataFrame(
        [('{"Quote #": "12", "status": null, "n": "x"}',), ('{"a": 1, "a": 2}',)], "doc string"
    )
    r = df.select(
        json_field("doc", "Quote #").alias("q"),
        has_key("doc", "status").alias("hk"),
        json_int("doc", "n").alias("n"),
        json_map("doc").getItem("a").alias("a"),
    ).collect()
    assert r[0].q == "12" and r[0].hk is True and r[0].n is None
    assert r[1].a == "2"  # last duplicate key wins, as jsonb does


def test_canonical_hash_order_free(spark):
    df = spark.createDataFrame([(1, [3, 1, 2]), (1, [2, 3, 1])], "a int, jobs array<int>")
    h = [r[0] for r in df.select(canonical_hash("jobs", "a", sort_arrays=["jobs"])).collect()]
    assert h[0] == h[1]


def test_zone_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 8, 8, 5, 0),)], "ts timestamp")
    r = df.select(
        ftime.local_date("ts", "America/Los_Angeles").alias("d"),
        ftime.entity_today("2026-08-08 05:00:00", "America/Los_Angeles").alias("t"),
        ftime.hours_since("ts", "2026-08-08 08:00:00").alias("h"),
    ).first()
    assert r.d == dt.date(2026, 8, 7) and r.t == dt.date(2026, 8, 7) and abs(r.h - 3.0) < 1e-9
