import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_CHECK
from fieldwise.operators import access, change, joins, merge, quality
from fieldwise.operators.joins import DuplicateKeyError, bounded_broadcast, range_join, row_bound
from fieldwise.operators.resolve import Candidates, latest_by_source, pick_latest, resolve, soft_delete
from fieldwise.operators.retention import prune_generations
from fieldwise.plans import registry as reg
from fieldwise.plans import resolution_queries as rq
from fieldwise.sources import reports, seeds
from fieldwise.sources.ledger import read_call_ledger
from fieldwise.sources.tables import optional_source

D = dt.datetime


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


OBS_SCHEMA = "k string, source string, source_priority int, observed_at timestamp, a string, b long"
CANDS = Candidates(fields={"a": ["s1", "s2", "s3"], "b": ["s3", "s1"]})


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBS_SCHEMA)


def test_t4_newest_null_hides_older_value(spark):
    # s1's newest row has a null 'a'; its older 'old' must not come back (T4)
    obs = _obs(spark, [
        ("x", "s1", 1, D(2026, 1, 1), "old", 1),
        ("x", "s1", 1, D(2026, 1, 3), None, 2),
        ("x", "s2", 2, D(2026, 1, 2), "z", None),
    ])
    out = resolve(obs, ["k"], CANDS).first()
    assert out.a == "z" and out.b == 2
    two = pick_latest(latest_by_source(obs, ["k"]), ["k"], CANDS).first()
    assert (two.a, two.b) == ("z", 2)


def test_t3_equal_times_use_the_fields_own_list(spark):
    t = D(2026, 1, 1)
    obs = _obs(spark, [("x", "s1", 1, t, "from_s1", 10), ("x", "s3", 3, t, "from_s3", 30)])
    out = resolve(obs, ["k"], CANDS).first()
    assert out.a == "from_s1"  # s1 listed first for a
    assert out.b == 30  # s3 listed first for b although its priority is lower


def test_t10_null_time_sorts_first_within_a_source(spark):
    obs = _obs(spark, [("x", "s1", 1, None, "no_time", 1), ("x", "s1", 1, D(2026, 1, 1), "timed", 2)])
    latest = latest_by_source(obs, ["k"]).first()
    assert latest.a == "no_time"  # PostgreSQL's DESC puts nulls first
    assert resolve(obs, ["k"], CANDS).first().a is None  # and a null time never wins a field


def test_fused_equals_two_level_on_driver_orders(spark):
    obs = rq.order_observations(spark, SF_CHECK)
    fused = resolve(obs, rq.ORDER_KEYS, rq.ORDER_CANDIDATES)
    two = pick_latest(latest_by_source(obs, rq.ORDER_KEYS), rq.ORDER_KEYS, rq.ORDER_CANDIDATES)
    cols = sorted(fused.columns)
    assert fused.select(cols).exceptAll(two.select(cols)).count() == 0
    assert two.select(cols).exceptAll(fused.select(cols)).count() == 0


def test_resolution_invariant_under_shuffle_and_null_source(spark):
    obs = rq.order_observations(spark, SF_CHECK)
    base = resolve(obs, rq.ORDER_KEYS, rq.ORDER_CANDIDATES)
    shuffled = resolve(obs.repartition(7, "observed_at").sortWithinPartitions(F.rand(3)), rq.ORDER_KEYS, rq.ORDER_CANDIDATES)
    assert base.exceptAll(shuffled).count() == 0
    # an arm that knows nothing (all values null) changes no field
    nulls = obs.filter(F.col("source") == "api_sweep").select(
        *rq.ORDER_KEYS, F.lit("api_sweep").alias("source"), F.lit(2).alias("source_priority"),
        (F.col("observed_at") - F.expr("INTERVAL 400 DAYS")).alias("observed_at"),
        *[F.lit(None).cast(t).alias(f) for f, t in rq.ORDER_FIELDS.items()],
    )
    with_nulls = resolve(obs.unionByName(nulls), rq.ORDER_KEYS, rq.ORDER_CANDIDATES)
    assert base.exceptAll(with_nulls).count() == 0


def test_soft_delete_rules(spark):
    df = spark.createDataFrame(
        [(D(2026, 1, 2), D(2026, 1, 1)), (D(2026, 1, 1), D(2026, 1, 2)), (None, D(2026, 1, 1)), (D(2026, 1, 1), None), (D(2026, 1, 1), D(2026, 1, 1))],
        "deleted_at timestamp, snapshot_at timestamp",
    )
    got = [r[0] for r in df.select(soft_delete(F.col("deleted_at"), F.col("snapshot_at"))).collect()]
    assert got == [True, False, False, True, True]


def test_retention_keeps_newest_generation_per_day_and_is_idempotent(spark):
    rows = []
    # one instance, three generations on an old day (two rows each), one recent
    for g in (D(2026, 7, 1, 6), D(2026, 7, 1, 12), D(2026, 7, 1, 18)):
        rows += [("i", g, "America/Los_Angeles", "r1"), ("i", g, "America/Los_Angeles", "r2")]
    rows += [("i", D(2026, 8, 5, 6), "America/Los_Angeles", "r1")]
    df = spark.createDataFrame(rows, "source_instance_id string, report_generated_at timestamp, timezone string, row_key string")
    kept = prune_generations(df, "2026-08-08 00:00:00", keep_days=10)
    gens = sorted({r.report_generated_at for r in kept.collect()})
    # 06:00 UTC is Jun 30 in Los Angeles (its own local day); 12:00 and 18:00 UTC
    # are both Jul 1 local and only the newest survives - with all its rows
    assert gens == [D(2026, 7, 1, 6), D(2026, 7, 1, 18), D(2026, 8, 5, 6)]
    assert kept.count() == 5
    again = prune_generations(kept, "2026-08-08 00:00:00", keep_days=10)
    assert again.count() == 5


def test_unmatched_plus_matched_is_input(spark):
    from fieldwise.operators import bridge

    xw = spark.createDataFrame([("i", "10", 1), ("i", "11", 2)], "source_instance_id string, quote_number string, opportunity_id long")
    rep = spark.createDataFrame(
        [("i", "10 ", D(2026, 1, 1)), ("i", "12", D(2026, 1, 1)), ("i", None, D(2026, 1, 1)), ("i", "10", D(2025, 1, 1))],
        "source_instance_id string, quote_number string, report_generated_at timestamp",
    )
    um = bridge.unmatched(rep, xw)
    newest = bridge.newest_generation(rep.withColumn("quote_number", bridge.quote_key("quote_number")))
    m = bridge.matched(newest, xw, ["source_instance_id", "quote_number"], "opportunity_id")
    assert um.count() + m.count() == newest.count() == 3
    assert sorted(r.reason for r in um.collect()) == ["no_quote_number", "quote_not_in_api"]


def test_state_fold_scenarios(spark):
    keys = ["source_instance_id", "id"]
    now = "2026-08-13 12:00:00"
    today = F.lit("2026-08-13").cast("date")
    schema = "source_instance_id string, id string, h string, t timestamp, seen timestamp, sd long, sdx long, ls string, gone timestamp, gp boolean, g404 boolean"
    old = D(2026, 8, 1)
    state = spark.createDataFrame([
        ("a", "fresh", "h1", D(2026, 8, 13, 1), D(2026, 8, 12), 20260815, 20260815, None, None, None, None),
        ("a", "hot_stale", "h1", D(2026, 8, 12, 1), D(2026, 8, 12), 20260815, 20260815, None, None, None, None),
        ("a", "cold_fresh", "h1", D(2026, 8, 10), D(2026, 8, 12), 20261101, 20261101, None, None, None, None),
        ("a", "changed", "h1", D(2026, 8, 13, 1), D(2026, 8, 12), 20260815, 20260815, None, None, None, None),
        ("a", "returning", "h1", old, D(2026, 8, 1), 20260815, 20260815, None, D(2026, 8, 5), None, None),
        ("a", "vanished", "h1", old, D(2026, 8, 12), 20260820, 20260820, None, None, None, None),
        ("a", "out_of_window", "h1", old, D(2026, 8, 12), 20270101, 20270101, None, None, None, None),
        ("a", "no_span", "h1", old, D(2026, 8, 12), None, None, None, None, None, None),
    ], schema)
    sweep = spark.createDataFrame([
        ("a", "fresh", "h1", 20260815, 20260815), ("a", "hot_stale", "h1", 20260815, 20260815),
        ("a", "cold_fresh", "h1", 20261101, 20261101), ("a", "changed", "h2", 20260815, 20260815),
        ("a", "returning", "h1", 20260815, 20260815), ("a", "brand_new", "h9", 20260816, 20260816),
        ("a", "gone_404", "h1", 20260816, 20260816),
    ], "source_instance_id string, id string, h string, sd long, sdx long")
    obs = change.observe_sweep(state, sweep, keys, now, today)
    reasons = {r.id: r.reason for r in obs.collect()}
    assert reasons == {"fresh": None, "hot_stale": "stale", "cold_fresh": None, "changed": "changed",
                       "returning": "resurrected", "brand_new": "new", "gone_404": "new"}
    details = spark.createDataFrame(
        [("a", "gone_404", False, True, None), ("a", "changed", True, False, " Booked ")],
        "source_instance_id string, id string, ok boolean, missing boolean, ls string",
    )
    folded = change.fold_state(state, obs, details, keys, now)
    manifest = spark.createDataFrame(
        [("a", D(2026, 8, 13, 12), 20260801, 20261231, True), ("a", D(2026, 8, 13, 13), 20260801, 20261231, False)],
        "source_instance_id string, at timestamp, from long, to long, complete boolean",
    )
    marked = change.detect_deletions(folded, change.last_complete_sweep(manifest), keys, now)
    dels = {r.id: r._delete_source for r in change.emit_deletions(marked, keys, now).collect()}
    assert dels == {"gone_404": "detail_404", "vanished": "sweep_disappearance"}
    st = {r.id: r for r in marked.collect()}
    assert st["changed"].h == "h2" and st["changed"].ls == "Booked"
    assert st["hot_stale"].h == "h1" and st["hot_stale"].t == D(2026, 8, 12, 1)  # no result: watermark kept
    assert st["returning"].gone is None
    # replaying the same batch is a no-op for the state
    again = change.fold_state(folded, change.observe_sweep(folded, sweep, keys, now, today), details.limit(0), keys, now)
    assert {r.id for r in again.collect()} == set(st)


def test_prune_and_migrate(spark):
    keys = ["source_instance_id", "id"]
    st = spark.createDataFrame(
        [("a", "old_span", None, None, 20260101), ("a", "young", None, None, 20260801), ("a", "old_nospan", None, D(2026, 1, 1), None)],
        "source_instance_id string, id string, h string, t timestamp, sdx long",
    )
    kept = change.prune_state(st, "2026-08-13 00:00:00", F.lit("2026-08-13").cast("date"))
    assert sorted(r.id for r in kept.collect()) == ["young"]
    legacy = spark.createDataFrame([("a", "x", "h")], "source_instance_id string, id string, h string")
    m = change.migrate_legacy(legacy, keys, "2026-08-13 00:00:00").first()
    assert m.h == "h" and m.t == D(2026, 8, 13)


def test_upsert_and_children(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    b = spark.createDataFrame([(2, "B1", 1), (2, "B2", 2), (3, "c", 1)], "id int, v string, ver int")
    out = merge.upsert(t, b, ["id"], order=["ver"])
    assert _rows(out, "id", "v") == [(1, "a"), (2, "B2"), (3, "c")]
    assert _rows(merge.upsert(out, b, ["id"], order=["ver"]), "id", "v") == _rows(out, "id", "v")  # replay no-op
    kids = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (2, 0, "z")], "pid int, idx int, v string")
    new = spark.createDataFrame([(1, 0, "only")], "pid int, idx int, v string")
    assert _rows(merge.replace_children(kids, new, ["pid"]), "pid", "idx", "v") == [(1, 0, "only"), (2, 0, "z")]


def test_land_report_and_headers(spark):
    rows = spark.createDataFrame([({"Quote #": "10", "Status": "Booked"},), ({"Quote #": " ", "Status": "x"},)], "row map<string,string>")
    header = ["Quote #", "Status", "Volume/Weight"]
    landed = reports.land_report(rows, "i", "2026-08-13 06:00:00", "Quote #", header)
    r = landed.collect()
    assert len(r) == 1 and r[0].row_key == "10"
    assert '"Volume/Weight":""' in r[0].row_data
    again = reports.land_report(rows, "i", "2026-08-13 06:00:00", "Quote #", header, existing=landed)
    assert again.count() == 0


def test_landed_and_quarantined_rows_add_up(spark):
    keys = ["7", "7", "7", "8", " ", " ", None]
    rows = spark.createDataFrame(
        [({"Quote #": k, "Status": s},) for k, s in zip(keys, ["b", "a", "b", "x", "p", "p", "q"])], "row map<string,string>"
    )
    landed, bad = reports.split_landing(rows, "i", "2026-08-13 06:00:00", "Quote #", ["Quote #", "Status"])
    got = {r.row_key: r.row_data for r in landed.collect()}
    assert set(got) == {"7", "8"} and '"a"' in got["7"]
    reasons = sorted((r.reason, r.copies) for r in bad.collect())
    assert reasons == [("blank_key", 1), ("blank_key", 2), ("repeated_key", 2)]
    assert len(got) + sum(n for _, n in reasons) == len(keys)


def test_optional_source_and_ledger(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert optional_source(spark, "no_such_table_here", schema).count() == 0
    p = tmp_path / "calls.jsonl"
    p.write_text('{"ts":"2026-08-13T06:00:00Z","instance":"a","path":"/api/leads","params":{"page":"1"},"status":200,"rows":200,"ms":350}\n')
    led = read_call_ledger(spark, str(p)).first()
    assert led.status == 200 and led.params == {"page": "1"}


def test_quality_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "F"), (1, "X"), (None, "O")], "k int, s string")
    assert quality.not_null(df, "k").count() == 1
    assert quality.unique(df, ["k"]).count() == 1
    assert quality.accepted_values(df, "s", ["F", "O"]).count() == 1
    parent = spark.createDataFrame([(2,)], "k int")
    assert quality.relationships(df, "k", parent, "k").count() == 2
    stored = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    added = T.StructType([*stored.fields, T.StructField("c", T.StringType())])
    retyped = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert not quality.is_breaking(quality.contract_diff(stored, added))
    assert quality.is_breaking(quality.contract_diff(stored, retyped))


def test_access_and_publish(spark):
    acc = seeds.frame(spark, seeds.ENTITY_ACCESS, seeds.ENTITY_ACCESS_SCHEMA)
    df = spark.createDataFrame([(1, "west_co"), (2, "east_co"), (3, None)], "id int, entity_id string")
    assert _rows(access.secure_view(df, acc, "analyst_west"), "id") == [(1,)]
    assert access.secure_view(df, acc, "stranger").count() == 0
    pub = access.publish_for_role(
        {"jobs_upcoming_v1": ("serving", df), "raw_x": ("staging", df), "entity_access": ("core", acc)}, acc, "admin"
    )
    assert list(pub) == ["serving.jobs_upcoming_v1"]
    assert access.tenant_tables({"a": df, "entity_access": acc.withColumnRenamed("role_name", "r")}) == ["a"]


def test_broadcast_needs_a_proven_bound(spark):
    seed = seeds.frame(spark, [(1, "a")], "k int, v string")
    assert row_bound(seed) == 1
    plan = spark.range(10).join(bounded_broadcast(seed.withColumnRenamed("k", "id")), "id")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()  # bound lost by the rename: no hint
    big = spark.range(50)
    assert bounded_broadcast(big, max_rows=10, probe=True) is big
    dup = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(DuplicateKeyError):
        bounded_broadcast(dup, max_rows=10, unique_on=["k"], probe=True)
    with pytest.raises(ValueError):
        seeds.frame(spark, [(1,), (1,)], "k int", unique_on=[0])


def test_range_join_open_end_and_overlap(spark):
    iv = seeds.frame(spark, [("a", "t1", "2026-01-01", "9999-12-31"), ("a", "t2", "2026-06-01", "2026-06-30")],
                     "k string, team string, f string, t string")
    iv = iv.selectExpr("k", "team", "cast(f as date) f", "cast(t as date) t")
    pts = spark.createDataFrame([("a", dt.date(2026, 6, 15)), ("a", dt.date(2025, 1, 1))], "k string, d date")
    out = range_join(pts, iv, "d", "f", "t", keys=["k"], bound=2)
    assert _rows(out, "d", "team") == [(dt.date(2025, 1, 1), None), (dt.date(2026, 6, 15), "t1"), (dt.date(2026, 6, 15), "t2")]


def test_registry_contract_and_selective_rebuild(spark, tmp_path):
    r = reg.Registry()
    r.source("raw")
    r.add(reg.Model("stg", "staging", lambda raw: raw.select("id", "v"), ["raw"]))
    r.add(reg.Model("core_t", "core", lambda s: s.withColumn("w", F.col("v") * 2), ["stg"], partition_by=["id"]))
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())])
    r.add(reg.Model("serve_v1", "serving", lambda c: c.select("id", "v", "w"), ["core_t"], contract=contract))
    raw = spark.createDataFrame([(1, 10), (2, 20)], "id long, v long")
    out = reg.run(spark, r, {"raw": raw}, str(tmp_path))
    assert out["serve_v1"].count() == 2
    assert r.downstream(["stg"]) == ["core_t", "serve_v1"]
    r.models["serve_v1"].contract = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(reg.ContractError):
        reg.run(spark, r, {"raw": raw}, str(tmp_path), changed_sources=["core_t"], built=out)


def test_t18_an_arm_without_candidate_fails_the_build(spark):
    from fieldwise.operators.union import ArmSpec, UncoveredFieldError, stack_observations

    df = spark.createDataFrame([("x", D(2026, 1, 1), "v")], "k string, t timestamp, a string")
    arms = [ArmSpec("s2", 2, F.col("t"), {"b": F.lit(1)})]  # s2 is not a candidate for b
    with pytest.raises(UncoveredFieldError):
        stack_observations(df, ["k"], arms, {"a": "string", "b": "bigint"}, candidates=CANDS)
    ok = stack_observations(df, ["k"], [ArmSpec("s1", 1, F.col("t"), {"a": F.col("a")})], {"a": "string", "b": "bigint"}, candidates=CANDS)
    assert ok.count() == 1


def test_candidates_are_whole_and_ranked(spark):
    obs = spark.createDataFrame(
        [("a", str(i), "stale" if i % 2 else "changed") for i in range(10)], "source_instance_id string, id string, reason string"
    )
    got = change.enrichment_candidates(obs, ["source_instance_id", "id"]).orderBy("reason_rank", "id").collect()
    assert [r.id for r in got] == list("0246813579")


def test_targeted_details_reach_the_state(spark):
    now = "2026-08-13 06:00:00"
    state = spark.createDataFrame(
        [("i", k, "h", None, D(2026, 8, 1), 1, 2, None, g, None, None) for k, g in (("a", None), ("b", D(2026, 8, 2)), ("c", None))],
        "source_instance_id string, id string, h string, t timestamp, seen timestamp, sd long, sdx long, ls string,"
        " gone timestamp, gp boolean, g404 boolean",
    )
    keys = ["source_instance_id", "id"]
    obs = spark.createDataFrame([], "source_instance_id string, id string, h string, sd long, sdx long, reason string")
    none = spark.createDataFrame([], "source_instance_id string, id string, ok boolean, missing boolean, ls string")
    targeted = spark.createDataFrame(
        [("i", "a", False, True, None), ("i", "b", True, False, "Won"), ("i", "new", False, True, None)], none.schema
    )
    got = {r.id: r for r in change.fold_state(state, obs, none, keys, now, targeted).collect()}
    assert got["a"].gone is not None and got["a"].g404 and got["a"].gp
    assert got["b"].gone is None and got["b"].t is not None and got["b"].ls == "Won" and got["b"].h == "h"
    assert got["c"].gone is None and got["c"].t is None and got["c"].seen == D(2026, 8, 1)
    assert got["new"].g404


def test_join_side_must_be_unique_on_the_normalised_key(spark):
    left = spark.createDataFrame([("Google",)], "t string")
    right = spark.createDataFrame([("google ", 1), ("GOOGLE", 2)], "r string, v int")
    with pytest.raises(joins.DuplicateKeyError):
        joins.norm_key_join(left, right, "t", "r")


def test_freshness_reports_groups_without_rows(spark):
    df = spark.createDataFrame([("a", D(2026, 8, 13))], "g string, t timestamp")
    targets = spark.createDataFrame([("a", 60), ("b", 60)], "g string, target_minutes int")
    got = {r.g: r for r in quality.freshness_report(df, "g", "t", "2026-08-13 00:30:00", targets).collect()}
    assert not got["a"].is_stale and not got["a"].breaches_target
    assert got["b"].n_rows == 0 and got["b"].is_stale and got["b"].breaches_target


def test_rule_engine_priority_and_status_map(spark):
    from fieldwise.operators import rules

    df = spark.createDataFrame([("Moving LD", "Main"), ("International move", "x"), ("Local", "MMM Interstate"), (None, None)],
                               "service_type string, branch_name string")
    table = [
        (1, "service_type", "contains", "LD", "interstate"),
        (1, "service_type", "contains", "International", "interstate"),
        (99, "service_type", "default", "*", "local"),
        (2, "branch_name", "contains", "MMM Interstate", "avoid"),
    ]
    got = [r.category for r in rules.rule_engine(df, table).collect()]
    assert got == ["interstate", "interstate", "avoid", "local"]
    smap = seeds.frame(spark, [("follow up 3 no response", "open", "no_response"), ("Booked ", "booked", "booked")],
                       "status_raw string, status_category string, status_subcategory string")
    rep = spark.createDataFrame([("Follow up 3 - No Response",), ("BOOKED",), ("Lost",)], "status string")
    out = sorted((r.status, r.status_category) for r in rules.map_status_text(rep, "status", smap).collect())
    assert out == [("BOOKED", "booked"), ("Follow up 3 - No Response", "open"), ("Lost", None)]


def test_changes_without_events(spark):
    from fieldwise.operators.events import changes_without_events

    ch = spark.createDataFrame([("a", D(2026, 8, 1, h)) for h in range(12)] + [("a", D(2026, 8, 2, h)) for h in range(12)]
                               + [("b", D(2026, 8, 1, 1))], "inst string, at timestamp")
    ev = spark.createDataFrame([("a", D(2026, 8, 2, 5))], "inst string, received_at timestamp")
    got = [(r.inst, r.day) for r in changes_without_events(ch, ev, ["inst"], "at", "received_at").collect()]
    assert got == [("a", dt.date(2026, 8, 1))]


def test_match_next_two_frames(spark):
    from fieldwise.operators.bridge import match_next

    leads = spark.createDataFrame([("e1", 1, D(2026, 8, 1)), ("e1", 2, D(2026, 8, 20)), ("e2", 3, D(2026, 8, 1))],
                                  "contact string, lid long, at timestamp")
    opps = spark.createDataFrame([("e1", 10, D(2026, 8, 3)), ("e1", 11, D(2026, 8, 2)), ("e2", 12, D(2026, 7, 30))],
                                 "contact string, oid long, at timestamp")
    got = sorted((r.lead_id, r.opportunity_id) for r in match_next(leads, opps, ["contact"], "at", "at", "lid", "oid", 7 * 86400).collect())
    # lead 1 takes the first opportunity at or after it (11, on Aug 2); lead 2 has none within 7 days;
    # lead 3's only opportunity is earlier
    assert got == [(1, 11), (2, None), (3, None)]


def test_e9_late_older_generation_changes_nothing(spark):
    # observed_at is the report's generation time: an older generation that lands
    # later (arrival order) must not override a newer value
    base = _obs(spark, [("x", "s1", 1, D(2026, 8, 10), "new", 1), ("x", "s2", 2, D(2026, 8, 5), "mid", 2)])
    late = _obs(spark, [("x", "s1", 1, D(2026, 8, 1), "old", 3)])
    a = resolve(base, ["k"], CANDS).first()
    b = resolve(base.unionByName(late), ["k"], CANDS).first()
    assert (a.a, a.b) == (b.a, b.b) == ("new", 1)


def test_resolving_arms_equals_resolving_their_rows(spark):
    from fieldwise.operators.resolve import resolve_arms
    from fieldwise.operators.union import ArmSpec, stack_observations

    rows = [
        ("k1", D(2026, 1, 1), 1, None, "x"), ("k1", D(2026, 1, 2), 2, 5, None), ("k1", None, 3, 6, "y"),
        ("k2", D(2026, 1, 1), 4, 7, "z"), ("k2", D(2026, 1, 1), 5, 8, None), ("none", D(2026, 1, 1), 60, 1, "u"), (None, D(2026, 1, 3), 2, 9, "v"),
    ]
    df = spark.createDataFrame(rows, "k string, t timestamp, id int, b long, a string")
    schema = {"a": "string", "b": "bigint", "id": "int"}
    even, small = F.col("id") % 2 == 0, F.col("id") < 50
    arms = [
        ArmSpec("s1", 1, F.col("t"), {"a": F.col("a"), "id": F.col("id"), "b": F.col("b")}, when=small),
        ArmSpec("s2", 2, F.col("t"), {"a": F.upper("a"), "id": F.col("id")}, when=even & small),
        ArmSpec("s3", 3, F.col("t"), {"a": F.lit("p"), "b": F.col("b") * 2, "id": F.col("id")}, when=small),
        ArmSpec("s3", 3, F.col("t") + F.expr("INTERVAL 1 DAY"), {"b": F.lit(3), "id": F.col("id")}, when=even & small),
    ]
    long = resolve(stack_observations(df, ["k"], arms, schema), ["k"], CANDS, tiebreak=["id"], count_col="n")
    wide = resolve_arms(df, ["k"], arms, schema, CANDS, tiebreak=["id"], count_col="n")
    assert wide.columns == long.columns
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(map(tuple, long.collect()), key=repr)
    assert wide.count() == 3  # no row where no arm observes


def test_replays_are_measured_from_the_last_kept_delivery(spark):
    from fieldwise.operators import events

    days = [0, 6, 12, 18, 24, 30, 7, 14, 50]
    rows = [("h", D(2026, 1, 1) + dt.timedelta(days=d), i) for i, d in enumerate(days)] + [(None, D(2026, 1, 1), 90), (None, D(2026, 1, 2), 91)]
    df = spark.createDataFrame(rows, "h string, t timestamp, id int").repartition(3)
    got = sorted(r.id for r in events.dedupe_replays(df, "h", "t", 7 * 86400, ["id"]).collect())
    kept, last = [], None
    for i, d in sorted(enumerate(days), key=lambda x: x[1]):
        if last is None or d - last > 7:
            kept.append(i)
            last = d
    assert got == sorted([*kept, 90])


def test_lead_and_service_windows_follow_the_tenants_calendar(spark):
    from fieldwise.sources.tables import read_leads_window, read_service_window

    rows = spark.createDataFrame(
        [(1, D(2026, 8, 13, 5), "America/Los_Angeles"), (2, D(2026, 8, 13, 8), "America/Los_Angeles"), (3, D(2026, 8, 13, 5), "UTC"), (4, None, "UTC")],
        "id int, created timestamp, tz string",
    )
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(read_leads_window(rows, "created", "2026-08-13 20:00:00", F.col("tz"))) == [2, 3]
    assert ids(read_leads_window(rows, "created", "2026-08-13 20:00:00", F.col("tz"), start="2026-08-12")) == [1, 2, 3]
    jobs = spark.createDataFrame([(1, dt.date(2026, 8, 12)), (2, dt.date(2026, 8, 13)), (3, dt.date(2026, 8, 15)), (4, dt.date(2026, 8, 16)), (5, None)], "id int, day date")
    got = read_service_window(jobs, "day", "2026-08-14 03:00:00", "America/Los_Angeles", 2).collect()
    assert sorted((r.id, r._sweep_from, r._sweep_to) for r in got) == [(2, 20260813, 20260815), (3, 20260813, 20260815)]


def test_legacy_maps_and_a_state_that_is_new_already(spark):
    hashes = spark.createDataFrame([("i", "a", "h1")], "inst string, id string, h string")
    seen = spark.createDataFrame([("i", "a"), ("i", "b")], "inst string, id string")
    state = change.migrate_legacy(hashes, ["inst", "id"], "2026-08-13 00:00:00", seen=seen, prior=seen)
    assert [(r.id, r.h, r.t) for r in state.collect()] == [("a", "h1", D(2026, 8, 13))]
    assert change.migrate_legacy(hashes, ["inst", "id"], "2027-01-01 00:00:00", state=state).first().t == D(2026, 8, 13)
    assert change.migrate_legacy(hashes, ["inst", "id"], "2027-01-01 00:00:00", state=state.limit(0)).first().t == D(2027, 1, 1)
    with pytest.raises(ValueError):
        change.migrate_legacy(hashes, ["inst", "id"], "2026-08-13 00:00:00", seen=seen.drop("id"))
