import datetime as dt
import json
import tempfile

from pyspark.sql import functions as F

from fieldwise.operators import quality
from fieldwise.plans import crm
from fieldwise.plans import registry as reg
from fieldwise.sources import seeds

D = dt.datetime
AS_OF = "2026-08-13 20:00:00"  # 13:00 in Los Angeles

OPP_SCHEMA = (
    "source_instance_id string, entity_id string, id string, quote_number bigint, type bigint, status bigint, "
    "service_date int, lead_status string, volume double, weight double, "
    "estimated_total struct<subtotal:double,taxable_amount:double,tax:double,final_total:double>, "
    "branch struct<name:string>, customer struct<id:string,name:string,email_address:string,phone_number:string>, "
    "sales_assignee struct<name:string>, estimator struct<name:string>, move_coordinator struct<name:string>, "
    "referral_source string, created_at_utc timestamp, _snapshot_at timestamp, "
    "jobs array<struct<id:string,job_number:string,job_date:int,type:bigint,"
    "estimated_charges:array<struct<name:string,subtotal:double,discount_amount:double,total_cost:double>>,"
    "actual_charges:array<struct<name:string,subtotal:double,discount_amount:double,total_cost:double>>,"
    "job_addresses:array<string>,crew_members:array<string>,job_documents:array<struct<is_complete:boolean>>>>, "
    "payments array<struct<source:bigint,payment_type:bigint,payment_category:bigint,amount:double,"
    "amount_refunded:double,is_outstanding:boolean,taken_by_user:string>>, "
    "contacts array<struct<name:string,email_address:string,phone_number:string,phone_type:bigint>>, "
    "opportunity_documents array<struct<is_complete:boolean>>, opportunity_files array<struct<id:string>>, "
    "photos array<struct<id:string>>"
)
SWEEP_SCHEMA = (
    "source_instance_id string, entity_id string, id string, name string, phone_number string, email_address string, "
    "address string, _sweep_from int, _sweep_to int, _extracted_at timestamp, "
    "opportunities array<struct<id:string,quote_number:string,status:bigint,"
    "jobs:array<struct<id:string,job_number:string,service_date:string,type:bigint>>>>"
)
REPORT_SCHEMA = "source_instance_id string, entity_id string, report_generated_at timestamp, row_key string, row_data string"


def _opp(oid, quote, status, snap, final, sales, branch="Main Office ", jobs=None, pays=None, docs=None):
    return ("i1", "t1", oid, quote, 1, status, 20260815, "Booked ", 500.0, 3600.0,
            (900.0, 900.0, 100.0, final), (branch,), ("C1", "Enr Name", "e@x.com", "555"),
            (sales,), ("Est",), ("Coord",), "Google", D(2026, 8, 1, 16), snap, jobs or [],
            pays or [], [("Pat", "P@X.com ", "555", 1)], docs or [], [], [])


def _inputs(spark):
    charge = [("Labor", 800.0, 0.0, 800.0)]
    opps = spark.createDataFrame([
        _opp("O1", 1001, 3, D(2026, 8, 10), 1000.0, "Ann",
             jobs=[("J1", "1001-1", 20260815, 1, charge, charge + [("Tip", 50.0, 0.0, 50.0)],
                    ["12 Elm St", "9 Oak Ave"], ["Ann", "Bo", "Cy"], [(True,), (False,)])],
             pays=[(1, 2, 3, 250.0, 0.0, False, "Ann")], docs=[(True,), (False,), (True,)]),
        _opp("O2", 1002, 3, D(2026, 8, 1), 500.0, "Bob"),
        _opp("O3", 1003, 3, D(2026, 8, 5), 700.0, "Cy"),
    ], OPP_SCHEMA)
    sweep = spark.createDataFrame([
        ("i1", "t1", "C1", "Sweep Name", "555-0", "s@x.com", "1 Main St", 20260801, 20261001, D(2026, 8, 13),
         [("O1", "1001", 4, [("J1", "1001-1", "2026-08-16", 1)])]),
    ], SWEEP_SCHEMA)
    hooks = spark.createDataFrame([
        (1, D(2026, 8, 12), "i1", "t1", "opportunity-status-changed", "O1",
         json.dumps({"event-type": "opportunity-status-changed", "opportunity-id": "O1", "opportunity-status": 4})),
        (2, D(2026, 8, 12), "i1", "t1", "job-closed", "J1", json.dumps({"job-id": "J1"})),
    ], "event_id long, received_at timestamp, source_instance_id string, entity_id string, event_type string, "
       "resource_id string, payload string")
    dels = spark.createDataFrame([
        ("i1", "O2", D(2026, 8, 5), "sweep_disappearance"), ("i1", "O3", D(2026, 8, 1), "detail_404"),
    ], "source_instance_id string, id string, _deleted_at timestamp, _delete_source string")

    def lead_row(quote, revenue, sales, received):
        return json.dumps({"Quote #": quote, "Status": "Booked", "Lead Status": "Booked", "Branch Name": "Main Office",
                           "Sales Person": sales, "Received at": received, "Service Date": "8/15/2026",
                           "Time to Contact": "1h 5m", "Estimated Revenue": revenue, "Volume/Weight": "525 cuft / 3698 lbs"})

    gen = D(2026, 8, 11, 13)
    rpt = spark.createDataFrame([
        ("i1", "t1", gen, "1001", lead_row("1001", "$1,100.00", "", "8/10/2026 7:16 AM")),
        ("i1", "t1", gen, "9999", lead_row("9999", "$10.00", "Zed", "8/10/2026 7:16 AM")),
        ("i1", "t1", gen, "blank", lead_row("", "$10.00", "Zed", "")),
        ("i1", "t1", D(2026, 8, 1), "old", lead_row("8888", "$10.00", "Zed", "")),
    ], REPORT_SCHEMA)
    bkd = spark.createDataFrame([
        ("i1", "t1", D(2026, 8, 12), "1001", json.dumps({"Quote #": "1001", "Status": "Completed", "Customer Name": "Booked Name",
                                                          "Invoiced Amount": "$1,200.00", "Booked Date": "8/12/2026"})),
    ], REPORT_SCHEMA)
    leads = spark.createDataFrame([
        ("i1", "t1", "L1", "Lee", "l@x.com", "555", "Google ", "Ann", "Main Office", 20260819, 1, None, None, D(2026, 8, 13, 15), D(2026, 8, 13, 16), None, None, "98101"),
        ("i1", "t1", "L2", "Lou", None, None, None, None, "Main Office", 0, 30, "price", None, D(2026, 8, 14, 5), D(2026, 8, 14, 6), "Tacoma", "WA", "98402"),
        ("i1", "t1", "L3", "Liz", None, None, None, None, "Main Office", 0, 0, None, "spam", D(2026, 8, 12, 15), D(2026, 8, 13, 16), None, None, None),
    ], "source_instance_id string, entity_id string, id string, customer_name string, email_address string, phone_number string, "
       "referral_source_name string, sales_person string, branch_name string, service_date int, status bigint, "
       "lost_reason string, bad_lead_reason string, created_at_utc timestamp, _extracted_at timestamp, "
       "origin_city string, origin_state string, origin_zip string")
    inst = spark.createDataFrame(
        [("i1", "t1", "Tenant One", "America/Los_Angeles", "America/Los_Angeles", "long_distance")],
        "instance_id string, entity_id string, entity_name string, timezone string, crm_timezone string, lob_hint string",
    )
    btz = spark.createDataFrame([("i1", "main office", "America/Denver")], "source_instance_id string, branch_name string, timezone string")
    branches = spark.createDataFrame(
        [("i1", "t1", "B1", "Main Office", "555", True, ("1 Main", "1 Main", "Seattle", "WA", "98101", 0.0, 0.0)),
         ("i1", "t1", "B2", "North Branch", "556", False, None)],
        "source_instance_id string, entity_id string, id string, name string, phone_number string, is_primary boolean, "
        "dispatch_location struct<full_address:string,street:string,city:string,state:string,zip:string,lat:double,lng:double>",
    )
    service_types = spark.createDataFrame([("i1", 1, "Commercial Move")], "source_instance_id string, id bigint, name string")
    lob_branch = spark.createDataFrame([("i1", "Main Office", "local")], "source_instance_id string, branch_name string, line_of_business string")
    def job_row(**cells):
        return json.dumps({k.replace("_", " "): v for k, v in cells.items()})

    all_jobs = spark.createDataFrame([
        # the detail call and the report row are of one time: the report leads for the estimator, the detail for sales
        ("i1", "t1", D(2026, 8, 10), "J1", job_row(Job_Id="J1", Job_Number="1001-1", Job_Date="8/15/2026", Estimator_Name="Report Est",
         Sales_Person_Name="Report Sales", Job_Type="Local Move", Total_Actual_Cost="$1,234.50", Origin_City="Seattle",
         Start_Time_Utc="8/15/2026 8:45:00 AM -07:00", Move_Date_Is_TBD="No", Volume="525 cuft / 3698 lbs", Branch_Name="Main Office")),
        ("i1", "t1", D(2026, 8, 1), "J1", job_row(Job_Id="J1", Job_Number="1001-1", Total_Actual_Cost="$1.00")),
        ("i1", "t1", D(2026, 8, 10), "J9", job_row(Job_Id="J9", Job_Number="7777-2", Job_Date="8/16/2026", Customer_Name="Only Here")),
        ("i1", "t1", D(2026, 8, 10), "", job_row(Job_Id=" ", Job_Number="x")),
    ], REPORT_SCHEMA)
    return {
        "report_all_jobs": all_jobs,
        "leads": leads, "opportunities_enriched": opps, "customers_service_window": sweep, "report_lead_status": rpt,
        "report_booked_opportunities": bkd, "webhook_events": hooks, "opportunity_deletions": dels,
        "dim_instance": inst, "dim_opportunity_status": seeds.status_enum(spark), "branch_timezone": btz,
        "dim_branches": branches, "dim_service_types": service_types, "dim_lob_branch": lob_branch,
        "dim_referral_source": spark.createDataFrame([("GOOGLE", "Google", "search", True)],
                                                     "referral_source_raw string, source_clean string, channel_group string, is_paid boolean"),
        "dim_zip": spark.createDataFrame([("98101", "Seattle", "WA"), ("98402", "Tacoma", "WA")], "zip string, city string, state string"),
    }


def test_crm_models_end_to_end(spark):
    wh = tempfile.mkdtemp(prefix="fw-wh-", dir="/tmp")
    out, results = reg.run_checked(spark, crm.crm_registry(AS_OF), _inputs(spark), wh, crm.CRM_CHECKS)
    opps = {r.opportunity_key: r for r in out["core_opportunities"].collect()}
    o1 = opps["i1:O1"]
    assert o1.status_code == 4 and o1.status_label == "Booked" and o1.is_booked  # webhook/sweep newer than detail
    assert o1.estimated_final_total == 1100  # report (Aug 11) beats detail (Aug 10); booked row has no estimate
    assert o1.sales_assignee_name == "Ann"  # the report's blank cell is skipped
    assert o1.customer_name == "Sweep Name"  # the sweep is the newest non-null source
    assert o1.customer_address == "1 Main St" and o1.invoiced_amount == 1200
    assert o1.volume == 525 and o1.synced_at == D(2026, 8, 13)
    assert opps["i1:O2"].is_deleted and opps["i1:O2"].deleted_at == D(2026, 8, 5)
    assert not opps["i1:O3"].is_deleted  # a newer detail snapshot revives
    assert {r.entity_id for r in opps.values()} == {"t1"}

    unmatched = {r.row_key: r.reason for r in out["mart_unmatched_report_rows"].collect()}
    assert unmatched == {"9999": "quote_not_in_api", "blank": "no_quote_number"}

    jobs = {r.job_key: r for r in out["core_jobs"].collect()}
    assert set(jobs) == {"i1:J1", "i1:J9"} and jobs["i1:J1"].service_date == dt.date(2026, 8, 16)
    up = crm.read_upcoming(out["jobs_upcoming_v1"]).collect()
    assert [(r.job_key, r.timezone, r.days_until) for r in up] == [
        ("i1:J9", "America/Los_Angeles", 3), ("i1:J1", "America/Denver", 3),
    ]

    br = {r.external_branch_id: (r.timezone, r.has_timezone_override) for r in out["core_branches"].collect()}
    assert br == {"B1": ("America/Denver", True), "B2": ("America/Los_Angeles", False)}
    lob = {r.job_key: (r.line_of_business, r.lob_source, r.is_unclassified) for r in out["core_lines_of_business"].collect()}
    assert lob == {"i1:J1": ("commercial", "service_type", False), "i1:J9": ("long_distance", "instance", False)}

    pays = out["core_opportunity_payments"].collect()
    assert [(p.opportunity_key, float(p.amount), p.entity_id) for p in pays] == [("i1:O1", 250.0, "t1")]
    addrs = sorted((r.position, r.address, r.n_siblings, r.is_first) for r in out["stg_opportunity_job_addresses"].collect())
    assert addrs == [(0, "12 Elm St", 2, True), (1, "9 Oak Ave", 2, False)]
    assert out["stg_opportunity_job_crew"].count() == 3
    assert out["stg_opportunity_contacts"].first().email_address == "p@x.com"
    att = {r.opportunity_key: (r.document_count, r.document_complete_count, r.job_document_count) for r in out["int_attachment_counts"].collect()}
    assert att == {"i1:O1": (3, 2, 2)}

    bkd = out["mart_booked_by_book_date"].collect()
    assert [(r.booked_date_local, r.n_booked, float(r.invoiced_total)) for r in bkd] == [(dt.date(2026, 8, 12), 1, 1200.0)]
    w = {r.opportunity_key: r for r in out["mart_opportunity_360"].collect()}
    assert float(w["i1:O1"].actual_charges_total) == 850 and float(w["i1:O1"].paid_total) == 250 and w["i1:O1"].n_jobs == 1
    assert w["i1:O2"].n_jobs == 0 and w["i1:O2"].document_count == 0
    # the booked report (newest) says 'Completed'; the lead-status row still says 'Booked'
    assert o1.pipeline_status == "Completed"
    q = [(r.opportunity_key, r.reason) for r in out["mart_enrichment_candidates"].collect()]
    assert q == [("i1:O1", "status_differs")]
    assert out["opportunities_v1"].columns == [f.name for f in crm.OPPORTUNITIES_V1.fields]
    assert sorted(r.job_key for r in out["jobs_v1"].collect()) == ["i1:J1", "i1:J9"]

    charges = out["core_opportunity_charges"].groupBy("charge_kind").agg(F.sum("total_cost").alias("t")).collect()
    assert {r.charge_kind: r.t for r in charges} == {"estimated": 800, "actual": 850}

    leads = {r.lead_key: r for r in out["core_leads"].collect()}
    assert leads["i1:L1"].lead_disposition == "In Progress"
    assert leads["i1:L2"].lead_disposition == "Lost" and leads["i1:L3"].lead_disposition == "Bad Lead"
    assert (leads["i1:L1"].referral_channel, leads["i1:L1"].referral_is_paid) == ("search", True)
    assert (leads["i1:L1"].origin_city, leads["i1:L1"].origin_state) == ("Seattle", "WA")  # filled from the ZIP
    assert leads["i1:L2"].origin_city == "Tacoma" and leads["i1:L3"].origin_city is None
    today = sorted(r.lead_key for r in out["leads_today_v1"].collect())
    assert today == ["i1:L1", "i1:L2"]  # L2 is 23:00 on Aug 13 in the branch's zone
    assert leads["i1:L2"].local_tz == "America/Denver" and leads["i1:L2"].created_at_local.hour == 23

    assert float(jobs["i1:J1"].total_actual_cost) == 1234.5
    assert jobs["i1:J1"].start_at_utc == D(2026, 8, 15, 15, 45) and jobs["i1:J1"].move_date_is_tbd is False
    assert (jobs["i1:J1"].origin_city, float(jobs["i1:J1"].volume_cuft), jobs["i1:J1"].quote_number) == ("Seattle", 525.0, "1001")
    assert (jobs["i1:J9"].customer_name, jobs["i1:J9"].entity_id, jobs["i1:J9"].opportunity_key) == ("Only Here", "t1", None)
    core = {r.opportunity_key: r for r in out["core_opportunities"].collect()}
    assert (core["i1:O1"].estimator_name, core["i1:O1"].sales_assignee_name) == ("Report Est", "Ann")

    rpt = out["stg_report_lead_status"].filter("row_key = '1001'").first()
    assert rpt.received_at_utc == D(2026, 8, 10, 14, 16) and rpt.time_to_contact_minutes == 65

    assert len(crm.CRM_CHECKS) >= 173
    rows = {(r.check_name, r.table_name, r.column_name): (r.failing_rows, r.sample) for r in results.collect()}
    assert len(rows) == len(crm.CRM_CHECKS) and {k: v for k, v in rows.items() if v[0]} == {}


def test_a_job_two_sources_attach_differently_stays_one(spark):
    schema = (
        "source_instance_id string, external_job_id string, opportunity_key string, external_opportunity_id string,"
        " job_number string, service_date date, service_type_id bigint, observed_at timestamp"
    )
    day = dt.date(2026, 8, 1)
    detail = spark.createDataFrame([("i1", "J1", "i1:O1", "O1", "1-1", day, 1, D(2026, 8, 1))], schema)
    sweep = spark.createDataFrame([("i1", "J1", "i1:O2", "O2", "1-1", day, 2, D(2026, 8, 2))], schema)
    opps = spark.createDataFrame(
        [("i1:O2", "t1", "Name", "Main", "Booked", D(2026, 8, 3))],
        "opportunity_key string, entity_id string, customer_name string, branch_name string, status_label string, synced_at timestamp",
    )
    (job,) = crm.core_jobs(detail, sweep, opps).collect()
    assert (job.job_key, job.opportunity_key, job.external_opportunity_id, job.customer_name) == ("i1:J1", "i1:O2", "O2", "Name")


def test_charge_lines_without_an_opportunity_are_kept(spark):
    charges = spark.createDataFrame([("i1:X", "c1")], "opportunity_key string, charge_key string")
    opps = spark.createDataFrame([], "opportunity_key string, entity_id string, source_instance_id string, synced_at timestamp")
    assert crm.core_opportunity_charges(charges, opps).count() == 1


def test_crm_selective_rebuild_only_touches_downstream(spark):
    r = crm.crm_registry(AS_OF)
    todo = r.downstream(["report_booked_opportunities"])
    assert "stg_report_booked" in todo and "core_opportunities" in todo and "jobs_upcoming_v1" in todo
    assert "core_leads" not in todo and "stg_leads" not in todo


FULL_DETAIL = (
    "source_instance_id string, entity_id string, id string, quote_number bigint, opportunity_type int, type bigint, status bigint, service_date int, "
    "lead_status string, volume double, weight double, volume_weight_calculation_mode bigint, has_trip_info boolean, "
    "trip_info struct<is_trip_info_applied:boolean>, allow_inventory_updates boolean, referral_source string, affiliate_id string, affiliate_name string, "
    "cancellation_reason string, tariff struct<id:string,name:string>, estimated_total struct<subtotal:double,taxable_amount:double,tax:double,final_total:double>, "
    "move_size struct<name:string,description:string,volume:double>, branch struct<name:string,phone_number:string>, "
    "customer struct<id:string,name:string,email_address:string,phone_number:string,phone_type:bigint>, sales_assignee struct<id:string,name:string>, "
    "estimator struct<name:string,mobile_number:string,branch_id:string,title:string>, move_coordinator struct<id:string,name:string>, "
    "created_at_utc timestamp, _snapshot_at timestamp, _extracted_at timestamp, "
    "jobs array<struct<id:string,job_number:string,job_date:int,type:bigint,confirmed:boolean,total_tips:double,"
    "arrival_window:struct<id:string,description:string,start_time:string,end_time:string,is_default:boolean>,"
    "job_time:struct<labor_time:struct<estimated:double,actual:double>,travel_time:struct<estimated:double,actual:double>,billable_hours:double>,"
    "estimated_charges:array<struct<name:string,charge_category:bigint,description:string,editable_description:string,sort_order:bigint,subtotal:double,discount_amount:double,total_cost:double>>,"
    "actual_charges:array<struct<name:string,charge_category:bigint,description:string,editable_description:string,sort_order:bigint,subtotal:double,discount_amount:double,total_cost:double>>>>"
)


def _detail(snap, tips, window, hours, reason, affiliate):
    charge = [("Labor", 3, "by the hour", "", 1, 900.0, 100.0, 800.0)]
    job = ("J1", "1-1", 20260815, 7, True, tips, ("W", window, "08:00", "10:00", False), ((4.0, 5.5), (1.0, 1.25), hours), charge, charge)
    return (
        "i1", "t1", "O1", 1, 2, 7, 20, 20260815, "x", 1.0, 2.0, 1, True, (True,), False, "Google", "A1", affiliate, reason, ("T1", "Tariff"),
        (900.0, 900.0, 0.0, 900.0), ("2 rooms", "two", 525.0), ("Main", "555"), ("C1", "N", "e", "5", 4), ("S1", "Ann"), ("Est", "556", "B1", "Lead"),
        ("M1", "Coord"), D(2026, 8, 1), snap, D(2026, 8, 9), [job],
    )


def test_every_field_of_the_detail_is_staged_and_resolved(spark):
    old, new = D(2026, 8, 1), D(2026, 8, 5)
    raw = spark.createDataFrame([_detail(old, 10.0, "morning", 6.0, "price", "Old"), _detail(new, 25.5, "", None, "moved away", "New")], FULL_DETAIL)
    enr = crm.stg_opportunities_enriched(raw)
    assert len(enr.columns) >= 45 and set(crm.DETAIL_FIELDS) <= set(enr.columns)
    row = enr.filter("affiliate_name = 'New'").first()
    assert (row.opportunity_type_code, row.service_type_id, row.tariff_name, row.move_size_name, row.branch_phone) == (2, 7, "Tariff", "2 rooms", "555")
    assert row.is_trip_info_applied and float(row.estimated_taxable_amount) == 900 and row.estimator_title == "Lead" and row.synced_at == D(2026, 8, 9)
    jobs = crm.stg_opportunity_jobs(raw)
    schema = "source_instance_id string, external_job_id string, opportunity_key string, external_opportunity_id string, job_number string, service_date date, service_type_id bigint, observed_at timestamp"
    sweep = spark.createDataFrame([("i1", "J1", "i1:O1", "O1", "1-1", dt.date(2026, 8, 16), 7, D(2026, 8, 7))], schema)
    opps = spark.createDataFrame([("i1:O1", "t1", "N", "Main", "Booked", D(2026, 8, 3))], "opportunity_key string, entity_id string, customer_name string, branch_name string, status_label string, synced_at timestamp")
    (job,) = crm.core_jobs(jobs, sweep, opps).collect()
    # the newest detail row counts whole: its blank window and missing hours hide the older ones
    assert job.is_confirmed and float(job.total_tips) == 25.5 and job.arrival_window_description is None and job.billable_hours is None
    assert [float(job[c]) for c in ("labor_time_estimated", "labor_time_actual", "travel_time_estimated", "travel_time_actual")] == [4.0, 5.5, 1.0, 1.25]
    assert job.service_date == dt.date(2026, 8, 16)  # the sweep is newer and says nothing of the detail's fields
    obs = crm.stack_observations(
        enr, [crm.OPP_KEY, "source_instance_id", "external_opportunity_id"],
        [crm.ArmSpec(crm.ENR, 1, F.col("observed_at"), {c: F.col(c) for c in ("service_type_id", "affiliate_name", "tariff_name", "move_size_name", "cancellation_reason")})],
        crm.OBS_FIELDS, candidates=crm.OPPORTUNITY_CANDIDATES,
    )
    res = crm.resolve(obs, [crm.OPP_KEY], crm.OPPORTUNITY_CANDIDATES).first()
    assert (res.service_type_id, res.affiliate_name, res.tariff_name, res.move_size_name, res.cancellation_reason) == (7, "New", "Tariff", "2 rooms", "moved away")
    charge = crm.stg_opportunity_job_charges(raw).first()
    assert (float(charge.subtotal), float(charge.discount_amount), charge.charge_category_code, charge.charge_description, charge.sort_order) == (900, 100, 3, "by the hour", 1)
    assert charge.charge_editable_description is None


def test_staging_of_customers_service_types_and_branches(spark):
    inputs = _inputs(spark)
    (c,) = crm.stg_customers(inputs["customers_service_window"]).collect()
    assert (c.customer_key, c.customer_name, c.customer_address) == ("i1:C1", "Sweep Name", "1 Main St")
    (s,) = crm.stg_service_types(inputs["dim_service_types"]).collect()
    assert (s.service_type_id, s.service_type_name, s.entity_id) == (1, "Commercial Move", None)
    b = crm.core_branches(crm.stg_branches(inputs["dim_branches"]), inputs["branch_timezone"], inputs["dim_instance"])
    first = b.filter("external_branch_id = 'B1'").first()
    assert (first.crm_timezone, first.address, first.zip, first.lat, first.synced_at) == ("America/Los_Angeles", "1 Main", "98101", 0.0, None)
    report = crm.stg_report_lead_status(inputs["report_lead_status"].withColumn("_source_email", F.lit("m@x.com")), inputs["dim_instance"])
    xwalk = spark.createDataFrame([], "source_instance_id string, quote_number string, opportunity_id string")
    lost = crm.mart_unmatched_report_rows(report, xwalk).filter("row_key = '9999'").first()
    assert (lost.status_raw, lost.branch_name, float(lost.estimated_revenue), lost.source_email) == ("Booked", "Main Office", 10.0, "m@x.com")
    assert lost.service_date == dt.date(2026, 8, 15) and lost.received_at_utc == D(2026, 8, 10, 14, 16)


def test_planted_failures_are_found_while_writing(spark, tmp_path):
    r = reg.Registry()
    r.source("raw")
    r.add(reg.Model("t", "core", lambda raw: raw.select("id", "kind", "n"), ["raw"]))
    raw = spark.createDataFrame([(1, "a", "5"), (2, None, "x"), (3, "z", ""), (4, "z", None)], "id bigint, kind string, n string")
    checks = [
        quality.Check("not_null", "t", ("kind",), ("id",)),
        quality.Check("accepted_values", "t", ("kind",), ("id",), values=("a", "b")),
        quality.Check("accepted_values", "t", ("kind",), ("id",), values=("a", "b"), where="id > 3"),
        quality.Check("unique", "t", ("kind",), ()),
    ]
    _, results = reg.run_checked(spark, r, {"raw": raw}, str(tmp_path), checks)
    found = lambda df: sorted((x.check_name, x.failing_rows, x.sample) for x in df.collect())
    assert found(results) == [("accepted_values", 1, "4"), ("accepted_values", 2, "3"), ("not_null", 1, "2"), ("unique", 1, "z")]
    assert found(quality.run_checks(checks, {"t": raw})) == found(results)
    losses = {"n": (F.col("n"), F.expr("try_cast(n as int)"))}
    observed = quality.Observed([], losses)
    df = observed.attach(raw)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()  # no aggregation beside the write
    df.write.parquet(f"{tmp_path}/observed")
    assert observed.lost() == [("n", 2, 1)]
    (loss,) = quality.parse_losses(raw, losses).collect()
    assert (loss.n_nonblank, loss.n_lost) == (2, 1)
