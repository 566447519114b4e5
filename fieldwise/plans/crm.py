"""The CRM warehouse as one configuration of the engine (§2.13 models).

Raw inputs follow the landed shapes (nested API payloads, report rows as
JSON text, the webhook log, seeds). Every model is a function of DataFrames
registered in a :class:`~fieldwise.plans.registry.Registry`; the engine's
operators do the work. ``AS_OF`` is a parameter of the build, so "today" is
repeatable.

Raw table names: ``leads``, ``opportunities_enriched`` (nested jobs and
charges), ``customers_service_window`` (nested opportunities and jobs),
``report_lead_status``, ``report_booked_opportunities``, ``webhook_events``,
``opportunity_deletions`` and the seeds ``dim_instance``,
``dim_opportunity_status``, ``branch_timezone``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts, text
from ..functions.json import has_key, json_int, json_struct
from ..functions.time import days_until, entity_today, in_window, local_date, local_timestamp, zone_of
from ..operators import bridge, quality, rules
from ..operators.joins import bounded_broadcast, norm_key_join
from ..operators.resolve import Candidates, resolve
from ..operators.union import ArmSpec, stack_observations
from ..sources.nested import flatten, grandchildren
from . import all_jobs
from .registry import Model, Registry

OPP_KEY = "opportunity_key"

# Observation sources and their priorities (lower wins a tie
# inside one source's history).
ENR, WHK, SWP, DEL, RPT, BKD = "api_enrichment", "webhook", "api_sweep", "deletion", "report_lead_status", "report_booked"
AJO, RPJ = "jobs_attribution", "report_all_jobs"
PRIORITY = {ENR: 1, WHK: 2, SWP: 3, DEL: 4, RPT: 5, BKD: 6, AJO: 7, RPJ: 8}

# The opportunity candidate table, most authoritative first.
OPPORTUNITY_CANDIDATES = Candidates(
    fields={
        "quote_number": [ENR, SWP, RPT],
        "status_code": [ENR, WHK, SWP],
        "pipeline_status": [ENR, RPT, BKD],
        "service_date": [ENR, RPT],
        "external_customer_id": [ENR, SWP],
        "customer_name": [BKD, ENR, SWP],
        "customer_email": [BKD, ENR, SWP],
        "customer_phone": [BKD, ENR, SWP],
        "customer_address": [SWP],
        "branch_name": [ENR, RPT, AJO],
        "referral_source": [ENR, RPT, AJO],
        "estimated_final_total": [ENR, RPT, BKD],
        "estimated_subtotal": [ENR],
        "estimated_tax": [ENR],
        "volume": [ENR, RPT],
        "weight": [ENR, RPT],
        "sales_assignee_name": [ENR, RPT, AJO],
        "estimator_name": [AJO, ENR, RPT],
        "move_coordinator_name": [AJO, ENR, RPT],
        "opportunity_type_code": [ENR],
        "service_type_id": [ENR],
        "affiliate_name": [ENR],
        "tariff_name": [ENR],
        "move_size_name": [ENR],
        "cancellation_reason": [ENR],
        "created_at_utc": [ENR],
        "invoiced_amount": [BKD],
        "booked_date_local": [BKD],
        "is_deleted": [DEL, ENR],
        "deleted_at": [DEL],
    },
    freshness_sources=[ENR, WHK, SWP, DEL, RPT, BKD],
)
OBS_FIELDS = {
    "quote_number": "string", "status_code": "int", "pipeline_status": "string", "service_date": "date",
    "external_customer_id": "string", "customer_name": "string", "customer_email": "string",
    "customer_phone": "string", "customer_address": "string", "branch_name": "string", "referral_source": "string",
    "estimated_final_total": "decimal(18,2)", "estimated_subtotal": "decimal(18,2)", "estimated_tax": "decimal(18,2)",
    "volume": "decimal(18,4)", "weight": "decimal(18,4)", "sales_assignee_name": "string", "estimator_name": "string",
    "move_coordinator_name": "string", "opportunity_type_code": "int", "service_type_id": "bigint", "affiliate_name": "string",
    "tariff_name": "string", "move_size_name": "string", "cancellation_reason": "string", "created_at_utc": "timestamp",
    "invoiced_amount": "decimal(18,2)", "booked_date_local": "date", "is_deleted": "boolean", "deleted_at": "timestamp",
}

# Further fields of the detail payload, by their path in it; a payload without one gives null.
DETAIL_FIELDS = {
    "opportunity_type_code": ("opportunity_type", "int"),
    "service_type_id": ("type", "bigint"),
    "volume_weight_calculation_mode_code": ("volume_weight_calculation_mode", "bigint"),
    "has_trip_info": ("has_trip_info", "boolean"),
    "is_trip_info_applied": ("trip_info.is_trip_info_applied", "boolean"),
    "allow_inventory_updates": ("allow_inventory_updates", "boolean"),
    "affiliate_id": ("affiliate_id", "string"),
    "affiliate_name": ("affiliate_name", "string"),
    "cancellation_reason": ("cancellation_reason", "string"),
    "tariff_id": ("tariff.id", "string"),
    "tariff_name": ("tariff.name", "string"),
    "estimated_taxable_amount": ("estimated_total.taxable_amount", "decimal(18,2)"),
    "move_size_name": ("move_size.name", "string"),
    "move_size_description": ("move_size.description", "string"),
    "move_size_volume": ("move_size.volume", "decimal(18,4)"),
    "branch_phone": ("branch.phone_number", "string"),
    "customer_phone_type_code": ("customer.phone_type", "bigint"),
    "sales_assignee_id": ("sales_assignee.id", "string"),
    "estimator_mobile": ("estimator.mobile_number", "string"),
    "estimator_branch_id": ("estimator.branch_id", "string"),
    "estimator_title": ("estimator.title", "string"),
    "move_coordinator_id": ("move_coordinator.id", "string"),
    "synced_at": ("_extracted_at", "timestamp"),
}
# The same for a job, and which of them are resolved (the detail alone has them).
JOB_DETAIL_FIELDS = {
    "is_confirmed": ("confirmed", "boolean"),
    "total_tips": ("total_tips", "decimal(18,2)"),
    "arrival_window_id": ("arrival_window.id", "string"),
    "arrival_window_description": ("arrival_window.description", "string"),
    "arrival_window_start_time": ("arrival_window.start_time", "string"),
    "arrival_window_end_time": ("arrival_window.end_time", "string"),
    "arrival_window_is_default": ("arrival_window.is_default", "boolean"),
    "labor_time_estimated": ("job_time.labor_time.estimated", "decimal(18,4)"),
    "labor_time_actual": ("job_time.labor_time.actual", "decimal(18,4)"),
    "travel_time_estimated": ("job_time.travel_time.estimated", "decimal(18,4)"),
    "travel_time_actual": ("job_time.travel_time.actual", "decimal(18,4)"),
    "billable_hours": ("job_time.billable_hours", "decimal(18,4)"),
}
RESOLVED_JOB_DETAIL = [
    "is_confirmed", "total_tips", "arrival_window_description", "labor_time_estimated", "labor_time_actual",
    "travel_time_estimated", "travel_time_actual", "billable_hours",
]
CHARGE_FIELDS = {
    "charge_category_code": ("charge_category", "bigint"),
    "charge_description": ("description", "string"),
    "charge_editable_description": ("editable_description", "string"),
    "sort_order": ("sort_order", "bigint"),
    "subtotal": ("subtotal", "decimal(18,2)"),
    "discount_amount": ("discount_amount", "decimal(18,2)"),
}
BRANCH_FIELDS = {
    "address": ("dispatch_location.full_address", "string"),
    "street": ("dispatch_location.street", "string"),
    "city": ("dispatch_location.city", "string"),
    "state": ("dispatch_location.state", "string"),
    "zip": ("dispatch_location.zip", "string"),
    "lat": ("dispatch_location.lat", "double"),
    "lng": ("dispatch_location.lng", "double"),
    "synced_at": ("_extracted_at", "timestamp"),
}
# Further fields of a lead.
LEAD_FIELDS = {
    **{c: (c, "string") for c in ("origin_city", "origin_state", "origin_zip", "destination_city", "destination_state", "destination_zip")},
    "move_size_name": ("move_size_name", "string"),
}

# Declared headers of the two modelled reports.
LEAD_STATUS_HEADERS = [
    "Quote #", "Status", "Lead Status", "Branch Name", "Service Type", "Sales Person", "Estimator",
    "Move Coordinator", "Referral Source", "Received at", "Quote Sent", "Last Communication", "Service Date",
    "Time to Contact", "Estimated Revenue", "Volume/Weight",
]
BOOKED_HEADERS = [
    "Quote #", "Status", "Customer Name", "Email", "Phone Number", "Invoiced Amount", "Estimated Amount",
    "Booked Date", "Service Date",
]

JOBS_UPCOMING_V1 = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("source_instance_id", T.StringType()),
        T.StructField("job_key", T.StringType()),
        T.StructField("external_job_id", T.StringType()),
        T.StructField("job_number", T.StringType()),
        T.StructField("service_date", T.DateType()),
        T.StructField("days_until", T.IntegerType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("branch_name", T.StringType()),
        T.StructField("status_label", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("synced_at", T.TimestampType()),
    ]
)


def _nn(c) -> F.Column:
    return text.blank_to_null(c)


def _has(schema: T.StructType, path: str) -> bool:
    head, _, rest = path.partition(".")
    if head not in schema.fieldNames():
        return False
    return not rest or (isinstance(schema[head].dataType, T.StructType) and _has(schema[head].dataType, rest))


def _fields(df: DataFrame, fields: dict[str, tuple[str, str]]) -> list[F.Column]:
    """Declared payload fields, typed; blank text and what the payload lacks are null."""
    out = []
    for name, (path, kind) in fields.items():
        c = F.col(path) if _has(df.schema, path) else F.lit(None)
        out.append((_nn(c.cast(kind)) if kind == "string" else c.cast(kind)).alias(name))
    return out


# ------------------------------------------------------------------ staging
def stg_leads(leads: DataFrame) -> DataFrame:
    return leads.select(
        text.surrogate_key("source_instance_id", "id").alias("lead_key"),
        "source_instance_id", "entity_id", F.col("id").alias("external_lead_id"),
        _nn("customer_name").alias("customer_name"), _nn("email_address").alias("customer_email"),
        _nn("phone_number").alias("customer_phone"), _nn("referral_source_name").alias("referral_source"),
        _nn("sales_person").alias("sales_person"), _nn("branch_name").alias("branch_name"),
        casts.int_date("service_date").alias("service_date"), F.col("status").cast("int").alias("lead_status_code"),
        _nn("lost_reason").alias("lost_reason"), _nn("bad_lead_reason").alias("bad_lead_reason"),
        *_fields(leads, LEAD_FIELDS),
        "created_at_utc", F.col("_extracted_at").alias("synced_at"),
    )


def stg_opportunities_enriched(opps: DataFrame) -> DataFrame:
    return opps.select(
        text.surrogate_key("source_instance_id", "id").alias(OPP_KEY),
        "source_instance_id", "entity_id", F.col("id").alias("external_opportunity_id"),
        F.col("_snapshot_at").alias("observed_at"),
        F.col("quote_number").cast("string").alias("quote_number"), F.col("status").cast("int").alias("status_code"),
        _nn("lead_status").alias("pipeline_status"), casts.int_date("service_date").alias("service_date"),
        _nn(F.col("customer.id")).alias("external_customer_id"), _nn(F.col("customer.name")).alias("customer_name"),
        _nn(F.col("customer.email_address")).alias("customer_email"),
        _nn(F.col("customer.phone_number")).alias("customer_phone"), _nn(F.col("branch.name")).alias("branch_name"),
        _nn("referral_source").alias("referral_source"),
        F.col("estimated_total.subtotal").cast("decimal(18,2)").alias("estimated_subtotal"),
        F.col("estimated_total.tax").cast("decimal(18,2)").alias("estimated_tax"),
        F.col("estimated_total.final_total").cast("decimal(18,2)").alias("estimated_final_total"),
        F.col("volume").cast("decimal(18,4)").alias("volume"), F.col("weight").cast("decimal(18,4)").alias("weight"),
        _nn(F.col("sales_assignee.name")).alias("sales_assignee_name"),
        _nn(F.col("estimator.name")).alias("estimator_name"),
        _nn(F.col("move_coordinator.name")).alias("move_coordinator_name"),
        "created_at_utc", *_fields(opps, DETAIL_FIELDS),
    )


def stg_opportunity_jobs(opps: DataFrame) -> DataFrame:
    """S2 + J1: the detail payload's jobs, with the parent's composite key."""
    o = opps.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "id")).withColumnRenamed("id", "_opp_id")
    j = flatten(o, "jobs", [OPP_KEY], carry=["source_instance_id", "entity_id", "_snapshot_at", "_opp_id"])
    return j.select(
        F.col(f"_parent_{OPP_KEY}").alias(OPP_KEY), "source_instance_id", "entity_id",
        F.col("_opp_id").alias("external_opportunity_id"), F.col("_snapshot_at").alias("observed_at"),
        F.col("_list_idx").alias("job_index"), F.col("id").alias("external_job_id"),
        _nn("job_number").alias("job_number"), casts.int_date("job_date").alias("service_date"),
        F.col("type").alias("service_type_id"), *_fields(j, JOB_DETAIL_FIELDS),
    )


def stg_opportunity_job_charges(opps: DataFrame) -> DataFrame:
    """U3 + S2 (two levels): estimated and actual charge lines in one table."""
    o = opps.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "id"))
    parts = []
    for kind, col in (("estimated", "estimated_charges"), ("actual", "actual_charges")):
        jobs = o.select(OPP_KEY, F.transform("jobs", lambda j: F.struct(j["id"].alias("job_id"), j[col].alias("lines"))).alias("jobs"))
        g = grandchildren(jobs, "jobs", "lines", [OPP_KEY])
        parts.append(
            g.select(
                F.col(f"_root_{OPP_KEY}").alias(OPP_KEY), F.col("_parent_job_idx").alias("job_index"),
                F.col("_list_idx").alias("line_index"),
                F.lit(kind).alias("charge_kind"), _nn("name").alias("charge_name"), *_fields(g, CHARGE_FIELDS),
                F.col("total_cost").cast("decimal(18,2)").alias("total_cost"),
            )
        )
    out = parts[0].unionByName(parts[1])
    return out.withColumn(
        "charge_key",
        text.surrogate_key(OPP_KEY, "job_index", "charge_kind", "line_index"),
    )


def _children(opps: DataFrame, col: str, fields: dict[str, str]) -> DataFrame:
    """S2 + J1 for one child array of the detail payload (empty, typed, when absent)."""
    o = opps.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "id"))
    if col not in opps.columns:
        empty = o.limit(0).select(OPP_KEY, "source_instance_id", "entity_id", F.lit(None).cast("bigint").alias("child_index"))
        return empty.select("*", *[F.lit(None).cast(t).alias(f) for f, t in fields.items()])
    c = flatten(o, col, [OPP_KEY], carry=["source_instance_id", "entity_id"])
    return c.select(
        F.col(f"_parent_{OPP_KEY}").alias(OPP_KEY), "source_instance_id", "entity_id",
        F.col("_list_idx").alias("child_index"), *[F.col(f).cast(t).alias(f) for f, t in fields.items()],
    )


def stg_opportunity_payments(opps: DataFrame) -> DataFrame:
    p = _children(opps, "payments", {
        "source": "bigint", "payment_type": "bigint", "payment_category": "bigint", "amount": "decimal(18,2)",
        "amount_refunded": "decimal(18,2)", "is_outstanding": "boolean", "taken_by_user": "string",
    })
    return p.withColumn("payment_key", text.surrogate_key(OPP_KEY, "child_index"))


def stg_opportunity_contacts(opps: DataFrame) -> DataFrame:
    c = _children(opps, "contacts", {"name": "string", "email_address": "string", "phone_number": "string", "phone_type": "bigint"})
    return c.withColumn("name", _nn("name")).withColumn("email_address", F.lower(_nn("email_address")))


def stg_opportunity_surveys(opps: DataFrame) -> DataFrame:
    return _children(opps, "surveys", {
        "type": "bigint", "start_at_utc": "timestamp", "duration_minutes": "bigint", "is_confirmed": "boolean", "notes": "string",
    })


def _job_strings(opps: DataFrame, col: str, out: str) -> DataFrame:
    """Ordered strings under each job (addresses, crew): value + position + sibling count."""
    o = opps.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "id"))
    job_fields = opps.schema["jobs"].dataType.elementType.fieldNames() if "jobs" in opps.columns else []
    if col not in job_fields:
        return o.limit(0).select(OPP_KEY, F.lit(None).cast("bigint").alias("job_index"),
                                 F.lit(None).cast("bigint").alias("position"), F.lit(None).cast("string").alias(out),
                                 F.lit(None).cast("int").alias("n_siblings"), F.lit(None).cast("boolean").alias("is_first"))
    jobs = o.select(OPP_KEY, F.transform("jobs", lambda j: F.struct(j[col].alias("vals"))).alias("jobs"))
    g = grandchildren(jobs, "jobs", "vals", [OPP_KEY])
    return g.select(
        F.col(f"_root_{OPP_KEY}").alias(OPP_KEY), F.col("_parent_job_idx").alias("job_index"),
        F.col("_list_idx").alias("position"), _nn("value").alias(out), F.col("_n_siblings").alias("n_siblings"),
        (F.col("_list_idx") == 0).alias("is_first"),  # F10; list order is not origin/destination (T15)
    )


def stg_opportunity_job_addresses(opps: DataFrame) -> DataFrame:
    return _job_strings(opps, "job_addresses", "address")


def stg_opportunity_job_crew(opps: DataFrame) -> DataFrame:
    return _job_strings(opps, "crew_members", "crew_member")


def int_attachment_counts(opps: DataFrame) -> DataFrame:
    """A-1 + J14 + F11: documents (and complete ones), files, photos, job documents per
    opportunity - each pre-aggregated, then joined; grain = opportunities with any."""
    o = opps.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "id"))
    base = o.select(OPP_KEY, "source_instance_id", "entity_id")

    def counted(col, name, complete=None):
        if col not in opps.columns:
            return None
        c = flatten(o, col, [OPP_KEY]).withColumnRenamed(f"_parent_{OPP_KEY}", OPP_KEY)
        aggs = [F.count(F.lit(1)).alias(name)]
        if complete:
            aggs.append(F.count_if(F.col("is_complete")).alias(complete))
        return c.groupBy(OPP_KEY).agg(*aggs)

    parts = [
        counted("opportunity_documents", "document_count", "document_complete_count"),
        counted("opportunity_files", "file_count"),
        counted("photos", "photo_count"),
    ]
    if "jobs" in opps.columns and "job_documents" in opps.schema["jobs"].dataType.elementType.fieldNames():
        jd = grandchildren(o.select(OPP_KEY, "jobs"), "jobs", "job_documents", [OPP_KEY])
        parts.append(jd.groupBy(F.col(f"_root_{OPP_KEY}").alias(OPP_KEY)).agg(
            F.count(F.lit(1)).alias("job_document_count"), F.count_if(F.col("is_complete")).alias("job_document_complete_count")
        ))
    names = ["document_count", "document_complete_count", "file_count", "photo_count", "job_document_count", "job_document_complete_count"]
    out = base
    for part in parts:
        if part is not None:
            out = out.join(part, OPP_KEY, "left")
    for n in names:
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(0).cast("bigint")) if n in out.columns else F.lit(0).cast("bigint"))
    return out.filter(sum((F.col(n) for n in names if "complete" not in n), F.lit(0)) > 0)


def stg_sweep(customers: DataFrame) -> DataFrame:
    """The sweep's opportunities under each customer (J3 without a join)."""
    opp = flatten(
        customers, "opportunities", ["id"],
        carry=["source_instance_id", "entity_id", "_extracted_at", "name", "email_address", "phone_number", "address"],
    )
    return opp.select(
        text.surrogate_key("source_instance_id", "id").alias(OPP_KEY), "source_instance_id", "entity_id",
        F.col("id").alias("external_opportunity_id"), F.col("_extracted_at").alias("observed_at"),
        F.col("_parent_id").alias("external_customer_id"), _nn("name").alias("customer_name"),
        _nn("email_address").alias("customer_email"), _nn("phone_number").alias("customer_phone"),
        _nn("address").alias("customer_address"), F.col("quote_number").cast("string").alias("quote_number"),
        F.col("status").cast("int").alias("status_code"), "jobs",
    )


def stg_sweep_jobs(sweep: DataFrame) -> DataFrame:
    j = flatten(sweep, "jobs", [OPP_KEY], carry=["source_instance_id", "entity_id", "external_opportunity_id", "observed_at"])
    return j.select(
        F.col(f"_parent_{OPP_KEY}").alias(OPP_KEY), "source_instance_id", "entity_id", "external_opportunity_id",
        "observed_at", F.col("id").alias("external_job_id"), _nn("job_number").alias("job_number"),
        casts.iso_date("service_date").alias("service_date"), F.col("type").alias("service_type_id"),
    )


def stg_report_lead_status(report: DataFrame, instances: DataFrame) -> DataFrame:
    """The lead-status report typed, parsed once."""
    inst = bounded_broadcast(instances.select(F.col("instance_id").alias("source_instance_id"), "crm_timezone"))
    r = report.join(inst, "source_instance_id", "left").withColumn("r", json_struct("row_data", LEAD_STATUS_HEADERS))
    c = lambda h: F.col("r")[h]
    tz = F.col("crm_timezone")
    return r.select(
        text.surrogate_key("source_instance_id", "row_key", text.compact_stamp("report_generated_at")).alias("report_row_key"),
        "source_instance_id", "entity_id", "report_generated_at", "row_key",
        _nn(c("Quote #")).alias("quote_number"), _nn(c("Status")).alias("status_raw"),
        _nn(c("Lead Status")).alias("pipeline_status"), _nn(c("Branch Name")).alias("branch_name"),
        _nn(c("Service Type")).alias("service_type_name"), _nn(c("Sales Person")).alias("sales_assignee_name"),
        _nn(c("Estimator")).alias("estimator_name"), _nn(c("Move Coordinator")).alias("move_coordinator_name"),
        _nn(c("Referral Source")).alias("referral_source"),
        casts.rpt_ts(c("Received at"), tz).alias("received_at_utc"),
        casts.rpt_ts(c("Quote Sent"), tz).alias("quote_sent_at_utc"),
        casts.rpt_ts(c("Last Communication"), tz).alias("last_communication_at_utc"),
        casts.rpt_date(c("Service Date")).alias("service_date"),
        casts.rpt_minutes(c("Time to Contact")).alias("time_to_contact_minutes"),
        casts.rpt_num(c("Estimated Revenue")).alias("estimated_final_total"),
        casts.rpt_cuft(c("Volume/Weight")).alias("volume"), casts.rpt_lbs(c("Volume/Weight")).alias("weight"),
        "crm_timezone", "row_data", *_fields(r, {"source_email": ("_source_email", "string")}),
    )


def stg_report_booked(report: DataFrame) -> DataFrame:
    r = report.withColumn("r", json_struct("row_data", BOOKED_HEADERS))
    c = lambda h: F.col("r")[h]
    return r.select(
        "source_instance_id", "entity_id", "report_generated_at", "row_key",
        _nn(c("Quote #")).alias("quote_number"), _nn(c("Status")).alias("pipeline_status"),
        _nn(c("Customer Name")).alias("customer_name"), _nn(c("Email")).alias("customer_email"),
        _nn(c("Phone Number")).alias("customer_phone"), casts.rpt_num(c("Invoiced Amount")).alias("invoiced_amount"),
        casts.rpt_num(c("Estimated Amount")).alias("estimated_final_total"),
        casts.rpt_date(c("Booked Date")).alias("booked_date_local"),
    )


def stg_webhook_status(events: DataFrame) -> DataFrame:
    """F3 + X12: status events whose payload has both keys (JSON null still counts)."""
    ok = has_key("payload", "opportunity-id") & has_key("payload", "opportunity-status")
    e = events.filter(ok)
    opp = F.get_json_object("payload", "$['opportunity-id']")
    return e.select(
        text.surrogate_key("source_instance_id", opp).alias(OPP_KEY), "source_instance_id", "entity_id",
        opp.alias("external_opportunity_id"), F.col("received_at").alias("observed_at"), "event_id",
        json_int("payload", "opportunity-status").alias("status_code"),
    )


def stg_branches(branches: DataFrame) -> DataFrame:
    """rename and type the branch reference list."""
    return branches.select(
        text.surrogate_key("source_instance_id", "id").alias("branch_key"), "source_instance_id", "entity_id",
        F.col("id").alias("external_branch_id"), _nn("name").alias("branch_name"),
        _nn("phone_number").alias("phone_number"), F.coalesce("is_primary", F.lit(False)).alias("is_primary"),
        *_fields(branches, BRANCH_FIELDS),
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    """F1 + F2: the sweep's customers, one row each."""
    return customers.select(
        text.surrogate_key("source_instance_id", "id").alias("customer_key"), "source_instance_id", "entity_id",
        F.col("id").alias("external_customer_id"), F.col("name").alias("customer_name"), _nn("phone_number").alias("customer_phone"),
        _nn("email_address").alias("customer_email"), _nn("address").alias("customer_address"), F.col("_extracted_at").alias("synced_at"),
    )


def stg_service_types(service_types: DataFrame) -> DataFrame:
    """service types; ids are unique within an instance only."""
    return service_types.select(
        text.surrogate_key("source_instance_id", "id").alias("service_type_key"), "source_instance_id",
        *_fields(service_types, {"entity_id": ("entity_id", "string")}), F.col("id").alias("service_type_id"), F.col("name").alias("service_type_name"),
    )


# ------------------------------------------------------------- intermediate
def int_quote_crosswalk(enriched: DataFrame, sweep: DataFrame) -> DataFrame:
    """(instance, quote) -> opportunity id from the two API arms only."""
    cols = ["source_instance_id", "quote_number", F.col("external_opportunity_id").alias("opportunity_id"), "observed_at"]
    arms = enriched.select(*cols, F.lit(ENR).alias("source"), F.lit(1).alias("source_priority")).unionByName(
        sweep.select(*cols, F.lit(SWP).alias("source"), F.lit(2).alias("source_priority"))
    )
    return bridge.crosswalk(arms)


def _bridged(report: DataFrame, xwalk: DataFrame) -> DataFrame:
    r = report.withColumn("quote_number", bridge.quote_key("quote_number"))
    m = bridge.matched(r, xwalk, ["source_instance_id", "quote_number"], "opportunity_id")
    return m.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "opportunity_id")).withColumn(
        "external_opportunity_id", F.col("opportunity_id")
    )


def int_opportunity_observations(enr, sweep, hooks, deletions, rpt, bkd, xwalk, attribution) -> DataFrame:
    """Every arm by name into one long table (the candidate table decides who counts)."""

    def arm(df, source, ts, **values):
        return stack_observations(
            df, [OPP_KEY, "source_instance_id", "external_opportunity_id"],
            [ArmSpec(source, PRIORITY[source], F.col(ts) if isinstance(ts, str) else ts, {k: F.col(v) if isinstance(v, str) else v for k, v in values.items()})],
            OBS_FIELDS,
            candidates=OPPORTUNITY_CANDIDATES,
        )

    same = lambda df, names: {n: n for n in names if n in df.columns}
    enr_fields = [f for f in OBS_FIELDS if f not in ("customer_address", "invoiced_amount", "booked_date_local", "deleted_at")]
    arms = [
        arm(enr, ENR, "observed_at", **same(enr, enr_fields), is_deleted=F.lit(False)),
        arm(hooks, WHK, "observed_at", status_code="status_code"),
        arm(sweep, SWP, "observed_at", **same(sweep, ["quote_number", "status_code", "external_customer_id",
                                                     "customer_name", "customer_email", "customer_phone", "customer_address"])),
        arm(deletions.withColumn(OPP_KEY, text.surrogate_key("source_instance_id", "id"))
            .withColumn("external_opportunity_id", F.col("id")), DEL, "_deleted_at",
            is_deleted=F.lit(True), deleted_at="_deleted_at"),
        arm(_bridged(rpt, xwalk), RPT, "report_generated_at",
            **same(rpt, ["quote_number", "pipeline_status", "service_date", "branch_name", "referral_source",
                         "estimated_final_total", "volume", "weight", "sales_assignee_name", "estimator_name",
                         "move_coordinator_name"])),
        arm(_bridged(bkd, xwalk), BKD, "report_generated_at",
            **same(bkd, ["pipeline_status", "customer_name", "customer_email", "customer_phone",
                         "estimated_final_total", "invoiced_amount", "booked_date_local"])),
        arm(attribution, AJO, "observed_at", **same(attribution, all_jobs.ATTRIBUTED.values())),
    ]
    out = arms[0]
    for a in arms[1:]:
        out = out.unionByName(a)
    return out


def int_status_latest(hooks: DataFrame, status_enum: DataFrame) -> DataFrame:
    """Newest status per opportunity from the event feed only, labelled."""
    from ..operators.resolve import newest_row

    latest = newest_row(hooks, [OPP_KEY], [F.col("observed_at"), F.col("event_id")],
                        keep=["source_instance_id", "entity_id", "status_code", "observed_at"])
    return rules.with_status(latest, status_enum)


# --------------------------------------------------------------------- core
def core_opportunities(obs: DataFrame, instances: DataFrame, status_enum: DataFrame) -> DataFrame:
    """R3 + R5 + R6 + J8 + X16 + X25: one row per opportunity key (T7: key only)."""
    res = resolve(obs, [OPP_KEY, "source_instance_id", "external_opportunity_id"], OPPORTUNITY_CANDIDATES)
    inst = bounded_broadcast(instances.select(F.col("instance_id").alias("source_instance_id"), "entity_id"))
    out = res.join(inst, "source_instance_id", "left").withColumn(
        "is_deleted", F.coalesce(F.col("is_deleted"), F.lit(False))
    )
    return rules.with_status(out, status_enum)


def core_jobs(
    enr_jobs: DataFrame, sweep_jobs: DataFrame, opportunities: DataFrame, report: DataFrame | None = None
) -> DataFrame:
    """Jobs resolved from the detail, the sweep and the all-jobs report, with the opportunity's
    fields (J10) and the depth of the newest report row (J11): costs, crew, addresses, times."""
    # the opportunity is a field like the others: a job that two sources attach to different ones stays one job
    cols = {
        "job_number": "string", "service_date": "date", OPP_KEY: "string", "external_opportunity_id": "string",
        "service_type_id": "bigint",
    }
    keys = ["job_key", "source_instance_id", "external_job_id"]

    detail = {c: JOB_DETAIL_FIELDS[c][1] for c in RESOLVED_JOB_DETAIL}

    def arm(df, source):
        d = df.withColumn("job_key", text.surrogate_key("source_instance_id", "external_job_id"))
        seen = {c: F.col(c) for c in (*cols, *(detail if source == ENR else ())) if c in df.columns}
        return stack_observations(d, keys, [ArmSpec(source, PRIORITY[source], F.col("observed_at"), seen)], cols | detail)

    obs = arm(enr_jobs, ENR).unionByName(arm(sweep_jobs, SWP))
    sources = {c: [ENR, SWP] for c in cols} | {c: [ENR] for c in detail}
    if report is not None:
        seen = {"job_number": F.col("job_number"), "service_date": F.col("service_date_local")}
        rows = report.withColumn("job_key", text.surrogate_key("source_instance_id", "external_job_id"))
        obs = obs.unionByName(stack_observations(rows, keys, [ArmSpec(RPJ, PRIORITY[RPJ], F.col("observed_at"), seen)], cols | detail))
        sources |= {c: [ENR, SWP, RPJ] for c in seen}
    jobs = resolve(obs, keys, Candidates(fields=sources))
    opp = opportunities.select(OPP_KEY, "entity_id", "customer_name", "branch_name", "status_label", F.col("synced_at").alias("_opp_synced"))
    jobs = jobs.join(opp, OPP_KEY, "left").withColumn("synced_at", F.greatest("synced_at", "_opp_synced")).drop("_opp_synced")
    if report is None:
        return jobs.withColumn("job_type_name", F.lit(None).cast("string"))
    depth = [c for c in report.columns if c not in {*jobs.columns, "observed_at", "service_date_local"}]
    own = report.select(
        "job_key", F.col("entity_id").alias("_entity"), F.col("branch_name").alias("_branch"), F.col("customer_name").alias("_customer"), *depth
    )
    jobs = jobs.join(own, "job_key", "left")
    # the job's own branch wins over the opportunity's; a job that only the report knows keeps its tenant
    return (
        jobs.withColumn("branch_name", F.coalesce("_branch", "branch_name"))
        .withColumn("entity_id", F.coalesce("entity_id", "_entity"))
        .withColumn("customer_name", F.coalesce("customer_name", "_customer"))
        .drop("_branch", "_entity", "_customer")
    )


def core_leads(leads: DataFrame, instances: DataFrame, status_enum: DataFrame,
               referral: DataFrame, zips: DataFrame, branch_tz: DataFrame) -> DataFrame:
    """J8 + X16 + X22 + X10 + X24: status label, disposition and local dates per lead, in
    the branch's zone or else the instance's; tier 2: referral channel by normalised source name (J9) and ZIP -> city/state fill."""
    inst = bounded_broadcast(instances.select(F.col("instance_id").alias("source_instance_id"), F.col("timezone").alias("_itz")))
    bz = branch_tz.select("source_instance_id", F.col("branch_name").alias("_bz_branch"), F.col("timezone").alias("_btz"))
    ref = referral.select(F.col("referral_source_raw").alias("_ref_raw"), F.col("channel_group").alias("referral_channel"),
                          F.col("is_paid").alias("referral_is_paid"))
    zp = zips.select(F.col("zip").alias("origin_zip"), F.col("city").alias("_zip_city"), F.col("state").alias("_zip_state"))
    l = leads.join(inst, "source_instance_id", "left")
    l = norm_key_join(l, bz, "branch_name", "_bz_branch", extra_keys=["source_instance_id"], key_name="_bz_key")
    l = l.withColumn("local_tz", zone_of("_btz", "_itz"))
    l = norm_key_join(l, ref, "referral_source", "_ref_raw", key_name="_ref_key").drop("_ref_key")
    l = l.join(zp, "origin_zip", "left").withColumn("origin_city", F.coalesce("origin_city", "_zip_city")).withColumn(
        "origin_state", F.coalesce("origin_state", "_zip_state")
    )
    l = rules.with_status(l, status_enum, code_col="lead_status_code")
    return l.select(
        "lead_key", "source_instance_id", "entity_id", "external_lead_id", "customer_name", "branch_name",
        "lead_status_code", F.col("status_label").alias("lead_status_name"), "is_booked", "is_lost", "is_bad_lead",
        rules.lead_disposition(F.col("bad_lead_reason"), F.col("lost_reason"), F.col("lead_status_code"), F.col("status_label")).alias("lead_disposition"),
        "referral_source", "referral_channel", "referral_is_paid", "origin_zip", "origin_city", "origin_state",
        "local_tz", "created_at_utc",
        local_timestamp("created_at_utc", F.col("local_tz")).alias("created_at_local"),
        local_date("created_at_utc", F.col("local_tz")).alias("created_date_local"),
        "synced_at",
    )


def core_opportunity_charges(charges: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Charge lines with the opportunity's tenant and freshness."""
    return charges.join(opportunities.select(OPP_KEY, "entity_id", "source_instance_id", "synced_at"), OPP_KEY, "left")


def core_branches(branches: DataFrame, branch_tz: DataFrame, instances: DataFrame) -> DataFrame:
    """J9 + X24 + F10: the zone authority - a branch override, else the instance default."""
    inst = bounded_broadcast(instances.select(F.col("instance_id").alias("source_instance_id"), F.col("timezone").alias("_itz"), "crm_timezone"))
    bz = branch_tz.select("source_instance_id", F.col("branch_name").alias("_bz_branch"), F.col("timezone").alias("_btz"))
    b = norm_key_join(branches, bz, "branch_name", "_bz_branch", extra_keys=["source_instance_id"], key_name="_bz_key")
    b = b.join(inst, "source_instance_id", "left")
    return b.select(
        "branch_key", "source_instance_id", "entity_id", "external_branch_id", "branch_name", "phone_number", "is_primary",
        zone_of("_btz", "_itz").alias("timezone"), "crm_timezone", F.col("_btz").isNotNull().alias("has_timezone_override"),
        *BRANCH_FIELDS,
    )


def core_lines_of_business(jobs: DataFrame, service_types: DataFrame, lob_branch: DataFrame, instances: DataFrame) -> DataFrame:
    """X23 + J8 (two keys) + F10: line of business per job with its provenance."""
    st = service_types.select("source_instance_id", "service_type_id", _nn("service_type_name").alias("service_type_name"))
    j = jobs.join(st, ["source_instance_id", "service_type_id"], "left")
    out = rules.classify_lob(j, lob_branch, instances, "job_type_name", "service_type_name", "branch_name")
    return out.select(
        "job_key", "source_instance_id", "entity_id", "external_job_id", "service_date", "branch_name",
        "service_type_name", "line_of_business", "lob_source", "is_unclassified",
    )


def core_opportunity_payments(payments: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Payment lines with the opportunity's tenant and freshness."""
    return payments.drop("entity_id").join(opportunities.select(OPP_KEY, "entity_id", "synced_at"), OPP_KEY, "left")


# -------------------------------------------------------------- marts/serve
def mart_unmatched_report_rows(report: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Newest generation only, with a reason per unbridgeable row."""
    return bridge.unmatched(report, xwalk).select(
        "report_row_key", "source_instance_id", "entity_id", "report_generated_at", "row_key", "quote_number", "status_raw",
        "branch_name", "service_date", "received_at_utc", F.col("estimated_final_total").alias("estimated_revenue"), "reason", "source_email",
    )


def mart_booked_by_book_date(opportunities: DataFrame) -> DataFrame:
    """Tier 2: bookings and invoiced money per local booking date (booked report's date)."""
    b = opportunities.filter(F.col("booked_date_local").isNotNull() & ~F.col("is_deleted"))
    return b.groupBy("entity_id", "source_instance_id", "booked_date_local").agg(
        F.count(F.lit(1)).alias("n_booked"), F.sum("invoiced_amount").alias("invoiced_total")
    )


def mart_opportunity_360(opportunities, charges, payments, attachments, jobs) -> DataFrame:
    """Tier 2: one wide row per opportunity; every child table is pre-aggregated on
    the opportunity key before the join (J14), so no join fans out."""
    ch = charges.groupBy(OPP_KEY).agg(
        F.sum(F.when(F.col("charge_kind") == "estimated", F.col("total_cost"))).alias("estimated_charges_total"),
        F.sum(F.when(F.col("charge_kind") == "actual", F.col("total_cost"))).alias("actual_charges_total"),
    )
    pay = payments.groupBy(OPP_KEY).agg(
        F.sum("amount").alias("paid_total"), F.count_if(F.col("is_outstanding")).alias("n_outstanding_payments")
    )
    jb = jobs.groupBy(OPP_KEY).agg(F.count(F.lit(1)).alias("n_jobs"), F.min("service_date").alias("first_service_date"))
    att = attachments.select(OPP_KEY, "document_count", "file_count", "photo_count", "job_document_count")
    out = opportunities
    for part in (ch, pay, jb, att):
        out = out.join(part, OPP_KEY, "left")
    for c in ("n_outstanding_payments", "n_jobs", "document_count", "file_count", "photo_count", "job_document_count"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("bigint")))
    return out


def mart_enrichment_candidates(report: DataFrame, xwalk: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Tier 2: opportunities whose newest lead-status report row disagrees with the
    resolved money or pipeline status - the report-driven refresh queue for what the
    cheap sweep cannot see. Newest generation only; one row per opportunity."""
    newest = bridge.newest_generation(report.withColumn("quote_number", bridge.quote_key("quote_number")))
    bridged = _bridged(newest, xwalk).select(
        OPP_KEY, "report_generated_at",
        F.col("pipeline_status").alias("report_status"), F.col("estimated_final_total").alias("report_total"),
    )
    j = bridged.join(opportunities.select(OPP_KEY, "entity_id", "source_instance_id", "pipeline_status", "estimated_final_total", "synced_at"), OPP_KEY, "inner")
    differs = (~F.col("report_status").eqNullSafe(F.col("pipeline_status"))) | (
        ~F.col("report_total").eqNullSafe(F.col("estimated_final_total"))
    )
    reason = F.when(~F.col("report_status").eqNullSafe(F.col("pipeline_status")), F.lit("status_differs")).otherwise(F.lit("money_differs"))
    return j.filter(differs).select(OPP_KEY, "entity_id", "source_instance_id", "report_generated_at", reason.alias("reason"))


OPPORTUNITIES_V1 = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("source_instance_id", T.StringType()),
        T.StructField(OPP_KEY, T.StringType()),
        T.StructField("quote_number", T.StringType()),
        T.StructField("status_label", T.StringType()),
        T.StructField("pipeline_status", T.StringType()),
        T.StructField("service_date", T.DateType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("branch_name", T.StringType()),
        T.StructField("estimated_final_total", T.DecimalType(18, 2)),
        T.StructField("invoiced_amount", T.DecimalType(18, 2)),
        T.StructField("is_booked", T.BooleanType()),
        T.StructField("is_deleted", T.BooleanType()),
        T.StructField("synced_at", T.TimestampType()),
    ]
)


JOBS_V1 = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("source_instance_id", T.StringType()),
        T.StructField("job_key", T.StringType()),
        T.StructField(OPP_KEY, T.StringType()),
        T.StructField("external_job_id", T.StringType()),
        T.StructField("job_number", T.StringType()),
        T.StructField("service_date", T.DateType()),
        T.StructField("service_type_id", T.LongType()),
        T.StructField("branch_name", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("status_label", T.StringType()),
        T.StructField("synced_at", T.TimestampType()),
    ]
)


def jobs_v1(jobs: DataFrame) -> DataFrame:
    """Tier 2 serving table: every resolved job, fixed column list (W3 contract)."""
    return jobs.select(*[f.name for f in JOBS_V1.fields])


def opportunities_v1(opportunities: DataFrame) -> DataFrame:
    """Tier 2 serving table: a fixed column list (W3 contract)."""
    return opportunities.select(*[f.name for f in OPPORTUNITIES_V1.fields])


def jobs_upcoming_v1(as_of: str):
    def build(jobs: DataFrame, branch_tz: DataFrame, instances: DataFrame) -> DataFrame:
        inst = bounded_broadcast(instances.select(F.col("instance_id").alias("source_instance_id"), F.col("timezone").alias("_itz")))
        bz = branch_tz.select("source_instance_id", F.col("branch_name").alias("_bz_branch"), F.col("timezone").alias("_btz"))
        j = norm_key_join(jobs.join(inst, "source_instance_id", "left"), bz, "branch_name", "_bz_branch",
                          extra_keys=["source_instance_id"], key_name="_bz_key")
        j = j.withColumn("timezone", zone_of("_btz", "_itz")).withColumn("_today", entity_today(as_of, F.col("timezone")))
        j = j.filter(in_window("service_date", F.col("_today"), 11))
        return j.select(
            "entity_id", "source_instance_id", "job_key", "external_job_id", "job_number", "service_date",
            days_until("service_date", F.col("_today")).alias("days_until"), "customer_name", "branch_name",
            "status_label", "timezone", "synced_at",
        )

    return build


def read_upcoming(jobs_upcoming: DataFrame) -> DataFrame:
    """The consumer's read of the serving table, ordered for display."""
    return jobs_upcoming.orderBy("service_date", "customer_name")


def leads_today_v1(as_of: str):
    def build(leads: DataFrame) -> DataFrame:
        today = entity_today(as_of, F.col("local_tz"))
        return leads.filter(F.col("created_date_local") == today).select(
            "entity_id", "source_instance_id", "lead_key", "customer_name", "branch_name", "lead_status_name",
            "lead_disposition", "created_at_local", "synced_at",
        )

    return build


RAW = [
    "leads", "opportunities_enriched", "customers_service_window", "report_lead_status",
    "report_booked_opportunities", "report_all_jobs", "webhook_events", "opportunity_deletions", "dim_instance",
    "dim_opportunity_status", "branch_timezone", "dim_branches", "dim_service_types", "dim_lob_branch",
    "dim_referral_source", "dim_zip",
]


def crm_registry(as_of: str) -> Registry:
    r = Registry()
    r.source(*RAW)
    add = r.add
    add(Model("stg_leads", "staging", stg_leads, ["leads"]))
    add(Model("stg_opportunities_enriched", "staging", stg_opportunities_enriched, ["opportunities_enriched"]))
    add(Model("stg_opportunity_jobs", "staging", stg_opportunity_jobs, ["opportunities_enriched"]))
    add(Model("stg_opportunity_job_charges", "staging", stg_opportunity_job_charges, ["opportunities_enriched"]))
    add(Model("stg_sweep", "staging", stg_sweep, ["customers_service_window"]))
    add(Model("stg_customers", "staging", stg_customers, ["customers_service_window"]))
    add(Model("stg_service_types", "staging", stg_service_types, ["dim_service_types"]))
    add(Model("stg_sweep_jobs", "staging", stg_sweep_jobs, ["stg_sweep"]))
    add(Model("stg_report_lead_status", "staging", stg_report_lead_status, ["report_lead_status", "dim_instance"]))
    add(Model("stg_report_booked", "staging", stg_report_booked, ["report_booked_opportunities"]))
    add(Model("stg_report_all_jobs", "staging", all_jobs.stg_report_all_jobs, ["report_all_jobs"]))
    add(Model("int_report_all_jobs_latest", "intermediate", all_jobs.int_report_all_jobs_latest, ["report_all_jobs"]))
    add(Model("int_job_attribution", "intermediate", all_jobs.int_job_attribution,
              ["int_report_all_jobs_latest", "stg_opportunity_jobs", "stg_sweep_jobs"]))
    add(Model("stg_webhook_status", "staging", stg_webhook_status, ["webhook_events"]))
    add(Model("stg_branches", "staging", stg_branches, ["dim_branches"]))
    add(Model("stg_opportunity_payments", "staging", stg_opportunity_payments, ["opportunities_enriched"]))
    add(Model("stg_opportunity_contacts", "staging", stg_opportunity_contacts, ["opportunities_enriched"]))
    add(Model("stg_opportunity_surveys", "staging", stg_opportunity_surveys, ["opportunities_enriched"]))
    add(Model("stg_opportunity_job_addresses", "staging", stg_opportunity_job_addresses, ["opportunities_enriched"]))
    add(Model("stg_opportunity_job_crew", "staging", stg_opportunity_job_crew, ["opportunities_enriched"]))
    add(Model("int_attachment_counts", "intermediate", int_attachment_counts, ["opportunities_enriched"]))
    add(Model("int_quote_crosswalk", "intermediate", int_quote_crosswalk, ["stg_opportunities_enriched", "stg_sweep"]))
    add(Model("int_opportunity_observations", "intermediate", int_opportunity_observations,
              ["stg_opportunities_enriched", "stg_sweep", "stg_webhook_status", "opportunity_deletions",
               "stg_report_lead_status", "stg_report_booked", "int_quote_crosswalk", "int_job_attribution"]))
    add(Model("int_status_latest", "intermediate", int_status_latest, ["stg_webhook_status", "dim_opportunity_status"]))
    add(Model("core_opportunities", "core", core_opportunities,
              ["int_opportunity_observations", "dim_instance", "dim_opportunity_status"], partition_by=["source_instance_id"]))
    add(Model("core_jobs", "core", core_jobs, ["stg_opportunity_jobs", "stg_sweep_jobs", "core_opportunities", "int_report_all_jobs_latest"],
              partition_by=["source_instance_id"]))
    add(Model("core_branches", "core", core_branches, ["stg_branches", "branch_timezone", "dim_instance"]))
    add(Model("core_lines_of_business", "core", core_lines_of_business,
              ["core_jobs", "stg_service_types", "dim_lob_branch", "dim_instance"], partition_by=["source_instance_id"]))
    add(Model("core_leads", "core", core_leads,
              ["stg_leads", "dim_instance", "dim_opportunity_status", "dim_referral_source", "dim_zip", "branch_timezone"],
              partition_by=["source_instance_id"]))
    add(Model("core_opportunity_charges", "core", core_opportunity_charges,
              ["stg_opportunity_job_charges", "core_opportunities"], partition_by=["source_instance_id"]))
    add(Model("core_opportunity_payments", "core", core_opportunity_payments,
              ["stg_opportunity_payments", "core_opportunities"], partition_by=["source_instance_id"]))
    add(Model("mart_booked_by_book_date", "marts", mart_booked_by_book_date, ["core_opportunities"]))
    add(Model("mart_opportunity_360", "marts", mart_opportunity_360,
              ["core_opportunities", "core_opportunity_charges", "core_opportunity_payments", "int_attachment_counts", "core_jobs"],
              partition_by=["source_instance_id"]))
    add(Model("mart_enrichment_candidates", "marts", mart_enrichment_candidates,
              ["stg_report_lead_status", "int_quote_crosswalk", "core_opportunities"]))
    add(Model("opportunities_v1", "serving", opportunities_v1, ["core_opportunities"], contract=OPPORTUNITIES_V1))
    add(Model("jobs_v1", "serving", jobs_v1, ["core_jobs"], contract=JOBS_V1))
    add(Model("mart_unmatched_report_rows", "marts", mart_unmatched_report_rows,
              ["stg_report_lead_status", "int_quote_crosswalk"]))
    add(Model("jobs_upcoming_v1", "serving", jobs_upcoming_v1(as_of), ["core_jobs", "branch_timezone", "dim_instance"],
              contract=JOBS_UPCOMING_V1))
    add(Model("leads_today_v1", "serving", leads_today_v1(as_of), ["core_leads"]))
    return r


# Declared data tests of the CRM models (Q1-Q4): of each model its key (unique and not null)
# and its other columns that may not be null.
MODEL_TESTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "stg_leads": ("lead_key", ("source_instance_id", "entity_id", "external_lead_id", "lead_status_code", "created_at_utc", "synced_at")),
    "stg_opportunities_enriched": (OPP_KEY, ("source_instance_id", "entity_id", "external_opportunity_id", "observed_at", "status_code")),
    "stg_opportunity_job_charges": ("charge_key", (OPP_KEY, "job_index", "line_index", "charge_kind", "total_cost")),
    "stg_sweep": (OPP_KEY, ("source_instance_id", "entity_id", "external_opportunity_id", "external_customer_id", "observed_at")),
    "stg_customers": ("customer_key", ("source_instance_id", "entity_id", "external_customer_id", "synced_at")),
    "stg_service_types": ("service_type_key", ("source_instance_id", "service_type_id", "service_type_name")),
    "stg_branches": ("branch_key", ("source_instance_id", "entity_id", "external_branch_id", "branch_name")),
    "stg_opportunity_payments": ("payment_key", (OPP_KEY, "source_instance_id", "child_index", "amount")),
    "stg_report_lead_status": ("report_row_key", ("source_instance_id", "entity_id", "report_generated_at", "row_key", "row_data")),
    "stg_report_all_jobs": ("report_row_key", ("source_instance_id", "entity_id", "report_generated_at", "row_key")),  # rows without a job are kept here
    "int_report_all_jobs_latest": ("job_key", ("source_instance_id", "entity_id", "external_job_id", "observed_at")),
    "int_attachment_counts": (OPP_KEY, ("source_instance_id", "document_count", "document_complete_count", "file_count", "photo_count", "job_document_count")),
    "int_status_latest": (OPP_KEY, ("source_instance_id", "status_code", "observed_at")),
    "int_job_attribution": (OPP_KEY, ("source_instance_id", "external_opportunity_id", "observed_at")),
    "core_opportunities": (OPP_KEY, ("source_instance_id", "entity_id", "external_opportunity_id", "is_deleted", "is_booked", "is_open", "synced_at")),
    "core_jobs": ("job_key", ("source_instance_id", "entity_id", "external_job_id", "job_number", "synced_at")),
    "core_leads": ("lead_key", ("source_instance_id", "entity_id", "external_lead_id", "lead_disposition", "local_tz", "created_at_utc", "created_date_local", "synced_at")),
    "core_branches": ("branch_key", ("source_instance_id", "entity_id", "external_branch_id", "branch_name", "timezone", "has_timezone_override")),
    "core_lines_of_business": ("job_key", ("source_instance_id", "entity_id", "external_job_id", "line_of_business", "lob_source", "is_unclassified")),
    "core_opportunity_charges": ("charge_key", (OPP_KEY, "source_instance_id", "entity_id", "charge_kind", "total_cost", "synced_at")),
    "core_opportunity_payments": ("payment_key", (OPP_KEY, "source_instance_id", "entity_id", "amount", "synced_at")),
    "mart_opportunity_360": (OPP_KEY, ("source_instance_id", "entity_id", "n_jobs", "synced_at")),
    "mart_unmatched_report_rows": ("report_row_key", ("source_instance_id", "entity_id", "report_generated_at", "row_key", "reason")),
    "opportunities_v1": (OPP_KEY, ("entity_id", "source_instance_id", "is_booked", "is_deleted", "synced_at")),
    "jobs_v1": ("job_key", ("entity_id", "source_instance_id", "external_job_id", "synced_at")),
    "jobs_upcoming_v1": ("job_key", ("entity_id", "source_instance_id", "external_job_id", "service_date", "days_until", "timezone", "synced_at")),
    "leads_today_v1": ("lead_key", ("entity_id", "source_instance_id", "lead_disposition", "created_at_local", "synced_at")),
}
# The values that a column may have.
ACCEPTED: dict[tuple[str, str], tuple] = {
    ("core_opportunities", "status_category"): ("open", "booked", "completed", "closed", "cancelled", "lost", "bad_lead"),
    ("int_status_latest", "status_category"): ("open", "booked", "completed", "closed", "cancelled", "lost", "bad_lead"),
    ("int_opportunity_observations", "source"): (ENR, WHK, SWP, DEL, RPT, BKD, AJO),
    ("int_quote_crosswalk", "source"): (ENR, SWP),
    ("stg_opportunity_job_charges", "charge_kind"): ("estimated", "actual"),
    ("core_opportunity_charges", "charge_kind"): ("estimated", "actual"),
    ("core_lines_of_business", "lob_source"): ("service_type", "branch", "instance", "fallback_default"),
    ("mart_unmatched_report_rows", "reason"): (bridge.NO_QUOTE, bridge.NOT_IN_API),
    ("mart_enrichment_candidates", "reason"): ("status_differs", "money_differs"),
}
# Child column -> parent.
RELATED = [
    ("core_jobs", OPP_KEY, "core_opportunities", OPP_KEY),
    ("core_opportunity_charges", OPP_KEY, "core_opportunities", OPP_KEY),
    ("core_opportunity_payments", OPP_KEY, "core_opportunities", OPP_KEY),
    ("core_lines_of_business", "job_key", "core_jobs", "job_key"),
    ("int_status_latest", OPP_KEY, "core_opportunities", OPP_KEY),
    ("jobs_v1", OPP_KEY, "opportunities_v1", OPP_KEY),
    ("jobs_upcoming_v1", "job_key", "core_jobs", "job_key"),
    ("mart_enrichment_candidates", OPP_KEY, "core_opportunities", OPP_KEY),
]


def _key_of(model: str) -> tuple[str, ...]:
    return (MODEL_TESTS[model][0],) if model in MODEL_TESTS else ("source_instance_id",)


CRM_CHECKS = [
    *[quality.Check("unique", m, (key,), ()) for m, (key, _) in MODEL_TESTS.items()],
    quality.Check("unique", "stg_report_booked", ("source_instance_id", "report_generated_at", "row_key"), ()),
    quality.Check("unique", "int_quote_crosswalk", ("source_instance_id", "quote_number"), ()),
    *[quality.Check("not_null", m, (c,), (key,)) for m, (key, cols) in MODEL_TESTS.items() for c in (key, *cols)],
    *[quality.Check("accepted_values", m, (c,), _key_of(m), values=v) for (m, c), v in ACCEPTED.items()],
    *[quality.Check("relationships", m, (c,), _key_of(m), parent=p, parent_column=pc) for m, c, p, pc in RELATED],
]
