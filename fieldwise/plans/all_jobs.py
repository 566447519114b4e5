"""The all-jobs report: typed rows, the newest row of each job, attribution.

The report has one row a job and names it by the job's id, so it attaches to a
job without a crosswalk. Its time columns mean three things: start and end
carry their own offset, the other ``at Utc`` columns are bare local dates, and
no column is a wall clock of the instance's zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts, text
from ..functions.json import json_field, json_struct
from ..operators import bridge
from ..operators.resolve import newest_row

# The report's headers and the names of their columns, by kind.
TEXT = {
    "Job Number": "job_number",
    "Opportunity Status": "opportunity_status_raw",
    "Opportunity Type": "opportunity_type_name",
    "Job Type": "job_type_name",
    "Branch Name": "branch_name",
    "Customer Name": "customer_name",
    "Customer Email": "customer_email",
    "Customer Phone": "customer_phone",
    "Sales Person Name": "sales_person",
    "Estimator Name": "estimator_name",
    "Move Coordinator Name": "move_coordinator_name",
    "Referral Source": "referral_source",
    "Affiliate Name": "affiliate_name",
    "Crew Member Names": "crew_member_names",
    "Truck Names": "truck_names",
    "Pricing Method": "pricing_method",
}
PLACES = ("Origin", "Destination")
PLACE_PARTS = {"Street": "street", "City": "city", "State": "state", "Zip": "zip", "Unit": "unit", "Type": "type", "Address": "address_full"}
DATES = {
    "Job Date": "service_date_local",
    "End Date": "end_date_local",
    "Created at Utc": "created_date_local",
    "Booked at Utc": "booked_date_local",
    "Completed at Utc": "completed_date_local",
    "Closed at Utc": "closed_date_local",
}
INSTANTS = {"Start Time Utc": "start_at_utc", "End Time Utc": "end_at_utc"}
FLAGS = {"Move Date Is TBD": "move_date_is_tbd"}
#: Costs come estimated and actual: ``<kind> <name> Cost`` is ``est_/actual_<column>_cost``.
COSTS = {
    "Labor": "labor",
    "Materials": "materials",
    "Fuel Surcharges": "fuel",
    "Insurance": "insurance",
    "Valuation": "valuation",
    "Additional Services": "additional_services",
    "Other Fees": "other_fees",
    "Trip Fees": "trip_fees",
    "Storage in Transit": "storage_in_transit",
    "Prepaid Storage": "prepaid_storage",
    "Warehouse Handling": "warehouse_handling",
}
KINDS = {"Estimated": "est", "Actual": "actual"}
NUMBERS = {
    "Truck Fees Estimated Cost": "est_truck_fees_cost",
    "Travel Time Fees Estimated Cost": "est_travel_time_fees_cost",
    "Estimated Tax Amount": "est_tax_amount",
    "Estimated Discount": "est_discount",
    "Total Estimated Cost": "total_estimated_cost",
    "Truck Fees Actual Cost": "actual_truck_fees_cost",
    "Travel Time Fees Actual Cost": "actual_travel_time_fees_cost",
    "Credit Card Fees Actual Cost": "actual_credit_card_fees_cost",
    "Actual Tax Amount": "actual_tax_amount",
    "Actual Discount": "actual_discount",
    "Total Actual Cost": "total_actual_cost",
    "Tip Amount": "tip_amount",
    "Wages": "wages",
    "Estimated Number of Crew": "est_crew_count",
    "Actual Number of Crew": "actual_crew_count",
    "Estimated Number of Trucks": "est_truck_count",
    "Actual Number of Trucks": "actual_truck_count",
    "Total Estimated Time Hours": "est_time_hours",
    "Actual Time Hours": "actual_time_hours",
    "Total Job Time Deductions Minutes": "time_deductions_minutes",
    "Origin to Destination Mileage": "origin_to_destination_mileage",
    "Round Trip Mileage": "round_trip_mileage",
    "Hourly Rate Quoted": "hourly_rate_quoted",
    "Hourly Rate Billed": "hourly_rate_billed",
    "Job Rating": "job_rating",
}
JOB_ID, VOLUME, WEIGHT = "Job Id", "Volume", "Weight"


def typed_columns() -> dict[str, tuple[str, object]]:
    """column -> (header, cast) of every typed column but the volume and weight pair."""
    out: dict[str, tuple[str, object]] = {c: (h, text.blank_to_null) for h, c in TEXT.items()}
    for place in PLACES:
        for part, column in PLACE_PARTS.items():
            out[f"{place.lower()}_{column}"] = (f"{place} {part}", text.blank_to_null)
    out |= {c: (h, casts.rpt_date) for h, c in DATES.items()}
    out |= {c: (h, casts.rpt_ts_offset) for h, c in INSTANTS.items()}
    out |= {c: (h, casts.rpt_bool) for h, c in FLAGS.items()}
    for kind, prefix in KINDS.items():
        out |= {f"{prefix}_{c}_cost": (f"{kind} {h} Cost", casts.rpt_num) for h, c in COSTS.items()}
    out |= {c: (h, casts.rpt_num) for h, c in NUMBERS.items()}
    return out


def headers() -> list[str]:
    return [JOB_ID, VOLUME, WEIGHT, *[h for h, _ in typed_columns().values()]]


def stg_report_all_jobs(report: DataFrame) -> DataFrame:
    """All landed generations, each row's JSON parsed once and typed."""
    r = report.withColumn("_r", json_struct("row_data", headers()))
    cell = lambda h: F.col("_r")[h]
    job_id = text.blank_to_null(cell(JOB_ID))
    number = F.trim(cell("Job Number"))
    return r.select(
        text.surrogate_key("source_instance_id", job_id).alias("job_key"),
        text.surrogate_key("source_instance_id", "row_key", text.compact_stamp("report_generated_at")).alias("report_row_key"),
        "source_instance_id",
        "entity_id",
        "report_generated_at",
        "row_key",
        job_id.alias("external_job_id"),
        F.nullif(text.quote_of(number), F.lit("")).alias("quote_number"),
        *[cast(cell(header)).alias(column) for column, (header, cast) in typed_columns().items()],
        casts.rpt_cuft(cell(VOLUME)).alias("volume_cuft"),
        casts.rpt_lbs(cell(WEIGHT)).alias("weight_lbs"),
        "row_data",
    )


def int_report_all_jobs_latest(report: DataFrame) -> DataFrame:
    """The newest row of each job (ties by row text), typed.

    The landed rows are collapsed first, by a partial aggregation over their
    text, and only the winners are parsed and typed.
    """
    job_id = text.blank_to_null(json_field("row_data", JOB_ID))
    rows = report.withColumn("_job", job_id).filter(F.col("_job").isNotNull())
    keep = ["entity_id", "report_generated_at", "row_key", "row_data"]
    newest = newest_row(rows, ["source_instance_id", "_job"], ["report_generated_at", "row_data"], keep=keep)
    typed = stg_report_all_jobs(newest.drop("_job")).withColumnRenamed("report_generated_at", "observed_at")
    return typed.drop("report_row_key", "row_key", "row_data")


ATTRIBUTED = {
    "branch_name": "branch_name",
    "referral_source": "referral_source",
    "sales_person": "sales_assignee_name",
    "estimator_name": "estimator_name",
    "move_coordinator_name": "move_coordinator_name",
}


def int_job_attribution(latest: DataFrame, detail_jobs: DataFrame, sweep_jobs: DataFrame) -> DataFrame:
    """Who works on an opportunity, from the newest report row among its jobs."""
    key = ["opportunity_key", "source_instance_id", "external_opportunity_id"]
    job = text.surrogate_key("source_instance_id", "external_job_id").alias("job_key")
    api = detail_jobs.select(job, *key).unionByName(sweep_jobs.select(job, *key)).distinct()
    rows = latest.select("job_key", "observed_at", *[F.col(c).alias(n) for c, n in ATTRIBUTED.items()])
    return bridge.recover_attribution(rows, api, "job_key", key, "observed_at", list(ATTRIBUTED.values()), tiebreak=["job_key"])
