"""Typed seed dimensions (S8) and the fixed dimensions of the driver-table roles.

A seed is a small, hand-kept CSV read with an explicit schema (never
inferred). Seeds have a fixed, tiny size, which is what makes broadcasting
them safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import keep_bound, with_bound

# The integer opportunity status enum (authoritative status):
# code, name, category, is_valid_lead, is_booked, is_completed, is_cancelled,
# is_lost, is_bad_lead, is_open, sort_order. Completed and Closed count as
# booked; only BadLead is not a valid lead.
STATUS_ENUM = [
    (0, "NewLead", "open", True, False, False, False, False, False, True, 10),
    (1, "LeadInProgress", "open", True, False, False, False, False, False, True, 20),
    (3, "Opportunity", "open", True, False, False, False, False, False, True, 30),
    (4, "Booked", "booked", True, True, False, False, False, False, False, 40),
    (10, "Completed", "completed", True, True, True, False, False, False, False, 50),
    (11, "Closed", "closed", True, True, False, False, False, False, False, 60),
    (20, "Cancelled", "cancelled", True, False, False, True, False, False, False, 70),
    (30, "Lost", "lost", True, False, False, False, True, False, False, 80),
    (50, "BadLead", "bad_lead", False, False, False, False, False, True, False, 90),
]
STATUS_ENUM_SCHEMA = (
    "status_code int, status_name string, status_category string, is_valid_lead boolean, "
    "is_booked boolean, is_completed boolean, is_cancelled boolean, is_lost boolean, "
    "is_bad_lead boolean, is_open boolean, sort_order int"
)

# Fixed values for the driver-table roles (region = instance, nation = branch):
# instance id, tenant, default zone, line-of-business hint.
INSTANCES = [
    (0, "africa", "south_co", "Africa/Johannesburg", "local"),
    (1, "america", "west_co", "America/Los_Angeles", "long_distance"),
    (2, "asia", "east_co", "Asia/Tokyo", "local_commercial"),
    (3, "europe", "west_co", "Europe/Berlin", "commercial"),
    (4, "middle_east", "east_co", "Asia/Dubai", None),
]
INSTANCES_SCHEMA = "r_regionkey int, instance_id string, entity_id string, timezone string, lob_hint string"

# Branch zone overrides, spelled unlike the branch table (joined by norm_text).
BRANCH_ZONES = [
    ("america", "Nation 1", "America/New_York"),
    ("america", "nation-6 ", "America/Chicago"),
    ("europe", "NATION_3", "Europe/London"),
]
BRANCH_ZONES_SCHEMA = "source_instance_id string, branch_name string, timezone string"

# Branch -> line of business map (rule 2 of the ladder).
LOB_BRANCH = [
    ("asia", "Nation 2", "commercial"),
    ("asia", "nation_7", "long_distance"),
    ("africa", "NATION 5", "long_distance"),
    ("middle_east", "nation-4", "local"),
]
LOB_BRANCH_SCHEMA = "source_instance_id string, branch_name string, line_of_business string"

# Service type names per part type (the API's service types).
SERVICE_TYPES = [
    ("ECONOMY", "Local Move"),
    ("LARGE", "Long Distance (LD)"),
    ("MEDIUM", "Moving - Standard"),
    ("PROMO", "Commercial / Office"),
    ("SMALL", "Labor Only"),
    ("STANDARD", "International LD"),
]
SERVICE_TYPES_SCHEMA = "p_type string, service_type_name string"

# SCD2 assignment: a name (normalised for the join), a team, a validity
# interval; an open end is 9999-12-31. One name has two overlapping rows on
# purpose (one person working two lines).
ASSIGNMENTS = [
    ("Automobile", "team_north", "1995-01-01", "1997-12-31"),
    ("automobile ", "team_south", "1998-01-01", "9999-12-31"),
    ("BUILDING", "team_north", "1995-01-01", "9999-12-31"),
    ("Building", "team_east", "1999-01-01", "9999-12-31"),
    ("furniture!", "team_west", "1996-06-01", "1999-12-31"),
    ("Machinery", "team_east", "2000-01-01", "2000-12-31"),
]
ASSIGNMENTS_SCHEMA = "name string, team string, valid_from string, valid_to string"

# Row access: which role may see which tenant.
ENTITY_ACCESS = [
    ("analyst_west", "west_co"),
    ("analyst_east", "east_co"),
    ("admin", "west_co"),
    ("admin", "east_co"),
    ("admin", "south_co"),
]
ENTITY_ACCESS_SCHEMA = "role_name string, entity_id string"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A UTF-8 CSV with a header, quoted commas allowed, explicit schema.

    0/1 flags load as booleans when the schema says ``boolean``.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def frame(spark: SparkSession, rows, schema: str, unique_on: Sequence[int] = ()) -> DataFrame:
    """A seed held in code (fixed rows) as a DataFrame with its exact row count.

    ``unique_on`` lists column positions that must be unique; checked here, in
    Python, so the join that uses the seed cannot fan out.
    """
    if unique_on:
        seen = set()
        for r in rows:
            k = tuple(r[i] for i in unique_on)
            if k in seen:
                raise ValueError(f"seed not unique on positions {list(unique_on)}: {k}")
            seen.add(k)
    return with_bound(spark.createDataFrame(rows, schema), len(rows))


def status_enum(spark: SparkSession) -> DataFrame:
    return frame(spark, STATUS_ENUM, STATUS_ENUM_SCHEMA, unique_on=[0])


def instances(spark: SparkSession) -> DataFrame:
    return frame(spark, INSTANCES, INSTANCES_SCHEMA, unique_on=[0])


def assignments(spark: SparkSession) -> DataFrame:
    df = frame(spark, ASSIGNMENTS, ASSIGNMENTS_SCHEMA)
    out = df.selectExpr("name", "team", "cast(valid_from as date) valid_from", "cast(valid_to as date) valid_to")
    return keep_bound(out, df)
