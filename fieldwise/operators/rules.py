"""Ordered classification rules (X16, X22-X25, J8, J9, F9, F10, tier-2 rule engine).

Every ladder is a single ``CASE`` (``when`` chain) computed once as a
struct of (value, provenance), so the value and the reason it was chosen can
never disagree. Dimensions are seeds and broadcast behind a size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import default_false, default_true, label_or_code, mentions, norm_text
from .joins import bounded_broadcast, keep_bound, norm_key_join

# Fixed value: instance hints that can stand in for a missing branch; a mixed
# instance ('local_commercial') gives no usable default.
USABLE_LOB_HINTS = ["local", "long_distance", "commercial"]


def with_status(df: DataFrame, enum: DataFrame, code_col: str = "status_code") -> DataFrame:
    """J8 + X16 + X25: label and flags from the status enum.

    Unknown codes stay visible as ``status_<code>``; an unknown code counts as
    a valid lead and as none of booked, completed, cancelled, lost and open.
    """
    dim = bounded_broadcast(keep_bound(enum.withColumnRenamed("status_code", "_enum_code"), enum), 10_000)
    out = df.join(dim, F.col(code_col) == F.col("_enum_code"), "left")
    return out.select(
        *[F.col(c) for c in df.columns],
        label_or_code(F.col("status_name"), F.col(code_col)).alias("status_label"),
        F.col("status_category"),
        default_true(F.col("is_valid_lead")).alias("is_valid_lead"),
        default_false(F.col("is_booked")).alias("is_booked"),
        default_false(F.col("is_completed")).alias("is_completed"),
        default_false(F.col("is_cancelled")).alias("is_cancelled"),
        default_false(F.col("is_lost")).alias("is_lost"),
        default_false(F.col("is_bad_lead")).alias("is_bad_lead"),
        default_false(F.col("is_open")).alias("is_open"),
    )


def lead_disposition(
    bad_reason: Column, lost_reason: Column, code: Column, label: Column
) -> Column:
    """Bad-lead reason > lost reason > code 1 > code 0 > label (or ``status_<code>``)."""
    return (
        F.when(bad_reason.isNotNull(), F.lit("Bad Lead"))
        .when(lost_reason.isNotNull(), F.lit("Lost"))
        .when(code == 1, F.lit("In Progress"))
        .when(code == 0, F.lit("New"))
        .otherwise(label_or_code(label, code))
    )


def lob_ladder(job_type: Column, service_type: Column, branch_lob: Column, instance_hint: Column) -> Column:
    """X23 + F9: line of business and its provenance as one struct.

    1. job type or service type mentions "commercial" (normalised) -> commercial
    2. the branch map -> its value
    3. a usable instance hint -> the hint
    4. otherwise ``local`` (flagged as unclassified, F10)
    A null text is no match.
    """
    commercial = mentions(job_type, "commercial") | mentions(service_type, "commercial")
    hint = F.when(instance_hint.isin(USABLE_LOB_HINTS), instance_hint)
    return (
        F.when(commercial, F.struct(F.lit("commercial").alias("value"), F.lit("service_type").alias("source")))
        .when(branch_lob.isNotNull(), F.struct(branch_lob.alias("value"), F.lit("branch").alias("source")))
        .when(hint.isNotNull(), F.struct(hint.alias("value"), F.lit("instance").alias("source")))
        .otherwise(F.struct(F.lit("local").alias("value"), F.lit("fallback_default").alias("source")))
    )


def classify_lob(
    jobs: DataFrame,
    branch_map: DataFrame,
    instances: DataFrame,
    job_type: str,
    service_type: str,
    branch_name: str,
    instance_col: str = "source_instance_id",
) -> DataFrame:
    """X23 over a jobs table: branch map joined by (instance, normalised name)."""
    bm = keep_bound(
        branch_map.select(
            F.col("source_instance_id").alias(instance_col),
            F.col("branch_name").alias("_bm_branch"),
            F.col("line_of_business").alias("_branch_lob"),
        ),
        branch_map,
    )
    joined = norm_key_join(jobs, bm, branch_name, "_bm_branch", extra_keys=[instance_col], key_name="_branch_key")
    inst = bounded_broadcast(
        keep_bound(instances.select(F.col("instance_id").alias(instance_col), F.col("lob_hint").alias("_hint")), instances),
        max_rows=100_000,
    )
    joined = joined.join(inst, instance_col, "left")
    lob = lob_ladder(F.col(job_type), F.col(service_type), F.col("_branch_lob"), F.col("_hint"))
    return (
        joined.withColumn("_lob", lob)
        .withColumn("line_of_business", F.col("_lob.value"))
        .withColumn("lob_source", F.col("_lob.source"))
        .withColumn("is_unclassified", F.col("lob_source") == "fallback_default")
        .drop("_lob", "_branch_lob", "_hint", "_branch_key")
    )


def rule_engine(
    df: DataFrame,
    rules: Sequence[tuple[int, str, str, str, str]],
    out_col: str = "category",
) -> DataFrame:
    """Tier-2 rule table: ``(priority, field, match_type, match_value, category)``.

    ``match_type`` is ``contains`` (on normalised text of both sides),
    ``equals`` (normalised) or ``default``. The lowest priority that matches
    wins; equal priorities keep table order. Rules are data, compiled into one
    ``CASE`` - no join, no UDF.
    """
    ordered = sorted(enumerate(rules), key=lambda ir: (ir[1][0], ir[0]))
    expr = None
    default = None
    for _, (_prio, fld, mtype, mval, category) in ordered:
        if mtype == "default":
            if default is None:
                default = F.lit(category)
            continue
        needle = norm_text(F.lit(mval))
        hay = norm_text(F.col(fld))
        cond = hay.contains(needle) if mtype == "contains" else hay == needle
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    if expr is None:
        result = default if default is not None else F.lit(None).cast("string")
    else:
        result = expr.otherwise(default) if default is not None else expr
    return df.withColumn(out_col, result)


def map_status_text(df: DataFrame, text_col: str, status_map: DataFrame) -> DataFrame:
    """Tier-2: report status string -> category/subcategory via the normalised key."""
    return norm_key_join(df, status_map, text_col, "status_raw", key_name="_status_key").drop("_status_key")
