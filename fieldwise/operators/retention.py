"""Report-generation retention (R7, N6; trap T1).

Policy: keep every generation for ``keep_days``; older than that, keep one
generation per instance-local calendar day - the latest one. The day is the
instance's day, so a Pacific evening send is not split from the morning ones.

Implemented on the *generation* grain, not the row grain (a row-level
``row_number`` would give every multi-row generation an ``rn > 1`` and
delete the newest one too, trap T1): distinct generations per instance are a
small aggregate (a handful per instance-day), ranked there, and the kept set
is semi-joined back to the rows. Running it twice keeps the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import local_date
from .joins import small_table


def generations_to_keep(
    rows: DataFrame,
    as_of,
    keep_days: int = 10,
    instance: str = "source_instance_id",
    generated_at: str = "report_generated_at",
    zone_col: str = "timezone",
) -> DataFrame:
    """The ``(instance, generated_at)`` pairs the policy keeps.

    ``rows`` must carry the instance zone in ``zone_col`` (the instance's CRM
    zone, defaulted by the caller).
    """
    now = F.lit(as_of).cast("timestamp")
    gens = rows.groupBy(instance, generated_at, zone_col).agg(F.lit(1).alias("_n")).drop("_n")
    gens = gens.withColumn("_day", local_date(F.col(generated_at), F.col(zone_col)))
    recent = gens.filter(F.col(generated_at) >= now - F.make_interval(days=F.lit(keep_days)))
    newest_per_day = gens.groupBy(instance, "_day").agg(F.max(generated_at).alias(generated_at))
    return recent.select(instance, generated_at).unionByName(newest_per_day.select(instance, generated_at)).distinct()


def prune_generations(
    rows: DataFrame,
    as_of,
    keep_days: int = 10,
    instance: str = "source_instance_id",
    generated_at: str = "report_generated_at",
    zone_col: str = "timezone",
    max_generations: int = 1_000_000,
) -> DataFrame:
    """The rows that survive retention (a rewrite keeps exactly these).

    The kept-generation set grows with instances x days, not with rows; it is computed
    once while the plan is built and broadcast up to ``max_generations`` rows, else
    semi-joined by shuffle.
    """
    keep = generations_to_keep(rows, as_of, keep_days, instance, generated_at, zone_col)
    return rows.join(small_table(keep, max_generations), [instance, generated_at], "left_semi")
