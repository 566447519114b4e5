"""Tolerant typing of text report cells (X2-X8, X17, X18; traps T6, T11, T14).

Report cells are text in US formats with vendor null sentinels. Every cast
here is guarded and uses Spark's ``try_*`` forms, so one malformed cell
yields null instead of failing the job (the reference raises on several of
them, trap T6); ``parse_losses`` (quality Q8) counts what became null.

Regex guards end with ``\\z``: Java's ``$`` also matches before a trailing
newline, PostgreSQL's does not (trap T11).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import wall_clock_to_utc


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The accepted shapes of report cells.
US_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
US_MINUTE_TIME = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2} (AM|PM)\z"
DURATION = r"^-?([0-9]+d ?)?([0-9]+h ?)?([0-9]+m)?\z"
TRUE_WORDS = ["1", "true", "yes", "y"]
FALSE_WORDS = ["0", "false", "no", "n"]


def rpt_date(c: str | Column) -> Column:
    """``M/D/YYYY`` -> date; ``0/0/0``, blanks, ``2/31/2026`` and anything else -> null."""
    x = _c(c)
    return F.when(x.rlike(US_DATE), F.try_to_date(x, "M/d/yyyy"))


def rpt_ts(c: str | Column, tz: str | Column) -> Column:
    """``M/D/YYYY H:MM AM`` read as a wall clock in ``tz`` -> UTC instant.

    Hours outside 1-12 (``13:16 PM``, ``0:16 AM``) are null. Ambiguous and
    skipped wall clocks follow PostgreSQL's rule (standard time, trap T5).
    """
    x = _c(c)
    wall = F.when(x.rlike(US_MINUTE_TIME), F.try_to_timestamp(x, F.lit("M/d/yyyy h:mm a")))
    return wall_clock_to_utc(wall, tz)


def rpt_ts_offset(c: str | Column) -> Column:
    """``M/D/YYYY h:mm:ss AM ±HH:MM`` -> instant; the offset is applied, no zone.

    Missing offset, blank or malformed -> null.
    """
    x = F.nullif(F.trim(F.coalesce(_c(c), F.lit(""))), F.lit(""))
    return F.try_to_timestamp(x, F.lit("M/d/yyyy h:mm:ss a xxx"))


def rpt_num(c: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """Strip ``$`` and ``,``; blank -> null; junk (``--``, ``(5.00)``) -> null."""
    stripped = F.nullif(F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"[$,]", "")), F.lit(""))
    return stripped.try_cast(f"decimal({precision},{scale})")


def rpt_bool(c: str | Column) -> Column:
    """1/true/yes/y -> true, 0/false/no/n -> false, else null (trimmed, any case)."""
    x = F.lower(F.trim(_c(c)))
    return F.when(x.isin(TRUE_WORDS), F.lit(True)).when(x.isin(FALSE_WORDS), F.lit(False))


def rpt_minutes(c: str | Column) -> Column:
    """``[-][Nd ][Nh ][Nm]`` -> signed minutes; needs a digit; else null.

    ``'1d 13h 41m'`` -> 2261, ``'-9m'`` -> -9, ``'5'`` / ``'--'`` / ``''`` -> null.
    """
    x = _c(c)

    def part(unit: str) -> Column:
        digits = F.nullif(F.regexp_extract(x, rf"([0-9]+){unit}", 1), F.lit(""))
        return F.coalesce(digits.try_cast("bigint"), F.lit(0))

    total = part("d") * 1440 + part("h") * 60 + part("m")
    sign = F.when(x.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    return F.when(x.rlike(DURATION) & x.rlike("[0-9]"), (sign * total).cast("int"))


def rpt_cuft(c: str | Column, precision: int = 18, scale: int = 4) -> Column:
    """The volume side of ``'525 cuft / 3698 lbs'`` (independent of the weight side)."""
    x = F.coalesce(_c(c), F.lit(""))
    v = F.nullif(F.regexp_extract(x, r"^([0-9.]+) cuft", 1), F.lit(""))
    return v.try_cast(f"decimal({precision},{scale})")


def rpt_lbs(c: str | Column, precision: int = 18, scale: int = 4) -> Column:
    """The weight side of ``'525 cuft / 3698 lbs'``."""
    x = F.coalesce(_c(c), F.lit(""))
    v = F.nullif(F.regexp_extract(x, r"/ ([0-9.]+) lbs", 1), F.lit(""))
    return v.try_cast(f"decimal({precision},{scale})")


def int_date(c: str | Column) -> Column:
    """Integer ``YYYYMMDD`` -> date; 0, null and impossible dates -> null."""
    x = _c(c)
    return F.when(x > 0, F.try_to_date(x.cast("string"), "yyyyMMdd"))


def iso_date(c: str | Column) -> Column:
    """ISO string date: ``try_cast(nullif(x, '') as date)``."""
    return F.nullif(_c(c), F.lit("")).try_cast("date")


def to_ymd(c: str | Column, numeric: bool = False) -> Column:
    """A date-ish value -> ``YYYYMMDD`` int, else null.

    Numeric input counts when above 19000000. Text input counts when, trimmed,
    it is 8 digits or starts with an ISO ``YYYY-MM-DD`` prefix.
    """
    x = _c(c)
    if numeric:
        return F.when(x > 19000000, x.cast("bigint"))
    s = F.trim(x)
    eight = F.when(s.rlike(r"^[0-9]{8}\z"), s.try_cast("bigint"))
    iso = F.regexp_extract(s, r"^([0-9]{4})-([0-9]{2})-([0-9]{2})", 0)
    iso_int = F.nullif(F.regexp_replace(iso, "-", ""), F.lit("")).try_cast("bigint")
    return F.coalesce(eight, iso_int)
