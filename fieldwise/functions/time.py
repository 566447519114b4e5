"""Zone-aware business dates (X3 helper, X9, X10, X19, X21, X24; trap T5).

Instants are ``timestamp`` in a UTC session. A *business date* is a local
date in some zone and is never shifted again. ``as_of`` is always a
parameter, so "today" is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _z(tz: str | Column) -> Column:
    return F.lit(tz) if isinstance(tz, str) else tz


def wall_clock_to_utc(wall: Column, tz: str | Column) -> Column:
    """A naive wall clock (held as a UTC ``timestamp``) read in ``tz`` -> instant.

    ``to_utc_timestamp`` resolves an ambiguous wall clock (the repeated hour
    when clocks fall back) with the *earlier* offset; PostgreSQL uses standard
    time, one hour later. If the instant one hour later shows the same wall
    clock in ``tz``, that later instant is the standard-time reading. Skipped
    wall clocks (spring forward) and ordinary ones are unaffected.
    """
    zone = _z(tz)
    first = F.to_utc_timestamp(wall, zone)
    later = first + F.expr("INTERVAL 1 HOUR")
    return F.when(F.from_utc_timestamp(later, zone) == wall, later).otherwise(first)


def local_timestamp(ts: str | Column, tz: str | Column) -> Column:
    """Instant -> naive local wall clock (``ts at time zone tz``)."""
    return F.from_utc_timestamp(_c(ts), _z(tz)).cast("timestamp_ntz")


def local_date(ts: str | Column, tz: str | Column) -> Column:
    """Instant -> local calendar date in ``tz``."""
    return F.to_date(F.from_utc_timestamp(_c(ts), _z(tz)))


def entity_today(as_of, tz: str | Column) -> Column:
    """today's date in a row's zone, for a given instant ``as_of``."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return F.to_date(F.from_utc_timestamp(now, _z(tz)))


def days_until(d: str | Column, today: Column) -> Column:
    """``d - today`` in days (an int, not an interval)."""
    return F.datediff(_c(d), today)


def hours_since(t: str | Column, now) -> Column:
    """Hours from ``t`` to ``now``; null when ``t`` is null."""
    n = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    return (F.unix_micros(n) - F.unix_micros(_c(t))) / F.lit(3.6e9)


def zone_of(branch_zone: str | Column, instance_zone: str | Column) -> Column:
    """A branch's own zone overrides the instance default."""
    return F.coalesce(_c(branch_zone), _c(instance_zone))


def in_window(d: str | Column, today: Column, days: int) -> Column:
    """``today <= d < today + days`` (a rolling local-date window)."""
    x = _c(d)
    return (x >= today) & (x < F.date_add(today, days))
