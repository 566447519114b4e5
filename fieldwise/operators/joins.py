"""Join operators.

Broadcasts are never blind. A side is hinted for broadcast only when its
row count is *proven* small:

* seeds built from rows held in code carry their exact row count
  (``row_bound``) - no Spark job is needed to know it;
* any other side can be probed on request (``probe=True``: one
  ``limit(n + 1).count()`` job that stops early).

Everything else is left unhinted: Spark's planner broadcasts only below
``spark.sql.autoBroadcastJoinThreshold`` (estimated from file sizes) and
AQE re-plans at runtime from the measured shuffle size - the size check
and the shuffle join beyond it are Spark's own. Dimensions keyed by text
are joined on a precomputed normalised key column, so the join stays an
equi-join.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_text
from ..session import written_once

# A side above this many rows is not hinted (a few tens of MB for typical
# dimension widths); the join then shuffles on its key.
DEFAULT_BROADCAST_ROWS = 1_000_000


class DuplicateKeyError(ValueError):
    """A dimension that must be unique on its join key is not (fan-out)."""


def with_bound(df: DataFrame, n: int) -> DataFrame:
    """Record a proven row count on a DataFrame (rows built in code)."""
    df.row_bound = n  # type: ignore[attr-defined]
    return df


def row_bound(df: DataFrame) -> int | None:
    """The proven row count, if the DataFrame carries one."""
    return getattr(df, "row_bound", None)


def keep_bound(derived: DataFrame, source: DataFrame) -> DataFrame:
    """Carry a proven bound to a projection / filter / rename of a bounded frame
    (those never add rows)."""
    n = row_bound(source)
    return with_bound(derived, n) if n is not None else derived


def probe_rows(df: DataFrame, max_rows: int) -> int | None:
    """The row count when it is at most ``max_rows``, else ``None`` (stops early)."""
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, or ``DuplicateKeyError`` when a (non-null) key occurs twice."""
    known = df.filter(functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    dup = known.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()  # one example
    if dup:
        raise DuplicateKeyError(f"join side not unique on {list(keys)}: {dup[0].asDict()}")
    return df


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    unique_on: Sequence[str] | None = None,
    bound: int | None = None,
    probe: bool = False,
) -> DataFrame:
    """Hint ``df`` for broadcast only when it provably has at most ``max_rows`` rows.

    The bound comes from ``bound``, from the DataFrame's recorded
    ``row_bound``, or - with ``probe=True`` - from a counting job. With
    ``unique_on`` the side, whatever its size, is checked for duplicate keys,
    which would silently fan out the other side (J9). Without a proven bound
    ``df`` is returned unhinted and Spark's size-checked planner decides.
    """
    n = bound if bound is not None else row_bound(df)
    if n is None and probe:
        n = probe_rows(df, max_rows)
    if unique_on:
        require_unique(df, unique_on)
    if n is None or n > max_rows:
        return df
    return F.broadcast(df)


def small_table(df: DataFrame, max_rows: int) -> DataFrame:
    """A side that should be small (an aggregate over few keys), computed once, written and counted
    while the plan is built, and broadcast if it has at most ``max_rows`` rows; else it is joined as it is."""
    held = written_once(df)
    return bounded_broadcast(held, max_rows, bound=held.count())


def norm_key_join(
    left: DataFrame,
    right: DataFrame,
    left_text: str,
    right_text: str,
    extra_keys: Sequence[str] = (),
    how: str = "left",
    key_name: str = "_norm_key",
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    unique: bool = True,
) -> DataFrame:
    """Join on ``norm_text`` of a text column on both sides (+ equal extra keys).

    The normalised key is computed once per side as a column, so the join is a
    plain equi-join (hashable, broadcastable) rather than a function in the
    condition. The right side must be unique on the *normalised* key: two
    spellings of one key would silently double the left rows (``unique=False``
    for a side that is meant to fan out). That check is a job of its own on every call,
    while the plan is built.
    """
    bound = row_bound(right)
    lk = left.withColumn(key_name, norm_text(left_text))
    rk = right.withColumn(key_name, norm_text(right_text)).drop(right_text)
    keys = [key_name, *extra_keys]
    if unique:
        require_unique(rk, keys)
    rk = bounded_broadcast(rk, max_rows, bound=bound)
    return lk.join(rk, keys, how)


def range_join(
    left: DataFrame,
    intervals: DataFrame,
    point: str | Column,
    valid_from: str,
    valid_to: str,
    keys: Sequence[str] = (),
    how: str = "left",
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    bound: int | None = None,
) -> DataFrame:
    """SCD2 lookup - equal on ``keys`` and ``valid_from <= point <= valid_to``.

    An open interval end is stored as ``9999-12-31``. The equi part keeps the
    join hashable; the interval table is a seed-sized dimension and is
    broadcast behind the bound check (beyond it the join shuffles on keys).
    """
    p = F.col(point) if isinstance(point, str) else point
    iv = bounded_broadcast(intervals, max_rows, bound=bound if bound is not None else row_bound(intervals))
    cond = [left[k] == iv[k] for k in keys]
    cond.append((p >= iv[valid_from]) & (p <= iv[valid_to]))
    out = left.join(iv, cond, how)
    for k in keys:
        out = out.drop(iv[k])
    return out


def with_parent(child: DataFrame, parent: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Child rows joined to their parent on the (composite) lineage key."""
    return child.join(parent, list(keys), how)


def keep_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J15 (``exists``): rows of ``df`` whose key appears in ``other`` (no fan-out)."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J13/J16 (left join ... is null / delete using): rows with no match in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def with_counts(df: DataFrame, counts: DataFrame, keys: Sequence[str], count_cols: Sequence[str]) -> DataFrame:
    """Left join to pre-aggregated counts, absent counts as 0."""
    out = df.join(counts, list(keys), "left")
    for c in count_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("bigint")))
    return out


#: Interval bins: an interval lies in ``BIN_SPAN`` bins of its level at most (and one more, where it
#: begins within a bin); each level's bins are ``BIN_SPAN`` times as wide as those of the level before.
BIN_SPAN = 16


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    valid_from: str,
    valid_to: str,
    keys: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """J17 for interval tables of any size: equal on ``keys`` and ``valid_from <= point <= valid_to``
    (dates), without a broadcast and without pairs of a key.

    What a point matches depends on its keys and its day alone, so the distinct
    (keys, day) are looked up: however many rows a hot key has, it has as many of these
    as there are days. Keys whose intervals do not overlap (histories: as many intervals
    as days at most) are looked up in order of days (``_latest_begun``), the intervals of
    the others by bins (``_met_in_bins``). The rows then join what their day found;
    partitions of a hot (key, day) are split by Spark. Whether intervals overlap, and in
    which keys, is measured while the plan is built.

    Null keys, points and bounds match nothing. ``how`` is ``inner`` or ``left``; a point
    in several intervals comes out once for each.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    extra = [c for c in intervals.columns if c not in set(keys)]
    day = lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))
    known = lambda *cs: functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cs])
    iv = intervals.filter(known(*keys, valid_from, valid_to)).withColumns({"_lo": day(valid_from), "_hi": day(valid_to)}).filter("_lo <= _hi")
    iv = iv.select(*keys, "_lo", "_hi", F.struct(*extra).alias("_found"))
    days = points.filter(known(*keys, point)).select(*keys, day(point).alias("_day")).distinct()
    several = written_once(_overlapping(iv, keys))
    if several.isEmpty():
        found = _latest_begun(days, iv, keys)
    elif keys:
        found = _latest_begun(days, drop_matching(iv, several, keys), keys).unionByName(_met_in_bins(days, keep_matching(iv, several, keys), keys))
    else:
        found = _met_in_bins(days, iv, keys)
    rows = points.withColumn("_day", day(point)).join(found, [*keys, "_day"], how)
    return rows.select(*points.columns, *[F.col(f"_found.{c}").alias(c) for c in extra])


def _overlapping(iv: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of which two intervals have a day in common (for no keys: a row if any two have).

    The intervals are combined by the day they begin first, so that a key brings no more rows
    to its task than there are days."""
    begun = iv.groupBy(*keys, "_lo").agg(F.max("_hi").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    met = begun.withColumn("_reach", F.max("_hi").over(before)).filter("_n > 1 OR _reach >= _lo")
    return met.select(*(keys or [F.lit(1).alias("_all")])).distinct()


def _latest_begun(days: DataFrame, iv: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, day) with the interval the day lies in, where a key's intervals do not overlap: the
    one that began last, if it reaches the day. Days and intervals are shuffled once, by their keys."""
    begin = iv.select(*keys, F.col("_lo").alias("_day"), F.struct("_hi", "_found").alias("_iv"))
    both = begin.unionByName(days, allowMissingColumns=True)
    # on one day the interval comes before the point
    upto = Window.partitionBy(*keys).orderBy("_day", F.col("_iv").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = both.withColumn("_last", F.last("_iv", ignorenulls=True).over(upto))
    return last.filter("_iv IS NULL AND _last._hi >= _day").select(*keys, "_day", F.col("_last._found").alias("_found"))


def _met_in_bins(days: DataFrame, iv: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, day) with each interval the day lies in, by an equi-join on (keys, level, bin).

    An interval takes the narrowest level of bins in which it spans ``BIN_SPAN`` (one,
    sixteen, 256 ... days wide) and has a row for each of its bins there, so an open end
    costs a few rows, not one a day; a day has one row for each level that occurs."""
    width = F.pow(F.lit(float(BIN_SPAN)), F.col("_level")).cast("bigint")
    powers = F.array(*[F.lit(BIN_SPAN**k) for k in range(1, 12)]).cast("array<bigint>")
    iv = iv.withColumn("_level", F.size(F.filter(powers, lambda w: w < F.col("_hi") - F.col("_lo") + 1)))
    iv = iv.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width))))
    levels = sorted(r[0] for r in iv.select("_level").distinct().collect())  # twelve at most
    days = keep_matching(days, iv.select(*keys).distinct(), keys) if keys else days
    placed = days.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    placed = placed.withColumn("_bin", F.floor(F.col("_day") / width))
    met = placed.join(iv, [*keys, "_level", "_bin"]).filter(F.col("_day").between(F.col("_lo"), F.col("_hi")))
    return met.select(*keys, "_day", "_found")
