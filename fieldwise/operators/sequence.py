"""Ordered scans per key that survive a hot key (E2, E3 batch forms).

"Previous event of the same key" and "gap-based session of the same key" are
order-dependent, so the usual plan is a window partitioned by the key - which
puts every row of a key into one task. When one resource holds a third of
all events, that task holds a third of the data.

Here the rows are **range-partitioned on (key, time, tiebreak)** instead.
Range partitioning samples the full sort key, so a hot key is split over
many partitions by time. Each partition is scanned in order (Arrow batches,
``mapInPandas``, carrying state between batches); only the first key-run of
a partition can continue from the previous partition, and that carry comes
from a per-partition boundary table (one row per partition - its size is
bounded by the partition count, never by the data), resolved with windows
over that tiny table and broadcast back.

The scanned rows are written once to the shared checkpoint folder, while the plan is
being built (so ``ordered_scan`` runs a job), and the boundary pass reads what was
written: the data is shuffled once and both passes see the same range bounds. There
are as many ranges as ``spark.sql.shuffle.partitions`` says, or ``num_partitions``:
size it so that a range fits a task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written_once
from .joins import bounded_broadcast

# The pandas functions of this module run in Python workers. Pickle them by
# value so executors need numpy and pandas only, not this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EXTRA = [
    T.StructField("_pid", T.IntegerType()),
    T.StructField("_t", T.LongType()),
    T.StructField("_prev", T.LongType()),
    T.StructField("_lstart", T.LongType()),
    T.StructField("_head", T.BooleanType()),
    T.StructField("_first", T.BooleanType()),
]


def _same(a: pd.Series, b: pd.Series) -> np.ndarray:
    eq = (a == b).to_numpy(dtype=bool, na_value=False)
    return eq | (a.isna().to_numpy() & b.isna().to_numpy())


def _key_equal(a: tuple, b: tuple) -> bool:
    for x, y in zip(a, b):
        xn = x is None or (isinstance(x, float) and np.isnan(x)) or x is pd.NaT
        yn = y is None or (isinstance(y, float) and np.isnan(y)) or y is pd.NaT
        if xn and yn:
            continue
        if xn != yn or x != y:
            return False
    return True


def _scan_fn(keys: Sequence[str], gap_us: int | None, marked: bool = False):
    keys = list(keys)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key: tuple | None = None
        last_t: int | None = None
        last_start: int | None = None
        last_mt = last_mv = None
        in_head = True
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            t = pdf["_t"].to_numpy(dtype=np.int64)
            same = np.ones(n, dtype=bool)
            for k in keys:
                col = pdf[k]
                same &= _same(col, col.shift(1))
            first_key = tuple(pdf[k].iloc[0] for k in keys)
            first_of_partition = last_key is None
            same[0] = (not first_of_partition) and _key_equal(first_key, last_key)
            has_prev = same.copy()  # the row before is of the same key, in this batch or the last one
            prev = np.empty(n, dtype=np.int64)
            prev[1:] = t[:-1]
            prev[0] = 0 if last_t is None else last_t
            prev[~has_prev] = 0
            new_run = ~same
            runs = np.cumsum(new_run)
            if first_of_partition:
                head = runs == 1
            elif in_head:
                head = runs == 0
            else:
                head = np.zeros(n, dtype=bool)
            start = new_run if gap_us is None else new_run | (has_prev & (t - prev > gap_us))
            first = np.zeros(n, dtype=bool)
            if first_of_partition:
                start[0] = False
                first[0] = True
            # integers throughout: order values over 2**53 stay exact
            starts = pd.Series(pd.arrays.IntegerArray(t.copy(), ~start))
            if same[0] and not start[0] and last_start is not None:
                starts.iloc[0] = last_start
            starts = starts.ffill()
            out = pdf.copy()
            out["_prev"] = pd.arrays.IntegerArray(prev, ~has_prev)
            out["_lstart"] = starts.array
            out["_head"] = head
            out["_first"] = first
            if marked:
                # the newest marked row at or before each row, within the key run
                m = pdf["_mark"].fillna(False).to_numpy(dtype=bool)
                mt = pd.Series(pd.arrays.IntegerArray(t.copy(), ~m))
                value = pdf["_mval"].to_numpy(dtype=np.int64)
                mv = pd.Series(pd.arrays.IntegerArray(value.copy(), ~m | pdf["_mnull"].to_numpy(dtype=bool)))
                if same[0] and not m[0] and last_mt is not None:
                    mt.iloc[0], mv.iloc[0] = last_mt, last_mv
                mt = mt.groupby(runs).ffill()
                mv = mv.groupby(runs).ffill()
                out["_lmt"] = mt.array
                out["_lmv"] = mv.array
                last_mt = None if pd.isna(mt.iloc[-1]) else int(mt.iloc[-1])
                last_mv = None if pd.isna(mv.iloc[-1]) else int(mv.iloc[-1])
            last_key = tuple(pdf[k].iloc[-1] for k in keys)
            last_t = int(t[-1])
            ls = starts.iloc[-1]
            last_start = None if pd.isna(ls) else int(ls)
            in_head = bool(in_head and (runs[-1] == runs[0]) and (first_of_partition or same[0]))
            yield out

    return scan


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    gap_seconds: float | None = None,
    num_partitions: int | None = None,
    mark: str | Column | None = None,
    mark_value: str | None = None,
) -> DataFrame:
    """Add ``prev_ts`` (previous row of the same key) and, with a gap,
    ``session_start`` (start of the gap-bounded session the row belongs to).

    With ``mark`` (a boolean column) also ``last_mark_ts`` and
    ``last_mark_value``: the order value and ``mark_value`` (a long column) of
    the newest marked row at or before each row of the same key - an as-of
    lookup that never pairs rows.

    ``ts`` is a timestamp, or a long (any order value; then results are longs
    and ``gap_seconds`` is not allowed). Order is ``ts`` then ``tiebreak``;
    rows with equal order keep a deterministic order only if ``tiebreak``
    makes it total.
    """
    keys = list(keys)
    order = [*keys, ts, *tiebreak]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_long = isinstance(df.schema[ts].dataType, (T.LongType, T.IntegerType))
    if is_long and gap_seconds is not None:
        raise ValueError("gap_seconds needs a timestamp order column")
    as_out = (lambda c: c) if is_long else F.timestamp_micros
    gap_us = None if gap_seconds is None else int(gap_seconds * 1_000_000)
    src = df
    if mark is not None:
        m = F.col(mark) if isinstance(mark, str) else mark
        value = F.col(mark_value).cast("bigint") if mark_value else F.lit(None).cast("bigint")
        # never null on the way to pandas, which would turn the longs into floats
        src = src.withColumns({"_mark": m, "_mval": F.coalesce(value, F.lit(0).cast("bigint")), "_mnull": value.isNull()})
    ranged = src.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in order]
    )
    t_expr = F.col(ts).cast("bigint") if is_long else F.unix_micros(F.col(ts))
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_t", t_expr)
    extra = _EXTRA[2:] + ([T.StructField("_lmt", T.LongType()), T.StructField("_lmv", T.LongType())] if mark is not None else [])
    schema = T.StructType(list(ranged.schema.fields) + extra)
    # Written once: both branches below (rows and boundary table) must see the same
    # range bounds and partition numbers, whatever plan each of them gets.
    scanned = written_once(ranged.mapInPandas(_scan_fn(keys, gap_us, marked=mark is not None), schema))

    kstruct = F.struct(*[F.col(k) for k in keys])
    ostruct = F.struct(*[F.col(c) for c in [*keys, "_t", *tiebreak]])
    bound_aggs = [
        F.min_by(kstruct, ostruct).alias("_fk"),
        F.min(F.when(F.col("_first"), F.col("_t"))).alias("_ft"),
        F.max_by(kstruct, ostruct).alias("_lk"),
        F.max_by(F.col("_t"), ostruct).alias("_lt"),
        F.max_by(F.col("_lstart"), ostruct).alias("_ls"),
    ]
    if mark is not None:
        last_mark = F.when(F.col("_lmt").isNotNull(), F.struct(F.col("_lmt").alias("t"), F.col("_lmv").alias("v")))
        bound_aggs.append(F.max_by(last_mark, ostruct).alias("_lm"))
    bounds = scanned.groupBy("_pid").agg(*bound_aggs)
    w = Window.orderBy("_pid")
    b = bounds.withColumn("_plk", F.lag("_lk").over(w)).withColumn("_plt", F.lag("_lt").over(w))
    cont = F.col("_plk").eqNullSafe(F.col("_fk"))
    if gap_us is None:
        head_starts = ~cont
    else:
        head_starts = ~cont | ((F.col("_ft") - F.col("_plt")) > F.lit(gap_us))
    whole = F.col("_fk").eqNullSafe(F.col("_lk"))
    b = b.withColumn("_ls_eff", F.coalesce(F.col("_ls"), F.when(whole & head_starts, F.col("_ft"))))
    chain = Window.partitionBy("_lk").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("_res", F.last("_ls_eff", ignorenulls=True).over(chain))
    b = b.withColumn("_pres", F.lag("_res").over(w))
    carry_cols = [
        "_pid",
        "_ft",
        F.when(cont, F.col("_plt")).alias("_cprev"),
        F.when(cont, F.col("_pres")).alias("_cstart"),
        head_starts.alias("_hstarts"),
    ]
    if mark is not None:
        b = b.withColumn("_mres", F.last("_lm", ignorenulls=True).over(chain)).withColumn("_pmres", F.lag("_mres").over(w))
        carry_cols.append(F.when(cont, F.col("_pmres")).alias("_cmark"))
    carry = b.select(*carry_cols)
    # one row per partition: its size is the partition count, known here
    j = scanned.join(bounded_broadcast(carry, max_rows=1_000_000, bound=n), "_pid", "left")
    prev = F.coalesce(F.col("_prev"), F.when(F.col("_first"), F.col("_cprev")))
    out = j.withColumn("prev_ts", as_out(prev))
    if gap_us is not None:
        head_start = F.when(F.col("_hstarts"), F.col("_ft")).otherwise(F.col("_cstart"))
        start = F.coalesce(F.col("_lstart"), F.when(F.col("_head"), head_start))
        out = out.withColumn("session_start", F.timestamp_micros(start))
    drop = ["_pid", "_t", "_prev", "_lstart", "_head", "_first", "_ft", "_cprev", "_cstart", "_hstarts"]
    if mark is not None:
        local = F.col("_lmt").isNotNull()
        out = out.withColumn(
            "last_mark_ts", as_out(F.when(local, F.col("_lmt")).otherwise(F.when(F.col("_head"), F.col("_cmark.t"))))
        ).withColumn(
            "last_mark_value", F.when(local, F.col("_lmv")).otherwise(F.when(F.col("_head"), F.col("_cmark.v")))
        )
        drop += ["_mark", "_mval", "_mnull", "_lmt", "_lmv", "_cmark"]
    return out.drop(*drop)


def sessionize(
    df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Gap-based sessions per key: a new session starts when the previous event
    of the key is more than ``gap_seconds`` earlier (or there is none)."""
    return ordered_scan(df, keys, ts, tiebreak, gap_seconds=gap_seconds)


def previous_in_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``prev_ts``: the time of the previous row of the same key (null for the first)."""
    return ordered_scan(df, keys, ts, tiebreak)


def within(prev: Column, ts: Column, seconds: float) -> Column:
    """True when ``prev`` exists and lies less than or exactly ``seconds`` before ``ts``."""
    return prev.isNotNull() & ((F.unix_micros(ts) - F.unix_micros(prev)) <= F.lit(int(seconds * 1_000_000)))
