"""Declarative data tests and contracts (Q1-Q11).

Each check returns the *failing rows* as a DataFrame (so they can be
inspected or quarantined); ``run_checks`` folds many checks into one result
table ``(check_name, table_name, column_name, failing_rows, sample)`` where the
sample is the smallest failing key as text - bounded, deterministic, and
never a collected list.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import json_map
from .joins import bounded_broadcast


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """Q2: key values that occur more than once (optionally among rows matching ``where``).

    One grouped aggregation with partial aggregation; only duplicate keys leave it.
    """
    src = df.filter(where) if where is not None else df
    return src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def accepted_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Q3: rows whose non-null ``col`` is outside ``values`` (nulls pass)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q4: child rows whose non-null ``col`` has no parent (anti join)."""
    p = parent.select(F.col(parent_col).alias(col))
    return child.filter(F.col(col).isNotNull()).join(p, col, "left_anti")


@dataclass(frozen=True)
class Check:
    """One declared test: kind in {not_null, unique, accepted_values, relationships}."""

    kind: str
    table: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    where: str | None = None


def failing(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if check.where:
        df = df.filter(F.expr(check.where))
    if check.kind == "not_null":
        return not_null(df, check.columns[0])
    if check.kind == "unique":
        return unique(df, list(check.columns))
    if check.kind == "accepted_values":
        return accepted_values(df, check.columns[0], check.values)
    if check.kind == "relationships":
        return relationships(df, check.columns[0], tables[check.parent], check.parent_column)
    raise ValueError(f"unknown check kind {check.kind}")


def _key_text(cols: Sequence[str]) -> Column:
    if len(cols) == 1:
        return F.col(cols[0]).cast("string")
    return F.concat_ws(":", *[F.col(c).cast("string") for c in cols])


ROW_LEVEL = ("not_null", "accepted_values")


def _failing_condition(check: Check) -> Column:
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    return c.isNotNull() & ~c.isin(list(check.values))


def _result(kind: str, table: str, columns: Sequence[str], failing: Column, sample: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(",".join(columns)).alias("column_name"),
        failing.alias("failing_rows"),
        sample.alias("sample"),
    )


def run_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks as one result table.

    Row-level checks (``not_null``, ``accepted_values``) of one table (and one
    ``where``) are evaluated together in a single pass - one aggregation with
    a ``count_if`` and a sample per check - so a table with dozens of declared
    tests is scanned once for all of them. ``unique`` and ``relationships``
    need their own keyed aggregation / anti join each.
    """
    parts = []
    groups: dict[tuple[str, str | None], list[Check]] = {}
    for c in checks:
        if c.kind in ROW_LEVEL:
            groups.setdefault((c.table, c.where), []).append(c)
    for (table, where), group in groups.items():
        df = tables[table]
        if where:
            df = df.filter(F.expr(where))
        aggs = []
        for i, c in enumerate(group):
            bad = _failing_condition(c)
            aggs.append(F.count_if(bad).alias(f"_n{i}"))
            aggs.append(F.min(F.when(bad, _key_text(list(c.key)))).alias(f"_s{i}"))
        one = df.agg(*aggs)
        rows = [_result(c.kind, c.table, c.columns, F.col(f"_n{i}"), F.col(f"_s{i}")) for i, c in enumerate(group)]
        parts.append(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for c in checks:
        if c.kind in ROW_LEVEL:
            continue
        bad = failing(c, tables)
        key = list(c.columns) if c.kind == "unique" else list(c.key)
        one = bad.agg(F.count(F.lit(1)).alias("_n"), F.min(_key_text(key)).alias("_s"))
        parts.append(one.select(_result(c.kind, c.table, c.columns, F.col("_n"), F.col("_s")).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def landed_vs_expected(
    rows: DataFrame, manifest: DataFrame, keys: Sequence[str], expected_col: str = "expected_records"
) -> DataFrame:
    """A-9 + Q5: landed rows per delivery against the announced count; mismatches only.

    A delivery with nothing landed counts 0 (left join from the manifest).
    """
    landed = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("landed_records"))
    j = manifest.select(*keys, expected_col).join(landed, list(keys), "left")
    j = j.withColumn("landed_records", F.coalesce(F.col("landed_records"), F.lit(0).cast("bigint")))
    return j.filter(~F.col("landed_records").eqNullSafe(F.col(expected_col).cast("bigint")))


def freshness_report(
    df: DataFrame,
    group_col: str,
    ts: str,
    as_of,
    targets: DataFrame | None = None,
    stale_hours: float = 26,
) -> DataFrame:
    """Q6 + Q7 (+ A-8): rows and newest time per group, age, staleness, per-group target."""
    now = F.unix_micros(F.lit(as_of).cast("timestamp"))
    f = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_rows"), F.max(ts).alias("max_ts"))
    if targets is not None:
        # every group that has a target is reported, also one without any row
        listed = bounded_broadcast(targets, 100_000)
        f = f.join(listed, group_col, "full_outer").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("bigint")))
    age_us = now - F.unix_micros(F.col("max_ts"))
    f = f.withColumn("age_hours", age_us / F.lit(3.6e9)).withColumn(
        "is_stale", (F.col("n_rows") == 0) | (age_us > F.lit(int(stale_hours * 3600 * 1_000_000)))
    )
    if targets is not None:
        late = age_us > F.col("target_minutes").cast("bigint") * F.lit(60 * 1_000_000)
        f = f.withColumn("breaches_target", F.when((F.col("n_rows") == 0) & F.col("target_minutes").isNotNull(), True).otherwise(late))
    return f


class Observed:
    """Row-level checks (Q1, Q3) and parse losses (Q8) measured while a model is written.

    ``attach`` adds one set of metrics to the DataFrame (``DataFrame.observe``), which Spark
    computes over the rows as they pass to the writer: no second scan, whatever the number
    of checks. ``results`` waits for that write. Keyed checks (Q2, Q4) need a shuffle of their own
    and stay with ``run_checks``.
    """

    def __init__(self, checks: Sequence[Check], losses: Mapping[str, tuple[Column, Column]] | None = None) -> None:
        bad_kind = [c.kind for c in checks if c.kind not in ROW_LEVEL]
        if bad_kind:
            raise ValueError(f"not row-level: {bad_kind}")
        self.checks, self.losses, self._observation = list(checks), dict(losses or {}), Observation()

    def metrics(self) -> list[Column]:
        out = []
        for i, c in enumerate(self.checks):
            bad = _failing_condition(c)
            bad = bad & F.coalesce(F.expr(c.where), F.lit(False)) if c.where else bad
            out += [F.count_if(bad).alias(f"n{i}"), F.min(F.when(bad, _key_text(list(c.key)))).alias(f"s{i}")]
        for i, (raw, typed) in enumerate(self.losses.values()):
            given = F.coalesce(F.trim(raw) != "", F.lit(False))
            out += [F.count_if(given).alias(f"given{i}"), F.count_if(given & typed.isNull()).alias(f"lost{i}")]
        return out

    def attach(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *self.metrics()) if self.checks or self.losses else df

    def results(self) -> list[tuple[str, str, str, int, str | None]]:
        """(check_name, table_name, column_name, failing_rows, sample) of each check."""
        got = self._observation.get if self.checks else {}
        return [(c.kind, c.table, ",".join(c.columns), got[f"n{i}"], got[f"s{i}"]) for i, c in enumerate(self.checks)]

    def lost(self) -> list[tuple[str, int, int]]:
        """(column_name, n_nonblank, n_lost) of each parsed column."""
        got = self._observation.get if self.losses else {}
        return [(name, got[f"given{i}"], got[f"lost{i}"]) for i, name in enumerate(self.losses)]


RESULT_SCHEMA = "check_name string, table_name string, column_name string, failing_rows bigint, sample string"


def parse_losses(df: DataFrame, pairs: Mapping[str, tuple[str | Column, Column]]) -> DataFrame:
    """Q8: per column, non-blank inputs and how many of them typed to null.

    ``pairs`` maps a column name to ``(raw text, typed value)``. One pass over
    ``df`` computes every column's counts (typed and raw together), then the
    one-row result is unpivoted.
    """
    aggs = []
    for name, (raw, typed) in pairs.items():
        r = F.col(raw) if isinstance(raw, str) else raw
        nonblank = r.isNotNull() & (F.trim(r) != "")
        aggs.append(F.count_if(nonblank).alias(f"{name}__n"))
        aggs.append(F.count_if(nonblank & typed.isNull()).alias(f"{name}__lost"))
    one = df.agg(*aggs)
    rows = [
        F.struct(F.lit(n).alias("column_name"), F.col(f"{n}__n").alias("n_nonblank"), F.col(f"{n}__lost").alias("n_lost"))
        for n in pairs
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def contract_diff(stored: T.StructType, current: T.StructType) -> list[tuple[str, str]]:
    """Differences between a published contract and the current schema.

    Returns ``(column, problem)``; ``problem`` is ``removed`` or ``type_changed``
    (breaking, needs a new ``_v2``) or ``added`` (additive, allowed).
    """
    old = {f.name: f.dataType for f in stored.fields}
    new = {f.name: f.dataType for f in current.fields}
    out = []
    for name, dtype in old.items():
        if name not in new:
            out.append((name, "removed"))
        elif new[name] != dtype:
            out.append((name, "type_changed"))
    for name in new:
        if name not in old:
            out.append((name, "added"))
    return out


def is_breaking(diff: Sequence[tuple[str, str]]) -> bool:
    return any(p in ("removed", "type_changed") for _, p in diff)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    value: str,
    left_name: str = "left_total",
    right_name: str = "right_total",
    tolerance=0,
) -> DataFrame:
    """Q10 (+ A-7): totals of two layers per key, full outer join, mismatches only."""
    lt = left.groupBy(*keys).agg(F.sum(value).alias(left_name))
    rt = right.groupBy(*keys).agg(F.sum(value).alias(right_name))
    j = lt.join(rt, list(keys), "full_outer")
    diff = F.coalesce(F.col(left_name), F.lit(0)) - F.coalesce(F.col(right_name), F.lit(0))
    return j.withColumn("difference", diff).filter(F.abs(F.col("difference")) > F.lit(tolerance))


def header_drift(rows: DataFrame, generation: Sequence[str], doc_col: str = "row_data") -> DataFrame:
    """Q11: generations whose rows do not all carry the same header set.

    The header set of a row is its sorted key list; a generation drifts when
    it has more than one distinct set. Two grouped aggregations, no collect.
    """
    sig = F.array_join(F.array_sort(F.map_keys(json_map(doc_col))), "\u0001")
    sets = rows.groupBy(*generation, sig.alias("_sig")).agg(F.count(F.lit(1)).alias("_n"))
    return sets.groupBy(*generation).agg(F.count(F.lit(1)).alias("n_header_sets")).filter(F.col("n_header_sets") > 1)
