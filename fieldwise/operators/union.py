"""Unions with a discriminator.

``observe`` (in ``resolve``) unions independent arms by name. When all arms
are projections of ONE input (estimated and actual charges of the same
lines), ``stack_arms`` emits them from a single scan: each row becomes one
row per arm through ``explode`` of an array of structs. Same rows as
``union all`` of the projections, half the I/O.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_arms(
    df: DataFrame,
    tag: str,
    arms: Mapping[str, Mapping[str, Column]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """One output row per (input row, arm); ``tag`` names the arm.

    Every arm must project the same value names (by name, never by position).
    """
    names = None
    structs = []
    for label, cols in arms.items():
        if names is None:
            names = list(cols)
        elif list(cols) != names:
            raise ValueError(f"arm {label!r} projects {list(cols)}, expected {names}")
        structs.append(F.struct(F.lit(label).alias(tag), *[c.alias(n) for n, c in cols.items()]))
    exploded = df.select(*keep, F.explode(F.array(*structs)).alias("_arm"))
    return exploded.select(*keep, F.col(f"_arm.{tag}").alias(tag), *[F.col(f"_arm.{n}").alias(n) for n in names])


@dataclass(frozen=True)
class ArmSpec:
    """One observation arm read from a shared input: the rows it covers
    (``when``; None = all), its source tag, priority, time and values."""

    source: str
    priority: int
    observed_at: Column
    values: Mapping[str, Column]
    when: Column | None = None


class UncoveredFieldError(ValueError):
    """An arm supplies a field that no candidate list accepts from its source."""


def check_arm_coverage(arms: Sequence[ArmSpec], candidates, ignore: Sequence[str] = ()) -> None:
    """Adding a source needs an arm *and* a candidate entry; fail the build
    when an arm supplies a field its source is not a candidate for (the value
    would otherwise be silently dropped by resolution)."""
    for a in arms:
        for f in a.values:
            if f in ignore:
                continue
            if a.source not in candidates.fields.get(f, ()):
                raise UncoveredFieldError(f"arm {a.source!r} supplies {f!r} but is not a candidate for it")


def stack_observations(
    df: DataFrame,
    keys: Sequence[str],
    arms: Sequence[ArmSpec],
    schema: Mapping[str, str],
    candidates=None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """U1/U2 from ONE scan: every input row emits one observation per arm that covers it.

    ``schema`` declares each value field's type; an arm that does not know a
    field contributes a typed null (by name, never by position - T8). The
    result has ``keys``, ``source``, ``source_priority``, ``observed_at`` and
    the value fields - the same rows as ``observe`` over per-arm projections,
    without re-reading the input per arm. With ``candidates`` the arms are
    checked against the candidate table first (T18); ``ignore`` lists fields
    that are carried for ordering only (tie-breaks).
    """
    if candidates is not None:
        check_arm_coverage(arms, candidates, ignore)
    unknown = {f for a in arms for f in a.values} - set(schema)
    if unknown:
        raise ValueError(f"fields without a declared type: {sorted(unknown)}")
    structs = []
    for a in arms:
        body = F.struct(
            F.lit(a.source).alias("source"),
            F.lit(a.priority).cast("int").alias("source_priority"),
            a.observed_at.cast("timestamp").alias("observed_at"),
            *[a.values.get(f, F.lit(None)).cast(t).alias(f) for f, t in schema.items()],
        )
        structs.append(body if a.when is None else F.when(a.when, body))
    obs = F.filter(F.array(*structs), lambda x: x.isNotNull())
    out = df.select(*keys, F.explode(obs).alias("_o"))
    return out.select(*keys, "_o.*")
