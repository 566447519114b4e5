"""Row and layer visibility.

A consumer sees a row only when ``(role, entity_id)`` is in the access map.
An unknown role or a null tenant sees nothing. The policy is a ``left_semi``
join with the role's slice of the access map, which is broadcast behind a
size check (it grows with tenants, not with data).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast, keep_bound

CONTROL_TABLES = frozenset({"entity_access"})
CONSUMER_LAYERS = ("serving", "core")


def secure_view(df: DataFrame, access: DataFrame, role: str, tenant_col: str = "entity_id") -> DataFrame:
    """A1: rows of ``df`` whose tenant the ``role`` may see (semi join, no fan-out)."""
    allowed = access.filter(F.col("role_name") == role).select(F.col("entity_id").alias(tenant_col))
    return df.join(bounded_broadcast(keep_bound(allowed, access), max_rows=1_000_000), tenant_col, "left_semi")


def tenant_tables(tables: Mapping[str, DataFrame], tenant_col: str = "entity_id") -> list[str]:
    """The tables that carry a tenant column, never the control table."""
    return sorted(
        name for name, df in tables.items() if tenant_col in df.columns and name not in CONTROL_TABLES
    )


def publish_for_role(
    tables: Mapping[str, tuple[str, DataFrame]],
    access: DataFrame,
    role: str,
    layers: Iterable[str] = CONSUMER_LAYERS,
    tenant_col: str = "entity_id",
) -> dict[str, DataFrame]:
    """A2 + A3: consumer views for one role.

    ``tables`` maps a name to ``(layer, df)``. Only consumer layers are
    published; every published table with a tenant column goes through
    ``secure_view``; a table without one is not exposed at all.
    """
    keep = set(layers)
    out: dict[str, DataFrame] = {}
    for name, (layer, df) in tables.items():
        if layer not in keep or name in CONTROL_TABLES:
            continue
        if tenant_col not in df.columns:
            continue
        out[f"{layer}.{name}"] = secure_view(df, access, role, tenant_col)
    return out
