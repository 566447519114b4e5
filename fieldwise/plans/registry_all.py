"""Import every query module so the catalog is complete."""

from __future__ import annotations

from . import (  # noqa: F401
    business_queries,
    cast_queries,
    change_queries,
    event_queries,
    feed_queries,
    operator_queries,
    quality_queries,
    resolution_queries,
    source_queries,
)
from .catalog import REGISTRY, Registered


def all_queries() -> dict[str, Registered]:
    return dict(REGISTRY)
