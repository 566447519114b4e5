"""JSON documents as text.

A report row arrives as one JSON object whose keys are the report's column
headers (spaces, ``#`` and ``/`` included). It is parsed **once** into a
``map<string,string>`` and then projected by key; parsing per column would
re-read the document once per field. ``from_json`` keeps the last of
duplicate keys like ``jsonb`` does, and a JSON null becomes SQL null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_MAP = "map<string,string>"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_map(doc: str | Column) -> Column:
    """Parse a JSON object into ``map<string,string>`` (values kept as text).

    ``from_json`` keeps duplicate keys as separate entries and a lookup would
    find the first; rebuilding the map with ``map_from_entries`` applies the
    session's ``LAST_WIN`` dedup policy, so the last duplicate wins as in jsonb.
    """
    return F.map_from_entries(F.map_entries(F.from_json(_c(doc), TEXT_MAP)))


def json_struct(doc: str | Column, keys: Sequence[str]) -> Column:
    """Parse a JSON object once into a struct of text fields named by ``keys``.

    The declared-header form of X11: one parse per row, last duplicate wins,
    absent keys are null. Field names may contain spaces and symbols.
    """
    fields = ", ".join(f"`{k.replace('`', '``')}`: string" for k in keys)
    return F.from_json(_c(doc), f"struct<{fields}>")


def json_field(doc: str | Column, key: str) -> Column:
    """X11 for a single key: ``doc ->> key`` without building a map.

    Keys with spaces or symbols use the bracket path, which ``get_json_object``
    accepts.
    """
    safe = key.replace("'", "\\'")
    return F.get_json_object(_c(doc), f"$['{safe}']")


def map_field(m: str | Column, key: str) -> Column:
    """X11 on a parsed map: ``m[key]``, null when absent."""
    return _c(m).getItem(key)


def json_int(doc: str | Column, key: str) -> Column:
    """``(doc ->> key)::int`` that yields null on junk instead of raising."""
    return json_field(doc, key).try_cast("int")


def has_key(doc: str | Column, key: str) -> Column:
    """``doc ? key`` - the key is present even when its value is JSON null."""
    return F.array_contains(F.json_object_keys(_c(doc)), F.lit(key))


def canonical_hash(*cols: str | Column, sort_arrays: Sequence[str] = ()) -> Column:
    """sha1 of a canonical JSON rendering (fields in name order).

    ``sort_arrays`` names array columns whose element order must not change the
    hash (e.g. the jobs of an opportunity, sorted by id).
    """
    named = []
    for c in cols:
        name = c if isinstance(c, str) else None
        if name is None:
            raise ValueError("canonical_hash takes column names")
        named.append(name)
    parts = []
    for name in sorted(named):
        c = F.col(name)
        if name in sort_arrays:
            c = F.array_sort(c)
        parts.append(c.alias(name))
    return F.sha1(F.to_json(F.struct(*parts)))
