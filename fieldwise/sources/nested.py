"""Nested payloads as child tables.

An API payload carries children as arrays of structs (an opportunity's jobs,
a job's charges). ``flatten`` turns one array column into a child table that
keeps the parent key, the root key and the list position - losslessly, in
one narrow ``posexplode`` (no shuffle, no join back to the parent). The
sibling count (``count(*) over (partition by parent)``) is the array size,
read before exploding, so it needs no window either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(
    df: DataFrame,
    array_col: str,
    parent_keys: Sequence[str],
    root_keys: Sequence[str] = (),
    carry: Sequence[str] = (),
    keep_empty: bool = False,
) -> DataFrame:
    """Child rows of ``array_col``.

    Output: ``_parent_<k>`` for each parent key, ``_root_<k>`` for each root
    key, the ``carry`` columns unchanged, ``_list_idx`` (0-based position),
    ``_n_siblings`` (array size) and the element: struct fields as columns,
    a scalar element as ``value``. ``keep_empty`` keeps a parent with an
    empty or null array as one row with null child columns.
    """
    elem_type = df.schema[array_col].dataType
    if not isinstance(elem_type, T.ArrayType):
        raise TypeError(f"{array_col} is not an array")
    explode = F.posexplode_outer if keep_empty else F.posexplode
    head = [F.col(k).alias(f"_parent_{k}") for k in parent_keys]
    head += [F.col(k).alias(f"_root_{k}") for k in root_keys]
    head += [F.col(c) for c in carry]
    names = [f"_parent_{k}" for k in parent_keys] + [f"_root_{k}" for k in root_keys] + list(carry)
    sized = df.select(*head, F.coalesce(F.size(array_col), F.lit(0)).alias("_n_siblings"), F.col(array_col))
    out = sized.select(*names, "_n_siblings", explode(array_col).alias("_list_idx", "_elem"))
    if isinstance(elem_type.elementType, T.StructType):
        fields = [F.col(f"_elem.{f.name}").alias(f.name) for f in elem_type.elementType.fields]
    else:
        fields = [F.col("_elem").alias("value")]
    return out.select(*names, F.col("_list_idx").cast("bigint").alias("_list_idx"), "_n_siblings", *fields)


def grandchildren(
    df: DataFrame,
    child_array: str,
    grandchild_array: str,
    parent_keys: Sequence[str],
) -> DataFrame:
    """J2/S2 two levels down (opportunity -> jobs -> charges).

    The child's key is (parent key, child position); the root key is the
    top-level key, carried through both explodes.
    """
    kids = flatten(df, child_array, parent_keys, root_keys=parent_keys)
    kid_keys = [f"_parent_{k}" for k in parent_keys] + ["_list_idx"]
    renamed = kids.select(
        *[F.col(f"_root_{k}").alias(k) for k in parent_keys],
        *[F.col(c).alias(f"job_{c.removeprefix('_parent_')}") if c.startswith("_parent_") else F.col(c).alias("job_idx") for c in kid_keys],
        F.col(grandchild_array),
    )
    job_keys = [f"job_{k}" for k in parent_keys] + ["job_idx"]
    return flatten(renamed, grandchild_array, job_keys, root_keys=parent_keys)


def _pruned(struct: T.StructType) -> T.StructType:
    """A struct type without its arrays, at any depth."""
    kept = []
    for f in struct.fields:
        if isinstance(f.dataType, T.StructType):
            kept.append(T.StructField(f.name, _pruned(f.dataType)))
        elif not isinstance(f.dataType, T.ArrayType):
            kept.append(f)
    return T.StructType(kept)


def _arrays(struct: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """(path, element type) of the arrays of a struct, also in structs within it."""
    found: list[tuple[str, T.DataType]] = []
    for f in struct.fields:
        if isinstance(f.dataType, T.ArrayType):
            found.append((prefix + f.name, f.dataType.elementType))
        elif isinstance(f.dataType, T.StructType):
            found += _arrays(f.dataType, f"{prefix}{f.name}.")
    return found


def _json_path(path: str) -> str:
    return "$" + "".join(f"['{p}']" for p in path.split(".")) if path else "$"


def _surplus(v: Column, struct: T.StructType, prefix: str = "") -> Column:
    """What the declared columns do not hold, by path: unknown fields, and values of another type than declared."""
    declared = [f.name for f in struct.fields]
    fields = F.try_variant_get(v, _json_path(prefix.rstrip(".")), "map<string,variant>")
    unknown = F.transform_keys(F.map_filter(fields, lambda k, _: ~k.isin(declared)), lambda k, _: F.concat(F.lit(prefix), k))
    odd = []
    for f in struct.fields:
        path = prefix + f.name
        if isinstance(f.dataType, T.StructType):
            kind = "map<string,variant>"
        elif isinstance(f.dataType, T.ArrayType):
            kind = "array<variant>"
        else:
            kind = f.dataType.simpleString()
        raw = F.try_variant_get(v, _json_path(path), "variant")
        lost = raw.isNotNull() & ~F.is_variant_null(raw) & F.try_variant_get(v, _json_path(path), kind).isNull()
        odd.append(F.when(lost, F.struct(F.lit(path).alias("key"), raw.alias("value"))))
    entries = F.filter(F.array(*odd), lambda e: e.isNotNull())
    out = F.map_concat(F.coalesce(unknown, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))), F.map_from_entries(entries))
    for f in struct.fields:
        if isinstance(f.dataType, T.StructType):
            out = F.map_concat(out, _surplus(v, f.dataType, f"{prefix}{f.name}."))
    return out


def child_tables(df: DataFrame, payload: str, root_keys: Sequence[str], schema: T.StructType) -> dict[str, DataFrame]:
    """S2 for any payload: the parent table (``""``) and a table for every array of ``schema``, at any
    depth, named by its path (``jobs``, ``jobs.charges``), from one JSON or variant column.

    Every row carries ``_root_<k>`` for each root key. A child also carries ``_parent_idx``,
    the positions of its ancestors from the root down, and ``_list_idx``, its own
    position in its list (all 0-based): root key, ``_parent_idx`` and ``_list_idx`` are its key, the first
    two are its parent's. Fields become columns (structs without their arrays), a
    scalar element ``value``. Nothing is lost: ``_surplus`` holds fields that the schema does
    not know and values of another type than declared, by path, as variants; ``_n_<path>``
    tells an absent list (null) from an empty one. Nulls count as absent.
    """
    roots = [F.col(k).alias(f"_root_{k}") for k in root_keys]
    v = F.col(payload)
    if not isinstance(df.schema[payload].dataType, T.VariantType):
        v = F.try_parse_json(payload)
    none = F.array().cast("array<bigint>")
    rows = df.select(*roots, none.alias("_parent_idx"), F.lit(None).cast("bigint").alias("_list_idx"), v.alias("_v"))
    names = [f"_root_{k}" for k in root_keys]
    out: dict[str, DataFrame] = {}

    def walk(rows: DataFrame, kind: T.DataType, path: str) -> None:
        place = [] if not path else ["_parent_idx", "_list_idx"]
        v = F.col("_v")
        if not isinstance(kind, T.StructType):
            odd = F.when(F.try_variant_get(v, "$", kind.simpleString()).isNull(), v)
            out[path] = rows.select(*names, *place, F.try_variant_get(v, "$", kind.simpleString()).alias("value"), odd.alias("_surplus"))
            return
        fields = [F.try_variant_get(v, _json_path(f.name), f.dataType.simpleString()).alias(f.name) for f in _pruned(kind).fields]
        lists = _arrays(kind)
        sizes = [F.size(F.try_variant_get(v, _json_path(p), "array<variant>")) for p, _ in lists]
        counts = [F.when(n >= 0, n).alias(f"_n_{p}") for n, (p, _) in zip(sizes, lists, strict=True)]
        out[path] = rows.select(*names, *place, *fields, *counts, _surplus(v, kind).alias("_surplus"))
        own = F.when(F.col("_list_idx").isNull(), F.col("_parent_idx")).otherwise(F.concat("_parent_idx", F.array("_list_idx")))
        for p, element in lists:
            kids = rows.select(*names, own.alias("_parent_idx"), F.posexplode(F.try_variant_get(v, _json_path(p), "array<variant>")).alias("_list_idx", "_v"))
            walk(kids.withColumn("_list_idx", F.col("_list_idx").cast("bigint")), element, f"{path}.{p}" if path else p)

    walk(rows, schema, "")
    return out
