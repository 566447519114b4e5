"""Publishing a table without a gap.

A build's contract is checked, it is written to a version folder of its own, and only
then one small file, ``_current``, is replaced in one step to name it. Readers resolve that name once and so read one version, whole, while later
builds run; a build that fails leaves the name, and so the table, as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.quality import contract_diff, is_breaking
from ..sources import files

POINTER = "_current"


class ContractError(RuntimeError):
    """A published model changed incompatibly; it needs a new ``_vN`` name."""


def publish(
    df: DataFrame,
    base: str,
    partition_by: Sequence[str] = (),
    contract: T.StructType | None = None,
    additive: bool = True,
) -> DataFrame:
    """Write ``df`` as the next version of the table at ``base`` and make it the current one.

    Without a ``contract`` the published version's columns are it, unless ``additive``
    is off: removing or retyping one is refused (additions pass), before anything is
    written. Returns the new version, read back.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    held = _pointer(spark, base)
    agreed = contract or (T.StructType.fromJson(held["schema"]) if held and additive else None)
    if agreed is not None:
        diff = contract_diff(agreed, df.schema)
        if is_breaking(diff):
            raise ContractError(f"{base.rsplit('/', 1)[-1]}: {diff}")
    version = (held["version"] if held else 0) + 1
    folder = f"v={version}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{base}/{folder}")
    files.replace_text(spark, f"{base}/{POINTER}", json.dumps({"version": version, "folder": folder, "schema": df.schema.jsonValue()}))
    return current(spark, base)


def _pointer(spark: SparkSession, base: str) -> dict | None:
    text = files.read_text(spark, f"{base.rstrip('/')}/{POINTER}")
    return json.loads(text) if text else None


def current(spark: SparkSession, base: str) -> DataFrame:
    """The version that is current now; the DataFrame stays on it whatever is published later."""
    held = _pointer(spark, base)
    if held is None:
        raise FileNotFoundError(f"nothing is published at {base}")
    # the written schema: partition discovery would infer a long key as int
    return spark.read.schema(T.StructType.fromJson(held["schema"])).parquet(f"{base.rstrip('/')}/{held['folder']}")


def current_version(spark: SparkSession, base: str) -> int:
    """The number of the current version, 0 before the first."""
    held = _pointer(spark, base)
    return held["version"] if held else 0


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove versions, but for the current one and those of the ``keep - 1`` numbers before it,
    and what failed builds left; returns the folders removed. Run it when no build runs and
    no reader is older than the versions kept."""
    held = _pointer(spark, base)
    gone = []
    for folder in files.folders(spark, base):
        if folder.startswith("v=") and held and folder != held["folder"]:
            number = int(folder[2:].split("-")[0])
            if number >= held["version"] or number <= held["version"] - keep:
                files.remove(spark, f"{base.rstrip('/')}/{folder}")
                gone.append(folder)
    return gone
