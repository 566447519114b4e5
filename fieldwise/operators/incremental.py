"""Latest-by-source kept as a table and folded forward.

The newest row of each (key, source) is a mergeable state: the newest of two states is
the newest of both histories. So the table holds one row a key and source, in buckets
of the key, and a new generation of observations is collapsed by itself, merged with
the rows of the keys it has, and written into the buckets whose rows changed. The
history is never read again. Resolution (R2) reads the table as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .partitioned import bucket_of, in_partitions, read_partitioned, upsert_partitions
from .resolve import OBSERVED_AT, PRIORITY, SOURCE, latest_by_source

BUCKETS = 256
BUCKET = "key_bucket"


def fold_latest(
    spark: SparkSession,
    path: str,
    generation: DataFrame,
    keys: Sequence[str],
    source: str = SOURCE,
    observed_at: str = OBSERVED_AT,
    priority: str | None = PRIORITY,
    tiebreak: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> int:
    """Fold one generation of observations into the state at ``path``; returns the number of
    buckets rewritten. Folding a generation again, or one that is older than what the state
    holds, changes nothing. The state after n folds is ``latest_by_source`` of all of them
    (with a ``tiebreak`` that tells rows of equal time apart)."""
    how = {"source": source, "observed_at": observed_at, "priority": priority, "tiebreak": tiebreak}
    newest = latest_by_source(generation, keys, **how).withColumn(BUCKET, bucket_of(keys, buckets))
    held = read_partitioned(spark, path, newest.schema)
    there = in_partitions(held, newest.select(BUCKET).distinct(), [BUCKET])
    mine = there.join(newest.select(*keys, source), [*keys, source], "left_semi").select(*newest.columns)
    merged = latest_by_source(newest.unionByName(mine).drop(BUCKET), keys, **how).withColumn(BUCKET, bucket_of(keys, buckets))
    return upsert_partitions(spark, path, merged.select(*newest.columns), [*keys, source], [BUCKET])


def latest_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The state's rows, one a key and source, with the columns of the observations (``schema``)."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return read_partitioned(spark, path, whole).drop(BUCKET)
