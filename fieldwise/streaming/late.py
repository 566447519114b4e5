"""Late rows as a second output.

Spark's stateful operators drop rows behind the watermark. Here the drain keeps the
watermark itself, one row a batch, and deals its rows: those on time go to ``on_time``
and, counted, into open windows; those behind the watermark go to ``late``. Every row
is in one of the two, so on time + late = input. A window is closed once the watermark
has passed its end; late rows make revisions of closed windows, and sessions of the
resources that they touch are built again from the landed rows.

All tables are Parquet, a partition a batch id: a replayed batch replaces its own part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.events import debounce, event_rate
from ..operators.partitioned import read_partitioned
from ..session import written_once
from ..sources import files

BATCH = "batch_id"


class LateAwareDrain:
    """A ``foreachBatch`` sink that deals rows by the watermark and counts windows by ``by``."""

    def __init__(self, base: str, schema: T.StructType, lateness: str, width: str, by: Sequence[str], ts: str = "received_at") -> None:
        self.base, self.schema, self.lateness, self.width, self.by, self.ts = base.rstrip("/"), schema, lateness, width, list(by), ts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        passed = self.watermark(spark, batch_id)
        rows = written_once(batch.select(*self.schema.fieldNames()))
        behind = F.coalesce(F.col(self.ts) <= F.lit(passed).cast("timestamp"), F.lit(False))  # rows without a time are on time
        on_time = rows.filter(~behind)
        self._put(on_time, "on_time", batch_id)
        self._put(rows.filter(behind), "late", batch_id)
        self._put(event_rate(on_time.filter(F.col(self.ts).isNotNull()), self.ts, self.width, self.by), "counts", batch_id)
        newest = rows.agg(F.max(self.ts).alias("newest")).select((F.col("newest") - F.expr(f"INTERVAL {self.lateness}")).alias("at"))
        self._put(newest.select(F.greatest("at", F.lit(passed).cast("timestamp")).alias("at")), "watermark", batch_id)

    def _put(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.base}/{name}/{BATCH}={batch_id}")

    def _table(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        return read_partitioned(spark, f"{self.base}/{name}", T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))

    def watermark(self, spark: SparkSession, before: int | None = None):
        """The watermark after the batches before ``before`` (all, if None); one value."""
        done = [int(x.split("=")[1]) for x in files.folders(spark, f"{self.base}/watermark")]
        last = max((n for n in done if before is None or n < before), default=None)
        return None if last is None else spark.read.parquet(f"{self.base}/watermark/{BATCH}={last}").first().at

    def rows(self, spark: SparkSession, name: str) -> DataFrame:
        """The rows ``on_time`` or ``late``."""
        return self._table(spark, name, self.schema).drop(BATCH)

    def _counts(self, spark: SparkSession) -> DataFrame:
        counted = T.StructType([*[self.schema[c] for c in self.by], *T.StructType.fromDDL("window_start timestamp, window_end timestamp, n_events bigint").fields])
        return self._table(spark, "counts", counted).drop(BATCH)

    def windows(self, spark: SparkSession) -> DataFrame:
        """(by ..., window_start, window_end, n_on_time, n_late, n_events, closed): every window with its revision."""
        on_time = self._counts(spark).withColumn("late", F.lit(0).cast("bigint"))
        late = event_rate(self.rows(spark, "late"), self.ts, self.width, self.by).withColumn("late", F.col("n_events")).withColumn("n_events", F.lit(0).cast("bigint"))
        sums = on_time.unionByName(late).groupBy(*self.by, "window_start", "window_end").agg(F.sum("n_events").alias("n_on_time"), F.sum("late").alias("n_late"))
        closed = F.coalesce(F.col("window_end") <= F.lit(self.watermark(spark)).cast("timestamp"), F.lit(False))
        return sums.withColumn("n_events", F.col("n_on_time") + F.col("n_late")).withColumn("closed", closed)

    def revised_sessions(self, spark: SparkSession, keys: Sequence[str], gap_seconds: float, tiebreak: Sequence[str] = ()) -> DataFrame:
        """The sessions, over all landed rows with a time, of the resources that have late rows."""
        touched = self.rows(spark, "late").select(*keys).distinct()
        landed = self.rows(spark, "on_time").unionByName(self.rows(spark, "late")).filter(F.col(self.ts).isNotNull())
        return debounce(landed.join(touched, list(keys), "left_semi"), keys, self.ts, gap_seconds, tiebreak)
