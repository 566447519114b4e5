"""The event feed as Structured Streaming.

The warehouse has no stream processor - it has an append-only webhook log,
five-minute drains and ordering rules. Here the log is a file stream (JSON
or Parquet, explicit schema), every operator is a streaming DataFrame
transformation, and sinks are ``foreachBatch`` writers that are idempotent
per batch id (a replayed micro-batch overwrites its own output folder), so a
lost executor or a restarted query never duplicates rows.

State lives under the session's ``spark.checkpoint.dir`` (shared storage on
a cluster), never in a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.events import ENRICH_TYPES, MAX_ATTEMPTS, delivery_hash
from ..session import checkpoint_dir, ensure_semantics
from .stateful import buckets_for as buckets_for, dedupe_stream as dedupe_stream  # keyed state; here for the feed's users

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("source_instance_id", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("resource_id", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("process_attempts", T.IntegerType()),
        T.StructField("last_error", T.StringType()),
    ]
)


def stream_location(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of one streaming query, under the shared checkpoint dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENT_SCHEMA,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The event log as a stream; ``received_at`` is the observation time.

    Naive timestamps are cast to instants (watermarks need ``timestamp``, T19).
    """
    ensure_semantics(spark)
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def with_hash(df: DataFrame, parts: Sequence[str] = ("event_type", "resource_id", "payload")) -> DataFrame:
    """The replay key of each delivery."""
    return df.withColumn("dedupe_hash", delivery_hash(*parts))


def debounce_stream(
    df: DataFrame, keys: Sequence[str], gap: str = "5 minutes", ts: str = "received_at", watermark: str = "10 minutes"
) -> DataFrame:
    """Events of one resource closer than ``gap`` become one unit of work.

    A session is emitted (append mode) once the watermark passes its end.
    """
    return (
        df.withWatermark(ts, watermark)
        .groupBy(*keys, F.session_window(ts, gap).alias("s"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))
        .select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events", "first_at", "last_at")
    )


def event_rate_stream(
    df: DataFrame, width: str = "25 minutes", by: Sequence[str] = ("event_type",), ts: str = "received_at", watermark: str = "1 hour"
) -> DataFrame:
    """Tumbling counts per type, windows aligned to the epoch."""
    return (
        df.withWatermark(ts, watermark)
        .groupBy(F.window(ts, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events")
    )


# ----------------------------------------------------------------- E5 ledger
def status_ledger_stream(df: DataFrame, key_col: str = "resource_id", ts: str = "received_at") -> DataFrame:
    """E5: newest status per key; late and replayed events never regress it.

    ``df`` must carry ``status_code`` (int) and ``event_id``. A plain stateful
    aggregation (one struct a key, kept in the JVM); the output (update mode)
    is the newest status of each key that the micro-batch touched - equal to
    batch R11 once all events are processed.
    """
    newest = F.max(F.struct(F.col(ts).alias("observed_at"), "event_id", "status_code")).alias("_s")
    best = df.groupBy(F.col(key_col).cast("string").alias("key")).agg(newest)
    return best.select("key", "_s.observed_at", "_s.event_id", "_s.status_code")


# ------------------------------------------------------------- E4 E6 sinks
def batch_writer(out_dir: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that is idempotent per batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    return write


def drain_writer(
    out_dir: str,
    allowlist: Sequence[str] = ENRICH_TYPES,
    max_attempts: int = MAX_ATTEMPTS,
    type_col: str = "event_type",
) -> Callable[[DataFrame, int], None]:
    """E4 + E6 + W5 in one micro-batch: route allowlisted events to the
    enrichment queue (distinct resources), the rest to processed; events that
    failed ``max_attempts`` times go to the dead-letter table (unique on
    id and error). Each output is overwritten per batch id (replay-safe)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        attempts = F.coalesce(F.col("process_attempts"), F.lit(0))
        dead = batch.filter(attempts >= max_attempts)
        live = batch.filter(attempts < max_attempts)
        enrich = live.filter(F.col(type_col).isin(list(allowlist)))
        queue = enrich.groupBy("source_instance_id", "resource_id").agg(
            F.min("received_at").alias("first_at"), F.count(F.lit(1)).alias("n_events")
        )
        processed = live.filter(~F.col(type_col).isin(list(allowlist))).select("event_id", "event_type", "received_at")
        letters = dead.select("event_id", "process_attempts", F.col("last_error").alias("error")).dropDuplicates(
            ["event_id", "error"]
        )
        batch.persist()  # three outputs from one read of the micro-batch
        try:
            for name, part in (("enrich_queue", queue), ("processed", processed), ("dead_letter", letters)):
                part.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def run_available(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None], mode: str = "append"):
    """Run a streaming query over everything available now, then stop (E9 backfill)."""
    spark = df.sparkSession
    q = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", stream_location(spark, name))
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
