"""Type-2 history kept up to date by a stream: only key buckets that a batch touches are computed again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cornerstore.functions.messages import RESCUED
from cornerstore.operators.history import END, START, one_event_per_sequence, scd2
from cornerstore.sinks.files import delete_path, move_buckets, path_exists, read_buckets, staged_whole
from cornerstore.streaming.jobs import CHANGE, sort_events, start_batches

KEYS, SEQUENCE, DELETED = ["order_id"], "updated_at", "operation = 'DELETE'"


def update_history(
    changes: DataFrame,
    root: str,
    transaction: str,
    buckets: int = 64,
    tie_break: Sequence[Column] = (),
    bucket_by: Column | None = None,
    slice_by: Column | None = None,
) -> None:
    """Add changes, in whatever order they come, to the stored ones and renew the touched buckets' history.

    ``changes`` and ``history`` below ``root`` are spread over the same key buckets
    (a hash of the key, or ``bucket_by``). Copies of one (key, sequence) are one
    event, the first by ``tie_break`` or else by content, so a replayed batch changes
    nothing. New content of both is staged whole before either is moved in, and what
    a transaction has staged whole is never computed again: a run that breaks off
    anywhere is finished by the next one. There must be one writer at a time.
    """
    spark = changes.sparkSession
    finish_updates(spark, root, but=transaction)
    if transaction not in staged_whole(spark, f"{root}/history"):
        hashed = F.pmod(F.xxhash64(*KEYS), F.lit(buckets))
        rows = changes.withColumn("_bucket", (hashed if bucket_by is None else bucket_by).cast("int"))
        arrived = f"{root}/staged/{transaction}"
        rows.write.mode("overwrite").parquet(arrived)
        new = spark.read.schema(rows.schema).parquet(arrived)
        # One small integer per touched bucket comes back to the driver.
        touched = [row[0] for row in new.select("_bucket").distinct().collect()]
        if touched:
            if path_exists(spark, f"{root}/changes/state"):
                stored = spark.read.schema(rows.schema).parquet(f"{root}/changes/state")
                new = stored.filter(F.col("_bucket").isin(touched)).unionByName(new)
            by_content = [F.xxhash64(*sorted(set(changes.columns) - {"_ingested_at", "_source_file"}))]
            events = one_event_per_sequence(new, KEYS, SEQUENCE, [*tie_break, *by_content])
            kept = _stage(events, f"{root}/changes", transaction)
            versions = scd2(kept, KEYS, SEQUENCE, DELETED, ["operation", RESCUED], slice_by)
            _stage(versions, f"{root}/history", transaction)
    _move_both(spark, root, transaction)


def _move_both(spark: SparkSession, root: str, transaction: str) -> None:
    """Changes go first: while the history is still staged whole, the set counts as unfinished."""
    move_buckets(spark, f"{root}/changes", transaction)
    move_buckets(spark, f"{root}/history", transaction)
    delete_path(spark, f"{root}/staged/{transaction}")


def finish_updates(spark: SparkSession, root: str, but: str = "") -> None:
    """Move in what other transactions have staged whole.

    Changes that were staged without their history belong to a batch that has
    touched nothing yet; its replay stages them again.
    """
    for transaction in staged_whole(spark, f"{root}/history"):
        if transaction != but:
            _move_both(spark, root, transaction)


def _stage(rows: DataFrame, root: str, transaction: str) -> DataFrame:
    path = f"{root}/staged/{transaction}/merged"
    rows.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def start_history(
    events: DataFrame,
    root: str,
    checkpoint: str,
    tie_break: Sequence[Column] = (),
    time_type: str = "timestamp",
    buckets: int = 64,
    bucket_by: Column | None = None,
    slice_by: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the history of valid changes of an event stream, micro-batch by micro-batch."""

    def handle(batch: DataFrame, transaction: str) -> None:
        judged = sort_events(batch, time_type).filter(F.col("_disposition") == CHANGE)
        changes = judged.drop("is_valid", "quality_reason", "_disposition")
        update_history(changes, root, transaction, buckets, tie_break, bucket_by, slice_by)

    return start_batches(events, handle, checkpoint, every)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All versions with [__START_AT, __END_AT)."""
    stored = spark.read.parquet(f"{root}/changes/state").schema
    kept = [f for f in stored.fields if f.name not in ("operation", RESCUED, "_bucket")]
    at = stored[SEQUENCE].dataType
    columns = T.StructType([*kept, T.StructField(END, at), T.StructField(START, at)])
    return read_buckets(spark, f"{root}/history", columns)
