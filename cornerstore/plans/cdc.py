"""Change events to type-2 history and daily sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cornerstore.functions.messages import RESCUED
from cornerstore.operators import metrics
from cornerstore.operators.history import current_from_events, current_versions, one_event_per_sequence, scd2
from cornerstore.sinks.files import commit_snapshots, delete_path, facts_of, read_parts, stage_parts, version_of
from cornerstore.sources.streams import parquet_stream
from cornerstore.streaming.history import DELETED, KEYS, SEQUENCE
from cornerstore.streaming.jobs import (
    batch_changes, compact_log, new_batches, silver_changes, start_event_log, start_parquet,
)

CHANGES, HISTORY, SUMS, DAILY = "silver_changes", "silver_orders_history", "daily_sales_sums", "gold_daily_sales"


def ingest(
    spark: SparkSession,
    events: DataFrame,
    root: str,
    time_type: str = "timestamp",
    files_per_trigger: int | None = None,
) -> None:
    """Drain an event stream into Bronze as it came in, then Bronze into the judged log."""
    start_parquet(events, f"{root}/bronze", f"{root}/checkpoints/bronze", every=None).awaitTermination()
    bronze = parquet_stream(spark, f"{root}/bronze", events.schema, files_per_trigger)
    start_event_log(bronze, f"{root}/events", f"{root}/checkpoints/events", time_type).awaitTermination()


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/bronze")


def current_orders(spark: SparkSession, root: str, tie_break: Sequence[Column] = ()) -> DataFrame:
    return current_from_events(
        silver_changes(spark, f"{root}/events"), KEYS, SEQUENCE, DELETED,
        except_columns=["operation", RESCUED], tie_break=tie_break,
    )


def publish(
    spark: SparkSession,
    root: str,
    publication_id: str,
    tie_break: Sequence[Column] = (),
    buckets: int = 16,
    bucket_by: Column | None = None,
    slice_by: Column | None = None,
) -> bool:
    """Bring history and daily sales up to the log and make both current together; False if nothing is new.

    Only batches that the last publication has not used are read. Their events are
    added to the stored events of the key buckets they touch, and the history of
    these buckets is made anew. Orders whose open version has changed leave their old
    day, store and category and enter the new ones, so of the daily sales only the
    touched months are read and written. Late events may come in any order. All of it becomes
    current by one commit, which also says what of the log is used up; a publication that broke off
    before it is repeated under its id.

    Key buckets are a hash of the order, or ``bucket_by``, which must never change for a
    key. ``slice_by`` cuts the events of a hot key as in ``scd2``.
    """
    published = f"{root}/published"
    used = facts_of(spark, published).get("log", {})
    folders, now = new_batches(spark, f"{root}/events", used)
    if not folders:
        return False
    seen = {name: version_of(spark, published, name) for name in (CHANGES, HISTORY, SUMS, DAILY)}
    changes = batch_changes(spark, folders)
    parts: dict[str, dict[str, str | None]] = {}
    if changes is not None:
        hashed = F.pmod(F.xxhash64(*KEYS), F.lit(buckets))
        bucket = (hashed if bucket_by is None else bucket_by).cast("int")
        arrived = f"{published}/_incoming-{publication_id}"
        changes.withColumn("_part", bucket).write.mode("overwrite").parquet(f"{arrived}/changes")
        events = spark.read.parquet(f"{arrived}/changes")
        # One small integer per touched bucket comes back to the driver.
        touched = [row[0] for row in events.select("_part").distinct().collect()]
        before = None
        if seen[HISTORY] is not None:
            events = read_parts(spark, published, CHANGES, touched).withColumn("_part", bucket).unionByName(events)
            before = read_parts(spark, published, HISTORY, touched)

        def staged(name: str, rows: DataFrame, of: Sequence[int]) -> DataFrame:
            parts[name] = stage_parts(rows, published, name, publication_id, of)
            paths = [path for path in parts[name].values() if path]
            return spark.read.parquet(*paths) if paths else rows.drop("_part").filter("false")

        by_content = F.xxhash64(*sorted(set(changes.columns) - {"_ingested_at", "_source_file"}))
        events = one_event_per_sequence(events, KEYS, SEQUENCE, [*tie_break, by_content])
        kept = staged(CHANGES, events, touched).withColumn("_part", bucket)
        versions = scd2(kept, KEYS, SEQUENCE, DELETED, ["operation", RESCUED], slice_by)
        after = staged(HISTORY, versions, touched)

        opened = before if before is None else current_versions(before)
        month = F.coalesce(F.year("order_date") * 12 + F.month("order_date"), F.lit(-1)).cast("int")
        moved = metrics.signed_store_sales(opened, current_versions(after)).withColumn("_part", month)
        moved.write.mode("overwrite").parquet(f"{arrived}/daily")
        moved = spark.read.parquet(f"{arrived}/daily")
        # One small integer per touched month.
        months = [row[0] for row in moved.select("_part").distinct().collect()]
        there = None if seen[SUMS] is None else read_parts(spark, published, SUMS, months)
        sums = metrics.add_sums(there, moved.drop("_part"), metrics.STORE_KEYS).withColumn("_part", month)
        sums = staged(SUMS, sums, months).withColumn("_part", month)
        staged(DAILY, metrics.store_sales_of(sums).withColumn("_part", month), months)
    commit_snapshots(spark, published, publication_id, {}, parts=parts, based_on=seen, facts={"log": now})
    if changes is not None:
        delete_path(spark, arrived)
    return True


def compact(spark: SparkSession, root: str, publication_id: str) -> bool:
    """Compact what the last publication has used of the event log."""
    used = facts_of(spark, f"{root}/published").get("log", {})
    return compact_log(spark, f"{root}/events", publication_id, used)
