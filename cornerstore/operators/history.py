"""Current-state dimensions, type-2 history, check snapshots, change stamps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from cornerstore.operators.latest import latest_per_key
from cornerstore.operators.merge import fits_broadcast

START, END = "__START_AT", "__END_AT"


def one_event_per_sequence(
    events: DataFrame, keys: Sequence[str], sequence: str, tie_break: Sequence[Column]
) -> DataFrame:
    return latest_per_key(events, [*keys, sequence], tie_break)


def scd2(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    deletes: str,
    except_columns: Sequence[str] = (),
    slice_by: Column | None = None,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Versions with [__START_AT, __END_AT) from change events in any order.

    A version ends where the key's next event starts; a delete ends the open
    version and opens none. ``slice_by`` must grow with ``sequence`` (default:
    its day). It splits a key's events over many tasks, so one hot key is not
    sorted in one task. A slice sees the start of the key's next slice through
    one marker row. Without ``slice_by``, events small enough to broadcast are not
    sliced. With
    ``tie_break`` events that repeat a (key, sequence) are first reduced to one;
    without it the pairs must be unique.
    """
    dropped = [name for name in except_columns if name in events.columns]
    if slice_by is None and fits_broadcast(events):
        if tie_break:
            events = one_event_per_sequence(events, keys, sequence, tie_break)
        in_key = Window.partitionBy(*keys).orderBy(sequence)
        return (
            events.withColumn(END, F.lead(sequence).over(in_key))
            .filter(~F.coalesce(F.expr(deletes), F.lit(False)))
            .withColumn(START, F.col(sequence))
            .drop(*dropped)
        )
    slice_of = F.date_trunc("day", F.col(sequence)) if slice_by is None else slice_by
    # Starts need no deduplicated events: copies share their sequence.
    starts = events.groupBy(*keys, slice_of.alias("_slice")).agg(F.min(sequence).alias("_first"))
    next_start = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slice"))
    markers = (
        starts.select(*keys, "_slice", next_start.alias(sequence))
        .filter(F.col(sequence).isNotNull())
        .withColumn("_marker", F.lit(True))
    )

    if tie_break:
        events = one_event_per_sequence(events, keys, sequence, tie_break)
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(sequence)
    return (
        events.withColumn("_slice", slice_of)
        .withColumn("_marker", F.lit(False))
        .unionByName(markers, allowMissingColumns=True)
        .withColumn(END, F.lead(sequence).over(in_slice))
        .filter(~F.col("_marker") & ~F.coalesce(F.expr(deletes), F.lit(False)))
        .withColumn(START, F.col(sequence))
        .drop("_marker", "_slice", *dropped)
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def current_from_events(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    deletes: str,
    except_columns: Sequence[str] = (),
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """The open versions alone: last event per key unless it is a delete.

    Needs no history and at most one row per key and input task in the shuffle.
    """
    last = latest_per_key(events, keys, [F.desc(sequence), *tie_break])
    dropped = [name for name in except_columns if name in events.columns]
    return (
        last.filter(~F.coalesce(F.expr(deletes), F.lit(False)))
        .withColumn(END, F.lit(None).cast(events.schema[sequence].dataType))
        .withColumn(START, F.col(sequence))
        .drop(*dropped)
    )


def stage_current_orders(history: DataFrame, time_type: str = "timestamp") -> DataFrame:
    """One open, validated row per order, as the models read it."""
    return current_versions(history).select(
        "order_id",
        "customer_id",
        "customer_name",
        F.lower("customer_email").alias("customer_email"),
        "product_id",
        "product_name",
        "category",
        "store_id",
        F.col("order_timestamp").cast(time_type).alias("order_timestamp"),
        F.col("order_timestamp").cast("date").alias("order_date"),
        "quantity",
        "unit_price",
        "total_amount",
        "updated_at",
    )


def _latest_fields(fields: Sequence[str], order: Sequence[str]) -> Column:
    """All fields of the newest row in one aggregate; rows without a time do not count."""
    row = F.struct(*order, *(F.col(name).alias(f"_{name}") for name in fields))
    return F.max(F.when(F.col(order[0]).isNotNull(), row))


def dim_customer(orders: DataFrame) -> DataFrame:
    """Customers with their latest name and mail, first and latest order."""
    return (
        orders.groupBy("customer_id")
        .agg(
            _latest_fields(["customer_name", "customer_email"], ["updated_at", "order_id"]).alias("_last"),
            F.min("order_timestamp").alias("first_order_at"),
            F.max("order_timestamp").alias("latest_order_at"),
        )
        .select(
            "customer_id",
            F.col("_last._customer_name").alias("customer_name"),
            F.col("_last._customer_email").alias("customer_email"),
            "first_order_at",
            "latest_order_at",
        )
    )


def dim_product(orders: DataFrame) -> DataFrame:
    """Products with their latest name and category."""
    return (
        orders.groupBy("product_id")
        .agg(
            _latest_fields(["product_name", "category"], ["updated_at", "order_id"]).alias("_last"),
            F.max("updated_at").alias("last_updated_at"),
        )
        .select(
            "product_id",
            F.col("_last._product_name").alias("product_name"),
            F.col("_last._category").alias("category"),
            "last_updated_at",
        )
    )


def _unchanged(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def start_check_snapshot(current: DataFrame, now: Column) -> DataFrame:
    """The first snapshot: every row is an open version."""
    kind = current.select(now.alias("t")).schema["t"].dataType
    return current.withColumn("valid_from", now).withColumn("valid_to", F.lit(None).cast(kind))


def check_snapshot(
    snapshot: DataFrame, current: DataFrame, key: str, checked: Sequence[str], now: Column
) -> DataFrame:
    """Type-2 snapshot step: a changed checked column closes the open version and adds one.

    Closed versions pass through unjoined. Keys missing from ``current`` stay open.
    """
    closed = snapshot.filter("valid_to IS NOT NULL")
    opened = snapshot.filter("valid_to IS NULL")
    state = current.select(F.col(key).alias("_key"), F.struct(*checked).alias("_now"))
    same = _unchanged("_was", "_now", checked)
    compared = opened.withColumn("_was", F.struct(*checked)).join(
        state, F.col(key) == F.col("_key"), "left"
    )
    changed = F.col("_key").isNotNull() & ~same
    kept = compared.withColumn("valid_to", F.when(changed, now).otherwise(F.col("valid_to"))).select(
        *snapshot.columns
    )
    fresh = start_check_snapshot(changed_rows(snapshot, current, key, checked), now)
    return closed.unionByName(kept).unionByName(fresh)


def changed_rows(snapshot: DataFrame, current: DataFrame, key: str, checked: Sequence[str]) -> DataFrame:
    """Rows of ``current`` that no open version has with the same checked columns: new keys and changed ones.

    Only the key, the checked columns and the end of the versions are read of the snapshot.
    """
    opened = snapshot.filter("valid_to IS NULL")
    before = opened.select(F.col(key).alias("_key"), F.struct(*checked).alias("_was"))
    same = _unchanged("_was", "_now", checked)
    return (
        current.withColumn("_now", F.struct(*checked))
        .join(before, (F.col(key) == F.col("_key")) & same, "left_anti")
        .drop("_now")
    )


def stamp_changes(
    before: DataFrame, after: DataFrame, key: str, compared: Sequence[str], now: Column,
    stamp: str = "updated_at",
) -> DataFrame:
    """Set ``stamp`` to ``now`` on rows that really changed; unchanged rows keep theirs.

    New rows keep a stamp they bring; missing stamps are filled with ``now``.
    """
    old = before.select(F.col(key).alias("_key"), F.struct(*compared).alias("_was"), F.col(stamp).alias("_old"))
    joined = after.withColumn("_now", F.struct(*compared)).join(old, F.col(key) == F.col("_key"), "left")
    stamped = (
        F.when(F.col("_key").isNull(), F.coalesce(F.col(stamp), now))
        .when(_unchanged("_was", "_now", compared), F.coalesce(F.col("_old"), now))
        .otherwise(now)
    )
    return joined.withColumn(stamp, stamped).select(*after.columns)


def backfill_stamp(df: DataFrame, now: Column, stamp: str = "updated_at") -> DataFrame:
    return df.withColumn(stamp, F.coalesce(F.col(stamp), now))
