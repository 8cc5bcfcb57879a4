"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cornerstore.contracts import SILVER_COLUMNS, SILVER_VERSION


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total within a key.

    Spark applies the limit of one row per key before the shuffle as well
    (WindowGroupLimit), so a hot key sends at most one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_silver(df: DataFrame) -> DataFrame:
    """Newest version per order: version time, then ingest time, then batch id.

    A source without a unique order id may repeat one at the same time in the
    same batch; content decides then, so a rerun picks the same row.
    """
    return latest_per_key(
        df.select(*SILVER_COLUMNS),
        ["order_id"],
        [
            *(F.desc(name) for name in SILVER_VERSION),
            *(F.desc(c) for c in ("total_amount", "product", "category", "customer_name", "city", "price", "quantity")),
        ],
    )


def latest_by_order(df: DataFrame, *tie_break: Column, within: Sequence[str] = ()) -> DataFrame:
    """Newest ``updated_at`` per order; the caller says how equal times are ordered.

    ``within`` names columns that follow from the order, such as the part of a table; rows
    that are dealt by them need no further shuffle.
    """
    return latest_per_key(df, [*within, "order_id"], [F.desc("updated_at"), *tie_break])
