"""MERGE semantics as joins and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cornerstore.contracts import SILVER_COLUMNS, SILVER_VERSION
from cornerstore.operators.latest import latest_silver


def merge_newer(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Insert new keys; replace a matched row where source version >= target version.

    Both sides hold one row per key. A source batch that Spark would broadcast is
    merged by anti-joins, which leave the target unshuffled; a larger one by a full
    outer join, which shuffles the target once. A NULL version on either side keeps
    the target row, as MERGE does. Several version columns are compared from left to
    right.
    """
    own = F.col(version[0]) if len(version) == 1 else F.struct(*version)
    if not fits_broadcast(source):
        return _merge_outer(target, source, keys, own)
    renamed_keys = [F.col(k).alias(f"_{k}") for k in keys]
    same = _same_key(keys)
    incoming = source.select(*renamed_keys, own.alias("_incoming"))
    kept = target.join(incoming, same & (F.col("_incoming") >= own), "left_anti")
    stored = target.join(incoming.drop("_incoming"), same, "left_semi").select(
        *renamed_keys, own.alias("_stored")
    )
    refused = same & ~F.coalesce(own >= F.col("_stored"), F.lit(False))
    accepted = source.join(stored, refused, "left_anti")
    return kept.unionByName(accepted)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of the size is within the broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate; of rows read from files, their bytes as far as their columns are read."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _merge_outer(target: DataFrame, source: DataFrame, keys: Sequence[str], version: Column) -> DataFrame:
    both, newer = _outer(target, source, keys, version)
    return both.select(F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")).select("row.*")


def merge_newer_marked(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Sequence[str], came: str,
    from_target: Sequence[str] = (),
) -> DataFrame:
    """``merge_newer`` by one full outer join, with column ``came`` true for keys that the source has.

    Columns in ``from_target`` keep the target's values, whichever row wins.
    """
    own = F.col(version[0]) if len(version) == 1 else F.struct(*version)
    both, newer = _outer(target, source, keys, own)
    kept = [F.col(f"old.{c}").alias(c) for c in from_target]
    row = F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")
    columns = [F.col(f"row.{c}") for c in target.columns if c not in from_target]
    return both.select(row, F.col("new").isNotNull().alias(came), *kept).select(*columns, came, *from_target)


def _outer(target: DataFrame, source: DataFrame, keys: Sequence[str], version: Column) -> tuple[DataFrame, Column]:
    """Target rows ``old`` and source rows ``new`` side by side, and where the new one is to stand."""
    columns = target.columns

    def side(df: DataFrame, name: str) -> DataFrame:
        whole = F.struct(*(F.col(c) for c in columns))
        return df.select(*(F.col(k).alias(f"_{name}_{k}") for k in keys), version.alias(f"_{name}_at"), whole.alias(name))

    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"_old_{key}") == F.col(f"_new_{key}"))
    both = side(target, "old").join(side(source, "new"), same, "full_outer")
    newer = F.col("old").isNull() | (F.col("new").isNotNull() & F.coalesce(F.col("_new_at") >= F.col("_old_at"), F.lit(False)))
    return both, newer


def merge_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys, replace every matched row."""
    incoming = source.select(*(F.col(k).alias(f"_{k}") for k in keys))
    return target.join(incoming, _same_key(keys), "left_anti").unionByName(source)


def newer_than_target(source: DataFrame, target: DataFrame, version: str = "updated_at") -> DataFrame:
    """Source rows past the target's greatest version; all rows if the target is empty."""
    kind = source.schema[version].dataType.simpleString()
    floor = target.agg(
        F.coalesce(F.max(version), F.expr(f"CAST('1900-01-01' AS {kind})"))
    ).scalar()
    return source.where(F.col(version) > floor)


def merge_incremental(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: str = "updated_at"
) -> DataFrame:
    """Incremental model step: late rows are skipped, the others replace or insert."""
    return merge_replace(target, newer_than_target(source, target, version), keys)


def merge_snapshot(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Silver snapshot after a batch: latest version per order over both.

    Only the batch is deduplicated; the snapshot already has one row per order.
    """
    return merge_newer(
        snapshot.select(*SILVER_COLUMNS),
        latest_silver(batch),
        ["order_id"],
        SILVER_VERSION,
    )


def _same_key(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]) == F.col(f"_{keys[0]}")
    for key in keys[1:]:
        condition = condition & (F.col(key) == F.col(f"_{key}"))
    return condition
