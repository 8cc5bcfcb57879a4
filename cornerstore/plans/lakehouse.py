"""One-shot incremental run: Bronze append, quarantine, MERGE into Silver, daily Gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cornerstore.contracts import LAKE_COLUMNS
from cornerstore.operators import checks
from cornerstore.operators.clean import classify_lake_rows
from cornerstore.operators.latest import latest_by_order
from cornerstore.operators.metrics import daily_category_sales
from cornerstore.operators.watermark import after_watermark, commit_watermark, load_watermark, watermark_of
from cornerstore.plans.medallion import NO_CHANGES, batch_id_after
from cornerstore.sinks.files import (
    append_if_any, commit_snapshots, drop_staged, path_exists, read_buckets, stage_snapshots, upsert_buckets,
)
from cornerstore.schemas import schema
from cornerstore.sources.files import require_columns


def extract(spark: SparkSession, source: DataFrame, root: str) -> tuple[str, DataFrame | None]:
    """The batch id that follows from the watermark, and the batch as Bronze holds it; None if there is none.

    A Bronze batch that a broken-off run has written to its end is taken up as it
    is: rows that the source gained meanwhile belong to the next batch, because the
    watermark is taken from this one.
    """
    watermark = load_watermark(spark, f"{root}/control/watermarks")
    batch_id = batch_id_after(watermark)
    path = f"{root}/bronze/batch_id={batch_id}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        rows = after_watermark(require_columns(source, LAKE_COLUMNS), watermark)
        if not append_if_any(rows.withColumn("ingested_at", F.current_timestamp()), path):
            return batch_id, None
    return batch_id, spark.read.parquet(path)


def run(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    tie_break: tuple[Column, ...] = (),
    buckets: int = 64,
    time_type: str = "timestamp",
    bucket_by: Column | None = None,
) -> dict[str, object]:
    """Process what follows the watermark and return counts, as one result row.

    A run that broke off anywhere is finished by the next one, with the rows it had
    extracted. ``bucket_by`` may give ranges of a growing order id, so that a batch of
    recent orders rewrites few of Silver's buckets.
    """
    batch_id, bronze = extract(spark, source, root)
    if bronze is None:
        return {"batch_id": batch_id, "extracted": 0, "status": NO_CHANGES}
    valid, rejected = classify_lake_rows(bronze, time_type)
    quarantine = f"{root}/quarantine/batch_id={batch_id}"
    rejected.write.mode("overwrite").parquet(quarantine)
    counts = {
        "extracted": bronze.count(), "valid": valid.count(), "rejected": spark.read.parquet(quarantine).count(),
    }
    if counts["valid"] + counts["rejected"] != counts["extracted"]:
        raise checks.QualityError(f"Bronze is not valid rows plus stored quarantine: {counts}")

    latest = latest_by_order(valid, *tie_break)
    upsert_buckets(latest, f"{root}/silver", ["order_id"], batch_id, buckets, ["updated_at"], bucket_by)
    silver = read_silver(spark, root, time_type)

    broken = F.expr("quantity <= 0 OR price < 0 OR order_id IS NULL")
    gate = checks.stored_lines(silver, valid, "updated_at", broken).withColumn("passed", F.col("failures") == 0)
    checks.require_passed(gate)

    attempt = 0
    while path_exists(spark, f"{root}/gold/daily_category_sales/v={batch_id}-{attempt}"):
        attempt += 1
    publication = f"{batch_id}-{attempt}"
    gold = daily_category_sales(silver, unique_orders=True)
    by_day = {"daily_category_sales": ["order_date"]}
    paths = stage_snapshots({"daily_category_sales": gold}, f"{root}/gold", publication, by_day)
    written = spark.read.schema(gold.schema).parquet(paths["daily_category_sales"])
    totals = checks.revenue_by_dataset(
        {"silver": (silver, "total_amount"), "gold": (written, "total_revenue")}
    ).collect()  # two rows
    by_name = {row["dataset"]: row for row in totals}
    if by_name["silver"]["revenue"] != by_name["gold"]["revenue"]:
        drop_staged(spark, paths)
        raise checks.QualityError("the daily totals do not add up to Silver")
    commit_snapshots(spark, f"{root}/gold", publication, paths)

    commit_watermark(spark, f"{root}/control/watermarks", watermark_of(bronze), batch_id)
    return {
        "batch_id": batch_id,
        **counts,
        "silver": by_name["silver"]["row_count"],
        "gold": by_name["gold"]["row_count"],
        "silver_revenue": str(by_name["silver"]["revenue"]),
        "status": "success",
    }


def read_silver(spark: SparkSession, root: str, time_type: str = "timestamp") -> DataFrame:
    columns = schema(
        order_id="long", customer_name="string", product="string", category="string",
        price="decimal(12,2)", quantity="int", city="string", order_date="date", updated_at=time_type,
        total_amount="decimal(18,2)",
    )
    return read_buckets(spark, f"{root}/silver", columns)
