"""Simple loads: CSV to a table, star schema, set-based sales upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cornerstore.contracts import SALES_SCHEMA
from cornerstore.operators.merge import merge_replace
from cornerstore.operators.star import DIMENSIONS, build_fact, extend_dimension, members
from cornerstore.sinks.files import (
    commit_snapshots, current_path, is_published, path_exists, read_snapshot, stage_snapshots,
)
from cornerstore.sinks.jdbc import Database, write_jdbc
from cornerstore.sources.files import read_csv


def csv_to_jdbc(spark: SparkSession, path: str, database: Database, table: str, mode: str = "overwrite") -> None:
    write_jdbc(read_csv(spark, path, SALES_SCHEMA), database, table, mode)


def seed_csv(spark: SparkSession, path: str, columns: T.StructType, target: str) -> bool:
    """Write the first version of a table from a CSV seed; True if there was none.

    An existing table is left as it is, and the seed is not even read.
    """
    if path_exists(spark, f"{target}/_SUCCESS"):
        return False
    read_csv(spark, path, columns).write.mode("overwrite").parquet(target)
    return True


def load_star(spark: SparkSession, sales: DataFrame, root: str, load_id: str) -> dict[str, DataFrame]:
    """Extend the three dimensions by new members and append the fact rows, in one publication.

    The facts of a load are a part of their own; earlier parts are neither read nor
    written. All four tables become visible by one commit: a load that broke off
    before it has left nothing and is run again under its id, one that was committed
    is not loaded twice.
    """
    names = [*DIMENSIONS, "fact_sales"]
    if not is_published(spark, root, load_id):
        dimensions = {}
        for name, (key, columns) in DIMENSIONS.items():
            stored = read_snapshot(spark, root, name) if current_path(spark, root, name) else None
            dimensions[name] = extend_dimension(stored, members(sales, columns), key, columns)
        # Each dimension is written once under its new version and read back, so the
        # fact build does not number the members a second time.
        paths = stage_snapshots(dimensions, root, load_id)
        written = {name: spark.read.parquet(path) for name, path in paths.items()}
        fact = build_fact(sales, written["dim_customer"], written["dim_product"], written["dim_city"])
        paths |= stage_snapshots({"fact_sales": fact}, root, load_id)
        commit_snapshots(spark, root, load_id, paths, append=["fact_sales"])
    return {name: read_snapshot(spark, root, name) for name in names}


def upsert_sales(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Sales with their amount, replacing rows of the same order."""
    sales = source.select(
        "order_id", "customer_name", "product", "category", "price", "quantity", "city",
        F.try_multiply("price", "quantity").alias("total_amount"),
    )
    return sales if target is None else merge_replace(target, sales, ["order_id"])
