"""JDBC sources: tables, subqueries, incremental scans, split reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cornerstore.contracts import SOURCE_COLUMNS
from cornerstore.operators.watermark import Watermark, source_subquery
from cornerstore.sinks.jdbc import Database


@dataclass(frozen=True)
class Split:
    """Read a numeric column's range over several connections."""

    column: str
    lower: int
    upper: int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def scan_options(database: Database, table: str, split: Split | None = None, fetch_size: int = 1000) -> dict[str, str]:
    options = {**database.options(table), "fetchsize": str(fetch_size)}
    return {**options, **split.options()} if split else options


def read_jdbc(spark: SparkSession, database: Database, table: str, split: Split | None = None) -> DataFrame:
    """``table`` is a table name or a parenthesised subquery with an alias.

    Without a split one task reads everything, so give one for a large table.
    """
    return spark.read.format("jdbc").options(**scan_options(database, table, split)).load()


def read_incremental(
    spark: SparkSession,
    database: Database,
    table: str,
    watermark: Watermark | None,
    split: Split | None = None,
    columns: tuple[str, ...] = SOURCE_COLUMNS,
) -> DataFrame:
    """Rows past the watermark; the predicate runs in the database."""
    return read_jdbc(spark, database, source_subquery(table, columns, watermark), split)
