"""File sources with explicit schemas and pruned batch reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from cornerstore.contracts import check_batch_id
from cornerstore.schemas import schema
from cornerstore.sinks.files import batch_folder, path_exists


def read_csv(spark: SparkSession, path: str, columns: T.StructType | None = None) -> DataFrame:
    """CSV with a header; without a schema the types are inferred by an extra pass."""
    reader = spark.read.option("header", True)
    return reader.schema(columns).csv(path) if columns is not None else reader.option("inferSchema", True).csv(path)


def read_batch(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    """One immutable batch, complete.

    Only the batch's own folder is listed and read. The partition columns get
    their declared types, so a batch id of digits stays text.
    """
    check_batch_id(batch_id)
    if not path_exists(spark, root):
        raise FileNotFoundError(f"no such dataset: {root}")
    folder = batch_folder(spark, root, batch_id)
    if folder is None:
        raise FileNotFoundError(f"no batch {batch_id} under {root}")
    partitions = schema(ingestion_date="date", batch_id="string")
    stored = spark.read.parquet(folder).schema
    columns = T.StructType([f for f in stored if f.name not in partitions.names] + partitions.fields)
    return spark.read.schema(columns).option("basePath", root).parquet(folder)


def require_columns(df: DataFrame, columns: Iterable[str], exact: bool = False) -> DataFrame:
    """Fail early, from the schema alone, if columns are missing (or, if exact, left over)."""
    wanted, found = set(columns), set(df.columns)
    if wanted - found:
        raise ValueError(f"missing columns: {sorted(wanted - found)}")
    if exact and found - wanted:
        raise ValueError(f"unexpected columns: {sorted(found - wanted)}")
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, None if it does not exist."""
    return spark.table(name) if spark.catalog.tableExists(name) else None
