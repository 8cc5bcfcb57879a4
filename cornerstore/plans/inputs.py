"""Retail order lines and order events derived from the given star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of order lines as an operational source would hand them out.

    Some prices are negative, some quantities zero and one nation's city is
    blank, so that every layer has rows to reject. Orders get their customer before they
    meet the lines, so that customers too large to broadcast cost no shuffle of the lines.
    """
    buyers = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderdate", "c_name", "n_nationkey", "n_name")
    )
    return (
        table(spark, folder, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
            F.col("c_name").alias("customer_name"),
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
            F.expr(
                "CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -p_retailprice ELSE p_retailprice END"
            ).cast("decimal(12,2)").alias("price"),
            F.expr("CASE WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN 0 ELSE l_quantity END")
            .cast("int").alias("quantity"),
            F.expr("CASE WHEN n_nationkey = 3 THEN '  ' ELSE concat(' ', n_name, ' ') END").alias("city"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_shipdate").alias("updated_at"),
            F.concat(F.lit("b"), F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("batch_id"),
        )
    )


def bronze_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with ingest lineage taken from the order date."""
    return (
        order_lines(spark, folder)
        .withColumn("ingested_at", F.col("order_date").cast("timestamp_ntz"))
        .withColumn("ingestion_date", F.col("order_date"))
    )


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Order change events; some lack a customer, a positive quantity or a valid price."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, folder, "events")
        .withColumn("k", k)
        .select(
            F.expr("concat('O', user_id)").alias("order_id"),
            F.expr("CASE WHEN k % 10 = 9 THEN NULL ELSE concat('C', user_id % 20) END").alias("customer_id"),
            F.expr("concat('Customer ', user_id % 20)").alias("customer_name"),
            F.expr("concat('C', user_id % 20, '@Shop', event_id % 3, '.example')").alias("customer_email"),
            F.expr("concat('P', user_id % 7)").alias("product_id"),
            F.expr("concat('Product ', user_id % 7)").alias("product_name"),
            F.col("event_type").alias("category"),
            F.expr("concat('S', user_id % 5)").alias("store_id"),
            F.col("ts").alias("order_timestamp"),
            F.col("ts").alias("updated_at"),
            F.col("k").alias("quantity"),
            F.expr("CASE WHEN event_id % 50 = 7 THEN -value ELSE value END").alias("unit_price"),
            F.expr(
                "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' "
                "WHEN 'view' THEN 'REFRESH' ELSE 'UPDATE' END"
            ).alias("operation"),
        )
    )
