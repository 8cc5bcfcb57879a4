"""Star schema: dimension members, surrogate keys, fact rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from cornerstore.operators.ordering import with_position

# dimension -> (surrogate key, member columns)
DIMENSIONS = {
    "dim_customer": ("customer_id", ("customer_name",)),
    "dim_product": ("product_id", ("product", "category")),
    "dim_city": ("city_id", ("city",)),
}


def members(sales: DataFrame, columns: Sequence[str]) -> DataFrame:
    return sales.select(*columns).distinct()


def extend_dimension(
    dimension: DataFrame | None, found: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Add members the dimension lacks, numbered after its greatest key.

    Existing keys never change, so loading the same members again adds nothing.
    New members are numbered in sorted order by a distributed sort.
    """
    order = [(name, "asc") for name in columns]
    if dimension is None:
        return with_position(found, order, key).select(key, *columns)
    stored = dimension.select(*(F.col(name).alias(f"_{name}") for name in columns))
    known = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in columns))
    fresh = with_position(found.join(stored, known, "left_anti"), order, key)
    greatest = dimension.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    return dimension.select(key, *columns).unionByName(
        fresh.withColumn(key, F.col(key) + greatest).select(key, *columns)
    )


def build_fact(
    sales: DataFrame, customers: DataFrame, products: DataFrame, cities: DataFrame
) -> DataFrame:
    """Sales with surrogate keys; a row whose member is NULL or unknown is left out.

    Spark broadcasts a dimension that is under the threshold and splits skewed
    partitions of a sort-merge join beyond it, so a hot city or customer is safe
    either way.
    """
    return (
        sales.join(customers, "customer_name")
        .join(products, ["product", "category"])
        .join(cities, "city")
        .select("order_id", "customer_id", "product_id", "city_id", "price", "quantity")
    )
