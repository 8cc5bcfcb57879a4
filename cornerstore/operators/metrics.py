"""Business KPIs over current orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cornerstore.contracts import OVERALL_SCOPE
from cornerstore.functions.columns import money_average
from cornerstore.operators.ordering import top_ranked, with_dense_rank
from cornerstore.session import write_and_reread

PRODUCT_ORDER = (("total_revenue", "desc"), ("product", "asc"))
TOP_PRODUCT_COLUMNS = (
    "sales_rank", "product", "category", "total_revenue", "order_count", "units_sold",
    "average_order_value", "last_refreshed_at",
)


def _kpis(unique_orders: bool) -> list[Column]:
    # With one row per order a plain count equals the distinct count, and the
    # aggregate needs no second distinct column (no row expansion).
    return _kpis_with(F.count("order_id") if unique_orders else F.count_distinct("order_id"))


def _kpis_with(orders: Column) -> list[Column]:
    return [
        F.sum("total_amount").cast("decimal(20,2)").alias("total_revenue"),
        orders.cast("long").alias("order_count"),
        F.sum("quantity").cast("long").alias("units_sold"),
        money_average("total_amount", "decimal(20,2)").alias("average_order_value"),
    ]


def common_kpis(
    silver: DataFrame,
    keys: Sequence[str] = (),
    refreshed_at: Column | None = None,
    unique_orders: bool = False,
) -> DataFrame:
    """Revenue, orders, units, average and customers, per key or over all rows.

    ``unique_orders`` states that the rows are one per order, as Silver is. Where they are not,
    two distinct counts in one aggregate would hold an entry per row for each of them in the
    memory of a task; so the first row of every order and of every customer is marked by sorting instead.
    """
    stamp = F.current_timestamp() if refreshed_at is None else refreshed_at
    orders, customers = F.count("order_id"), F.count_distinct("customer_name")
    if not unique_orders:
        silver = _first_marked(silver, keys)
        orders, customers = F.count_if("_first_of_order"), F.count_if("_first_of_customer")
    return silver.groupBy(*keys).agg(
        *_kpis_with(orders),
        customers.cast("long").alias("distinct_customers"),
    ).withColumn("last_refreshed_at", stamp)


def _first_marked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amounts and quantities, and whether a row is the one that stands for its order or its customer in the group.

    Rows without an order or a customer stand for none, and are spread by the other of the two.
    """

    def first(name: str) -> Column:
        same = Window.partitionBy(*keys, name, f"_spread_{name}").orderBy(name)
        return F.col(name).isNotNull() & (F.row_number().over(same) == 1)

    def spread(name: str, by: str) -> Column:
        return F.when(F.col(name).isNull(), F.xxhash64(by)).alias(f"_spread_{name}")

    marked = rows.select(
        *keys, "order_id", "customer_name", "total_amount", "quantity",
        spread("order_id", "customer_name"), spread("customer_name", "order_id"),
    ).withColumn("_first_of_order", first("order_id"))
    return marked.drop("order_id", "_spread_order_id").withColumn("_first_of_customer", first("customer_name"))


def overall_sales(silver: DataFrame, refreshed_at=None, unique_orders=False) -> DataFrame:
    kpis = common_kpis(silver, (), refreshed_at, unique_orders)
    return kpis.select(F.lit(OVERALL_SCOPE).alias("metric_scope"), *kpis.columns)


def category_sales(silver: DataFrame, refreshed_at=None, unique_orders=False) -> DataFrame:
    return common_kpis(silver, ["category"], refreshed_at, unique_orders)


def city_sales(silver: DataFrame, refreshed_at=None, unique_orders=False) -> DataFrame:
    return common_kpis(silver, ["city"], refreshed_at, unique_orders)


def product_sales(silver: DataFrame, refreshed_at=None, unique_orders=False) -> DataFrame:
    return common_kpis(silver, ["product", "category"], refreshed_at, unique_orders)


def customer_sales(silver: DataFrame, refreshed_at=None, unique_orders=False) -> DataFrame:
    """KPIs per named customer plus distinct products, in one aggregation.

    Within one customer the number of distinct customers is 1 by definition.
    """
    stamp = F.current_timestamp() if refreshed_at is None else refreshed_at
    return (
        silver.filter("customer_name IS NOT NULL")
        .groupBy("customer_name")
        .agg(*_kpis(unique_orders), F.count_distinct("product").cast("long").alias("distinct_products"))
        .withColumn("distinct_customers", F.lit(1).cast("long"))
        .withColumn("last_refreshed_at", stamp)
        .select(
            "customer_name", "total_revenue", "order_count", "units_sold", "average_order_value",
            "distinct_customers", "last_refreshed_at", "distinct_products",
        )
    )


def rank_products(products: DataFrame) -> DataFrame:
    """All products by revenue, name as second order; equal pairs share a rank."""
    return with_dense_rank(products, PRODUCT_ORDER, "sales_rank").select(*TOP_PRODUCT_COLUMNS)


def top_products(products: DataFrame, k: int) -> DataFrame:
    return top_ranked(products, PRODUCT_ORDER, k, "sales_rank").select(*TOP_PRODUCT_COLUMNS)


def kpis_in_one_pass(silver: DataFrame, refreshed_at=None, unique_orders=False) -> DataFrame:
    """Overall, category, city, product and customer KPIs from a single scan.

    ``scope`` names the grouping; key columns outside the grouping are NULL.
    """
    stamp = F.current_timestamp() if refreshed_at is None else refreshed_at
    keys = [F.col(name) for name in ("category", "city", "product", "customer_name")]
    category, city, product, customer = keys
    grouped = silver.groupingSets(
        [[], [category], [city], [product, category], [customer]], *keys
    ).agg(
        F.grouping_id().alias("_grouping"),
        *_kpis(unique_orders),
        F.count_distinct("customer_name").cast("long").alias("distinct_customers"),
    )
    scope = F.expr(
        "CASE _grouping WHEN 15 THEN 'overall' WHEN 7 THEN 'category' WHEN 11 THEN 'city' "
        "WHEN 5 THEN 'product' WHEN 14 THEN 'customer' END"
    )
    return grouped.select(
        scope.alias("scope"), "category", "city", "product", "customer_name", "total_revenue",
        "order_count", "units_sold", "average_order_value", "distinct_customers",
    ).withColumn("last_refreshed_at", stamp)


def daily_category_sales(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    revenue = F.sum("total_amount").cast("decimal(20,2)").alias("total_revenue")
    return _daily(orders, ["order_date", "category"], unique_orders, revenue)


STORE_KEYS = ("order_date", "store_id", "category")


def daily_store_sales(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    dated = orders.withColumn("order_date", F.to_date("order_timestamp"))
    return _daily(dated, STORE_KEYS, unique_orders, F.round(F.sum("total_amount"), 2).alias("gross_sales"))


def _daily(orders: DataFrame, keys: Sequence[str], unique_orders: bool, money: Column) -> DataFrame:
    count = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    return orders.groupBy(*keys).agg(count.alias("order_count"), F.sum("quantity").alias("units_sold"), money)


def signed_sums(before: DataFrame | None, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes of the sums per group that sales KPIs are made of: orders of ``after`` come in, those of ``before`` go out.

    Both hold one row per order. What is the same on both sides cancels out, and
    groups without a change are left away. The sums can be added to and taken from; the counts
    of known values tell when a sum over nothing but NULL has to be NULL again.
    """
    signed = after.withColumn("_sign", F.lit(1))
    if before is not None:
        signed = before.withColumn("_sign", F.lit(-1)).unionByName(signed)
    known = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.col("_sign")))
    sums = signed.groupBy(*keys).agg(
        known("order_id").alias("orders"),
        F.sum(F.col("quantity").cast("long") * F.col("_sign")).alias("units"), known("quantity").alias("units_known"),
        F.sum(F.when(F.col("_sign") > 0, F.col("total_amount")).otherwise(-F.col("total_amount"))).alias("amount"),
        known("total_amount").alias("amounts_known"), F.sum("_sign").alias("n_rows"),
    )
    return sums.na.fill(0, list(SUMS)).filter(" OR ".join(f"{name} <> 0" for name in SUMS))


SUMS = ("orders", "units", "units_known", "amount", "amounts_known", "n_rows")


def add_sums(sums: DataFrame | None, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sums after the changes; groups that have lost their last row are gone."""
    both = changes if sums is None else sums.unionByName(changes)
    kinds = {f.name: f.dataType for f in (changes if sums is None else sums).schema}
    return both.groupBy(*keys).agg(*(F.sum(name).cast(kinds[name]).alias(name) for name in SUMS)).filter("n_rows <> 0")


def signed_store_sales(before: DataFrame | None, after: DataFrame) -> DataFrame:
    dated = [None if orders is None else orders.withColumn("order_date", F.to_date("order_timestamp")) for orders in (before, after)]
    return signed_sums(*dated, STORE_KEYS)


def store_sales_of(sums: DataFrame) -> DataFrame:
    """Daily sales from their sums, as ``daily_store_sales`` gives them."""
    return sums.select(
        *STORE_KEYS, F.col("orders").alias("order_count"), F.when(F.col("units_known") > 0, F.col("units")).alias("units_sold"),
        F.when(F.col("amounts_known") > 0, F.round("amount", 2)).alias("gross_sales"),
    )


#: The finest groups that all KPI datasets can be made from.
CELL_KEYS = ("category", "city", "product", "customer_name")


def kpis_of_cells(cells: DataFrame, refreshed_at: Column | None = None) -> dict[str, DataFrame]:
    """The KPI datasets from sums per cell, as the functions above give them from one row per order.

    A customer counts in a group as long as one of its cells there has orders. Cells are
    shuffled once, by customer: where all cells of a customer are together, its share of every
    dataset is summed, so that distinct customers and products are plain counts
    and only these shares, summed per task, are shuffled again. The sums are written once for all datasets.
    """
    stamp = F.current_timestamp() if refreshed_at is None else refreshed_at
    by = {
        "overall": (None, None), "category": ("category", None), "city": ("city", None),
        "product": ("product", "category"), "customer": ("product", None),
    }
    texts = lambda names: [F.lit(None).cast("string") if n is None else F.col(n) for n in names]
    groups = [F.struct(F.lit(scope).alias("scope"), *(c.alias(k) for c, k in zip(texts(names), "ab"))) for scope, names in by.items()]
    dealt = cells.repartition("customer_name").select("customer_name", *SUMS, F.inline(F.array(*groups)))
    shares = dealt.groupBy("customer_name", "scope", "a", "b").agg(*(F.sum(name).alias(name) for name in SUMS))
    of_customer = F.col("scope") == "customer"
    summed = shares.filter(~of_customer | F.col("customer_name").isNotNull()).groupBy(
        "scope", F.when(of_customer, F.col("customer_name")).otherwise(F.col("a")).alias("_a"), F.col("b").alias("_b")
    ).agg(
        *(F.sum(name).alias(name) for name in SUMS),
        F.count("customer_name").alias("customers"), F.count(F.when(of_customer, F.col("a"))).alias("products"),
    )
    known = F.col("amounts_known") > 0
    kpis = write_and_reread(summed.select(
        "scope", "_a", "_b",
        F.when(known, F.col("amount")).cast("decimal(20,2)").alias("total_revenue"),
        F.col("orders").cast("long").alias("order_count"),
        F.when(F.col("units_known") > 0, F.col("units")).cast("long").alias("units_sold"),
        F.when(known, F.col("amount") / F.col("amounts_known")).cast("decimal(22,6)").cast("decimal(20,2)").alias("average_order_value"),
        F.when(of_customer, F.lit(1)).otherwise(F.col("customers")).cast("long").alias("distinct_customers"),
        F.col("products").cast("long").alias("distinct_products"),
    ), "kpis")
    names = ["total_revenue", "order_count", "units_sold", "average_order_value", "distinct_customers"]

    def of(scope: str, *keys: str) -> DataFrame:
        rows = kpis.filter(F.col("scope") == scope).withColumn("last_refreshed_at", stamp)
        return rows.select(*(F.col(c).alias(k) for c, k in zip(("_a", "_b"), keys)), *names, "last_refreshed_at", "distinct_products")

    overall = of("overall").select(F.lit(OVERALL_SCOPE).alias("metric_scope"), *names, "last_refreshed_at")
    return {
        "overall_sales": overall,
        "category_sales": of("category", "category").drop("distinct_products"),
        "city_sales": of("city", "city").drop("distinct_products"),
        "product_sales": of("product", "product", "category").drop("distinct_products"),
        "customer_sales": of("customer", "customer_name"),
    }


def mart_daily_sales(fact: DataFrame, products: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Daily sales per store and product category, the category from the product dimension."""
    count = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    sales = fact.select("order_id", "product_id", "store_id", "order_date", "quantity", "total_amount")
    return (
        sales.join(products.select("product_id", "category"), "product_id", "left")
        .groupBy("order_date", "store_id", "category")
        .agg(
            count.alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            F.sum("total_amount").cast("decimal(18,2)").alias("gross_sales"),
            money_average("total_amount", "decimal(18,2)").alias("average_order_value"),
        )
    )
