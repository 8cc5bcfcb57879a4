"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cornerstore.contracts import (
    ALLOWED_OPERATIONS, FINGERPRINT_COLUMNS, LAKE_COLUMNS, LAKE_RULES, MEDALLION_RULES, ORDER_EVENT_SCHEMA,
    SOURCE_COLUMNS,
)
from cornerstore.functions.columns import fingerprint, int_amount
from cornerstore.functions.messages import (
    RESCUED, parse_messages, parse_with_rescue, split_dead_letters, to_messages,
)
from cornerstore.operators import checks, history, merge, metrics, ordering, setops, star
from cornerstore.operators.classify import count_unexpected, keep_expected
from cornerstore.operators.clean import (
    classify_bronze, classify_lake_rows, clean_bronze, clean_lake_rows, judge_events,
    quarantined_events, valid_events,
)
from cornerstore.operators.latest import latest_by_order, latest_silver
from cornerstore.operators.watermark import Watermark, after_watermark, greatest_version
from cornerstore.plans import cdc, lakehouse, loads, medallion, models
from cornerstore.plans.inputs import bronze_lines, order_events, order_lines, table
from cornerstore.schemas import schema
from cornerstore.session import shared_folder, write_and_reread
from cornerstore.sinks import files as sinks
from cornerstore.sources import files as sources, streams
from cornerstore.streaming import history as stream_history_of, jobs

NTZ = "timestamp_ntz"
CUT = "updated_at < TIMESTAMP_NTZ '2000-01-01 00:00:00'"
EVENT_CUT = "updated_at < TIMESTAMP_NTZ '2024-01-15 00:00:00'"
WATERMARK_US, WATERMARK_ID = 946684800000000, 70000
DELETED = "operation = 'DELETE'"
SILVER_OUT = (
    "order_id", "customer_name", "product", "category", "price", "quantity", "city",
    "total_amount", "source_updated_at", "source_batch_id",
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def stamp() -> Column:
    return F.expr("TIMESTAMP_NTZ '2024-06-01 00:00:00'")


def later() -> Column:
    return F.expr("TIMESTAMP_NTZ '2024-07-01 00:00:00'")


# Building blocks -----------------------------------------------------------


def _classified(spark, folder) -> tuple[DataFrame, DataFrame]:
    return classify_bronze(bronze_lines(spark, folder), stamp(), NTZ)


def _silver(spark, folder) -> DataFrame:
    return latest_silver(_classified(spark, folder)[0])


def _lake(spark, folder) -> DataFrame:
    return classify_lake_rows(order_lines(spark, folder), NTZ)[0]


def _lake_order() -> tuple[Column, ...]:
    return F.desc("price"), F.desc("product"), F.desc("quantity")


def _lake_latest(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return latest_by_order(rows, *_lake_order(), within=within)


def _changes(spark, folder) -> DataFrame:
    valid = valid_events(order_events(spark, folder), NTZ)
    return keep_expected(valid, ALLOWED_OPERATIONS).drop("is_valid", "quality_reason")


def _history(events: DataFrame) -> DataFrame:
    return history.scd2(events, ["order_id"], "updated_at", DELETED, ["operation"], tie_break=[F.desc("order_timestamp")])


def _staged(events: DataFrame) -> DataFrame:
    current = history.current_from_events(events, ["order_id"], "updated_at", DELETED, ["operation"])
    return history.stage_current_orders(current, NTZ)


# Extraction ----------------------------------------------------------------


@query
def incremental_scan(spark, folder):
    rows = order_lines(spark, folder).select(*SOURCE_COLUMNS)
    return after_watermark(rows, Watermark(WATERMARK_US, WATERMARK_ID))


@query
def watermark_max(spark, folder):
    return greatest_version(order_lines(spark, folder))


@query
def incremental_table_scan(spark, folder):
    """The predicate on stored columns, where it reaches the file scan."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return after_watermark(lines, Watermark(WATERMARK_US, 7000), "l_shipdate", "l_orderkey")


# Classification ------------------------------------------------------------


@query
def classify_reasons(spark, folder):
    _, rejected = _classified(spark, folder)
    return rejected.select(
        "order_id", "source_batch_id", "source_updated_at", "price", "quantity", "city", "total_amount",
        F.array_join("rejection_reasons", ",").alias("reasons"),
    )


@query
def classify_merged(spark, folder):
    _, rejected = classify_lake_rows(order_lines(spark, folder), NTZ)
    return rejected.select(
        "order_id", "updated_at", "product", "price", "quantity", "city", "total_amount",
        F.array_join("rejection_reasons", ",").alias("reasons"),
    )


@query
def classify_first_match(spark, folder):
    return judge_events(order_events(spark, folder), NTZ).select(
        "order_id", "updated_at", "quantity", "unit_price", "quality_reason", "is_valid", "total_amount"
    )


@query
def valid_orders(spark, folder):
    return valid_events(order_events(spark, folder), NTZ).drop("is_valid", "quality_reason")


@query
def quarantined_orders(spark, folder):
    return quarantined_events(order_events(spark, folder), NTZ).drop("is_valid")


@query
def expected_operations(spark, folder):
    return _changes(spark, folder).select("order_id", "updated_at", "operation")


@query
def dropped_operations(spark, folder):
    return count_unexpected(valid_events(order_events(spark, folder), NTZ), ALLOWED_OPERATIONS)


@query
def record_fingerprint(spark, folder):
    cleaned = clean_bronze(bronze_lines(spark, folder), stamp(), NTZ)
    return cleaned.select(
        "order_id", "source_batch_id", "source_updated_at",
        fingerprint(FINGERPRINT_COLUMNS).alias("record_fingerprint"),
    )


@query
def line_amounts(spark, folder):
    """Integer amounts, the form the streaming and set-based loads use."""
    lines = order_lines(spark, folder).select(
        "order_id", "batch_id", F.col("price").cast("int").alias("price"), "quantity"
    )
    return lines.withColumn("total_amount", int_amount())


# Latest version, rank ------------------------------------------------------


@query
def dedup_latest(spark, folder):
    return _silver(spark, folder).select(*SILVER_OUT)


@query
def dedup_single_order(spark, folder):
    return _lake_latest(_lake(spark, folder))


@query
def rank_products(spark, folder):
    products = metrics.product_sales(_silver(spark, folder), stamp(), unique_orders=True)
    return metrics.rank_products(write_and_reread(products, "products"))


@query
def top_products_k(spark, folder):
    products = metrics.product_sales(_silver(spark, folder), stamp(), unique_orders=True)
    return metrics.top_products(write_and_reread(products, "products"), 25)


@query
def ordered_history(spark, folder):
    return _history(_changes(spark, folder)).select(
        "order_id", history.START, history.END, "total_amount"
    ).orderBy("order_id", history.START)


# KPIs ----------------------------------------------------------------------


@query
def kpi_overall(spark, folder):
    return metrics.overall_sales(_silver(spark, folder), stamp(), unique_orders=True)


@query
def kpi_category(spark, folder):
    return metrics.category_sales(_silver(spark, folder), stamp(), unique_orders=True)


@query
def kpi_city(spark, folder):
    return metrics.city_sales(_silver(spark, folder), stamp(), unique_orders=True)


@query
def kpi_product(spark, folder):
    return metrics.product_sales(_silver(spark, folder), stamp(), unique_orders=True)


@query
def kpi_customer(spark, folder):
    return metrics.customer_sales(_silver(spark, folder), stamp(), unique_orders=True)


@query
def kpi_all_versions(spark, folder):
    """KPIs over rows that are not one per order, so orders are counted distinct."""
    return metrics.category_sales(_classified(spark, folder)[0], stamp())


@query
def kpi_grouping_sets(spark, folder):
    return metrics.kpis_in_one_pass(_silver(spark, folder), stamp(), unique_orders=True)


@query
def daily_category_sales(spark, folder):
    return metrics.daily_category_sales(_lake_latest(_lake(spark, folder)), unique_orders=True)


@query
def daily_store_sales(spark, folder):
    return metrics.daily_store_sales(valid_events(order_events(spark, folder), NTZ))


# Models --------------------------------------------------------------------


@query
def stg_current_orders(spark, folder):
    return history.stage_current_orders(_history(_changes(spark, folder)), NTZ)


@query
def dim_customer(spark, folder):
    return history.dim_customer(valid_events(order_events(spark, folder), NTZ))


@query
def dim_product(spark, folder):
    return history.dim_product(valid_events(order_events(spark, folder), NTZ))


@query
def fct_sales(spark, folder):
    """A first load, then an incremental merge of everything known later."""
    changes = _changes(spark, folder)
    first = _staged(changes.filter(EVENT_CUT)).select(*models.FACT_COLUMNS)
    return merge.merge_incremental(first, _staged(changes).select(*models.FACT_COLUMNS), ["order_id"])


@query
def mart_daily_sales(spark, folder):
    valid = valid_events(order_events(spark, folder), NTZ)
    fact = valid.withColumn("order_date", F.to_date("order_timestamp"))
    return metrics.mart_daily_sales(fact, history.dim_product(valid))


# Merge ---------------------------------------------------------------------


@query
def merge_upsert(spark, folder):
    lake = _lake(spark, folder)
    target = write_and_reread(_lake_latest(lake.filter("quantity >= 25")), "target")
    source = write_and_reread(_lake_latest(lake.filter("quantity < 25")), "source")
    return merge.merge_newer(target, source, ["order_id"], ["updated_at"])


@query
def merge_incremental(spark, folder):
    lake = _lake(spark, folder)
    target = write_and_reread(_lake_latest(lake.filter(CUT)), "target")
    # New orders that come late: older than the target's newest row, so they are skipped.
    late = target.filter("quantity < 10").withColumn("order_id", -F.col("order_id"))
    source = write_and_reread(_lake_latest(lake).unionByName(late), "source")
    return merge.merge_incremental(target, source, ["order_id"])


@query
def snapshot_merge(spark, folder):
    valid, _ = _classified(spark, folder)
    snapshot = write_and_reread(latest_silver(valid.filter("quantity >= 25")), "snapshot")
    return merge.merge_snapshot(snapshot, valid.filter("quantity < 25")).select(*SILVER_OUT)


@query
def control_merge(spark, folder):
    """One watermark row per category, replaced by the newer run's row."""
    lines = order_lines(spark, folder)

    def marks(rows):
        top = F.max(F.struct("updated_at", "order_id")).alias("top")
        return rows.groupBy("category").agg(top).select("category", "top.updated_at", "top.order_id")

    return merge.merge_replace(marks(lines.filter(CUT)), marks(lines.filter(f"NOT ({CUT})")), ["category"])


@query
def sales_upsert(spark, folder):
    """Set-based upsert of sales with their amount, keyed by order."""
    lake = _lake(spark, folder)
    target = loads.upsert_sales(None, _lake_latest(lake.filter(CUT)))
    return loads.upsert_sales(target, _lake_latest(lake.filter(f"NOT ({CUT})")))


# History -------------------------------------------------------------------


@query
def scd2_history(spark, folder):
    return _history(_changes(spark, folder))


@query
def scd2_current(spark, folder):
    return history.current_from_events(
        _changes(spark, folder), ["order_id"], "updated_at", DELETED, ["operation"]
    )


@query
def snapshot_check(spark, folder):
    valid = valid_events(order_events(spark, folder), NTZ)

    def customers(rows):
        return history.dim_customer(rows).select("customer_id", "customer_name", "customer_email")

    first = history.start_check_snapshot(customers(valid.filter(EVENT_CUT)), stamp())
    return history.check_snapshot(
        first, customers(valid), "customer_id", ["customer_name", "customer_email"], later()
    )


@query
def change_stamp(spark, folder):
    lake = _lake(spark, folder)
    columns = ("order_id", "customer_name", "product", "category", "price", "quantity", "city", "updated_at")
    before = _lake_latest(lake.filter(CUT)).select(*columns)
    after = _lake_latest(lake).select(*columns).withColumn(
        "updated_at", F.when(F.col("quantity") >= 10, F.col("updated_at"))
    )
    return history.stamp_changes(before, after, "order_id", columns[1:-1], stamp())


# Star schema ---------------------------------------------------------------


def _dimension(spark, folder, name):
    """A dimension after two loads: the orders before 2000, then all orders."""
    key, columns = star.DIMENSIONS[name]
    sales = write_and_reread(_lake(spark, folder).select(*columns, "updated_at"), "sales")
    first = star.extend_dimension(None, star.members(sales.filter(CUT), columns), key, columns)
    return star.extend_dimension(first, star.members(sales, columns), key, columns)


@query
def star_dim_customer(spark, folder):
    return _dimension(spark, folder, "dim_customer")


@query
def star_dim_product(spark, folder):
    return _dimension(spark, folder, "dim_product")


@query
def star_dim_city(spark, folder):
    return _dimension(spark, folder, "dim_city")


@query
def star_fact(spark, folder):
    """All dimensions numbered in one load, then the fact rows."""
    sales = write_and_reread(_lake_latest(_lake(spark, folder)), "sales")
    dims = [
        star.extend_dimension(None, star.members(sales, columns), key, columns)
        for key, columns in star.DIMENSIONS.values()
    ]
    return star.build_fact(sales, *dims)


@query
def star_load(spark, folder):
    """The whole load run twice on growing sales, fact rows appended."""
    root = shared_folder(spark, "star")
    sales = write_and_reread(_lake_latest(_lake(spark, folder)), "sales")
    loads.load_star(spark, sales.filter(CUT), root, "first")
    return loads.load_star(spark, sales.filter(f"NOT ({CUT})"), root, "second")["fact_sales"]


# Quality -------------------------------------------------------------------


@query
def dq_counts(spark, folder):
    return checks.disposition_counts(clean_bronze(bronze_lines(spark, folder), stamp(), NTZ), MEDALLION_RULES)


@query
def dq_counts_merged(spark, folder):
    return checks.disposition_counts(clean_lake_rows(order_lines(spark, folder), NTZ), LAKE_RULES)


@query
def dq_unique(spark, folder):
    return checks.duplicate_keys(order_lines(spark, folder), ["order_id"])


@query
def dq_not_null(spark, folder):
    events = order_events(spark, folder)
    return checks.null_counts(events, ["order_id", "customer_id", "product_id", "order_timestamp", "quantity"])


@query
def dq_null_rows(spark, folder):
    return checks.null_rows(order_events(spark, folder), "customer_id").select("order_id", "updated_at", "store_id")


@query
def dq_relationships(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_linenumber")
    # Beside all lines, the seventh ones once more under a part that is not there.
    planted = lines.filter("l_linenumber = 7").withColumn("l_partkey", -F.col("l_partkey"))
    return checks.orphans(lines.unionByName(planted), "l_partkey", table(spark, folder, "part"), "p_partkey")


@query
def dq_positive(spark, folder):
    judged = judge_events(order_events(spark, folder), NTZ)
    return checks.negative_sales(judged).select("order_id", "updated_at", "quantity", "unit_price", "total_amount")


@query
def dq_silver_rules(spark, folder):
    """Re-check of cleaned but unfiltered rows, so there is something to find."""
    cleaned = clean_bronze(bronze_lines(spark, folder), stamp(), NTZ)
    return checks.silver_violations(cleaned).select(
        "order_id", "source_batch_id", "price", "quantity", "city", "total_amount"
    )


@query
def dq_lineage(spark, folder):
    valid, _ = _classified(spark, folder)
    early = valid.filter("source_updated_at < TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    return checks.lineage_gaps(latest_silver(valid), latest_silver(early))


@query
def dq_fingerprint_diff(spark, folder):
    _, rejected = _classified(spark, folder)
    early = rejected.filter("source_updated_at < TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    twice = early.unionByName(early)
    return setops.multiset_difference(rejected, twice, ["record_fingerprint"])


@query
def dq_revenue(spark, folder):
    silver = write_and_reread(_silver(spark, folder), "silver")
    gold = {
        "category_sales": metrics.category_sales(silver, stamp(), True),
        "city_sales": metrics.city_sales(silver, stamp(), True),
        "product_sales": metrics.product_sales(silver, stamp(), True),
        "customer_sales": metrics.customer_sales(silver, stamp(), True),
    }
    datasets = {name: (df, "total_revenue") for name, df in gold.items()}
    return checks.revenue_by_dataset({"silver": (silver, "total_amount"), **datasets})


@query
def dq_one_value(spark, folder):
    return checks.one_value(order_lines(spark, folder), "order_date")


@query
def dq_count_match(spark, folder):
    valid, rejected = _classified(spark, folder)
    return checks.count_difference(valid, rejected)


# Set operations ------------------------------------------------------------


@query
def union_snapshot(spark, folder):
    lake = _lake(spark, folder)
    return setops.union_rows(_lake_latest(lake.filter(CUT)), lake.filter(f"NOT ({CUT})"))


@query
def except_all_diff(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_linenumber")
    late = table(spark, folder, "lineitem").filter("l_returnflag = 'N'").select("l_partkey", "l_linenumber")
    return setops.except_all(lines, late)


# Messages ------------------------------------------------------------------

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SALE_COLUMNS = ("order_id", "customer_name", "product", "category", "price", "quantity", "city")
SALE_MESSAGE = schema(
    order_id="long", customer_name="string", product="string", category="string", price="decimal(12,2)",
    quantity="int", city="string", updated_at=NTZ, batch_id="string",
)


def _sale_messages(spark, folder) -> DataFrame:
    return to_messages(order_lines(spark, folder).select(*SALE_MESSAGE.names))


def _event_messages(spark, folder) -> DataFrame:
    """Event messages with times as text and one field that no schema declares."""
    events = order_events(spark, folder)
    return to_messages(
        events.withColumn("order_timestamp", F.date_format("order_timestamp", MICROS))
        .withColumn("updated_at", F.date_format("updated_at", MICROS))
        .withColumn("channel", F.col("category"))
    )


@query
def json_publish(spark, folder):
    return to_messages(order_lines(spark, folder).select("order_id", "product", "price", "quantity", "city"))


@query
def json_parse(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("props").alias("value"))
    return parse_messages(events, schema(k="int"), keep=("event_id",))


@query
def json_rescue(spark, folder):
    """Known fields typed, the undeclared one kept aside."""
    rows = _event_messages(spark, folder).select(
        parse_with_rescue(F.col("value"), ORDER_EVENT_SCHEMA).alias("data")
    ).select("data.*")
    return rows.select("order_id", "updated_at", "quantity", "unit_price", "operation", RESCUED)


@query
def json_dead_letters(spark, folder):
    """Messages whose key cannot be read: here those of customers left out."""
    events = order_events(spark, folder).select(
        "customer_id", "quantity", F.date_format("updated_at", MICROS).alias("updated_at")
    )
    _, unreadable = split_dead_letters(
        to_messages(events), schema(customer_id="string", quantity="int"), "customer_id"
    )
    return unreadable


# Sources and sinks ---------------------------------------------------------


@query
def csv_roundtrip(spark, folder):
    rows = order_lines(spark, folder).select(*SALE_COLUMNS, "batch_id")
    path = shared_folder(spark, "csv")
    sinks.write_csv(rows, path)
    return sources.read_csv(spark, path, rows.schema)


@query
def csv_inferred(spark, folder):
    rows = order_lines(spark, folder).select("order_id", "product", "quantity", "batch_id")
    path = shared_folder(spark, "csv")
    sinks.write_csv(rows, path)
    return sources.read_csv(spark, path)


@query
def json_landing(spark, folder):
    path = shared_folder(spark, "landing")
    events = order_events(spark, folder).select("order_id", "customer_id", "quantity", "unit_price", "operation")
    sinks.append_json(events, path)
    return spark.read.schema(events.schema).json(path)


@query
def seed_if_absent(spark, folder):
    """The second seed finds the table and leaves it as it is."""
    path = shared_folder(spark, "seed")
    lines = order_lines(spark, folder).select("order_id", "product", "quantity", "updated_at", "batch_id")
    sinks.seed_if_absent(lines.filter(CUT), path)
    sinks.seed_if_absent(lines, path)
    return spark.read.parquet(path)


@query
def bronze_batches(spark, folder):
    """Two immutable batches under one root; only one is read back."""
    root = shared_folder(spark, "bronze")
    lines = order_lines(spark, folder).select(*SOURCE_COLUMNS)
    for batch_id, rows in (("007", lines.filter(CUT)), ("8", lines.filter(f"NOT ({CUT})"))):
        sinks.append_batch(rows, root, batch_id, "2024-06-01")
    return sources.read_batch(spark, root, "007").select(*SOURCE_COLUMNS, "ingestion_date", "batch_id")


@query
def quarantine_write(spark, folder):
    """Rejected rows written once; the retry finds the same rows and writes nothing."""
    root = shared_folder(spark, "quarantine")
    _, rejected = _classified(spark, folder)
    for _ in range(2):
        sinks.write_quarantine(rejected, root, "batch-1", "2024-06-01")
    return sources.read_batch(spark, root, "batch-1").select("order_id", "record_fingerprint", "batch_id")


@query
def snapshot_publish(spark, folder):
    """Two publications of one dataset; readers see the second."""
    root = shared_folder(spark, "snapshots")
    lake = _lake(spark, folder)
    sinks.publish_snapshots({"orders": _lake_latest(lake.filter(CUT))}, root, "one")
    sinks.publish_snapshots({"orders": _lake_latest(lake)}, root, "two")
    return sinks.read_snapshot(spark, root, "orders")


@query
def bucket_upsert(spark, folder):
    """MERGE into a stored table that rewrites only the key buckets it touches."""
    root = shared_folder(spark, "buckets")
    lake = _lake(spark, folder)
    sinks.upsert_buckets(_lake_latest(lake.filter("quantity >= 25")), root, ["order_id"], "one", 16, ["updated_at"])
    sinks.upsert_buckets(_lake_latest(lake.filter("quantity < 25")), root, ["order_id"], "two", 16, ["updated_at"])
    return sinks.read_buckets(spark, root, lake.schema)


@query
def bucket_deltas(spark, folder):
    """The same MERGE in three batches of which two wait as deltas, merged while reading."""
    root = shared_folder(spark, "deltas")
    lake = _lake(spark, folder)
    batches = (lake.filter("quantity >= 25"), *(lake.filter(f"quantity < 25 AND order_id % 2 = {k}") for k in range(2)))
    for number, batch in enumerate(batches):
        sinks.upsert_buckets(
            _lake_latest(batch), root, ["order_id"], f"batch-{number}", 16, ["updated_at"], delta_share=1e9
        )
    return sinks.read_buckets(spark, root, lake.schema)


@query
def parts_merge(spark, folder):
    """An incremental model kept in ranges of the key: later rows replace and insert, late ones are skipped."""
    root = shared_folder(spark, "parts")
    lake = _lake(spark, folder)
    model = models.Model(
        "sales", lambda ref: ref("rows"), "incremental", "order_id", part_by="order_id DIV 32768", latest=_lake_latest
    )
    for run, rows in (("one", lake.filter(CUT)), ("two", lake)):
        models.build_models(spark, [model], {"rows": rows}, root, run)
    return sinks.read_snapshot(spark, root, "sales")


@query
def csv_seed(spark, folder):
    """A table seeded from CSV; the second seed finds it and leaves it as it is."""
    root = shared_folder(spark, "csv-seed")
    lines = order_lines(spark, folder).select("order_id", "product", "quantity", "updated_at", "batch_id")
    for name, rows in (("first", lines.filter(CUT)), ("second", lines)):
        sinks.write_csv(rows, f"{root}/{name}")
        loads.seed_csv(spark, f"{root}/{name}", rows.schema, f"{root}/table")
    return spark.read.parquet(f"{root}/table")


@query
def table_append(spark, folder):
    """Create on the first write, append on the second, then read by name."""
    path = shared_folder(spark, "lines")
    name = "lines_" + path.rsplit("-", 1)[1]
    lake = _lake(spark, folder).select("order_id", "product", "updated_at", "total_amount", "category")
    sinks.append_table(lake.filter(CUT), name, ["category"], path)
    sinks.append_table(lake.filter(f"NOT ({CUT})"), name, ["category"], path)
    return sources.read_table(spark, name)


@query
def table_replace(spark, folder):
    path = shared_folder(spark, "daily")
    name = "daily_" + path.rsplit("-", 1)[1]
    latest = _lake_latest(_lake(spark, folder))
    sinks.replace_table(metrics.daily_category_sales(latest.filter(CUT), True), name, ["category"], path)
    sinks.replace_table(metrics.daily_category_sales(latest, True), name, ["category"], path)
    return sources.read_table(spark, name)


# Streams -------------------------------------------------------------------


def _landed(spark, messages: DataFrame, compression: str | None = None) -> str:
    path = shared_folder(spark, "landing")
    sinks.write_messages(messages, path, compression)
    return path


@query
def stream_parquet(spark, folder):
    root = shared_folder(spark, "stream")
    messages = streams.file_messages(spark, _landed(spark, _sale_messages(spark, folder)))
    rows = jobs.sales_from_messages(messages, SALE_MESSAGE)
    jobs.start_parquet(rows, f"{root}/sales", f"{root}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{root}/sales")


@query
def stream_upsert(spark, folder):
    root = shared_folder(spark, "stream")
    messages = streams.file_messages(spark, _landed(spark, _sale_messages(spark, folder), "gzip"), 2)
    jobs.start_upsert(
        messages, SALE_MESSAGE, "order_id", [F.desc("updated_at"), F.desc("batch_id")],
        f"{root}/sales", f"{root}/checkpoint", 16, ["updated_at", "batch_id"],
    ).awaitTermination()
    columns = T.StructType([*SALE_MESSAGE.fields, T.StructField("total_amount", T.DecimalType(23, 2))])
    return sinks.read_buckets(spark, f"{root}/sales", columns)


def _event_log(spark, folder) -> str:
    root = shared_folder(spark, "events")
    landing = _landed(spark, _event_messages(spark, folder))
    cdc.ingest(spark, streams.json_events(spark, landing, ORDER_EVENT_SCHEMA, 2), root, NTZ, 2)
    return root


def _half_compacted(spark, folder) -> str:
    """The same log with the first half of its batches compacted."""

    def run(root):
        landing = _landed(spark, _event_messages(spark, folder))
        cdc.ingest(spark, streams.json_events(spark, landing, ORDER_EVENT_SCHEMA, 2), root, NTZ, 2)
        _, last = jobs.new_batches(spark, f"{root}/events", {})
        jobs.compact_log(spark, f"{root}/events", "half", {name: number // 2 for name, number in last.items()})

    return _once(spark, folder, "events-half", run)


@query
def compacted_changes(spark, folder):
    return jobs.silver_changes(spark, f"{_half_compacted(spark, folder)}/events").select(
        "order_id", "customer_id", "updated_at", "operation", "total_amount", RESCUED
    )


@query
def compacted_quarantine(spark, folder):
    return jobs.quarantine(spark, f"{_half_compacted(spark, folder)}/events").select(
        "order_id", "updated_at", "quality_reason", "operation"
    )


@query
def stream_bronze(spark, folder):
    """Events as they came in: texts unjudged, the undeclared field rescued."""
    rows = cdc.read_bronze(spark, _event_log(spark, folder))
    return rows.select(
        "order_id", "customer_id", "order_timestamp", "quantity", "unit_price", "operation", RESCUED,
        F.col("_source_file").isNotNull().alias("has_source_file"),
        F.col("_ingested_at").isNotNull().alias("has_ingest_time"),
    )


@query
def stream_changes(spark, folder):
    root = _event_log(spark, folder)
    return jobs.silver_changes(spark, f"{root}/events").select(
        "order_id", "customer_id", "updated_at", "operation", "total_amount", RESCUED
    )


@query
def stream_quarantine(spark, folder):
    root = _event_log(spark, folder)
    return jobs.quarantine(spark, f"{root}/events").select("order_id", "updated_at", "quality_reason", "operation")


@query
def stream_dropped(spark, folder):
    root = _event_log(spark, folder)
    return jobs.dropped(spark, f"{root}/events").select("order_id", "updated_at", "operation")


@query
def stream_scd2(spark, folder):
    root = _event_log(spark, folder)
    rows = jobs.order_history(spark, f"{root}/events", [F.desc("order_timestamp")])
    return rows.drop("_ingested_at", "_source_file")


@query
def stream_history(spark, folder):
    """Type-2 history kept by a stream in two ingests, the earlier events coming in last."""
    root = shared_folder(spark, "history")
    events = _event_messages(spark, folder)
    early = F.get_json_object("value", "$.updated_at") < "2024-01-15"
    landing = f"{root}/landing"
    for part in (events.filter(~early), events.filter(early)):
        sinks.write_messages(part, landing)
        rows = streams.json_events(spark, landing, ORDER_EVENT_SCHEMA)
        stream_history_of.start_history(
            rows, f"{root}/orders", f"{root}/checkpoint", [F.desc("order_timestamp")], NTZ, 16
        ).awaitTermination()
    return stream_history_of.read_history(spark, f"{root}/orders").drop("_ingested_at", "_source_file")


@query
def stream_of_table(spark, folder):
    """A catalog table read as a stream and appended to a Parquet folder."""
    root = shared_folder(spark, "stream")
    name = "events_" + root.rsplit("-", 1)[1]
    events = order_events(spark, folder).select("order_id", "updated_at", "operation", "quantity")
    sinks.append_table(events, name, path=f"{root}/bronze")
    rows = streams.table_stream(spark, name)
    jobs.start_parquet(
        keep_expected(rows, ALLOWED_OPERATIONS), f"{root}/silver", f"{root}/checkpoint", every=None
    ).awaitTermination()
    return spark.read.parquet(f"{root}/silver")


# Pipelines -----------------------------------------------------------------

_runs: dict[tuple[str, str, str], str] = {}


def _once(spark, folder, name: str, run: Callable[[str], None]) -> str:
    """Run a pipeline once per application and table folder; several queries read its layers."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _runs or not sinks.path_exists(spark, _runs[key]):
        root = shared_folder(spark, name)
        run(root)
        _runs[key] = root
    return _runs[key]


def _medallion(spark, folder) -> medallion.Layout:
    """Two runs: the source before 2000, then whatever follows the watermark."""

    def run(root):
        source = order_lines(spark, folder)
        medallion.run(spark, source.filter(CUT), medallion.Layout(root))
        medallion.run(spark, source, medallion.Layout(root))

    return medallion.Layout(_once(spark, folder, "medallion", run))


@query
def medallion_silver(spark, folder):
    rows = sinks.read_snapshot(spark, _medallion(spark, folder).silver, "retail_sales")
    return rows.select(
        "order_id", "customer_name", "category", "city", "total_amount",
        F.col("source_updated_at").cast(NTZ).alias("source_updated_at"),
    )


@query
def medallion_gold(spark, folder):
    return sinks.read_snapshot(spark, _medallion(spark, folder).gold, "category_sales").drop("last_refreshed_at")


@query
def medallion_report(spark, folder):
    """One quality report row per run."""
    return spark.read.parquet(_medallion(spark, folder).reports).select(
        F.when(F.col("batch_id") == "initial", "initial").otherwise("incremental").alias("run"),
        "bronze_count", "valid_batch_count", "quarantined_count", "silver_count", "silver_revenue", "status",
    )


@query
def quality_gate(spark, folder):
    """The cross-layer checks of the second run's batch."""
    layout = _medallion(spark, folder)
    batch = f"after_{_last_before_cut(spark, layout)}"
    return medallion.gate(spark, layout, batch)


@query
def quality_gate_damaged(spark, folder):
    """The same checks over layers with rows taken away, doubled and changed: every line counts something."""
    layout = _medallion(spark, folder)
    bronze = sources.read_batch(spark, layout.bronze, f"after_{_last_before_cut(spark, layout)}")
    valid, rejected = classify_bronze(bronze)
    quarantine = rejected.filter("order_id % 7 <> 0")
    silver = medallion.read_silver(spark, layout)
    damaged = silver.filter("order_id % 11 <> 0").unionByName(silver.filter("order_id % 13 = 0")).withColumn(
        "price", F.when(F.col("order_id") % 17 == 0, -F.col("price")).otherwise(F.col("price"))
    )
    gold = medallion.read_gold(spark, layout)
    short = {**gold, "category_sales": gold["category_sales"].filter("category <> 'ECONOMY'")}
    lines = checks.medallion_gate(
        checks.batch_counts(bronze, valid, rejected, quarantine), latest_silver(valid), rejected, quarantine, damaged, short
    )
    return lines


def _last_before_cut(spark, layout) -> str:
    row = spark.read.parquet(layout.control).orderBy("updated_at_us", "order_id").limit(1).first()
    return f"{row['updated_at_us']}_{row['order_id']}"


def _lakehouse(spark, folder) -> str:
    def run(root):
        source = order_lines(spark, folder).select(*LAKE_COLUMNS)
        lakehouse.run(spark, source.filter(CUT), root, _lake_order(), 16, NTZ)
        lakehouse.run(spark, source, root, _lake_order(), 16, NTZ)

    return _once(spark, folder, "lakehouse", run)


@query
def lakehouse_silver(spark, folder):
    return lakehouse.read_silver(spark, _lakehouse(spark, folder), NTZ)


@query
def lakehouse_gold(spark, folder):
    return sinks.read_snapshot(spark, f"{_lakehouse(spark, folder)}/gold", "daily_category_sales")


@query
def lakehouse_restart(spark, folder):
    """A run that broke off after staging its buckets; the source grows before the next run finishes it."""
    root = shared_folder(spark, "restart")
    source = order_lines(spark, folder).select(*LAKE_COLUMNS)
    lakehouse.run(spark, source.filter(CUT), root, _lake_order(), 16, NTZ)
    half = source.filter("updated_at < TIMESTAMP_NTZ '2000-07-01 00:00:00'")
    batch_id, bronze = lakehouse.extract(spark, half, root)
    latest = _lake_latest(classify_lake_rows(bronze, NTZ)[0])
    sinks.stage_buckets(latest, f"{root}/silver", ["order_id"], batch_id, 16, ["updated_at"])
    lakehouse.run(spark, source, root, _lake_order(), 16, NTZ)
    lakehouse.run(spark, source, root, _lake_order(), 16, NTZ)
    return lakehouse.read_silver(spark, root, NTZ)


def _cdc(spark, folder) -> str:
    def run(root):
        landing = _landed(spark, _event_messages(spark, folder))
        cdc.ingest(spark, streams.json_events(spark, landing, ORDER_EVENT_SCHEMA, 2), root, NTZ, 2)
        cdc.publish(spark, root, "one", [F.desc("order_timestamp")])

    return _once(spark, folder, "cdc", run)


@query
def cdc_daily_sales(spark, folder):
    return sinks.read_snapshot(spark, f"{_cdc(spark, folder)}/published", "gold_daily_sales")


def _cdc_late(spark, folder) -> str:
    """Two publications, the earlier events coming in last."""

    def run(root):
        events = _event_messages(spark, folder)
        early = F.get_json_object("value", "$.updated_at") < "2024-01-15"
        for name, part in (("one", events.filter(~early)), ("two", events.filter(early))):
            sinks.write_messages(part, f"{root}/landing")
            cdc.ingest(spark, streams.json_events(spark, f"{root}/landing", ORDER_EVENT_SCHEMA), root, NTZ)
            cdc.publish(spark, root, name, [F.desc("order_timestamp")])

    return _once(spark, folder, "cdc-late", run)


@query
def cdc_daily_sales_late(spark, folder):
    """Daily sales after a second publication that took orders out of their days and put them into others."""
    return sinks.read_snapshot(spark, f"{_cdc_late(spark, folder)}/published", "gold_daily_sales")


@query
def cdc_history_late(spark, folder):
    """The history of the same two publications."""
    rows = sinks.read_snapshot(spark, f"{_cdc_late(spark, folder)}/published", "silver_orders_history")
    return rows.drop("_ingested_at", "_source_file")


def _models(spark, folder) -> tuple[str, DataFrame]:
    """The model graph built twice: on the history of the early events, then on all of it."""
    changes = _changes(spark, folder)
    root = shared_folder(spark, "models")
    early = write_and_reread(_history(changes.filter(EVENT_CUT)), "history")
    sources_of = {"silver_orders_history": early}
    models.build_models(spark, models.RETAIL_MODELS, sources_of, root, "one", stamp())
    sources_of = {"silver_orders_history": write_and_reread(_history(changes), "history")}
    return root, models.build_models(spark, models.RETAIL_MODELS, sources_of, root, "two", later())


@query
def model_graph(spark, folder):
    root, _ = _models(spark, folder)
    return sinks.read_snapshot(spark, root, "mart_daily_sales")


@query
def model_tests(spark, folder):
    return _models(spark, folder)[1]


@query
def model_tests_after_deletes(spark, folder):
    """The second build comes after all orders of one customer and of one product were deleted.

    The incremental fact keeps their rows, so the two tests of known keys count orphans.
    """
    changes = _changes(spark, folder)
    root = shared_folder(spark, "models")
    early = write_and_reread(_history(changes.filter(EVENT_CUT)), "history")
    models.build_models(spark, models.RETAIL_MODELS, {"silver_orders_history": early}, root, "one", stamp())
    later_on = F.col("updated_at") + F.expr("INTERVAL 400 DAYS")
    deleted = changes.filter("customer_id = 'C3' OR product_id = 'P3'").withColumns(
        {"updated_at": later_on, "operation": F.lit("DELETE")}
    )
    late = write_and_reread(_history(changes.unionByName(deleted)), "history")
    return models.build_models(spark, models.RETAIL_MODELS, {"silver_orders_history": late}, root, "two", later())


@query
def model_snapshot(spark, folder):
    root, _ = _models(spark, folder)
    return sinks.read_snapshot(spark, root, "customer_snapshot")
