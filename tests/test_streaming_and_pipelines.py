import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cornerstore.contracts import ORDER_EVENT_SCHEMA, SALES_SCHEMA
from cornerstore.functions.messages import RESCUED, parse_with_rescue
from cornerstore.operators import checks, history, metrics
from cornerstore.operators.watermark import Watermark, load_watermark
from cornerstore.plans import cdc, lakehouse, loads, medallion, models
from cornerstore.schemas import schema
from cornerstore.sinks import files as sinks, jdbc
from cornerstore.sources import streams
from cornerstore.streaming import jobs

SALES = [
    (1001, "Alice", "Laptop", "Electronics", 85000, 1, "Bangalore"),
    (1002, "Bob", "Mouse", "Electronics", 500, 2, "Hyderabad"),
    (1003, "Charlie", "Keyboard", "Electronics", 1200, 1, "Chennai"),
]
NAMES = [f.name for f in SALES_SCHEMA]


def land(folder, name, *messages):
    with open(f"{folder}/{name}", "w") as out:
        for message in messages:
            out.write((message if isinstance(message, str) else json.dumps(message)) + "\n")


def sale(row, **changes):
    return {**dict(zip(NAMES, row)), **changes}


def test_stream_to_parquet_is_exactly_once(spark, folder):
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    land(landing, "a.json", *(sale(row) for row in SALES), "not json")

    def drain():
        rows = jobs.sales_from_messages(streams.file_messages(spark, str(landing)), SALES_SCHEMA)
        jobs.start_parquet(rows, f"{folder}/out", f"{folder}/cp", every=None).awaitTermination()

    drain()
    drain()
    land(landing, "b.json", sale(SALES[0], order_id=2000, price=2000000000, quantity=2))
    drain()
    out = {r.order_id: r.total_amount for r in spark.read.parquet(f"{folder}/out").collect()}
    assert out == {1001: 85000, 1002: 1000, 1003: 1200, None: None, 2000: None}


def test_stream_upsert_with_dead_letters(spark, folder):
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    message = schema(**{n: {"order_id": "int", "price": "int", "quantity": "int"}.get(n, "string") for n in NAMES}, seq="int")
    root = f"{folder}/sales"

    def drain():
        jobs.start_upsert(
            streams.file_messages(spark, str(landing), 1), message, "order_id", [F.desc("seq")], root,
            f"{folder}/cp", 4,
        ).awaitTermination()
        columns = [F.col("order_id"), F.col("city"), F.col("total_amount")]
        stored = schema(**{**{f.name: f.dataType.simpleString().replace("bigint", "long") for f in message}, "total_amount": "int"})
        return sorted(map(tuple, sinks.read_buckets(spark, root, stored).select(*columns).collect()))

    land(landing, "a.json", sale(SALES[0], seq=2, city="Late"), sale(SALES[0], seq=1), sale(SALES[1], seq=1), "broken {")
    assert drain() == [(1001, "Late", 85000), (1002, "Hyderabad", 1000)]
    land(landing, "b.json", sale(SALES[1], seq=5, quantity=3), sale(SALES[2], seq=1))
    assert drain() == [(1001, "Late", 85000), (1002, "Hyderabad", 1500), (1003, "Chennai", 1200)]
    assert drain() == [(1001, "Late", 85000), (1002, "Hyderabad", 1500), (1003, "Chennai", 1200)]
    letters = spark.read.schema("value string").parquet(f"{root}/dead_letters/batch=*")
    assert [r.value for r in letters.collect()] == ["broken {"]


def test_replayed_batch_overwrites_its_own_log(spark, folder):
    names = []
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    land(landing, "a.json", {"k": 1})
    rows = streams.file_messages(spark, str(landing))
    jobs.start_batches(rows, lambda batch, name: names.append(name), f"{folder}/cp1").awaitTermination()
    jobs.start_batches(rows, lambda batch, name: names.append(name), f"{folder}/cp2").awaitTermination()
    assert len(set(names)) == 2 and all(name.endswith("-0") and not name.startswith("None") for name in names)


def test_failing_batch_stops_the_stream_and_is_replayed(spark, folder):
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    land(landing, "a.json", {"k": 1})
    seen = []

    def handle(batch, name):
        seen.append(name)
        if len(seen) == 1:
            raise RuntimeError("first attempt")

    for attempt in range(2):
        query = jobs.start_batches(streams.file_messages(spark, str(landing)), handle, f"{folder}/cp")
        if attempt == 0:
            with pytest.raises(Exception):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert len(seen) == 2 and seen[0] == seen[1]


def test_rescue_keeps_unknown_and_mistyped_fields(spark):
    df = spark.createDataFrame(
        [('{"a": "x", "n": 5}',), ('{"a": "x", "n": "many", "extra": true}',), ("oops",), ('{"n": null}',)], "value string"
    )
    rows = df.select(parse_with_rescue(F.col("value"), schema(a="string", n="int")).alias("d")).select("d.*").collect()
    assert [(r.a, r.n) for r in rows] == [("x", 5), ("x", None), (None, None), (None, None)]
    assert rows[0][RESCUED] is None and rows[3][RESCUED] is None
    assert json.loads(rows[1][RESCUED]) == {"n": "many", "extra": "true"}
    assert json.loads(rows[2][RESCUED]) == {"_corrupt": "oops"}


def event(order, customer, at, updated, quantity, price, operation, **more):
    return {
        "order_id": order, "customer_id": customer, "customer_name": "N" + str(customer),
        "customer_email": f"{customer}@Mail", "product_id": "P" + order[-1], "product_name": "Thing",
        "category": "Office", "store_id": "S1", "order_timestamp": at, "updated_at": updated,
        "quantity": quantity, "unit_price": price, "operation": operation, **more,
    }


FEED = [
    event("O1", "C1", "2026-08-15T10:10:00", "2026-08-15T10:10:01", 2, 35.5, "INSERT"),
    event("O2", "C2", "2026-08-15T11:15:00", "2026-08-15T11:15:01", 1, 79.99, "INSERT"),
    event("O3", "C3", "2026-08-16T08:30:00", "2026-08-16T08:30:01", 3, 49.0, "INSERT"),
    event("O2", "C2", "2026-08-15T11:15:00", "2026-08-16T09:00:00", 2, 79.99, "UPDATE"),
    event("BAD", None, "2026-08-16T09:30:00", "2026-08-16T09:30:01", 0, -5.0, "INSERT"),
    event("O3", "C3", "2026-08-16T08:30:00", "2026-08-17T08:30:01", 3, 49.0, "DELETE"),
    event("O4", "C4", "2026-08-16T08:30:00", "2026-08-17T08:30:01", 3, 49.0, "REFRESH"),
]


def test_log_without_rejected_events(spark, folder):
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    land(landing, "a.json", FEED[0])
    cdc.ingest(spark, streams.json_events(spark, str(landing), ORDER_EVENT_SCHEMA), folder)
    assert jobs.quarantine(spark, f"{folder}/events").count() == 0
    assert jobs.dropped(spark, f"{folder}/events").count() == 0
    assert jobs.silver_changes(spark, f"{folder}/events").count() == 1


def test_change_feed_to_history(spark, folder):
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    # The update of O2 comes in before its insert.
    land(landing, "a.json", FEED[3], FEED[0], FEED[4])
    land(landing, "b.json", FEED[1], FEED[2], FEED[5], FEED[6])
    cdc.ingest(spark, streams.json_events(spark, str(landing), ORDER_EVENT_SCHEMA, 1), folder, files_per_trigger=1)
    cdc.ingest(spark, streams.json_events(spark, str(landing), ORDER_EVENT_SCHEMA, 1), folder, files_per_trigger=1)
    log = f"{folder}/events"
    assert cdc.read_bronze(spark, folder).count() == len(FEED)
    assert jobs.silver_changes(spark, log).count() == 5
    assert [r.quality_reason for r in jobs.quarantine(spark, log).collect()] == ["missing_required_field"]
    assert [r.order_id for r in jobs.dropped(spark, log).collect()] == ["O4"]
    history = jobs.order_history(spark, log, [F.desc("order_timestamp")])
    versions = sorted((r.order_id, str(r["__START_AT"]), str(r["__END_AT"])) for r in history.collect())
    assert versions == [
        ("O1", "2026-08-15 10:10:01", "None"),
        ("O2", "2026-08-15 11:15:01", "2026-08-16 09:00:00"),
        ("O2", "2026-08-16 09:00:00", "None"),
        ("O3", "2026-08-16 08:30:01", "2026-08-17 08:30:01"),
    ]
    assert "operation" not in history.columns and RESCUED not in history.columns
    assert "_source_file" in history.columns
    cdc.publish(spark, folder, "p1")
    gold = sinks.read_snapshot(spark, f"{folder}/published", "gold_daily_sales").collect()
    assert [(str(r.order_date), r.order_count, r.gross_sales) for r in gold] == [("2026-08-15", 2, Decimal("230.98"))]


def test_history_is_renewed_for_touched_buckets_only(spark, folder):
    from cornerstore.streaming import history as kept

    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    by_number = F.substring("order_id", 2, 9).cast("int")

    def ingest():
        rows = streams.json_events(spark, str(landing), ORDER_EVENT_SCHEMA)
        kept.start_history(rows, f"{folder}/h", f"{folder}/cp", bucket_by=by_number).awaitTermination()
        return sorted((r.order_id, str(r["__START_AT"])[5:16], str(r["__END_AT"])[5:16]) for r in kept.read_history(spark, f"{folder}/h").collect())

    # The later events come in first.
    land(landing, "a.json", FEED[3], FEED[0], FEED[4], FEED[5])
    assert ingest() == [("O1", "08-15 10:10", ""), ("O2", "08-16 09:00", "")]
    old = {p: p.stat().st_mtime_ns for part in ("changes", "history") for p in __import__("pathlib").Path(folder, f"h/{part}/state/_bucket=1").iterdir()}
    land(landing, "b.json", FEED[1], FEED[2], FEED[6], FEED[1])
    after = [
        ("O1", "08-15 10:10", ""), ("O2", "08-15 11:15", "08-16 09:00"), ("O2", "08-16 09:00", ""),
        ("O3", "08-16 08:30", "08-17 08:30"),
    ]
    assert ingest() == after
    assert old and all(p.stat().st_mtime_ns == at for p, at in old.items())
    again = spark.read.parquet(f"{folder}/h/changes/state").drop("_bucket")
    kept.update_history(again, f"{folder}/h", "replayed", bucket_by=by_number)
    assert ingest() == after


# Batch pipelines -----------------------------------------------------------

SOURCE = (
    "order_id long, customer_name string, product string, category string, price decimal(12,2), quantity int, "
    "city string, order_date string, at string"
)


def source(spark, *rows):
    df = spark.createDataFrame([(i, n, p, c, Decimal(price), q, t, d, at) for i, n, p, c, price, q, t, d, at in rows], SOURCE)
    return df.withColumn("order_date", F.to_date("order_date")).withColumn("updated_at", F.col("at").cast("timestamp")).drop("at")


FIRST = [
    (1, "Asha", "Laptop", "Electronics", "65000", 1, "Pune", "2026-08-01", "2026-08-01 00:00:00"),
    (2, "Ravi", "Phone", "Electronics", "30000", 2, "Mumbai", "2026-08-02", "2026-08-02 00:00:00"),
    (3, "Nina", "Desk", "Furniture", "12000", 1, "Bengaluru", "2026-08-02", "2026-08-02 00:00:00"),
    (4, "Vikram", "Chair", "Furniture", "7000", 0, "Delhi", "2026-08-03", "2026-08-03 00:00:00"),
]
MORE = [
    (2, "Ravi", "Phone", "Phones", "30000", 1, "Mumbai", "2026-08-02", "2026-08-04 00:00:00"),
    (5, "Uma", "Lamp", "Furniture", "1000", 1, "Pune", "2026-08-04", "2026-08-03 00:00:00"),
]


def test_medallion_runs_incrementally(spark, folder):
    layout = medallion.Layout(folder)
    one = medallion.run(spark, source(spark, *FIRST), layout)
    assert (one["status"], one["checks_passed"], one["batch_id"]) == ("success", 8, "initial")
    assert medallion.run(spark, source(spark, *FIRST), layout)["status"] == medallion.NO_CHANGES
    two = medallion.run(spark, source(spark, *FIRST, *MORE), layout)
    assert two["watermark"].order_id == 2
    assert medallion.run(spark, source(spark, *FIRST, *MORE), layout)["status"] == medallion.NO_CHANGES
    silver = {r.order_id: r.total_amount for r in sinks.read_snapshot(spark, layout.silver, "retail_sales").collect()}
    assert silver == {1: Decimal(65000), 2: Decimal(30000), 3: Decimal(12000), 5: Decimal(1000)}
    gold = medallion.read_gold(spark, layout)
    assert gold["overall_sales"].first().total_revenue == Decimal(108000)
    assert {r.category for r in gold["category_sales"].collect()} == {"Electronics", "Phones", "Furniture"}
    reports = spark.read.parquet(layout.reports).orderBy("checked_at").collect()
    assert [(r.bronze_count, r.quarantined_count, r.silver_count) for r in reports] == [(4, 1, 3), (2, 0, 4)]


def test_bucketed_silver_equals_the_snapshot(spark, folder):
    stored = {}
    for buckets in (0, 4):
        layout = medallion.Layout(f"{folder}/{buckets}", silver_buckets=buckets)
        medallion.run(spark, source(spark, *FIRST), layout)
        assert medallion.run(spark, source(spark, *FIRST, *MORE), layout)["checks_passed"] == 8
        rows = medallion.read_silver(spark, layout).select("order_id", "category", "total_amount", "source_updated_at")
        stored[buckets] = sorted(map(tuple, rows.collect()))
    assert stored[0] == stored[4] and len(stored[0]) == 4


def test_broken_off_run_is_taken_up_again(spark, folder):
    layout = medallion.Layout(folder)
    batch = medallion.extract(spark, source(spark, *FIRST), layout)
    medallion.transform(spark, layout, batch)
    medallion.transform(spark, layout, batch)
    result = medallion.run(spark, source(spark, *FIRST), layout)
    assert result["status"] == "success"
    assert sinks.read_snapshot(spark, layout.silver, "retail_sales").count() == 3
    assert spark.read.schema("order_id long").parquet(layout.quarantine).count() == 1


def test_failed_gate_holds_the_watermark_back(spark, folder):
    layout = medallion.Layout(folder)
    batch = medallion.extract(spark, source(spark, *FIRST), layout)
    medallion.transform(spark, layout, batch)
    medallion.aggregate(spark, layout, "g1")
    silver = sinks.read_snapshot(spark, layout.silver, "retail_sales")
    sinks.publish_snapshots({"retail_sales": silver.unionByName(silver.limit(1))}, layout.silver, "broken")
    with pytest.raises(checks.QualityError, match="silver_orders_unique"):
        medallion.commit(spark, layout, batch)
    assert load_watermark(spark, layout.control) is None


def test_gate_scans_silver_once(spark, folder):
    layout = medallion.Layout(folder)
    batch = medallion.run(spark, source(spark, *FIRST), layout)["batch_id"]
    # Spark cuts a scan's location in the plan text after so many characters.
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        plan = medallion.gate(spark, layout, batch)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("/silver/") == 1


def test_gate_compares_the_serving_store(spark, folder):
    layout = medallion.Layout(folder)
    served = medallion.run(spark, source(spark, *FIRST), layout, publish=lambda gold: gold)
    assert served["checks_passed"] == 10
    gold = medallion.read_gold(spark, layout)
    short = {**gold, "city_sales": gold["city_sales"].limit(1)}
    lines = {r.check_name: r.passed for r in medallion.gate(spark, layout, served["batch_id"], short).collect()}
    assert not lines["serving_counts"] and lines["serving_revenue_matches"]
    targets = medallion.serving_datasets(gold)
    assert targets["top_products"][1] == "analytics_top_products"


def test_serving_tables_are_loaded_and_read_back(spark, folder, monkeypatch):
    """The publication through stand-ins: what is staged is what the gate reads."""
    layout = medallion.Layout(folder)
    served = {}

    def publish(datasets, database, load_id, target_ddl):
        assert len(target_ddl) == 6 and target_ddl[0] == (
            "CREATE TABLE IF NOT EXISTS analytics_overall_sales (metric_scope VARCHAR(100) NOT NULL, "
            "total_revenue NUMERIC(20,2) NOT NULL, order_count BIGINT NOT NULL, units_sold BIGINT NOT NULL, "
            "average_order_value NUMERIC(20,2) NOT NULL, distinct_customers BIGINT NOT NULL, "
            "last_refreshed_at TIMESTAMP WITH TIME ZONE NOT NULL, PRIMARY KEY (metric_scope))"
        )
        served.update({table: df for df, table, _ in datasets.values()})

    monkeypatch.setattr(medallion, "publish_jdbc", publish)
    monkeypatch.setattr(medallion, "read_jdbc", lambda spark, database, table: served[table])
    publisher = medallion.jdbc_publisher(spark, jdbc.Database("jdbc:x"), "l1")
    assert medallion.run(spark, source(spark, *FIRST), layout, publish=publisher)["checks_passed"] == 10


def test_stream_upsert_into_a_database(spark, folder, monkeypatch):
    (landing := __import__("pathlib").Path(folder) / "in").mkdir()
    land(landing, "a.json", sale(SALES[0]), sale(SALES[0]), sale(SALES[1]), "broken {")
    calls = []

    def upsert(df, database, target, keys, load_id, dialect):
        calls.append((target, keys, load_id, dialect, sorted(r.total_amount for r in df.collect())))

    monkeypatch.setattr(jobs, "upsert_jdbc", upsert)
    jobs.start_jdbc_upsert(
        streams.file_messages(spark, str(landing)), SALES_SCHEMA, "order_id", [F.desc("_source_file")],
        jdbc.Database("jdbc:x"), "streaming_sales", f"{folder}/dead", f"{folder}/cp",
    ).awaitTermination()
    (target, keys, load_id, dialect, amounts), = calls
    assert (target, keys, dialect, amounts) == ("streaming_sales", ["order_id"], "postgresql", [1000, 85000])
    assert load_id.isidentifier() or load_id.replace("_", "a").isalnum()


def test_lakehouse_run(spark, folder):
    one = lakehouse.run(spark, source(spark, *FIRST), folder, buckets=4)
    assert (one["extracted"], one["valid"], one["rejected"], one["silver"]) == (4, 3, 1, 3)
    assert lakehouse.run(spark, source(spark, *FIRST), folder, buckets=4)["status"] == "no_changes"
    two = lakehouse.run(spark, source(spark, *FIRST, *MORE), folder, buckets=4)
    assert (two["extracted"], two["silver"], two["silver_revenue"]) == (2, 4, "108000.00")
    # The order that changed its category is there once.
    assert [r.category for r in lakehouse.read_silver(spark, folder).filter("order_id = 2").collect()] == ["Phones"]
    gold = sinks.read_snapshot(spark, f"{folder}/gold", "daily_category_sales")
    assert gold.agg(F.sum("total_revenue")).first()[0] == Decimal(108000)
    assert load_watermark(spark, f"{folder}/control/watermarks") == Watermark(1785801600000000, 2)


def test_lakehouse_finishes_a_broken_off_run(spark, folder, monkeypatch):
    """The run dies after its buckets are staged; the source has grown when it is run again."""
    late = (6, "Zoe", "Lamp", "Furniture", "500", 1, "Pune", "2026-08-05", "2026-08-05 00:00:00")
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "move_buckets", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lakehouse.run(spark, source(spark, *FIRST), folder, buckets=4)
    retry = lakehouse.run(spark, source(spark, *FIRST, *MORE, late), folder, buckets=4)
    assert (retry["extracted"], retry["valid"], retry["rejected"], retry["silver"]) == (4, 3, 1, 3)
    rest = lakehouse.run(spark, source(spark, *FIRST, *MORE, late), folder, buckets=4)
    assert (rest["extracted"], rest["silver"]) == (3, 5)
    assert {r.order_id for r in lakehouse.read_silver(spark, folder).collect()} == {1, 2, 3, 5, 6}
    assert lakehouse.run(spark, source(spark, *FIRST, *MORE, late), folder, buckets=4)["status"] == "no_changes"


def test_lakehouse_stops_if_quarantine_is_short(spark, folder, monkeypatch):
    whole = lakehouse.classify_lake_rows
    monkeypatch.setattr(lakehouse, "classify_lake_rows", lambda *a: (whole(*a)[0], whole(*a)[1].limit(0)))
    with pytest.raises(checks.QualityError, match="stored quarantine"):
        lakehouse.run(spark, source(spark, *FIRST), folder, buckets=4)
    assert load_watermark(spark, f"{folder}/control/watermarks") is None


def test_lakehouse_ranges_rewrite_only_recent_orders(spark, folder):
    ranges = F.expr("order_id DIV 3")
    lakehouse.run(spark, source(spark, *FIRST), folder, bucket_by=ranges)
    old = {p: p.stat().st_mtime_ns for p in __import__("pathlib").Path(folder, "silver/state/_bucket=0").glob("*.parquet")}
    lakehouse.run(spark, source(spark, *FIRST, MORE[1]), folder, bucket_by=ranges)
    assert old and all(p.exists() and p.stat().st_mtime_ns == at for p, at in old.items())


def test_gold_is_laid_out_by_day(spark, folder):
    lakehouse.run(spark, source(spark, *FIRST), folder, buckets=4)
    path = sinks.current_path(spark, f"{folder}/gold", "daily_category_sales")
    assert {p.name for p in __import__("pathlib").Path(path).glob("order_date=*")} == {"order_date=2026-08-01", "order_date=2026-08-02"}


def test_star_load_is_one_publication(spark, folder, monkeypatch):
    sales = source(spark, *FIRST[:2])
    commit = loads.commit_snapshots
    monkeypatch.setattr(loads, "commit_snapshots", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        loads.load_star(spark, sales, folder, "one")
    assert sinks.current_paths(spark, folder) == {}
    monkeypatch.setattr(loads, "commit_snapshots", commit)
    loads.load_star(spark, sales, folder, "one")
    first = sinks.current_path(spark, folder, "fact_sales")
    files = {p.name: p.stat().st_mtime_ns for p in __import__("pathlib").Path(first).iterdir()}
    again = loads.load_star(spark, sales, folder, "one")
    assert again["fact_sales"].count() == 2
    two = loads.load_star(spark, source(spark, FIRST[2]), folder, "two")
    assert sorted(r.order_id for r in two["fact_sales"].collect()) == [1, 2, 3]
    assert {p.name: p.stat().st_mtime_ns for p in __import__("pathlib").Path(first).iterdir()} == files


def test_warnings_are_reported_and_do_not_stop(spark, folder):
    model = models.Model(
        "numbers", lambda ref: ref("given"),
        tests=lambda rows, ref: {"numbers.id.unique": checks.duplicate_keys(rows, ["id"])},
        warnings=frozenset({"numbers.id.unique"}),
    )
    given = spark.createDataFrame([(1,), (1,)], "id int")
    lines = models.build_models(spark, [model], {"given": given}, folder, "r1").collect()
    assert [(r.check_name, r.failures, r.passed) for r in lines] == [("numbers.id.unique", 1, False)]


def test_model_tests_stop_the_run(spark, folder):
    bad = models.Model(
        "numbers", lambda ref: ref("given"),
        tests=lambda rows, ref: {"numbers.id.unique": checks.duplicate_keys(rows, ["id"])},
    )
    later = models.Model("after", lambda ref: pytest.fail("must not be built"))
    given = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(checks.QualityError, match="numbers.id.unique"):
        models.build_models(spark, [bad, later], {"given": given}, folder, "r1")


def built_parts(folder, name):
    return {p: p.stat().st_mtime_ns for p in __import__("pathlib").Path(folder, name).rglob("*.parquet")}


def orders_of(spark, *rows):
    return spark.createDataFrame([(k, name, amount, datetime(2026, 1, day)) for k, name, amount, day in rows], "id int, name string, amount int, updated_at timestamp")


KEPT_MODELS = [
    models.Model("facts", lambda ref: ref("given"), "incremental", "id", part_by="id DIV 10"),
    models.Model("names", lambda ref: ref("given").select("id", "name", "amount"), "snapshot", "id", ("name",), part_by="id DIV 10"),
]


def test_a_build_writes_only_the_parts_that_changed(spark, folder):
    """Incremental model and snapshot: files of untouched parts stay, rows come out as from a whole rewrite."""
    first = orders_of(spark, *((k, f"n{k}", k, 1) for k in range(50)))
    models.build_models(spark, KEPT_MODELS, {"given": first}, folder, "one", F.lit(datetime(2026, 2, 1)))
    before = built_parts(folder, "facts") | built_parts(folder, "names")
    # 3 changes its name, 17 its amount only, 60 is new, 44 comes late.
    second = first.filter("id not in (3, 17, 44)").unionByName(
        orders_of(spark, (3, "new", 3, 5), (17, "n17", 99, 5), (60, "n60", 1, 6), (44, "late", 7, 1))
    )
    models.build_models(spark, KEPT_MODELS, {"given": second}, folder, "two", F.lit(datetime(2026, 3, 1)))
    after = built_parts(folder, "facts") | built_parts(folder, "names")
    assert all(after[p] == at for p, at in before.items())
    new = {str(p.parent.relative_to(folder)) for p in after if p not in before}
    assert new == {f"facts/v=two/_part={k}" for k in (0, 1, 6)} | {f"names/v=two/_part={k}" for k in (0, 4, 6)}
    facts = {r.id: (r.name, r.amount) for r in sinks.read_snapshot(spark, folder, "facts").collect()}
    assert len(facts) == 51 and facts[3] == ("new", 3) and facts[17] == ("n17", 99) and facts[44] == ("n44", 44) and facts[60] == ("n60", 1)
    names = sinks.read_snapshot(spark, folder, "names")
    whole = history.check_snapshot(
        history.start_check_snapshot(first.select("id", "name", "amount"), F.lit(datetime(2026, 2, 1))),
        second.select("id", "name", "amount"), "id", ["name"], F.lit(datetime(2026, 3, 1)),
    )
    assert sorted(map(tuple, names.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert names.count() == 53


def test_a_build_that_broke_off_is_repeated_under_its_id(spark, folder):
    """Models that were published are read, the others built."""
    built = []

    def given(name, fails=False):
        def build(ref):
            built.append(name)
            if fails and built.count(name) == 1:
                raise OSError("lost")
            return ref("given")
        return build

    graph = [models.Model("one", given("one")), models.Model("two", given("two", True), "incremental", "id"), models.Model("three", given("three"))]
    rows = orders_of(spark, (1, "a", 1, 1), (2, "b", 2, 1))
    with pytest.raises(OSError):
        models.build_models(spark, graph, {"given": rows}, folder, "r1")
    files = built_parts(folder, "one")
    models.build_models(spark, graph, {"given": rows}, folder, "r1")
    assert built_parts(folder, "one") == files
    assert all(sinks.read_snapshot(spark, folder, name).count() == 2 for name in ("one", "two", "three"))


def test_medallion_with_silver_in_ranges(spark, folder):
    """A small batch waits as a delta, and the later stages see it."""
    layout = medallion.Layout(folder, bucket_by="order_id DIV 100")
    medallion.run(spark, source(spark, *FIRST), layout)
    assert medallion.read_silver(spark, layout).count() == 3
    later = [(9, "Zoe", "Lamp", "Furniture", "10", 1, "Pune", "2026-08-09", "2026-08-09 00:00:00")]
    result = medallion.run(spark, source(spark, *FIRST, *later), layout)
    assert result["status"] == "success"
    assert sorted(r.order_id for r in medallion.read_silver(spark, layout).collect()) == [1, 2, 3, 9]


def test_seed_from_csv(spark, folder):
    columns = schema(id="int", name="string")
    for text, wanted in (("id,name\n1,a\n2,\n", True), ("id,name\n3,c\n", False)):
        __import__("pathlib").Path(folder, "seed.csv").write_text(text)
        assert loads.seed_csv(spark, f"{folder}/seed.csv", columns, f"{folder}/t") is wanted
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/t").collect())) == [(1, "a"), (2, None)]


def gold_rows(spark, layout):
    return {name: sorted(map(tuple, df.drop("last_refreshed_at").collect()), key=str) for name, df in medallion.read_gold(spark, layout).items()}


def plain_gold(spark, layout):
    """The same datasets from all of Silver by the plain aggregates."""
    silver = medallion.read_silver(spark, layout)
    plain = medallion.kpi_datasets(silver)
    plain["top_products"] = metrics.rank_products(plain["product_sales"])
    wanted = medallion.read_gold(spark, layout)
    return {name: sorted(map(tuple, plain[name].select(*wanted[name].columns).drop("last_refreshed_at").collect()), key=str) for name in wanted}


def moved(day, *changes):
    """Source rows of a later day: order, customer, product, category, price, quantity, city."""
    return [(*c[:4], c[4], c[5], c[6], "2026-08-01", f"2026-08-{day:02d} 00:00:00") for c in changes]


@pytest.mark.parametrize("ranges", [None, "order_id DIV 2"])
def test_gold_follows_silver_by_changed_orders(spark, folder, ranges):
    """Orders change every field; customers and products go down to nothing and come back."""
    layout = medallion.Layout(folder, bucket_by=ranges)
    batches = [
        [*FIRST, (8, None, "Lamp", "Furniture", "1", 3, "Pune", "2026-08-01", "2026-08-03 00:00:00")],
        moved(10, (1, "Asha", "Phone", "Electronics", "10", 3, "Delhi"), (2, "Nina", "Desk", "Furniture", "1", 1, "Pune"), (9, "Zoe", "Lamp", "Home", "5", 1, "Pune")),
        moved(20, (1, "Ravi", "Phone", "Toys", "0.01", 7, "Delhi"), (9, "Ravi", "Lamp", "Home", "5", 2, "Pune"), (3, "Ravi", "Lamp", "Home", "3.33", 1, "Pune")),
    ]
    source_rows, files = [], {}
    for number, batch in enumerate(batches):
        source_rows += batch
        assert medallion.run(spark, source(spark, *source_rows), layout)["status"] == "success"
        assert gold_rows(spark, layout) == plain_gold(spark, layout)
        now = built_parts(folder, "gold/sales_cells")
        assert all(now[p] == at for p, at in files.items())
        files = now
    assert not sinks.names_of(spark, f"{layout.changes}/batch_id=*")
    medallion.aggregate(spark, layout, "again", rebuild=True)
    assert gold_rows(spark, layout) == plain_gold(spark, layout)


def test_gold_after_runs_that_broke_off(spark, folder, monkeypatch):
    """Changed orders are noted before Silver changes, and used once."""
    layout = medallion.Layout(folder)
    medallion.run(spark, source(spark, *FIRST), layout)
    rows = source(spark, *FIRST, *moved(10, (1, "Zoe", "Phone", "Toys", "10", 3, "Delhi"), (7, "Asha", "Phone", "Toys", "1", 1, "Pune")))

    def lost(*args, **more):
        raise OSError("lost")

    for name in ("publish_snapshots", "stage_parts", "commit_snapshots", "delete_path", "commit_watermark"):
        with monkeypatch.context() as patched, pytest.raises(OSError):
            patched.setattr(medallion, name, lost)
            medallion.run(spark, rows, layout)
    assert medallion.run(spark, rows, layout)["status"] == "success"
    assert gold_rows(spark, layout) == plain_gold(spark, layout)
    assert medallion.run(spark, rows, layout)["status"] == medallion.NO_CHANGES


def test_gold_does_not_hide_a_silver_changed_by_hand(spark, folder):
    layout = medallion.Layout(folder)
    medallion.run(spark, source(spark, *FIRST), layout)
    silver = sinks.read_snapshot(spark, layout.silver, "retail_sales")
    sinks.publish_snapshots({"retail_sales": silver.filter("order_id <> 1")}, layout.silver, "by-hand")
    with pytest.raises(checks.QualityError, match="differs from Silver"):
        medallion.aggregate(spark, layout, "g2")
    medallion.aggregate(spark, layout, "g3", rebuild=True)
    assert gold_rows(spark, layout) == plain_gold(spark, layout)
