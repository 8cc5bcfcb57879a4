"""Steps that must not do wide or repeated work, whatever the size."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from cornerstore.contracts import ORDER_EVENT_SCHEMA
from cornerstore.operators import checks, merge, metrics
from cornerstore.operators.clean import classify_bronze
from cornerstore.plans import lakehouse, medallion
from cornerstore.plans.inputs import bronze_lines, order_lines
from cornerstore.sinks import files as sinks
from cornerstore.sources import streams
from test_plans import FOLDER, plan_of
from test_streaming_and_pipelines import FIRST, MORE, source


def counted(spark, rows):
    """The rows, and how many of them were computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    return rows.withColumn("quantity", F.udf(count, T.IntegerType()).asNondeterministic()("quantity")), seen


def small(rows):
    return sorted(map(str, rows.collect()))


def test_medallion_extracts_from_one_pass_over_the_source(spark, folder):
    rows, seen = counted(spark, source(spark, *FIRST).coalesce(1))
    layout = medallion.Layout(folder)
    assert medallion.extract(spark, rows, layout, "one") == "one"
    assert seen.value == len(FIRST)
    assert medallion.extract(spark, rows.filter("false"), layout, "two") is None
    assert not medallion.has_batch(spark, layout.bronze, "two")
    with pytest.raises(FileExistsError):
        medallion.extract(spark, rows, layout, "one")


def test_lakehouse_extracts_from_one_pass_over_the_source(spark, folder):
    rows, seen = counted(spark, source(spark, *FIRST).coalesce(1))
    assert lakehouse.extract(spark, rows, folder)[1].count() == len(FIRST)
    assert seen.value == len(FIRST)


def test_a_batch_broken_off_before_its_rename_is_written_anew(spark, folder, monkeypatch):
    rows = source(spark, *FIRST)
    with monkeypatch.context() as patched:
        patched.setattr(sinks, "move_path", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lakehouse.extract(spark, rows, folder)
    assert lakehouse.extract(spark, rows, folder)[1].count() == len(FIRST)


def test_lines_are_shuffled_for_orders_and_parts_only(spark):
    """No table is broadcast but the nations: lines meet customers through the orders."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        plan = plan_of(order_lines(spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # A shuffle by customer lies below the join by order.
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    depth = lambda key: next(len(line) - len(line.lstrip(" :|+-")) for line in exchanges if key in line)
    assert depth("o_custkey") > depth("l_orderkey")


def test_the_gate_sorts_no_valid_rows(spark):
    valid, _ = classify_bronze(bronze_lines(spark, FOLDER))
    plan = plan_of(checks.newest_times(valid))
    assert "Window" not in plan and "HashAggregate" in plan and "SortAggregate" not in plan
    wanted = valid.groupBy("order_id").agg(F.max("source_updated_at").alias("t"))
    assert checks.newest_times(valid).exceptAll(wanted).isEmpty()


def test_kpis_of_cells_are_those_of_the_orders(spark):
    rows = [
        (1, "Electronics", "Pune", "Laptop", "Asha", 1, Decimal("10.00")), (2, "Electronics", "Pune", "Laptop", "Asha", 2, Decimal("5.50")),
        (3, "Furniture", None, "Desk", None, None, None), (4, "Furniture", "Pune", None, "Ravi", 3, None),
        (5, None, "Delhi", "Desk", "Ravi", None, Decimal("1.25")), (6, "Furniture", "Delhi", "Desk", None, 1, Decimal("0.01")),
        (7, "Electronics", "Delhi", "Desk", "Ravi", 1, Decimal("2.00")),
    ]
    kind = "order_id long, category string, city string, product string, customer_name string, quantity int, total_amount decimal(18,2)"
    orders = spark.createDataFrame(rows, kind)
    at = F.lit("2024-06-01").cast("timestamp")
    cells = metrics.add_sums(None, metrics.signed_sums(None, orders, metrics.CELL_KEYS), metrics.CELL_KEYS)
    wanted = medallion.kpi_datasets(orders, at)
    made = metrics.kpis_of_cells(cells, at)
    assert set(made) == set(wanted)
    for name, df in wanted.items():
        assert made[name].columns == df.columns and [f.dataType for f in made[name].schema] == [f.dataType for f in df.schema], name
        assert small(made[name]) == small(df), name


def test_a_marked_merge_is_the_merge_with_what_stood_there(spark):
    kind = "k long, at int, v string"
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (3, None, "c"), (4, 1, "d")], kind)
    new = spark.createDataFrame([(1, 2, "A"), (2, 4, "B"), (3, 1, "C"), (5, 1, "E")], kind)
    made = merge.merge_newer_marked(
        old.withColumn("was", F.col("v")), new.withColumn("was", F.lit(None).cast("string")), ["k"], ["at"], "came", ["was"]
    )
    assert small(made.select("k", "at", "v")) == small(merge.merge_newer(old, new, ["k"], ["at"]))
    assert {r["k"]: (r["came"], r["was"]) for r in made.collect()} == {
        1: (True, "a"), 2: (True, "b"), 3: (True, "c"), 4: (False, "d"), 5: (True, None)
    }


def test_a_large_batch_leaves_what_a_small_one_leaves(spark, folder):
    """The merge by one outer join publishes the same Silver and Gold as the one that broadcasts the batch."""
    left = {}
    for name, threshold in (("small", "10m"), ("large", "-1")):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            layout = medallion.Layout(f"{folder}/{name}")
            for rows in (FIRST, [*FIRST, *MORE]):
                assert medallion.run(spark, source(spark, *rows), layout)["status"] == "success"
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        gold = medallion.read_gold(spark, layout)
        left[name] = [
            small(medallion.read_silver(spark, layout).drop("processed_at", "source_ingested_at", "source_ingestion_date")),
            *(small(gold[n].drop("last_refreshed_at")) for n in sorted(gold)),
        ]
    assert left["small"] == left["large"]


def test_large_deltas_are_merged_by_one_join(spark, folder):
    """As if merged one by one, rows without a version included; the stored rows are shuffled once."""
    kind = "k long, at int, v string"
    batches = [
        [(1, 1, "a1"), (2, None, "a2"), (3, 5, "a3"), (4, 1, "a4")],
        [(1, 2, "b1"), (2, 9, "b2"), (3, 4, "b3"), (5, None, "b5"), (6, 3, "b6"), (7, 1, "b7")],
        [(1, 2, "c1"), (5, 9, "c5"), (6, None, "c6"), (7, 2, "c7"), (8, 1, "c8"), (4, None, "c4")],
    ]
    frames = [spark.createDataFrame(rows, kind) for rows in batches]
    wanted = frames[0]
    for frame in frames[1:]:
        wanted = merge.merge_newer(wanted, frame, ["k"], ["at"])
    for number, frame in enumerate(frames):
        sinks.upsert_buckets(frame, folder, ["k"], f"batch-{number}", 4, ["at"], delta_share=1e9)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert small(sinks.read_buckets(spark, folder, frames[0].schema)) == small(wanted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = sinks.read_buckets(spark, folder, frames[0].schema)
        assert plan_of(merged).count("Exchange hashpartitioning") == 2
        assert small(merged) == small(wanted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_lines_count_what_the_single_checks_count(spark):
    kind = "order_id long, quantity int, updated_at timestamp_ntz"
    sql = lambda values: spark.sql(f"SELECT * FROM VALUES {values} AS t(order_id, quantity, at)").select(
        F.col("order_id").cast("long"), "quantity", F.expr("CAST(at AS timestamp_ntz)").alias("updated_at"))
    silver = sql("(1, 1, '2026-01-02'), (1, 1, '2026-01-02'), (2, 0, '2026-01-01'), (3, 1, null), (6, 1, '2026-01-01'), (7, 1, '2026-01-01')")
    batch = sql("(1, 1, '2026-01-01'), (2, 1, '2026-01-03'), (2, 1, '2026-01-01'), (3, 1, '2026-01-01'), (4, 1, '2026-01-01'), (5, 1, null), (7, 1, '2026-01-01')")
    assert silver.schema.simpleString() == spark.createDataFrame([], kind).schema.simpleString()
    lines = checks.stored_lines(silver, batch, "updated_at", F.expr("quantity <= 0"))
    assert plan_of(lines).count("Exchange hashpartitioning") == 1
    newest = batch.groupBy("order_id").agg(F.max("updated_at").alias("updated_at"))
    assert {r["check_name"]: r["failures"] for r in lines.collect()} == {
        "silver_orders_unique": checks.duplicate_keys(silver, ["order_id"]).count(), "silver_rows_valid": 1,
        "batch_reached_silver": checks.lineage_gaps(newest, silver, "updated_at").count(),
    }


def test_a_growing_table_is_rewritten_about_once(spark, folder):
    """Twenty equal batches of new keys: merges rewrite a bounded share of what arrived, and no row is lost."""
    table = spark.range(40_000).selectExpr("cast(id as int) order_id", "sha2(cast(id as string), 256) v", "1 n")
    for number in range(20):
        sinks.upsert_buckets(table.filter(f"order_id % 20 = {number}"), folder, ["order_id"], f"t{number}", 4, ["n"])
    traffic = sinks._traffic(spark, folder)
    assert 0 < traffic["rewritten"] <= sinks.REWRITE_SHARE * traffic["arrived"]
    assert small(sinks.read_buckets(spark, folder, table.schema)) == small(table)


@pytest.mark.parametrize("version", [["n"], ["n", "v"], []])
def test_a_large_merge_into_buckets_is_one_shuffle(spark, folder, version):
    kind = "order_id int, v string, n int"
    batches = [
        [(1, "a", 5), (2, "a", None), (3, "a", 3)],
        [(1, "b", 5), (2, "b", 9), (3, "b", 2), (4, "b", None), (5, "b", 1), (6, "b", 7)],
        [(1, "c", None), (4, "c", 8), (5, "c", None), (6, "c", 7), (7, "c", 1)],
        [(3, "d", 3), (5, "d", 0), (6, "d", 6), (7, "d", 2)],
    ]
    frames = [spark.createDataFrame(rows, kind) for rows in batches]
    left = {}
    for name, threshold, share in (("small", "10m", 0.0), ("large", "-1", 0.0), ("waits", "-1", 1e9)):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for number, frame in enumerate(frames):
                last = share if number < 3 else 0.0
                sinks.upsert_buckets(frame, f"{folder}/{name}", ["order_id"], f"t{number}", 4, version, delta_share=last)
            left[name] = small(sinks.read_buckets(spark, f"{folder}/{name}", frames[0].schema))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert left["small"] == left["large"] == left["waits"]
    stored = spark.read.schema("order_id int, v string, n int, _bucket int").parquet(f"{folder}/small/state")
    plan = plan_of(sinks._newest_by_bucket(stored, [f"{folder}/small/state"], ["order_id"], version, 3))
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_message_is_parsed_twice_whatever_its_fields(spark):
    """Once as a map of texts and once by schema, not once per field or branch."""
    rows = streams.event_rows(spark.range(1).selectExpr("cast(id as string) value"), ORDER_EVENT_SCHEMA)
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    try:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    parsers = re.findall(r"from_json\((.*?)(?:, \(mode,PERMISSIVE\))?, value", plan)
    assert len(set(parsers)) == 2 and plan.count("map_filter(") == 1
