"""History and daily sales from a growing log, publication by publication."""

import json
import random
import shutil
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cornerstore.contracts import ORDER_EVENT_SCHEMA
from cornerstore.operators import metrics
from cornerstore.plans import cdc
from cornerstore.sinks import files as sinks
from cornerstore.sources import streams
from cornerstore.streaming import jobs


def event(order, at, day, quantity, operation, store="S1", category="Office"):
    return {
        "order_id": f"O{order}", "customer_id": "C1", "customer_name": "N", "customer_email": "m", "product_id": "P1",
        "product_name": "Thing", "category": category, "store_id": store, "order_timestamp": f"{day}T10:00:00",
        "updated_at": f"2026-08-{at:02d}T10:10:{order:02d}", "quantity": quantity, "unit_price": 2.5, "operation": operation,
    }


def ingest(spark, folder, number, *events):
    landing = Path(folder, "in")
    landing.mkdir(exist_ok=True)
    (landing / f"{number}.json").write_text("".join(json.dumps(e) + "\n" for e in events))
    cdc.ingest(spark, streams.json_events(spark, str(landing), ORDER_EVENT_SCHEMA), str(folder))


def rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def published(spark, folder, name):
    return sinks.read_snapshot(spark, f"{folder}/published", name)


def same_as_from_the_whole_log(spark, folder):
    """Both layers, compared with history and sales computed from all of the log."""
    log = f"{folder}/events"
    tie = [F.xxhash64("order_timestamp", "quantity", "store_id", "category", "operation")]
    history = jobs.order_history(spark, log, tie).drop("_ingested_at", "_source_file")
    kept = published(spark, folder, "silver_orders_history").select(*history.columns)
    daily = metrics.daily_store_sales(cdc.current_orders(spark, folder, tie))
    return rows(kept) == rows(history) and rows(published(spark, folder, "gold_daily_sales")) == rows(daily.select(*metrics.STORE_KEYS, "order_count", "units_sold", "gross_sales"))


def test_publications_follow_the_log(spark, folder):
    """Random inserts, updates of every field and deletes, in any order of time."""
    made = random.Random(4)
    tie = [F.xxhash64("order_timestamp", "quantity", "store_id", "category", "operation")]
    for number in range(5):
        events = [
            event(
                made.randrange(12), made.randrange(1, 28), f"2026-0{made.randrange(1, 4)}-0{made.randrange(1, 4)}", made.randrange(1, 5),
                made.choice(["INSERT", "UPDATE", "UPDATE", "DELETE", "REFRESH"]), made.choice(["S1", "S2"]), made.choice(["Office", "Home"]),
            )
            for _ in range(made.randrange(2, 14))
        ]
        ingest(spark, folder, number, *events, *events[:1], event(1, 1, "2026-01-01", 0, "INSERT"))
        assert cdc.publish(spark, folder, f"p{number}", tie, buckets=4)
        assert same_as_from_the_whole_log(spark, folder)
    assert not cdc.publish(spark, folder, "nothing new", tie, buckets=4)


def test_only_touched_buckets_and_months_are_written(spark, folder):
    number = F.substring("order_id", 2, 9).cast("int")
    ingest(spark, folder, 0, *(event(k, 1 + k, f"2026-0{1 + k % 6}-05", 2, "INSERT") for k in range(12)))
    cdc.publish(spark, folder, "one", bucket_by=number)
    before = {p: p.stat().st_mtime_ns for p in Path(folder, "published").rglob("*.parquet")}
    # Order 3 moves from April to June, order 5 goes, order 7 is repeated as it is.
    ingest(spark, folder, 1, event(3, 20, "2026-06-05", 9, "UPDATE"), event(5, 21, "2026-06-05", 2, "DELETE"), event(7, 22, "2026-02-05", 2, "UPDATE"))
    cdc.publish(spark, folder, "two", bucket_by=number)
    after = {p: p.stat().st_mtime_ns for p in Path(folder, "published").rglob("*.parquet")}
    assert all(after[p] == at for p, at in before.items())
    new = {str(p.parent.relative_to(f"{folder}/published")) for p in after if p not in before}
    months = {f"_part={2026 * 12 + m}" for m in (4, 6)}
    assert {n for n in new if n.startswith("gold")} == {f"gold_daily_sales/v=two/{m}" for m in months}
    assert {n for n in new if n.startswith("silver_orders")} == {f"silver_orders_history/v=two/_part={k}" for k in (3, 5, 7)}
    assert same_as_from_the_whole_log(spark, folder)
    # All orders go: the datasets are empty, and still there.
    ingest(spark, folder, 2, *(event(k, 25, "2026-01-05", 1, "DELETE") for k in range(12)))
    cdc.publish(spark, folder, "three", bucket_by=number)
    assert published(spark, folder, "gold_daily_sales").count() == 0 and same_as_from_the_whole_log(spark, folder)
    ingest(spark, folder, 3, event(4, 27, "2026-01-05", 1, "INSERT"))
    cdc.publish(spark, folder, "four", bucket_by=number)
    assert published(spark, folder, "gold_daily_sales").count() == 1 and same_as_from_the_whole_log(spark, folder)


def test_sums_with_unknown_amounts(spark):
    """NULL amounts, days and stores come out as a plain aggregate has them, before and after."""
    columns = "order_id int, order_timestamp string, store_id string, category string, quantity int, total_amount decimal(18,2)"
    old = spark.createDataFrame([(1, "2026-01-01", "S", "a", 1, None), (2, None, None, "a", 2, Decimal(5)), (3, "2026-01-01", "S", "b", 3, Decimal(7))], columns)
    new = spark.createDataFrame([(1, "2026-01-01", "S", "a", 1, None), (2, None, None, "a", None, Decimal(6)), (4, "2026-01-02", "S", "b", 1, Decimal(2))], columns)
    plain = lambda orders: rows(metrics.daily_store_sales(orders).select(*metrics.STORE_KEYS, "order_count", "units_sold", "gross_sales"))
    sums = metrics.add_sums(None, metrics.signed_store_sales(None, old), metrics.STORE_KEYS)
    assert rows(metrics.store_sales_of(sums)) == plain(old)
    assert rows(metrics.store_sales_of(metrics.add_sums(sums, metrics.signed_store_sales(old, new), metrics.STORE_KEYS))) == plain(new)
    assert metrics.signed_store_sales(old, old).count() == 0


class Lost(Exception):
    pass


def test_publication_broken_off_anywhere(spark, folder, monkeypatch):
    """Neither layer moves without the other, and the repetition uses the same batches once."""
    base = Path(folder, "base")
    base.mkdir()
    ingest(spark, base, 0, *(event(k, 1 + k, "2026-01-05", 2, "INSERT") for k in range(4)))
    cdc.publish(spark, str(base), "one", buckets=2)
    ingest(spark, base, 1, event(1, 20, "2026-02-05", 9, "UPDATE"), event(2, 20, "2026-02-05", 9, "DELETE"))
    first = rows(published(spark, str(base), "gold_daily_sales"))
    for step in range(20):
        root = f"{folder}/broken-{step}"
        shutil.copytree(base, root)
        # Paths in the log and the manifest are absolute.
        for path in Path(root, "published", "manifest").glob("*.json"):
            path.write_text(path.read_text().replace(str(base), root))
        calls = []

        def breaking(real):
            def call(*args, **more):
                if len(calls) == step:
                    raise Lost
                calls.append(real.__name__)
                return real(*args, **more)
            return call

        with monkeypatch.context() as patched:
            for module, name in ((cdc, "stage_parts"), (cdc, "commit_snapshots"), (cdc, "delete_path"), (sinks, "_place_new")):
                patched.setattr(module, name, breaking(getattr(module, name)))
            try:
                cdc.publish(spark, root, "two", buckets=2)
            except Lost:
                done = False
            else:
                done = True
        if not done and "_place_new" not in calls:
            assert rows(published(spark, root, "gold_daily_sales")) == first
        cdc.publish(spark, root, "two", buckets=2)
        assert same_as_from_the_whole_log(spark, root)
        if done:
            assert len(calls) == 7
            return
    pytest.fail("never ran through")


def log_rows(spark, folder):
    log = f"{folder}/events"
    return [rows(df.select("order_id", "updated_at", "quantity", "operation")) for df in (jobs.silver_changes(spark, log), jobs.quarantine(spark, log), jobs.dropped(spark, log))]


def test_compacted_log_reads_as_before(spark, folder):
    """Readers see each event once before, between and after compactions, and publications go on."""
    for number in range(3):
        ingest(
            spark, folder, number, event(number, 1 + number, "2026-01-05", 2, "INSERT"), event(9, 20, "2026-01-05", 0, "INSERT"),
            *([event(8, 9, "2026-01-05", 2, "REFRESH")] if number == 1 else []),
        )
    whole = log_rows(spark, folder)
    assert [len(r) for r in whole] == [3, 3, 1]
    assert not cdc.compact(spark, folder, "nothing used yet")
    _, last = jobs.new_batches(spark, f"{folder}/events", {})
    (query,) = last
    begun = jobs.silver_changes(spark, f"{folder}/events")
    assert jobs.compact_log(spark, f"{folder}/events", "c1", {query: 0}) and log_rows(spark, folder) == whole
    assert begun.count() == 3
    assert cdc.publish(spark, folder, "one", buckets=2) is True
    assert same_as_from_the_whole_log(spark, folder)


def test_compaction_behind_publications(spark, folder):
    """Only used batches are compacted; folders go one compaction later."""
    whole = []
    for number in range(4):
        ingest(spark, folder, number, event(number, 1 + number, f"2026-0{1 + number}-05", 2, "INSERT"), event(0, 9 + number, "2026-03-01", number, "UPDATE"))
        cdc.publish(spark, folder, f"p{number}", buckets=2)
        whole = log_rows(spark, folder)
        if number % 2:
            assert cdc.compact(spark, folder, f"c{number}")
            assert log_rows(spark, folder) == whole and same_as_from_the_whole_log(spark, folder)
    kept = sorted(p.name for p in Path(folder, "events").glob("batch=*"))
    assert len(kept) == 2 and all(name.endswith(("-2", "-3")) for name in kept)
    assert not cdc.compact(spark, folder, "c5") and not list(Path(folder, "events").glob("batch=*"))
    assert log_rows(spark, folder) == whole
    ingest(spark, folder, 9, event(5, 25, "2026-03-05", 2, "INSERT"))
    assert cdc.publish(spark, folder, "p9", buckets=2) and same_as_from_the_whole_log(spark, folder)


def test_compaction_broken_off(spark, folder, monkeypatch):
    for number in range(2):
        ingest(spark, folder, number, event(number, 1 + number, "2026-01-05", 2, "INSERT"))
    whole = log_rows(spark, folder)

    def lost(*args, **more):
        raise Lost

    for name in ("stage_snapshots", "commit_snapshots"):
        with monkeypatch.context() as patched, pytest.raises(Lost):
            patched.setattr(jobs, name, lost)
            jobs.compact_log(spark, f"{folder}/events", "c1")
        assert log_rows(spark, folder) == whole
    assert jobs.compact_log(spark, f"{folder}/events", "c1") and log_rows(spark, folder) == whole
    with monkeypatch.context() as patched, pytest.raises(Lost):
        patched.setattr(jobs, "delete_path", lost)
        jobs.compact_log(spark, f"{folder}/events", "c2")
    assert not jobs.compact_log(spark, f"{folder}/events", "c2") and log_rows(spark, folder) == whole
