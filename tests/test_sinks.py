from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cornerstore.contracts import SALES_SCHEMA
from cornerstore.operators import watermark
from cornerstore.operators.watermark import (
    Watermark, after_watermark, commit_watermark, load_watermark, source_subquery, watermark_of,
)
from cornerstore.plans import loads
from cornerstore.session import drop_intermediate, shared_folder, write_and_reread
from cornerstore.sinks import files as sinks, jdbc
from cornerstore.sources import files as sources, streams
from cornerstore.sources.jdbc import Split, scan_options


def frame(spark, *rows, columns="order_id int, v string"):
    return spark.createDataFrame(list(rows), columns)


def state(df):
    return sorted(map(tuple, df.collect()))


def test_published_datasets_change_together(spark, folder):
    one = {"a": frame(spark, (1, "x")), "b": frame(spark, (1, "y"))}
    sinks.publish_snapshots(one, folder, "p1")
    broken = {"a": frame(spark, (2, "z")), "b": frame(spark, (1, "y")).select(F.raise_error(F.lit("no")).alias("v"))}
    with pytest.raises(Exception):
        sinks.publish_snapshots(broken, folder, "p2")
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(1, "x")]
    assert not sinks.path_exists(spark, f"{folder}/a/v=p2")
    sinks.publish_snapshots({"a": frame(spark, (3, "w"))}, folder, "p3")
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(3, "w")]
    assert state(sinks.read_snapshot(spark, folder, "b")) == [(1, "y")]


def test_snapshot_can_be_built_from_itself(spark, folder):
    sinks.publish_snapshots({"a": frame(spark, (1, "x"))}, folder, "p1")
    grown = sinks.read_snapshot(spark, folder, "a").unionByName(frame(spark, (2, "y")))
    sinks.publish_snapshots({"a": grown}, folder, "p2")
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(1, "x"), (2, "y")]


def test_same_publication_twice_is_refused(spark, folder):
    sinks.publish_snapshots({"a": frame(spark, (1, "x"))}, folder, "p1")
    with pytest.raises(FileExistsError):
        sinks.publish_snapshots({"a": frame(spark, (1, "x"))}, folder, "p1")


def test_expiry_keeps_the_current_version(spark, folder):
    for n in range(4):
        sinks.publish_snapshots({"a": frame(spark, (n, "x"))}, folder, f"p{n}")
    sinks.expire_snapshots(spark, folder, "a", keep=1)
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(3, "x")]
    assert not sinks.path_exists(spark, f"{folder}/a/v=p2")
    with pytest.raises(ValueError):
        sinks.expire_snapshots(spark, folder, "a", keep=0)


def test_killed_publication_does_not_block_its_id(spark, folder):
    sinks.publish_snapshots({"a": frame(spark, (1, "x"))}, folder, "p1")
    sinks.stage_snapshots({"a": frame(spark, (2, "lost"))}, folder, "p2")  # the driver dies here
    sinks.publish_snapshots({"a": frame(spark, (3, "y"))}, folder, "p2")
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(3, "y")]
    with pytest.raises(FileExistsError):
        sinks.stage_snapshots({"a": frame(spark, (4, "z"))}, folder, "p1")


def test_two_publishers_take_different_numbers(spark, folder, monkeypatch):
    one = sinks.stage_snapshots({"a": frame(spark, (1, "x"))}, folder, "p1")
    two = sinks.stage_snapshots({"b": frame(spark, (2, "y"))}, folder, "p2")
    known, calls = sinks._commit_files, []

    def between(spark, root):
        found = known(spark, root)
        calls.append(root)
        if len(calls) == 1:  # the other publisher commits after this one has listed the commits
            sinks.commit_snapshots(spark, root, "p2", two)
        return found

    monkeypatch.setattr(sinks, "_commit_files", between)
    sinks.commit_snapshots(spark, folder, "p1", one)
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(1, "x")]
    assert state(sinks.read_snapshot(spark, folder, "b")) == [(2, "y")]
    assert len(known(spark, folder)) == 2


def test_half_written_commit_is_not_read(spark, folder):
    sinks.publish_snapshots({"a": frame(spark, (1, "x"))}, folder, "p1")
    Path(folder, "manifest", "000000000001.json").write_text('{"number": 1, "data')
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(1, "x")]
    sinks.publish_snapshots({"a": frame(spark, (2, "y"))}, folder, "p2")
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(2, "y")]


def test_expiry_spares_what_is_staged(spark, folder):
    for n in range(3):
        sinks.publish_snapshots({"a": frame(spark, (n, "x"))}, folder, f"p{n}")
    staged = sinks.stage_snapshots({"a": frame(spark, (9, "s"))}, folder, "p9")
    sinks.expire_snapshots(spark, folder, "a", keep=1)
    assert not sinks.path_exists(spark, f"{folder}/a/v=p1")
    sinks.commit_snapshots(spark, folder, "p9", staged)
    assert state(sinks.read_snapshot(spark, folder, "a")) == [(9, "s")]
    assert len(list(Path(folder, "manifest").glob("*.json"))) < 4


def test_appended_parts_leave_earlier_ones_alone(spark, folder):
    first = sinks.stage_snapshots({"f": frame(spark, (1, "x"))}, folder, "p1")
    sinks.commit_snapshots(spark, folder, "p1", first, append=["f"])
    before = {p.name: p.stat().st_mtime_ns for p in Path(folder, "f", "v=p1").iterdir()}
    second = sinks.stage_snapshots({"f": frame(spark, (2, "y"))}, folder, "p2")
    sinks.commit_snapshots(spark, folder, "p2", second, append=["f"])
    assert state(sinks.read_snapshot(spark, folder, "f")) == [(1, "x"), (2, "y")]
    assert {p.name: p.stat().st_mtime_ns for p in Path(folder, "f", "v=p1").iterdir()} == before


def test_staging_names_are_valid_and_differ():
    names = {jdbc.staging_name(t, i) for t in ("public.sales", "sales") for i in ("after_1_-2", "x" * 90 + "1", "x" * 90 + "2")}
    assert len(names) == 6
    for name in names:
        schema_of, _, table = name.rpartition(".")
        assert schema_of in ("", "public") and table.isidentifier() and len(table) <= 63


def test_failed_clean_up_does_not_hide_the_load(spark, monkeypatch):
    calls = []

    def transaction(connection, statements, counted=()):
        calls.append(statements)
        if statements[0].startswith("DROP"):
            raise RuntimeError("gone")

    monkeypatch.setattr(jdbc, "write_jdbc", lambda *a, **k: None)
    monkeypatch.setattr(jdbc, "connect", lambda *a: None)
    monkeypatch.setattr(jdbc, "in_transaction", transaction)
    with pytest.warns(UserWarning, match="are left"):
        jdbc.upsert_jdbc(frame(spark, (1, "x")), jdbc.Database("jdbc:x"), "t", ["order_id"], "l")
    assert len(calls) == 2


def test_watermark_ignores_rows_without_id(spark):
    rows = spark.createDataFrame(
        [(1, datetime(2026, 1, 1)), (None, datetime(2026, 1, 2)), (3, None)], "order_id long, updated_at timestamp"
    )
    assert watermark_of(rows).order_id == 1
    with pytest.raises(ValueError):
        watermark_of(rows.filter("order_id is null"))


def test_batches_are_immutable_and_ids_stay_text(spark, folder):
    sinks.append_batch(frame(spark, (1, "x")), folder, "007", "2026-01-01")
    sinks.append_batch(frame(spark, (2, "y")), folder, "7", "2026-01-01")
    with pytest.raises(FileExistsError):
        sinks.append_batch(frame(spark, (3, "z")), folder, "7", "2026-01-02")
    batch = sources.read_batch(spark, folder, "007")
    assert [(r.order_id, r.batch_id) for r in batch.collect()] == [(1, "007")]
    with pytest.raises(ValueError):
        sources.read_batch(spark, folder, "../7")
    with pytest.raises(FileNotFoundError):
        sources.read_batch(spark, folder, "8")
    with pytest.raises(FileNotFoundError):
        sources.read_batch(spark, folder + "/none", "8")


def test_batch_of_a_broken_off_attempt_does_not_count(spark, folder):
    """Files without the marker of a finished write are ignored, also under an earlier date."""
    half = f"{folder}/ingestion_date=2026-01-01/batch_id=b"
    frame(spark, (1, "half")).write.parquet(half)
    sinks.delete_path(spark, f"{half}/_SUCCESS")
    with pytest.raises(FileNotFoundError):
        sources.read_batch(spark, folder, "b")
    sinks.append_batch(frame(spark, (1, "x"), (2, "y")), folder, "b", "2026-01-02")
    batch = sources.read_batch(spark, folder, "b")
    assert sorted((r.order_id, r.v, str(r.ingestion_date)) for r in batch.collect()) == [
        (1, "x", "2026-01-02"), (2, "y", "2026-01-02"),
    ]


def test_quarantine_retry(spark, folder):
    day = "2026-01-01"
    rows = frame(spark, (1, "f1"), (2, "f1"), (3, "f2"), columns="order_id int, record_fingerprint string")
    assert sinks.write_quarantine(rows, folder, "b1", day)
    assert not sinks.write_quarantine(rows, folder, "b1", day)
    with pytest.raises(FileExistsError):
        sinks.write_quarantine(rows.filter("order_id <> 2"), folder, "b1", day)


SCHEMA = "order_id int, v string, n int"


def test_bucket_upsert_and_replay(spark, folder):
    def rows(*r):
        return frame(spark, *r, columns=SCHEMA)

    columns = rows((1, "", 1)).schema
    sinks.upsert_buckets(rows((1, "a", 5), (2, "a", 5), (3, "a", 5)), folder, ["order_id"], "t1", 4, ["n"])
    for _ in range(2):
        sinks.upsert_buckets(rows((1, "b", 6), (2, "b", 4), (9, "b", 1)), folder, ["order_id"], "t2", 4, ["n"])
        assert state(sinks.read_buckets(spark, folder, columns)) == [
            (1, "b", 6), (2, "a", 5), (3, "a", 5), (9, "b", 1),
        ]


def test_bucket_upsert_resumes_from_staged_rows(spark, folder):
    """A run that staged its buckets and then broke off is finished by its replay."""
    rows = frame(spark, (1, "a", 5), columns=SCHEMA)
    sinks.upsert_buckets(rows, folder, ["order_id"], "t1", 4)
    merged = frame(spark, (1, "b", 6), columns=SCHEMA).withColumn(
        "_bucket", F.pmod(F.xxhash64("order_id"), F.lit(4)).cast("int")
    )
    merged.write.partitionBy("_bucket").parquet(f"{folder}/staged/t2/merged")
    bucket = merged.first()["_bucket"]
    sinks.delete_path(spark, f"{folder}/state/_bucket={bucket}")
    sinks.upsert_buckets(frame(spark, (1, "b", 6), columns=SCHEMA), folder, ["order_id"], "t2", 4)
    assert state(sinks.read_buckets(spark, folder, rows.schema)) == [(1, "b", 6)]


def test_bucket_ranges_touch_only_recent_orders(spark, folder):
    ranges = F.expr("order_id DIV 100")
    old = spark.range(1000).selectExpr("cast(id as int) order_id", "'a' v", "1 n")
    sinks.upsert_buckets(old, folder, ["order_id"], "t1", bucket_by=ranges)
    before = {p.name: p.stat().st_mtime_ns for p in Path(folder, "state").iterdir()}
    recent = spark.range(950, 1050).selectExpr("cast(id as int) order_id", "'b' v", "2 n")
    sinks.upsert_buckets(recent, folder, ["order_id"], "t2", bucket_by=ranges)
    after = {p.name: p.stat().st_mtime_ns for p in Path(folder, "state").iterdir()}
    kept = [n for n in before if n.startswith("_bucket=") and before[n] == after[n]]
    assert sorted(kept) == sorted(f"_bucket={i}" for i in range(9))
    counts = sinks.read_buckets(spark, folder, old.schema).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in counts} == {"a": 950, "b": 100}


def test_csv_keeps_blank_and_padded_text(spark, folder):
    df = frame(spark, (1, "  "), (2, " x "), (4, None), (5, 'a,"b"'))
    sinks.write_csv(df, f"{folder}/csv")
    assert sorted(map(tuple, sources.read_csv(spark, f"{folder}/csv", df.schema).collect())) == sorted(
        map(tuple, df.collect())
    )


def test_required_columns(spark):
    df = frame(spark, (1, "x"))
    sources.require_columns(df, ["order_id"])
    with pytest.raises(ValueError, match="missing"):
        sources.require_columns(df, ["order_id", "city"])
    with pytest.raises(ValueError, match="unexpected"):
        sources.require_columns(df, ["order_id"], exact=True)


def test_missing_table_is_none(spark):
    assert sources.read_table(spark, "no_such_table") is None


def test_shared_folder_follows_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    path = shared_folder(spark, "x")
    assert path != shared_folder(spark, "x")
    if root:
        assert path.startswith(root)


def test_intermediate_tables_can_be_dropped(spark):
    kept = write_and_reread(frame(spark, (1, "x")), "kept")
    assert kept.count() == 1
    path = shared_folder(spark, "x").rsplit("/", 1)[0]
    assert sinks.path_exists(spark, path)
    drop_intermediate(spark)
    assert not sinks.path_exists(spark, path)


# Watermark -----------------------------------------------------------------


def test_watermark_needs_zone_and_id():
    with pytest.raises(ValueError):
        Watermark.at(datetime(2026, 1, 1), 1)
    with pytest.raises(ValueError):
        Watermark(0, -1)
    east = timezone(timedelta(hours=5, minutes=30))
    assert Watermark.at(datetime(2026, 1, 1, 5, 30, tzinfo=east), 1) == Watermark.at(
        datetime(2026, 1, 1, tzinfo=timezone.utc), 1
    )


def test_watermark_moves_forward_only(spark, folder):
    path = f"{folder}/control"
    assert load_watermark(spark, path) is None
    commit_watermark(spark, path, Watermark(10, 5), "b1")
    commit_watermark(spark, path, Watermark(10, 5), "b1")
    commit_watermark(spark, path, Watermark(10, 6), "b2")
    with pytest.raises(ValueError):
        commit_watermark(spark, path, Watermark(10, 5), "b3")
    assert load_watermark(spark, path) == Watermark(10, 6)
    assert load_watermark(spark, path, "other") is None


def test_watermark_commits_are_folded(spark, folder, monkeypatch):
    """Many runs are read from few files, also after folds that broke off."""
    path = f"{folder}/control"
    for n in range(19):
        commit_watermark(spark, path, Watermark(n, n), f"b{n}")
    deleted = []

    def lost(spark, path):
        if len(deleted) == 3:
            raise OSError("lost")
        deleted.append(path)
        sinks.delete_path(spark, path)

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(watermark, "delete_path", lost)
        commit_watermark(spark, path, Watermark(19, 19), "b19")
    assert load_watermark(spark, path) == Watermark(19, 19)
    for n in range(20, 80):
        commit_watermark(spark, path, Watermark(n, n), f"b{n}")
        if n % 30 == 0:
            assert len(sinks.names_of(spark, f"{path}/*.parquet")) <= watermark.FOLD_COMMITS
    rows = spark.read.parquet(path).select("updated_at_us", "batch_id").collect()
    assert sorted(r.updated_at_us for r in rows) == list(range(80)) and len({r.batch_id for r in rows}) == 80
    assert load_watermark(spark, path) == Watermark(79, 79)
    with pytest.raises(ValueError):
        commit_watermark(spark, path, Watermark(3, 3), "late")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rows_after_watermark(spark, kind):
    df = spark.sql(
        f"SELECT id, CAST(at AS {kind}) updated_at, id order_id FROM VALUES "
        "(1, '2026-01-01 00:00:00'), (2, '2026-01-02 00:00:00'), (3, '2026-01-02 00:00:00'), "
        "(4, '2026-01-03 00:00:00'), (5, NULL) AS t(id, at)"
    )
    mark = Watermark.at(datetime(2026, 1, 2, tzinfo=timezone.utc), 2)
    assert [r.id for r in after_watermark(df, mark).orderBy("id").collect()] == [3, 4]
    assert after_watermark(df, None).count() == 5
    assert watermark_of(df) == Watermark.at(datetime(2026, 1, 3, tzinfo=timezone.utc), 4)
    with pytest.raises(ValueError):
        watermark_of(df.filter("false"))


def test_watermark_predicate_reaches_the_scan(spark, folder):
    spark.range(10).selectExpr("id order_id", "TIMESTAMP_NTZ '2026-01-01 00:00:00' updated_at").write.parquet(f"{folder}/t")
    rows = after_watermark(spark.read.parquet(f"{folder}/t"), Watermark(0, 3))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(updated_at" in pushed and "Or(GreaterThan(" in pushed


# JDBC: statements and options only; no database is started ------------------


def test_incremental_subquery_text():
    mark = Watermark.at(datetime(2026, 1, 2, 3, 4, 5, 6, tzinfo=timezone.utc), 7)
    assert source_subquery("public.retail_sales", ("order_id", "city"), mark) == (
        "(SELECT order_id, city FROM public.retail_sales "
        "WHERE updated_at > TIMESTAMPTZ '2026-01-02 03:04:05.000006+00:00' "
        "OR (updated_at = TIMESTAMPTZ '2026-01-02 03:04:05.000006+00:00' AND order_id > 7)) AS incremental_source"
    )
    assert "WHERE" not in source_subquery("t", ("order_id",), None)


def test_scan_options_hide_the_password():
    database = jdbc.Database("jdbc:x", user="u", password="secret")
    options = scan_options(database, "t", Split("order_id", 0, 100, 4))
    assert options["fetchsize"] == "1000" and options["numPartitions"] == "4" and options["partitionColumn"] == "order_id"
    assert "secret" not in repr(database)


def test_upsert_statements():
    assert jdbc.upsert_statement("t", "s", ["id"], ["id", "v"], "postgresql") == (
        "INSERT INTO t (id, v) SELECT id, v FROM s ON CONFLICT (id) DO UPDATE SET v = EXCLUDED.v"
    )
    assert "WHEN NOT MATCHED THEN INSERT (id, v) VALUES (s.id, s.v)" in jdbc.upsert_statement(
        "t", "s", ["id"], ["id", "v"], "merge"
    )
    with pytest.raises(ValueError):
        jdbc.upsert_statement("t", "s", ["id"], ["id"], "other")


class Recorder:
    """Stands in for a JDBC connection and writes down what it is told."""

    def __init__(self, fail_on=None):
        self.said, self.fail_on = [], fail_on

    def setAutoCommit(self, on):
        self.said.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def execute(self, text):
        if text == self.fail_on:
            raise RuntimeError(text)
        self.said.append(text)

    def executeQuery(self, text):
        self.said.append(text)
        return self

    def next(self):
        return True

    def getLong(self, column):
        return 3

    def commit(self):
        self.said.append("commit")

    def rollback(self):
        self.said.append("rollback")

    def close(self):
        self.said.append("close")


def test_transaction_commits_or_rolls_back():
    good = Recorder()
    assert jdbc.in_transaction(good, ["A", "B"], ["t"]) == {"t": 3}
    assert good.said == ["autocommit False", "A", "B", "SELECT COUNT(*) FROM t", "commit", "close"]
    bad = Recorder(fail_on="B")
    with pytest.raises(RuntimeError):
        jdbc.in_transaction(bad, ["A", "B"])
    assert bad.said == ["autocommit False", "A", "rollback", "close"]


def test_publication_checks_columns_and_orders_statements(spark, monkeypatch):
    written, connections = [], []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, db, table, mode: written.append((table, mode)))
    monkeypatch.setattr(jdbc, "connect", lambda spark, db: connections.append(Recorder()) or connections[-1])
    df = frame(spark, (1, "x"))
    counts = jdbc.publish_jdbc({"a": (df, "ta", ["order_id", "v"])}, jdbc.Database("jdbc:x"), "l1")
    staging = jdbc.staging_name("ta", "l1")
    assert counts == {"ta": 3} and written == [(staging, "overwrite")]
    assert connections[0].said == [
        "autocommit False", jdbc.publish_lock(["ta"]), "TRUNCATE TABLE ta",
        f"INSERT INTO ta (order_id, v) SELECT order_id, v FROM {staging}", "SELECT COUNT(*) FROM ta", "commit", "close",
    ]
    assert f"DROP TABLE IF EXISTS {staging}" in connections[1].said
    with pytest.raises(ValueError):
        jdbc.publish_jdbc({"a": (df, "ta", ["order_id"])}, jdbc.Database("jdbc:x"), "l2")


class Steps:
    """Stands in for a Spark reader or writer and writes down how it is set up."""

    def __init__(self):
        self.said = {}

    def format(self, name):
        self.said["format"] = name
        return self

    def option(self, name, value):
        self.said[name] = value
        return self

    def load(self):
        return self

    def save(self):
        self.said["saved"] = True


def test_kafka_source_and_sink_are_set_up():
    """Options only: Spark's Kafka package is not here."""
    class Session:
        readStream = Steps()

    class Messages:
        write = Steps()

    assert streams.kafka_messages(Session, "b1:9092,b2:9092", "sales", "latest").said == {
        "format": "kafka", "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "sales", "startingOffsets": "latest",
    }
    assert streams.kafka_messages(Session, "b", "t").said["startingOffsets"] == "earliest"
    sinks.send_messages(Messages, "b1:9092", "sales")
    assert Messages.write.said == {"format": "kafka", "kafka.bootstrap.servers": "b1:9092", "topic": "sales", "saved": True}


def test_csv_goes_to_a_database_typed(spark, folder, monkeypatch):
    """The rows that are handed to the JDBC writer; no database is started."""
    text = "order_id,customer_name,product,category,price,quantity,city\n1, Ann ,Pen,Office,3,2,\n2,,Cup,Home,x,1,Pune\n"
    Path(folder, "sales.csv").write_text(text)
    written = []
    monkeypatch.setattr(loads, "write_jdbc", lambda rows, database, table, mode: written.append((rows, table, mode)))
    loads.csv_to_jdbc(spark, f"{folder}/sales.csv", jdbc.Database("jdbc:x"), "sales", "append")
    ((rows, table, mode),) = written
    assert (table, mode) == ("sales", "append") and [f.name for f in rows.schema] == [f.name for f in SALES_SCHEMA]
    found = {r.order_id: (r.customer_name, r.price, r.quantity, r.city) for r in rows.collect()}
    assert found[1] == (" Ann ", 3, 2, None) and found[2][1:] == (None, 1, "Pune")
