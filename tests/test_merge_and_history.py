import random
from collections import Counter

from pyspark.sql import functions as F

from cornerstore.operators import history, merge, star
from cornerstore.operators.setops import except_all, multiset_difference

VERSIONED = "order_id int, v string, updated_at int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_follows_the_version(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (3, "old", 5), (4, "old", None)], VERSIONED)
    source = spark.createDataFrame([(1, "new", 6), (2, "new", 5), (3, "new", 4), (4, "new", 9), (9, "new", 1)], VERSIONED)
    merged = merge.merge_newer(target, source, ["order_id"], ["updated_at"])
    assert rows_of(merged) == [
        (1, "new", 6), (2, "new", 5), (3, "old", 5), (4, "old", None), (9, "new", 1),
    ]


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], VERSIONED)
    source = spark.createDataFrame([(1, "c", 7), (3, "d", 1)], VERSIONED)
    once = merge.merge_newer(target, source, ["order_id"], ["updated_at"])
    assert rows_of(merge.merge_newer(once, source, ["order_id"], ["updated_at"])) == rows_of(once)


def test_small_source_leaves_the_target_unshuffled(spark):
    target = spark.range(1000).selectExpr("cast(id as int) order_id", "'t' v", "1 updated_at")
    source = spark.range(10).selectExpr("cast(id as int) order_id", "'s' v", "2 updated_at")
    plan = merge.merge_newer(target, source, ["order_id"], ["updated_at"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_incremental_merge_skips_late_rows(spark):
    kinds = "order_id int, v string, updated_at timestamp_ntz"
    at = lambda day: F.expr(f"TIMESTAMP_NTZ '2026-01-{day:02d} 00:00:00'")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "order_id int, v string").withColumn("updated_at", at(5))
    source = (
        spark.createDataFrame([(1, "late")], "order_id int, v string").withColumn("updated_at", at(4))
        .unionByName(spark.createDataFrame([(2, "new"), (3, "new")], "order_id int, v string").withColumn("updated_at", at(6)))
    )
    merged = merge.merge_incremental(base, source, ["order_id"])
    assert sorted((r.order_id, r.v) for r in merged.collect()) == [(1, "a"), (2, "new"), (3, "new")]
    empty = spark.createDataFrame([], kinds)
    assert merge.merge_incremental(empty, source, ["order_id"]).count() == 3


# Type-2 history ------------------------------------------------------------


def brute_force(events):
    """(key, start, end, value) from (key, seq, op, value), one event per (key, seq)."""
    versions = []
    by_key = {}
    for event in events:
        by_key.setdefault(event[0], []).append(event)
    for key, own in by_key.items():
        own.sort(key=lambda e: e[1])
        for event, following in zip(own, [*own[1:], None]):
            if event[2] != "DELETE":
                versions.append((key, event[1], following[1] if following else None, event[3]))
    return sorted(versions, key=repr)


def made_events(n=3000, seed=1):
    """A third of all events belong to one key."""
    generator = random.Random(seed)
    events = []
    for seq in range(n):
        key = "hot" if generator.random() < 0.34 else f"k{generator.randrange(200)}"
        events.append((key, seq, generator.choice(["INSERT", "UPDATE", "DELETE"]), generator.randrange(9)))
    generator.shuffle(events)
    return events


EVENT = "k string, seq int, op string, v int"


def versions_of(df):
    return sorted(((r.k, r[history.START], r[history.END], r.v) for r in df.collect()), key=repr)


def test_history_of_shuffled_events_with_a_hot_key(spark):
    events = made_events()
    df = spark.createDataFrame(events, EVENT).repartition(5)
    for width in (1, 50, 100000):
        result = history.scd2(df, ["k"], "seq", "op = 'DELETE'", ["op"], slice_by=F.floor(F.col("seq") / width))
        assert versions_of(result) == brute_force(events)
        assert "op" not in result.columns and "_slice" not in result.columns


def test_event_without_sequence_counts_as_the_earliest(spark):
    df = spark.createDataFrame([("a", 5, "INSERT", 1), ("a", None, "INSERT", 2), ("a", 900, "UPDATE", 3)], EVENT)
    result = history.scd2(df, ["k"], "seq", "op = 'DELETE'", ["op"], slice_by=F.floor(F.col("seq") / 10))
    assert versions_of(result) == sorted(
        [("a", None, 5, 2), ("a", 5, 900, 1), ("a", 900, None, 3)], key=repr
    )


def test_copies_of_one_event_open_one_version(spark):
    events = made_events(300)
    copies = events + [events[0]] * 200
    df = spark.createDataFrame(copies, EVENT).repartition(5)
    result = history.scd2(
        df, ["k"], "seq", "op = 'DELETE'", ["op"], slice_by=F.floor(F.col("seq") / 40), tie_break=[F.desc("v")]
    )
    assert versions_of(result) == brute_force(events)


def test_current_without_history_equals_open_versions(spark):
    df = spark.createDataFrame(made_events(), EVENT)
    full = history.current_versions(
        history.scd2(df, ["k"], "seq", "op = 'DELETE'", ["op"], slice_by=F.floor(F.col("seq") / 64))
    )
    short = history.current_from_events(df, ["k"], "seq", "op = 'DELETE'", ["op"])
    assert versions_of(full) == versions_of(short)


def test_history_splits_keys_by_slice(spark):
    df = spark.createDataFrame(made_events(50), EVENT)
    plan = history.scd2(df, ["k"], "seq", "op = 'DELETE'", slice_by=F.col("seq"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan


def test_check_snapshot_closes_and_opens(spark):
    kinds = "customer_id string, name string, mail string"
    first = spark.createDataFrame([("a", "A", "x"), ("b", "B", None), ("c", "C", "z")], kinds)
    second = spark.createDataFrame([("a", "A", "x"), ("b", "B", "y"), ("d", "D", None)], kinds)
    one, two = F.expr("TIMESTAMP_NTZ '2026-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ '2026-02-01 00:00:00'")
    snapshot = history.start_check_snapshot(first, one)
    step = history.check_snapshot(snapshot, second, "customer_id", ["name", "mail"], two)
    state = [(r.customer_id, r.mail, r.valid_from.month, r.valid_to and r.valid_to.month) for r in step.collect()]
    assert sorted(state, key=repr) == sorted(
        [("a", "x", 1, None), ("b", None, 1, 2), ("b", "y", 2, None), ("c", "z", 1, None), ("d", None, 2, None)],
        key=repr,
    )
    again = history.check_snapshot(step, second, "customer_id", ["name", "mail"], two)
    assert again.count() == step.count()


def test_stamp_only_changed_rows(spark):
    kinds = "id int, v string, updated_at int"
    before = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, None)], kinds)
    after = spark.createDataFrame([(1, "a", 7), (2, "c", 7), (3, None, None), (4, "d", None), (5, "e", 3)], kinds)
    stamped = history.stamp_changes(before, after, "id", ["v"], F.lit(99))
    assert {r.id: r.updated_at for r in stamped.collect()} == {1: 1, 2: 99, 3: 99, 4: 99, 5: 3}
    filled = history.backfill_stamp(before, F.lit(50))
    assert {r.id: r.updated_at for r in filled.collect()} == {1: 1, 2: 1, 3: 50}


def test_dimension_takes_the_latest_even_if_null(spark):
    orders = spark.createDataFrame(
        [("o1", "c", "Old", "m", 1, 1), ("o2", "c", "New", None, 2, 2)],
        "order_id string, customer_id string, customer_name string, customer_email string, updated_at int, "
        "order_timestamp int",
    )
    row = history.dim_customer(orders).first()
    assert (row.customer_name, row.customer_email, row.first_order_at, row.latest_order_at) == ("New", None, 1, 2)


# Star ----------------------------------------------------------------------


def test_surrogate_keys_never_change(spark):
    one = spark.createDataFrame([("b",), ("d",), (None,)], "city string")
    two = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "city string")
    first = star.extend_dimension(None, one, "city_id", ["city"])
    second = star.extend_dimension(first, two, "city_id", ["city"])
    third = star.extend_dimension(second, two, "city_id", ["city"])
    assert {r.city: r.city_id for r in second.collect()} == {None: 1, "b": 2, "d": 3, "a": 4, "c": 5}
    assert rows_of(third) == rows_of(second)


def test_fact_drops_rows_without_member(spark):
    sales = spark.createDataFrame(
        [(1, "Ann", "Pen", "Office", "Rome", 5, 1), (2, None, "Pen", "Office", "Rome", 5, 1)],
        "order_id int, customer_name string, product string, category string, city string, price int, quantity int",
    )
    dims = [
        star.extend_dimension(None, star.members(sales, columns), key, columns)
        for key, columns in star.DIMENSIONS.values()
    ]
    assert [r.order_id for r in star.build_fact(sales, *dims).collect()] == [1]


# Bags ----------------------------------------------------------------------


def test_bag_difference_counts_copies(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    right = spark.createDataFrame([("a",), ("c",), (None,)], "x string")
    assert Counter({r.x: r.surplus for r in multiset_difference(left, right, ["x"]).collect()}) == {"a": 1, "b": 1, "c": -1}
    assert rows_of(except_all(left, right)) == [("a",), ("b",)]


def test_outer_merge_equals_anti_joins(spark):
    """Beyond the broadcast threshold another plan is taken; the rows are the same."""
    target = spark.createDataFrame([(1, 5, "t"), (2, 5, "t"), (3, None, "t"), (4, 5, "t"), (None, 1, "t")], "k int, v int, w string")
    source = spark.createDataFrame([(1, 6, "s"), (2, 4, "s"), (3, 9, "s"), (4, None, "s"), (5, 1, "s"), (None, 2, "s")], "k int, v int, w string")
    small = sorted(map(str, merge.merge_newer(target, source, ["k"], ["v"]).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = merge.merge_newer(target, source, ["k"], ["v"])
        assert sorted(map(str, large.collect())) == small
        plan = large._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("Join") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_and_large_tables_give_the_same_positions_and_history(spark):
    from cornerstore.operators import ordering

    rows = spark.range(500).selectExpr("id", "id % 37 as a", "concat('n', id % 11) as b")
    events = spark.range(300).selectExpr(
        "id % 9 as k", "timestamp'2026-01-01' + make_interval(0, 0, 0, 0, id) as at", "if(id % 7 = 0, 'D', 'U') as op"
    )
    order = [("a", "desc"), ("b", "asc")]

    def all_of():
        ranked = ordering.with_dense_rank(rows, order, "r").select("id", "r").collect()
        placed = ordering.with_position(rows, [("a", "asc"), ("id", "asc")], "n", 5).select("id", "n").collect()
        versions = history.scd2(events, ["k"], "at", "op = 'D'").collect()
        return [sorted(map(str, part)) for part in (ranked, placed, versions)]

    small = all_of()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert all_of() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
