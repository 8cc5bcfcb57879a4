"""Model graph: named models with a materialization and tests, built in order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cornerstore.operators import checks, history, merge, metrics
from cornerstore.sinks.files import current_path, merge_parts, publish_snapshots, published_as, read_snapshot

Ref = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Model:
    """``build(ref)`` gives the model's rows; ``tests(rows, ref)`` the offending rows per test name.

    A test named in ``warnings`` is counted and reported, but does not stop the run.
    Incremental models and snapshots are kept in parts, and a build writes only the
    parts that have changed rows: ranges of a growing key if ``part_by`` gives them as
    a SQL expression (such as "order_id DIV 1000000"), else ``parts`` hash parts of the key.

    Where ``build`` gives an incremental model several rows of a key, ``latest(rows, within)``
    leaves the one with the greatest ``updated_at``. It gets the rows past the stored ones only,
    which is the same as leaving late rows out afterwards, and dealt by the columns
    ``within`` (a part of the key range, or none), as they are to be written.
    """

    name: str
    build: Callable[[Ref], DataFrame]
    kind: str = "table"  # view, table, incremental or snapshot
    key: str | None = None
    checked: Sequence[str] = ()
    tests: Callable[[DataFrame, Ref], dict[str, DataFrame]] = field(default=lambda rows, ref: {})
    warnings: frozenset[str] = frozenset()
    parts: int = 16
    part_by: str | None = None
    latest: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None


def not_null(name: str, *columns: str) -> Callable[[DataFrame], dict[str, DataFrame]]:
    return lambda rows: {f"{name}.{c}.not_null": checks.null_rows(rows, c) for c in columns}


def _tests_stage(rows: DataFrame, ref: Ref) -> dict[str, DataFrame]:
    return {
        **not_null("stg_current_orders", "order_id", "customer_id", "product_id", "total_amount")(rows),
        "stg_current_orders.order_id.unique": checks.duplicate_keys(rows, ["order_id"]),
    }


def _tests_dimension(name: str, key: str):
    return lambda rows, ref: {
        **not_null(name, key)(rows),
        f"{name}.{key}.unique": checks.duplicate_keys(rows, [key]),
    }


def _tests_fact(rows: DataFrame, ref: Ref) -> dict[str, DataFrame]:
    return {
        **not_null("fct_sales", "order_id")(rows),
        "fct_sales.order_id.unique": checks.duplicate_keys(rows, ["order_id"]),
        "fct_sales.customer_id.known": checks.orphans(rows, "customer_id", ref("dim_customer"), "customer_id"),
        "fct_sales.product_id.known": checks.orphans(rows, "product_id", ref("dim_product"), "product_id"),
        "fct_sales.sales_positive": checks.negative_sales(rows),
    }


FACT_COLUMNS = (
    "order_id", "customer_id", "product_id", "store_id", "order_date", "order_timestamp",
    "quantity", "unit_price", "total_amount", "updated_at",
)

RETAIL_MODELS = (
    Model(
        "stg_current_orders",
        lambda ref: history.stage_current_orders(ref("silver_orders_history")),
        kind="view",
        tests=_tests_stage,
    ),
    Model(
        "dim_customer",
        lambda ref: history.dim_customer(ref("stg_current_orders")),
        tests=_tests_dimension("dim_customer", "customer_id"),
    ),
    Model(
        "dim_product",
        lambda ref: history.dim_product(ref("stg_current_orders")),
        tests=_tests_dimension("dim_product", "product_id"),
    ),
    Model(
        "fct_sales",
        lambda ref: ref("stg_current_orders").select(*FACT_COLUMNS),
        kind="incremental",
        key="order_id",
        tests=_tests_fact,
        # The incremental fact never sees deletes: a row of an order deleted later keeps a
        # customer or product that the rebuilt dimensions may lack.
        warnings=frozenset({"fct_sales.customer_id.known", "fct_sales.product_id.known"}),
    ),
    Model(
        "mart_daily_sales",
        lambda ref: metrics.mart_daily_sales(ref("fct_sales"), ref("dim_product"), unique_orders=True),
        tests=lambda rows, ref: not_null("mart_daily_sales", "order_date", "gross_sales")(rows),
    ),
    Model(
        "customer_snapshot",
        lambda ref: ref("dim_customer").select("customer_id", "customer_name", "customer_email"),
        kind="snapshot",
        key="customer_id",
        checked=("customer_name", "customer_email"),
    ),
)


def build_models(
    spark: SparkSession,
    models: Sequence[Model],
    sources: dict[str, DataFrame],
    root: str,
    run_id: str,
    now: Column | None = None,
) -> DataFrame:
    """Build the models in the given order and test each; returns (check_name, failures, passed).

    Tables and snapshots are published under ``root``; a model whose tests fail
    stops the run before later models are built, unless the test is a warning, which
    the result counts all the same. ``models`` lists a model after those it refers to.
    A build that broke off is repeated under its ``run_id``: models that it has published
    are read and tested, not built again.
    """
    moment = F.current_timestamp() if now is None else now
    rows: dict[str, DataFrame] = dict(sources)
    results: DataFrame | None = None
    for model in models:
        built = model.build(rows.__getitem__)
        rows[model.name] = _materialize(spark, model, built, root, run_id, moment)
        rows[model.name].createOrReplaceTempView(model.name)
        lines = None
        for name, offending in model.tests(rows[model.name], rows.__getitem__).items():
            line = checks.failures(name, offending)
            lines = line if lines is None else lines.unionByName(line)
        if lines is None:
            continue
        lines = lines.withColumn("passed", F.col("failures") == 0)
        checks.require_passed(lines.filter(~F.col("check_name").isin(*model.warnings)) if model.warnings else lines)
        results = lines if results is None else results.unionByName(lines)
    return results


def _materialize(
    spark: SparkSession, model: Model, built: DataFrame, root: str, run_id: str, now: Column
) -> DataFrame:
    if model.kind == "view":
        return built
    if model.kind not in ("table", "incremental", "snapshot"):
        raise ValueError(f"unknown kind of model: {model.kind}")
    if published_as(spark, root, model.name) != run_id:
        if model.kind == "table":
            publish_snapshots({model.name: built}, root, run_id)
        else:
            stored = read_snapshot(spark, root, model.name) if current_path(spark, root, model.name) else None
            rows, combine = _changed(model, stored, built, now)
            part = F.expr(model.part_by) if model.part_by else F.pmod(F.xxhash64(model.key), F.lit(model.parts))
            keys = [model.key] if model.kind == "incremental" else []
            merge_parts(rows, root, model.name, run_id, part, combine, keys)
    return read_snapshot(spark, root, model.name)


def _changed(model: Model, stored: DataFrame | None, built: DataFrame, now: Column):
    """The built rows that the stored model has not, and how they are merged into their parts."""
    if model.kind == "incremental":
        rows = built if stored is None else merge.newer_than_target(built, stored)
        if model.latest and model.part_by:
            dealt = rows.withColumn("_part", F.expr(model.part_by).cast("int")).repartition("_part")
            rows = model.latest(dealt, ["_part"])
        elif model.latest:
            rows = model.latest(rows, [])
        return rows, lambda there, new: new if there is None else merge.merge_replace(there, new, [model.key])
    rows = built if stored is None else history.changed_rows(stored, built, model.key, model.checked)

    def combine(there: DataFrame | None, new: DataFrame) -> DataFrame:
        if there is None:
            return history.start_check_snapshot(new, now)
        return history.check_snapshot(there, new, model.key, model.checked, now)

    return rows, combine
