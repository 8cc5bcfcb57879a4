"""Data-quality checks. Each is a DataFrame; a gate is their union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cornerstore.contracts import RECONCILED_DATASETS, SILVER_RULES
from cornerstore.operators.classify import Rule, breaks_any
from cornerstore.operators.setops import multiset_difference


class QualityError(ValueError):
    """A quality gate did not hold."""


def disposition_counts(cleaned: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Input, valid and rejected rows in one pass."""
    broken = breaks_any(rules)
    return cleaned.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~broken).alias("valid_rows"),
        F.count_if(broken).alias("rejected_rows"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for several columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """(foreign key, row_count) without a parent; NULL keys do not count.

    Child keys are counted before the join, so a hot key costs one row.
    """
    used = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(key).alias("_parent"))
    return used.join(known, F.col(foreign_key) == F.col("_parent"), "left_anti")


def negative_sales(fact: DataFrame) -> DataFrame:
    return fact.filter("quantity <= 0 OR unit_price < 0 OR total_amount < 0")


def _violates_silver() -> Column:
    broken = reduce(lambda a, b: a | b, (F.coalesce(F.expr(rule), F.lit(False)) for rule in SILVER_RULES))
    amount = (F.col("price") * F.col("quantity")).try_cast("decimal(18,2)")
    return broken | ~F.col("total_amount").eqNullSafe(amount) | F.col("total_amount").isNull()


def silver_violations(silver: DataFrame) -> DataFrame:
    """Silver rows that break a rule or whose amount is not price * quantity.

    The amount test is null-safe: a missing amount is a violation.
    """
    return silver.filter(_violates_silver())


def lineage_gaps(batch: DataFrame, silver: DataFrame, version: str = "source_updated_at") -> DataFrame:
    """Orders of a deduplicated batch that Silver lacks or holds in an older version."""
    stored = silver.select("order_id", F.col(version).alias("silver_updated_at"))
    return (
        batch.select("order_id", F.col(version).alias("batch_updated_at"))
        .join(stored, "order_id", "left")
        .filter("silver_updated_at IS NULL OR silver_updated_at < batch_updated_at")
    )


def newest_times(valid: DataFrame) -> DataFrame:
    """Version time of each order's latest row, all that the lineage check needs of it: no whole row is sorted or shuffled."""
    return valid.groupBy("order_id").agg(F.max("source_updated_at").alias("source_updated_at"))


def stored_lines(silver: DataFrame, batch: DataFrame, version: str, broken: Column) -> DataFrame:
    """Three checks of Silver against a batch, from one scan and one narrow shuffle of both.

    Orders are unique, no row is ``broken``, and each order of the batch (any of its
    versions may be given) is there in its newest version or a later one.
    """
    at = silver.schema[version].dataType
    stored = silver.select("order_id", F.lit(1).alias("copy"), broken.alias("broken"), F.col(version).alias("stored_at"))
    came = batch.select("order_id", F.lit(1).alias("came"), F.col(version).cast(at).alias("came_at"))
    by_order = stored.unionByName(came, allowMissingColumns=True).groupBy("order_id").agg(
        F.count("copy").alias("copies"), F.count_if("broken").alias("broken"), F.max("stored_at").alias("stored_at"),
        F.count("came").alias("came"), F.max("came_at").alias("came_at"),
    )
    lacks = F.expr("came > 0 AND (order_id IS NULL OR stored_at IS NULL OR stored_at < came_at)")
    line = by_order.agg(
        F.count_if(F.col("copies") > 1).alias("silver_orders_unique"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("silver_rows_valid"), F.count_if(lacks).alias("batch_reached_silver"),
    )
    structs = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failures")) for n in line.columns]
    return line.select(F.inline(F.array(*structs)))


def revenue_by_dataset(datasets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dataset, row_count, revenue) per dataset, name -> (rows, amount column)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(amount).cast("decimal(28,2)").alias("revenue"))
        .select(F.lit(name).alias("dataset"), "row_count", "revenue")
        for name, (df, amount) in datasets.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def revenue_mismatches(silver: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """Datasets whose revenue is not the Silver revenue."""
    total = silver.agg(F.sum("total_amount").cast("decimal(28,2)")).scalar()
    sums = revenue_by_dataset({name: (df, "total_revenue") for name, df in gold.items()})
    return sums.where(~F.col("revenue").eqNullSafe(total))


def count_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows ``left`` has more than ``right``."""
    return left.agg(F.count(F.lit(1)).alias("_n")).unionByName(
        right.agg((-F.count(F.lit(1))).alias("_n"))
    ).agg(F.sum("_n").alias("surplus"))


def one_value(df: DataFrame, column: str) -> DataFrame:
    """One row: least and greatest value, and whether all rows agree."""
    return df.agg(F.min(column).alias("least"), F.max(column).alias("greatest")).withColumn(
        "agrees", F.col("least").eqNullSafe(F.col("greatest"))
    )


def failures(name: str, offending: DataFrame) -> DataFrame:
    """A gate line: the number of offending rows."""
    return offending.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def surplus_line(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    return count_difference(left, right).select(
        F.lit(name).alias("check_name"), F.abs("surplus").cast("long").alias("failures")
    )


def batch_counts(bronze: DataFrame, valid: DataFrame, rejected: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: Bronze rows, valid rows, rows to reject, and the quarantine rows that are stored."""
    sides = {"input_rows": bronze, "valid_rows": valid, "rejected_rows": rejected, "stored_rows": quarantine}
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("of"), "n") for k, df in sides.items()]
    rows = reduce(DataFrame.unionByName, counted)
    return rows.agg(*(F.coalesce(F.sum(F.when(F.col("of") == k, F.col("n"))), F.lit(0)).alias(k) for k in sides))


def _count_lines(counts: DataFrame) -> DataFrame:
    """The three count checks from one row of ``batch_counts``: what is stored against what came in."""
    lines = {
        "bronze_not_empty": F.when(F.col("input_rows") > 0, 0).otherwise(1),
        "valid_plus_rejected_is_bronze": F.abs(F.expr("input_rows - valid_rows - stored_rows")),
        "quarantine_count": F.abs(F.col("rejected_rows") - F.col("stored_rows")),
    }
    structs = [F.struct(F.lit(n).alias("check_name"), c.cast("long").alias("failures")) for n, c in lines.items()]
    return counts.select(F.inline(F.array(*structs)))


def _silver_lines(silver: DataFrame, batch: DataFrame, totals: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """The checks of Silver and of the datasets made from it, with one scan and one shuffle of Silver.

    ``totals`` maps a check name to the datasets whose revenue must be Silver's.
    """
    by_order = silver.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(_violates_silver()).alias("broken"),
        F.sum("total_amount").alias("revenue"), F.max("source_updated_at").alias("stored_at"),
    )
    came = batch.select(F.col("order_id").alias("_came"), F.col("source_updated_at").alias("_came_at"))
    both = by_order.join(came, F.col("order_id") == F.col("_came"), "full_outer")
    missing = F.col("_came_at").isNotNull() & (F.col("stored_at").isNull() | (F.col("stored_at") < F.col("_came_at")))
    counted = {
        "silver_orders_unique": F.count_if(F.col("copies") > 1),
        "silver_rows_valid": F.coalesce(F.sum("broken"), F.lit(0)),
        "batch_reached_silver": F.count_if(missing),
    }
    revenue = F.sum("revenue").cast("decimal(28,2)").alias("revenue")
    rows = both.agg(*(c.cast("long").alias(n) for n, c in counted.items()), revenue).withColumn("of", F.lit(""))
    made = {f"{check}/{name}": df for check, of in totals.items() for name, df in of.items()}
    for name, df in made.items():
        total = df.agg(F.sum("total_revenue").cast("decimal(28,2)").alias("revenue")).withColumn("of", F.lit(name))
        rows = rows.unionByName(total, allowMissingColumns=True)
    own = {name: f"_{i}" for i, name in enumerate(["", *made])}
    line = rows.agg(
        *(F.sum(n).alias(n) for n in counted), *(F.max(F.when(F.col("of") == n, F.col("revenue"))).alias(c) for n, c in own.items())
    )
    differs = lambda name: F.when(F.col(own[name]).eqNullSafe(F.col(own[""])), 0).otherwise(1)
    sums = {check: sum((differs(f"{check}/{name}") for name in of), F.lit(0)) for check, of in totals.items()}
    lines = {**{n: F.col(n) for n in counted}, **sums}
    structs = [F.struct(F.lit(n).alias("check_name"), c.cast("long").alias("failures")) for n, c in lines.items()]
    return line.select(F.inline(F.array(*structs)))


def medallion_gate(
    counts: DataFrame,
    latest_valid: DataFrame,
    rejected: DataFrame,
    quarantine: DataFrame,
    silver: DataFrame,
    gold: dict[str, DataFrame],
    serving: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """All cross-layer checks as (check_name, failures, passed).

    ``counts`` are the batch's ``batch_counts``. ``serving`` maps dataset
    names to the rows read back from the serving store; its two checks are left
    out where there is none.
    """
    totals = {"gold_revenue_matches": {name: gold[name] for name in RECONCILED_DATASETS}}
    if serving is not None:
        totals["serving_revenue_matches"] = {"overall_sales": serving["overall_sales"]}
    lines = [
        _count_lines(counts),
        failures("quarantine_matches", multiset_difference(rejected, quarantine, ["record_fingerprint"])),
        _silver_lines(silver, latest_valid, totals),
    ]
    if serving is not None:
        counted = [surplus_line("serving_counts", gold[name], serving[name]) for name in gold]
        lines.append(
            reduce(DataFrame.unionByName, counted).groupBy("check_name").agg(F.sum("failures").alias("failures"))
        )
    return reduce(DataFrame.unionByName, lines).withColumn("passed", F.col("failures") == 0)


def require_passed(gate: DataFrame) -> int:
    """Number of checks passed; raises with the names of those that failed."""
    lines = gate.collect()  # one line per check
    failed = [f"{line['check_name']} ({line['failures']})" for line in lines if not line["passed"]]
    if failed:
        raise QualityError("quality checks failed: " + ", ".join(failed))
    return len(lines)
