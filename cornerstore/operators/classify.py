"""Row rules: classify rows, split valid from rejected, drop unexpected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """``failed`` is a SQL condition; a row breaks the rule where it is true."""

    reason: str
    failed: str

    @property
    def column(self) -> Column:
        return F.coalesce(F.expr(self.failed), F.lit(False))


def breaks_any(rules: Sequence[Rule]) -> Column:
    """True where at least one rule is broken.

    A plain boolean, so that the filter stays inside generated code; the array
    of reasons is built for rejected rows only.
    """
    return reduce(or_, (rule.column for rule in rules))


def all_reasons(rules: Sequence[Rule]) -> Column:
    """Every broken rule's reason, in rule order."""
    return F.array_compact(F.array(*(F.when(F.expr(rule.failed), rule.reason) for rule in rules)))


def first_reason(rules: Sequence[Rule]) -> Column:
    """The first broken rule's reason, NULL for a valid row."""
    return F.coalesce(*(F.when(F.expr(rule.failed), rule.reason) for rule in rules))


def split_rows(
    df: DataFrame, rules: Sequence[Rule], reasons: str = "rejection_reasons"
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons)."""
    broken = breaks_any(rules)
    return df.filter(~broken), df.filter(broken).withColumn(reasons, all_reasons(rules))


def keep_expected(df: DataFrame, condition: str) -> DataFrame:
    """Keep rows where the condition is true; false and unknown rows are dropped."""
    return df.filter(F.coalesce(F.expr(condition), F.lit(False)))


def count_unexpected(df: DataFrame, condition: str) -> DataFrame:
    """How many rows ``keep_expected`` would drop."""
    met = F.coalesce(F.expr(condition), F.lit(False))
    return df.agg(F.count_if(~met).alias("dropped"), F.count(F.lit(1)).alias("seen"))
