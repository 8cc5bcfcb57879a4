"""Column helpers that turn bad values into NULL instead of failing under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def clean_text(name: str) -> Column:
    """Text with outer spaces removed (spaces only, tabs and line breaks stay)."""
    return F.trim(F.col(name).cast("string")).alias(name)


def safe_cast(source: str | Column, to: str, name: str | None = None) -> Column:
    column = F.col(source) if isinstance(source, str) else source
    return column.try_cast(to).alias(name or (source if isinstance(source, str) else "value"))


def line_amount(price: str = "price", quantity: str = "quantity", to: str = "decimal(18,2)") -> Column:
    """price * quantity; an amount too large for ``to`` is NULL."""
    return (F.col(price) * F.col(quantity)).try_cast(to)


def int_amount(price: str = "price", quantity: str = "quantity") -> Column:
    """Integer price * quantity; NULL on overflow."""
    return F.try_multiply(F.col(price), F.col(quantity))


def fingerprint(columns: Iterable[str]) -> Column:
    """SHA-256 of the row's JSON text. NULL fields are left out of the text."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def money_average(amount: str, to: str) -> Column:
    return F.avg(amount).cast(to)


def with_lineage(df, batch_id: str, ingested_at: Column | None = None):
    """Add when and in which batch the rows came in."""
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    return (
        df.withColumn("ingested_at", moment)
        .withColumn("ingestion_date", F.to_date("ingested_at"))
        .withColumn("batch_id", F.lit(batch_id))
    )
