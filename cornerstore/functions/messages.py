"""JSON messages: publish, parse, dead letters, and rescue of unexpected fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

RESCUED = "_rescued_data"


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON message per row in a ``value`` column, as a message sink expects it."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def parse_messages(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten JSON text in ``value``; unreadable text gives a row of NULLs."""
    return df.select(
        *keep, F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select(*keep, "data.*")


def split_dead_letters(df: DataFrame, schema: T.StructType, key: str) -> tuple[DataFrame, DataFrame]:
    """(readable rows, raw messages whose key could not be read).

    Readable rows keep the message's other columns, such as its offset.
    """
    return split_parsed(parse_once(df, schema, key))


def parse_once(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Messages with their row in ``data`` and whether its key is missing; the text is kept for those alone.

    ``split_parsed`` takes them apart. Stored in between, they are parsed once for both outputs.
    """
    beside = [c for c in df.columns if c != "value" and c not in schema.names]
    text = F.col("value").cast("string")
    parsed = df.select(text.alias("value"), *beside, F.from_json(text, schema).alias("data"))
    unreadable = F.col("data").isNull() | F.col(f"data.{key}").isNull()
    marked = parsed.withColumn("_unreadable", unreadable)
    return marked.withColumn("value", F.when(F.col("_unreadable"), F.col("value")))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    beside = [c for c in parsed.columns if c not in ("value", "data", "_unreadable")]
    return parsed.filter("NOT _unreadable").select("data.*", *beside), parsed.filter("_unreadable").select("value")


def parse_with_rescue(text: Column, schema: T.StructType) -> Column:
    """Struct of ``schema`` plus ``_rescued_data``.

    The rescued text is a JSON object with the fields that are not in the schema
    and those whose value does not fit the declared type; NULL if there are none.
    Text that is no JSON object at all is kept whole under ``_corrupt``.
    """
    raw = F.from_json(text, "map<string,string>")
    # With an option given, here the default one, Spark parses once for all fields; else once for each.
    declared = F.from_json(text, _as_text(schema), {"mode": "PERMISSIVE"})
    typed = [
        declared.getField(field.name).try_cast(field.dataType).alias(field.name) for field in schema
    ]
    known = {field.name: field.dataType for field in schema}
    misfit = F.map_filter(raw, lambda name, value: _does_not_fit(name, value, known))
    # The map is parsed and filtered once: no branch repeats it.
    kept = F.coalesce(misfit, F.when(text.isNotNull(), F.create_map(F.lit("_corrupt"), text)))
    return F.struct(*typed, F.nullif(F.to_json(kept), F.lit("{}")).alias(RESCUED))


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(field.name, T.StringType()) for field in schema])


def _does_not_fit(name: Column, value: Column, known: dict[str, T.DataType]) -> Column:
    unknown = ~name.isin(*known)
    typed = {n: t for n, t in known.items() if not isinstance(t, T.StringType)}
    for field, kind in typed.items():
        unknown = unknown | ((name == field) & value.isNotNull() & value.try_cast(kind).isNull())
    return unknown
