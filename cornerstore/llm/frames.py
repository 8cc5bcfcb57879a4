"""Small helpers that all text operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    They import the functions they run from it, and need not have it on their path.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="cornerstore-ship-")) / "cornerstore_package.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, f"{root.name}/{source.relative_to(root).as_posix()}")
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_columns(
    df: DataFrame,
    columns: list[str],
    function: Callable[..., Iterable[tuple]],
    schema: str,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows that ``function(*lists)`` yields for every Arrow batch of ``columns``.

    ``function`` gets one Python list per column and yields one tuple per output
    row. Columns named in ``keep`` need one output row per input row, in order:
    they come first in ``schema`` and are passed on as they are.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    full = _parse_datatype_string(schema)
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(c) for c in keep]
            rows = list(function(*(batch.column(c).to_pylist() for c in columns)))
            made = list(zip(*rows)) if rows else [()] * (len(arrow) - len(keep))
            types = arrow.types[len(keep):]
            arrays = [pa.array(values, type=t) for values, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [a.cast(t) for a, t in zip(given, arrow.types)] + arrays, schema=arrow
            )

    ship(df.sparkSession)
    wanted = list(dict.fromkeys([*keep, *columns]))
    return df.select(*(F.col(f"`{c}`") for c in wanted)).mapInArrow(run, full)


def hash_part(column: str, parts: int):
    """crc32 of the column as text, modulo ``parts``; NULL becomes the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def _share(keys: tuple[str, ...], share):
    """Whether a hash of the keys falls within ``share`` (a number or column from 0 to 1)."""
    steps = 1 << 30
    return F.pmod(F.xxhash64(*(F.col(k) for k in keys), F.lit("sample")), F.lit(steps)) < share * steps


def bounded_sample(df: DataFrame, key: str | tuple[str, ...], rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows of ``df``, chosen by a hash of ``key`` (one or more columns).

    The choice depends on the key alone, so a task that is run again sees the
    same rows. Only classifiers are fitted on such a sample. Rows with equal keys are
    chosen together; where these may be many, name columns whose copies can be dropped.
    """
    if total <= rows:
        return df
    return df.filter(_share((key,) if isinstance(key, str) else key, int(rows / total * (1 << 30)) / (1 << 30)))


def sample_of_labels(df: DataFrame, label: str, keys: tuple[str, ...], rows: int, counts: dict) -> DataFrame:
    """About ``rows`` different rows of ``df``, and of every label about a quarter of an even part at least.

    ``counts`` has the rows of each label. A label with fewer rows than that comes
    whole, so each one can be learned whatever its share. At most 1.25 x ``rows`` are
    expected: equal rows count once, and different ones are chosen independently.
    """
    total = sum(counts.values())
    if total > rows:
        floor = max(1, rows // (4 * len(counts)))
        share = F.lit(0.0)
        for value, n in counts.items():
            share = F.when(F.col(label) == value, F.lit(min(1.0, max(rows / total, floor / n)))).otherwise(share)
        df = df.filter(_share(keys, share))
    return df.distinct()
