"""JDBC sinks: plain writes, staged set-based upsert, and multi-table publication.

Rows always travel from the executors to a staging table. The driver only sends
a fixed number of SQL statements in one transaction.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def publish_lock(targets: Sequence[str]) -> str:
    """Publishers of the same tables wait for each other: the lock's number comes from the names."""
    number = int.from_bytes(hashlib.sha256("\n".join(sorted(targets)).encode()).digest()[:7], "big")
    return f"SELECT pg_advisory_xact_lock({number})"


def staging_name(target: str, load_id: str) -> str:
    """A staging table in the schema of ``target``; any load id gives a valid name."""
    folder, _, name = target.rpartition(".")
    mark = hashlib.sha256(f"{name}\n{load_id}".encode()).hexdigest()[:16]
    return f"{folder}.stg_{name[:40]}_{mark}" if folder else f"stg_{name[:40]}_{mark}"


@dataclass(frozen=True)
class Database:
    url: str
    driver: str = "org.postgresql.Driver"
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self, table: str) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver, "dbtable": table}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return options


def write_jdbc(
    df: DataFrame, database: Database, table: str, mode: str, batch_size: int = 1000, connections: int = 32
) -> None:
    """``mode`` is "overwrite" or "append"; ``connections`` bounds how many tasks write at a time."""
    (
        df.write.format("jdbc")
        .options(**database.options(table))
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .mode(mode)
        .save()
    )


def upsert_statement(target: str, staging: str, keys: Sequence[str], columns: Sequence[str], dialect: str) -> str:
    """One set-based upsert from a staging table ("postgresql" or standard "merge")."""
    names = ", ".join(columns)
    changed = [c for c in columns if c not in keys]
    if dialect == "postgresql":
        updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in changed)
        return (
            f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} "
            f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
        )
    if dialect != "merge":
        raise ValueError(f"unknown dialect: {dialect}")
    matched = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    updates = ", ".join(f"{c} = s.{c}" for c in changed)
    values = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {staging} s ON {matched} "
        f"WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def create_statement(target: str, df: DataFrame, keys: Sequence[str], text: str = "VARCHAR(100)") -> str:
    """CREATE TABLE IF NOT EXISTS for a KPI table, all columns required; ``text`` is the type of strings."""
    kinds = {"string": text, "bigint": "BIGINT", "int": "INTEGER", "timestamp": "TIMESTAMP WITH TIME ZONE"}
    columns = [
        f"{name} {kinds.get(kind, kind.replace('decimal', 'NUMERIC'))} NOT NULL" for name, kind in df.dtypes
    ]
    return f"CREATE TABLE IF NOT EXISTS {target} ({', '.join(columns)}, PRIMARY KEY ({', '.join(keys)}))"


def connect(spark: SparkSession, database: Database):
    """A JDBC connection of the driver JVM, for statements only."""
    properties = spark._jvm.java.util.Properties()
    for name in ("user", "password"):
        value = getattr(database, name)
        if value is not None:
            properties.setProperty(name, value)
    spark._jvm.java.lang.Class.forName(database.driver)
    return spark._jvm.java.sql.DriverManager.getConnection(database.url, properties)


def in_transaction(connection, statements: Sequence[str], counted: Sequence[str] = ()) -> dict[str, int]:
    """Run statements as one transaction; row counts of the ``counted`` tables are taken inside it."""
    counts: dict[str, int] = {}
    connection.setAutoCommit(False)
    try:
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        for table in counted:
            result = statement.executeQuery(f"SELECT COUNT(*) FROM {table}")
            result.next()
            counts[table] = result.getLong(1)
        connection.commit()
        return counts
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert_jdbc(
    df: DataFrame, database: Database, target: str, keys: Sequence[str], load_id: str, dialect: str = "postgresql"
) -> None:
    """Upsert rows (one per key) without collecting them."""
    spark, staging = df.sparkSession, staging_name(target, load_id)
    try:
        write_jdbc(df, database, staging, "overwrite")
        in_transaction(connect(spark, database), [upsert_statement(target, staging, keys, df.columns, dialect)])
    finally:
        _drop(spark, database, [staging])


def _drop(spark: SparkSession, database: Database, tables: Sequence[str]) -> None:
    """Clean up staging tables. A failure here neither hides the load's own error nor undoes a committed load."""
    try:
        in_transaction(connect(spark, database), [f"DROP TABLE IF EXISTS {t}" for t in tables])
    except Exception as error:  # noqa: BLE001
        warnings.warn(f"staging tables {list(tables)} are left: {error}", stacklevel=2)


def publish_jdbc(
    datasets: dict[str, tuple[DataFrame, str, Sequence[str]]],
    database: Database,
    load_id: str,
    lock_statement: str | None = None,
    target_ddl: Sequence[str] = (),
) -> dict[str, int]:
    """Replace several serving tables together: name -> (rows, target table, columns).

    All rows are staged first. One transaction then takes a lock, replaces each
    target from its staging table and counts it; on any error nothing changes.
    """
    for name, (df, _, columns) in datasets.items():
        if set(df.columns) != set(columns):
            raise ValueError(f"unexpected columns for {name}: {sorted(df.columns)}")
    spark = next(iter(datasets.values()))[0].sparkSession
    staging = {name: staging_name(target, load_id) for name, (_, target, _) in datasets.items()}
    if lock_statement is None:
        lock_statement = publish_lock([target for _, target, _ in datasets.values()])
    try:
        for name, (df, _, columns) in datasets.items():
            write_jdbc(df.select(*columns), database, staging[name], "overwrite")
        statements = [lock_statement, *target_ddl] if lock_statement else list(target_ddl)
        for name, (_, target, columns) in datasets.items():
            listed = ", ".join(columns)
            statements += [
                f"TRUNCATE TABLE {target}",
                f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging[name]}",
            ]
        return in_transaction(
            connect(spark, database), statements, [target for _, target, _ in datasets.values()]
        )
    finally:
        _drop(spark, database, list(staging.values()))
