"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(
    app_name: str = "cornerstore",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators expect.

    ``shuffle_partitions`` is the upper bound that adaptive execution merges
    down from. Size it so that one partition is about 200 MB of shuffle data:
    cores for a laptop, tens of thousands for a 100 TB table.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder all executors share (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="cornerstore-")
        root = _local_folders[app]
    return f"{root.rstrip('/')}/cornerstore/{context.applicationId}/{name}-{uuid4().hex[:12]}"


def drop_intermediate(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder."""
    own = shared_folder(spark, "x").rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_and_reread(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by writing ``df`` to the shared folder and reading it back.

    Used where a later step must see exactly the rows an earlier step saw, also
    after executors were lost.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
