"""File sinks: immutable batches, quarantine, versioned snapshots, keyed state, tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cornerstore.operators.latest import latest_per_key
from cornerstore.operators.merge import estimated_bytes, fits_broadcast, merge_newer, merge_replace
from cornerstore.operators.setops import multiset_difference

COMMIT_ATTEMPTS = 20
#: A record of all earlier commits is written every so many; about twice as many commit files stay.
FOLD_EVERY = 20
#: A batch waits as a delta while the waiting ones have at most this share of the bytes of the buckets they touch.
DELTA_SHARE = 0.1
#: Merging deltas in may rewrite so many bytes for each byte that ever arrived, however many batches there are.
REWRITE_SHARE = 1.25
#: Bytes of stored buckets that one task merges.
MERGE_BYTES = 64 << 20


class StaleSnapshot(RuntimeError):
    """A dataset was published by somebody else since it was read."""


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or for a pattern any match, exists."""
    files, hadoop_path = _file_system(spark, path)
    found = files.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def delete_path(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _file_system(spark, path)
    files.delete(hadoop_path, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a path that does not exist."""
    files, source_path = _file_system(spark, source)
    _, target_path = _file_system(spark, target)
    files.mkdirs(target_path.getParent())
    if not files.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target}")


def names_of(spark: SparkSession, pattern: str) -> list[str]:
    """Last names of the matching paths, in order."""
    files, hadoop_path = _file_system(spark, pattern)
    return sorted(status.getPath().getName() for status in files.globStatus(hadoop_path) or [])


def _size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    files, hadoop_path = _file_system(spark, path)
    return files.getContentSummary(hadoop_path).getLength()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, hadoop_path = _file_system(spark, path)
    stream = files.create(hadoop_path, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def _read_text(spark: SparkSession, path: str) -> str:
    files, hadoop_path = _file_system(spark, path)
    stream = files.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _place_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that is never seen unfinished and never replaces another; False if the name is taken.

    The file is written whole under another name first. A local rename would replace
    what is there, so a local file gets its name as a hard link.
    """
    files, target = _file_system(spark, path)
    beside = f"{target.getParent().toString()}/_new-{uuid4().hex}"
    _write_text(spark, beside, text)
    _, source = _file_system(spark, beside)
    try:
        if files.getUri().getScheme() == "file":
            at = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, source)]
            spark._jvm.java.nio.file.Files.createLink(*at)
        else:
            _rename_to_new(spark, source, target)
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(source, False)
    return True


def _rename_to_new(spark: SparkSession, source, target) -> None:
    """A rename that fails where the target exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; outer spaces of a value are kept. CSV reads empty text back as NULL."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_messages(messages: DataFrame, path: str, compression: str | None = None) -> None:
    """JSON messages as text files, for streams that read files. A compressed file is read by one task."""
    messages.select("value").write.mode("append").text(path, compression)


def send_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """JSON messages to a Kafka topic (needs Spark's Kafka package)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def batch_folder(spark: SparkSession, root: str, batch_id: str) -> str | None:
    """Folder of a batch that was written to its end, None if there is none.

    What a broken-off attempt left behind, perhaps under another date, does not count.
    """
    files, pattern = _file_system(spark, f"{root}/ingestion_date=*/batch_id={batch_id}/_SUCCESS")
    found = files.globStatus(pattern)
    return found[0].getPath().getParent().toString() if found is not None and len(found) else None


def append_batch(df: DataFrame, root: str, batch_id: str, ingestion_date: date | str) -> None:
    """Add one immutable batch to a dataset partitioned by ingestion date and batch id."""
    if batch_folder(df.sparkSession, root, batch_id) is not None:
        raise FileExistsError(f"batch {batch_id} already exists under {root}")
    rows = df.drop("ingestion_date", "batch_id")
    rows.write.mode("overwrite").parquet(f"{root}/ingestion_date={ingestion_date}/batch_id={batch_id}")


def append_if_any(df: DataFrame, path: str) -> bool:
    """Write a batch that must not be empty as a folder; False, with nothing left behind, if it has no rows.

    The rows are computed once: they are written beside and looked at there, and one
    rename makes them the batch. What a broken-off attempt left at ``path`` is replaced.
    """
    spark = df.sparkSession
    parent, _, name = path.rpartition("/")
    beside = f"{parent}/_arriving-{name}"
    df.write.mode("overwrite").parquet(beside)
    if spark.read.schema(df.schema).parquet(beside).isEmpty():
        delete_path(spark, beside)
        return False
    if path_exists(spark, path):
        delete_path(spark, path)
    move_path(spark, beside, path)
    return True


def write_quarantine(rejected: DataFrame, root: str, batch_id: str, ingestion_date: date | str) -> bool:
    """Write a batch's rejected rows once; True if written, False if already there.

    A retry with the same fingerprints is accepted, one with others is refused.
    """
    spark = rejected.sparkSession
    folder = batch_folder(spark, root, batch_id)
    if folder is not None:
        stored = spark.read.schema("record_fingerprint string").parquet(folder)
        if not multiset_difference(rejected, stored, ["record_fingerprint"]).isEmpty():
            raise FileExistsError(f"quarantine batch {batch_id} exists with other rows under {root}")
        return False
    append_batch(rejected, root, batch_id, ingestion_date)
    return True


def stage_snapshots(
    datasets: dict[str, DataFrame], root: str, publication_id: str,
    partition_by: Mapping[str, Sequence[str]] | None = None, dealt: bool = False,
) -> dict[str, str]:
    """Write all datasets beside the published ones; nothing is visible yet.

    What a killed run staged under the same id, but never committed, is replaced;
    a committed version is never touched. Rows that are ``dealt`` by their partition already are not shuffled for it.
    """
    spark = next(iter(datasets.values())).sparkSession
    paths = {name: f"{root}/{name}/v={publication_id}" for name in datasets}
    left_over = [path for path in paths.values() if path_exists(spark, path)]
    if left_over:
        history = _history(spark, root)["versions"].values()
        published = [path for versions in history for paths in versions.values() for path in paths]
        for staged in left_over:
            if any(path == staged or path.startswith(f"{staged}/") for path in published):
                raise FileExistsError(f"publication already exists: {staged}")
    try:
        for name, df in datasets.items():
            columns = (partition_by or {}).get(name, ())
            rows = df.hint("rebalance", *columns) if columns and not dealt else df
            rows.write.mode("overwrite").partitionBy(*columns).parquet(paths[name])
    except Exception:
        drop_staged(spark, paths)
        raise
    return paths


def drop_staged(spark: SparkSession, paths: dict[str, str]) -> None:
    for path in paths.values():
        delete_path(spark, path)


def _commit_files(spark: SparkSession, root: str) -> list:
    files, pattern = _file_system(spark, f"{root}/manifest/*.json")
    return sorted((status.getPath() for status in files.globStatus(pattern) or []), key=lambda path: path.getName())


def _number(path) -> int:
    return int(path.getName().removesuffix(".json"))


def _read_commit(spark: SparkSession, path) -> dict | None:
    """One commit; None for a file that is not whole, which no publisher of this version leaves."""
    text = _read_text(spark, path.toString())
    return json.loads(text) if text.endswith("}\n") else None


def _newest(spark: SparkSession, commit_files: Sequence) -> dict:
    for path in reversed(commit_files):
        if commit := _read_commit(spark, path):
            return commit
    return {"datasets": {}}


def _last_commit(spark: SparkSession, root: str) -> dict:
    return _newest(spark, _commit_files(spark, root))


def _history(spark: SparkSession, root: str) -> dict:
    """Publication ids, and the paths of each dataset's versions by commit number.

    The newest folded record holds all up to its number; only later commits are opened.
    """
    folds = names_of(spark, f"{root}/manifest/*.folded")
    found = {"number": -1, "publications": [], "versions": {}}
    if folds:
        found = json.loads(_read_text(spark, f"{root}/manifest/{folds[-1]}"))
    for path in _commit_files(spark, root):
        if _number(path) > found["number"] and (commit := _read_commit(spark, path)):
            found["number"] = commit["number"]
            found["publications"].append(commit["publication_id"])
            for name, d in commit["datasets"].items():
                found["versions"].setdefault(name, {})[str(d["number"])] = d["paths"]
    return found


def _fold(spark: SparkSession, root: str) -> None:
    """Write the record of all commits so far, and drop commit files that an earlier record covers."""
    folds = names_of(spark, f"{root}/manifest/*.folded")
    covered = int(folds[-1].removesuffix(".folded")) if folds else -1
    files = _commit_files(spark, root)
    if not files or _number(files[-1]) - covered < FOLD_EVERY:
        return
    record = _history(spark, root)
    _place_new(spark, f"{root}/manifest/{record['number']:012d}.folded", json.dumps(record))
    for path in files:
        if _number(path) <= covered:
            delete_path(spark, path.toString())
    for name in folds[:-1]:
        delete_path(spark, f"{root}/manifest/{name}")


def commit_snapshots(
    spark: SparkSession, root: str, publication_id: str, paths: Mapping[str, str], append: Sequence[str] = (),
    parts: Mapping[str, Mapping[str, str | None]] | None = None, based_on: Mapping[str, int | None] | None = None,
    facts: Mapping[str, object] | None = None,
) -> None:
    """Make staged datasets current, all at once, by one numbered file that must not exist yet.

    Each commit file says where all datasets of ``root`` lie, so a reader needs the
    newest only. It is built on the commit before it, its parent, and put in place
    whole: of two publishers that build on the same parent one finds the number
    taken and builds anew on the other's commit, so neither is lost. Datasets in
    ``append`` gain a part and keep the ones they have; of those in ``parts`` (path by
    part, None for one that is empty now) the named parts are replaced. ``based_on`` has the commit numbers of datasets
    that the staged rows were made from: where one has changed, ``StaleSnapshot`` is raised.
    ``facts`` are small values, such as the input used up so far, that become current along.
    """
    for _ in range(COMMIT_ATTEMPTS):
        known = _commit_files(spark, root)
        number = _number(known[-1]) + 1 if known else 0
        parent = _newest(spark, known)
        datasets = dict(parent["datasets"])
        for name, seen in (based_on or {}).items():
            if datasets.get(name, {}).get("number") != seen:
                raise StaleSnapshot(f"{name} under {root} has changed since it was read")
        for name, path in paths.items():
            before = datasets[name]["paths"] if name in append and name in datasets else []
            datasets[name] = {"publication_id": publication_id, "number": number, "paths": [*before, path]}
        for name, changed in (parts or {}).items():
            kept = {**datasets.get(name, {}).get("parts", {}), **changed}
            kept = {part: path for part, path in kept.items() if path}
            datasets[name] = {
                "publication_id": publication_id, "number": number, "paths": [kept[k] for k in sorted(kept)], "parts": kept,
            }
        commit = {
            "number": number, "parent": parent.get("number"), "publication_id": publication_id, "datasets": datasets,
            "facts": {**parent.get("facts", {}), **(facts or {})},
        }
        if _place_new(spark, f"{root}/manifest/{number:012d}.json", json.dumps(commit) + "\n"):
            _fold(spark, root)
            return
    raise RuntimeError(f"other publishers kept taking the next number under {root}")


def publish_snapshots(
    datasets: dict[str, DataFrame], root: str, publication_id: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Replace several datasets together, or none of them."""
    paths = stage_snapshots(datasets, root, publication_id, partition_by)
    commit_snapshots(next(iter(datasets.values())).sparkSession, root, publication_id, paths)
    return paths


def current_parts(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Where the published parts of each dataset lie; empty before the first publication."""
    return {name: d["paths"] for name, d in _last_commit(spark, root)["datasets"].items()}


def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Where the published version of each dataset lies; for appended datasets the newest part."""
    return {name: parts[-1] for name, parts in current_parts(spark, root).items()}


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    return current_paths(spark, root).get(name)


def is_published(spark: SparkSession, root: str, publication_id: str) -> bool:
    return publication_id in _history(spark, root)["publications"]


def published_as(spark: SparkSession, root: str, name: str) -> str | None:
    """The publication id of a dataset's current version."""
    return _last_commit(spark, root)["datasets"].get(name, {}).get("publication_id")


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    parts = current_parts(spark, root).get(name)
    if not parts:
        raise FileNotFoundError(f"{name} was never published under {root}")
    return spark.read.parquet(*parts)


def expire_snapshots(spark: SparkSession, root: str, name: str, keep: int = 2) -> None:
    """Delete versions older than the newest ``keep`` publications of a dataset.

    Only committed versions go: what another publisher has staged and not committed
    yet is spared. Commit files that no kept version needs go too.
    """
    if keep < 1:
        raise ValueError("the current version has to be kept")
    versions = {int(number): paths for number, paths in _history(spark, root)["versions"].get(name, {}).items()}
    newest = sorted(versions, reverse=True)[:keep]
    needed = {path for number in newest for path in versions[number]}
    for number in versions:
        for path in versions[number]:
            if path not in needed:
                delete_path(spark, path)
    current = _last_commit(spark, root)["datasets"]
    if set(current) == {name}:  # other datasets may still need their older commits
        for path in _commit_files(spark, root)[:-1]:
            if newest and _number(path) < newest[-1]:
                delete_path(spark, path.toString())


def merge_parts(
    rows: DataFrame, root: str, name: str, publication_id: str, part: Column,
    merge: Callable[[DataFrame | None, DataFrame], DataFrame], keys: Sequence[str] = (),
) -> None:
    """Publish a dataset kept in parts, with new files for the parts that ``rows`` touch only.

    ``part`` gives a row's part (an int) and must never change for a key. ``merge(stored, rows)``
    gets the stored rows of the touched parts, None before the first publication, and
    gives their new content. All other parts stay the files they are. Rows are
    computed once, into a staging folder. A run that broke off before its commit is
    repeated under its id.

    ``keys`` say that ``merge`` lets rows replace the stored ones of the same key; parts are
    then merged by one shuffle that also deals them for writing. ``rows`` that bring ``_part``
    are dealt by it already.
    """
    spark = rows.sparkSession
    seen = version_of(spark, root, name)
    dealt = "_part" in rows.columns
    if seen is None:
        merged = merge(None, rows)
        merged = merged if dealt else merged.withColumn("_part", part.cast("int"))
        staged = stage_parts(merged, root, name, publication_id, (), dealt)
        commit_snapshots(spark, root, publication_id, {}, parts={name: staged}, based_on={name: None})
        return
    arrived = f"{root}/{name}/_incoming-{publication_id}"
    (rows if dealt else rows.withColumn("_part", part.cast("int"))).write.mode("overwrite").parquet(arrived)
    incoming = spark.read.parquet(arrived)
    # One small integer per touched part comes back to the driver.
    touched = [row[0] for row in incoming.select("_part").distinct().collect()]
    in_parts = has_parts(spark, root, name)
    if touched or not in_parts:  # one that was published whole until now gets parts
        stored = read_parts(spark, root, name, touched) if in_parts else read_snapshot(spark, root, name)
        one_shuffle = bool(keys) and in_parts
        if one_shuffle:
            slices = 1 + (estimated_bytes(stored) + estimated_bytes(incoming)) // len(touched) // MERGE_BYTES
            merged = _replace_by_part(stored.withColumn("_part", part.cast("int")), incoming, keys, slices)
        else:
            merged = merge(stored, incoming.drop("_part")).withColumn("_part", part.cast("int"))
        staged = stage_parts(merged, root, name, publication_id, touched if in_parts else (), one_shuffle)
        commit_snapshots(spark, root, publication_id, {}, parts={name: staged}, based_on={name: seen})
    delete_path(spark, arrived)


def _replace_by_part(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], slices: int) -> DataFrame:
    """``merge_replace`` of rows with ``_part``, after which each task holds whole parts, or slices of large ones.

    As in a join, a key with a NULL equals no other.
    """
    both = stored.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    dealt = both.withColumn("_slice", F.pmod(F.hash(*keys), F.lit(slices))).repartition("_part", "_slice")
    known = reduce(and_, (F.col(k).isNotNull() for k in keys))
    replaced = known & F.max("_new").over(Window.partitionBy("_part", "_slice", *keys))
    return dealt.withColumn("_replaced", replaced).filter("_new OR NOT _replaced").drop("_new", "_slice", "_replaced")


def version_of(spark: SparkSession, root: str, name: str) -> int | None:
    """The commit number of a dataset's current version, None before the first."""
    return _last_commit(spark, root)["datasets"].get(name, {}).get("number")


def facts_of(spark: SparkSession, root: str) -> dict:
    return _last_commit(spark, root).get("facts", {})


def has_parts(spark: SparkSession, root: str, name: str) -> bool:
    return "parts" in _last_commit(spark, root)["datasets"].get(name, {})


def part_paths(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """Where each current part of a dataset lies."""
    return dict(_last_commit(spark, root)["datasets"].get(name, {}).get("parts", {}))


def read_parts(spark: SparkSession, root: str, name: str, parts: Sequence[int]) -> DataFrame:
    """The current rows of the named parts alone; other parts are neither listed nor read."""
    dataset = _last_commit(spark, root)["datasets"][name]
    paths = [dataset["parts"][str(k)] for k in parts if str(k) in dataset["parts"]]
    if paths:
        return spark.read.parquet(*paths)
    return spark.read.parquet(dataset["paths"][0]).filter("false")


def stage_parts(
    rows: DataFrame, root: str, name: str, publication_id: str, touched: Sequence[int], dealt: bool = False
) -> dict[str, str | None]:
    """Write rows (with _part) beside the published ones; path by part, None for touched parts without rows.

    Where no part of the dataset is left, an empty one keeps its columns.
    """
    spark = rows.sparkSession
    staged = stage_snapshots({name: rows}, root, publication_id, {name: ["_part"]}, dealt)[name]
    paths: dict[str, str | None] = {str(k): None for k in touched}
    paths |= {text.removeprefix("_part="): f"{staged}/{text}" for text in names_of(spark, f"{staged}/_part=*")}
    others = part_paths(spark, root, name).keys() - paths.keys()
    if not any(paths.values()) and not others:
        paths["none"] = stage_snapshots({name: rows.drop("_part")}, root, publication_id)[name]
    return paths


def seed_if_absent(df: DataFrame, path: str) -> None:
    """Write a first version of a table; an existing table is left as it is."""
    df.write.mode("ignore").parquet(path)


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Create the table, or append to it if it exists."""
    _save_table(df, table, partition_by, path, "append")


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Create the table, or replace its whole content."""
    _save_table(df, table, partition_by, path, "overwrite")


def _save_table(df: DataFrame, table: str, partition_by: Sequence[str], path: str | None, mode: str) -> None:
    # Rows of one partition value go to few tasks, so partitions get few files;
    # adaptive execution splits a value that holds too much for one task.
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode(mode).format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append_report(report: DataFrame, path: str) -> None:
    """Add one run's quality report; a single small file, visible whole or not at all."""
    report.coalesce(1).write.mode("append").parquet(path)


def upsert_buckets(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    transaction: str,
    buckets: int = 64,
    version: Sequence[str] = (),
    bucket_by: Column | None = None,
    delta_share: float = DELTA_SHARE,
) -> None:
    """Upsert ``source`` (one row per key) into a table spread over key buckets.

    A batch that is small beside the buckets it touches is stored as a delta, so it
    writes about its own size; ``read_buckets`` merges the deltas while reading. Once
    the waiting deltas and the batch have more than ``delta_share`` of those buckets' bytes,
    they are merged in: only touched buckets are read and rewritten. A table that grows by
    many batches would so be rewritten again and again; a merge therefore also waits until all
    merges together have rewritten at most ``REWRITE_SHARE`` of the bytes that ever arrived
    (not with a ``delta_share`` of 0, which merges each batch at once).

    The source is computed once, into a staging folder. New content of buckets is
    staged whole before it is moved in: a run that broke off in between is finished
    by the next, so no row is lost. The transaction must name one set of rows for good:
    what it staged is used again, whatever ``source`` holds then. With ``version`` a
    matched row is replaced only by an equal or newer one. There must be one writer at a time.

    The bucket of a key must never change. By default it is a hash of the keys.
    ``bucket_by`` may give ranges of a growing id instead (such as id DIV width),
    so that a batch of recent orders touches few buckets of a large table.
    """
    spark = source.sparkSession
    finish_moves(spark, root, but=transaction)
    if any(path.rsplit("/", 1)[1].partition("-")[2] == transaction for path in _delta_paths(spark, root)):
        return
    if not path_exists(spark, f"{root}/staged/{transaction}/merged/_SUCCESS"):
        arrived = _arrive(source, root, keys, transaction, buckets, bucket_by)
        _count_traffic(spark, root, arrived=_size(spark, arrived))
        if _waits(spark, root, arrived, delta_share):
            _add_delta(spark, root, arrived, transaction, keys, version)
            return
        _merge_staged(spark, root, keys, transaction, version, source.schema)
    move_buckets(spark, root, transaction)


def stage_buckets(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    transaction: str,
    buckets: int = 64,
    version: Sequence[str] = (),
    bucket_by: Column | None = None,
) -> None:
    """Write the new content of the touched buckets beside the table, unless this transaction did so already.

    Deltas that wait are merged along, and dropped once the buckets have been moved in.
    """
    spark = source.sparkSession
    if path_exists(spark, f"{root}/staged/{transaction}/merged/_SUCCESS"):
        return
    finish_moves(spark, root, but=transaction)
    _arrive(source, root, keys, transaction, buckets, bucket_by)
    _merge_staged(spark, root, keys, transaction, version, source.schema)


def _arrive(
    source: DataFrame, root: str, keys: Sequence[str], transaction: str, buckets: int, bucket_by: Column | None
) -> str:
    """Compute the batch once, with each row's bucket."""
    path = f"{root}/staged/{transaction}/incoming"
    hashed = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    columns = source.withColumn("_bucket", (hashed if bucket_by is None else bucket_by).cast("int"))
    columns.write.mode("overwrite").parquet(path)
    return path


def _with_bucket(columns: T.StructType) -> T.StructType:
    return T.StructType([*(f for f in columns.fields if f.name != "_bucket"), T.StructField("_bucket", T.IntegerType())])


def _delta_paths(spark: SparkSession, root: str) -> list[str]:
    """Deltas that were written whole, oldest first."""
    return [f"{root}/deltas/{name}" for name in names_of(spark, f"{root}/deltas/*-*")]


def _waits(spark: SparkSession, root: str, arrived: str, share: float) -> bool:
    """Whether a batch is small enough, with the deltas there are, to be stored as a delta."""
    if not path_exists(spark, f"{root}/state"):
        return False
    waiting = [arrived, *_delta_paths(spark, root)]
    rows = spark.read.schema("_bucket int").parquet(*waiting)
    # One small integer per touched bucket comes back to the driver.
    touched = [row[0] for row in rows.distinct().collect()]
    there, more = sum(_bucket_sizes(spark, root, touched)), sum(_size(spark, path) for path in waiting)
    if more <= share * there:
        return True
    traffic = _traffic(spark, root)
    paid = traffic["rewritten"] + there + more <= REWRITE_SHARE * traffic["arrived"]
    if share and not paid:
        return True
    _count_traffic(spark, root, rewritten=there + more)
    return False


def _bucket_sizes(spark: SparkSession, root: str, touched: Sequence[int]) -> list[int]:
    """Bytes of each of the buckets that is stored."""
    stored = [f"{root}/state/_bucket={k}" for k in touched]
    return [_size(spark, path) for path in stored if path_exists(spark, path)]


def _traffic(spark: SparkSession, root: str) -> dict[str, int]:
    """Bytes that have arrived and that merges have rewritten. They decide when to merge, never what is read,
    so a file that a broken-off run left unfinished counts as none."""
    path = f"{root}/_traffic.json"
    text = _read_text(spark, path) if path_exists(spark, path) else ""
    return json.loads(text) if text.endswith("}\n") else {"arrived": 0, "rewritten": 0}


def _count_traffic(spark: SparkSession, root: str, **more: int) -> None:
    now = {name: size + more.get(name, 0) for name, size in _traffic(spark, root).items()}
    _write_text(spark, f"{root}/_traffic.json", json.dumps(now) + "\n")


def _add_delta(
    spark: SparkSession, root: str, arrived: str, transaction: str, keys: Sequence[str], version: Sequence[str]
) -> None:
    """One rename makes the batch part of the table."""
    _place_new(spark, f"{root}/_merge_on.json", json.dumps({"keys": list(keys), "version": list(version)}))
    there = names_of(spark, f"{root}/deltas/*-*")
    number = int(there[-1].split("-")[0]) + 1 if there else 0
    move_path(spark, arrived, f"{root}/deltas/{number:012d}-{transaction}")
    delete_path(spark, f"{root}/staged/{transaction}")


def _merge_staged(
    spark: SparkSession, root: str, keys: Sequence[str], transaction: str, version: Sequence[str], columns: T.StructType
) -> None:
    """Stage the buckets that the batch and the waiting deltas touch, as they are to be."""
    staged, shape = f"{root}/staged/{transaction}", _with_bucket(columns)
    deltas = _delta_paths(spark, root)
    if deltas:
        _write_text(spark, f"{staged}/merged-deltas.json", json.dumps(deltas))
    merged = incoming = spark.read.schema(shape).parquet(f"{staged}/incoming")
    if path_exists(spark, f"{root}/state"):
        batches = [*deltas, f"{staged}/incoming"]
        # One small integer per touched bucket comes back to the driver.
        touched = [row[0] for row in spark.read.schema("_bucket int").parquet(*batches).distinct().collect()]
        stored = spark.read.schema(shape).parquet(f"{root}/state").filter(F.col("_bucket").isin(touched))
        if not fits_broadcast(spark.read.schema(shape).parquet(*batches)):
            largest = max(_bucket_sizes(spark, root, touched), default=0)
            slices = 1 + (largest + sum(_size(spark, path) for path in batches) // len(touched)) // MERGE_BYTES
            newest = _newest_by_bucket(stored, batches, keys, version, slices)
            newest.write.mode("overwrite").partitionBy("_bucket").parquet(f"{staged}/merged")
            return
        if deltas:
            merged = _merge_deltas(stored, batches, keys, version)
        else:
            merged = merge_newer(stored, incoming, keys, version) if version else merge_replace(stored, incoming, keys)
    merged.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{staged}/merged")


def _newest_by_bucket(
    stored: DataFrame, batches: Sequence[str], keys: Sequence[str], version: Sequence[str], slices: int
) -> DataFrame:
    """``_merge_deltas`` by one shuffle, after which each task holds whole buckets or slices of them, ready to be written.

    The stored rows count as the batch before all others. Of a key's rows the newest version stays, of
    equal ones the last; a first row without a version stays for good.
    """
    spark = stored.sparkSession
    rows = stored.withColumn("_batch", F.lit(-1))
    for number, path in enumerate(batches):
        rows = rows.unionByName(spark.read.schema(stored.schema).parquet(path).withColumn("_batch", F.lit(number)))
    dealt = rows.withColumn("_slice", F.pmod(F.hash(*keys), F.lit(slices))).repartition("_bucket", "_slice")
    by_key = ["_bucket", "_slice", *keys]
    order = [F.desc("_batch")]
    if len(version) == 1:
        dealt = dealt.withColumn("_first", F.min("_batch").over(Window.partitionBy(*by_key)))
        stays = F.col(version[0]).isNull() & (F.col("_batch") == F.col("_first"))
        order = [F.desc(stays), F.desc(version[0]), *order]
    elif version:
        order = [F.desc(F.struct(*version)), *order]
    return latest_per_key(dealt, by_key, order).select(*stored.columns)


def _merge_deltas(stored: DataFrame, batches: Sequence[str], keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The stored rows after all batches, as if they had been merged one after the other."""
    spark = stored.sparkSession
    rows = None
    for number, path in enumerate(batches):
        one = spark.read.schema(stored.schema).parquet(path).withColumn("_batch", F.lit(number))
        rows = one if rows is None else rows.unionByName(one)
    whole = F.struct(*stored.columns)
    by_key = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys))
    if not version:
        return merge_replace(stored, by_key.agg(F.max_by(whole, "_batch").alias("row")).select("row.*"), keys)
    own = F.col(version[0]) if len(version) == 1 else F.struct(*version)
    # Merged one by one, a new key that comes without a version keeps that row for good;
    # else the newest version stays, of equal ones the last.
    newest = F.max_by(whole, F.when(own.isNotNull(), F.struct(own, F.col("_batch")))).alias("newest")
    unversioned = F.min_by(F.when(own.isNull(), whole), "_batch").alias("unversioned")
    if fits_broadcast(rows):  # the stored rows need no shuffle

        def kept(best: Column, name: str) -> DataFrame:
            return by_key.agg(best).filter(f"{name} IS NOT NULL").select(f"{name}.*")

        if len(version) == 1:
            stored = merge_newer(stored, kept(unversioned, "unversioned"), keys, version)
        return merge_newer(stored, kept(newest, "newest"), keys, version)
    # Both come from one aggregation, and the stored rows are joined once.
    best = by_key.agg(newest, unversioned)
    held = stored.select(*(F.col(k).alias(f"_held_{k}") for k in keys), own.alias("_held_at"), whole.alias("held"))
    same = reduce(and_, (F.col(f"_held_{k}") == F.col(f"_{k}") for k in keys))
    at = F.col(f"newest.{version[0]}") if len(version) == 1 else F.struct(*(F.col(f"newest.{c}") for c in version))
    later = F.col("newest").isNotNull() & F.coalesce(at >= F.col("_held_at"), F.lit(False))
    new = F.coalesce("unversioned", "newest")
    row = F.when(F.col("held").isNull(), new).when(later, F.col("newest")).otherwise(F.col("held"))
    return held.join(best, same, "full_outer").select(row.alias("row")).select("row.*")


def move_buckets(spark: SparkSession, root: str, transaction: str) -> None:
    """Put staged buckets in the place of the stored ones, by renaming their folders.

    A stored bucket is set aside before the new one takes its place, and nothing is
    deleted until all have moved. Buckets that a broken-off move has moved already are
    no longer staged, so a repetition does the rest. Deltas that were merged along go
    last, the oldest first: what is left of them in a broken-off run is the last
    word on its keys, and merging it once more changes nothing.
    """
    staged = f"{root}/staged/{transaction}"
    if path_exists(spark, f"{staged}/merged/_SUCCESS"):
        for name in names_of(spark, f"{staged}/merged/_bucket=*"):
            target, aside = f"{root}/state/{name}", f"{staged}/replaced/{name}"
            if path_exists(spark, target):
                if path_exists(spark, aside):
                    delete_path(spark, target)  # half a copy, where a rename copies
                else:
                    move_path(spark, target, aside)
            move_path(spark, f"{staged}/merged/{name}", target)
        _file_system(spark, root)[0].mkdirs(_file_system(spark, f"{root}/state")[1])
        if path_exists(spark, f"{staged}/merged-deltas.json"):
            for path in json.loads(_read_text(spark, f"{staged}/merged-deltas.json")):
                delete_path(spark, path)
    delete_path(spark, staged)


def finish_moves(spark: SparkSession, root: str, but: str = "") -> None:
    """Move in what other transactions have staged whole: no later batch may be merged with the rows before it."""
    for transaction in staged_whole(spark, root):
        if transaction != but:
            move_buckets(spark, root, transaction)


def staged_whole(spark: SparkSession, root: str) -> list[str]:
    """Transactions whose new buckets are staged to their end."""
    files, pattern = _file_system(spark, f"{root}/staged/*/merged/_SUCCESS")
    found = files.globStatus(pattern) or []
    return sorted(status.getPath().getParent().getParent().getName() for status in found)


def read_buckets(spark: SparkSession, root: str, columns: T.StructType) -> DataFrame:
    """The table, with the deltas that wait merged in."""
    stored = spark.read.schema(_with_bucket(columns)).parquet(f"{root}/state")
    deltas = _delta_paths(spark, root)
    if deltas:
        how = json.loads(_read_text(spark, f"{root}/_merge_on.json"))
        stored = _merge_deltas(stored, deltas, how["keys"], how["version"])
    return stored.drop("_bucket")
