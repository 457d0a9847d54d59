"""Dimension jobs: first load, and the merge of a silver source into gold."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tierwise import scratch
from tierwise.functions.columns import date_id_from_name, drop_file_columns, file_stamp, with_date_id
from tierwise.operators.keys import dedup_latest, require_unique, split_null_keys
from tierwise.operators.scd1 import measured_bytes, prepared_source, require_columns, scd1_merge
from tierwise.operators.scd2 import VERSION_COLUMNS, late_rows, open_versions, rebuild_history, scd2_merge, splice_versions
from tierwise.scratch import path_exists
from tierwise.sinks.publish import (
    finish_days,
    recover,
    stage_days,
    stage_folders,
    staged_publish,
    write_partitioned,
    write_silver,
)
from tierwise.sinks.versions import manifest, publish_folders, roll_forward
from tierwise.sources.catalog import quoted
from tierwise.sources.files import ingest, read_layer
from tierwise.spec import DatasetSpec, ScdSpec

log = logging.getLogger(__name__)

STAMP = "__stamp"
# Folder names of a type 2 dimension: current versions, the record of deliveries, and the file in it that says
# the record goes back to the first one.
CURRENT, SEEN, FROM_START = "is_current=true", "_seen", "_from_start"


def initial_load(
    spark: SparkSession, first: DatasetSpec, gold_path: str, then: DatasetSpec | None = None, table: str | None = None
) -> None:
    """Seed a gold dimension by ``date_id`` from one snapshot and silver from the next.

    Refuses to replace an existing dimension.  With ``table`` it is a versioned one.
    """
    seed = ingest(spark, first)
    if seed.frame is None:
        raise FileNotFoundError(f"{first.name}: {seed.reason}")
    if path_exists(spark, gold_path):
        raise FileExistsError(f"{gold_path} already exists")
    rows = with_date_id(seed.frame).drop("filename")
    if table:
        publish_folders(spark, rows, table, gold_path, ["date_id"])
    else:
        staged_publish(spark, rows, gold_path, partition_by="date_id")
    if then is not None:
        later = ingest(spark, then)
        if later.frame is None:
            raise FileNotFoundError(f"{then.name}: {later.reason}")
        write_silver({then.name: later.frame}, {then.name: then})


def dimension_source(silver: DataFrame) -> DataFrame:
    """Silver rows in the dimension's shape: ``date_id`` from the file name, no file columns.

    The file's stamp stays as a helper that orders several rows of one key.
    """
    name = F.col("filename")
    return drop_file_columns(silver.withColumns({"date_id": date_id_from_name(name), STAMP: file_stamp(name)}))


def merge_dimension(
    spark: SparkSession,
    spec: ScdSpec,
    effective: datetime.date | None = None,
    quarantine_path: str | None = None,
) -> int:
    """Merge the source into the target path and publish it there; returns its row count.

    No source row is lost without a trace: those with an incomplete key go to a folder of
    ``quarantine_path`` for their batch; where one is needed and not given, the job fails before it
    writes.  A batch is named by its date, or else by the newest stamp of its files, so a rerun replaces
    it.  Type 2 batches may come in any order.  Only a history published before its deliveries were
    recorded has no place for earlier changes: they go to ``late_path`` in the same way.
    """
    silver = read_layer(spark, spec.source_path)
    source = dimension_source(silver.filter(spec.source_filter) if spec.source_filter else silver)
    order_by = spec.order_by or (STAMP,)
    batch_name = effective.isoformat() if effective else source.agg(F.max(STAMP)).first()[0]
    _, rejected = split_null_keys(source, spec.join_keys)
    set_aside(rejected.drop(STAMP), quarantine_path, batch_name, f"{spec.source_path}: rows without a key")
    if spec.scd_type == "scd2":
        return _merge_versions(spark, spec, source, order_by, effective or datetime.date.today(), batch_name)
    if spec.versioned:
        roll_forward(spark, spec.table, spec.target_path.rstrip("/"))
    else:
        recover(spark, spec.target_path)  # a crash between two renames leaves only the backup
        if len(spec.partition_by) == 1:
            finish_days(spark, spec.target_path.rstrip("/"))
    target = read_target(spark, spec)
    # computed once: the checks, the choice of the days and the merge all read it
    staged = scratch.work_dir(spark, "batch")
    prepared_source(source, target, spec.join_keys, order_by).write.parquet(staged)
    try:
        return _merge_batch(spark, spec, spark.read.parquet(staged), target)
    finally:
        scratch.delete(spark, staged)


def read_target(spark: SparkSession, spec: ScdSpec) -> DataFrame:
    return spark.table(quoted(spec.table)) if spec.versioned else read_layer(spark, spec.target_path)


def _merge_batch(spark: SparkSession, spec: ScdSpec, batch: DataFrame, target: DataFrame) -> int:
    """Merge a reduced batch into the published target."""
    size = measured_bytes(batch)
    if spec.delete_missing and size == 0:
        raise ValueError(f"{spec.source_path}: an empty source would delete the whole dimension")
    small = size <= spec.broadcast_limit_bytes
    log.info("merging %s into %s, small source: %s", spec.source_path, spec.target_path, small)
    if spec.check_target:
        require_unique(split_null_keys(target, spec.join_keys)[0], spec.join_keys, spec.target_path)
    merge = partial(
        scd1_merge,
        batch,
        keys=spec.join_keys,
        compare=spec.compare,
        metadata_cols=spec.metadata_cols,
        compare_exclude=spec.compare_exclude,
        delete_missing=spec.delete_missing,
        small_source=small,
    )
    if small and not spec.delete_missing and _replace_days(spark, spec, merge, batch, target):
        return read_target(spark, spec).count()
    if spec.versioned:
        return publish_folders(spark, merge(target), spec.table, spec.target_path, spec.partition_by, rebalance=not small)
    # A small source leaves target rows in their scan tasks, each of few dates: no shuffle to write.
    return staged_publish(
        spark, merge(target), spec.target_path, "parquet", spec.partition_by, rebalance=not small
    )


def _replace_days(
    spark: SparkSession,
    spec: ScdSpec,
    merge: Callable[[DataFrame], DataFrame],
    batch: DataFrame,
    target: DataFrame,
) -> bool:
    """Rewrite only the date folders a small batch touches, if they are the minority.

    Those are the folders of matched target rows and of the batch's own dates.  False,
    with the target unchanged, when the whole dimension has to be rewritten after all.
    """
    path, column = spec.target_path.rstrip("/"), spec.partition_by[0] if spec.partition_by else None
    if len(spec.partition_by) != 1 or not isinstance(target.schema[column].dataType, DateType):
        return False
    keys = list(spec.join_keys)
    hit = target.select(*keys, column).join(F.broadcast(batch.select(*keys)), keys, "left_semi")
    dates = hit.select(column).unionByName(batch.select(column)).distinct()
    days = [row[0] for row in dates.collect()]  # one row per folder
    existing = manifest(spark, path).folders if spec.versioned else scratch.list_names(spark, path)
    existing = [n for n in existing if n.startswith(f"{column}=")]
    if None in days or 2 * len(days) > len(existing):
        return False
    touched = target.join(F.broadcast(dates), column, "left_semi").select(*target.columns)
    folders = [f"{column}={d}" for d in days]
    if spec.versioned:
        publish_folders(spark, merge(touched), spec.table, path, [column], whole=False, emptied=folders)
        return True
    stage_days(spark, merge(touched), path, column, folders)
    return finish_days(spark, path)


def set_aside(rows: DataFrame, path: str | None, batch: str | None, what: str) -> int:
    """Write ``rows`` to the batch's own folder below ``path``; returns their number.

    A batch without such rows leaves no folder of an earlier run behind.
    """
    spark = rows.sparkSession
    count = rows.count()
    if count and not path:
        raise ValueError(f"{what}: {count}, and no folder to set them aside in")
    if path:
        folder = f"{path.rstrip('/')}/batch={batch}"
        if count:
            write_partitioned(rows, folder)
            log.warning("%s: %d, set aside in %s", what, count, folder)
        else:
            scratch.delete(spark, folder)
    return count


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """A published type 2 dimension; folder values come back with their declared types."""
    history = spark.read.option("basePath", path).parquet(path)
    columns = [c for c in history.columns if c not in VERSION_COLUMNS]
    types = {"is_current": "boolean", "effective_to": "date"}
    return history.withColumns({c: F.col(c).cast(t) for c, t in types.items()}).select(
        *columns, *VERSION_COLUMNS
    )


def _merge_versions(
    spark: SparkSession,
    spec: ScdSpec,
    source: DataFrame,
    order_by: tuple[str, ...],
    effective: datetime.date,
    batch_name: str | None,
) -> int:
    """Type 2 merge whose cost follows the current versions, not the history.

    Current versions live in one folder, closed ones in a folder per closing date, and beside them is
    written which keys were delivered on which day.  A batch of a new day reads and replaces the current
    folder and adds the day's closing folder.  One of an earlier day, or of one that was delivered
    before, is spliced into the versions of its keys: it reads the folders that close on its day or later
    and replaces those that it changes.  Batches give the same history in any order.

    The new folders are staged and listed, then moved in; a run after a crash moves the rest first.
    """
    exclude = [*spec.metadata_cols, *spec.compare_exclude]
    source = source.drop(*[c for c in spec.partition_by if c not in spec.join_keys])
    path, keys = spec.target_path.rstrip("/"), list(spec.join_keys)
    finish_days(spark, path)
    recover(spark, f"{path}/{CURRENT}")
    if path_exists(spark, f"{path}/{CURRENT}"):
        history = read_history(spark, path)
        current = history.filter("is_current")
        if spec.check_target:
            require_unique(split_null_keys(current, keys)[0], keys, path)
        newest = current.agg(F.max("effective_from")).first()[0]
    else:
        history = current = open_versions(source.drop(STAMP), keys, effective, exclude).limit(0)
        newest = None
    days = delivered_days(spark, path)
    behind = newest is not None and effective <= max([newest, *days])
    complete = path_exists(spark, f"{path}/{SEEN}/{FROM_START}") or bool(days) and effective >= min(days)
    if newest is None:
        scratch.write_text(spark, f"{path}/{SEEN}/{FROM_START}", "")

    spliced = None
    if behind and complete:
        spliced = scratch.work_dir(spark, "splice")
        seen = read_seen(spark, path, [d for d in days if d > effective], current, keys)
        splice_versions(source, history, seen, keys, effective, exclude, order_by).write.parquet(spliced)
        rows, folders = _respliced(spark, history, spark.read.parquet(spliced), keys)
    else:
        late = late_rows(source, current, keys, effective, exclude, order_by)
        set_aside(late, spec.late_path, batch_name, f"{path}: changes older than the record of deliveries")
        small = measured_bytes(source) <= spec.broadcast_limit_bytes
        merged = scd2_merge(source, current, keys, effective, exclude, order_by, small_source=small)
        closing = closed_folder(effective)
        if path_exists(spark, f"{path}/{closing}"):  # published before deliveries were recorded
            identity = [*keys, "effective_from"]
            before = history.filter(F.col("effective_to") == F.lit(effective))
            merged = merged.unionByName(before.join(merged.filter("NOT is_current").select(*identity), identity, "left_anti"))
        rows, folders = merged, [CURRENT, closing]
    types = {f.name: f.dataType for f in current.schema}
    delivered = split_null_keys(source, keys)[0].select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
    delivered = delivered.unionByName(read_seen(spark, path, [effective] if effective in days else [], current, keys).select(*keys))
    beside = {f"{SEEN}/day={effective.isoformat()}": (delivered.distinct(), ())}
    stage_folders(spark, path, rows, ["is_current", "effective_to"], folders, beside)
    finish_days(spark, path)
    if spliced:
        scratch.delete(spark, spliced)
    return read_history(spark, path).count()


def append_days(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> int:
    """Merge rows of several days, each with its ``effective_from``, into a type 2 dimension in one pass.

    All days are later than any that was delivered before: the current versions and the rows of a key are
    sequenced together, closed folders are not read, and the days' own are added.  The same as one merge for
    each day, and published like it.  Returns the number of days.
    """
    path = path.rstrip("/")
    finish_days(spark, path)
    extra = [c for c in order_by if c not in rows.columns]
    if extra:
        raise ValueError(f"{path}: no columns {', '.join(extra)} to order by")
    named = split_null_keys(rows, keys)[0]
    days = sorted(r[0] for r in named.select("effective_from").distinct().collect())  # one row for each day
    if not days:
        return 0
    helpers = {*VERSION_COLUMNS, *order_by}
    columns = [c for c in rows.columns if c not in helpers]
    if path_exists(spark, f"{path}/{CURRENT}"):
        current = read_history(spark, path).filter("is_current")
        newest = max([current.agg(F.max("effective_from")).first()[0], *delivered_days(spark, path)])
        if days[0] <= newest:
            raise ValueError(f"{path}: rows of {days[0]}, and {newest} was delivered before")
        require_columns(rows, current, derived=VERSION_COLUMNS)
        columns = [c for c in current.columns if c not in VERSION_COLUMNS]
        types = {f.name: f.dataType for f in current.schema}
        named = named.select(*[F.col(c).cast(types[c]).alias(c) for c in columns], "effective_from", *order_by)
        everything = current.select(*columns, "effective_from").unionByName(named, allowMissingColumns=True)
    else:
        scratch.write_text(spark, f"{path}/{SEEN}/{FROM_START}", "")
        everything = named
    versions = rebuild_history(everything, keys, exclude=exclude, sequence_by=order_by)
    seen = named.select(*keys, F.col("effective_from").alias("day")).distinct()
    folders = [CURRENT, *map(closed_folder, days)]
    stage_folders(spark, path, versions, ["is_current", "effective_to"], folders, {SEEN: (seen, ["day"])})
    finish_days(spark, path)
    return len(days)


def closed_folder(day: datetime.date) -> str:
    return f"is_current=false/effective_to={day.isoformat()}"


def _respliced(
    spark: SparkSession, history: DataFrame, changes: DataFrame, keys: list[str]
) -> tuple[DataFrame | None, list[str]]:
    """The new content of the folders that spliced versions leave or enter, and these folders."""
    identity = [*keys, "effective_from", "effective_to"]
    both = [changes.select(F.explode(c).alias("r")).select("r.*") for c in ("removed", "added")]
    versions = both[0].unionByName(both[1])
    closings = [r[0] for r in versions.select("effective_to").distinct().collect()]  # one row per folder
    if not closings:
        return None, []
    dates = [d for d in closings if d is not None]
    touched = F.col("effective_to").isin(dates) & ~F.col("is_current")
    if None in closings:
        touched = touched | F.col("is_current")
    old = history.filter(touched)
    same = [old[c].eqNullSafe(versions[c]) if c == "effective_to" else old[c] == versions[c] for c in identity]
    rows = old.join(versions, same, "left_anti").unionByName(both[1])
    return rows, [CURRENT] * (None in closings) + [closed_folder(d) for d in dates]


def delivered_days(spark: SparkSession, path: str) -> list[datetime.date]:
    """The days whose deliveries are recorded, see ``read_seen``."""
    names = scratch.list_names(spark, f"{path}/{SEEN}")
    return [datetime.date.fromisoformat(n.removeprefix("day=")) for n in names if n.startswith("day=")]


def read_seen(
    spark: SparkSession, path: str, days: list[datetime.date], like: DataFrame, keys: list[str]
) -> DataFrame:
    """(keys, day): the keys that were delivered on each of ``days``, with the types of ``like``."""
    if not days:
        return like.select(*keys, F.lit(None).cast("date").alias("day")).limit(0)
    root = f"{path}/{SEEN}"
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/day={d.isoformat()}" for d in days])
    return rows.select(*keys, F.col("day").cast("date").alias("day"))
