"""Sinks: partitioned writes, and a staged publish that may replace its own input."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise import scratch
from tierwise.parallel import together
from tierwise.spec import DATE_PARTS, DatasetSpec, SpecError, as_tuple

log = logging.getLogger(__name__)

# Formats every Spark build can write.
BUILT_IN_FORMATS = ("parquet", "orc", "json", "csv")
COUNTED_FORMATS = ("parquet", "orc")  # counting reads footers only
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Names of the small files beside published or staged data; readers skip them.
PLAN, NOTE = "_replaced_folders", "_note"


def _aside(path: str, kind: str) -> str:
    """A folder in a hidden one beside ``path``: readers skip underscores, unless '=' follows."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{kind}/{name.replace('=', '-')}"


def staging_of(path: str) -> str:
    return f"{_aside(path, 'staging')}-{uuid.uuid4().hex[:12]}"


def backup_of(path: str) -> str:
    return _aside(path, "previous")


def days_of(path: str) -> str:
    return _aside(path, "days")


def require_format(spark: SparkSession, file_format: str) -> str:
    """Fail before any work when the session has no such data source."""
    if file_format in BUILT_IN_FORMATS:
        return file_format
    try:
        spark.read.format(file_format).load(scratch.work_dir(spark, "probe"))
    except (PySparkException, Py4JJavaError) as err:
        if "DATA_SOURCE_NOT_FOUND" in str(err):
            raise SpecError(f"output format '{file_format}' is not on this session's classpath") from err
    return file_format


def write_partitioned(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    partition_by: str | Sequence[str] = (),
    dynamic: bool = False,
    rebalance: bool = False,
) -> None:
    """Write hive-style partition folders.

    ``dynamic`` replaces only the folders present in ``df``.  ``rebalance`` gathers each
    folder's rows first, to avoid tasks x folders small files; Spark splits a folder that
    is too large for one task, so a day holding most rows stays parallel.
    """
    columns = as_tuple(partition_by)
    if rebalance and columns:
        df = df.hint("rebalance", *columns)
    writer = df.write.format(file_format).mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)


def write_silver(
    frames: Mapping[str, DataFrame],
    specs: Mapping[str, DatasetSpec],
    dynamic: bool = True,
    parallel: int = 4,
) -> None:
    """Publish every ingested dataset by year, month and day.

    No shuffle by default: a scan task reads few files, hence few days, and writes no
    more files than it read.  A feed of very many small files can ask for ``compact``.
    With ``dynamic`` earlier days survive; without it the whole dataset is replaced.  The
    datasets are independent jobs, ``parallel`` of them submitted at a time.
    """
    for name in frames:
        if not specs[name].output_path:
            raise SpecError(f"dataset {name}: output_path is required to write silver")

    def write(name: str) -> None:
        spec = specs[name]
        log.info("writing silver dataset %s to %s", name, spec.output_path)
        try:
            write_partitioned(
                frames[name],
                spec.output_path,
                "parquet",
                "overwrite",
                DATE_PARTS,
                dynamic=dynamic,
                rebalance=spec.compact,
            )
        except (PySparkException, Py4JJavaError) as err:
            raise RuntimeError(f"silver dataset {name} was not written") from err

    if frames:
        spark = next(iter(frames.values())).sparkSession
        together(spark, {name: partial(write, name) for name in frames}, parallel)


def staged_publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_by: str | Sequence[str] = (),
    rebalance: bool = False,
    expected_rows: int | None = None,
    note: str | None = None,
) -> int | None:
    """Replace ``path`` with ``df``, which may itself read ``path``; returns the row count.

    The result is written beside the target, verified, and swapped in by two renames.  A
    failure before the swap leaves the target untouched; one between the renames leaves
    a backup that ``recover`` puts back.  Renames are not atomic on object stores: there,
    publish through a catalog table (``publish_version``).  Text formats are only counted
    when there is a number to compare with, since that reads them.  ``note`` is a text that is
    published with the data, see ``note_of``.
    """
    recover(spark, path)
    staging = staging_of(path)
    write_partitioned(df, staging, file_format, "errorifexists", partition_by, rebalance=rebalance)
    written = None
    if expected_rows is not None or file_format in COUNTED_FORMATS:
        written = spark.read.format(file_format).load(staging).count()
    if expected_rows is not None and written != expected_rows:
        raise RuntimeError(f"{path}: wrote {written} rows, expected {expected_rows}; target unchanged")
    if note is not None:
        scratch.write_text(spark, f"{staging}/{NOTE}", note)
    swap(spark, staging, path)
    return written


def note_of(spark: SparkSession, path: str) -> str | None:
    return scratch.read_text(spark, f"{path.rstrip('/')}/{NOTE}")


def swap(spark: SparkSession, staging: str, path: str) -> None:
    """Put ``staging`` in the place of ``path``, keeping the old content as one backup."""
    backup = backup_of(path)
    if scratch.path_exists(spark, path):
        scratch.delete(spark, backup)  # safe: the target itself is present
        scratch.make_parents(spark, backup)
        scratch.rename(spark, path, backup)
    scratch.rename(spark, staging, path)


def recover(spark: SparkSession, path: str) -> bool:
    """After a crash: put the backup back if the target is gone.  Staging is ignored."""
    backup = backup_of(path)
    if not scratch.path_exists(spark, path) and scratch.path_exists(spark, backup):
        scratch.rename(spark, backup, path)
        return True
    return False


def stage_days(spark: SparkSession, df: DataFrame, path: str, column: str, days: Sequence[str]) -> None:
    """Write the new content of the folders ``days`` of ``path`` aside; one without rows will go."""
    stage_folders(spark, path, df, [column], days)


def stage_folders(
    spark: SparkSession,
    path: str,
    df: DataFrame | None,
    columns: Sequence[str],
    folders: Iterable[str],
    beside: Mapping[str, tuple[DataFrame, Sequence[str]]] | None = None,
) -> None:
    """Write the new content of ``folders`` of ``path`` aside: ``df`` by ``columns``, and frames for folders of
    their own, each with the columns that it is partitioned by there, if any.

    ``df`` may read ``path`` and has rows of these folders only; one without rows will go.  The list of
    folders is written last: with it the stage is complete, and ``finish_days`` can be repeated until it
    went through.
    """
    staging, folders = days_of(path), set(folders)
    scratch.delete(spark, staging)
    if df is not None:
        write_partitioned(df, staging, partition_by=columns)
    leaves = partition_folders(spark, staging, len(columns))
    replaced = {f for f in folders if any(leaf == f or leaf.startswith(f"{f}/") for leaf in leaves)}
    if strays := {leaf for leaf in leaves if not any(leaf == f or leaf.startswith(f"{f}/") for f in folders)}:
        scratch.delete(spark, staging)
        raise RuntimeError(f"{path}: rows of folders that were not to be replaced: {sorted(strays)}")
    for name, (frame, parts) in (beside or {}).items():
        write_partitioned(frame, f"{staging}/{name}", partition_by=parts)
        leaves = partition_folders(spark, f"{staging}/{name}", len(parts)) if parts else []
        replaced |= {f"{name}/{leaf}" for leaf in leaves} if parts else {name}
    plan = {"replaced": sorted(replaced), "emptied": sorted(folders - replaced)}
    scratch.write_text(spark, f"{staging}/{PLAN}", json.dumps(plan))


def partition_folders(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Names of the partition folders below ``path``, all ``levels`` of them together."""
    found = [""]
    for _ in range(levels):
        found = [f"{at}/{n}" for at in found for n in scratch.list_names(spark, f"{path}{at}") if "=" in n]
    return [name[1:] for name in found]


def finish_days(spark: SparkSession, path: str) -> bool:
    """Move complete staged folders in; after a crash, go on where it stopped, or discard the rest."""
    staging = days_of(path)
    plan = scratch.read_text(spark, f"{staging}/{PLAN}")
    if plan is not None:
        todo = json.loads(plan)
        for name in todo["replaced"]:
            if scratch.path_exists(spark, f"{staging}/{name}"):  # else it was moved before
                scratch.delete(spark, f"{path}/{name}")
                scratch.make_parents(spark, f"{path}/{name}")
                scratch.rename(spark, f"{staging}/{name}", f"{path}/{name}")
        drop_folders(spark, path, todo["emptied"])
    scratch.delete(spark, staging)
    return plan is not None


def drop_folders(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    for name in names:
        scratch.delete(spark, f"{path.rstrip('/')}/{name}")


def folders_of(days: DataFrame, columns: Sequence[str]) -> set[str]:
    """Names of the partition folders that the rows of ``days`` are in: one row for each folder."""
    names = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in columns]
    return {r[0] for r in days.select(F.concat_ws("/", *names)).distinct().collect()}


def publish_version(
    spark: SparkSession, df: DataFrame, table: str, base_path: str, version: str
) -> int:
    """Write ``base_path/version`` and point the external table at it in one catalog change."""
    from tierwise.sources.catalog import create_external_table, repoint_table

    path = f"{base_path}/{version}"
    write_partitioned(df, path, "parquet", "errorifexists")
    if spark.catalog.tableExists(table):
        repoint_table(spark, table, path)
    else:
        create_external_table(spark, table, path)
    return spark.read.parquet(path).count()
