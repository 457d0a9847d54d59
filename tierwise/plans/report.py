"""The report job: feeds -> silver -> join chain -> aggregates and partitioned gold table."""

from __future__ import annotations

import datetime
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.columns import date_id, project
from tierwise.operators.joins import join_chain, unreadable_values
from tierwise.operators.metrics import global_aggregates, grouped_aggregates
from tierwise.operators.quality import quarantine, rule_report, verdicts_by_day
from tierwise.parallel import together
from tierwise.scratch import path_exists
from tierwise.sinks.publish import (
    BUILT_IN_FORMATS,
    drop_folders,
    folders_of,
    require_format,
    staged_publish,
    write_partitioned,
    write_silver,
)
from tierwise.sinks.versions import publish_folders
from tierwise.sources.catalog import create_external_table, quoted, register_views
from tierwise.sources.files import IngestResult, feed_files, frames, ingest_all, latest_day, read_layer
from tierwise.sources.schemas import silver_schema
from tierwise.spec import DATE_PARTS, VIEW_SUFFIX, DatasetSpec, OutputSpec, ReportSpec, SpecError

log = logging.getLogger(__name__)

@dataclass(frozen=True)
class ReportResult:
    ingested: Mapping[str, IngestResult]
    aggregates: Row | None
    metrics: DataFrame | None
    report: DataFrame
    quality: Mapping[str, DataFrame]
    unreadable: Sequence[Row] = ()


def report_chain(silver: Mapping[str, DataFrame], spec: ReportSpec) -> DataFrame:
    return join_chain(silver, spec.joins)


def report_rows(chain: DataFrame, output: OutputSpec) -> DataFrame:
    """The declared projection of the chain with its ``date_id``."""
    columns, parts = output.select, output.date_parts
    if not columns:
        raise SpecError("output: select is required")
    if len(parts) != 3:
        raise SpecError("output: date_parts needs year, month and day")
    day = date_id(*[F.col(p) for p in parts], legacy=output.legacy_date_id).alias("date_id")
    if output.drop_unmatched:
        chain = chain.filter(F.col(parts[0]).isNotNull())
    names = project(chain, columns).columns
    return chain.select(*[F.col(c).alias(n) for c, n in zip(columns, names)], day)


def report_aggregates(chain: DataFrame, spec: ReportSpec) -> DataFrame:
    if spec.group_by:
        return grouped_aggregates(chain, spec.group_by, spec.aggregations, spec.grouping)
    return global_aggregates(chain, spec.aggregations)


def publish_silver(
    spark: SparkSession,
    ingested: Mapping[str, DataFrame],
    specs: Mapping[str, DatasetSpec],
    dynamic: bool = True,
) -> None:
    """Validate, set rejects aside, write silver and register its tables.

    One pass over a feed with rules counts both kinds of rows by day, so that its rejects are only
    written if there are any, and days of which a table has no row any more lose their folder.
    """
    stale: list[tuple[str, str]] = []
    rejects = {}
    for name, frame in ingested.items():
        spec = specs[name]
        if not spec.output_path:
            raise SpecError(f"dataset {name}: output_path is required to write silver")
        if not spec.rules:
            continue
        valid, rejected = quarantine(frame, spec.rules)
        days = verdicts_by_day(frame, spec.rules, DATE_PARTS).collect()  # one row for each day folder
        for day in days:
            folder = "/".join(f"{p}={day[p]}" for p in DATE_PARTS)
            empty = [spec.output_path] * (not day.valid) + [spec.quarantine_path] * (not day.rejected)
            stale += [(path, folder) for path in empty]
        if any(day.rejected for day in days):
            write = partial(write_partitioned, rejected, spec.quarantine_path, "parquet", "overwrite", DATE_PARTS)
            rejects[name] = partial(write, dynamic=dynamic)
        ingested = {**ingested, name: valid}
    together(spark, rejects)
    write_silver(ingested, specs, dynamic=dynamic)
    for path, folder in stale:
        drop_folders(spark, path, [folder])
    for name in ingested:
        if specs[name].table:
            create_external_table(spark, specs[name].table, specs[name].output_path, partitioned=True)


def accounting(
    spark: SparkSession, ingested: Mapping[str, IngestResult], specs: Mapping[str, DatasetSpec]
) -> DataFrame:
    """(dataset, files, undated_files, rows, silver, quarantined) of the days that were read.

    Every row read is in silver or in quarantine, so ``rows = silver + quarantined``.
    """
    found = None
    for name, result in sorted(ingested.items()):
        if result.frame is None:
            continue
        days = folders_of(result.frame, DATE_PARTS)

        def kept(path: str | None, days: set[str] = days) -> Column:
            folders = [f"{path.rstrip('/')}/{d}" for d in days] if path else []
            there = [f for f in folders if path_exists(spark, f)]
            if not there:
                return F.lit(0).cast("long")
            return spark.read.option("basePath", path).parquet(*there).agg(F.count(F.lit(1))).scalar()

        files = feed_files(spark, specs[name])
        row = spark.range(1).select(
            F.lit(name).alias("dataset"),
            files.agg(F.count(F.lit(1))).scalar().alias("files"),
            files.agg(F.count_if(~F.col("dated"))).scalar().alias("undated_files"),
            result.frame.agg(F.count(F.lit(1))).scalar().alias("rows"),
            kept(specs[name].output_path).alias("silver"),
            kept(specs[name].quarantine_path).alias("quarantined"),
        )
        found = row if found is None else found.unionByName(row)
    if found is None:
        schema = "dataset string, files bigint, undated_files bigint, rows bigint, silver bigint, quarantined bigint"
        return spark.createDataFrame([], schema)
    return found


def read_silver(spark: SparkSession, spec: ReportSpec, typed: bool = True) -> dict[str, DataFrame]:
    """The datasets the report uses, with their declared casts if ``typed``.

    Silver keeps earlier days; of a dataset that is not ``all`` only the newest day counts, so an
    older snapshot of the same rows is not joined a second time.
    """
    used = {spec.joins[0].left, *[s.right for s in spec.joins]} if spec.joins else set(spec.datasets)
    frames = {}
    for name in sorted(used):
        dataset = spec.datasets[name]
        casts = dict(dataset.casts) if typed else None
        frame = read_layer(spark, dataset.output_path, casts, schema=silver_schema(spark, dataset))
        newest = None if dataset.snapshot == "all" else latest_day(spark, dataset.output_path)
        frames[name] = frame if newest is None else frame.filter(newest)
    return frames


def since(
    silver: Mapping[str, DataFrame], output: OutputSpec, from_day: datetime.date
) -> dict[str, DataFrame]:
    """Silver with the dataset that dates the report cut to ``from_day`` and later.

    Folders of earlier days are not read, and only later gold days are replaced.
    """
    if not (output.dynamic and output.drop_unmatched):
        raise SpecError("output: from_day needs dynamic and drop_unmatched, or older days would be lost")
    dated, day = dated_by(output)
    return {**silver, dated: silver[dated].filter(day >= F.lit(from_day))}


def dated_by(output: OutputSpec) -> tuple[str, Column]:
    """The dataset that dates the report, and the day of its rows."""
    parts = output.date_parts
    day = date_id(*[F.col(p.rsplit(".", 1)[-1]) for p in parts], legacy=output.legacy_date_id)
    return parts[0].split(".")[0].removesuffix(VIEW_SUFFIX), day


def publish_report(
    spark: SparkSession, rows: DataFrame, output: OutputSpec, days: DataFrame | None = None
) -> None:
    """Replace the gold table, or with ``dynamic`` only the days in ``rows``.

    ``days`` (date_id) are those that the run has read: of them, the ones without a row any more
    lose their folder.  File formats are swapped in after they are complete: an overwrite in place
    would delete the old table first and leave nothing behind a failed job.  A ``versioned`` table is
    published through the catalog instead.
    """
    if output.versioned:
        known = output.dynamic and days is not None and output.partition_by == ("date_id",)
        emptied = folders_of(days, ["date_id"]) if known else ()
        publish_folders(spark, rows, output.table, output.path, output.partition_by, whole=not output.dynamic, emptied=emptied)
        return
    if output.dynamic and days is not None and output.partition_by == ("date_id",):
        drop_folders(spark, output.path, folders_of(days, ["date_id"]) - folders_of(rows, ["date_id"]))
    if output.dynamic or output.format not in BUILT_IN_FORMATS:
        write_partitioned(
            rows,
            output.path,
            output.format,
            "overwrite",
            output.partition_by,
            dynamic=output.dynamic,
            rebalance=True,
        )
    else:
        staged_publish(spark, rows, output.path, output.format, output.partition_by, rebalance=True)
    if output.table:
        create_external_table(spark, output.table, output.path, output.format, bool(output.partition_by))


def write_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """The aggregates of one run, with the time; a repeated run replaces its own."""
    stamped = metrics.withColumns({"recorded_at": F.current_timestamp(), "run_id": F.lit(run_id)})
    write_partitioned(stamped, path, mode="overwrite", partition_by="run_id", dynamic=True)


def run_report(
    spark: SparkSession,
    spec: ReportSpec,
    metrics_path: str | None = None,
    run_id: str | None = None,
    dynamic_silver: bool = True,
    preview: int = 0,
    from_day: datetime.date | None = None,
) -> ReportResult:
    """Run the whole job.

    After the silver writes there are two actions, one row of aggregates and the gold write, and beside
    the first a count of the values that casts and keys lose.  ``metrics_path`` adds the aggregates to a table, as those of ``run_id``, instead of
    returning that row; grouped aggregates come back as the ``metrics`` frame.  ``preview`` shows rows of
    the gold table.  ``from_day`` limits the run to later days, see ``since``.  The result's
    ``quality`` holds a rule report per dataset with rules, computed when it is read, and ``unreadable`` the
    numbers of values that a cast or a join key has made null (``unreadable_values``); they are logged as well.
    """
    require_format(spark, spec.output.format)
    ingested = ingest_all(spark, spec.datasets.values())
    read = frames(ingested)
    publish_silver(spark, read, spec.datasets, dynamic_silver)
    silver, untyped = read_silver(spark, spec), read_silver(spark, spec, typed=False)
    if from_day:
        silver, untyped = since(silver, spec.output, from_day), since(untyped, spec.output, from_day)
    register_views(spark, silver)
    chain = report_chain(silver, spec)

    casts = {n: spec.datasets[n].casts for n in untyped}
    actions = {"unreadable": lambda: unreadable_values(untyped, spec.joins, casts).collect()}  # one row for each such column
    metrics = report_aggregates(chain, spec) if spec.aggregations else None
    if metrics is not None and metrics_path:
        actions["metrics"] = lambda: write_metrics(metrics, metrics_path, run_id or uuid.uuid4().hex)
    elif metrics is not None and not spec.group_by:
        actions["aggregates"] = metrics.first
    done = together(spark, actions)
    unreadable, aggregates = done["unreadable"], done.get("aggregates")
    if aggregates is not None:
        log.info("aggregates: %s", aggregates.asDict())
    for bad in unreadable:
        if bad.bad_values:
            log.warning("dataset %s: %d values of %s are not %s (%s)", *(bad[c] for c in ("dataset", "bad_values", "column", "as_type", "used_as")))

    rows = report_rows(chain, spec.output)
    dated, day = dated_by(spec.output)
    publish_report(spark, rows, spec.output, silver[dated].select(day.alias("date_id")) if dated in silver else None)
    if spec.output.versioned:
        report = spark.table(quoted(spec.output.table))
    else:
        report = spark.read.format(spec.output.format).load(spec.output.path)
    if preview:
        report.show(preview, truncate=False)
    quality = {n: rule_report(f, spec.datasets[n].rules) for n, f in read.items() if spec.datasets[n].rules}
    return ReportResult(ingested, aggregates, metrics, report, quality, unreadable)
