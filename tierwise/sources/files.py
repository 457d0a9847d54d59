"""Feed discovery and ingestion.

File selection works on a listing frame (one row per file), never on file contents, and
on any Hadoop file system.  A feed with a declared schema is read as one directory scan.  If that
scan has files of the snapshot only, no row is asked for its file's name; else a
``_metadata.file_name`` filter prunes files at planning time, and is evaluated for each row
again.  Without a schema the names are handed to the reader, because header
and type inference must look at matching files only.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierwise.functions.columns import file_name_parts, file_stamp, is_dated, stamp_place, try_casts
from tierwise.parallel import together
from tierwise.scratch import list_names, path_exists
from tierwise.spec import DATE_PARTS, READ_FORMATS, DatasetSpec, SpecError

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestResult:
    """What happened to one dataset.

    status: ``read``, ``no_files``, ``unsupported_format`` or ``error``.  ``rejected``
    lists files the feed pattern accepts but whose name carries no date.
    """

    name: str
    status: str
    reason: str = ""
    frame: DataFrame | None = None
    rejected: DataFrame | None = None


def name_matches(name: Column, pattern: str) -> Column:
    """Anchored at the start of the bare file name, open at its end."""
    return name.rlike(f"^(?:{pattern})")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, modified, length) of the direct children; contents are not read."""
    listing = spark.read.format("binaryFile").load(path)
    return listing.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


def feed_files(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """Listing of the feed's files with their stamp; ``dated`` is false for rejects."""
    name = F.col("file_name")
    return (
        list_files(spark, spec.input_path)
        .filter(name_matches(name, spec.pattern))
        .withColumns({"stamp": file_stamp(name), "dated": is_dated(name)})
    )


def with_format(reader, spec: DatasetSpec):
    """A batch or stream reader with the feed's format, options and declared schema."""
    reader = reader.format(spec.format).options(**spec.options)
    if spec.format == "csv":
        reader = reader.option("header", spec.header).option("sep", spec.delimiter)
        if spec.header:
            reader = reader.option("enforceSchema", False)  # a file whose header says otherwise is an error
    if spec.format == "json":
        reader = reader.option("multiLine", spec.multiline)
    return reader.schema(spec.schema) if spec.schema else reader


def _reader(spark: SparkSession, spec: DatasetSpec):
    return with_format(spark.read, spec)


def _with_file_columns(df: DataFrame, files: Sequence[Row] | None = None) -> DataFrame:
    """Tag every row at the scan, before a shuffle can hide the file it came from.

    ``files`` are all files of ``df`` (stamp_at) if they are known: where their stamps begin at one place, they are
    cut out there, and no pattern is matched for each row.
    """
    places = {f.stamp_at for f in files or ()}
    return df.withColumns(file_name_parts(F.col("_metadata.file_name"), places.pop() if len(places) == 1 else None))


def _has_only(df: DataFrame, files: Sequence[Row]) -> bool:
    """Whether the scan ``df``, as it was listed, has no file but ``files`` (file_name).

    The scan's names are encoded as in ``_metadata``; one that this changes counts as another file.
    """
    return {path.rsplit("/", 1)[-1] for path in df.inputFiles()} <= {f.file_name for f in files}


def read_feed(
    spark: SparkSession, spec: DatasetSpec, files: DataFrame | None = None
) -> tuple[str, DataFrame | None]:
    """Rows of the feed's current snapshot; (reason, None) when there is nothing to read.

    ``files`` restricts the read to a subset of the listing, e.g. the days a ledger has
    not seen completely yet.
    """
    return _read(spark, spec, feed_files(spark, spec) if files is None else files, files is None)


def _read(
    spark: SparkSession, spec: DatasetSpec, listing: DataFrame, whole_feed: bool
) -> tuple[str, DataFrame | None]:
    usable = listing.filter("dated")
    if spec.schema_log:
        return _read_evolving(spark, spec, usable)
    found = ["path", "file_name", "stamp", stamp_place(F.col("file_name")).alias("stamp_at")]
    files = usable.select(*found).collect()  # file names only
    if not files:
        return "no file with a date in its name matches", None
    stamps = {f.stamp for f in files}
    if spec.snapshot is None and len(stamps) > 1:
        raise SpecError(f"dataset {spec.name}: files of {len(stamps)} stamps match; declare 'snapshot'")
    if spec.snapshot == "latest":
        files = [f for f in files if f.stamp == max(stamps)]
    if not (spec.schema and whole_feed):
        return "", _with_file_columns(_reader(spark, spec).load(sorted(f.path for f in files)), files)
    scan = _reader(spark, spec).load(spec.input_path)
    if _has_only(scan, files):  # so no row of it needs to be asked for its file's name
        return "", _with_file_columns(scan, files)
    name = F.col("_metadata.file_name")
    chosen = name_matches(name, spec.pattern) & is_dated(name)
    if spec.snapshot == "latest":
        chosen &= file_stamp(name) == max(stamps)
    return "", _with_file_columns(scan.filter(chosen))


def _read_evolving(spark: SparkSession, spec: DatasetSpec, usable: DataFrame) -> tuple[str, DataFrame | None]:
    from tierwise.sources.schemas import SchemaLog, read_evolving  # it reads with what is above

    if spec.snapshot != "all":
        facts = usable.agg(F.max("stamp").alias("latest"), F.count_distinct("stamp").alias("stamps")).first()
        if spec.snapshot is None and facts.stamps > 1:
            raise SpecError(f"dataset {spec.name}: files of {facts.stamps} stamps match; declare 'snapshot'")
        usable = usable.filter(F.col("stamp") == F.lit(facts.latest))
    frame = read_evolving(spark, spec, SchemaLog(spark, spec.schema_log), usable)
    return ("no file with a date in its name matches", None) if frame is None else ("", frame)


def ingest(spark: SparkSession, spec: DatasetSpec) -> IngestResult:
    """Read one dataset, reporting instead of hiding what went wrong."""
    result = _ingest(spark, spec)
    if result.status != "read":
        if spec.required:
            raise SpecError(f"required dataset {spec.name}: {result.status}: {result.reason}")
        log.warning("dataset %s: %s: %s", spec.name, result.status, result.reason)
    return result


def _ingest(spark: SparkSession, spec: DatasetSpec) -> IngestResult:
    if spec.format not in READ_FORMATS:
        return IngestResult(spec.name, "unsupported_format", f"'{spec.format}' is not one of {READ_FORMATS}")
    if not path_exists(spark, spec.input_path):
        return IngestResult(spec.name, "no_files", f"{spec.input_path} does not exist")
    try:
        listing = feed_files(spark, spec)
        reason, frame = _read(spark, spec, listing, whole_feed=True)
    except AnalysisException as err:
        return IngestResult(spec.name, "error", str(err).splitlines()[0])
    rejected = listing.filter("NOT dated")
    if undated := rejected.count():  # of the listing
        log.warning("dataset %s: %d files have no date in their name and are not read", spec.name, undated)
    if frame is None:
        return IngestResult(spec.name, "no_files", reason, rejected=rejected)
    return IngestResult(spec.name, "read", frame=frame, rejected=rejected)


def day_files(listing: DataFrame, fresh: DataFrame) -> DataFrame:
    """All files of the days that ``fresh`` files belong to."""
    day = F.substring("stamp", 1, 8).alias("__day")
    days = fresh.filter("dated").select(day).distinct()
    return listing.withColumn("__day", F.substring("stamp", 1, 8)).join(days, "__day", "left_semi").drop("__day")


def ingest_all(spark: SparkSession, specs: Iterable[DatasetSpec]) -> dict[str, IngestResult]:
    """One lazy frame per readable dataset, plus the status of every dataset.

    Listing and schema inference of the datasets run side by side.
    """
    return together(spark, {spec.name: partial(ingest, spark, spec) for spec in specs})


def frames(results: dict[str, IngestResult]) -> dict[str, DataFrame]:
    return {name: r.frame for name, r in results.items() if r.frame is not None}


def latest_day(spark: SparkSession, path: str) -> Column | None:
    """Condition selecting a silver layer's newest day folder, found by listing names only."""
    condition, folder = None, path.rstrip("/")
    for part in DATE_PARTS:
        values = [n.split("=", 1)[1] for n in list_names(spark, folder) if n.startswith(f"{part}=")]
        numbers = [v for v in values if v.isdigit()]
        if not numbers:
            return condition
        newest = max(numbers, key=int)
        here = F.col(part) == int(newest)
        condition = here if condition is None else condition & here
        folder = f"{folder}/{part}={newest}"
    return condition


def read_layer(
    spark: SparkSession,
    path: str,
    casts: dict[str, str] | None = None,
    text_parts: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """A silver or gold Parquet layer, with ``schema`` if its files differ.

    Directory values come back as inferred (``01`` becomes 1); ``text_parts`` restores
    the two-digit text the file names had.
    """
    df = try_casts((spark.read.schema(schema) if schema else spark.read).parquet(path), casts or {})
    if text_parts:
        width = {"year": 4}
        df = df.withColumns(
            {p: F.lpad(F.col(p).cast("string"), width.get(p, 2), "0") for p in DATE_PARTS if p in df.columns}
        )
    return df
