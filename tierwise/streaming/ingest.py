"""File streams: bronze feeds to silver, each new file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierwise.functions.columns import file_name_parts, is_dated
from tierwise.plans.incremental import publish_days
from tierwise.sources.files import feed_files, name_matches, with_format
from tierwise.spec import DatasetSpec, SpecError

# Fixed value: the columns of Spark's binaryFile source.
BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def feed_stream(spark: SparkSession, spec: DatasetSpec, max_files: int | None = None) -> DataFrame:
    """New files of a feed, tagged like the batch read.  A stream needs a declared schema."""
    if not spec.schema:
        raise SpecError(f"dataset {spec.name}: a stream needs a declared schema")
    reader = with_format(spark.readStream, spec)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = F.col("_metadata.file_name")
    rows = reader.load(spec.input_path).withColumns(file_name_parts(name))
    return rows.filter(name_matches(F.col("filename"), spec.pattern) & is_dated(F.col("filename")))


def file_stream(spark: SparkSession, spec: DatasetSpec, max_files: int | None = None) -> DataFrame:
    """(filename) of a feed's new files; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(BINARY)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = F.element_at(F.split("path", "/"), -1).alias("filename")
    return reader.load(spec.input_path).select(name).filter(name_matches(F.col("filename"), spec.pattern) & is_dated(F.col("filename")))


def stream_to_silver(
    spark: SparkSession, spec: DatasetSpec, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Publish the days of all files not seen before, then stop.

    The stream finds new files by their names; each batch publishes the days they belong to as a batch run
    does: through the dataset's rules, into the same silver folder, with silver's days replaced as a whole.
    A repeated batch thus changes nothing, and batch and stream runs can take turns.  The cost: a day's
    files are read again by every batch that brings another file of the day.
    """
    if not spec.schema:
        raise SpecError(f"dataset {spec.name}: a stream needs a declared schema")

    def publish(batch: DataFrame, batch_id: int) -> None:
        listing = feed_files(spark, spec)
        names = batch.select("filename").distinct()
        fresh = listing.join(names, listing.file_name == names.filename, "left_semi")
        publish_days(spark, spec, listing, fresh)

    return (
        file_stream(spark, spec, max_files)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
