"""Event-time aggregates and de-duplication with bounded state.

A stream that goes on appends a window once, when the watermark has passed its end
(``run_available``): state holds open windows only.  A run over everything there is can also give
every window, those still open included (``run_to_end``): its state holds all windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Sessions are merged inside each task first, so one very active user is not shuffled row by row.
LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _windowed(events: DataFrame, window: Column, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    grouped = events.groupBy(window.alias("w"), *by).agg(*[m.alias(n) for n, m in measures.items()])
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *measures
    )


def tumbling(
    events: DataFrame, time: str, delay: str, size: str, by: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    return _windowed(events.withWatermark(time, delay), F.window(time, size), by, measures)


def sliding(
    events: DataFrame,
    time: str,
    delay: str,
    size: str,
    slide: str,
    by: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    return _windowed(events.withWatermark(time, delay), F.window(time, size, slide), by, measures)


def sessions(
    events: DataFrame, time: str, delay: str, gap: str, by: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Activity sessions per ``by`` value; a session ends ``gap`` after its last event."""
    return _windowed(events.withWatermark(time, delay), F.session_window(time, gap), by, measures)


def deduplicated(
    events: DataFrame, time: str, delay: str, keys: Sequence[str], spreads: int = 64
) -> DataFrame:
    """One row per key within the watermark.

    Copies are removed twice: first within ``spreads`` shares of the input partitions,
    then among the at most ``spreads`` survivors of a key per batch.  A key repeated very
    often is thus never handled by a single task.  The share follows the input partition,
    so a recomputed task repeats it.  State: for each key within the watermark one entry of the
    second step and one for each share it came in, so 2 for a key that comes once and up to
    ``spreads + 1`` for one that comes everywhere.  With ``spreads=1`` there is only the second
    step with one entry a key, for keys that repeat rarely.
    """
    marked = events.withWatermark(time, delay)
    if spreads > 1:
        share = F.spark_partition_id() % spreads
        marked = marked.withColumn("__share", share)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "__share"]).drop("__share")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def run_available(
    frame: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Process everything available, appending exactly once to a Parquet folder, and stop."""
    writer = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def run_to_end(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available, leave all windows with their values so far in ``path``, and stop.

    Each batch replaces the result as a whole; a repeated batch writes the same.
    """

    def replace(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(path)

    return (
        frame.writeStream.foreachBatch(replace)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@contextmanager
def sessions_merged_locally(spark: SparkSession) -> Iterator[None]:
    """Queries started inside merge sessions in each task before they shuffle them; the session's own
    setting is as before afterwards."""
    before = spark.conf.get(LOCAL_SESSIONS, None)
    spark.conf.set(LOCAL_SESSIONS, "true")
    try:
        yield
    finally:
        spark.conf.unset(LOCAL_SESSIONS) if before is None else spark.conf.set(LOCAL_SESSIONS, before)
