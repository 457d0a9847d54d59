"""Ledger of consumed files: change detection by comparing names with what was published."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise import scratch
from tierwise.scratch import path_exists

LEDGER_SCHEMA = (
    "dataset string, file_name string, stamp string, length bigint, status string, "
    "recorded_at timestamp, batch_id string"
)


class FileLedger:
    """An append-only Parquet table partitioned by dataset, batch and status.

    Recording a batch overwrites exactly that batch's folder, so a retried batch leaves
    one copy of its rows; a dataset's entries are read without those of others.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def unprocessed(self, listing: DataFrame, dataset: str) -> DataFrame:
        """Files of ``listing`` not yet recorded as done for ``dataset``."""
        done = self.read().filter((F.col("dataset") == dataset) & (F.col("status") == "done"))
        return unprocessed(listing, done, "file_name")

    def of_batch(self, dataset: str, batch_id: str) -> DataFrame:
        """Files recorded for one batch, each once."""
        rows = self.read().filter((F.col("dataset") == dataset) & (F.col("batch_id") == batch_id))
        return rows.select("file_name", "stamp", "length").distinct()

    def record(self, listing: DataFrame, dataset: str, batch_id: str, status: str = "done") -> None:
        rows = listing.select(
            F.lit(dataset).alias("dataset"),
            "file_name",
            "stamp",
            "length",
            F.lit(status).alias("status"),
            F.current_timestamp().alias("recorded_at"),
            F.lit(batch_id).alias("batch_id"),
        )
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dataset", "batch_id", "status")
            .parquet(self.path)
        )


def unprocessed(listing: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``listing`` whose keys the ledger does not hold."""
    return listing.join(done.select(*keys).distinct(), list(keys), "left_anti")


class Claims:
    """Which run works on which day of a feed: files that are created once, by one run.

    A day's claims are numbered, and the newest one counts.  Whoever creates it has the day until it is
    released or ``seconds`` old; then the next run may create the following number, which again only one
    can.  A run that was started again under its name keeps its claims.  ``seconds`` is more than a run
    takes: one that comes back after it must find with ``holds`` that its day is another's by now.
    """

    def __init__(
        self, spark: SparkSession, path: str, owner: str, seconds: float = 6 * 3600, clock: Callable[[], float] = time.time
    ) -> None:
        self.spark, self.path, self.owner, self.seconds, self.clock = spark, path.rstrip("/"), owner, seconds, clock

    def _newest(self, day: str) -> tuple[int, str | None]:
        """The day's newest claim and who holds it; no one if it is released or too old."""
        names = scratch.list_names(self.spark, f"{self.path}/{day}")
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return 0, None
        number = max(numbers)
        at = f"{self.path}/{day}/{number}"
        try:
            until, holder = json.loads(scratch.read_text(self.spark, at))
        except ValueError:  # its writer was stopped
            until, holder = scratch.modified(self.spark, at) + self.seconds, "unknown"
        return number, None if f"{number}.released" in names or self.clock() > until else holder

    def holds(self, day: str) -> bool:
        return self._newest(day)[1] == self.owner

    def claim(self, days: Iterable[str]) -> list[str]:
        """Those of ``days`` that are this run's from now on, or were before."""
        mine = []
        for day in sorted(days):
            number, holder = self._newest(day)
            text = json.dumps([self.clock() + self.seconds, self.owner])
            if holder == self.owner or holder is None and scratch.create_new(self.spark, f"{self.path}/{day}/{number + 1}", text):
                mine.append(day)
        return mine

    def release(self, days: Iterable[str]) -> None:
        """Give back ``days`` that are still this run's, and forget their earlier claims."""
        for day in days:
            number, holder = self._newest(day)
            if holder == self.owner:
                scratch.write_once(self.spark, f"{self.path}/{day}/{number}.released", self.owner)
                for name in scratch.list_names(self.spark, f"{self.path}/{day}"):
                    if int(name.split(".")[0]) < number:
                        scratch.delete(self.spark, f"{self.path}/{day}/{name}")
