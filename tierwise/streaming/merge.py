"""Streaming merges into type 1 and type 2 dimensions.

Rewriting a large dimension per micro-batch would cost the dimension's size each time.
Instead every batch is reduced to one row per key and kept in its own change folder;
readers see base plus changes, and ``compact`` folds the changes into the base with the
staged publish.  A repeated batch overwrites its own folder, so replays are harmless.

A type 2 dimension keeps its changes by day until the watermark has passed the day: only then it is
known which row of a key's day is the last, and which day ends the version before it.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierwise import scratch
from tierwise.operators.keys import dedup_latest, has_key
from tierwise.operators.scd1 import align, require_columns, scd1_merge
from tierwise.plans.dimension import append_days, delivered_days, read_history
from tierwise.sinks.publish import finish_days, note_of, recover, staged_publish
from tierwise.sinks.versions import manifest, publish_folders, roll_forward
from tierwise.sources.catalog import quoted

# Partition column of a change folder, and the file that says what was closed.
DAY, STATE = "change_day", "_closed"


class StreamedDimension:
    """A base folder and a log of per-batch changes beside it.

    With ``table`` the base is that table, published by ``partition_by`` through the catalog.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        changes: str,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        table: str | None = None,
        partition_by: Sequence[str] = (),
    ) -> None:
        self.spark = spark
        self.path = path
        self.changes = changes
        self.keys = list(keys)
        self.order_by = list(order_by)
        self.table = table
        self.partition_by = list(partition_by)
        if table:
            roll_forward(spark, table, path)
        else:
            recover(spark, path)

    def base(self) -> DataFrame:
        return self.spark.table(quoted(self.table)) if self.table else self.spark.read.parquet(self.path)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Body of ``foreachBatch``; cost follows the batch, not the dimension."""
        base = self.base()
        require_columns(batch, base)
        kept = dedup_latest(batch.filter(has_key(self.keys)), self.keys, self.order_by)
        align(kept, base).write.mode("overwrite").parquet(f"{self.changes}/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def folded(self) -> int:
        """The last batch that the base contains; the number is published with it."""
        note = manifest(self.spark, self.path).note if self.table else note_of(self.spark, self.path)
        return int(note or -1)

    def batches(self) -> list[int]:
        """Batches with a change folder, in their order."""
        return sorted(int(n.split("=")[1]) for n in scratch.list_names(self.spark, self.changes) if "=" in n)

    def _change_rows(self) -> DataFrame | None:
        """Changes that the base does not contain yet."""
        if not [b for b in self.batches() if b > self.folded()]:
            return None
        rows = self.spark.read.option("basePath", self.changes).parquet(self.changes)
        return rows.filter(F.col("batch_id") > self.folded())

    def snapshot(self) -> DataFrame:
        """The dimension with all applied batches, later batches winning."""
        base, changes = self.base(), self._change_rows()
        return base if changes is None else scd1_merge(changes, base, self.keys, order_by=["batch_id"])

    def compact(self) -> int:
        """Publish the snapshot as the new base, then drop the folders it contains, oldest first.

        The base says which batches it contains, so folders that a crash left are not merged again.
        """
        batches = self.batches()
        last = max([self.folded(), *batches])
        if self.table:
            rows = publish_folders(self.spark, self.snapshot(), self.table, self.path, self.partition_by, note=str(last))
        else:
            rows = staged_publish(self.spark, self.snapshot(), self.path, note=str(last))
        for batch in batches:
            scratch.delete(self.spark, f"{self.changes}/batch_id={batch}")
        return rows


class StreamedHistory:
    """A type 2 dimension fed by a stream: its published history, and the changes of days still open.

    Rows carry an event ``time``; of a key's rows of one day the last one counts, by ``order_by`` and then
    the time.  Days that ended over ``delay`` before the newest time seen are closed: ``compact`` puts them into
    the history (``append_days``; batch merges may take turns with it).  Rows that come for a day after that are
    set aside in ``<changes>-late``, those without a key or a time in ``<changes>-rejected``, by batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        changes: str,
        keys: Sequence[str],
        time: str,
        delay: datetime.timedelta,
        order_by: Sequence[str] = (),
        exclude: Sequence[str] = (),
    ) -> None:
        self.spark, self.path, self.changes = spark, path.rstrip("/"), changes.rstrip("/")
        self.keys, self.time, self.delay, self.exclude = list(keys), time, delay, list(exclude)
        self.order_by = [*order_by, *([] if time in order_by else [time])]
        finish_days(spark, self.path)  # what a stopped run has published is moved in first

    def history(self) -> DataFrame:
        return read_history(self.spark, self.path)

    def folded(self) -> tuple[datetime.date | None, int]:
        """The last day that the history is closed for, if any, and the last batch that it may have rows of.

        The history says itself which days it has: a run that was stopped after publishing them is seen.
        """
        text = scratch.read_text(self.spark, f"{self.changes}/{STATE}")
        day, batch = json.loads(text) if text else (None, -1)
        days = [*([datetime.date.fromisoformat(day)] if day else []), *delivered_days(self.spark, self.path)]
        return max(days, default=None), batch

    def _fold(self, day: datetime.date | None, batch: int) -> None:
        scratch.write_text(self.spark, f"{self.changes}/{STATE}", json.dumps([day and day.isoformat(), batch]))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Body of ``foreachBatch``: the batch's last row of each key and day, in a folder of its own.

        A batch that is repeated after its days were closed has nothing new to say about them.
        """
        last_day, last_batch = self.folded()
        dated = batch.withColumn(DAY, F.to_date(self.time))
        usable = has_key(self.keys) & F.col(DAY).isNotNull()
        kept = dedup_latest(dated.filter(usable), [*self.keys, DAY], self.order_by)
        closed = F.lit(False) if last_day is None else F.col(DAY) <= F.lit(last_day)
        kept.filter(~closed).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.changes}/batch_id={batch_id}")
        aside = {"rejected": dated.filter(~usable).drop(DAY)}
        if batch_id > last_batch:
            aside["late"] = kept.filter(closed).drop(DAY)
        for name, rows in aside.items():
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{self.changes}-{name}/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def open_days(self) -> dict[int, list[datetime.date]]:
        """The days that each batch has changes of and the history does not contain."""
        last_day, _ = self.folded()
        found = {}
        for name in scratch.list_names(self.spark, self.changes):
            if name.startswith("batch_id="):
                days = scratch.list_names(self.spark, f"{self.changes}/{name}")
                dates = [datetime.date.fromisoformat(d.split("=")[1]) for d in days if d.startswith(f"{DAY}=")]
                found[int(name.split("=")[1])] = [d for d in dates if last_day is None or d > last_day]
        return found

    def compact(self, everything: bool = False) -> int:
        """Close the days that the watermark has passed, or ``everything`` there is; returns how many.

        Only change folders of these days are read.  Stopped anywhere, the next call goes on.
        """
        finish_days(self.spark, self.path)
        open_days = self.open_days()
        last_day, last_batch = self.folded()
        if any(open_days.values()):
            paths = {(b, d): f"{self.changes}/batch_id={b}/{DAY}={d.isoformat()}" for b, days in open_days.items() for d in days}
            reader = self.spark.read.option("basePath", self.changes)
            newest = reader.parquet(*paths.values()).agg(F.to_date(F.max(self.time) - F.lit(self.delay))).first()[0]
            closing = max(d for _, d in paths) if everything else newest - datetime.timedelta(days=1)
            ready = [path for (_, d), path in paths.items() if d <= closing]
            last_batch = max([last_batch, *open_days])
            self._fold(last_day, last_batch)  # before the days are published: from then on these batches are known
            if ready:
                rows = reader.parquet(*ready)
                latest = dedup_latest(rows, [*self.keys, DAY], [*self.order_by, "batch_id"])
                dated = latest.withColumn("effective_from", F.col(DAY).cast("date")).drop(DAY, "batch_id")
                append_days(self.spark, self.path, dated.drop(*self.order_by), self.keys, self.exclude)
            self._fold(max(last_day or closing, closing), last_batch)
        closed, _ = self.folded()
        if closed is None:
            return 0
        for name in scratch.list_names(self.spark, self.changes):
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= last_batch:
                days = [d for d in scratch.list_names(self.spark, f"{self.changes}/{name}") if d.startswith(f"{DAY}=")]
                done = [d for d in days if datetime.date.fromisoformat(d.split("=")[1]) <= closed]
                for day in [""] if len(done) == len(days) else done:
                    scratch.delete(self.spark, f"{self.changes}/{name}/{day}".rstrip("/"))
        return len({d for days in open_days.values() for d in days if d <= closed})
