"""Daily states that merge: sums, counts and sketches of distinct values of each day, kept as a table.

A day's state is computed from that day's rows, once; any range of days is summed up from states,
never from detail.  A day that is delivered again replaces its state.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.scratch import path_exists
from tierwise.sinks.publish import finish_days, folders_of, stage_folders

#: Logarithm of a sketch's registers; the relative standard error is 1.04 / sqrt(2 ** LOG_REGISTERS), 1.6 %.
LOG_REGISTERS = 12


@dataclass(frozen=True)
class DailyStates:
    """What is kept of each day and group: ``sums`` and ``distinct`` are SQL expressions by name.

    The number of rows is always kept, as ``n``.  A sum is exact if its expression's type is (decimals and
    integers); distinct values are estimated, small numbers of them nearly exactly.
    """

    by: Sequence[str] = ()
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)

    def of(self, rows: DataFrame, day: Column) -> DataFrame:
        """(date_id, by, n, sums, sketches) of each day in ``rows``; one row for each day and group."""
        sums = [F.sum(F.expr(e)).alias(n) for n, e in self.sums.items()]
        sketches = [F.hll_sketch_agg(F.expr(e), LOG_REGISTERS).alias(n) for n, e in self.distinct.items()]
        dated = rows.withColumn("date_id", day.cast("date")).filter("date_id IS NOT NULL")
        return dated.groupBy("date_id", *self.by).agg(F.count("*").alias("n"), *sums, *sketches)

    def replace(self, path: str, rows: DataFrame, day: Column, days: Sequence[datetime.date] | None = None) -> None:
        """Put the states of ``rows`` in the place of those of the same days.

        ``days`` are those that ``rows`` were read for, so that one without any row left loses its state; if
        not given, those that occur.  Staged and listed before anything is moved: a run after a crash
        moves the rest first.
        """
        spark = rows.sparkSession
        finish_days(spark, path)
        states = self.of(rows, day)
        if days is None:
            folders = folders_of(rows.select(day.cast("date").alias("date_id")).dropna(), ["date_id"])
        else:
            folders = {f"date_id={d.isoformat()}" for d in days}
        stage_folders(spark, path, states, ["date_id"], folders)
        finish_days(spark, path)

    def totals(
        self,
        spark: SparkSession,
        path: str,
        first: datetime.date | None = None,
        last: datetime.date | None = None,
        by: Sequence[str | Column] = (),
    ) -> DataFrame:
        """The totals of the days from ``first`` to ``last``, by any of the columns or of the days.

        Only these days' folders are read.
        """
        finish_days(spark, path)
        if not path_exists(spark, path):
            raise FileNotFoundError(f"{path}: no states yet")
        states = spark.read.parquet(path).withColumn("date_id", F.col("date_id").cast("date"))
        if first is not None:
            states = states.filter(F.col("date_id") >= F.lit(first))
        if last is not None:
            states = states.filter(F.col("date_id") <= F.lit(last))
        sums = [F.sum(n).alias(n) for n in ("n", *self.sums)]
        distinct = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in self.distinct]
        return states.groupBy(*by).agg(*sums, *distinct)
