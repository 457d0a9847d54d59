"""Aggregates declared as SQL text, and day-level summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _named(name: str, expression: str) -> Column:
    """The expression under its declared name, whatever alias its own text carries."""
    return F.expr(expression).alias(name)


def global_aggregates(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """All declared aggregates in one pass over ``df``: a single row."""
    return df.select(*[_named(n, e) for n, e in expressions.items()])


def grouped_aggregates(
    df: DataFrame, group_by: Sequence[str], expressions: Mapping[str, str], grouping: str = "group"
) -> DataFrame:
    """The same expressions per group; ``grouping`` is group, rollup or cube."""
    grouped = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[grouping](*group_by)
    return grouped.agg(*[_named(n, e) for n, e in expressions.items()])


def totals_per_key(
    df: DataFrame, key: str, measure: str, total: str = "total", count: str = "n"
) -> DataFrame:
    """Detail rows reduced to one row per key, so that joining them cannot fan out.

    Partial sums leave each task, so a key holding most of the detail costs one row per
    task in the shuffle.
    """
    return df.groupBy(key).agg(F.sum(measure).alias(total), F.count(F.lit(1)).alias(count))


def daily_summary(
    df: DataFrame, day: Column, by: Sequence[str], expressions: Mapping[str, str]
) -> DataFrame:
    return grouped_aggregates(df.withColumn("date_id", day), ["date_id", *by], expressions)


def day_over_day(summary: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Change of each measure against the previous day present.

    The window runs over a daily summary, one row per day and ``by`` value, never over
    detail rows.
    """
    window = Window.partitionBy(*by).orderBy("date_id")
    return summary.withColumns(
        {f"{m}_change": F.col(m) - F.lag(m).over(window) for m in measures}
    )
