"""Facts get the surrogate key of the dimension version that was valid on their day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a stretch: a key has at most so many versions in one, as a version is valid for a day at least.
STRETCH_DAYS = 64
#: Key of facts that no version is valid for.
UNKNOWN = -1


def stretch_of(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / F.lit(days)).cast("int")


def fact_keys(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    day: Column,
    sk: str = "sk",
    unknown: int = UNKNOWN,
    stretch_days: int = STRETCH_DAYS,
) -> DataFrame:
    """``facts`` with the ``sk`` of the version of their key that is valid on ``day``.

    ``versions`` have the keys, ``sk``, and effective_from and effective_to (null: open), which do not
    overlap for a key.  No fact is lost or repeated: those whose key or day is null, whose key is not in
    the dimension or whose day is before its first version get ``unknown``.

    Versions are cut into stretches of the calendar and joined by key and stretch, so that a fact is
    compared with its key's versions of one stretch only, at most ``stretch_days``, however many a key
    has.  Open versions end with the last day that any fact has, and stretches without a fact's
    day are not made.  Facts are the kept side: a key with most of them is split over tasks by adaptive
    execution, and a small dimension is broadcast, as Spark measures it.
    """
    names = list(keys)
    # one row; known to the join's own plan, nothing runs while it is built
    span = facts.agg(F.min(day).cast("date").alias("__first"), F.max(day).cast("date").alias("__last"))
    first, last = (span.select(c).scalar() for c in span.columns)
    begins = F.greatest("effective_from", first)
    ends = F.least(F.coalesce(F.date_sub("effective_to", 1), last), last)
    used = versions.dropna(subset=names).select(
        *[F.col(k).alias(f"__{k}") for k in names],
        F.col(sk).alias("__sk"),
        F.col("effective_from").alias("__from"),
        F.col("effective_to").alias("__to"),
        F.when(begins <= ends, F.sequence(stretch_of(begins, stretch_days), stretch_of(ends, stretch_days))).alias("__in"),
    )
    used = used.withColumn("__stretch", F.explode("__in")).drop("__in")
    dated = facts.withColumns({"__day": day.cast("date"), "__at": stretch_of(day.cast("date"), stretch_days)})
    same = [F.col(k) == F.col(f"__{k}") for k in names] + [F.col("__at") == F.col("__stretch")]
    valid = (F.col("__from") <= F.col("__day")) & (F.col("__to").isNull() | (F.col("__day") < F.col("__to")))
    joined = dated.join(used, reduce(and_, same) & valid, "left")
    return joined.select(*facts.columns, F.coalesce("__sk", F.lit(unknown)).cast("long").alias(sk))
