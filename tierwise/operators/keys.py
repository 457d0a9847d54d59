"""Business keys: latest row per key, null-key split, uniqueness, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.hashing import version_hash

# Hex digits of the bucket a new surrogate key is numbered in: 16 ** 4 = 65,536 buckets.
BUCKET_DIGITS = 4
# Hex digits by which buckets are grouped to sum up their sizes: at most 4,096 groups.
GROUP_DIGITS = 3


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by the remaining columns (not maps).

    The rank filter reaches Spark's window group limit, so each task keeps one row per
    key before the shuffle and a key holding most rows costs one row per task.
    """
    first = [F.col(c).desc_nulls_last() if isinstance(c, str) else c.desc_nulls_last() for c in order_by]
    named = {c for c in order_by if isinstance(c, str)} | set(keys)
    rest = [F.col(c).desc_nulls_last() for c, t in df.dtypes if c not in named and "map<" not in t]
    window = Window.partitionBy(*keys).orderBy(*first, *rest)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def has_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows to quarantine)."""
    return df.filter(has_key(keys)), df.filter(~has_key(keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples occurring more than once, with their counts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    sample = duplicate_keys(df, keys).limit(3).collect()
    if sample:
        shown = "; ".join(str(tuple(row)) for row in sample)
        raise ValueError(f"{what}: key {', '.join(keys)} is not unique, e.g. {shown}")


def key_bucket(keys: Sequence[str], digits: int = BUCKET_DIGITS) -> Column:
    """Leading hex digits of the key's hash: an even, repeatable spread of distinct keys."""
    return F.substring(version_hash(keys), 1, digits)


def surrogate_keys(
    batch: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    sk: str = "sk",
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """``existing`` (keys, sk) plus dense new numbers after its maximum for unseen keys.

    New keys are numbered inside hash buckets in key order, ``16 ** digits`` of them, as many
    as one wants.  Bucket sizes are counted before anything is sorted and summed up in two
    levels: within groups of buckets, and over the at most 4,096 groups.  No task sorts all
    keys or all buckets, and nothing depends on partition numbers, so a lost executor cannot
    change a number.  Duplicates collapse before the shuffle.
    """
    if not 1 <= digits <= 32:
        raise ValueError("digits must be 1 to 32, the length of a hash")
    known = existing.select(*keys, sk)
    unseen = (
        batch.select(*keys)
        .filter(has_key(keys))
        .distinct()
        .join(known.select(*keys), list(keys), "left_anti")
        .withColumn("__bucket", key_bucket(keys, digits))
    )
    sizes = unseen.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    sizes = sizes.withColumn("__group", F.substring("__bucket", 1, GROUP_DIGITS))
    in_group = Window.partitionBy("__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # The highest key in use enters as an empty first group: '' sorts before any hex text.
    start = known.agg(F.coalesce(F.max(sk).cast("long"), F.lit(0)).alias("__size"))
    groups = sizes.groupBy("__group").agg(F.sum("__size").alias("__size"))
    groups = groups.unionByName(start.withColumn("__group", F.lit("")))
    over_groups = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    group_offsets = groups.select("__group", F.sum("__size").over(over_groups).alias("__base"))
    offsets = (
        sizes.select("__group", "__bucket", F.coalesce(F.sum("__size").over(in_group), F.lit(0)).alias("__before"))
        .join(F.broadcast(group_offsets), "__group")  # at most 4,097 rows
        .select("__bucket", (F.col("__base") + F.col("__before")).alias("__offset"))
    )
    in_bucket = Window.partitionBy("__bucket").orderBy(*keys)
    ranked = unseen.withColumn("__rank", F.row_number().over(in_bucket))
    fresh = ranked.join(offsets, "__bucket").select(
        *keys, (F.col("__offset") + F.col("__rank")).cast("long").alias(sk)
    )
    return known.withColumn(sk, F.col(sk).cast("long")).unionByName(fresh)
