"""Declared equi-joins.

Adaptive execution splits a hot key's partition only on a side whose rows the join need
not pad: both sides of an inner join, the kept side of a semi, anti or one-sided outer
join, no side of a full join.  The other side of a semi or anti join is reduced to its
distinct keys, and ``salted_outer_join`` covers the rest.  A key is hot if it holds more
than a share of a side's rows (``HOT_SHARE`` of a shuffle partition's mean), whatever the
size, so there are at most ``shuffle partitions / HOT_SHARE`` of them and none is left
out.  Their rows are spread over salts, the matching rows of the other side are repeated
once per salt, and padded rows that exist only because of the repetition are removed
again.  Every other key joins as usual, and no row is lost: a hot key is by construction
present on the side it is hot on, so a repeated row always meets at least one real partner.

Counting the keys is part of the join's own plan: nothing runs while it is built.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.spec import VIEW_SUFFIX, JoinStep, SpecError

# A key is hot if its rows are more than this share of what a shuffle partition has on average.
HOT_SHARE = 0.25
# Buckets in which keys are counted first, for each such share: one with ordinary keys only has a 16th of it.
BUCKETS = 16
# Prefix of the helper columns that say which row of its dataset a row came from.
ROW = "__row_"


def alias_of(name: str) -> str:
    return f"{name}{VIEW_SUFFIX}"


def compare_type(left: T.DataType, right: T.DataType) -> str | None:
    """Type to compare in when only one side is text; None when Spark's own rule is fine."""
    if isinstance(left, T.StringType) == isinstance(right, T.StringType):
        return None
    return (right if isinstance(left, T.StringType) else left).simpleString()


def key_pair(
    left: DataFrame, left_name: str, right: DataFrame, right_name: str, key_type: str | None = None
) -> tuple[Column, Column]:
    """The two columns to compare; unparsable text becomes null, so it never matches or fails."""
    key_type = key_type or compare_type(
        left.select(left_name).schema[0].dataType, right.select(right_name).schema[0].dataType
    )
    pair = F.col(left_name), F.col(right_name)
    return pair if key_type is None else (pair[0].try_cast(key_type), pair[1].try_cast(key_type))


def with_row(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number that tells its rows apart and is the same when a task is repeated.

    For a file scan that knows them these are the file and the place in it, of which no column has
    to be read; copies of a row differ.  For other frames (text files, aggregated rows) it is a hash of the
    row's values, without maps, and of the partition it is in now: different rows of a key differ.
    """
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        return df.withColumn(name, place)
    except AnalysisException:  # no scan, or one of a format without places
        values = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        return df.withColumn(name, F.xxhash64(F.spark_partition_id(), *values))


def hot_keys(df: DataFrame, keys: Sequence[Column], parts: int, with_nulls: bool = False) -> DataFrame:
    """(__hot_0, ..., __salts) of the keys that hold over 1 / ``parts`` of the rows: under ``parts`` rows.

    Each has a salt for every such share of its rows.  Rows are counted by buckets of the keys' hash first: a hot
    key's bucket has at least its rows, so only keys in such buckets, mostly hot ones, are counted by themselves
    and moved.
    """
    names = [f"__hot_{i}" for i in range(len(keys))]
    keyed = df.select(*[k.alias(n) for k, n in zip(keys, names)])
    bucket = F.pmod(F.xxhash64(*names), F.lit(BUCKETS * parts)).alias("__bucket")
    sizes = keyed.groupBy(bucket).agg(F.count(F.lit(1)).alias("__n"))
    share = sizes.agg((F.sum("__n") / parts).alias("__share")).scalar()
    large = sizes.filter(F.col("__n") > share).select("__bucket")  # bounded: fewer than ``parts``
    wanted = keyed if with_nulls else keyed.filter(reduce(and_, [F.col(n).isNotNull() for n in names]))
    wanted = wanted.select("*", bucket).join(F.broadcast(large), "__bucket", "left_semi")
    hot = wanted.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > share)
    return hot.select(*names, F.ceil(F.col("__n") / share).cast("int").alias("__salts"))


def _with_salts(
    df: DataFrame, keys: Sequence[Column], hot: DataFrame, name: str, null_safe: bool = False
) -> DataFrame:
    """``df`` plus the number of salts of its key under ``name``, null for an ordinary key."""
    lookup = hot.withColumnRenamed("__salts", name)
    helper = [f"__hot_{i}" for i in range(len(keys))]
    match = [k.eqNullSafe(F.col(h)) if null_safe else k == F.col(h) for k, h in zip(keys, helper)]
    # bounded: fewer hot keys than ``parts``
    return df.join(F.broadcast(lookup), reduce(and_, match), "left").drop(*helper)


def _spread(df: DataFrame, keys: Sequence[Column], hot: DataFrame, salt: str, row: Column) -> DataFrame:
    """Give each row of a hot key one salt, by its ``row`` number.

    That was taken at the scan, so rows of one key that a shuffle brought into one partition spread as
    well, and a repeated task repeats it.  Rows without a key match nothing, so they may be
    spread like any hot key.
    """
    df = _with_salts(df, keys, hot, "__salts", null_safe=True)
    chosen = F.pmod(row, F.col("__salts")).cast("int")
    return df.withColumn(salt, F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(chosen)).drop("__salts")


def _repeat(df: DataFrame, keys: Sequence[Column], hot: DataFrame, salts: str, copy: str) -> DataFrame:
    """One copy of each row per salt of its key; ``salts`` stays null for ordinary keys."""
    last = F.coalesce(F.col(salts), F.lit(1)) - 1
    return _with_salts(df, keys, hot, salts).withColumn(copy, F.explode(F.sequence(F.lit(0), last)))


def salted_outer_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[Column, Column]],
    how: str,
    left_row: Column,
    right_row: Column,
    parts: int | None = None,
) -> DataFrame:
    """Left, right or full outer equi-join that survives a hot key on a padded side.

    ``left_row`` and ``right_row`` are the sides' row numbers (``with_row``); keys with over
    1 / ``parts`` of a padded side's rows are salted.
    """
    if parts is None:
        parts = math.ceil(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")) / HOT_SHARE)
    left_keys, right_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    condition = reduce(and_, [a == b for a, b in pairs])
    # Padded sides, which adaptive execution cannot split: right of a left join and vice versa.
    # A full join pads rows without a key as well.
    hot_right = hot_keys(right, right_keys, parts, how == "full") if how in ("left", "full") else None
    hot_left = hot_keys(left, left_keys, parts, how == "full") if how in ("right", "full") else None
    lonely_copy = F.lit(False)
    if hot_right is not None:
        right = _spread(right, right_keys, hot_right, "__r_salt", right_row)
        left = _repeat(left, left_keys, hot_right, "__l_copies", "__l_copy")
        condition &= F.col("__l_copy") == F.col("__r_salt")
        lonely_copy |= F.col("__l_copies").isNotNull() & F.col("__r_salt").isNull()
    if hot_left is not None:
        left = _spread(left, left_keys, hot_left, "__l_salt", left_row)
        right = _repeat(right, right_keys, hot_left, "__r_copies", "__r_copy")
        condition &= F.col("__r_copy") == F.col("__l_salt")
        lonely_copy |= F.col("__r_copies").isNotNull() & F.col("__l_salt").isNull()
    joined = left.join(right, condition, how).filter(~F.coalesce(lonely_copy, F.lit(False)))
    return joined.drop("__l_copies", "__l_copy", "__l_salt", "__r_copies", "__r_copy", "__r_salt")


def row_of(df: DataFrame) -> Column:
    """One number from the row numbers of all datasets that are part of ``df``."""
    return F.xxhash64(*[F.col(c) for c in df.columns if c.startswith(ROW)])


def join_step(left: DataFrame, right: DataFrame, step: JoinStep) -> DataFrame:
    """Join ``right`` (already aliased) onto the accumulated chain."""
    pairs = [
        key_pair(
            left, f"{alias_of(step.left)}.{lk}", right, f"{alias_of(step.right_name)}.{rk}", step.key_type
        )
        for lk, rk in zip(step.left_keys, step.right_keys)
    ]
    if step.join_type in ("left_semi", "left_anti"):
        # Only the keys decide; repeats collapse before the shuffle.
        right = right.select(*[f"{alias_of(step.right_name)}.{k}" for k in step.right_keys]).distinct()
    if step.skew == "salt" and step.join_type in ("left", "right", "full"):
        return salted_outer_join(left, right, pairs, step.join_type, row_of(left), row_of(right))
    return left.join(right, reduce(and_, [a == b for a, b in pairs]), step.join_type)


def join_chain(frames: Mapping[str, DataFrame], steps: Sequence[JoinStep]) -> DataFrame:
    """Fold the steps in declared order.

    Columns stay reachable as ``<dataset>_table.<column>``.  The first step's left side
    is the base; each later step names a left side that is already part of the chain.
    """
    if not steps:
        raise SpecError("a join chain needs at least one step")
    missing = {steps[0].left, *[step.right for step in steps]} - set(frames)
    if missing:
        raise SpecError(f"datasets not available: {sorted(missing)}")
    base = steps[0].left
    salted = any(s.skew == "salt" and s.join_type in ("left", "right", "full") for s in steps)

    def dataset(name: str, alias: str) -> DataFrame:
        # numbered before the first shuffle
        frame = with_row(frames[name], f"{ROW}{alias}") if salted else frames[name]
        return frame.alias(alias_of(alias))

    chain = dataset(base, base)
    joined = {base}
    for step in steps:
        if step.left not in joined:
            raise SpecError(f"{step.name}: '{step.left}' is not part of the chain yet")
        if step.right_name in joined:
            raise SpecError(f"{step.name}: '{step.right_name}' is joined already; give it an 'as' name")
        chain = join_step(chain, dataset(step.right, step.right_name), step)
        if step.join_type not in ("left_semi", "left_anti"):
            joined.add(step.right_name)
    return chain.drop(*[f"{ROW}{name}" for name in joined]) if salted else chain


def unreadable_values(
    frames: Mapping[str, DataFrame], steps: Sequence[JoinStep] = (), casts: Mapping[str, Mapping[str, str]] | None = None
) -> DataFrame:
    """(dataset, column, as_type, used_as, bad_values): how many values are present but cannot be read as the
    type that a declared cast or a join compares in.

    ``frames`` are as before the casts.  Such a value becomes null: a row with one as its key matches
    nothing, and an inner join drops it.  One pass over each dataset, which reads these columns only.
    """
    casts = casts or {}
    wanted: dict[str, dict[tuple[str, str, str], Column]] = {n: {} for n in frames}

    def typed(name: str, column: str) -> Column:
        own = casts.get(name, {}).get(column)
        return F.col(column).try_cast(own) if own else F.col(column)

    def count(name: str, column: str, as_type: str, used_as: str, value: Column) -> None:
        wanted[name][column, as_type, used_as] = F.count_if(value.isNotNull() & value.try_cast(as_type).isNull())

    for name in frames:
        for column, as_type in casts.get(name, {}).items():
            count(name, column, as_type, "cast", F.col(column))
    datasets = {n: n for n in frames} | {s.right_name: s.right for s in steps}
    for step in steps:
        for lk, rk in zip(step.left_keys, step.right_keys):
            sides = [(datasets[step.left], lk), (datasets[step.right_name], rk)]
            kinds = [frames[name].select(typed(name, key)).schema[0].dataType for name, key in sides]
            as_type = step.key_type or compare_type(*kinds)
            for side, kind in zip(sides, kinds):
                if as_type and kind.simpleString() != as_type:
                    count(*side, as_type, "key", typed(*side))
    found = None
    for name, counts in wanted.items():
        if counts:
            rows = [F.struct(F.lit(name).alias("dataset"), *[F.lit(v).alias(n) for v, n in zip(what, ("column", "as_type", "used_as"))],
                             n.alias("bad_values")) for what, n in counts.items()]
            each = frames[name].agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
            found = each if found is None else found.unionByName(each)
    if found is None:
        spark = next(iter(frames.values())).sparkSession
        return spark.createDataFrame([], "dataset string, column string, as_type string, used_as string, bad_values long")
    return found


def unparsable_keys(df: DataFrame, key: str, key_type: str) -> DataFrame:
    """One row: how many keys are present but cannot be read as ``key_type``."""
    bad = F.col(key).isNotNull() & F.col(key).try_cast(key_type).isNull()
    return df.agg(F.count_if(bad).alias("unparsable_keys"))
