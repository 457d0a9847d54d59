"""Filters of hashed keys, and rows taken out of a large table without moving the others.

A filter is a bitmap with two probes for each key.  It gets sixteen bits or more for every key,
so that about one key in seventy that it has not passes, up to ``MOST_BITS`` (8 MiB): beyond four
million keys more pass, and whoever uses it decides about them exactly, so no result depends on it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import free_name, ship_package

LEAST_BITS, MOST_BITS = 16, 26


def filter_of(keys: DataFrame) -> np.ndarray:
    """The filter, as bytes, of the first column of ``keys``, hashes of 64 bits.

    At most 2 ** MOST_BITS / 64 pairs of numbers come to the driver, whatever the number of keys.
    """
    (name,) = keys.columns
    bits = min(max((16 * keys.count() - 1).bit_length(), LEAST_BITS), MOST_BITS)
    probes = F.array(F.shiftrightunsigned(name, 64 - bits), F.col(name).bitwiseAND(F.lit((1 << bits) - 1)))
    cells = (
        keys.select(F.explode(probes).alias("bit"))
        .groupBy(F.expr("int(bit div 64)").alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("bits"))
        .toArrow()
    )
    found = np.zeros((1 << bits) // 64, dtype=np.int64)
    found[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return found.view(np.uint8)


def passing(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions of the hashes that the filter lets through: all that it has, and few others."""
    bits = (8 * len(cells)).bit_length() - 1

    def has(bit: np.ndarray) -> np.ndarray:
        return (cells[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1

    first = np.flatnonzero(has(hashes >> np.uint64(64 - bits)))
    return first[has(hashes[first] & np.uint64((1 << bits) - 1)) == 1]


def parted(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """``rows`` in two parts, and the name of a column with their key in both: those whose key the filter of
    ``keys`` (one column) lets through, the second part, have to be decided on; the others are in ``keys`` surely not.

    Telling them apart needs their key only, in the task that has read them; the rows are read twice.
    """
    spark = rows.sparkSession
    ship_package(spark)
    cells = spark.sparkContext.broadcast(filter_of(keys.select(F.xxhash64(*keys.columns).alias("hash"))))

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        found = np.zeros(len(hashes), dtype=bool)
        found[passing(cells.value, hashes.to_numpy().view(np.uint64))] = True
        return pd.Series(found)

    name = free_name(rows, "row_key")
    keyed = rows.withColumn(name, key)
    through = passes(F.xxhash64(name))
    return keyed.filter(~through), keyed.filter(through), name


def without_keys(rows: DataFrame, key: Column, gone: DataFrame, single: DataFrame | None = None) -> DataFrame:
    """``rows`` but those whose ``key`` is in the column row_key of ``gone``; of the rows that share a key of
    ``single`` (same column) one stays.

    Kept rows pass where they are read.  Only rows to be left out, and the few others that a filter
    cannot tell from them, are moved to a join; all columns stay as they are, whatever their names.
    """
    keys = gone.select("row_key") if single is None else gone.select("row_key").union(single.select("row_key"))
    others, doubtful, name = parted(rows, key, keys)
    decided = doubtful.join(gone.select(F.col("row_key").alias(name)), name, "left_anti")
    if single is not None:
        decided = decided.dropDuplicates([name])
    return others.unionByName(decided.select(*others.columns)).drop(name)
