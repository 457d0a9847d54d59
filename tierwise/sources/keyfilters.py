"""Which days of a layer can have a key: a filter of fixed size for each day, kept beside the ledger.

A new delivery's keys are looked up in the filters of all days, so that only days which may have one of them are
read for the exact answer.  A key that a day does not have is suspected there with odds of about
(1 - exp(-probes * n / 2 ** log_bits)) ** probes, n being the day's keys: with 2 ** 27 bits, six probes and
a million keys a day less than one in a hundred million, so that a delivery of a million new keys reads hardly any.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise import scratch
from tierwise.operators.keys import has_key

#: Hashes are cut to so many bits, so that sums of them stay in range.
HASH_BITS = 40


class KeyFilters:
    """The filters of one layer's ``keys``, a folder for each day."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], log_bits: int = 27, probes: int = 6) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.log_bits, self.probes = log_bits, probes

    def _bits(self) -> Column:
        """The places of a key's bits; null keys have none."""
        mask = F.lit((1 << HASH_BITS) - 1)
        first, step = (F.xxhash64(F.lit(salt), *self.keys).bitwiseAND(mask) for salt in ("first", "step"))
        places = [((first + step * i) % (1 << self.log_bits)).alias(f"b{i}") for i in range(self.probes)]
        return F.array(*places)

    def record(self, rows: DataFrame, day: datetime.date) -> None:
        """The filter of a day's ``rows``, in the place of an earlier one: only cells that have a bit are kept."""
        bits = rows.filter(has_key(self.keys)).select(F.explode(self._bits()).alias("bit"))
        cells = bits.groupBy(F.expr("int(bit div 64)").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("bits"))
        cells.write.mode("overwrite").parquet(f"{self.path}/day={day.isoformat()}")

    def suspected(self, delivery: DataFrame, but: Sequence[datetime.date] = ()) -> list[datetime.date]:
        """The days that may have a key of ``delivery``; those left out have none."""
        names = [n for n in scratch.list_names(self.spark, self.path) if n.startswith("day=")]
        days = [n for n in names if datetime.date.fromisoformat(n[4:]) not in but]
        if not days:
            return []
        schema = "cell int, bits long, day date"
        filters = self.spark.read.schema(schema).option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in days])
        keys = delivery.filter(has_key(self.keys)).select(*self.keys).distinct()
        probes = keys.select(F.xxhash64(*self.keys).alias("key"), F.explode(self._bits()).alias("bit"))
        hits = probes.select("key", F.expr("int(bit div 64)").alias("cell"), F.expr("shiftleft(1L, int(bit % 64))").alias("one"))
        hits = hits.join(filters, "cell").filter("bits & one <> 0").groupBy("day", "key").agg(F.count("*").alias("n"))
        found = hits.filter(F.col("n") >= self.probes).select("day").distinct()
        return sorted(r[0] for r in found.collect())  # one row for each day


def not_unique_with(
    delivery: DataFrame, day: datetime.date, layer: DataFrame | None, layer_day: Column, filters: KeyFilters
) -> DataFrame:
    """(keys, n) of the delivery's keys that are there more than once, in it and in the ``layer`` together.

    What the layer has of the delivery's own ``day`` is about to be replaced and does not count.  Of its other days,
    ``layer_day`` by its partition columns, only suspected ones are read.  Rows without a complete key are left out.
    """
    keys = filters.keys
    complete = delivery.filter(has_key(keys))
    counts = complete.groupBy(*keys).agg(F.count("*").alias("n"))
    if layer is not None and (days := filters.suspected(delivery, but=[day])):
        there = layer.filter(layer_day.isin(days)).select(*keys).join(complete.select(*keys).distinct(), keys, "left_semi")
        counts = counts.unionByName(there.groupBy(*keys).agg(F.count("*").alias("n")))
        counts = counts.groupBy(*keys).agg(F.sum("n").alias("n"))
    return counts.filter("n > 1")
