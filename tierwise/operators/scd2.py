"""Type 2 dimension: one row per version, valid in [effective_from, effective_to)."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.hashing import version_hash
from tierwise.operators.keys import dedup_latest, has_key
from tierwise.operators.scd1 import latest_complete, require_columns, unmatched

VERSION_COLUMNS = ("effective_from", "effective_to", "is_current", "row_hash")


def business_columns(history: DataFrame) -> list[str]:
    return [c for c in history.columns if c not in VERSION_COLUMNS]


def open_versions(
    df: DataFrame, keys: Sequence[str], effective: datetime.date | Column, exclude: Sequence[str] = ()
) -> DataFrame:
    """Rows of a first load as open versions."""
    compared = [c for c in df.columns if c not in keys and c not in exclude]
    start = F.lit(effective) if isinstance(effective, datetime.date) else effective
    return df.select(
        "*",
        start.cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        version_hash(compared).alias("row_hash"),
    )


def _batch(
    source: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    effective: datetime.date,
    exclude: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """The batch as open versions: complete keys, one row per key, the history's types."""
    require_columns(source, history, derived=VERSION_COLUMNS)
    names = business_columns(history)
    types = {f.name: f.dataType for f in history.schema}
    latest = latest_complete(source, names, keys, order_by)
    typed = latest.select(*[F.col(c).cast(types[c]).alias(c) for c in names])
    return open_versions(typed, keys, effective, exclude)


def _paired(batch: DataFrame, current: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Current versions (t) beside the batch (s), with markers."""
    s = batch.withColumn("__in_s", F.lit(True)).alias("s")
    t = current.withColumn("__in_t", F.lit(True)).alias("t")
    return t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], how)


def scd2_merge(
    source: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    effective: datetime.date,
    exclude: Sequence[str] = (),
    order_by: Sequence[str] = (),
    small_source: bool = False,
) -> DataFrame:
    """The whole history after a batch valid from ``effective``.

    Changed keys get their current version closed and a new one opened; closed versions
    pass through untouched.  Only current versions are joined.  Applying a batch twice
    changes nothing, and a changed delivery for the same day replaces the versions that day
    opened.  Changes earlier than the version they would close are left out here and
    reported by ``late_rows``; ``splice_versions`` puts them where they belong.
    ``small_source`` says the source is known to fit a broadcast: no version is shuffled.
    """
    columns = history.columns
    batch = _batch(source, history, keys, effective, exclude, order_by).select(*columns)
    current = history.filter("is_current")
    if small_source:
        batch = F.broadcast(batch)
    base = _paired(batch, current, keys, "left" if small_source else "full")
    in_s, in_t = F.col("s.__in_s").isNotNull(), F.col("t.__in_t").isNotNull()
    changed = in_s & in_t & (F.col("s.row_hash") != F.col("t.row_hash"))
    closes = changed & (F.col("t.effective_from") < F.lit(effective))
    replaces = changed & (F.col("t.effective_from") == F.lit(effective))

    def version(side: str, **values: Column) -> Column:
        return F.struct(*[values.get(c, F.col(f"{side}.{c}")).alias(c) for c in columns])

    as_is = version("t")
    closed = version("t", effective_to=F.lit(effective).cast("date"), is_current=F.lit(False))
    opened = version("s")
    rows = (
        F.when(~in_t | replaces, F.array(opened))
        .when(closes, F.array(closed, opened))
        .otherwise(F.array(as_is))
    )
    merged = base.select(F.explode(rows).alias("v")).select("v.*")
    if small_source:
        merged = merged.unionByName(unmatched(batch, current, keys))
    return history.filter("NOT is_current").unionByName(merged)


def splice_versions(
    source: DataFrame,
    history: DataFrame,
    seen: DataFrame,
    keys: Sequence[str],
    effective: datetime.date,
    exclude: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """(removed, added): for each key that a batch of any day changes, arrays of the versions that go and
    of those that come.

    A row is a delivery of its key on the day ``effective``, and stands until the key's next one.  It
    falls into the version that is valid on that day, or before all; that version is cut there, and goes
    on from the next day of ``seen`` (keys and ``day``: when which keys were delivered) inside it.  A
    neighbour that says the same is joined instead of followed.  Of ``history`` only the versions that
    are current or close on that day or later are needed.  A joined version has the columns of its
    earlier part; one that goes on has those it had, also outside the compared ones.
    """
    columns, names = history.columns, list(keys)
    day = F.lit(effective).cast("date")
    start, end = F.col("effective_from"), F.col("effective_to")
    whole = F.struct(*columns)
    batch = _batch(source, history, keys, effective, exclude, order_by).select(*names, whole.alias("__b"))
    holds = (start <= day) & (end.isNull() | (end > day))
    around = (
        history.filter(end.isNull() | (end >= day))
        .join(batch.select(*names), names, "left_semi")
        .groupBy(*names)
        .agg(
            F.first(F.when(end == day, whole), ignorenulls=True).alias("__p"),
            F.first(F.when(holds, whole), ignorenulls=True).alias("__v"),
            F.min_by(whole, F.when(start > day, start)).alias("__w"),
        )
    )
    onward = seen.filter(F.col("day") > day).join(batch.select(*names), names, "left_semi")
    onward = onward.groupBy(*names).agg(F.min("day").alias("__s"))
    found = batch.join(around, names, "left").join(onward, names, "left")
    p, v, w, s, b = (F.col(f"__{x}") for x in "pvwsb")
    v_to = v["effective_to"]
    begins = v["effective_from"] == day
    again = v.isNotNull() & s.isNotNull() & (v_to.isNull() | (s < v_to))
    upto = F.when(again, s).when(v.isNotNull(), v_to).otherwise(w["effective_from"])
    with_next = ~again & w.isNotNull() & (w["effective_from"] == upto) & (w["row_hash"] == b["row_hash"])
    with_last = p.isNotNull() & (v.isNull() | begins) & (p["row_hash"] == b["row_hash"])

    def version(row: Column, first: Column, last: Column) -> Column:
        values = {"effective_from": first, "effective_to": last, "is_current": last.isNull()}
        return F.struct(*[values.get(c, row[c]).alias(c) for c in columns])

    last = F.when(with_next, w["effective_to"]).otherwise(upto)
    new = F.when(with_last, version(p, p["effective_from"], last)).otherwise(version(b, day, last))
    added = [F.when(v.isNotNull() & ~begins, version(v, v["effective_from"], day)), new, F.when(again, version(v, s, v_to))]
    removed = [v, F.when(with_next, w), F.when(with_last, p)]
    changed = found.filter(v.isNull() | (v["row_hash"] != b["row_hash"]))
    return changed.select(
        F.array_compact(F.array(*removed)).alias("removed"), F.array_compact(F.array(*added)).alias("added")
    )


def late_rows(
    source: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    effective: datetime.date,
    exclude: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Batch rows that change a key whose current version is newer than the batch."""
    batch = _batch(source, history, keys, effective, exclude, order_by)
    base = _paired(batch, history.filter("is_current"), keys, "inner")
    late = (F.col("s.row_hash") != F.col("t.row_hash")) & (F.col("t.effective_from") > F.lit(effective))
    return base.filter(late).select(*[F.col(f"s.{c}") for c in business_columns(history)])


def rebuild_history(
    versions: DataFrame,
    keys: Sequence[str],
    effective_from: str = "effective_from",
    exclude: Sequence[str] = (),
    sequence_by: Sequence[str] = (),
) -> DataFrame:
    """History from dated rows in any order: the way out of late and out-of-order batches.

    Dates are days and the last row of a key's day by ``sequence_by`` wins, chosen before
    the shuffle; a key therefore brings at most one row per calendar day to the
    sequencing window, however many raw rows it has.  Repeats of the previous version
    collapse.  ``sequence_by`` columns only order rows; they are not part of a version.
    """
    helpers = {*VERSION_COLUMNS, effective_from, *sequence_by}
    kept = [c for c in versions.columns if c not in helpers]
    compared = [c for c in kept if c not in keys and c not in exclude]
    dated = versions.select(
        *kept, *sequence_by, F.col(effective_from).cast("date").alias("effective_from")
    ).filter(F.col("effective_from").isNotNull() & has_key(keys))
    daily = dedup_latest(dated, [*keys, "effective_from"], sequence_by)
    by_day = Window.partitionBy(*keys).orderBy("effective_from")
    hashed = daily.select(*kept, "effective_from", version_hash(compared).alias("row_hash"))
    starts = (
        hashed.withColumn("__before", F.lag("row_hash").over(by_day))
        .filter(F.col("__before").isNull() | (F.col("__before") != F.col("row_hash")))
        .drop("__before")
    )
    return starts.withColumn("effective_to", F.lead("effective_from").over(by_day)).select(
        *kept,
        "effective_from",
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
        "row_hash",
    )
