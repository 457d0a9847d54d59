"""Type 1 dimension merge: upsert by business key, change seen by comparing rows.

One full outer join and one projection.  Which side a row came from is read from a
marker column, never from a key or hash that may itself be null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.functions.hashing import differs, row_hash
from tierwise.operators.keys import dedup_latest, split_null_keys


class MissingColumns(ValueError):
    """The source lacks columns of the target."""


def schema_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column, in_source, in_target, same_type): one row per column of either side."""
    src, tgt = dict(source.dtypes), dict(target.dtypes)
    rows = [
        (c, c in src, c in tgt, src.get(c) == tgt.get(c))
        for c in [*tgt, *[c for c in src if c not in tgt]]
    ]
    return source.sparkSession.createDataFrame(
        rows, "column string, in_source boolean, in_target boolean, same_type boolean"
    )


def require_columns(source: DataFrame, target: DataFrame, derived: Sequence[str] = ()) -> None:
    missing = [c for c in target.columns if c not in source.columns and c not in derived]
    if missing:
        raise MissingColumns(f"columns missing in the source: {', '.join(missing)}")


def align(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source in the target's column order and types; extra columns are left out.

    The cast is strict: a value the target cannot hold fails the job.
    """
    types = {f.name: f.dataType for f in target.schema}
    have = {f.name: f.dataType for f in source.schema}
    return source.select(
        *[F.col(c) if have[c] == t else F.col(c).cast(t).alias(c) for c, t in types.items()]
    )


@dataclass(frozen=True)
class Compare:
    """How two versions of a row are compared.

    ``null_safe`` compares column by column.  ``hash`` compares joined-text hashes, in
    which shifted nulls and embedded separators collide.
    """

    columns: tuple[str, ...]
    mode: str = "null_safe"

    def changed(self, left: str, right: str) -> Column:
        if self.mode == "hash":
            return row_hash([F.col(f"{left}.{c}") for c in self.columns]) != row_hash(
                [F.col(f"{right}.{c}") for c in self.columns]
            )
        return differs([(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in self.columns])


def compare_columns(target: DataFrame, keys: Sequence[str], exclude: Sequence[str]) -> tuple[str, ...]:
    return tuple(c for c in target.columns if c not in keys and c not in exclude)


def prepared_source(
    source: DataFrame, target: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Complete keys only, one row per key, aligned to the target; no other column is read."""
    require_columns(source, target)
    return align(latest_complete(source, target.columns, keys, order_by), target)


def latest_complete(
    source: DataFrame, columns: Sequence[str], keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The latest row of each complete key, reduced to ``columns`` and the ordering ones."""
    extra = [c for c in order_by if c not in columns]
    valid, _ = split_null_keys(source.select(*columns, *extra), keys)
    return dedup_latest(valid, keys, order_by)


def _paired(source: DataFrame, target: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    s = source.withColumn("__in_s", F.lit(True)).alias("s")
    t = target.withColumn("__in_t", F.lit(True)).alias("t")
    return t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], how)


def change_class(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    compare: str = "null_safe",
    compare_exclude: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """(keys, change): new, updated, unchanged or target_only, for every key of either side."""
    rule = Compare(compare_columns(target, keys, compare_exclude), compare)
    keyed, keyless = split_null_keys(target, keys)
    base = _paired(prepared_source(source, target, keys, order_by), keyed, keys, "full")
    change = (
        F.when(F.col("s.__in_s").isNull(), "target_only")
        .when(F.col("t.__in_t").isNull(), "new")
        .when(rule.changed("s", "t"), "updated")
        .otherwise("unchanged")
    )
    classes = base.select(*[F.coalesce(f"s.{k}", f"t.{k}").alias(k) for k in keys], change.alias("change"))
    return classes.unionByName(keyless.select(*keys, F.lit("target_only").alias("change")))


def scd1_merge(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    compare: str = "null_safe",
    metadata_cols: Sequence[str] = (),
    compare_exclude: Sequence[str] = (),
    order_by: Sequence[str] = (),
    delete_missing: bool = False,
    small_source: bool = False,
) -> DataFrame:
    """The whole target after the upsert, in the target's columns.

    ``metadata_cols`` and ``compare_exclude`` do not count as changes; an unchanged row
    keeps the target's values for them.  ``order_by`` decides between several source
    rows of one key.  Source rows with an incomplete key are left out (see
    ``split_null_keys`` for the quarantine).  Keys absent from the source are kept unless
    ``delete_missing``.

    ``small_source`` says the source is known to fit a broadcast: then no target row is
    shuffled.  The caller proves the size (``measured_bytes``).
    """
    ready = prepared_source(source, target, keys, order_by)
    excluded = [*metadata_cols, *compare_exclude]
    rule = Compare(compare_columns(target, keys, excluded), compare)
    take_source = F.col("s.__in_s").isNotNull()
    if excluded or compare == "hash":
        # coalesce: no target row at all compares as null in hash mode
        take_source &= F.col("t.__in_t").isNull() | F.coalesce(rule.changed("s", "t"), F.lit(True))
    merged = [
        F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns
    ]
    if not small_source:
        if delete_missing:
            return _paired(ready, target, keys, "right").select(*merged)
        # Rows without a key match nothing, and in the full join all of them would go to one task.
        keyed, keyless = split_null_keys(target, keys)
        return _paired(ready, keyed, keys, "full").select(*merged).unionByName(keyless)
    ready = F.broadcast(ready)
    how = "inner" if delete_missing else "left"
    kept = _paired(ready, target, keys, how).select(*merged)
    return kept.unionByName(unmatched(ready, target, keys))


def unmatched(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a small batch whose key the target lacks; of the target only keys are read."""
    matched = target.select(*keys).join(F.broadcast(batch.select(*keys)), list(keys), "left_semi")
    # Matched keys are a subset of the batch's keys, so they fit a broadcast as well.
    return batch.join(F.broadcast(matched.distinct()), list(keys), "left_anti")


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows' size as text: one aggregate pass, one row to the driver."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns]
    total = widths[0]
    for width in widths[1:]:
        total = total + width
    return df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0)).alias("b")).first().b
