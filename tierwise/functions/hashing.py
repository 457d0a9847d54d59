"""Row comparison: joined-text hash, unambiguous stored hash, null-safe difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: Sequence[Column | str]) -> Column:
    """md5 of the non-null values joined by '|'.  Nulls vanish, so shifted nulls collide."""
    return F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in columns]))


def version_hash(columns: Sequence[Column | str]) -> Column:
    """md5 over length-prefixed values: nulls, shifts and separators all stay distinct."""
    parts = []
    for column in columns:
        text = _col(column).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts)) if parts else F.md5(F.lit(""))


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True where any pair differs, two nulls being equal; never null."""
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~left.eqNullSafe(right) for left, right in pairs])


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
