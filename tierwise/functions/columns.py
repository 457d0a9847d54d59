"""Column expressions: file-name metadata, date identifiers, qualified projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.spec import DATE_PARTS, FILE_COLUMNS, STAMP_DIGITS, STAMP_PATTERN, STAMP_START


def file_name_parts(name: Column, stamp_at: int | None = None) -> dict[str, Column]:
    """year, month, day and filename as text, taken from a stamped file name.

    ``stamp_at`` is where the stamp begins (from 1) if that is the same in all names, see ``stamp_place``:
    then no pattern is matched for each row.
    """
    if stamp_at:
        places = zip(DATE_PARTS, (0, 4, 6), (4, 2, 2))
        return {**{part: F.substring(name, stamp_at + at, width) for part, at, width in places}, "filename": name}
    parts = {part: F.regexp_extract(name, STAMP_PATTERN, i) for i, part in enumerate(DATE_PARTS, 1)}
    return {**parts, "filename": name}


def stamp_place(name: Column) -> Column:
    """Where a name's date begins, from 1: after what ``STAMP_PATTERN`` takes up to the last underscore before a stamp.

    Null for a name with characters that ``_metadata`` encodes.
    """
    date = F.concat(*[F.regexp_extract(name, STAMP_PATTERN, i) for i in range(1, 4)])
    at = F.length(F.regexp_extract(name, STAMP_START, 1)) + 1
    return F.when((F.substring(name, at, 8) == date) & name.rlike(r"^[A-Za-z0-9._-]+$"), at)


def file_stamp(name: Column) -> Column:
    """The 14-digit stamp of a file name, null where there is none."""
    return F.nullif(F.regexp_extract(name, STAMP_DIGITS, 1), F.lit(""))


def is_dated(name: Column) -> Column:
    """Whether a file name carries a stamp whose first eight digits are a real date."""
    return name.rlike(f"^{STAMP_PATTERN}$") & date_id_from_name(name).isNotNull()


def padded(part: Column, width: int = 2) -> Column:
    return F.lpad(part.cast("string"), width, "0")


def date_id(year: Column, month: Column, day: Column, legacy: bool = False) -> Column:
    """DATE from its parts; ``legacy`` gives the unpadded text, '' where all parts are null."""
    if legacy:
        return F.concat_ws("-", *[p.cast("string") for p in (year, month, day)])
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def with_date_id(df: DataFrame, legacy: bool = False) -> DataFrame:
    return df.withColumn("date_id", date_id(*[F.col(p) for p in DATE_PARTS], legacy=legacy)).drop(*DATE_PARTS)


def date_id_from_name(name: Column) -> Column:
    """DATE from a stamped file name, null (a reject) where the name has no valid stamp."""
    return F.try_to_timestamp(F.substring(file_stamp(name), 1, 8), F.lit("yyyyMMdd")).cast("date")


def date_id_from_name_legacy(name: Column, pattern: str) -> Column:
    """Text form: rewrite groups 1-3 of ``pattern``; an unmatched name passes through."""
    return F.regexp_replace(name, pattern, "$1-$2-$3")


def drop_file_columns(df: DataFrame) -> DataFrame:
    return df.drop(*FILE_COLUMNS)


def try_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Typed columns; malformed text becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()}) if casts else df


def malformed_counts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """(column, bad_values): values present as text that ``try_casts`` would null, one pass."""
    bad = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
        for c, t in casts.items()
    ]
    return df.agg(*bad).unpivot([], list(casts), "column", "bad_values")


def side_columns(df: DataFrame, alias: str) -> DataFrame:
    """All columns of one side of a join."""
    return df.select(f"{alias}.*")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Alias-qualified projection; each column keeps its bare name."""
    return df.select(*[F.col(c).alias(c.rsplit(".", 1)[-1]) for c in columns])
