"""Schemas of a feed's deliveries: kept with each, widened over all, refused where they do not fit.

Types are ordered: a type is wider than another if it holds all its values as they are.  Deliveries of
older and newer files are read each with its own schema and brought to the least type that is wider
than all; a column that a delivery lacks is null in it.  A delivery that would need a type no wider
than what is there (text that becomes a number, a day that becomes a float) is refused before
anything is read or written.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise import scratch
from tierwise.functions.columns import file_name_parts
from tierwise.sources.files import feed_files, with_format
from tierwise.spec import DATE_PARTS, DatasetSpec

# Integer types in their order with the digits that they need, and floats that hold all of them.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
HELD_BY = {T.ByteType: T.FloatType, T.ShortType: T.FloatType, T.IntegerType: T.DoubleType}


class SchemaConflict(ValueError):
    """A delivery's columns do not fit what was delivered before."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both; None if none does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(DIGITS):
        return max((a, b), key=lambda t: DIGITS[type(t)])
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    whole = next((t for t in (a, b) if type(t) in DIGITS), None)
    other = b if whole is a else a
    if whole is not None and isinstance(other, (T.FloatType, T.DoubleType)):
        held = HELD_BY.get(type(whole))
        return held and wider(held(), other)
    if whole is not None and isinstance(other, T.DecimalType):
        return _decimal(max(DIGITS[type(whole)], other.precision - other.scale), other.scale)
    if kinds == {T.DecimalType}:
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    if T.DateType in kinds and kinds & {T.TimestampType, T.TimestampNTZType}:
        return a if isinstance(b, T.DateType) else b
    if kinds == {T.ArrayType}:
        element = wider(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    if kinds == {T.MapType} and a.keyType == b.keyType:
        value = wider(a.valueType, b.valueType)
        return value and T.MapType(a.keyType, value)
    if kinds == {T.StructType}:
        merged, bad = _merged(a, b)
        return None if bad else merged
    return None


def _decimal(whole: int, scale: int) -> T.DecimalType | None:
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _merged(old: T.StructType, new: T.StructType) -> tuple[T.StructType, list[str]]:
    """The fields of both, the old ones first, and what is wrong."""
    by_name = {f.name: f.dataType for f in new}
    fields, bad = [], []
    for f in old:
        kind = wider(f.dataType, by_name.get(f.name, f.dataType))
        if kind is None:
            bad.append(f"{f.name} is {f.dataType.simpleString()}, and {by_name[f.name].simpleString()} does not fit it")
        fields.append(T.StructField(f.name, kind or f.dataType))
    known = {f.name for f in old}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name not in known]), bad


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    merged, bad = _merged(old, new)
    if bad:
        raise SchemaConflict("; ".join(bad))
    return merged


class SchemaLog:
    """One small file with the schema of each delivery of a dataset, named by its stamp."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def deliveries(self, dataset: str) -> Mapping[str, T.StructType]:
        names = [n for n in scratch.list_names(self.spark, f"{self.path}/{dataset}") if n.endswith(".json")]
        texts = {n.removesuffix(".json"): scratch.read_text(self.spark, f"{self.path}/{dataset}/{n}") for n in names}
        return {stamp: T.StructType.fromJson(json.loads(text)) for stamp, text in texts.items()}

    def current(self, dataset: str) -> T.StructType:
        """The schema that all deliveries fit, columns in the order in which they came."""
        found = T.StructType([])
        for _, schema in sorted(self.deliveries(dataset).items()):
            found = merged_schema(found, schema)
        return found

    def admit(self, dataset: str, stamp: str, schema: T.StructType) -> T.StructType:
        """Record a delivery's schema, or refuse it and leave everything as it was; the schema of all."""
        try:
            merged = merged_schema(self.current(dataset), schema)
        except SchemaConflict as err:
            raise SchemaConflict(f"dataset {dataset}, delivery {stamp}: {err}") from None
        scratch.write_text(self.spark, f"{self.path}/{dataset}/{stamp}.json", schema.json())
        return merged


def read_evolving(spark: SparkSession, spec: DatasetSpec, log: SchemaLog, listing: DataFrame | None = None) -> DataFrame | None:
    """All deliveries of a feed in one frame with the schema that fits all, tagged like every feed.

    A delivery that the log does not have is looked at and admitted first, in the order of stamps; one that
    does not fit stops the read before any other work.  Deliveries of one schema are read together.
    """
    files = (feed_files(spark, spec) if listing is None else listing).filter("dated")
    paths: dict[str, list[str]] = {}
    for row in files.select("path", "stamp").collect():  # file names only
        paths.setdefault(row.stamp, []).append(row.path)
    if not paths:
        return None
    known = dict(log.deliveries(spec.name))
    for stamp in sorted(set(paths) - set(known)):
        known[stamp] = with_format(spark.read, spec).load(sorted(paths[stamp])).schema
        log.admit(spec.name, stamp, known[stamp])
    target = log.current(spec.name)
    together: dict[str, list[str]] = {}
    for stamp in sorted(paths):
        together.setdefault(known[stamp].json(), []).append(stamp)
    found = None
    for text, stamps in together.items():
        schema = T.StructType.fromJson(json.loads(text))
        reader = with_format(spark.read, spec).schema(schema)
        parts = file_name_parts(F.col("_metadata.file_name"))
        rows = reader.load(sorted(p for s in stamps for p in paths[s])).withColumns(parts)
        own = set(schema.names)
        columns = [(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
        rows = rows.select(*columns, *parts)
        found = rows if found is None else found.unionByName(rows)
    return found


def silver_schema(spark: SparkSession, spec: DatasetSpec) -> T.StructType | None:
    """What to read a silver layer as whose older days were written with narrower types or fewer columns."""
    if not spec.schema_log:
        return None
    current = SchemaLog(spark, spec.schema_log).current(spec.name)
    parts = [T.StructField(p, T.IntegerType()) for p in DATE_PARTS]
    return T.StructType([*current.fields, T.StructField("filename", T.StringType()), *parts])
