"""Feeds whose deliveries have different schemas."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.sources.files import ingest
from tierwise.sources.schemas import SchemaConflict, SchemaLog, merged_schema, wider
from tierwise.spec import DatasetSpec

KINDS = (
    "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(4, 1)", "decimal(12, 2)", "decimal(38, 0)", "string", "date",
    "timestamp", "timestamp_ntz", "boolean", "array<int>", "array<bigint>", "map<string, int>", "struct<a: int>", "struct<a: double, b: string>",
)


def parse(text):
    return T.StructType.fromDDL(f"c {text}")["c"].dataType



def test_types_are_ordered(spark):
    """A least upper bound: the same from both sides, at least as wide as both, and reached in any order."""
    kinds = list(map(parse, KINDS))
    for a in kinds:
        assert wider(a, a) == a and wider(a, T.NullType()) == a
        for b in kinds:
            both = wider(a, b)
            assert (both is None) == (wider(b, a) is None)
            if not isinstance(a, T.StructType):
                assert both == wider(b, a)
            if both is not None and not isinstance(a, T.StructType):
                assert wider(both, a) == both and wider(both, b) == both
    name = lambda t: t and t.simpleString()
    pairs = {("int", "bigint"): "bigint", ("int", "float"): "double", ("bigint", "double"): None, ("smallint", "float"): "float",
             ("decimal(12, 2)", "decimal(6, 4)"): "decimal(14,4)", ("decimal(38, 0)", "decimal(4, 2)"): None, ("bigint", "decimal(5, 2)"): "decimal(21,2)",
             ("date", "timestamp"): "timestamp", ("timestamp", "timestamp_ntz"): None, ("string", "int"): None,
             ("struct<a: int>", "struct<a: bigint, b: string>"): "struct<a:bigint,b:string>"}
    for (a, b), expected in pairs.items():
        assert name(wider(parse(a), parse(b))) == expected, (a, b)


def test_all_conflicts_are_named(spark):
    old, new = (parse(t) for t in ("struct<a: int, b: string, c: date>", "struct<c: boolean, a: string, d: int>"))
    with pytest.raises(SchemaConflict, match="a is int, and string.*c is date, and boolean"):
        merged_schema(old, new)


def deliver(frame, root, stamp, fmt="parquet"):
    frame.coalesce(1).write.format(fmt).mode("append").option("mapreduce.output.basename", f"things_{stamp}.").save(root)


def test_deliveries_in_one_frame(spark, tmp_path):
    root = f"{tmp_path}/bronze"
    spec = DatasetSpec("things", root, format="parquet", pattern=r"things_\d{14}.*", snapshot="all", schema_log=f"{tmp_path}/log")
    deliver(spark.sql("select 1 id, date'2024-01-01' at, cast(1.5 as decimal(3, 1)) v"), root, "20240101000000")
    assert ingest(spark, spec).frame.schema["id"].dataType == T.IntegerType()
    deliver(spark.sql("select 5000000000 id, timestamp_ntz'2024-01-02 10:00:00' at, 'new' more"), root, "20240102000000")
    deliver(spark.sql("select cast(3 as smallint) id, cast(12345.678 as decimal(8, 3)) v"), root, "20240103000000")
    frame = ingest(spark, spec).frame
    assert [f.simpleString() for f in frame.schema[:4]] == ["id:bigint", "at:timestamp_ntz", "v:decimal(8,3)", "more:string"]
    rows = [(r.id, r.at and str(r.at), r.v and str(r.v), r.more, r.day) for r in frame.orderBy("day").collect()]
    assert rows == [(1, "2024-01-01 00:00:00", "1.500", None, "01"), (5000000000, "2024-01-02 10:00:00", None, "new", "02"), (3, None, "12345.678", None, "03")]
    assert sorted(SchemaLog(spark, f"{tmp_path}/log").deliveries("things")) == [f"2024010{n}000000" for n in (1, 2, 3)]

    deliver(spark.sql("select 'x' id"), root, "20240104000000")
    before = sorted(os.listdir(f"{tmp_path}/log/things"))
    with pytest.raises(SchemaConflict, match="things, delivery 20240104000000: id is bigint, and string"):
        ingest(spark, spec)
    assert sorted(os.listdir(f"{tmp_path}/log/things")) == before
    assert spark.read.parquet(f"{root}/things_20240103*").select(F.max("id")).first()[0] == 3


def test_header_files(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "things_20240101000000.csv").write_text("id,v\n1,a\n")
    (tmp_path / "b" / "things_20240102000000.csv").write_text("v,id,w\nb,2,x\n")
    spec = DatasetSpec("things", f"{tmp_path}/b", pattern=r"things_\d{14}.*", snapshot="all", schema_log=f"{tmp_path}/log")
    rows = ingest(spark, spec).frame.select("id", "v", "w", "day").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "a", None, "01"), ("2", "b", "x", "02")]
