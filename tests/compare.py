"""Runs a registered query and its SQL and compares the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def mismatch(spark, con, name, run, sql, sf_dir) -> str | None:
    frame = run(spark, sf_dir)
    relation = con.sql(sql)
    if sorted(frame.columns) != sorted(relation.columns):
        return f"{name}: columns {sorted(frame.columns)} != {sorted(relation.columns)}"
    ours = rows_of(frame.columns, frame.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if not ours:
        return f"{name}: no rows"
    if ours != theirs:
        only = [r for r in ours if r not in set(theirs)][:2]
        other = [r for r in theirs if r not in set(ours)][:2]
        return f"{name}: {len(ours)} rows != {len(theirs)} rows; e.g. {only} / {other}"
    kinds = {c: t for c, t in frame.dtypes}
    sql_kinds = dict(zip(relation.columns, map(str, relation.types)))
    odd = {c: (kinds[c], sql_kinds[c]) for c in kinds if not same_kind(kinds[c], sql_kinds[c])}
    return f"{name}: types {odd}" if odd else None


def same_kind(spark_type: str, duck_type: str) -> bool:
    expected = {
        "string": ("VARCHAR",),
        "bigint": ("BIGINT",),
        "int": ("INTEGER",),
        "double": ("DOUBLE",),
        "boolean": ("BOOLEAN",),
        "date": ("DATE",),
        "timestamp_ntz": ("TIMESTAMP",),
        "timestamp": ("TIMESTAMP", "TIMESTAMP WITH TIME ZONE"),
    }
    return duck_type in expected.get(spark_type, (duck_type,))
