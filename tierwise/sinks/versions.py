"""Publishing through the catalog, folder by folder: no published file is moved, renamed or overwritten.

A publish writes the partition folders it changes below a folder of its own, a version.  Then it writes
its manifest, one small file, created once: which folder of which version every partition of the table
is, and what is in it (rows, and a digest that does not depend on their order).  With that the publish
has happened; the catalog's partitions are set to the new locations, and a mark says that they are.  A
publish that was stopped before its manifest leaves files that nothing names; one stopped after it is
rolled forward by the next.  Readers of the table never see a folder change under them.

Versions stay as long as one of the last manifests names them, so that earlier ones can be read and
two be compared: only folders whose digests differ are read for that.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierwise import scratch
from tierwise.functions.hashing import differs
from tierwise.parallel import listing_by_cores, together
from tierwise.sinks.publish import NO_VALUE, partition_folders, write_partitioned
from tierwise.sources import catalog
from tierwise.sources.catalog import quoted

# Folder of the manifests below the table's path, ending of the marks, folders changed by one statement or, where each
# needs its own, by one thread, and such threads at a time.
MANIFESTS, DONE, TOGETHER, AT_ONCE = "_manifests", ".done", 100, 16


@dataclass(frozen=True)
class Folder:
    """Where a partition's files are, and what they hold."""

    version: str
    rows: int
    digest: str


@dataclass(frozen=True)
class Manifest:
    """All partitions after a publish, and the names of those that it has changed or dropped."""

    version: str
    columns: tuple[str, ...]
    schema: str
    folders: Mapping[str, Folder]
    changed: tuple[str, ...]
    dropped: tuple[str, ...]
    note: str | None = None

    def text(self) -> str:
        return json.dumps(self, default=lambda part: part.__dict__)

    @classmethod
    def of(cls, text: str) -> Manifest | None:
        """None for a file whose writing was stopped."""
        try:
            values = json.loads(text)
        except ValueError:
            return None
        values["folders"] = {name: Folder(**f) for name, f in values["folders"].items()}
        return cls(**{**values, **{c: tuple(values[c]) for c in ("columns", "changed", "dropped")}})


def manifests(spark: SparkSession, path: str) -> list[str]:
    """Versions that have a manifest, oldest first."""
    names = scratch.list_names(spark, f"{path}/{MANIFESTS}")
    return [n.removesuffix(".json") for n in names if n.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: str | None = None) -> Manifest | None:
    """That of ``version``, or the newest one."""
    wanted = [version] if version else reversed(manifests(spark, path))
    texts = (scratch.read_text(spark, f"{path}/{MANIFESTS}/{v}.json") for v in wanted)
    return next((m for m in map(Manifest.of, filter(None, texts)) if m), None)


def publish_folders(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    path: str,
    columns: Sequence[str],
    whole: bool = True,
    emptied: Iterable[str] = (),
    keep: int = 2,
    rebalance: bool = True,
    note: str | None = None,
) -> int:
    """Publish ``df``, which may read the table itself, partitioned by ``columns``; the table's rows afterwards.

    It is the ``whole`` new content, or else replaces the folders that it has rows of, and those of ``emptied``
    that it has none of go.  A folder whose content is what it was stays where it is.  ``note`` is a text that
    is published with the data.  The folders of the last ``keep`` manifests are kept.
    """
    path = path.rstrip("/")
    roll_forward(spark, table, path)
    before = manifest(spark, path)
    if before is None and spark.catalog.tableExists(table):
        raise ValueError(f"{table} exists and was not published by folders")
    kinds = kinds_of(df.schema)
    if before and (was := kinds_of(schema_of(before))) != kinds:
        raise ValueError(f"{table}: its columns are {was}, not {kinds}")
    version = f"v{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    with listing_by_cores(spark):
        write_partitioned(df, f"{path}/{version}", mode="errorifexists", partition_by=columns, rebalance=rebalance)
        written = digests(spark, f"{path}/{version}", version, df.schema, columns)
    old = dict(before.folders) if before else {}
    leaving = set(old if whole else emptied) - set(written)
    same = {n for n, f in written.items() if n in old and (f.rows, f.digest) == (old[n].rows, old[n].digest)}
    changed = {n: f for n, f in written.items() if n not in same}
    now = {n: f for n, f in {**old, **changed}.items() if n not in leaving}
    made = Manifest(version, tuple(columns), df.schema.json(), now, tuple(sorted(changed)), tuple(sorted(leaving & set(old))), note)
    scratch.write_once(spark, f"{path}/{MANIFESTS}/{version}.json", made.text())
    roll_forward(spark, table, path)
    expire(spark, path, keep)
    return sum(f.rows for f in now.values())


def digests(spark: SparkSession, root: str, version: str, schema: StructType, columns: Sequence[str]) -> dict[str, Folder]:
    """The folders below ``root``, their numbers of rows and sums of two hashes of each row."""
    if not partition_folders(spark, root, len(columns)):
        return {}
    names = sorted(f.name for f in schema if f.name not in columns)
    rows = spark.read.schema(StructType([f for f in schema if f.name in names])).option("recursiveFileLookup", "true").parquet(root)

    def total(*salt: Column) -> Column:
        return F.sum(F.xxhash64(*salt, *[F.col(n) for n in names]).cast("decimal(38)")).cast("string")

    at = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("at")
    found = rows.groupBy(at).agg(F.count("*").alias("n"), total(F.lit(0)).alias("a"), total(F.lit(1)).alias("b")).collect()
    return {"/".join(unquote(r["at"]).split("/")[-len(columns) :]): Folder(version, r["n"], f"{r['a']}:{r['b']}") for r in found}


def schema_of(of: Manifest) -> StructType:
    return StructType.fromJson(json.loads(of.schema))


def kinds_of(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def text_of(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def partition_of(name: str) -> str:
    """The catalog's PARTITION clause for a folder's name."""
    parts = [part.split("=", 1) for part in name.split("/")]
    values = [f"`{c}` = {'null' if v == NO_VALUE else text_of(unquote(v))}" for c, v in parts]
    return f"PARTITION ({', '.join(values)})"


def chunks(names: Sequence[str]) -> list[Sequence[str]]:
    return [names[i : i + TOGETHER] for i in range(0, len(names), TOGETHER)]


def roll_forward(spark: SparkSession, table: str, path: str) -> bool:
    """Set the catalog to the newest manifest if it is not there yet; any number of times.

    A folder's new place takes a statement of its own: many folders are dealt to threads, which the driver's
    cores and the catalog serve side by side.  A table that the catalog does not know, or not any more, is created with all its partitions.
    """
    newest, name = manifest(spark, path), quoted(table)
    if newest is None:
        return False
    known, to_set = spark.catalog.tableExists(table), newest.changed
    if known and scratch.path_exists(spark, f"{path}/{MANIFESTS}/{newest.version}{DONE}"):
        return False
    if not known:
        parts = ", ".join(f"`{c}`" for c in newest.columns)
        columns = kinds_of(schema_of(newest))
        place = text_of(f"{path}/_table")  # nothing is ever in it: partitions have their own places
        catalog.change(spark, f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION {place}")
        to_set = tuple(newest.folders)
    there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # one row per folder
    place = {n: f"LOCATION {text_of(f'{path}/{f.version}/{n}')}" for n, f in newest.folders.items()}

    def set_places(names: Sequence[str]) -> None:
        for n in names:
            catalog.change(spark, f"ALTER TABLE {name} {partition_of(n)} SET {place[n]}")

    moved = chunks([n for n in to_set if n in there])
    together(spark, {f"from {names[0]}": partial(set_places, names) for names in moved}, AT_ONCE)
    for names in chunks([n for n in to_set if n not in there]):
        added = " ".join(f"{partition_of(n)} {place[n]}" for n in names)
        catalog.change(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for names in chunks(newest.dropped):
        catalog.change(spark, f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(partition_of, names))}")
    spark.catalog.refreshTable(name)
    scratch.write_once(spark, f"{path}/{MANIFESTS}/{newest.version}{DONE}", "")
    return True


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Delete the folders that none of the last ``keep`` manifests names, and earlier manifests."""
    versions = manifests(spark, path)
    kept = [m for m in (manifest(spark, path, v) for v in versions[-max(keep, 1) :]) if m]
    if not kept:
        return
    named = {f"{f.version}/{n}" for m in kept for n, f in m.folders.items()}
    recent = {m.version for m in kept}
    for version in [n for n in scratch.list_names(spark, path) if n.startswith("v") and n <= kept[-1].version]:
        leaves = partition_folders(spark, f"{path}/{version}", len(kept[-1].columns))
        unnamed = [leaf for leaf in leaves if f"{version}/{leaf}" not in named]
        for leaf in [""] if len(unnamed) == len(leaves) else unnamed:
            scratch.delete(spark, f"{path}/{version}/{leaf}".rstrip("/"))
    for version in versions:
        if version not in recent:
            for ending in (".json", DONE):
                scratch.delete(spark, f"{path}/{MANIFESTS}/{version}{ending}")


def read_folders(spark: SparkSession, path: str, of: Manifest, names: Iterable[str] | None = None) -> DataFrame:
    """The rows that a manifest says, or those of some of its folders; without the catalog."""
    schema = schema_of(of)
    data = StructType([f for f in schema if f.name not in of.columns])
    by_version: dict[str, list[str]] = {}
    for n in sorted(of.folders if names is None else set(names) & set(of.folders)):
        by_version.setdefault(of.folders[n].version, []).append(n)
    frames = []
    for version, folders in by_version.items():
        root = f"{path.rstrip('/')}/{version}"
        kinds = StructType([*data.fields, *[schema[c] for c in of.columns]])
        all_of_it = set(folders) == set(partition_folders(spark, root, len(of.columns)))
        paths = [root] if all_of_it else [f"{root}/{n}" for n in folders]  # each path given is looked up by itself
        with listing_by_cores(spark):
            rows = spark.read.schema(kinds).option("basePath", root).parquet(*paths)
        frames.append(rows.select(*schema.names))
    found = spark.createDataFrame([], schema)
    for frame in frames:
        found = found.unionByName(frame)
    return found


def changes_between(spark: SparkSession, path: str, keys: Sequence[str], earlier: str, later: str | None = None) -> DataFrame:
    """(change, before, after): the rows inserted, updated and deleted from one published version to another.

    ``before`` and ``after`` are the whole rows.  Folders that are the same in both, by their digests, are not
    read.  A row that only moved to another folder is an update of its partition columns.  Keys are unique in a
    version, as a type 1 dimension's are; rows whose key is incomplete are left out.
    """
    old, new = manifest(spark, path, earlier), manifest(spark, path, later)
    if old is None or new is None:
        raise ValueError(f"{path} has no version {earlier if old is None else later}")

    def content(f: Folder | None) -> tuple | None:
        return f and (f.rows, f.digest)

    differing = [n for n in {*old.folders, *new.folders} if content(old.folders.get(n)) != content(new.folders.get(n))]
    sides = []
    for of, name in ((old, "before"), (new, "after")):
        rows = read_folders(spark, path, of, differing).dropna(subset=list(keys))
        sides.append(rows.select(*keys, F.struct(*rows.columns).alias(name)))
    before, after = F.col("before"), F.col("after")
    columns = [c for c in schema_of(new).names if c not in keys]
    change = F.when(before.isNull(), "insert").when(after.isNull(), "delete").otherwise("update")
    unequal = differs([(before[c], after[c]) for c in columns]) if columns else F.lit(False)
    joined = sides[0].join(sides[1], list(keys), "full")
    return joined.filter(before.isNull() | after.isNull() | unequal).select(change.alias("change"), "before", "after")
