"""Tables published through the catalog, folder by folder."""

import datetime
import os
import threading

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from stopping import steps_until_done

from tierwise import scratch
from tierwise.parallel import LISTING
from tierwise.plans.dimension import merge_dimension
from tierwise.sinks import versions
from tierwise.sinks.publish import NO_VALUE
from tierwise.sinks.versions import MANIFESTS, changes_between, manifest, manifests, publish_folders, read_folders, roll_forward
from tierwise.sources import catalog
from tierwise.spec import ScdSpec, SpecError
from tierwise.streaming.merge import StreamedDimension

SCHEMA = "k string, v string, day date, part string"
COLUMNS = ["day", "part"]


def frame(spark, rows):
    day = {n: datetime.date(2024, 1, n) for n in range(1, 9)}
    return spark.createDataFrame([(k, v, day.get(d), p) for k, v, d, p in rows], SCHEMA)


def rows(df):
    return sorted(((r.k, r.v, r.day and r.day.day, r.part) for r in df.collect()), key=str)


FIRST = [("1", "a", 1, "x"), ("2", "b", 2, "it's=a/b"), ("3", "c", 2, "x"), ("4", "d", None, None), (None, "e", 3, "x")]


@pytest.fixture
def table(spark):
    name = "published_t"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_whole_and_by_folder(spark, tmp_path, table):
    path = f"{tmp_path}/t"
    assert publish_folders(spark, frame(spark, FIRST), table, path, COLUMNS) == 5
    assert rows(spark.table(table)) == sorted(FIRST, key=str)
    files = {f for _, _, fs in os.walk(path) for f in fs}
    more = frame(spark, [("3", "C", 2, "x"), ("5", "n", 4, None)])
    gone = ["day=2024-01-01/part=x", "day=2024-01-08/part=x"]
    assert publish_folders(spark, more, table, path, COLUMNS, whole=False, emptied=gone) == 5
    expected = [FIRST[1], ("3", "C", 2, "x"), FIRST[3], FIRST[4], ("5", "n", 4, None)]
    assert rows(spark.table(table)) == sorted(expected, key=str)
    assert files <= {f for _, _, fs in os.walk(path) for f in fs}  # nothing published was moved or replaced
    earlier, later = manifests(spark, path)
    assert manifest(spark, path).dropped == (gone[0],)
    assert rows(read_folders(spark, path, manifest(spark, path, earlier))) == sorted(FIRST, key=str)
    grown = spark.table(table).union(frame(spark, [("6", "f", 5, "x")]))
    assert publish_folders(spark, grown, table, path, COLUMNS) == 6  # reads the table itself
    newest = manifest(spark, path)
    assert len(newest.changed) == 1  # of the other folders the content is what it was
    assert newest.folders["day=2024-01-02/part=x"].version == later
    assert f"day={NO_VALUE}/part={NO_VALUE}" in newest.folders
    with pytest.raises(ValueError, match="its columns"):
        publish_folders(spark, grown.drop("v"), table, path, COLUMNS)


def test_old_versions_go(spark, tmp_path, table):
    path = f"{tmp_path}/t"
    publish_folders(spark, frame(spark, FIRST), table, path, COLUMNS)
    for n in range(4):
        publish_folders(spark, frame(spark, [("3", f"c{n}", 2, "x")]), table, path, COLUMNS, whole=False)
        assert spark.table(table).count() == 5
    kept = manifests(spark, path)
    assert len(kept) == 2
    left = sorted(n for n in os.listdir(path) if n.startswith("v"))
    assert left[1:] == kept  # and the first, of which other folders are in use
    assert not os.path.exists(f"{path}/{left[0]}/day=2024-01-02/part=x")
    assert rows(read_folders(spark, path, manifest(spark, path, kept[0])))[2] == ("3", "c2", 2, "x")


def test_publish_survives_a_stop_after_any_step(spark, tmp_path):
    change = [("1", "z", 1, "x"), ("9", "n", 4, "x")]
    gone = ["day=2024-01-03/part=x"]
    after = sorted([*change, *FIRST[1:4]], key=str)
    stops = 0
    for stop, run in steps_until_done(tmp_path):
        name, path = f"stopped_{stop}", f"{run.root}/t"
        publish_folders(spark, frame(spark, FIRST), name, path, COLUMNS)
        with run.stopping():
            publish_folders(spark, frame(spark, change), name, path, COLUMNS, whole=False, emptied=gone, keep=1)
        stops += run.stopped
        published = len(manifests(spark, path)) > 1 or not run.stopped or manifest(spark, path).dropped != ()
        roll_forward(spark, name, path)
        assert rows(spark.table(name)) == (after if published else sorted(FIRST, key=str)), stop
        publish_folders(spark, frame(spark, change), name, path, COLUMNS, whole=False, emptied=gone, keep=1)
        assert rows(spark.table(name)) == after, stop
        spark.sql(f"DROP TABLE {name}")
    assert stops >= 5


def test_half_written_manifest_counts_for_nothing(spark, tmp_path, table):
    path = f"{tmp_path}/t"
    publish_folders(spark, frame(spark, FIRST), table, path, COLUMNS)
    scratch.write_once(spark, f"{path}/{MANIFESTS}/v9999.json", manifest(spark, path).text()[:40])
    assert not roll_forward(spark, table, path)
    assert spark.table(table).count() == 5
    spark.sql(f"DROP TABLE {table}")  # a catalog that was lost is made from the manifest
    assert roll_forward(spark, table, path) and spark.table(table).count() == 5
    spark.sql("CREATE TABLE other_t (k string) USING parquet")
    with pytest.raises(ValueError, match="not published by folders"):
        publish_folders(spark, frame(spark, FIRST), "other_t", f"{tmp_path}/o", COLUMNS)
    spark.sql("DROP TABLE other_t")


def test_changes_read_differing_folders_only(spark, tmp_path, table):
    path = f"{tmp_path}/t"
    publish_folders(spark, frame(spark, FIRST), table, path, COLUMNS)
    after = [FIRST[0], ("2", "b", 4, "x"), ("3", None, 2, "x"), FIRST[4], ("7", "n", 3, "x")]
    publish_folders(spark, frame(spark, after), table, path, COLUMNS)
    earlier, later = manifests(spark, path)
    found = changes_between(spark, path, ["k"], earlier, later)
    got = sorted((r.change, (r.before or r.after).k, r.before and r.before.v, r.after and r.after.v) for r in found.collect())
    assert got == [("delete", "4", "d", None), ("insert", "7", None, "n"), ("update", "2", "b", "b"), ("update", "3", "c", None)]
    assert not [f for f in found.inputFiles() if "day=2024-01-01" in f]
    assert changes_between(spark, path, ["k"], later, later).count() == 0
    with pytest.raises(ValueError, match="no version"):
        changes_between(spark, path, ["k"], "v0", later)


def silver(spark, path, values, day):
    frame = spark.createDataFrame(values, "k string, v string")
    frame.withColumns({"filename": F.lit(f"things_{day}060606.csv"), "year": F.lit(2024), "month": F.lit(1), "day": F.lit(1)}).write.parquet(path)
    return path


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_dimension_job_through_the_catalog(spark, tmp_path, table, limit):
    """A small batch replaces few folders, a large one all; the source row of a new key comes with its own day."""
    gold = f"{tmp_path}/gold"
    days = F.date_add(F.lit("2024-01-01"), (F.col("id") / 10).cast("int")).alias("date_id")
    target = spark.range(60).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("v"), days)
    publish_folders(spark, target, table, gold, ["date_id"])
    source = silver(spark, f"{tmp_path}/s", [("3", "new"), ("900", "new")], "20240102")
    spec = ScdSpec(source, gold, ("k",), table=table, versioned=True, broadcast_limit_bytes=limit)
    for _ in range(2):
        assert merge_dimension(spark, spec) == 61
        found = {r.k: (r.v, str(r.date_id)) for r in spark.table(table).collect()}
        assert len(found) == 61 and found["3"] == found["900"] == ("new", "2024-01-02") and found["4"] == ("t", "2024-01-01")
    assert len(manifest(spark, gold).folders) == 6
    with pytest.raises(SpecError, match="versioned"):
        ScdSpec(source, gold, ("k",), versioned=True)


def test_streamed_dimension_in_a_table(spark, tmp_path, table):
    path = f"{tmp_path}/base"
    publish_folders(spark, frame(spark, FIRST[:3]), table, path, COLUMNS)

    def opened():
        return StreamedDimension(spark, path, f"{tmp_path}/changes", ["k"], table=table, partition_by=COLUMNS)

    opened().apply(frame(spark, [("2", "B", 2, "x"), ("8", "n", 5, "x")]), 0)
    expected = [("1", "a", 1, "x"), ("2", "B", 2, "x"), ("3", "c", 2, "x"), ("8", "n", 5, "x")]
    assert rows(opened().snapshot()) == expected
    assert opened().compact() == 4
    assert rows(spark.table(table)) == expected and opened().folded() == 0 and opened().batches() == []


def test_many_folders_are_moved_and_dropped_side_by_side(spark, tmp_path, table, monkeypatch):
    """Two threads meet in the catalog; what is dropped goes in few statements."""
    path, made, meet = f"{tmp_path}/t", [], threading.Barrier(2, timeout=20)
    real = catalog.change

    def change(session, statement):
        made.append(statement)
        if " SET " in statement and sum(" SET " in s for s in made) <= 2:
            meet.wait()
        real(session, statement)

    first = [(str(n), "a", n, "x") for n in range(1, 8)]
    publish_folders(spark, frame(spark, first), table, path, COLUMNS)
    monkeypatch.setattr(catalog, "change", change)
    monkeypatch.setattr(versions, "TOGETHER", 2)
    after = [(str(n), "b", n, "x") for n in range(1, 5)]
    publish_folders(spark, frame(spark, after), table, path, COLUMNS)
    assert rows(spark.table(table)) == after
    assert sum(" SET " in s for s in made) == 4 and sum(" DROP " in s for s in made) == 2


def test_folders_of_a_version_are_listed_from_its_root_in_few_tasks(spark, tmp_path, table, monkeypatch):
    path, looked_up = f"{tmp_path}/t", []
    real = DataFrameReader.parquet

    def parquet(self, *paths, **options):
        looked_up.append((len(paths), int(spark.conf.get(LISTING))))
        return real(self, *paths, **options)

    monkeypatch.setattr(DataFrameReader, "parquet", parquet)
    before = spark.conf.get(LISTING)
    publish_folders(spark, frame(spark, FIRST), table, path, COLUMNS)
    whole = manifest(spark, path)
    assert rows(read_folders(spark, path, whole)) == sorted(FIRST, key=str)
    some = sorted(whole.folders)[:2]
    assert rows(read_folders(spark, path, whole, some)) == FIRST[:2]
    assert [paths for paths, _ in looked_up] == [1, 1, 2]  # the digests, all folders, two of them
    assert all(tasks < 10_000 for _, tasks in looked_up) and spark.conf.get(LISTING) == before
