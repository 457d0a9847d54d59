import time

import pytest
from pyspark.sql import functions as F

from tierwise.plans.incremental import ingest_new
from tierwise.plans.report import publish_silver
from tierwise.sources.files import feed_files, ingest, ingest_all, list_files, read_layer
from tierwise.sources.ledger import Claims, FileLedger
from tierwise.spec import DatasetSpec, Rule, SpecError
from tierwise.streaming.ingest import feed_stream, stream_to_silver
from workload.tables import drop_feed

SCHEMA = "id string, v string"


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    (folder / "things_20240101060606.csv").write_text("id,v\n1,a\n2,b\n")
    (folder / "things_20240102080808.csv").write_text("id,v\n3,c\n")
    (folder / "things_20240103080808").write_text("id,v\n4,d\n")  # no extension: no date
    (folder / "other_20240104080808.csv").write_text("x;y\n9;9\n")
    return folder


def spec(feed, **settings):
    settings.setdefault("pattern", r"things_\d{14}.*")
    settings.setdefault("snapshot", "latest")
    return DatasetSpec("things", str(feed), **settings)


def plan_of(frame):
    return str(frame._jdf.queryExecution().optimizedPlan()).lower()


@pytest.mark.parametrize("schema", [None, SCHEMA])
def test_no_pattern_is_matched_for_each_row_of_a_folder_of_one_feed(spark, tmp_path, schema):
    for day in "12":
        (tmp_path / f"things_2024010{day}060606.csv").write_text(f"id,v\n{day},a\n")
    things = spec(tmp_path, schema=schema, snapshot="all", pattern="things")
    frame = ingest(spark, things).frame
    assert "regexp" not in plan_of(frame) and "rlike" not in plan_of(frame)
    name = "things_2024010{}060606.csv"
    assert sorted(map(tuple, frame.collect())) == [(d, "a", "2024", "01", f"0{d}", name.format(d)) for d in "12"]

    def days():
        return sorted((r.id, r.day) for r in ingest(spark, things).frame.collect())

    (tmp_path / "things_1_20240103060606.csv").write_text("id,v\n3,a\n")  # a stamp at another place
    assert days() == [(d, f"0{d}") for d in "123"]
    (tmp_path / "things_20240104060606_20240105060606.x.csv").write_text("id,v\n5,a\n")  # the last stamp counts
    (tmp_path / "things x%20_20240106060606.csv").write_text("id,v\n6,a\n")  # Spark encodes this name
    assert days() == [(d, f"0{d}") for d in "12356"]
    (tmp_path / "others_20240107060606.csv").write_text("x;y\n9;9\n")
    assert days() == [(d, f"0{d}") for d in "12356"]


@pytest.mark.parametrize("schema", [None, SCHEMA])
def test_snapshots_and_file_columns(spark, feed, schema):
    latest = ingest(spark, spec(feed, schema=schema)).frame
    assert [tuple(r) for r in latest.collect()] == [
        ("3", "c", "2024", "01", "02", "things_20240102080808.csv")
    ]
    assert latest.columns == ["id", "v", "year", "month", "day", "filename"]
    everything = ingest(spark, spec(feed, schema=schema, snapshot="all")).frame
    assert sorted(r.id for r in everything.collect()) == ["1", "2", "3"]


def test_undated_files_are_rejected_not_lost(spark, feed):
    result = ingest(spark, spec(feed))
    assert [r.file_name for r in result.rejected.collect()] == ["things_20240103080808"]


@pytest.mark.parametrize("schema", [None, SCHEMA])
def test_impossible_dates_and_double_stamps(spark, feed, schema):
    (feed / "things_20241399060606.csv").write_text("id,v\n6,x\n")
    (feed / "things_20230101060606.old_20240103070707.csv").write_text("id,v\n7,y\n")
    result = ingest(spark, spec(feed, schema=schema))
    assert [(r.id, r.day) for r in result.frame.collect()] == [("7", "03")]
    assert {r.file_name[7:15] for r in result.rejected.collect()} == {"20241399", "20240103"}
    every = ingest(spark, spec(feed, schema=schema, snapshot="all")).frame
    assert sorted(r.id for r in every.collect()) == ["1", "2", "3", "7"]


def test_file_columns_replace_columns_of_the_feed(spark, tmp_path):
    (tmp_path / "things_20240102080808.csv").write_text("id,year\n1,1999\n")
    frame = ingest(spark, spec(tmp_path)).frame
    assert [(r.id, r.year) for r in frame.collect()] == [("1", "2024")]


def test_listing_reads_names_only(spark, feed):
    plan = list_files(spark, str(feed))._jdf.queryExecution().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert feed_files(spark, spec(feed)).count() == 3


def test_declared_schema_prunes_files_at_planning(spark, tmp_path):
    good = spark.range(3).select(F.col("id").cast("string").alias("id"))
    drop_feed(good, f"{tmp_path}/bronze", "things", "20240102080808", "parquet")
    for name in ("things_20240101060606.parquet", "other_20240103080808.parquet"):
        (tmp_path / "bronze" / name).write_text("not a parquet file at all")
    things = DatasetSpec(
        "things", f"{tmp_path}/bronze", format="parquet", pattern=r"things_\d{14}.*", schema="id string", snapshot="latest"
    )
    assert ingest(spark, things).frame.count() == 3  # older and foreign files are never opened


def test_pattern_is_anchored_at_the_start(spark, feed):
    assert feed_files(spark, spec(feed, pattern="20240101")).count() == 0
    assert feed_files(spark, spec(feed, pattern="things|other")).count() == 4


def test_status_of_datasets(spark, feed, tmp_path):
    (tmp_path / "empty").mkdir()
    specs = [
        spec(feed),
        DatasetSpec("strange", str(feed), format="xyz"),
        DatasetSpec("nothing", str(tmp_path / "empty")),
        DatasetSpec("absent", str(tmp_path / "absent")),
    ]
    results = ingest_all(spark, specs)
    assert [r.status for r in results.values()] == ["read", "unsupported_format", "no_files", "no_files"]
    with pytest.raises(SpecError, match="required dataset absent"):
        ingest(spark, DatasetSpec("absent", str(tmp_path / "absent"), required=True))


def test_files_with_other_columns_fail_loudly(spark, feed):
    (feed / "things_20240105080808.csv").write_text("v,id\nz,7\n")
    frame = ingest(spark, spec(feed, snapshot="all")).frame
    with pytest.raises(Exception, match="(?i)header"):
        frame.collect()


def test_a_declared_schema_does_not_rename_columns(spark, tmp_path):
    (tmp_path / "things_20240105080808.csv").write_text("v,id\nz,7\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest(spark, spec(tmp_path, schema=SCHEMA)).frame.collect()


def test_ledger_remembers_files(spark, feed, tmp_path):
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    things = spec(feed)
    todo = ledger.unprocessed(feed_files(spark, things).filter("dated"), "things")
    assert todo.count() == 2
    ledger.record(todo.filter("stamp < '20240102'"), "things", "b1")
    ledger.record(feed_files(spark, things).filter("stamp < '20240102'"), "things", "b1")  # retried batch
    assert ledger.read().count() == 1
    rest = ledger.unprocessed(feed_files(spark, things).filter("dated"), "things")
    assert [r.file_name for r in rest.collect()] == ["things_20240102080808.csv"]
    assert ledger.unprocessed(feed_files(spark, things).filter("dated"), "elsewhere").count() == 2


def test_stream_takes_each_file_once(spark, feed, tmp_path):
    things = spec(feed, schema=SCHEMA, output_path=str(tmp_path / "silver"))
    for _ in range(2):
        stream_to_silver(spark, things, str(tmp_path / "checkpoint"), max_files=1).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(things.output_path).collect()) == ["1", "2", "3"]
    (feed / "things_20240106080808.csv").write_text("id,v\n5,e\n")
    stream_to_silver(spark, things, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(things.output_path).collect()) == ["1", "2", "3", "5"]
    with pytest.raises(SpecError, match="declared schema"):
        feed_stream(spark, spec(feed))


def test_stream_and_batch_share_silver_and_rules(spark, feed, tmp_path):
    rule = Rule("not_c", "sql", expression="v <> 'c'")
    folders = {"output_path": str(tmp_path / "silver"), "quarantine_path": str(tmp_path / "rejected")}
    things = spec(feed, schema=SCHEMA, snapshot="all", rules=(rule,), **folders)

    def ids(path):
        return sorted(r.id for r in read_layer(spark, path).collect())

    stream_to_silver(spark, things, str(tmp_path / "checkpoint")).awaitTermination()
    assert ids(things.output_path) == ["1", "2"] and ids(things.quarantine_path) == ["3"]
    (feed / "things_20240107080808.csv").write_text("id,v\n6,f\n")
    publish_silver(spark, {"things": ingest(spark, things).frame}, {"things": things})
    assert ids(things.output_path) == ["1", "2", "6"]
    (feed / "things_20240107090808.csv").write_text("id,v\n7,c\n8,g\n")
    stream_to_silver(spark, things, str(tmp_path / "checkpoint")).awaitTermination()
    assert ids(things.output_path) == ["1", "2", "6", "8"] and ids(things.quarantine_path) == ["3", "7"]


def test_incremental_ingest_repeats_safely(spark, feed, tmp_path, monkeypatch):
    things = spec(feed, schema=SCHEMA, output_path=str(tmp_path / "silver"))
    ledger = FileLedger(spark, str(tmp_path / "ledger"))

    def silver():
        return sorted(r.id for r in spark.read.parquet(things.output_path).collect())

    real = FileLedger.record
    monkeypatch.setattr(FileLedger, "record", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        ingest_new(spark, things, ledger, "b1")
    monkeypatch.setattr(FileLedger, "record", real)
    assert ingest_new(spark, things, ledger, "b1") == 2 and silver() == ["1", "2", "3"]
    assert ingest_new(spark, things, ledger, "b2") == 0
    (feed / "things_20240102090909.csv").write_text("id,v\n8,h\n")  # a second file of a known day
    assert ingest_new(spark, things, ledger, "b3") == 1 and silver() == ["1", "2", "3", "8"]


def test_runs_side_by_side_and_one_that_dies(spark, feed, tmp_path, monkeypatch):
    """Every file is published by one run, whichever comes when; a dead run's days wait until its claim is old."""
    from tierwise.plans import incremental

    things = spec(feed, schema=SCHEMA, output_path=str(tmp_path / "silver"))
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    now, read, real = [0.0], [], incremental.publish_days

    def run(owner, inside=None):
        def publish(spark, spec, listing, mine):
            if inside:
                inside()
            real(spark, spec, listing, mine)
            read.extend((owner, r.file_name) for r in mine.collect())

        with monkeypatch.context() as patched:
            patched.setattr(incremental, "publish_days", publish)
            claims = Claims(spark, str(tmp_path / "claims"), owner, 100, lambda: time.time() + now[0])
            return ingest_new(spark, things, ledger, owner, claims)

    def dies():
        raise OSError("lost")

    def meanwhile():
        (feed / "things_20240109080808.csv").write_text("id,v\n9,i\n")
        assert run("b") == 1  # the new day; the others are being worked on

    assert run("a", meanwhile) == 2
    assert sorted(read) == [("a", "things_20240101060606.csv"), ("a", "things_20240102080808.csv"), ("b", "things_20240109080808.csv")]
    (feed / "things_20240102090909.csv").write_text("id,v\n8,h\n")
    (feed / "things_20240103090909.csv").write_text("id,v\n7,h\n")
    with pytest.raises(OSError, match="lost"):
        run("c", dies)
    assert run("d") == 0 and len(read) == 3
    now[0] = 200.0
    assert run("e") == 2 and sorted(read[3:]) == [("e", "things_20240102090909.csv"), ("e", "things_20240103090909.csv")]
    assert run("f") == 0
    assert sorted(r.id for r in spark.read.parquet(things.output_path).collect()) == ["1", "2", "3", "7", "8", "9"]


def test_claims(spark, tmp_path):
    now = [0.0]
    a, b = (Claims(spark, str(tmp_path / "claims"), n, 100, lambda: time.time() + now[0]) for n in "ab")
    assert a.claim(["d1", "d2"]) == ["d1", "d2"] and b.claim(["d2", "d3"]) == ["d3"]
    assert a.claim(["d1", "d3"]) == ["d1"] and a.holds("d1") and not b.holds("d1")
    a.release(["d1", "d3"])  # the latter is not its own
    assert b.claim(["d1"]) == ["d1"] and not a.holds("d1") and b.holds("d3")
    now[0] = 150.0
    assert not a.holds("d2") and b.claim(["d2"]) == ["d2"]
    now[0] = 0.0
    assert not a.holds("d2")  # taken over


@pytest.mark.parametrize(
    "fmt, text, options, expected",
    [
        ("text", "hello\nworld\n", {}, ["hello", "world"]),
        ("xml", "<a><r><v>x</v></r><r><v>y</v></r></a>", {"rowTag": "r"}, ["x", "y"]),
        ("json", '{"v": "p"}\n{"v": "q"}\n', {}, ["p", "q"]),
    ],
)
def test_further_formats(spark, tmp_path, fmt, text, options, expected):
    (tmp_path / f"things_20240101060606.{fmt}").write_text(text)
    things = DatasetSpec("things", str(tmp_path), format=fmt, multiline=False, options=options)
    frame = ingest(spark, things).frame
    assert sorted(r[0] for r in frame.collect()) == expected
    assert frame.first().day == "01"


def test_rules_send_rows_to_quarantine(spark, feed, tmp_path):
    things = DatasetSpec.from_dict(
        "things",
        {
            "input_path": str(feed),
            "output_path": str(tmp_path / "silver"),
            "regex": r"things_\d{14}.*",
            "snapshot": "all",
            "rules": [{"name": "known", "kind": "in_set", "column": "v", "values": ["a", "c"]}],
            "quarantine_path": str(tmp_path / "rejected"),
            "table": "silver_things",
        },
    )
    publish_silver(spark, {"things": ingest(spark, things).frame}, {"things": things})
    assert sorted(r.id for r in spark.table("silver_things").collect()) == ["1", "3"]
    rejected = spark.read.parquet(str(tmp_path / "rejected")).collect()
    assert [(r.id, r.failed_rules) for r in rejected] == [("2", ["known"])]
    spark.sql("DROP TABLE silver_things")
