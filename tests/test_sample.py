"""A small lending library with hand-derived results."""

import datetime
import json

import pytest

from tierwise.__main__ import main
from tierwise.operators.scd1 import change_class, scd1_merge
from tierwise.plans.dimension import initial_load, merge_dimension
from tierwise.plans.report import accounting, run_report
from tierwise.spec import DatasetSpec, ReportSpec, ScdSpec, SpecError

COLUMNS = ["isbn", "genre", "branch_id", "copies", "bought_on"]
MORNING = [
    ("b1", "Poetry", "N", "4", "2019-05-01"),
    ("b2", "History", "S", "7", "2020-02-11"),
    ("b3", "Travel", "N", "2", "2021-08-30"),
    ("b4", "Science", "E", "5", "2022-01-09"),  # never lent
]
EVENING = [
    ("b1", "Poetry", "N", "4", "2019-05-01"),
    ("b3", "Guide", "N", "2", "2021-08-30"),
    ("b5", "Drama", "W", "9", "2024-03-01"),  # no such branch
]
BRANCHES = "branch_id,town,visitors\nN,Aalen,120\nS,Bonn,300\nE,Celle,90\n"
LOANS = [(11, "b1", 14, "home"), (12, "b1", 3, "hall"), (13, "b2", 21, "home"), (14, "b3", 7, "home"), (15, "b2", 1, "hall"), (16, "b2", 5, "home")]
SHOWN = ["loans_table.loan_id", "loans_table.isbn", "loans_table.days", "branches_table.branch_id", "branches_table.town"]
MERGED = {"b1": "Poetry", "b2": "History", "b3": "Guide", "b4": "Science", "b5": "Drama"}


def books_text(rows):
    return "\n".join("|".join(line) for line in [COLUMNS, *rows]) + "\n"


def loans_text(rows):
    return json.dumps([dict(zip(("loan_id", "isbn", "days", "kind"), r)) for r in rows], indent=1)


def deliver(root, name, text):
    folder = root / "bronze" / name.split("_")[0]
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture
def bronze(tmp_path):
    deliver(tmp_path, "books_20240309101500.csv", books_text(MORNING))
    deliver(tmp_path, "branches_20240309110000.csv", BRANCHES)
    deliver(tmp_path, "loans_20240309120000.json", loans_text(LOANS))
    return tmp_path


def add_evening(root, stamp="20240309171500"):
    deliver(root, f"books_{stamp}.csv", books_text(EVENING))


def config(root, **output):
    def dataset(name, **more):
        paths = {"input_path": f"{root}/bronze/{name}/", "output_path": f"{root}/silver/{name}/"}
        return {**paths, "regex": rf"{name}_\d{{14}}.*", "snapshot": "latest", **more}

    on = {"left": "books", "join_type": "left"}
    return {
        "datasets": {
            "books": dataset("books", format="csv", header="true", delimiter="|"),
            "branches": dataset("branches", format="csv", header="true"),
            "loans": dataset("loans", format="json"),
        },
        "etl": {
            "join": {**on, "right": "loans", "left_key": "isbn", "right_key": "isbn"},
            "join_b": {**on, "right": "branches", "left_key": "branch_id", "right_key": "branch_id", "join_type": "inner"},
            "aggregations": {
                "copies": "sum(books_table.copies)",
                "titles": "count(distinct books_table.isbn)",
                "busiest": "max(cast(branches_table.visitors as int))",
                "days": "sum(loans_table.days)",
                "rows": "count(*)",
                "longest": "max(loans_table.days)",
            },
            "output": {
                "path": f"{root}/gold/lending/",
                "select": SHOWN,
                "date_parts": ["loans_table.year", "loans_table.month", "loans_table.day"],
                **output,
            },
        },
    }


def run(spark, root, **output):
    return run_report(spark, ReportSpec.from_dict(config(root, **output)))


# morning: b1 twice, b2 three times, b3 once, b4 without a loan; evening: b1 twice, b3 once
@pytest.mark.parametrize("evening, expected", [(False, (36.0, 4, 300, 51, 7, 21)), (True, (10.0, 2, 120, 24, 3, 14))])
def test_report(spark, bronze, evening, expected):
    if evening:
        add_evening(bronze)
    result = run(spark, bronze)
    assert tuple(result.aggregates) == pytest.approx(expected)
    assert result.report.count() == expected[4]
    days = {str(r.date_id) for r in result.report.select("date_id").collect()}
    assert days == ({"2024-03-09"} if evening else {"2024-03-09", "None"})
    assert result.report.columns == ["loan_id", "isbn", "days", "branch_id", "town", "date_id"]


def test_next_day_replaces_the_snapshot_not_the_layer(spark, bronze):
    run(spark, bronze)
    add_evening(bronze, "20240402080000")
    result = run(spark, bronze)
    assert result.aggregates.titles == 2 and result.report.count() == 3
    silver = spark.read.parquet(f"{bronze}/silver/books")
    assert sorted({(r.month, r.day) for r in silver.collect()}) == [(3, 9), (4, 2)]


def test_several_stamps_need_a_declared_snapshot(spark, bronze):
    add_evening(bronze)
    for schema in (None, ", ".join(f"{c} string" for c in COLUMNS)):
        cfg = config(bronze)
        cfg["datasets"]["books"] |= {"snapshot": None, "schema": schema}
        with pytest.raises(SpecError, match="declare 'snapshot'"):
            run_report(spark, ReportSpec.from_dict(cfg))


def test_a_report_needs_its_projection(spark, bronze):
    for missing in ("select", "date_parts"):
        with pytest.raises(SpecError, match=missing):
            run(spark, bronze, **{missing: []})


def test_run_from_a_day_replaces_later_days_only(spark, bronze):
    cfg = config(bronze, dynamic=True, drop_unmatched=True)
    cfg["datasets"]["loans"]["snapshot"] = "all"
    run_report(spark, ReportSpec.from_dict(cfg))
    deliver(bronze, "loans_20240311120000.json", loans_text([(21, "b2", 9, "home")]))
    (bronze / "gold" / "lending" / "date_id=2024-03-09" / "untouched.marker").write_text("")
    result = run_report(spark, ReportSpec.from_dict(cfg), from_day=datetime.date(2024, 3, 10))
    assert (result.aggregates.days, result.report.count()) == (9, 7)
    assert (bronze / "gold" / "lending" / "date_id=2024-03-09" / "untouched.marker").exists()
    with pytest.raises(SpecError, match="from_day"):
        run_report(spark, ReportSpec.from_dict(config(bronze)), from_day=datetime.date(2024, 3, 10))


def test_a_correction_that_empties_a_gold_day(spark, bronze):
    cfg = config(bronze, dynamic=True, drop_unmatched=True)
    cfg["datasets"]["loans"]["snapshot"] = "all"
    deliver(bronze, "loans_20240311120000.json", loans_text([(21, "b2", 9, "home")]))
    days = [str(r.date_id) for r in run_report(spark, ReportSpec.from_dict(cfg)).report.select("date_id").distinct().collect()]
    assert sorted(days) == ["2024-03-09", "2024-03-11"]
    deliver(bronze, "loans_20240311120000.json", loans_text([(21, "unknown", 9, "home")]))
    days = [str(r.date_id) for r in run_report(spark, ReportSpec.from_dict(cfg)).report.select("date_id").distinct().collect()]
    assert days == ["2024-03-09"]


def test_values_that_cannot_be_read_are_counted(spark, bronze):
    """A book without a numeric number of copies, and loans whose keys are no numbers when compared with it."""
    deliver(bronze, "books_20240309101500.csv", books_text([*MORNING, ("b9", "Prose", "N", "many", "2020-01-01")]))
    cfg = config(bronze)
    cfg["datasets"]["books"]["casts"] = {"copies": "int"}
    cfg["etl"]["join"] |= {"left_key": "copies", "right_key": "isbn"}
    found = {(r.dataset, r.column, r.used_as): r.bad_values for r in run_report(spark, ReportSpec.from_dict(cfg)).unreadable}
    assert found == {("books", "copies", "cast"): 1, ("loans", "isbn", "key"): 6}


def test_report_through_the_catalog(spark, bronze):
    """The same days as above, in a table whose folders are switched by the catalog."""
    cfg = config(bronze, dynamic=True, drop_unmatched=True, table="lending_versions", versioned=True)
    cfg["datasets"]["loans"]["snapshot"] = "all"
    deliver(bronze, "loans_20240311120000.json", loans_text([(21, "b2", 9, "home")]))

    def days():
        report = run_report(spark, ReportSpec.from_dict(cfg)).report
        assert report.count() == spark.table("lending_versions").count()
        return sorted((str(r.date_id), r["count"]) for r in report.groupBy("date_id").count().collect())

    assert days() == [("2024-03-09", 6), ("2024-03-11", 1)]
    deliver(bronze, "loans_20240311120000.json", loans_text([(21, "unknown", 9, "home")]))
    assert days() == [("2024-03-09", 6)]
    cfg["etl"]["output"] |= {"dynamic": False, "drop_unmatched": False}
    assert days() == [("2024-03-09", 6), ("None", 1)]
    spark.sql("DROP TABLE lending_versions")
    with pytest.raises(SpecError, match="versioned"):
        ReportSpec.from_dict(config(bronze, versioned=True))


def test_legacy_date_id_is_unpadded(spark, bronze):
    run(spark, bronze, legacy_date_id="true")
    assert (bronze / "gold" / "lending" / "date_id=2024-3-9").is_dir()


def test_book_without_loans_keeps_a_null_date(spark, bronze):
    padded = run(spark, bronze).report.filter("loan_id is null").collect()
    assert [(r.date_id, r.town) for r in padded] == [(None, "Celle")]
    assert run(spark, bronze, drop_unmatched=True).report.count() == 6


def test_metrics_table_and_command_line(spark, bronze):
    path = bronze / "report.json"
    path.write_text(json.dumps(config(bronze)))
    for batch in ("one", "two", "one"):
        assert main(["report", str(path), "--preview", "3", "--metrics", f"{bronze}/metrics", "--batch", batch]) == 0
    metrics = spark.read.parquet(f"{bronze}/metrics")
    assert sorted(r.run_id for r in metrics.collect()) == ["one", "two"] and "recorded_at" in metrics.columns


def test_grouped_aggregates(spark, bronze):
    cfg = config(bronze)
    cfg["etl"] |= {"group_by": ["branches_table.town"], "grouping": "rollup"}
    cfg["etl"]["aggregations"] = {"rows": "count(*)", "days": "sum(loans_table.days)"}
    result = run_report(spark, ReportSpec.from_dict(cfg))
    assert result.aggregates is None
    assert sorted(map(tuple, result.metrics.collect()), key=str) == [
        ("Aalen", 3, 24), ("Bonn", 3, 27), ("Celle", 1, None), (None, 7, 51),
    ]


def few_copies(root, **rule):
    cfg = config(root)
    cfg["datasets"]["books"] |= {
        "rules": [{"name": "few", "kind": "sql", "expression": "try_cast(copies as int) < 5", **rule}],
        "quarantine_path": f"{root}/quarantine",
        "compact": True,
    }
    return ReportSpec.from_dict(cfg)


def test_rules_in_the_report_job(spark, bronze):
    result = run_report(spark, few_copies(bronze))
    assert [tuple(r) for r in result.quality["books"].collect()] == [("few", 4, 2)]
    assert result.report.count() == 3 and result.aggregates.copies == 10.0
    assert sorted(r.isbn for r in spark.read.parquet(f"{bronze}/quarantine").collect()) == ["b2", "b4"]


def test_redelivered_days_leave_nothing_stale(spark, bronze):
    """Some rows rejected, then none, then all: silver and quarantine always hold the last delivery."""
    spec = few_copies(bronze)
    for copies, silver, rejected in (("", 2, 2), ("1", 4, 0), ("8", 0, 4), ("1", 4, 0)):
        rows = [(*r[:3], copies or r[3], r[4]) for r in MORNING]
        deliver(bronze, "books_20240309101500.csv", books_text(rows))
        if silver:
            result = run_report(spark, spec)
        else:
            with pytest.raises(Exception):  # a report without a single book
                run_report(spark, spec)
            assert not (bronze / "silver" / "books" / "year=2024" / "month=03" / "day=09").exists()
            continue
        counts = accounting(spark, {"books": result.ingested["books"]}, spec.datasets).first()
        assert (counts.rows, counts.silver, counts.quarantined) == (4, silver, rejected)


def test_silver_failure_names_its_dataset(spark, bronze):
    cfg = config(bronze)
    cfg["datasets"]["branches"] |= {
        "rules": [{"name": "boom", "kind": "sql", "expression": "raise_error('boom') is null"}],
        "quarantine_path": f"{bronze}/quarantine",
    }
    with pytest.raises(Exception, match="branches|boom"):
        run_report(spark, ReportSpec.from_dict(cfg))
    del cfg["datasets"]["branches"]["output_path"], cfg["datasets"]["branches"]["rules"]
    with pytest.raises(SpecError, match="output_path"):
        run_report(spark, ReportSpec.from_dict(cfg))


def test_missing_output_format_fails_before_any_work(spark, bronze):
    with pytest.raises(SpecError, match="classpath"):
        run(spark, bronze, format="no_such_source")
    assert not (bronze / "silver").exists()


def snapshots(spark):
    return [spark.createDataFrame(rows, COLUMNS) for rows in (EVENING, MORNING)]


@pytest.mark.parametrize("compare", ["null_safe", "hash"])
@pytest.mark.parametrize("small", [False, True])
def test_scd1_on_sample(spark, compare, small):
    source, target = snapshots(spark)
    merged = scd1_merge(source, target, ["isbn"], compare=compare, small_source=small)
    assert {r.isbn: r.genre for r in merged.collect()} == MERGED
    assert merged.columns == target.columns


def test_change_classes_on_sample(spark):
    classes = {r.isbn: r.change for r in change_class(*snapshots(spark), ["isbn"]).collect()}
    assert classes == {"b1": "unchanged", "b2": "target_only", "b3": "updated", "b4": "target_only", "b5": "new"}


def seeded(spark, root, **settings):
    add_evening(root)

    def snapshot(stamp):
        folders = f"{root}/bronze/books", f"{root}/silver/books"
        return DatasetSpec("books", *folders, delimiter="|", pattern=f"books_{stamp}.*")

    initial_load(spark, snapshot("20240309101500"), f"{root}/gold/books", snapshot("20240309171500"))
    paths = {"source_table": f"{root}/silver/books", "target_table": f"{root}/gold/books"}
    return ScdSpec.from_dict({**paths, "join_keys": ["isbn"], **settings})


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_dimension_job(spark, bronze, limit):
    spec = seeded(spark, bronze, scd_type="scd1", broadcast_limit_bytes=limit)
    assert merge_dimension(spark, spec) == 5
    gold = spark.read.parquet(spec.target_path)
    assert {r.isbn: r.genre for r in gold.collect()} == MERGED
    assert {str(r.date_id) for r in gold.collect()} == {"2024-03-09"}
    assert merge_dimension(spark, spec) == 5  # a second run changes nothing


def test_initial_load_refuses_to_replace(spark, bronze):
    seeded(spark, bronze)
    books = DatasetSpec("books", f"{bronze}/bronze/books", delimiter="|", pattern="books.*", snapshot="latest")
    with pytest.raises(Exception, match="already exists"):
        initial_load(spark, books, f"{bronze}/gold/books")


def test_type2_dimension_job(spark, bronze):
    first = seeded(spark, bronze)
    history = f"{bronze}/gold/history"
    merge_dimension(spark, ScdSpec(first.source_path, history, ("isbn",), scd_type="scd2"), datetime.date(2024, 3, 9))
    changed = spark.read.parquet(first.source_path).replace("Poetry", "Verse", subset=["genre"])
    changed.write.partitionBy("year", "month", "day").parquet(f"{bronze}/silver/next")
    spec = ScdSpec(f"{bronze}/silver/next", history, ("isbn",), scd_type="scd2")
    for _ in range(2):
        assert merge_dimension(spark, spec, datetime.date(2024, 4, 1)) == 4
    versions = spark.read.parquet(history).filter("isbn = 'b1'").orderBy("effective_from").collect()
    assert [(r.genre, str(r.effective_from), str(r.effective_to), str(r.is_current)) for r in versions] == [
        ("Poetry", "2024-03-09", "2024-04-01", "false"),
        ("Verse", "2024-04-01", "None", "true"),
    ]
