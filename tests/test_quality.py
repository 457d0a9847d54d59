import datetime
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tierwise.functions.columns import malformed_counts, try_casts
from tierwise.operators.quality import not_unique, orphans, quarantine, rule_report
from tierwise.sources.keyfilters import KeyFilters, not_unique_with
from tierwise.spec import DatasetSpec, ReportSpec, Rule, ScdSpec, SpecError

RULES = [
    Rule("given", "not_null", "k"),
    Rule("plausible", "range", "n", min=0, max=10),
    Rule("known", "in_set", "c", values=("a", "b")),
    Rule("short", "regex", "c", pattern="^.$"),
    Rule("number", "type", "c", as_type="int"),
    Rule("together", "sql", expression="n < 5 OR c = 'a'"),
]
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.integers(-5, 15)),
    st.one_of(st.none(), st.sampled_from(["a", "b", "cc", "7"])),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(ROW, max_size=12))
def test_quarantine_splits_completely(spark, data):
    frame = spark.createDataFrame(data, "k int, n int, c string")
    valid, rejected = quarantine(frame, RULES)
    assert valid.count() + rejected.count() == len(data)
    report = {r.rule: (r.rows_checked, r.rows_bad) for r in rule_report(frame, RULES).collect()}
    broken = [rule for r in rejected.collect() for rule in r.failed_rules]
    assert report == {r.name: (len(data), broken.count(r.name)) for r in RULES}
    assert report["given"][1] == sum(k is None for k, _, _ in data)
    assert report["plausible"][1] == sum(n is not None and not 0 <= n <= 10 for _, n, _ in data)
    assert report["number"][1] == sum(c in ("a", "b", "cc") for _, _, c in data)


def test_keys_and_references(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert [tuple(r) for r in not_unique(child, "k").collect()] == [(1, 2)]
    assert [r.k for r in orphans(child, parent, "k", "p").collect()] == [2]


def test_malformed_text_is_counted_and_nulled(spark):
    frame = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    assert malformed_counts(frame, {"v": "int"}).first().bad_values == 1
    assert [r.v for r in try_casts(frame, {"v": "int"}).collect()] == [1, None, None]


def test_bad_descriptions_are_refused(spark):
    for bad in ({"kind": "odd"}, {"kind": "range"}, {"kind": "in_set"}, {"kind": "sql"}, {"kind": "x", "y": 1}):
        with pytest.raises(SpecError):
            Rule.from_dict({"name": "r", "column": "c", **bad})
    with pytest.raises(SpecError, match="quarantine_path"):
        DatasetSpec("d", "/x", rules=(Rule("r", "not_null", "c"),))
    with pytest.raises(SpecError, match="regex"):
        DatasetSpec("d", "/x", pattern="(")
    with pytest.raises(SpecError, match="snapshot|latest"):
        DatasetSpec("d", "/x", snapshot="newest")
    with pytest.raises(SpecError, match="scd3"):
        ScdSpec.from_dict({"source_table": "s", "target_table": "t", "join_keys": ["k"], "scd_type": "scd3"})
    with pytest.raises(SpecError, match="join_keys"):
        ScdSpec.from_dict({"source_table": "s", "target_table": "t", "join_keys": []})
    with pytest.raises(SpecError, match="not declared"):
        ReportSpec.from_dict(
            {
                "datasets": {},
                "etl": {
                    "join": {
                        "left": "a", "right": "b", "left_key": "k", "right_key": "k", "join_type": "left"
                    },
                    "output": {"path": "/x"},
                },
            }
        )
    assert Rule.from_dict({"name": "r", "kind": "in_set", "column": "c", "values": ["a"]}).values == ("a",)


@pytest.mark.parametrize("log_bits", [6, 22])
def test_uniqueness_of_random_deliveries(spark, tmp_path, log_bits):
    """Equal to the full check, however small the filters; with room in them, days without a common key are not read."""
    rng = random.Random(log_bits)
    filters = KeyFilters(spark, f"{tmp_path}/filters", ["k", "l"], log_bits, 4)
    day, held = F.make_date(F.lit(2024), F.lit(1), "d"), {}
    for n, d in enumerate([1, 2, 3, 4, 2]):
        rows = [(rng.choice([None, *range(40 * d, 40 * d + 60)]), rng.choice("xy")) for _ in range(60)]
        frame = spark.createDataFrame(rows, "k int, l string")
        layer = spark.read.parquet(f"{tmp_path}/silver") if n else None
        found = not_unique_with(frame, datetime.date(2024, 1, d), layer, day, filters)
        held[d] = rows
        everything = Counter(r for day_rows in held.values() for r in day_rows if r[0] is not None)
        assert sorted(map(tuple, found.collect())) == sorted((*r, everything[r]) for r in set(rows) if everything[r] > 1)
        if log_bits == 22 and n:
            share = {other for other in held if other != d and set(held[other]) & set(rows) - {(None, "x"), (None, "y")}}
            assert {x.day for x in filters.suspected(frame, but=[datetime.date(2024, 1, d)])} == share
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert any("make_date" in part.split("]")[0] for part in plan.split("PartitionFilters: ")[1:]) == bool(share)
        frame.withColumn("d", F.lit(d)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(f"{tmp_path}/silver")
        filters.record(frame, datetime.date(2024, 1, d))
