"""Version keys of facts, and daily states."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from stopping import steps_until_done

from tierwise.operators.facts import fact_keys
from tierwise.operators.states import DailyStates

DAY0 = datetime.date(1969, 11, 1)


def day(n):
    return DAY0 + datetime.timedelta(days=n)


def versions_of(rng):
    """Key 0 changes nearly every day, the others seldom; some begin late, have gaps or end."""
    made, sk = [], 0
    for k in range(8):
        at = rng.randrange(20)
        while at < 400:
            end = at + (rng.randint(1, 2) if k == 0 else rng.randint(1, 250))
            sk += 1
            made.append((k, "x", day(at), None if end >= 400 and k != 3 else day(end), sk))
            at = end + (rng.random() < 0.2)
    return made


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_facts_against_brute_force(spark, threshold):
    rng = random.Random(4)
    versions = versions_of(rng)
    facts = [(rng.choice([0, 0, 0, *range(9), None]), "x", rng.choice([None, *map(day, range(-5, 500))]), i) for i in range(3000)]
    dimension = spark.createDataFrame([*versions, (None, "x", day(0), None, 999)], "k int, b string, effective_from date, effective_to date, sk long")
    frame = spark.createDataFrame(facts, "k int, b string, at date, i int")
    expected = {}
    for k, _, at, i in facts:
        found = [v[4] for v in versions if at and v[0] == k and v[2] <= at and (v[3] is None or at < v[3])]
        expected[i] = found[0] if found else -1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for days in (1, 7, 64):
            keyed = fact_keys(frame, dimension, ["k", "b"], F.col("at"), stretch_days=days)
            assert keyed.columns == ["k", "b", "at", "i", "sk"]
            rows = keyed.collect()
            assert len(rows) == len(facts) and {r.i: r.sk for r in rows} == expected
            plan = keyed._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert fact_keys(frame.limit(0), dimension, ["k"], F.col("at")).count() == 0
        assert {r.sk for r in fact_keys(frame, dimension.limit(0), ["k"], F.col("at"), unknown=-9).collect()} == {-9}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


STATES = DailyStates(["kind"], {"total": "cast(v as decimal(12, 2))"}, {"users": "u"})


def events(spark, n=20_000):
    i = F.col("id")
    return spark.range(n).select(
        F.date_add(F.lit("2024-03-01"), (i % 10).cast("int")).alias("at"), (i % 3).alias("kind"), (i % 700 / 4).alias("v"), (i * 7 % 9001).alias("u")
    )


def test_states_of_any_range(spark, tmp_path):
    path = f"{tmp_path}/states"
    rows = events(spark)
    STATES.replace(path, rows, F.col("at"))
    for first, last in ((None, None), (3, 7), (5, 5), (20, 30)):
        a, b = (n and datetime.date(2024, 3, n) for n in (first, last))
        inside = rows if a is None else rows.filter(F.col("at").between(a, b))
        got = {r.kind: r for r in STATES.totals(spark, path, a, b, by=["kind"]).collect()}
        exact = inside.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.expr(STATES.sums["total"])).alias("total"), F.count_distinct("u").alias("users")).collect()
        assert len(got) == len(exact)
        for r in exact:
            assert (got[r.kind].n, got[r.kind].total) == (r.n, r.total)
            assert abs(got[r.kind].users - r.users) <= max(1, 0.05 * r.users)
    totals = STATES.totals(spark, path, datetime.date(2024, 3, 5), datetime.date(2024, 3, 6))
    assert "PartitionFilters: [isnotnull" in totals._jdf.queryExecution().executedPlan().toString()
    read = STATES.totals(spark, path, datetime.date(2024, 3, 5), datetime.date(2024, 3, 6)).inputFiles()
    assert read  # states only: no detail is known to this table
    with pytest.raises(FileNotFoundError):
        STATES.totals(spark, f"{tmp_path}/none")


def test_a_day_again_survives_a_stop_after_any_step(spark, tmp_path):
    rows = events(spark, 200)
    gone, again = datetime.date(2024, 3, 4), datetime.date(2024, 3, 5)
    for stop, run in steps_until_done(tmp_path):
        path = f"{run.root}/states"
        STATES.replace(path, rows, F.col("at"))
        part = rows.filter(F.col("at") == F.lit(again)).withColumn("v", F.lit(1))
        with run.stopping():
            STATES.replace(path, part, F.col("at"), [gone, again])
        STATES.replace(path, part, F.col("at"), [gone, again])
        found = {str(r.date_id): (r.n, r.total) for r in STATES.totals(spark, path, by=["date_id"]).collect()}
        assert len(found) == 9 and found["2024-03-05"] == (20, 20) and str(gone) not in found, stop
