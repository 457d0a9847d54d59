import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwise.operators import joins
from tierwise.operators.joins import (
    _spread,
    hot_keys,
    join_chain,
    key_pair,
    salted_outer_join,
    unparsable_keys,
    unreadable_values,
    with_row,
)
from tierwise.spec import JoinStep, SpecError

KEYS = st.one_of(st.none(), st.integers(0, 4))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=25)


def frame(spark, rows, value):
    return with_row(spark.createDataFrame(rows, f"k int, {value} int").repartition(3), f"row_{value}")


def salted(a, b, pairs, how, parts, rows=("a.row_x", "b.row_y")):
    return salted_outer_join(a, b, pairs, how, *map(F.col, rows), parts)


@pytest.mark.parametrize("how", ["left", "right", "full"])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=ROWS, right=ROWS)
def test_salted_join_equals_plain_join(spark, how, left, right):
    a = frame(spark, left, "x").alias("a")
    b = frame(spark, right, "y").alias("b")
    pairs = [(F.col("a.k"), F.col("b.k"))]
    plain = a.join(b, pairs[0][0] == pairs[0][1], how)
    spread = salted(a, b, pairs, how, 12)
    names = ["a.k", "a.x", "b.k", "b.y"]
    rows = [sorted(map(tuple, df.select(*names).collect()), key=repr) for df in (plain, spread)]
    assert rows[0] == rows[1]


def numbered(spark, tmp_path, rows, name="row"):
    """``rows`` as a Parquet table, each with its place in the files."""
    path = str(tmp_path / name)
    rows.write.parquet(path)
    return with_row(spark.read.parquet(path), name)


def test_hot_key_is_spread_over_salts(spark, tmp_path):
    rows = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit(1).alias("y")
    )
    table = numbered(spark, tmp_path, rows)
    hot = hot_keys(table, [F.col("k")], 60)
    assert [(r["__hot_0"], r["__salts"]) for r in hot.collect()] == [(7, 21)]  # ceil(2001 / 100)
    salts = _spread(table, [F.col("k")], hot, "salt", F.col("row")).filter("k = 7").groupBy("salt").count()
    sizes = [r["count"] for r in salts.collect()]  # copies of one row spread, too
    assert len(sizes) == 21 and max(sizes) < 150
    shuffled = _spread(table.repartition(8, "k"), [F.col("k")], hot, "salt", F.col("row"))
    assert shuffled.filter("k = 7").select("salt").distinct().count() == 21
    keys = numbered(spark, tmp_path, spark.createDataFrame([(7,), (8,), (-1,)], "k long"), "other").alias("a")
    copy = table.alias("b")
    joined = salted(keys, copy, [(F.col("a.k"), F.col("b.k"))], "left", 60, ("a.other", "b.row"))
    plain = keys.join(copy, F.col("a.k") == F.col("b.k"), "left")
    assert joined.count() == plain.count() == 2003


def test_every_hot_key_counts(spark):
    rows = with_row(spark.range(60_000).select((F.col("id") % 3000).alias("k")), "row")
    hot = hot_keys(rows, [F.col("k")], 6000)
    assert hot.count() == 3000 and hot.filter("__salts = 2").count() == 3000


def test_shuffled_hot_left_side_is_split(spark, tmp_path):
    """Tasks of a right and of a full step: no task has much more than its share of the hot key."""
    rows = spark.range(0, 40_000, 1, 4).select(F.lit(7).alias("k"), F.col("id").alias("x"))
    left = numbered(spark, tmp_path, rows).repartition(8, "k").alias("a")
    right = with_row(spark.createDataFrame([(7, 1), (8, 2)], "k int, y int"), "other").alias("b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("right", "full"):
            joined = salted(left, right, [(F.col("a.k"), F.col("b.k"))], how, 32, ("a.row", "b.other"))
            tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert sum(r["count"] for r in tasks) == 40_001
            assert max(r["count"] for r in tasks) < 40_000 * 0.35
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_full_join_spreads_rows_without_a_key(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("y")
    )
    table = numbered(spark, tmp_path, rows)
    hot = hot_keys(table, [F.col("k")], 30, with_nulls=True)
    assert [(r["__hot_0"], r["__salts"]) for r in hot.collect()] == [(None, 10)]
    spread = _spread(table, [F.col("k")], hot, "salt", F.col("row"))
    assert spread.filter("k is null").select("salt").distinct().count() == 10
    a, b = table.alias("a"), table.alias("b")
    joined = salted(a, b, [(F.col("a.k"), F.col("b.k"))], "full", 30, ("a.row", "b.row"))
    assert joined.count() == 4000


def test_building_a_chain_runs_no_job(spark):
    frames = {n: spark.range(20).withColumnRenamed("id", "k") for n in "abcd"}
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    steps = [step(f"j{n}", left="a", right=n, join_type=how) for n, how in zip("bcd", ("left", "right", "full"))]
    chain = join_chain(frames, steps)
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert chain.count() == 20 and chain.columns == ["k"] * 4


def test_composite_and_mixed_type_keys(spark):
    a = spark.createDataFrame([("1", "x", 1), ("bad", "x", 2), (None, "y", 3)], "k string, g string, i int")
    b = spark.createDataFrame([(1, "x", 10), (1, "x", 11), (2, "y", 12)], "k bigint, g string, j int")
    step = JoinStep.from_dict(
        "join", {"left": "a", "right": "b", "left_key": ["k", "g"], "right_key": ["k", "g"], "join_type": "left"}
    )
    rows = join_chain({"a": a, "b": b}, [step]).select("a_table.i", "b_table.j").collect()
    assert sorted(map(tuple, rows), key=repr) == [(1, 10), (1, 11), (2, None), (3, None)]
    assert unparsable_keys(a, "k", "bigint").first().unparsable_keys == 1


def step(name, **cfg):
    return JoinStep.from_dict(name, {"left_key": "k", "right_key": "k", "join_type": "inner", **cfg})


def test_chain_rules(spark):
    a = spark.createDataFrame([(1, 2)], "k int, m int")
    frames = {"a": a, "b": a}
    with pytest.raises(SpecError, match="not part of the chain"):
        join_chain(frames, [step("j1", left="a", right="b"), step("j2", left="c", right="b", **{"as": "b2"})])
    with pytest.raises(SpecError, match="'as' name"):
        join_chain(frames, [step("j1", left="a", right="b"), step("j2", left="a", right="b")])
    with pytest.raises(SpecError, match="not available"):
        join_chain(frames, [step("j1", left="a", right="zzz")])
    with pytest.raises(SpecError, match="unknown join type"):
        step("j", left="a", right="b", join_type="sideways")
    twice = join_chain(
        frames, [step("j1", left="a", right="b"), step("j2", left="b", right="b", **{"as": "b2"})]
    )
    assert twice.select("a_table.m", "b_table.m", "b2_table.m").first() == (2, 2, 2)


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "cross", "outer", "right_outer"])
def test_join_types_pass_through(spark, how):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    joined = join_chain({"a": a, "b": b}, [step("j", left="a", right="b", join_type=how)])
    expected = {"left_semi": 1, "left_anti": 1, "cross": 1, "outer": 3, "right_outer": 2}
    assert joined.count() == expected[how]


def test_hot_key_of_mixed_types(spark):
    a = with_row(spark.createDataFrame([("7",), ("8",), ("bad",)], "k string"), "row_x").alias("a")
    b = with_row(spark.createDataFrame([(7, i) for i in range(50)], "k bigint, y int"), "row_y").alias("b")
    joined = salted(a, b, [key_pair(a, "a.k", b, "b.k")], "left", 10)
    assert joined.count() == 52 and joined.filter("b.k is null").count() == 2
    assert joined.columns == ["k", "row_x", "k", "y", "row_y"]


def test_semi_join_moves_distinct_keys_only(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1, 1)] * 9, "k int, y int")
    for how, expected in (("semi", [1]), ("anti", [None, 2])):
        joined = join_chain({"a": a, "b": b}, [step("j", left="a", right="b", join_type=how)])
        assert sorted((r.k for r in joined.collect()), key=str) == sorted(expected, key=str)
        assert "Aggregate" in str(joined._jdf.queryExecution().optimizedPlan())


def test_chain_of_salted_steps_equals_the_plain_chain(spark, monkeypatch):
    def eager(df, keys, parts, with_nulls):
        return hot_keys(df, keys, 10, with_nulls)

    monkeypatch.setattr(joins, "hot_keys", eager)
    rows = [(i % 4 if i % 5 else None, i) for i in range(30)]
    frames = {n: spark.createDataFrame(rows[: 10 + 5 * i], f"k int, {n} int") for i, n in enumerate("abcd")}
    for hows in (("left", "full", "inner"), ("right", "left", "full"), ("full", "right", "left")):
        found = []
        for skew in ("salt", "plain"):
            steps = [
                step(f"j{n}", left="a", right=n, join_type=how, skew=skew) for n, how in zip("bcd", hows)
            ]
            chain = join_chain(frames, steps).select("a_table.a", "b_table.b", "c_table.c", "d_table.d")
            found.append(chain.groupBy("a", "b", "c", "d").count())
        assert found[0].exceptAll(found[1]).count() == found[1].exceptAll(found[0]).count() == 0


def test_rows_of_a_hot_key_spread_whatever_they_come_from(spark, tmp_path):
    """Text files and aggregated frames have no row places; their rows' salts differ all the same."""
    plain = spark.range(2000).select(F.lit(7).alias("k"), F.col("id").alias("x"))
    plain.coalesce(1).write.option("header", True).csv(f"{tmp_path}/c")
    plain.coalesce(1).write.json(f"{tmp_path}/j")
    frames = [
        spark.read.option("header", True).csv(f"{tmp_path}/c"),
        spark.read.json(f"{tmp_path}/j"),
        plain.groupBy("k", "x").agg(F.count("*").alias("n"), F.map_from_arrays(F.collect_list("k"), F.collect_list("x")).alias("m")),
    ]
    for frame in frames:
        salts = with_row(frame, "row").groupBy(F.pmod("row", F.lit(16)).alias("salt")).count().collect()
        assert len(salts) == 16 and max(r["count"] for r in salts) < 250


def test_unreadable_values(spark):
    a = spark.createDataFrame([("1", "x"), ("no", "2"), (None, "3"), ("5", None)], "k string, v string")
    b = spark.createDataFrame([(1, "7")], "k bigint, w string")
    step = JoinStep.from_dict("join", {"left": "a", "right": "b", "left_key": "k", "right_key": "k", "join_type": "inner", "as": "other"})
    rows = unreadable_values({"a": a, "b": b}, [step], {"a": {"v": "int"}}).collect()
    assert sorted(map(tuple, rows)) == [("a", "k", "bigint", "key", 1), ("a", "v", "int", "cast", 1)]
    assert unreadable_values({"b": b}).count() == 0


def test_only_keys_in_buckets_of_a_hot_keys_size_are_counted_by_themselves(spark):
    rows = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 2).when(F.col("id") % 3 == 1, -F.col("id")).alias("k"), (F.col("id") % 2).alias("l")
    )
    keys = [F.col("k"), F.col("l")]
    for with_nulls, nulls in ((False, []), (True, [(None, 0, 30), (None, 1, 30)])):
        hot = hot_keys(rows, keys, 180, with_nulls)  # a share is 50 rows
        assert sorted(map(tuple, hot.collect()), key=str) == sorted([(0, 0, 30), (1, 1, 30), *nulls], key=str)
    assert hot_keys(rows.filter("l > 1"), keys, 180).count() == 0
    plan = str(hot_keys(rows, keys, 180)._jdf.queryExecution().optimizedPlan())
    assert "Aggregate [__hot_0" in plan and "LeftSemi" in plan.split("Aggregate [__hot_0")[1]
