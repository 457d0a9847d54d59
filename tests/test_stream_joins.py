"""Stream-stream join chains."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tierwise.spec import SpecError
from tierwise.streaming.joins import StreamSide, StreamStep, join_streams
from tierwise.streaming.windows import run_available

T0 = datetime.datetime(2024, 5, 1)
SCHEMA = "k string, at timestamp, i int"


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def arrivals(spark, path, rows, files):
    """Files that come in turn, each with its share of the time."""
    for n in range(files):
        part = [r for j, r in enumerate(rows) if j * files // len(rows) == n]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").option("mapreduce.output.basename", f"f{n:03}").json(path)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(path)


def generated(rng, n, minutes):
    times = sorted(rng.randrange(minutes) for _ in range(n))
    return [(rng.choice(["hot", "hot", "a", "b", "c", None]), at(t), i) for i, t in enumerate(times)]


@pytest.mark.parametrize("spreads", [1, 3])
def test_chain_gives_unmatched_rows_and_forgets(spark, tmp_path, spreads):
    rng, minutes = random.Random(2), 3000
    data = {n: generated(rng, size, minutes) for n, size in (("orders", 240), ("payments", 200), ("parcels", 150))}
    for n, rows in data.items():
        arrivals(spark, f"{tmp_path}/{n}", [*rows, ("end", at(minutes + 10_000), -1)], 7)
    sides = {n: StreamSide(stream(spark, f"{tmp_path}/{n}"), "at", "200 minutes") for n in data}
    steps = [
        StreamStep("orders", "payments", ("k",), ("k",), "left", "5 minutes", "30 minutes", spreads),
        StreamStep("orders", "parcels", ("k",), ("k",), "left", after="45 minutes", spreads=spreads),
    ]
    ids = [F.col(f"{n}_table.i").alias(n) for n in data]
    query = run_available(join_streams(sides, steps).select(*ids), f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").filter("orders >= 0").collect()), key=str)

    def partners(rows, k, t, before, after):
        return [i for key, s, i in rows if k is not None and key == k and -before <= (s - t).total_seconds() / 60 <= after] or [None]

    expected = [
        (i, p, q)
        for k, t, i in data["orders"]
        for p in partners(data["payments"], k, t, 5, 30)
        for q in partners(data["parcels"], k, t, 0, 45)
    ]
    assert got == sorted(expected, key=str) and any(p is None for _, p, _ in got)
    held = [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress]
    if spreads == 1:
        assert max(held) < 0.7 * sum(map(len, data.values())) and held[-1] <= 6  # rows of the end only


def test_steps_are_checked(spark, tmp_path):
    arrivals(spark, f"{tmp_path}/a", [("x", T0, 1)], 1)
    side = StreamSide(stream(spark, f"{tmp_path}/a"), "at", "1 minute")
    sides = {"a": side, "b": side, "c": side}
    with pytest.raises(SpecError, match="inner or left"):
        StreamStep("a", "b", ("k",), ("k",), "full")
    with pytest.raises(SpecError, match="may be padded"):
        join_streams(sides, [StreamStep("a", "b", ("k",), ("k",)), StreamStep("b", "c", ("k",), ("k",))])
    with pytest.raises(SpecError, match="not declared"):
        join_streams(sides, [StreamStep("a", "z", ("k",), ("k",))])
    with pytest.raises(SpecError, match="same number"):
        StreamStep("a", "b", ("k",), ())
    with pytest.raises(SpecError, match="already"):
        join_streams(sides, [StreamStep("a", "b", ("k",), ("k",)), StreamStep("a", "b", ("k",), ("k",))])
