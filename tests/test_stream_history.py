"""Type 2 dimensions fed by a stream."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F
from stopping import steps_until_done

from tierwise.operators.scd2 import rebuild_history
from tierwise.plans.dimension import append_days
from tierwise.streaming.merge import StreamedHistory

T0 = datetime.datetime(2024, 2, 1)
SCHEMA = "k string, v string, at timestamp"
COLUMNS = ["k", "v", "effective_from", "effective_to", "is_current", "row_hash"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def opened(spark, root, days=2):
    return StreamedHistory(spark, f"{root}/history", f"{root}/changes", ["k"], "at", datetime.timedelta(days=days))


def found(history):
    return sorted(map(str, history.select(*COLUMNS).collect()))


def expected(spark, rows):
    dated = frame(spark, [r for r in rows if r[0] is not None and r[2] is not None]).withColumn("effective_from", F.to_date("at"))
    return found(rebuild_history(dated, ["k"], sequence_by=["at"]))


def batches_of(rng, days, size):
    """Rows in the order of their days, each up to a day and a half too late."""
    times = sorted(rng.uniform(0, days) for _ in range(size))
    rows = [(rng.choice(["1", "2", "3", "4", None]), rng.choice("ab"), T0 + datetime.timedelta(days=t)) for t in times]
    rows.sort(key=lambda r: r[2] + datetime.timedelta(days=rng.uniform(0, 1.5)))
    return [rows[i : i + size // 6 + 1] for i in range(0, size, size // 6 + 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_days_close_behind_the_watermark(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches = batches_of(rng, 14, 90)
    history = opened(spark, tmp_path)
    for n, rows in enumerate(batches):
        history.apply(frame(spark, rows), n)
        if rng.random() < 0.5:
            history.apply(frame(spark, rows), n)  # replayed
        if rng.random() < 0.7:
            history.compact()
            newest = max(r[2] for part in batches[: n + 1] for r in part)
            assert history.folded()[0] <= (newest - history.delay).date() - datetime.timedelta(days=1)
        if rng.random() < 0.5:
            opened(spark, tmp_path).apply(frame(spark, rows), n)  # replayed after its days were closed
    history.compact(everything=True)
    assert found(history.history()) == expected(spark, [r for rows in batches for r in rows])
    assert history.open_days() == {} and not os.path.exists(f"{tmp_path}/changes-late")
    rejected = spark.read.parquet(f"{tmp_path}/changes-rejected").count()
    assert rejected == sum(r[0] is None for rows in batches for r in rows)


def test_rows_of_closed_days_are_set_aside(spark, tmp_path):
    history, day = opened(spark, tmp_path, 0), lambda n: T0 + datetime.timedelta(days=n)
    history.apply(frame(spark, [("1", "a", day(0)), ("1", "b", day(1)), ("1", "c", day(3))]), 0)
    assert history.compact() == 2
    history.apply(frame(spark, [("1", "late", day(1)), ("2", "x", day(2)), ("3", "y", None)]), 1)
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/changes-late").collect()) == ["late", "x"]
    assert spark.read.parquet(f"{tmp_path}/changes-rejected").count() == 1
    assert history.compact(everything=True) == 1  # day 3; day 2 was closed before its first row came
    assert [(r.v, r.is_current) for r in history.history().orderBy("effective_from").collect()] == [("a", False), ("b", False), ("c", True)]
    with pytest.raises(ValueError, match="delivered before"):
        append_days(spark, history.path, frame(spark, [("1", "z", day(1))]).select("k", "v", F.to_date("at").alias("effective_from")), ["k"])


def test_compaction_survives_a_stop_after_any_step(spark, tmp_path):
    rows = [("1", "a", T0), ("2", "b", T0), ("1", "b", T0 + datetime.timedelta(days=1)), ("1", "c", T0 + datetime.timedelta(days=6))]
    stops = 0
    for stop, run in steps_until_done(tmp_path, every=2):
        history = opened(spark, run.root)
        history.apply(frame(spark, rows), 0)
        with run.stopping():
            history.compact()
        stops += run.stopped
        again = opened(spark, run.root)
        again.apply(frame(spark, rows), 0)
        again.apply(frame(spark, [("2", "z", T0 + datetime.timedelta(days=7))]), 1)
        again.compact(everything=True)
        assert found(again.history()) == expected(spark, [*rows, ("2", "z", T0 + datetime.timedelta(days=7))]), stop
        assert not os.path.exists(f"{run.root}/changes-late"), stop
    assert stops >= 4
