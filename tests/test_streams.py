"""Late data, replays and hot keys in streams."""

import datetime

from pyspark.sql import functions as F

from tierwise.streaming.windows import (
    LOCAL_SESSIONS,
    deduplicated,
    run_available,
    run_to_end,
    sessions,
    sessions_merged_locally,
    tumbling,
)

SCHEMA = "id int, ts timestamp"
START = datetime.datetime(2024, 1, 1)


def arrive(spark, folder, rows):
    frame = spark.createDataFrame([(i, START + datetime.timedelta(minutes=m)) for i, m in rows], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def counts(spark, root):
    frame = tumbling(stream(spark, f"{root}/in"), "ts", "10 minutes", "1 hour", [], {"n": F.count(F.lit(1))})
    run_available(frame, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    found = spark.read.parquet(f"{root}/out").collect()
    return {int((r.window_start - START).total_seconds() // 3600): r.n for r in found}


def test_late_rows_inside_and_beyond_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, f"{root}/in", [(1, 5), (2, 65)])  # watermark 00:55: hour 0 still open
    assert counts(spark, root) == {}
    arrive(spark, f"{root}/in", [(3, 57), (4, 125)])  # 3 is late but inside; watermark 01:55
    assert counts(spark, root) == {0: 2}
    arrive(spark, f"{root}/in", [(5, 10), (6, 200)])  # 5 belongs to a window already emitted
    assert counts(spark, root) == {0: 2, 1: 1, 2: 1}
    assert counts(spark, root) == {0: 2, 1: 1, 2: 1}  # nothing new, nothing repeated


def test_duplicates_across_batches_and_a_hot_key(spark, tmp_path):
    for spreads in (1, 16):
        root = f"{tmp_path}/{spreads}"
        arrive(spark, f"{root}/in", [(7, 1)] * 200 + [(i, 2) for i in range(100, 110)])
        for _ in range(2):
            frame = deduplicated(stream(spark, f"{root}/in"), "ts", "10 minutes", ["id"], spreads)
            run_available(frame, f"{root}/out", f"{root}/checkpoint").awaitTermination()
            found = sorted(r.id for r in spark.read.parquet(f"{root}/out").collect())
            assert found == [7, *range(100, 110)]
            arrive(spark, f"{root}/in", [(7, 3), (100, 3)])


def test_sessions_grow_across_batches(spark, tmp_path):
    root = str(tmp_path)
    before = spark.conf.get(LOCAL_SESSIONS)

    def run():
        found = sessions(
            stream(spark, f"{root}/in"), "ts", "60 minutes", "30 minutes", ["id"], {"n": F.count(F.lit(1))}
        )
        with sessions_merged_locally(spark):
            run_available(found, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        assert spark.conf.get(LOCAL_SESSIONS) == before
        rows = spark.read.parquet(f"{root}/out").collect()
        minutes = [
            (r.id, *[int((t - START).total_seconds() // 60) for t in (r.window_start, r.window_end)], r.n)
            for r in rows
        ]
        return sorted(minutes)

    arrive(spark, f"{root}/in", [(1, 0), (1, 40), (2, 5)])  # two sessions of 1 so far
    assert run() == []
    arrive(spark, f"{root}/in", [(1, 20), (3, 200)])  # joins them, late but inside the watermark
    assert run() == [(1, 0, 70, 3), (2, 5, 35, 1)]


def test_a_bounded_run_gives_open_windows_too(spark, tmp_path):
    root = str(tmp_path)

    def run():
        frame = tumbling(stream(spark, f"{root}/in"), "ts", "10 minutes", "1 hour", [], {"n": F.count(F.lit(1))})
        run_to_end(frame, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        found = spark.read.parquet(f"{root}/out").collect()
        return {int((r.window_start - START).total_seconds() // 3600): r.n for r in found}

    arrive(spark, f"{root}/in", [(1, 5), (2, 65)])
    assert run() == {0: 1, 1: 1}
    arrive(spark, f"{root}/in", [(3, 57), (4, 125)])
    assert run() == {0: 2, 1: 1, 2: 1}
    assert run() == {0: 2, 1: 1, 2: 1}
