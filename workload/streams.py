"""Queries that run as Structured Streaming jobs over everything available, then stop."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.scratch import make_parents, work_dir
from tierwise.streaming.ingest import stream_to_silver
from tierwise.streaming.joins import StreamSide, StreamStep, join_streams
from tierwise.streaming.merge import StreamedDimension, StreamedHistory
from tierwise.streaming.windows import (
    deduplicated,
    run_available,
    run_to_end,
    sessions,
    sessions_merged_locally,
    sliding,
    tumbling,
)
from tierwise.sources.files import read_layer
from tierwise.spec import DatasetSpec
from workload.merges import KEY, SQL_HASH, SQL_MERGED
from workload.registry import query
from workload.tables import EARLY, LATE, drop_feed, profiles, table, table_stream

DELAY = "10 minutes"


def measures() -> dict:
    return {"n": F.count(F.lit(1)), "total": F.round(F.sum("value"), 2)}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events stream; watermarks need an instant, so ``ts`` is read as the session zone's time,
    in which ``_local_times`` gives it back.

    Windows begin on full hours of UTC: in a zone with half hours they would not on the clock's, so
    the time is moved by the zone's offset first.
    """
    utc = F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z")))
    return table_stream(spark, sf_dir, "events").withColumn("ts", utc)


def _finished(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    root = work_dir(spark, label)
    run_available(frame, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _all_windows(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    root = work_dir(spark, label)
    run_to_end(frame, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    utc = {
        c: F.to_timestamp_ntz(F.to_utc_timestamp(F.col(c), F.current_timezone()).cast("string"))
        for c in ("window_start", "window_end")
    }
    return spark.read.parquet(f"{root}/out").withColumns(utc)


@query(
    "stream_tumbling",
    """select date_trunc('hour', ts) window_start, date_trunc('hour', ts) + interval 1 hour
    window_end, event_type, count(*) n, round(sum(value), 2) total from events group by 1, 2, 3""",
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tumbling(events(spark, sf_dir), "ts", DELAY, "1 hour", ["event_type"], measures())
    return _all_windows(spark, counts, "tumbling")


@query(
    "stream_sliding",
    """select s window_start, s + interval 1 hour window_end, count(*) n,
    round(sum(value), 2) total from (select value, unnest([time_bucket(interval 30 minutes, ts),
    time_bucket(interval 30 minutes, ts) - interval 30 minutes]) s from events) group by 1, 2""",
)
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sliding(events(spark, sf_dir), "ts", DELAY, "1 hour", "30 minutes", [], measures())
    return _all_windows(spark, counts, "sliding")


@query(
    "stream_session",
    """select user_id, min(ts) window_start, max(ts) + interval 6 hours window_end, count(*) n,
    round(sum(value), 2) total from (select *, sum(fresh) over (partition by user_id order by ts, event_id
      rows unbounded preceding) s from (select *, case when ts - lag(ts) over (partition by user_id
      order by ts, event_id) < interval 6 hours then 0 else 1 end fresh from events)) group by user_id, s""",
)
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = sessions(events(spark, sf_dir), "ts", DELAY, "6 hours", ["user_id"], measures())
    with sessions_merged_locally(spark):
        return _all_windows(spark, visits, "session")


@query("stream_dedup", "select event_id, user_id, event_type, value from events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    twice = events(spark, sf_dir).union(events(spark, sf_dir))
    once = deduplicated(twice, "ts", DELAY, ["event_id"])
    return _finished(spark, once.select("event_id", "user_id", "event_type", "value"), "dedup")


@query(
    "stream_ingest",
    """select event_id, user_id, event_type, value, 2024 as "year", 1 as "month",
    case when ts < timestamp '2024-01-15' then 1 else 2 end as "day" from events""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feed deliveries; the stream runs after each and once more with nothing new."""
    root = work_dir(spark, "feed")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    spec = DatasetSpec(
        "events",
        f"{root}/bronze",
        f"{root}/silver",
        pattern=r"events_\d{14}.*",
        schema="event_id bigint, user_id bigint, event_type string, value double",
    )
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part, stamp in ((rows.filter(early), EARLY), (rows.filter(~early), LATE)):
        drop_feed(part.drop("ts"), spec.input_path, "events", stamp, "csv", header=True)
        stream_to_silver(spark, spec, f"{root}/checkpoint").awaitTermination()
    stream_to_silver(spark, spec, f"{root}/checkpoint").awaitTermination()
    return read_layer(spark, spec.output_path).drop("filename")


@query("stream_scd1", SQL_MERGED)
def stream_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later snapshot arrives as a file stream and is merged into the earlier one."""
    source, target = profiles(spark, sf_dir)
    root = work_dir(spark, "streamed")
    target.write.parquet(f"{root}/base")
    source.write.parquet(f"{root}/arrivals")
    dimension = StreamedDimension(spark, f"{root}/base", f"{root}/changes", KEY, ["as_of"])
    arrivals = spark.readStream.schema(source.schema).parquet(f"{root}/arrivals")
    dimension.start(arrivals, f"{root}/checkpoint").awaitTermination()
    dimension.compact()
    return dimension.base()


@query(
    "stream_join",
    """select c.event_id, v.event_id view_id, p.event_id purchase_id
    from events c left join events v on v.event_type = 'view' and v.user_id = c.user_id
        and v.ts between c.ts and c.ts + interval 2 hours
      left join events p on p.event_type = 'purchase' and p.user_id = c.user_id
        and p.ts between c.ts - interval 1 hour and c.ts + interval 3 hours
    where c.event_type = 'click'""",
)
def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click with its user's views and purchases around it, or none; three streams, joined in a chain.

    A last row of each stream, long after all others, lets the watermark pass them.
    """
    root = work_dir(spark, "join")
    last = table(spark, sf_dir, "events").agg(F.max("ts").alias("ts"))
    end = last.select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    end.write.parquet(f"{root}/end")
    marker = spark.readStream.schema(end.schema).parquet(f"{root}/end")
    utc = F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z")))

    def side(event_type: str) -> StreamSide:
        rows = events(spark, sf_dir).filter(F.col("event_type") == event_type).select("event_id", "user_id", "ts")
        return StreamSide(rows.unionByName(marker.withColumn("ts", utc)), "ts", "1 hour")

    sides = {"clicks": side("click"), "views": side("view"), "purchases": side("purchase")}
    steps = [
        StreamStep("clicks", "views", ("user_id",), ("user_id",), after="2 hours"),
        StreamStep("clicks", "purchases", ("user_id",), ("user_id",), before="1 hour", after="3 hours"),
    ]
    names = {"clicks": "event_id", "views": "view_id", "purchases": "purchase_id"}
    rows = join_streams(sides, steps).select(*[F.col(f"{n}_table.event_id").alias(c) for n, c in names.items()])
    # filtered when all is done: a filter of the stream would be pushed below the watermark
    return _finished(spark, rows, "joined").filter("event_id >= 0")


@query(
    "stream_scd2",
    f"""with d as (select * from (select o_custkey customer_key, o_orderstatus status, o_orderpriority priority,
        make_date(year(o_orderdate), month(o_orderdate) // 7 * 6 + 1, 1) effective_from, row_number() over (partition by
        o_custkey, year(o_orderdate), month(o_orderdate) // 7 order by o_orderdate desc, o_orderkey desc) rn from orders)
        where rn = 1),
    h as (select *, {SQL_HASH.format('')} row_hash from d),
    c as (select *, lag(row_hash) over (partition by customer_key order by effective_from) b from h),
    v as (select * from c where b is null or b <> row_hash)
    select customer_key, status, priority, effective_from,
      lead(effective_from) over (partition by customer_key order by effective_from) effective_to,
      lead(effective_from) over (partition by customer_key order by effective_from) is null is_current,
      row_hash from v""",
)
def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of half-years as changes of customers, in three arrivals that overlap; days are closed after each."""
    root = work_dir(spark, "history")
    ordered = F.col("o_orderdate")
    half = F.make_date(F.year(ordered), F.expr("month(o_orderdate) div 7 * 6 + 1"), F.lit(1))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        half.cast("timestamp").alias("at"),
        ordered.cast("string").alias("placed"),
        "o_orderkey",
    )
    keys, order = ["customer_key"], ["placed", "o_orderkey"]
    history = StreamedHistory(spark, f"{root}/history", f"{root}/changes", keys, "at", datetime.timedelta(days=600), order)
    make_parents(spark, f"{root}/arrivals/first")
    arrivals = spark.readStream.schema(rows.schema).parquet(f"{root}/arrivals")
    year, third = F.year("at"), F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    first, overlap = year < 1998, year.between(1998, 1999)
    for part in (first | overlap & (third == 0), overlap & (third > 0) | (year == 2000) & (third == 0), (year == 2000) & (third > 0) | (year > 2000)):
        rows.filter(part).write.mode("append").parquet(f"{root}/arrivals")
        history.start(arrivals, f"{root}/checkpoint").awaitTermination()
        history.compact()
    history.compact(everything=True)
    return history.history()
