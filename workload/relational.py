"""Queries over columns, joins and aggregates."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.columns import (
    date_id,
    date_id_from_name,
    date_id_from_name_legacy,
    padded,
    project,
)
from tierwise.functions.hashing import row_hash
from tierwise.operators.joins import join_chain, unreadable_values
from tierwise.operators.metrics import (
    daily_summary,
    day_over_day,
    global_aggregates,
    grouped_aggregates,
    totals_per_key,
)
from tierwise.operators.states import LOG_REGISTERS, DailyStates
from tierwise.plans.report import report_rows
from tierwise.scratch import work_dir
from tierwise.spec import JoinStep, OutputSpec
from workload.registry import query
from workload.tables import (
    SQL_CHAIN,
    SQL_PROFILES,
    chain_frames,
    profiles,
    table,
)

CHAIN_STEPS = tuple(
    JoinStep.from_dict(name, cfg)
    for name, cfg in {
        "join": {
            "left": "orders",
            "right": "lines",
            "left_key": "o_orderkey",
            "right_key": "l_orderkey",
            "join_type": "left",
        },
        "join2": {
            "left": "orders",
            "right": "customer",
            "left_key": "o_custkey",
            "right_key": "c_custkey",
            "join_type": "inner",
        },
    }.items()
)
REPORT = OutputSpec(
    path="",
    select=(
        "lines_table.l_orderkey",
        "lines_table.l_linenumber",
        "lines_table.l_extendedprice",
        "lines_table.l_returnflag",
        "customer_table.c_custkey",
        "customer_table.c_name",
    ),
    date_parts=("lines_table.year", "lines_table.month", "lines_table.day"),
    legacy_date_id=True,
)


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_chain(chain_frames(spark, sf_dir), CHAIN_STEPS)


def one_step(join_type: str, left: str, right: str, left_key: str, right_key: str, **settings) -> JoinStep:
    cfg = {"left": left, "right": right, "left_key": left_key, "right_key": right_key, "join_type": join_type}
    return JoinStep.from_dict("join", {**cfg, **settings})


def date_parts(name: str) -> dict:
    return {"year": F.year(name), "month": F.month(name), "day": F.day(name)}


@query(
    "join_chain",
    f"""select t.l_orderkey, t.l_linenumber, t.l_extendedprice, t.l_returnflag, u.c_custkey, u.c_name,
    concat_ws('-', year(t.l_shipdate), month(t.l_shipdate), day(t.l_shipdate)) date_id from {SQL_CHAIN}""",
)
def report_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = chain_frames(spark, sf_dir)
    frames["lines"] = frames["lines"].withColumns(date_parts("l_shipdate"))
    return report_rows(join_chain(frames, CHAIN_STEPS), REPORT)


@query(
    "join_left",
    """select a.o_orderkey, a.o_totalprice, t.l_linenumber, t.l_extendedprice from orders a
    left join lineitem t on a.o_orderkey = t.l_orderkey""",
)
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["orders_table.o_orderkey", "orders_table.o_totalprice"]
    columns += ["lines_table.l_linenumber", "lines_table.l_extendedprice"]
    return project(join_chain(chain_frames(spark, sf_dir), CHAIN_STEPS[:1]), columns)


@query(
    "join_inner",
    """select o_orderkey, c_custkey, c_name from orders join customer on o_custkey = c_custkey""",
)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_chain(chain_frames(spark, sf_dir), CHAIN_STEPS[1:])
    return project(joined, ["orders_table.o_orderkey", "customer_table.c_custkey", "customer_table.c_name"])


def _profile_join(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    source, target = profiles(spark, sf_dir)
    step = one_step(how, "target", "source", "customer_key", "customer_key")
    joined = join_chain({"target": target, "source": source}, [step])
    return joined.select(
        F.col("target_table.customer_key").alias("target_key"),
        F.col("target_table.status").alias("target_status"),
        F.col("source_table.customer_key").alias("source_key"),
        F.col("source_table.status").alias("source_status"),
    )


SQL_PROFILE_JOIN = f"""with {SQL_PROFILES} select tgt.customer_key target_key, tgt.status target_status,
    src.customer_key source_key, src.status source_status
    from tgt %s join src on tgt.customer_key = src.customer_key"""


@query("join_full", SQL_PROFILE_JOIN % "full")
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_join(spark, sf_dir, "full")


@query("join_right", SQL_PROFILE_JOIN % "right")
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_join(spark, sf_dir, "right")


def _order_filter_join(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    step = one_step(how, "orders", "lines", "o_orderkey", "l_orderkey")
    return join_chain(chain_frames(spark, sf_dir), [step]).select("o_orderkey", "o_totalprice")


@query(
    "join_semi",
    """select o_orderkey, o_totalprice from orders a where exists
    (select 1 from lineitem t where t.l_orderkey = a.o_orderkey)""",
)
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_filter_join(spark, sf_dir, "left_semi")


@query(
    "join_anti",
    """select o_orderkey, o_totalprice from orders a where not exists
    (select 1 from lineitem t where t.l_orderkey = a.o_orderkey)""",
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_filter_join(spark, sf_dir, "left_anti")


@query(
    "join_mixed_type",
    """select o_orderkey, c_name from orders join customer
    on try_cast(cast(o_custkey as varchar) as bigint) = c_custkey""",
)
def join_mixed_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("key"))
    step = one_step("inner", "orders", "customer", "key", "c_custkey")
    joined = join_chain({"orders": orders, "customer": table(spark, sf_dir, "customer")}, [step])
    return project(joined, ["orders_table.o_orderkey", "customer_table.c_name"])


@query(
    "unreadable_values",
    """select 'orders' as dataset, 'key' as "column", 'bigint' as as_type, 'key' as used_as,
      count(*) filter (o_custkey % 7 = 0) as bad_values from orders
    union all select 'orders', 'price', 'double', 'cast', count(*) filter (o_orderpriority like '1%') from orders
    union all select 'customer', 'c_name', 'int', 'cast', count(c_name) from customer""",
)
def unread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a join's keys and declared casts would lose of text that is no number."""
    key = F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit("no "), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    price = F.when(F.col("o_orderpriority").like("1%"), F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").select(key.alias("key"), price.alias("price"))
    frames = {"orders": orders, "customer": table(spark, sf_dir, "customer")}
    step = one_step("inner", "orders", "customer", "key", "c_custkey")
    return unreadable_values(frames, [step], {"orders": {"price": "double"}, "customer": {"c_name": "int"}})


AGGREGATES = {
    "total_balance": "round(sum(orders_table.o_totalprice), 2)",
    "accounts": "count(distinct orders_table.o_orderkey)",
    "avg_customer": "round(avg(customer_table.c_acctbal), 6)",
    "total_amount": "round(sum(lines_table.l_extendedprice), 2)",
    "rows": "count(*)",
    "avg_balance": "round(avg(orders_table.o_totalprice), 6)",
}
SQL_AGGREGATES = {
    "total_balance": "round(sum(a.o_totalprice), 2)",
    "accounts": "count(distinct a.o_orderkey)",
    "avg_customer": "round(avg(u.c_acctbal), 6)",
    "total_amount": "round(sum(t.l_extendedprice), 2)",
    "rows": "count(*)",
    "avg_balance": "round(avg(a.o_totalprice), 6)",
}


def _sql_aggregates(*names: str) -> str:
    return "select " + ", ".join(f'{SQL_AGGREGATES[n]} as "{n}"' for n in names) + f" from {SQL_CHAIN}"


def _aggregates(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return global_aggregates(chain(spark, sf_dir), {n: AGGREGATES[n] for n in names})


@query("global_aggs", _sql_aggregates(*SQL_AGGREGATES))
def global_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregates(spark, sf_dir, *AGGREGATES)


@query("agg_sum", _sql_aggregates("total_balance", "total_amount"))
def agg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregates(spark, sf_dir, "total_balance", "total_amount")


@query("agg_count_distinct", _sql_aggregates("accounts"))
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregates(spark, sf_dir, "accounts")


@query("agg_avg", _sql_aggregates("avg_customer", "avg_balance"))
def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregates(spark, sf_dir, "avg_customer", "avg_balance")


@query("agg_count_star", _sql_aggregates("rows"))
def agg_count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregates(spark, sf_dir, "rows")


@query(
    "global_aggs_no_fanout",
    f"""select round(sum(b), 2) total_balance, cast(sum(n) as bigint) transactions,
    round(sum(v), 2) total_amount from (select a.o_orderkey, max(a.o_totalprice) b,
    count(t.l_orderkey) n, sum(t.l_extendedprice) v from {SQL_CHAIN} group by a.o_orderkey) x""",
)
def global_aggs_no_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions are totalled per account before the join, so a balance counts once."""
    frames = chain_frames(spark, sf_dir)
    frames["lines"] = totals_per_key(frames["lines"], "l_orderkey", "l_extendedprice")
    steps = (one_step("left", "orders", "lines", "o_orderkey", "l_orderkey", skew="plain"), CHAIN_STEPS[1])
    expressions = {
        "total_balance": "round(sum(orders_table.o_totalprice), 2)",
        "transactions": "sum(lines_table.n)",
        "total_amount": "round(sum(lines_table.total), 2)",
    }
    return global_aggregates(join_chain(frames, steps), expressions)


@query(
    "filter_predicates",
    """select a.o_orderkey, t.l_linenumber from orders a left join
    lineitem t on a.o_orderkey = t.l_orderkey
    where (t.l_orderkey is null or t.l_extendedprice < 20000) and a.o_orderstatus != 'P'
    and a.o_orderpriority is not null and (length(a.o_orderpriority) < 8 or a.o_orderpriority = '1-URGENT')""",
)
def filter_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_chain(chain_frames(spark, sf_dir), CHAIN_STEPS[:1])
    priority = F.col("orders_table.o_orderpriority")
    kept = (
        (F.col("lines_table.l_orderkey").isNull() | (F.col("lines_table.l_extendedprice") < 20000))
        & (F.col("orders_table.o_orderstatus") != "P")
        & priority.isNotNull()
        & ((F.length(priority) < 8) | (priority == "1-URGENT"))
    )
    return project(joined.filter(kept), ["orders_table.o_orderkey", "lines_table.l_linenumber"])


@query(
    "pad_date_parts",
    """select o_orderkey, strftime(o_orderdate, '%Y') as "year", strftime(o_orderdate, '%m') as "month",
    strftime(o_orderdate, '%d') as "day" from orders""",
)
def pad_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "orders").withColumns(date_parts("o_orderdate"))
    return parts.select(
        "o_orderkey",
        F.col("year").cast("string").alias("year"),
        padded(F.col("month")).alias("month"),
        padded(F.col("day")).alias("day"),
    )


@query(
    "date_id_from_parts",
    """select o_orderkey, cast(o_orderdate as date) date_id,
    concat_ws('-', year(o_orderdate), month(o_orderdate), day(o_orderdate)) legacy_date_id from orders""",
)
def date_id_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = list(date_parts("o_orderdate").values())
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_id(*parts).alias("date_id"), date_id(*parts, legacy=True).alias("legacy_date_id")
    )


@query(
    "date_id_from_filename",
    """select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end date_id,
    case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d')
    else 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.csv' end legacy_date_id from orders""",
)
def date_id_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of pending orders lack the time digits: no date, and the text form passes them through."""
    time = F.when(F.col("o_orderstatus") != "P", "060606").otherwise("")
    name = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), time, F.lit(".csv"))
    legacy = date_id_from_name_legacy(name, r"orders_(\d{4})(\d{2})(\d{2})(\d{6})\.csv")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_id_from_name(name).alias("date_id"), legacy.alias("legacy_date_id")
    )


@query(
    "row_hash",
    """select c_custkey, md5(concat_ws('|', c_custkey, c_name, null, c_mktsegment, c_acctbal)) row_hash
    from customer""",
)
def row_hash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_custkey", "c_name", F.lit(None), "c_mktsegment", "c_acctbal"]
    return table(spark, sf_dir, "customer").select("c_custkey", row_hash(columns).alias("row_hash"))


@query("union_by_name", f"with {SQL_PROFILES} select * from tgt union all select * from src")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = profiles(spark, sf_dir)
    return target.unionByName(source.select("as_of", "priority", "status", "customer_key"))


DAILY = {"n": "count(*)", "total": "round(sum(value), 2)"}


@query(
    "daily_summary",
    """select cast(ts as date) date_id, event_type, count(*) n, round(sum(value), 2) total
    from events group by 1, 2""",
)
def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(table(spark, sf_dir, "events"), F.to_date("ts"), ["event_type"], DAILY)


@query(
    "daily_delta",
    """select date_id, event_type, n, total, n - lag(n) over w as n_change,
    round(total - lag(total) over w, 2) as total_change
    from (select cast(ts as date) date_id, event_type, count(*) n, round(sum(value), 2) total
          from events group by 1, 2) window w as (partition by event_type order by date_id)""",
)
def daily_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = day_over_day(daily_events(spark, sf_dir), ["n", "total"], ["event_type"])
    return changes.withColumn("total_change", F.round("total_change", 2))


STATES = DailyStates(["event_type"], {"total": "cast(value as decimal(18, 4))"}, {"users": "user_id", "events": "event_id"})


@query(
    "daily_distinct",
    """with d as (select event_type, date_trunc('week', ts) m, case when cast(ts as date) = date '2024-01-10' then value * 2
        else value end v from events where cast(ts as date) <> date '2024-01-11')
    select cast(m as date) as "week", event_type, count(*) n, sum(cast(v as decimal(18, 4))) total, true as within_error
    from d group by 1, 2""",
)
def daily_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks summed up from the days' states, after a day was corrected and another one emptied; the estimate
    of distinct values held against the exact number, within three standard errors."""
    path, day = work_dir(spark, "states"), F.to_date("ts")
    events = table(spark, sf_dir, "events")
    STATES.replace(path, events, day)
    corrected, emptied = datetime.date(2024, 1, 10), datetime.date(2024, 1, 11)
    again = events.filter(day == F.lit(corrected)).withColumn("value", F.col("value") * 2)
    STATES.replace(path, again, day, [corrected, emptied])
    found = STATES.totals(spark, path, by=[F.trunc("date_id", "week").alias("week"), "event_type"])
    exact = events.filter(day != F.lit(emptied)).groupBy(F.trunc(day, "week").alias("week"), "event_type")
    counts = [F.count_distinct(c).alias(f"exact_{n}") for n, c in (("users", "user_id"), ("events", "event_id"))]
    both = found.join(exact.agg(*counts), ["week", "event_type"], "left")
    error = 3 * 1.04 / math.sqrt(2**LOG_REGISTERS)
    near = [F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.greatest(F.lit(1.0), error * F.col(f"exact_{n}")) for n in ("users", "events")]
    return both.select("week", "event_type", "n", "total", (near[0] & near[1]).alias("within_error"))


SQL_GROUPED = """select o_orderstatus, o_orderpriority, count(*) n, round(sum(o_totalprice), 2) total
    from orders group by %s (o_orderstatus, o_orderpriority)"""


def _grouped(spark: SparkSession, sf_dir: str, grouping: str) -> DataFrame:
    expressions = {"n": "count(*)", "total": "round(sum(o_totalprice), 2)"}
    by = ["o_orderstatus", "o_orderpriority"]
    return grouped_aggregates(table(spark, sf_dir, "orders"), by, expressions, grouping)


@query("grouped_rollup", SQL_GROUPED % "rollup")
def grouped_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, "rollup")


@query("grouped_cube", SQL_GROUPED % "cube")
def grouped_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir, "cube")
