"""Queries over bronze files, silver and gold layers, views and external tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.columns import drop_file_columns, malformed_counts, side_columns
from tierwise.operators.scd1 import schema_report
from tierwise.plans.dimension import initial_load
from tierwise.plans.incremental import ingest_new
from tierwise.operators.metrics import global_aggregates
from tierwise.plans.report import accounting, publish_silver, run_report, write_metrics
from tierwise.scratch import delete, path_exists, work_dir
from tierwise.sinks.publish import write_partitioned, write_silver
from tierwise.sources.catalog import create_external_table, register_views, view
from tierwise.sources.files import feed_files, ingest, ingest_all, read_layer
from tierwise.sources.ledger import FileLedger
from tierwise.sources.schemas import SchemaConflict, silver_schema
from tierwise.spec import DatasetSpec, ReportSpec, Rule
from workload.registry import query
from workload.relational import AGGREGATES, _sql_aggregates, chain
from workload.tables import (
    CUT,
    EARLY,
    LATE,
    SQL_ACCOUNTS,
    SQL_CHAIN,
    accounts,
    customers,
    drop_feed,
    drop_json_arrays,
    table,
    transactions,
)

ACCOUNT_SCHEMA = (
    "account_number string, account_type string, customer_id string, balance string, open_date string"
)
CUSTOMER_SCHEMA = "customer_id string, name string, age string, city string"
TRANSACTION_SCHEMA = (
    "account_number bigint, amount double, transaction_id bigint, transaction_type string"
)
ACCOUNT_COLUMNS = ["account_number", "account_type", "customer_id", "balance", "open_date"]


def file_stamp() -> Column:
    return F.regexp_extract("filename", r"^([a-z]+_\d{14})\.", 1).alias("file_stamp")


def feed_spec(name: str, folder: str, **settings) -> DatasetSpec:
    return DatasetSpec(name, folder, pattern=rf"{name}_\d{{14}}.*", required=True, **settings)


def account_snapshots(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Two drops of the accounts feed: opened before and from CUT on."""
    rows = accounts(spark, sf_dir)
    options = {"header": True, "sep": "|"}
    drop_feed(rows.filter(F.col("open_date") < CUT), folder, "accounts", EARLY, "csv", **options)
    drop_feed(rows.filter(F.col("open_date") >= CUT), folder, "accounts", LATE, "csv", **options)


@query(
    "ingest_csv",
    f"""select account_number, account_type, customer_id, balance, open_date, '2024' as year, '01' as month,
    '01' as day, 'accounts_{EARLY}' as file_stamp from ({SQL_ACCOUNTS})""",
)
def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    drop_feed(accounts(spark, sf_dir), folder, "accounts", EARLY, "csv", header=True, sep="|")
    frame = ingest(spark, feed_spec("accounts", folder, delimiter="|", schema=ACCOUNT_SCHEMA)).frame
    return frame.select(*ACCOUNT_COLUMNS, "year", "month", "day", file_stamp())


@query(
    "ingest_json",
    """select l_orderkey account_number, l_extendedprice amount, l_partkey * 10 + l_linenumber transaction_id,
    l_linestatus transaction_type from lineitem""",
)
def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    drop_json_arrays(transactions(spark, sf_dir).drop("l_shipdate"), folder, "transactions", EARLY)
    spec = feed_spec("transactions", folder, format="json", schema=TRANSACTION_SCHEMA)
    return drop_file_columns(ingest(spark, spec).frame)


def _round_trip(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    drop_feed(table(spark, sf_dir, "customer"), folder, "customers", EARLY, file_format)
    return drop_file_columns(ingest(spark, feed_spec("customers", folder, format=file_format)).frame)


@query("ingest_parquet", "select * from customer")
def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "parquet")


@query("ingest_orc", "select * from customer")
def ingest_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "orc")


@query(
    "ingest_all_files",
    f"""select account_number, balance, case when o_orderdate < timestamp '{CUT}'
    then 'accounts_{EARLY}' else 'accounts_{LATE}' end file_stamp from ({SQL_ACCOUNTS})""",
)
def ingest_all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    account_snapshots(spark, sf_dir, folder)
    spec = feed_spec("accounts", folder, delimiter="|", snapshot="all", schema=ACCOUNT_SCHEMA)
    return ingest(spark, spec).frame.select("account_number", "balance", file_stamp())


@query(
    "ingest_latest_file",
    f"""select account_number, balance, 'accounts_{LATE}' as file_stamp from ({SQL_ACCOUNTS})
    where o_orderdate >= timestamp '{CUT}'""",
)
def ingest_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    account_snapshots(spark, sf_dir, folder)
    return ingest(spark, feed_spec("accounts", folder, delimiter="|", snapshot="latest")).frame.select(
        "account_number", "balance", file_stamp()
    )


@query(
    "file_pattern_filter",
    f"""select case when o_orderdate < timestamp '{CUT}' then '{EARLY}' else '{LATE}' end stamp, true as dated,
    count(*) as n_rows from orders group by 1""",
)
def file_pattern_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    account_snapshots(spark, sf_dir, folder)
    drop_feed(customers(spark, sf_dir), folder, "customers", EARLY, "csv", header=True)
    spec = feed_spec("accounts", folder, delimiter="|", snapshot="all", schema=ACCOUNT_SCHEMA)
    rows = ingest(spark, spec).frame.groupBy("filename").agg(F.count(F.lit(1)).alias("n"))
    files = feed_files(spark, spec).select("file_name", "stamp", "dated")
    return (
        files.join(rows, files.file_name == rows.filename)
        .groupBy("stamp", "dated")
        .agg(F.sum("n").alias("n_rows"))
    )


@query(
    "filename_metadata",
    f"""select cast(c_custkey as varchar) customer_id, '2024' as year, '01' as month, '02' as day,
    'customers_{LATE}' as file_stamp from customer""",
)
def filename_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    drop_feed(customers(spark, sf_dir), folder, "customers", LATE, "csv", header=True)
    return ingest(spark, feed_spec("customers", folder)).frame.select(
        "customer_id", "year", "month", "day", file_stamp()
    )


def bank_config(spark: SparkSession, sf_dir: str) -> dict:
    """Three bronze feeds derived from the tables, and the report configuration over them."""
    root = work_dir(spark, "bank")
    bronze = {n: f"{root}/bronze/{n}" for n in ("accounts", "customers", "transactions")}
    drop_feed(accounts(spark, sf_dir), bronze["accounts"], "accounts", EARLY, "csv", header=True, sep="|")
    drop_feed(customers(spark, sf_dir), bronze["customers"], "customers", EARLY, "csv", header=True)
    lines = transactions(spark, sf_dir)
    early = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    for rows, stamp in ((lines.filter(early), EARLY), (lines.filter(~early), LATE)):
        drop_json_arrays(rows.drop("l_shipdate"), bronze["transactions"], "transactions", stamp)
    datasets = {
        n: {"input_path": p, "output_path": f"{root}/silver/{n}", "regex": rf"{n}_\d{{14}}.*"}
        for n, p in bronze.items()
    }
    accounts_feed = {"format": "csv", "delimiter": "|", "schema": ACCOUNT_SCHEMA}
    datasets["accounts"] |= {**accounts_feed, "casts": {"balance": "double"}}
    datasets["customers"] |= {"format": "csv", "schema": CUSTOMER_SCHEMA, "casts": {"age": "double"}}
    datasets["transactions"] |= {"format": "json", "schema": TRANSACTION_SCHEMA, "snapshot": "all"}
    join = {"left": "accounts", "left_key": "account_number", "right_key": "account_number"}
    return {
        "datasets": datasets,
        "etl": {
            "join": {**join, "right": "transactions", "join_type": "left"},
            "join2": {
                "left": "accounts",
                "right": "customers",
                "left_key": "customer_id",
                "right_key": "customer_id",
                "join_type": "inner",
            },
            "aggregations": {
                "total_balance": "round(sum(accounts_table.balance), 2)",
                "transactions_count": "count(*)",
            },
            "output": {
                "path": f"{root}/gold/bank",
                "format": "parquet",
                "select": [
                    "transactions_table.transaction_id",
                    "transactions_table.account_number",
                    "transactions_table.amount",
                    "transactions_table.transaction_type",
                    "customers_table.customer_id",
                    "customers_table.name",
                ],
                "date_parts": [f"transactions_table.{p}" for p in ("year", "month", "day")],
            },
        },
    }


@query(
    "ingest_all_datasets",
    """select 'accounts' as dataset, 'read' as status, count(*) as n from orders
    union all select 'customers', 'read', count(*) from customer
    union all select 'transactions', 'read', count(*) from lineitem""",
)
def ingest_all_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReportSpec.from_dict(bank_config(spark, sf_dir))
    counts = [
        r.frame.select(F.lit(name).alias("dataset"), F.lit(r.status).alias("status"))
        for name, r in ingest_all(spark, spec.datasets.values()).items()
    ]
    rows = counts[0].union(counts[1]).union(counts[2])
    return rows.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "gold_report",
    f"""select t.l_partkey * 10 + t.l_linenumber transaction_id, t.l_orderkey account_number,
    t.l_extendedprice amount, t.l_linestatus transaction_type, cast(u.c_custkey as varchar) customer_id,
    u.c_name "name", case when t.l_shipdate < timestamp '{CUT}' then date '2024-01-01'
    when t.l_shipdate is not null then date '2024-01-02' end date_id from {SQL_CHAIN}""",
)
def gold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(spark, ReportSpec.from_dict(bank_config(spark, sf_dir))).report


@query(
    "parquet_scan",
    "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000",
)
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_layer(spark, f"{sf_dir}/orders.parquet")
    kept = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
    return kept.select("o_orderkey", "o_totalprice")


def _orders_by_year(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "silver")
    dated = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    write_partitioned(dated, path, partition_by="order_year", rebalance=True)
    return path


@query("partitioned_write", "select *, cast(year(o_orderdate) as integer) order_year from orders")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, _orders_by_year(spark, sf_dir))


@query(
    "gold_partition_prune",
    "select o_orderkey, o_totalprice from orders where year(o_orderdate) = 1998",
)
def gold_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = read_layer(spark, _orders_by_year(spark, sf_dir))
    return layer.filter("order_year = 1998").select("o_orderkey", "o_totalprice")


@query(
    "silver_write",
    f"""select account_number, balance, '2024' as year, '01' as month, '01' as day from ({SQL_ACCOUNTS})
    where o_orderdate < timestamp '{CUT}'
    union all select account_number, '0', '2024', '01', '02' from ({SQL_ACCOUNTS})
    where o_orderdate >= timestamp '{CUT}'""",
)
def silver_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, then a second delivery of the later day: the earlier one survives."""
    root = work_dir(spark, "silver")
    account_snapshots(spark, sf_dir, f"{root}/bronze")
    spec = feed_spec("accounts", f"{root}/bronze", output_path=f"{root}/silver", delimiter="|", snapshot="all")
    frame = ingest(spark, spec).frame
    write_silver({"accounts": frame}, {"accounts": spec})
    redelivered = frame.filter("day = '02'").withColumn("balance", F.lit("0"))
    write_silver({"accounts": redelivered}, {"accounts": spec})
    silver = read_layer(spark, spec.output_path, text_parts=True)
    return silver.select("account_number", "balance", "year", "month", "day")


@query(
    "initial_load",
    f"""select account_number, customer_id, balance, date '2024-01-01' as date_id, 'gold' as layer
    from ({SQL_ACCOUNTS}) where o_orderdate < timestamp '{CUT}'
    union all select account_number, customer_id, balance, date '2024-01-02', 'silver'
    from ({SQL_ACCOUNTS}) where o_orderdate >= timestamp '{CUT}'""",
)
def initial_load_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "seed")
    account_snapshots(spark, sf_dir, f"{root}/bronze")

    def snapshot(stamp: str) -> DatasetSpec:
        return DatasetSpec(
            "accounts", f"{root}/bronze", f"{root}/silver", delimiter="|", pattern=rf"accounts_{stamp}.*"
        )

    initial_load(spark, snapshot(EARLY), f"{root}/gold", snapshot(LATE))
    columns = ["account_number", "customer_id", "balance", "date_id", "layer"]
    gold = read_layer(spark, f"{root}/gold").withColumn("layer", F.lit("gold"))
    silver = read_layer(spark, f"{root}/silver").withColumns(
        {"date_id": F.make_date("year", "month", "day"), "layer": F.lit("silver")}
    )
    return gold.select(*columns).unionByName(silver.select(*columns))


@query("view_scan", "select c_custkey, c_name, c_acctbal from customer")
def view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"customer": table(spark, sf_dir, "customer")}
    register_views(spark, frames)
    return view(spark, "customer", frames).select("customer_table.c_custkey", "c_name", "c_acctbal")


@query("drop_columns", "select c_custkey, c_name, c_nationkey from customer")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").drop("c_acctbal", "c_mktsegment")


@query(
    "select_side_star",
    "select o.* from orders o join customer c on o.o_custkey = c.c_custkey",
)
def select_side_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").alias("o")
    customer = table(spark, sf_dir, "customer").alias("c")
    return side_columns(orders.join(customer, F.col("o.o_custkey") == F.col("c.c_custkey")), "o")


@query("preview_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "schema_check",
    """select 'account_number' as "column", true as in_source, true as in_target, false as same_type,
      count(*) filter (try_cast(cast(o_orderkey as varchar) as bigint) is null) as bad_values from orders
    union all select 'account_type', true, true, false,
      count(*) filter (try_cast(o_orderpriority as integer) is null) from orders
    union all select 'customer_id', true, true, true, 0
    union all select 'balance', true, true, false,
      count(*) filter (try_cast(cast(o_totalprice as varchar) as double) is null) from orders
    union all select 'open_date', true, false, false, 0
    union all select 'branch', false, true, false, 0""",
)
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns a typed target would miss or convert, and how many values would not convert."""
    source = accounts(spark, sf_dir)
    casts = {"account_number": "bigint", "account_type": "int", "balance": "double"}
    declared = ", ".join(f"{c} {t}" for c, t in {**casts, "customer_id": "string", "branch": "string"}.items())
    target = spark.createDataFrame([], declared)
    bad = malformed_counts(source, casts)
    return (
        schema_report(source, target)
        .join(F.broadcast(bad), "column", "left")  # one row per column
        .select("column", "in_source", "in_target", "same_type", F.coalesce("bad_values", F.lit(0)).alias("bad_values"))
    )


@query(
    "ingest_incremental",
    f"""select account_number, balance, case when o_orderdate < timestamp '{CUT}' then 1 else 2 end as "day"
    from ({SQL_ACCOUNTS})""",
)
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries; the job runs after each, and once more with nothing new."""
    root = work_dir(spark, "incremental")
    ledger = FileLedger(spark, f"{root}/ledger")
    rows = accounts(spark, sf_dir)
    early = F.col("open_date") < CUT
    spec = feed_spec(
        "accounts", f"{root}/bronze", output_path=f"{root}/silver", delimiter="|", schema=ACCOUNT_SCHEMA
    )
    for part, stamp in ((rows.filter(early), EARLY), (rows.filter(~early), LATE)):
        drop_feed(part, spec.input_path, "accounts", stamp, "csv", header=True, sep="|")
        ingest_new(spark, spec, ledger, stamp)
    ingest_new(spark, spec, ledger, "again")
    return read_layer(spark, spec.output_path).select("account_number", "balance", "day")


@query(
    "dq_feed_rules",
    f"""select account_number, case when o_totalprice > 450000 then 'price_plausible' else '' end failed
    from ({SQL_ACCOUNTS.replace("o_orderdate from", "o_orderdate, o_totalprice from")})""",
)
def dq_feed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed published through its rules: silver and quarantine together hold every row."""
    root = work_dir(spark, "rules")
    drop_feed(accounts(spark, sf_dir), f"{root}/bronze", "accounts", EARLY, "csv", header=True, sep="|")
    rule = Rule("price_plausible", "sql", expression="try_cast(balance as double) <= 450000")
    spec = feed_spec(
        "accounts",
        f"{root}/bronze",
        output_path=f"{root}/silver",
        delimiter="|",
        schema=ACCOUNT_SCHEMA,
        rules=(rule,),
        quarantine_path=f"{root}/quarantine",
    )
    publish_silver(spark, {"accounts": ingest(spark, spec).frame}, {"accounts": spec})
    valid = read_layer(spark, spec.output_path).select("account_number", F.lit("").alias("failed"))
    rejected = spark.read.parquet(spec.quarantine_path)
    return valid.unionByName(rejected.select("account_number", F.concat_ws(",", "failed_rules").alias("failed")))


@query("external_table", "select * from orders")
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_by_year(spark, sf_dir)
    name, read = f"orders_by_year_{uuid.uuid4().hex[:12]}", work_dir(spark, "read")
    write_partitioned(create_external_table(spark, name, path, partitioned=True).drop("order_year"), read)
    spark.sql(f"DROP TABLE {name}")
    return read_layer(spark, read)


@query(
    "ledger_unprocessed",
    """select '20240121000000' as stamp, count(*) as n_rows from events where ts >= timestamp '2024-01-21'""",
)
def ledger_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the files of the first one recorded as done: what is left to read."""
    root = work_dir(spark, "ledger")
    ledger = FileLedger(spark, f"{root}/ledger")
    spec = feed_spec("events", f"{root}/bronze", schema="event_id bigint, event_type string", snapshot="all")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    early = F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz")
    drop_feed(rows.filter(early).drop("ts"), spec.input_path, "events", "20240101000000", "csv", header=True)
    ledger.record(feed_files(spark, spec), "events", "first")
    drop_feed(rows.filter(~early).drop("ts"), spec.input_path, "events", "20240121000000", "csv", header=True)
    todo = ledger.unprocessed(feed_files(spark, spec), "events")
    read = ingest(spark, spec).frame.groupBy("filename").agg(F.count(F.lit(1)).alias("n"))
    return todo.join(read, todo.file_name == read.filename).groupBy("stamp").agg(F.sum("n").alias("n_rows"))


@query("metric_sink", _sql_aggregates("total_balance", "accounts", "rows").replace("select ", "select 'second' as run_id, ", 1)
       + " union all " + _sql_aggregates("total_balance", "accounts", "rows").replace("select ", "select 'first', ", 1))
def metric_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's aggregates written as those of two runs, one of them repeated."""
    path = work_dir(spark, "metrics")
    metrics = global_aggregates(chain(spark, sf_dir), {n: AGGREGATES[n] for n in ("total_balance", "accounts", "rows")})
    for run_id in ("first", "second", "first"):
        write_metrics(metrics, path, run_id)
    return spark.read.parquet(path).drop("recorded_at")


@query(
    "feed_accounting",
    f"""select 'accounts' as dataset, true as has_files, 0::bigint as undated_files, count(*) as "rows",
    count(*) filter (o_totalprice <= 450000) as silver, count(*) filter (o_totalprice > 450000) as quarantined
    from ({SQL_ACCOUNTS.replace("o_orderdate from", "o_orderdate, o_totalprice from")})""",
)
def feed_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery whose rows are all rejected, then the corrected one under the same name."""
    root = work_dir(spark, "accounting")
    rule = Rule("price_plausible", "sql", expression="try_cast(balance as double) <= 450000")
    spec = feed_spec(
        "accounts",
        f"{root}/bronze",
        output_path=f"{root}/silver",
        delimiter="|",
        schema=ACCOUNT_SCHEMA,
        rules=(rule,),
        quarantine_path=f"{root}/quarantine",
    )
    rows = accounts(spark, sf_dir)
    for delivery in (rows.withColumn("balance", F.lit("900000")), rows):
        if path_exists(spark, spec.input_path):
            delete(spark, spec.input_path)
        drop_feed(delivery, spec.input_path, "accounts", EARLY, "csv", header=True, sep="|")
        result = ingest(spark, spec)
        publish_silver(spark, {"accounts": result.frame}, {"accounts": spec})
    counted = accounting(spark, {"accounts": result}, {"accounts": spec})
    return counted.withColumn("has_files", F.col("files") > 0).drop("files")


@query(
    "schema_evolution",
    """select o_orderkey, cast(case when year(o_orderdate) < 1997 then cast(o_totalprice as decimal(12, 2)) else o_totalprice end
      as decimal(14, 4)) price, case when year(o_orderdate) >= 1997 then o_orderstatus end status,
    case when year(o_orderdate) >= 1999 then cast(o_orderdate as timestamp) when year(o_orderdate) >= 1997
      then cast(cast(o_orderdate as date) as timestamp) end placed, case when year(o_orderdate) < 1999 then o_custkey end customer
    from orders""",
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of orders with ever wider types, a column that comes and one that goes; through silver.

    A fourth one, whose price is text, is refused before anything is read.
    """
    root = work_dir(spark, "evolving")
    spec = feed_spec("orders", f"{root}/bronze", format="parquet", output_path=f"{root}/silver", snapshot="all", schema_log=f"{root}/schemas")
    orders, year = table(spark, sf_dir, "orders"), F.year("o_orderdate")

    def columns(key: str, price: str, **more) -> list:
        given = {"o_orderkey": F.col("o_orderkey").cast(key), "price": F.col("o_totalprice").cast(price), **more}
        return [c.alias(n) for n, c in given.items()]

    customer, status = F.col("o_custkey"), F.col("o_orderstatus")
    deliveries = [
        (year < 1997, columns("int", "decimal(12, 2)", customer=customer.cast("int"))),
        (year.between(1997, 1998), columns("bigint", "decimal(14, 4)", customer=customer, status=status, placed=F.to_date("o_orderdate"))),
        (year >= 1999, columns("int", "decimal(14, 4)", status=status, placed=F.col("o_orderdate"))),
    ]
    for n, (chosen, names) in enumerate(deliveries, 1):
        drop_feed(orders.filter(chosen).select(*names), spec.input_path, "orders", f"2024010{n}000000", "parquet")
        latest = replace(spec, snapshot="latest")  # each day's silver has its own delivery's types
        publish_silver(spark, {"orders": ingest(spark, latest).frame}, {"orders": latest})
    drop_feed(orders.limit(1).select(F.lit("none").alias("price")), spec.input_path, "orders", "20240104000000", "parquet")
    try:
        ingest(spark, spec)
    except SchemaConflict:
        pass
    else:
        raise AssertionError("a price that is text was admitted")
    silver = read_layer(spark, spec.output_path, schema=silver_schema(spark, spec))
    return silver.select("o_orderkey", "price", "status", "placed", F.col("customer").cast("bigint").alias("customer"))
