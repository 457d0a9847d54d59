"""The given tables, in their own shape and in the bank domain's shape.

orders stand in for accounts, line items for transactions, customer for customers.  A customer's latest order before and from ``CUT`` on gives two snapshots of
one dimension.  Bronze feeds are these frames written as dated files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.operators.keys import dedup_latest
from tierwise.scratch import is_directory

CUT = "1998-01-01"
EARLY, LATE = "20240101060606", "20240102080808"

# The same frames for the SQL side.
SQL_ACCOUNTS = """select cast(o_orderkey as varchar) account_number, o_orderpriority account_type,
    cast(o_custkey as varchar) customer_id, cast(o_totalprice as varchar) balance,
    strftime(o_orderdate, '%Y-%m-%d') open_date, o_orderdate from orders"""
SQL_CHAIN = """orders a left join lineitem t on a.o_orderkey = t.l_orderkey
    join customer u on a.o_custkey = u.c_custkey"""
SQL_PROFILES = f"""ranked as (select o_custkey customer_key, o_orderstatus status, o_orderpriority priority,
      cast(o_orderdate as date) as_of, o_orderdate < timestamp '{CUT}' early,
      row_number() over (partition by o_custkey, o_orderdate < timestamp '{CUT}'
                         order by o_orderdate desc, o_orderkey desc) rn from orders),
    tgt as (select customer_key, status, priority, as_of from ranked where rn = 1 and early),
    src as (select customer_key, status, priority, as_of from ranked where rn = 1 and not early)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def chain_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The chain's datasets under their own column names."""
    return {
        "orders": table(spark, sf_dir, "orders"),
        "lines": table(spark, sf_dir, "lineitem"),
        "customer": table(spark, sf_dir, "customer"),
    }


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("account_number"),
        F.col("o_orderpriority").alias("account_type"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").cast("string").alias("balance"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("open_date"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("age"),
        F.col("c_mktsegment").alias("city"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("account_number"),
        F.col("l_extendedprice").alias("amount"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_linestatus").alias("transaction_type"),
        F.col("l_shipdate"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(source, target): each customer's latest order from CUT on, and before it."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")

    def snapshot(rows: DataFrame) -> DataFrame:
        latest = dedup_latest(
            rows.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority"),
            ["o_custkey"],
            ["o_orderdate", "o_orderkey"],
        )
        return latest.select(
            F.col("o_custkey").alias("customer_key"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderdate").cast("date").alias("as_of"),
        )

    return snapshot(orders.filter(~early)), snapshot(orders.filter(early))


def drop_feed(df: DataFrame, folder: str, feed: str, stamp: str, file_format: str, **options) -> None:
    """Write ``df`` as dated bronze files; one drop may have several files of one stamp."""
    (
        df.write.format(file_format)
        .mode("append")
        .option("mapreduce.output.basename", f"{feed}_{stamp}.")
        .options(**options)
        .save(folder)
    )


def drop_json_arrays(df: DataFrame, folder: str, feed: str, stamp: str, rows_per_file: int = 20_000) -> None:
    """Files holding one JSON array each, of at most ``rows_per_file`` rows."""
    numbered = df.withColumn("__chunk", F.floor(F.monotonically_increasing_id() / rows_per_file))
    fields = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    arrays = numbered.groupBy("__chunk").agg(F.collect_list(fields).alias("__rows"))
    text = arrays.select(F.concat(F.lit("["), F.concat_ws(",\n", "__rows"), F.lit("]")).alias("value"))
    drop_feed(text, folder, feed, stamp, "text", maxRecordsPerFile=1)
