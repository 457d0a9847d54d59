"""Queries over dimension merges, business keys and data quality."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.operators.facts import fact_keys
from tierwise.operators.keys import dedup_latest, surrogate_keys
from tierwise.operators.quality import not_unique, orphans, rule_report, with_failed_rules
from tierwise.operators.scd1 import change_class, measured_bytes, scd1_merge
from tierwise.operators.scd2 import late_rows, open_versions, rebuild_history, scd2_merge
from tierwise.plans.dimension import merge_dimension, read_history
from tierwise.scratch import work_dir
from tierwise.sinks.publish import staged_publish, write_partitioned
from tierwise.sinks.versions import changes_between, manifests, publish_folders
from tierwise.sources.files import read_layer
from tierwise.sources.keyfilters import KeyFilters, not_unique_with
from tierwise.spec import DATE_PARTS, Rule, ScdSpec
from workload.registry import query
from workload.tables import CUT, EARLY, LATE, SQL_PROFILES, profiles, table

KEY = ["customer_key"]
SQL_MERGED = f"""with {SQL_PROFILES} select coalesce(s.customer_key, t.customer_key) customer_key,
    case when s.customer_key is null then t.status else s.status end status,
    case when s.customer_key is null then t.priority else s.priority end priority,
    case when s.customer_key is null then t.as_of else s.as_of end as_of
    from tgt t full join src s on t.customer_key = s.customer_key"""


@query("scd1_merge", SQL_MERGED)
def scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = profiles(spark, sf_dir)
    return scd1_merge(source, target, KEY)


@query("scd1_small_source", SQL_MERGED)
def scd1_small_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form used for a batch measured to fit a broadcast; else the full join."""
    source, target = profiles(spark, sf_dir)
    small = measured_bytes(source) <= ScdSpec.broadcast_limit_bytes
    return scd1_merge(source, target, KEY, small_source=small)


@query(
    "scd1_change_class",
    f"""with {SQL_PROFILES} select coalesce(s.customer_key, t.customer_key) customer_key,
    case when s.customer_key is null then 'target_only' when t.customer_key is null then 'new'
    when md5(concat_ws('|', t.customer_key, t.status)) = md5(concat_ws('|', s.customer_key, s.status))
    then 'unchanged' else 'updated' end as change
    from tgt t full join src s on t.customer_key = s.customer_key""",
)
def scd1_change_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = profiles(spark, sf_dir)
    return change_class(source, target, KEY, compare="hash", compare_exclude=["priority", "as_of"])


@query(
    "scd1_metadata_cols",
    f"""with {SQL_PROFILES} select coalesce(s.customer_key, t.customer_key) customer_key,
    coalesce(s.status, t.status) status,
    case when s.customer_key is null or t.status = s.status then t.priority else s.priority end priority,
    case when s.customer_key is null or t.status = s.status then t.as_of else s.as_of end as_of
    from tgt t full join src s on t.customer_key = s.customer_key""",
)
def scd1_metadata_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = profiles(spark, sf_dir)
    return scd1_merge(source, target, KEY, metadata_cols=["priority", "as_of"])


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
SQL_LINE_ORDER = """l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc,
    l_quantity desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc"""


@query(
    "scd1_multi_key",
    f"""with r as (select *, l_shipdate < timestamp '{CUT}' early, row_number() over (partition by l_orderkey,
      l_linenumber, l_shipdate < timestamp '{CUT}' order by {SQL_LINE_ORDER}) rn from lineitem),
    t as (select * from r where rn = 1 and early), s as (select * from r where rn = 1 and not early)
    select coalesce(s.l_orderkey, t.l_orderkey) l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) l_linenumber,
    case when s.l_orderkey is null then t.l_quantity else s.l_quantity end l_quantity,
    case when s.l_orderkey is null then t.l_returnflag else s.l_returnflag end l_returnflag
    from t full join s on t.l_orderkey = s.l_orderkey and t.l_linenumber = s.l_linenumber""",
)
def scd1_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    target = dedup_latest(lines.filter(early), LINE_KEY, LINE_ORDER)
    source = dedup_latest(lines.filter(~early), LINE_KEY, LINE_ORDER)
    columns = [*LINE_KEY, "l_quantity", "l_returnflag"]
    return scd1_merge(source.select(*columns), target.select(*columns), LINE_KEY)


@query("scd1_publish", SQL_MERGED)
def scd1_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged dimension replaces the very folder it was read from."""
    source, target = profiles(spark, sf_dir)
    path = work_dir(spark, "dimension")
    write_partitioned(target, path)
    staged_publish(spark, scd1_merge(source, read_layer(spark, path), KEY), path)
    return read_layer(spark, path)


def _silver(rows: DataFrame, path: str, stamp: str) -> str:
    """A snapshot as a dated silver source."""
    parts = {"year": stamp[:4], "month": stamp[4:6], "day": stamp[6:8], "filename": f"customers_{stamp}.csv"}
    dated = rows.drop("as_of").withColumns({c: F.lit(v) for c, v in parts.items()})
    write_partitioned(dated, path, partition_by=DATE_PARTS)
    return path


def _layers(spark: SparkSession, sf_dir: str) -> ScdSpec:
    """The two snapshots as a gold dimension and a dated silver source."""
    source, target = profiles(spark, sf_dir)
    root = work_dir(spark, "dimension")
    gold = target.drop("as_of").withColumn("date_id", F.lit("2024-01-01"))
    write_partitioned(gold, f"{root}/gold", partition_by="date_id")
    return ScdSpec(_silver(source, f"{root}/silver", LATE), f"{root}/gold", tuple(KEY))


@query(
    "scd1_dimension_job",
    f"""with {SQL_PROFILES} select coalesce(s.customer_key, t.customer_key) customer_key,
    case when s.customer_key is null then t.status else s.status end status,
    case when s.customer_key is null then t.priority else s.priority end priority,
    case when s.customer_key is null then date '2024-01-01' else date '2024-01-02' end date_id
    from tgt t full join src s on t.customer_key = s.customer_key""",
)
def scd1_dimension_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _layers(spark, sf_dir)
    merge_dimension(spark, spec)
    return read_layer(spark, spec.target_path)


SQL_HASH = """md5(concat(coalesce(concat(cast(length({0}status) as varchar), ':', {0}status), '-'),
    coalesce(concat(cast(length({0}priority) as varchar), ':', {0}priority), '-')))"""


SQL_VERSIONS = f"""with {SQL_PROFILES},
    j as (select t.customer_key tk, t.status ts, t.priority tp, s.customer_key sk, s.status ss, s.priority sp,
          {SQL_HASH.format('t.')} th, {SQL_HASH.format('s.')} sh
          from tgt t full join src s on t.customer_key = s.customer_key)
    select tk customer_key, ts status, tp priority, date '2023-01-01' effective_from,
      case when sk is not null and th <> sh then date '2024-01-01' end effective_to,
      not (sk is not null and th <> sh) is_current, th row_hash from j where tk is not null
    union all
    select sk, ss, sp, date '2024-01-01', null, true, sh from j
      where sk is not null and (tk is null or th <> sh)"""
FIRST_DAY, NEXT_DAY = datetime.date(2023, 1, 1), datetime.date(2024, 1, 1)


@query("scd2_merge", SQL_VERSIONS)
def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = [df.drop("as_of") for df in profiles(spark, sf_dir)]
    return scd2_merge(source, open_versions(target, KEY, FIRST_DAY), KEY, NEXT_DAY)


@query("scd2_dimension_job", SQL_VERSIONS)
def scd2_dimension_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both snapshots through the published dimension, the second one delivered twice."""
    source, target = profiles(spark, sf_dir)
    root = work_dir(spark, "versions")
    first = _silver(target, f"{root}/first", EARLY)
    later = _silver(source, f"{root}/later", LATE)
    for path, day in ((first, FIRST_DAY), (later, NEXT_DAY), (later, NEXT_DAY)):
        merge_dimension(spark, ScdSpec(path, f"{root}/gold", tuple(KEY), scd_type="scd2"), day)
    return read_history(spark, f"{root}/gold")


#: Deliveries of the customers' latest orders of a year, in the order in which they arrive; one arrives twice.
YEARS = (1998, 2000, 1996, 1999, 1996, 2001, 1995, 1997)


@query(
    "catalog_publish",
    """select o_orderkey, cast(year(o_orderdate) as int) o_year, case when year(o_orderdate) >= 1999 then 2 else 1 end * o_totalprice price
    from orders where year(o_orderdate) between 1996 and 2000""",
)
def catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published whole by year, then two of its years replaced and one emptied."""
    path, name = work_dir(spark, "published"), f"orders_published_{uuid.uuid4().hex[:12]}"
    year = F.year("o_orderdate").alias("o_year")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), year)
    publish_folders(spark, orders.filter("o_year <= 2000"), name, path, ["o_year"])
    corrected = orders.filter("o_year IN (1999, 2000)").withColumn("price", F.col("price") * 2)
    publish_folders(spark, corrected, name, path, ["o_year"], whole=False, emptied=["o_year=1995"])
    read = f"{path}-read"
    write_partitioned(spark.table(name), read)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(read)


@query(
    "dimension_changes",
    f"""with {SQL_PROFILES} select case when t.customer_key is null then 'insert' when s.customer_key is null
      then 'delete' else 'update' end as change, coalesce(s.customer_key, t.customer_key) customer_key,
    t.status before_status, s.status after_status, t.as_of before_as_of, s.as_of after_as_of
    from tgt t full join src s on t.customer_key = s.customer_key
    where t.customer_key is null or s.customer_key is null or t.status <> s.status or t.priority <> s.priority
      or t.as_of <> s.as_of""",
)
def dimension_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge that also deletes has changed, from the two published versions."""
    source, target = profiles(spark, sf_dir)
    path, name = work_dir(spark, "published"), f"profiles_{uuid.uuid4().hex[:12]}"
    band = F.expr("int(customer_key div 100)")
    publish_folders(spark, target.withColumn("band", band), name, path, ["band"])
    merged = scd1_merge(source.withColumn("band", band), spark.table(name), KEY, delete_missing=True)
    publish_folders(spark, merged, name, path, ["band"])
    spark.sql(f"DROP TABLE {name}")
    earlier, later = manifests(spark, path)
    both = changes_between(spark, path, KEY, earlier, later)
    sides = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in ("status", "as_of") for side in ("before", "after")]
    return both.select("change", F.coalesce("after.customer_key", "before.customer_key").alias("customer_key"), *sides)


@query(
    "scd2_any_order",
    f"""with d as (select * from (select o_custkey customer_key, o_orderstatus status, o_orderpriority priority,
        make_date(year(o_orderdate), 12, 31) effective_from, row_number() over (partition by o_custkey,
        year(o_orderdate) order by o_orderdate desc, o_orderkey desc) rn from orders
        where year(o_orderdate) between {min(YEARS)} and {max(YEARS)}) where rn = 1),
    h as (select *, {SQL_HASH.format('')} row_hash from d),
    c as (select *, lag(row_hash) over (partition by customer_key order by effective_from) b from h),
    v as (select * from c where b is null or b <> row_hash)
    select customer_key, status, priority, effective_from,
      lead(effective_from) over (partition by customer_key order by effective_from) effective_to,
      lead(effective_from) over (partition by customer_key order by effective_from) is null is_current,
      row_hash from v""",
)
def scd2_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly deliveries through the published dimension, most of them late."""
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    columns = {"o_custkey": "customer_key", "o_orderstatus": "status", "o_orderpriority": "priority"}
    root = work_dir(spark, "any_order")
    for y in YEARS:
        latest = dedup_latest(orders.filter(F.col("y") == y), ["o_custkey"], ["o_orderdate", "o_orderkey"])
        rows = latest.select(*[F.col(c).alias(n) for c, n in columns.items()], F.lit(None).alias("as_of"))
        source = _silver(rows, f"{root}/{y}", f"{y}1231000000")
        merge_dimension(spark, ScdSpec(source, f"{root}/gold", tuple(KEY), scd_type="scd2"), datetime.date(y, 12, 31))
    return read_history(spark, f"{root}/gold")


@query(
    "scd2_late_rows",
    f"""with {SQL_PROFILES} select t.customer_key, t.status, t.priority from tgt t
    join src s on t.customer_key = s.customer_key where t.status <> s.status or t.priority <> s.priority""",
)
def scd2_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier snapshot arriving after the later one."""
    later, earlier = [df.drop("as_of") for df in profiles(spark, sf_dir)]
    return late_rows(earlier, open_versions(later, KEY, NEXT_DAY), KEY, FIRST_DAY)


@query(
    "scd2_history",
    f"""with d as (select * from (select o_custkey customer_key, o_orderstatus status, o_orderpriority priority,
        cast(o_orderdate as date) effective_from, row_number() over (partition by o_custkey,
        cast(o_orderdate as date) order by o_orderkey desc) rn from orders) where rn = 1),
    h as (select *, {SQL_HASH.format('')} row_hash from d),
    c as (select *, lag(row_hash) over (partition by customer_key order by effective_from) b from h),
    v as (select * from c where b is null or b <> row_hash)
    select customer_key, status, priority, effective_from,
      lead(effective_from) over (partition by customer_key order by effective_from) effective_to,
      lead(effective_from) over (partition by customer_key order by effective_from) is null is_current,
      row_hash from v""",
)
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's order status and priority over time."""
    versions = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("effective_from"),
        "o_orderkey",
    )
    return rebuild_history(versions, KEY, sequence_by=["o_orderkey"])


@query(
    "dedup_latest",
    f"""select * exclude (rn) from (select *, row_number() over
    (partition by l_orderkey, l_linenumber order by {SQL_LINE_ORDER}) rn from lineitem) where rn = 1""",
)
def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


SQL_BUCKET = "substr(md5(concat(cast(length(cast(k as varchar)) as varchar), ':', cast(k as varchar))), 1, 4)"


@query(
    "surrogate_keys",
    f"""with o as (select o_orderkey k, min(o_orderdate) < timestamp '{CUT}' early from orders group by 1),
    first as (select k, row_number() over (order by {SQL_BUCKET}, k) sk from o where early),
    later as (select k, (select max(sk) from first) + row_number() over (order by {SQL_BUCKET}, k) sk
              from o where not early)
    select k as o_orderkey, sk from first union all select k, sk from later""",
)
def order_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before CUT numbered first; the whole table then adds only unseen keys."""
    orders = table(spark, sf_dir, "orders")
    early = orders.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))
    none = spark.createDataFrame([], "o_orderkey bigint, sk bigint")
    path = work_dir(spark, "surrogates")
    write_partitioned(surrogate_keys(early, none, ["o_orderkey"]), path)
    return surrogate_keys(orders, read_layer(spark, path), ["o_orderkey"])


@query(
    "fact_key_lookup",
    f"""with d as (select * from (select o_custkey k, o_orderstatus status, o_orderpriority priority,
        make_date(year(o_orderdate), 7, 1) since, row_number() over (partition by o_custkey,
        year(o_orderdate) order by o_orderdate desc, o_orderkey desc) rn from orders) where rn = 1),
    c as (select *, lag(status || priority) over (partition by k order by since) b from d),
    v as (select k, status, priority, since, lead(since) over (partition by k order by since) upto
      from c where b is null or b <> status || priority)
    select l_orderkey, l_linenumber, v.since is not null "known", v.status, v.priority, v.since as valid_from
    from lineitem join orders on l_orderkey = o_orderkey
      left join v on o_custkey = k and cast(l_shipdate as date) >= since and (upto is null or cast(l_shipdate as date) < upto)""",
)
def fact_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the key of their customer's version on the day they were shipped."""
    orders = table(spark, sf_dir, "orders")
    yearly = dedup_latest(orders.withColumn("y", F.year("o_orderdate")), ["o_custkey", "y"], ["o_orderdate", "o_orderkey"])
    history = rebuild_history(
        yearly.select(
            F.col("o_custkey").alias("customer_key"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.make_date("y", F.lit(7), F.lit(1)).alias("effective_from"),
        ),
        KEY,
    )
    identity = [*KEY, "effective_from"]
    numbers = surrogate_keys(history, spark.createDataFrame([], "customer_key bigint, effective_from date, sk bigint"), identity)
    versions = history.join(numbers, identity)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    facts = lines.join(orders.select("o_orderkey", F.col("o_custkey").alias("customer_key")), F.col("l_orderkey") == F.col("o_orderkey"))
    found = fact_keys(facts, versions, KEY, F.to_date("l_shipdate"))
    back = found.join(versions.drop(*KEY), "sk", "left")
    return back.select("l_orderkey", "l_linenumber", (F.col("sk") > 0).alias("known"), "status", "priority", F.col("effective_from").alias("valid_from"))


RULES = (
    Rule("customer_given", "not_null", "o_custkey"),
    Rule("price_plausible", "range", "o_totalprice", min=5000, max=450000),
    Rule("status_known", "in_set", "o_orderstatus", values=("F", "O")),
    Rule("priority_high", "regex", "o_orderpriority", pattern="^[1-3]-"),
)
SQL_BROKEN = {
    "customer_given": "o_custkey is null",
    "price_plausible": "o_totalprice < 5000 or o_totalprice > 450000",
    "status_known": "o_orderstatus not in ('F', 'O')",
    "priority_high": "not regexp_matches(o_orderpriority, '^[1-3]-')",
}


@query(
    "dq_row_rules",
    " union all ".join(
        f"select '{n}' as \"rule\", count(*) rows_checked, count(*) filter (where {c}) rows_bad from orders"
        for n, c in SQL_BROKEN.items()
    ),
)
def dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_report(table(spark, sf_dir, "orders"), RULES)


@query(
    "dq_quarantine",
    "select o_orderkey, o_totalprice, concat_ws(',', "
    + ", ".join(f"case when {c} then '{n}' end" for n, c in SQL_BROKEN.items())
    + ") failed_rules from orders",
)
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = with_failed_rules(table(spark, sf_dir, "orders"), RULES)
    return checked.select("o_orderkey", "o_totalprice", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query(
    "dq_unique",
    "select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1",
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_unique(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query(
    "dq_unique_incremental",
    "select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1",
)
def dq_unique_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by delivery, a year of line items each: a key is looked up in the filters of the years before."""
    root, year = work_dir(spark, "unique"), F.year("l_shipdate")
    filters = KeyFilters(spark, f"{root}/filters", LINE_KEY, log_bits=22, probes=4)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, year.alias("year"))
    years = sorted(r[0] for r in lines.select("year").distinct().collect())
    first = F.make_date("year", F.lit(1), F.lit(1))
    for n, y in enumerate(years):
        delivery, day = lines.filter(F.col("year") == y), datetime.date(y, 1, 1)
        layer = read_layer(spark, f"{root}/silver") if n else None
        found = not_unique_with(delivery.drop("year"), day, layer, first, filters)
        write_partitioned(found, f"{root}/found/delivery={y}")
        write_partitioned(delivery, f"{root}/silver", partition_by="year", dynamic=True)
        filters.record(delivery, day)
    # the last delivery that has a key has seen all of its rows
    return spark.read.parquet(f"{root}/found").groupBy(*LINE_KEY).agg(F.max("n").alias("n"))


@query(
    "dq_referential",
    """select o_orderkey, o_custkey, o_totalprice from orders o
    where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)""",
)
def dq_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orphans(orders, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
