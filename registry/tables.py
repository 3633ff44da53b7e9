"""Time, incremental loads, history and streams. Each returns the final table of a scripted sequence of runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry.base import AS_OF_EVENTS, avg_of, money, query, table
from registry.inputs import feed
from registry.models import calendar_sql, fct_sales, span_sql, stamp, stg_customers, stg_tickets, ticket_sales
from tidemark import history, incremental, publish
from tidemark.functions import count_rows, money_sum, ratio
from tidemark.operators import calendar as cal
from tidemark.operators.quality import enforce_contract
from tidemark.plans import demos, staging
from tidemark.session import fresh_path
from tidemark.sources.table import Table
from tidemark.streaming.refresh import Part, RefreshOptions, event_stream, keep_fresh, stream_into

PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
NTZ = "timestamp_ntz"


def ts(text: str):
    return F.lit(text).cast(NTZ)


def orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"), F.trunc("o_orderdate", "year").alias("year_start"),
    )


ORDERS = (
    f"SELECT o_orderkey, o_orderstatus, {PRICE} AS price, CAST(o_orderdate AS DATE) AS day, "
    "CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start FROM orders"
)


def order_span(spark, sf):
    return orders(spark, sf).agg(F.min("day"), F.max("day")).first()


def new_table(spark, label: str, partition_by: str | None = None) -> Table:
    return Table(spark, fresh_path(spark, label), partition_by)


# === calendar ==============================================================================

query("T01_date_spine", "SELECT d AS date_day FROM (" + span_sql("CAST(o_orderdate AS DATE)", "orders")
      + ") WHERE d < (SELECT max(o_orderdate) FROM orders)")(lambda s, d: cal.date_spine(s, *order_span(s, d)))
query("T02_date_spine_inclusive", "SELECT d AS spine_date FROM (" + span_sql("CAST(o_orderdate AS DATE)", "orders") + ")")(
    lambda s, d: cal.date_spine_inclusive(s, *order_span(s, d))
)
query("T03_calendar", calendar_sql(span_sql("CAST(l_shipdate AS DATE)", "lineitem")))(
    lambda s, d: cal.calendar(cal.spine_over(table(s, d, "lineitem"), F.to_date("l_shipdate")))
)
query("T04_time_spine", "SELECT d AS date_day FROM (" + span_sql("CAST(ts AS DATE)", "events") + ")")(
    lambda s, d: cal.spine_over(table(s, d, "events"), F.to_date("ts"))
)

# === incremental ===========================================================================


@query("T05_incremental_filter", ORDERS + " WHERE CAST(o_orderdate AS DATE) > DATE '1999-12-30'")
def incremental_filter(spark, sf):
    target = new_table(spark, "filter")
    target.overwrite(orders(spark, sf).where("day <= DATE '1999-12-30'").groupBy("day").agg(count_rows().alias("n")))
    return incremental.incremental_filter(orders(spark, sf), target, "day", environment="prod")


query("T05_incremental_filter_dev", ORDERS + " WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-10' - 3")(
    lambda s, d: _dev_filter(s, d)
)


def _dev_filter(spark, sf):
    target = new_table(spark, "filter")
    target.overwrite(orders(spark, sf).where("false"))
    return incremental.incremental_filter(orders(spark, sf), target, "day", environment="dev", days=3, as_of="2001-07-10")


def merge_batch(rows):
    """New keys (multiples of 3) and changed ones (1 modulo 7)."""
    return rows.where("o_orderkey % 3 = 0 OR o_orderkey % 7 = 1").withColumns(
        {"price": (F.col("price") + 1).cast("decimal(18,2)"), "o_orderstatus": F.lit("U"),
         "created_at": ts("2001-02-01 00:00:00"), "updated_at": ts("2001-02-01 00:00:00")}
    )


def stamped(rows):
    return rows.withColumns({"created_at": ts("2001-01-01 00:00:00"), "updated_at": ts("2001-01-01 00:00:00")})


@query("T06_merge", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
  CAST(price + CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 7 = 1 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price, day, year_start,
  CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2001-02-01' ELSE TIMESTAMP '2001-01-01' END AS created_at,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 7 = 1 THEN TIMESTAMP '2001-02-01' ELSE TIMESTAMP '2001-01-01' END AS updated_at
FROM ({ORDERS})
""")
def merge(spark, sf):
    target = new_table(spark, "merge", "year_start")
    incremental.merge(target, stamped(orders(spark, sf).where("o_orderkey % 3 <> 0")), "o_orderkey")
    batch = incremental.newer_rows(merge_batch(orders(spark, sf)), target, "updated_at")
    incremental.merge(target, batch, "o_orderkey", update_columns=["price", "updated_at"])
    # A second delivery of the same rows has nothing past the watermark and changes nothing.
    again = incremental.newer_rows(merge_batch(orders(spark, sf)), target, "updated_at")
    incremental.merge(target, again, "o_orderkey", update_columns=["price", "updated_at"])
    return target.read()


@query("T06_merge_window", f"""
WITH o AS ({ORDERS})
SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 1 AND day >= DATE '2000-01-01' THEN CAST(price + 1 AS DECIMAL(18,2)) ELSE price END AS price)
FROM o UNION ALL
SELECT * REPLACE (CAST(price + 1 AS DECIMAL(18,2)) AS price) FROM o WHERE o_orderkey % 7 = 1 AND day < DATE '2000-01-01'
""")
def merge_window(spark, sf):
    target = new_table(spark, "merge", "year_start")
    rows = orders(spark, sf)
    incremental.merge(target, rows, "o_orderkey")
    batch = rows.where("o_orderkey % 7 = 1").withColumn("price", (F.col("price") + 1).cast("decimal(18,2)"))
    incremental.merge(
        target, batch, "o_orderkey", update_columns=["price"], since=dt.date(2000, 1, 1), outside="insert"
    )
    return target.read()


@query("T06_merge_text_partition", f"""
SELECT o_orderkey, o_orderstatus, CAST(price + CASE WHEN o_orderkey % 7 = 1 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price, bucket FROM (
  SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus || ':' || (o_orderkey % 4) || '/%' END AS bucket FROM ({ORDERS}))
""")
def merge_text_partition(spark, sf):
    """Partition values with characters that directory names cannot hold."""
    key = F.col("o_orderkey")
    text = F.concat("o_orderstatus", F.lit(":"), (key % 4).cast("string"), F.lit("/%"))
    rows = orders(spark, sf).select("o_orderkey", "o_orderstatus", "price", F.when(key % 10 != 0, text).alias("bucket"))
    target = new_table(spark, "merge", "bucket")
    incremental.merge(target, rows.where("o_orderkey % 7 <> 2"), "o_orderkey")
    later = rows.where("o_orderkey % 7 IN (1, 2)")
    raised = F.when(key % 7 == 1, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
    for _ in range(2):
        incremental.merge(target, later.withColumn("price", raised), "o_orderkey")
    return target.read()


@query("T07_merge_all_columns", f"""
SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM ({ORDERS})
""")
def merge_all_columns(spark, sf):
    target = new_table(spark, "merge")
    rows = orders(spark, sf)
    incremental.merge(target, rows.where("o_orderkey % 2 = 0"), "o_orderkey")
    later = rows.where("o_orderkey % 2 = 1 OR o_orderkey % 5 = 0").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus"))
    )
    incremental.merge(target, later, "o_orderkey")
    return target.read()


@query("T08_append", "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem")
def append(spark, sf):
    source = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    target = new_table(spark, "append")
    for cut_off in ("1998-01-01", "2000-06-01", "2010-01-01"):
        arrived = source.where(F.col("l_shipdate") < ts(cut_off))
        incremental.append(target, incremental.newer_rows(arrived, target, "l_shipdate", "1900-01-01"))
    return target.read()


DAILY = f"SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, count(*) AS n, {money(f'sum({PRICE})')} AS total FROM orders GROUP BY ALL"


@query("T09_delete_insert", f"""
WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS top FROM orders WHERE o_orderdate < DATE '2001-06-30')
SELECT day, o_orderpriority, CASE WHEN day >= top - 3 THEN n ELSE n + 100 END AS n, total FROM ({DAILY}), m
""")
def delete_insert(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(
        count_rows().alias("n"), money_sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    target = new_table(spark, "days")
    first = daily.where("day < DATE '2001-06-30'").withColumn("n", F.col("n") + 100)
    incremental.delete_insert(target, first, "day")
    incremental.delete_insert(target, incremental.look_back_rows(daily, target, "day", 3), "day")
    return target.read()


def monthly(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        F.trunc("l_shipdate", "year").alias("year_start"), F.trunc("l_shipdate", "month").alias("month_start"), "l_returnflag"
    ).agg(count_rows().alias("n"), money_sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"))


MONTHLY = f"""SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS year_start, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
  l_returnflag, count(*) AS n, {money('sum(CAST(l_extendedprice AS DECIMAL(18,2)))')} AS total FROM lineitem GROUP BY ALL"""


@query("T10_insert_overwrite_partitions", f"SELECT * REPLACE (CASE WHEN year_start >= DATE '2000-01-01' THEN n ELSE n + 1 END AS n) FROM ({MONTHLY})")
def insert_overwrite_partitions(spark, sf):
    target = new_table(spark, "months", "year_start")
    incremental.insert_overwrite(target, monthly(spark, sf).withColumn("n", F.col("n") + 1))
    incremental.insert_overwrite(target, monthly(spark, sf).where("year_start >= DATE '2000-01-01'"), "partitions")
    return target.read()


@query("T10_insert_overwrite_table", f"SELECT * FROM ({MONTHLY}) WHERE month_start >= DATE '2001-06-01'")
def insert_overwrite_table(spark, sf):
    target = new_table(spark, "months")
    incremental.insert_overwrite(target, monthly(spark, sf), "table")
    recent = incremental.month_window(monthly(spark, sf), "month_start", as_of="2001-07-20")
    incremental.insert_overwrite(target, recent, "table")
    return target.read()


def event_days(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "value", F.to_date("ts").alias("event_date"))


EVENT_DAYS = "SELECT event_id, ts, event_type, value, CAST(ts AS DATE) AS event_date FROM events"


@query("T11_microbatch", f"SELECT * REPLACE (CASE WHEN ts >= DATE '2024-01-24' THEN value + 1 ELSE value END AS value) FROM ({EVENT_DAYS})")
def microbatch(spark, sf):
    target = new_table(spark, "batches", "event_date")
    begin, first_end, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 28), dt.datetime(2024, 2, 1)
    incremental.microbatch(target, event_days(spark, sf), "ts", begin, first_end)
    corrected = event_days(spark, sf).withColumn("value", F.col("value") + 1)
    incremental.microbatch(target, corrected, "ts", begin, end, look_back=3)
    return target.read()


@query("T11_microbatch_hour", f"""
SELECT * REPLACE (CASE WHEN ts >= (SELECT date_trunc('hour', max(ts)) - INTERVAL 2 HOUR FROM events WHERE ts < TIMESTAMP '2024-01-20 07:00:00')
  THEN value + 1 ELSE value END AS value) FROM ({EVENT_DAYS}) WHERE ts < TIMESTAMP '2024-01-20 12:00:00'
""")
def microbatch_hour(spark, sf):
    """Hours of a table that is partitioned by day: the last two loaded hours are taken in again."""
    target = new_table(spark, "batches", "event_date")
    begin, first_end, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20, 7), dt.datetime(2024, 1, 20, 12)
    incremental.microbatch(target, event_days(spark, sf), "ts", begin, first_end, size="hour")
    corrected = event_days(spark, sf).withColumn("value", F.col("value") + 1)
    incremental.microbatch(target, corrected, "ts", begin, end, look_back=2, size="hour")
    return target.read()


# A source that changes between two runs: `value` is new, `old` is gone, event_id has become a text.
def before_change(spark, sf):
    return event_days(spark, sf).drop("value").withColumn("old", F.lit(1))


def after_change(spark, sf):
    return event_days(spark, sf).withColumn("event_id", F.col("event_id").cast("string"))


@query("T11_microbatch_synced_columns", f"""
SELECT event_id, ts, event_type, CASE WHEN ts >= DATE '2024-01-24' THEN value END AS value, event_date FROM ({EVENT_DAYS})
""")
def microbatch_synced(spark, sf):
    """Days: the table takes the columns of the source; what is not loaded again has none of the new one."""
    target = new_table(spark, "batches", "event_date")
    begin, first_end, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 28), dt.datetime(2024, 2, 1)
    incremental.microbatch(target, before_change(spark, sf), "ts", begin, first_end)
    incremental.microbatch(target, after_change(spark, sf), "ts", begin, end, look_back=3)
    return target.read()


HOURS_AGAIN = "ts >= (SELECT date_trunc('hour', max(ts)) - INTERVAL 2 HOUR FROM events WHERE ts < TIMESTAMP '2024-01-20 07:00:00')"


@query("T11_microbatch_hour_appended_columns", f"""
SELECT *  REPLACE (CASE WHEN {HOURS_AGAIN} THEN value END AS value), CAST(CASE WHEN NOT {HOURS_AGAIN} THEN 1 END AS INT) AS old
FROM ({EVENT_DAYS}) WHERE ts < TIMESTAMP '2024-01-20 12:00:00'
""")
def microbatch_hour_appended(spark, sf):
    """Hours: new columns are added, lost ones stay and are empty from then on."""
    target = new_table(spark, "batches", "event_date")
    begin, first_end, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20, 7), dt.datetime(2024, 1, 20, 12)
    rule = dict(size="hour", on_schema_change="append_new_columns")
    incremental.microbatch(target, before_change(spark, sf), "ts", begin, first_end, **rule)
    incremental.microbatch(target, after_change(spark, sf), "ts", begin, end, look_back=2, **rule)
    return target.read()


@query("T11_microbatch_stream", "SELECT event_id, event_type, CAST(ts AS DATE) AS event_date FROM events")
def microbatch_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = event_stream(spark, sf, schema, "ts", glob="events.parquet")
    rows = stream.select("event_id", "event_type", F.to_date("ts").alias("event_date"))
    target = new_table(spark, "stream", "event_date")
    stream_into(rows, target, fresh_path(spark, "state")).awaitTermination()
    return target.read()


@query("T12_late_look_back", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(CAST(ts AS DATE)) FROM events WHERE ts < DATE '2024-01-20') - 3")
def late_look_back(spark, sf):
    source = table(spark, sf, "events").select("event_id", "ts")
    target = new_table(spark, "late")
    target.overwrite(source.where("ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"))
    return incremental.look_back_rows(source, target, "ts", days=3)


# --- schema drift --------------------------------------------------------------------------


def drift_source(spark, sf, where):
    return ticket_sales(spark, sf).where(where)


SALES = """SELECT sale_id, customer_id, ticket_id, purchase_date, visit_date, ticket_price, discount_percent,
  discount_category, updated_at FROM ticket_sales_q"""


@query("T13_append_new_columns", f"""
SELECT * REPLACE (CASE WHEN sale_id % 3 = 2 THEN NULL ELSE discount_category END AS discount_category),
  CASE WHEN sale_id % 3 = 1 THEN discount_percent >= 20 END AS is_deep_discount FROM ({SALES})
""")
def append_new_columns(spark, sf):
    target = new_table(spark, "drift")
    rule = dict(key="sale_id", on_schema_change="append_new_columns")
    incremental.merge(target, demos.drifting_sales(drift_source(spark, sf, "sale_id % 3 = 0")), **rule)
    incremental.merge(target, demos.drifting_sales(drift_source(spark, sf, "sale_id % 3 = 1"), "add_new_column"), **rule)
    incremental.merge(target, demos.drifting_sales(drift_source(spark, sf, "sale_id % 3 = 2"), "drop_legacy_column"), **rule)
    return target.read()


@query("T14_sync_all_columns", f"SELECT * EXCLUDE (discount_category) FROM ({SALES})")
def sync_all_columns(spark, sf):
    target = new_table(spark, "drift")
    rule = dict(key="sale_id", on_schema_change="sync_all_columns")
    incremental.merge(target, demos.drifting_sales(drift_source(spark, sf, "sale_id % 3 = 0")), **rule)
    incremental.merge(target, demos.drifting_sales(drift_source(spark, sf, "sale_id % 3 = 1"), "add_new_column"), **rule)
    incremental.merge(target, demos.drifting_sales(drift_source(spark, sf, "sale_id % 3 = 2"), "drop_legacy_column"), **rule)
    return target.read()


@query("T15_contracted_incremental", f"""
SELECT * EXCLUDE (discount_category), CASE WHEN sale_id % 2 = 1 THEN discount_percent >= 20 END AS is_deep_discount FROM ({SALES})
""")
def contracted_incremental(spark, sf):
    target = new_table(spark, "contract")
    contract = demos.contracted_sales(ticket_sales(spark, sf)).schema
    for where, mode in (("sale_id % 2 = 0", "baseline"), ("sale_id % 2 = 1", "add_new_column")):
        batch = demos.contracted_sales(drift_source(spark, sf, where), mode)
        incremental.merge(target, enforce_contract(batch, contract), "sale_id", on_schema_change="append_new_columns")
    return target.read()


# === auto-refreshed aggregate ==============================================================

FRESH = f"SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, {money('sum(CAST(value AS DECIMAL(10,2)))')} AS total FROM events GROUP BY ALL"


def refreshed(spark, sf, mode: str):
    # Two files and one file per trigger, so the aggregate is really maintained over batches.
    folder = fresh_path(spark, "feed")
    table(spark, sf, "events").repartition(2, "user_id").write.parquet(folder)
    schema = table(spark, sf, "events").schema
    stream = event_stream(spark, folder, schema, "ts", files_per_batch=1)
    rows = stream.select(
        F.trunc("ts", "week").alias("week_start"), F.to_date("ts").alias("day"), "event_type",
        F.col("value").cast("decimal(10,2)").alias("amount"),
    )
    # By day the aggregate is added up in slots; the full mode writes it anew at each trigger.
    target = new_table(spark, "fresh", "week_start" if mode == "FULL" else "slot")
    measures = {"n": Part(count_rows()), "total": Part(money_sum("amount"))}
    keep_fresh(rows, ["week_start", "day", "event_type"], measures, target, RefreshOptions("1 minute", mode), fresh_path(spark, "state"), once=True).awaitTermination()
    return target.read().select("day", "event_type", "n", "total")


query("T16_refresh_incremental", FRESH)(lambda s, d: refreshed(s, d, "INCREMENTAL"))
query("T16_refresh_full", FRESH)(lambda s, d: refreshed(s, d, "FULL"))


@query("demo_27_outlets_kept_fresh", f"""
SELECT visit_date, category, location, count(*) AS transaction_count, {money('sum(total_amount)')} AS total_revenue,
  {avg_of('total_amount', None)} AS avg_transaction_value, min(total_amount) AS min_transaction_value,
  max(total_amount) AS max_transaction_value FROM raw_pos GROUP BY ALL
""")
def outlets_kept_fresh(spark, sf):
    """The same aggregate by outlet, added to file by file."""
    folder = fresh_path(spark, "feed")
    fct_sales(spark, sf).select("visit_date", "category", "location", "total_amount").repartition(3, "visit_date").write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    target = new_table(spark, "outlets", "slot")
    measures = {
        "transaction_count": Part(count_rows()), "total_revenue": Part(money_sum("total_amount")),
        "min_transaction_value": Part(F.min("total_amount"), F.min), "max_transaction_value": Part(F.max("total_amount"), F.max),
    }
    keep_fresh(stream, ["visit_date", "category", "location"], measures, target, RefreshOptions("1 minute"),
               fresh_path(spark, "state"), once=True, slots=8).awaitTermination()
    average = ratio(F.col("total_revenue"), F.col("transaction_count")).alias("avg_transaction_value")
    return target.read().select("visit_date", "category", "location", *measures, average)


# === history ===============================================================================

FIRST, SECOND = "2002-01-01 00:00:00", "2002-02-01 00:00:00"


def snapshot_sql(source: str, key: str, new: str, gone: str, change: dict[str, str], compared: list[str], hard: bool) -> str:
    """History after two runs of the check strategy: rows `new` arrive with, rows `gone` leave before the second run."""
    replaced = ", ".join(f"{e} AS {c}" for c, e in change.items())
    differs = " OR ".join(f"v1.{c} IS DISTINCT FROM v2.{c}" for c in compared)
    def meta(alias: str, at: str) -> str:
        return (f"md5({alias}.{key} || '|' || '{at}') AS dbt_scd_id, TIMESTAMP '{at}' AS dbt_updated_at, "
                f"TIMESTAMP '{at}' AS dbt_valid_from")
    left = f"TIMESTAMP '{SECOND}'" if hard else "CAST(NULL AS TIMESTAMP)"
    return f"""
WITH v1 AS (SELECT * FROM {source} WHERE NOT coalesce({new}, false)),
v2 AS (SELECT * REPLACE ({replaced}) FROM {source} WHERE NOT coalesce({gone}, false))
SELECT v1.*, {meta('v1', FIRST)}, CASE WHEN v2.{key} IS NULL THEN {left} WHEN {differs} THEN TIMESTAMP '{SECOND}' END AS dbt_valid_to
FROM v1 LEFT JOIN v2 ON v1.{key} = v2.{key}
UNION ALL SELECT v2.*, {meta('v2', SECOND)}, NULL FROM v2 LEFT JOIN v1 ON v1.{key} = v2.{key} WHERE v1.{key} IS NULL OR {differs}
"""


def two_runs(spark, source, key: str, new: str, gone: str, change: dict, **rule) -> history.History:
    kept = history.History(spark, fresh_path(spark, "history"), key, **rule)
    kept.take(source.where(f"NOT coalesce({new}, false)"), FIRST)
    kept.take(source.where(f"NOT coalesce({gone}, false)").withColumns(change), SECOND)
    return kept


CUSTOMER_RULE = ("c_custkey", "c_custkey % 11 = 0", "c_custkey % 13 = 0")
CUSTOMER_SQL = dict(change={"c_acctbal": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END"}, compared=["c_acctbal", "c_name"])


def customer_history(spark, sf, hard: bool) -> history.History:
    change = {"c_acctbal": F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal"))}
    return two_runs(spark, table(spark, sf, "customer"), *CUSTOMER_RULE, change, check_columns=["c_acctbal", "c_name"], hard_deletes=hard)


query("T17_scd2_check", snapshot_sql("customer", *CUSTOMER_RULE, **CUSTOMER_SQL, hard=False))(
    lambda s, d: customer_history(s, d, False).read()
)


def stamped_snapshot_sql(source: str, key: str, new: str, gone: str, change: dict[str, str], hard: bool) -> str:
    """History after two runs of the timestamp strategy over the column updated_at."""
    replaced = ", ".join(f"{e} AS {c}" for c, e in change.items())
    def meta(alias: str) -> str:
        return (f"md5({alias}.{key} || '|' || {alias}.updated_at) AS dbt_scd_id, {alias}.updated_at AS dbt_updated_at, "
                f"{alias}.updated_at AS dbt_valid_from")
    left = f"TIMESTAMP '{SECOND}'" if hard else "CAST(NULL AS TIMESTAMP)"
    return f"""
WITH v1 AS (SELECT * FROM {source} WHERE NOT coalesce({new}, false)),
v2 AS (SELECT * REPLACE ({replaced}) FROM {source} WHERE NOT coalesce({gone}, false))
SELECT v1.*, {meta('v1')}, CASE WHEN v2.{key} IS NULL THEN {left} WHEN v2.updated_at > v1.updated_at THEN v2.updated_at END AS dbt_valid_to
FROM v1 LEFT JOIN v2 ON v1.{key} = v2.{key}
UNION ALL SELECT v2.*, {meta('v2')}, NULL FROM v2 LEFT JOIN v1 ON v1.{key} = v2.{key}
WHERE v1.{key} IS NULL OR v2.updated_at > v1.updated_at
"""


@query("T18_scd2_timestamp", stamped_snapshot_sql(
    "(SELECT o_orderkey, o_orderstatus, o_orderdate AS updated_at FROM orders)", "o_orderkey", "o_orderkey % 11 = 0",
    "o_orderkey % 13 = 0",
    {"o_orderstatus": "'Z'", "updated_at": "CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2002-01-15' ELSE updated_at END"}, False))
def scd2_timestamp(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("updated_at"))
    # Edits without a newer stamp stay unseen.
    change = {
        "o_orderstatus": F.lit("Z"),
        "updated_at": F.when(F.col("o_orderkey") % 5 == 0, ts("2002-01-15 00:00:00")).otherwise(F.col("updated_at")),
    }
    return two_runs(spark, rows, "o_orderkey", "o_orderkey % 11 = 0", "o_orderkey % 13 = 0", change, updated_at="updated_at").read()


query("T19_hard_deletes", snapshot_sql("customer", *CUSTOMER_RULE, **CUSTOMER_SQL, hard=True))(
    lambda s, d: customer_history(s, d, True).read()
)


GROWN_SQL = snapshot_sql("(SELECT *, CAST(NULL AS VARCHAR) AS c_grade FROM customer)", *CUSTOMER_RULE,
                         CUSTOMER_SQL["change"] | {"c_grade": "CASE WHEN c_acctbal > 5000 THEN 'high' ELSE 'low' END"},
                         CUSTOMER_SQL["compared"], False)


@query("T17_scd2_new_column", GROWN_SQL)
def scd2_new_column(spark, sf):
    """The second run's source has a column more: NULL in the rows of the first."""
    grade = F.when(F.col("c_acctbal") > 5000, "high").otherwise("low")
    change = {"c_grade": grade, "c_acctbal": F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal"))}
    return two_runs(spark, table(spark, sf, "customer"), *CUSTOMER_RULE, change, check_columns=CUSTOMER_SQL["compared"]).read()


query("T20_current_rows", "SELECT * FROM (" + snapshot_sql("customer", *CUSTOMER_RULE, **CUSTOMER_SQL, hard=True) + ") WHERE dbt_valid_to IS NULL")(
    lambda s, d: history.current_rows(customer_history(s, d, True).read())
)
query("T21_scd_columns", "SELECT c_custkey, c_name, dbt_scd_id, dbt_updated_at, dbt_valid_from, dbt_valid_to, "
      "dbt_valid_to IS NULL AS is_current_record FROM (" + snapshot_sql("customer", *CUSTOMER_RULE, **CUSTOMER_SQL, hard=True) + ")")(
    lambda s, d: history.scd_columns(customer_history(s, d, True).read(), "c_custkey", "c_name")
)

CHECKED = [
    "first_name", "last_name", "email", "phone", "address", "city", "state", "zip_code", "is_vip_member",
    "marketing_opt_in", "loyalty_points",
]
query("snp_customers", snapshot_sql("stg_customers_q", "customer_id", "customer_id % 11 = 0", "customer_id % 13 = 0",
      {"loyalty_points": "CASE WHEN customer_id % 6 = 0 THEN loyalty_points + 50 ELSE loyalty_points END", "age": "age + 1"}, CHECKED, True))(
    lambda s, d: two_runs(
        s, stg_customers(s, d), "customer_id", "customer_id % 11 = 0", "customer_id % 13 = 0",
        {"loyalty_points": F.col("loyalty_points") + F.when(F.col("customer_id") % 6 == 0, 50).otherwise(0), "age": F.col("age") + 1},
        check_columns=CHECKED, hard_deletes=True,
    ).read()
)
query("snp_employees", stamped_snapshot_sql("stg_employees_q", "employee_id", "employee_id % 11 = 0", "employee_id % 13 = 0",
      {"updated_at": "CASE WHEN employee_id % 5 = 0 THEN TIMESTAMP '2002-01-15' ELSE updated_at END"}, True))(
    lambda s, d: two_runs(
        s, staging.employees(feed(s, d, "raw_employees")), "employee_id", "employee_id % 11 = 0", "employee_id % 13 = 0",
        {"updated_at": F.when(F.col("employee_id") % 5 == 0, ts("2002-01-15 00:00:00")).otherwise(F.col("updated_at"))},
        updated_at="updated_at", hard_deletes=True,
    ).read()
)
query("snp_rides", stamped_snapshot_sql("stg_rides_q", "ride_id", "ride_id % 11 = 0", "ride_id % 13 = 0",
      {"updated_at": "CASE WHEN ride_id % 5 = 0 THEN TIMESTAMP '2002-01-15' ELSE updated_at END"}, False))(
    lambda s, d: two_runs(
        s, staging.rides(feed(s, d, "raw_rides")), "ride_id", "ride_id % 11 = 0", "ride_id % 13 = 0",
        {"updated_at": F.when(F.col("ride_id") % 5 == 0, ts("2002-01-15 00:00:00")).otherwise(F.col("updated_at"))},
        updated_at="updated_at",
    ).read()
)
query("snp_house_attributes", snapshot_sql("houses_q", "haunted_house_id", "haunted_house_id % 11 = 0", "haunted_house_id % 13 = 0",
      {"capacity": "CASE WHEN haunted_house_id % 4 = 0 THEN capacity + 10 ELSE capacity END"}, ["haunted_house_name", "capacity", "fear_level"], False))(
    lambda s, d: two_runs(
        s, staging.haunted_houses(feed(s, d, "raw_rides")), "haunted_house_id", "haunted_house_id % 11 = 0", "haunted_house_id % 13 = 0",
        {"capacity": F.col("capacity") + F.when(F.col("haunted_house_id") % 4 == 0, 10).otherwise(0)},
        check_columns=["haunted_house_name", "capacity", "fear_level"],
    ).read()
)
PRICED = f"(SELECT ticket_type AS ticket_type_name, CAST({avg_of('base_price')} AS DECIMAL(10,2)) AS price FROM raw_tickets GROUP BY ticket_type)"
query("snp_product_pricing_history", snapshot_sql(PRICED, "ticket_type_name", "ticket_type_name = 'group_pass'", "ticket_type_name = 'day_pass'",
      {"price": "CASE WHEN ticket_type_name = 'annual_pass' THEN CAST(price + 5 AS DECIMAL(10,2)) ELSE price END"}, ["price"], False))(
    # Keyed by name: the type number is a rank that changes when a type is added.
    lambda s, d: two_runs(
        s, staging.ticket_types(feed(s, d, "raw_tickets"), stamp()).select("ticket_type_name", "price"), "ticket_type_name",
        "ticket_type_name = 'group_pass'", "ticket_type_name = 'day_pass'",
        {"price": (F.col("price") + F.when(F.col("ticket_type_name") == "annual_pass", 5).otherwise(0)).cast("decimal(10,2)")},
        check_columns=["price"],
    ).read()
)
query("snp_ticket_sales_history", snapshot_sql("(FROM online_q UNION ALL FROM physical_q)", "sale_id", "sale_id % 11 = 0", "sale_id % 13 = 0",
      {"payment_method": "CASE WHEN sale_id % 4 = 0 THEN 'voucher' ELSE payment_method END"}, ["ticket_price", "discount_percent", "payment_method"], False))(
    lambda s, d: two_runs(
        s, staging.online_sales(feed(s, d, "raw_tickets")).unionByName(staging.physical_sales(feed(s, d, "raw_tickets"))), "sale_id",
        "sale_id % 11 = 0", "sale_id % 13 = 0",
        {"payment_method": F.when(F.col("sale_id") % 4 == 0, "voucher").otherwise(F.col("payment_method"))},
        check_columns=["ticket_price", "discount_percent", "payment_method"],
    ).read()
)
query("snp_visitor_feedback_changes", snapshot_sql("haunted_feedback_q", "feedback_id", "feedback_id % 11 = 0", "feedback_id % 13 = 0",
      {"would_recommend": "CASE WHEN feedback_id % 4 = 0 THEN NULL ELSE would_recommend END"}, ["satisfaction_rating", "would_recommend"], False))(
    lambda s, d: two_runs(
        s, staging.haunted_feedback(feed(s, d, "raw_feedback"), feed(s, d, "raw_rides")), "feedback_id", "feedback_id % 11 = 0",
        "feedback_id % 13 = 0", {"would_recommend": F.when(F.col("feedback_id") % 4 != 0, F.col("would_recommend"))},
        check_columns=["satisfaction_rating", "would_recommend"],
    ).read()
)

# === freshness, weeks ======================================================================


@query("T22_freshness", f"""
WITH t AS (
  SELECT 'events' AS source, max(ts) AS m, 43200 AS w, 86400 AS e FROM events
  UNION ALL SELECT 'clicks', max(ts), 30 * 86400, 60 * 86400 FROM events WHERE event_type = 'click' AND ts >= DATE '2024-01-10'
  UNION ALL SELECT 'orders', max(o_orderdate), 7 * 86400, 10000 * 86400 FROM orders)
SELECT source, m AS max_loaded_at, datediff('second', m, TIMESTAMP '{AS_OF_EVENTS}') AS age_seconds,
  CASE WHEN datediff('second', m, TIMESTAMP '{AS_OF_EVENTS}') > e THEN 'error'
       WHEN datediff('second', m, TIMESTAMP '{AS_OF_EVENTS}') > w THEN 'warn' ELSE 'pass' END AS status FROM t
UNION ALL SELECT 'suppliers', NULL, NULL, 'disabled'
""")
def freshness(spark, sf):
    now = ts(f"{AS_OF_EVENTS} 00:00:00")
    day = dt.timedelta(days=1)
    events, orders_ = table(spark, sf, "events"), table(spark, sf, "orders")
    rules = [
        ("events", events, publish.Freshness("ts", day / 2, day)),
        ("clicks", events, publish.Freshness("ts", 30 * day, 60 * day, "event_type = 'click' AND ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")),
        ("orders", orders_, publish.Freshness("o_orderdate", 7 * day, 10000 * day)),
        ("suppliers", table(spark, sf, "supplier"), None),
    ]
    return incremental.union_all([publish.freshness(name, df, rule, now) for name, df, rule in rules])


@query("T23_weekly_running_revenue", f"""
SELECT *, {money('sum(total_revenue) OVER (PARTITION BY ticket_type ORDER BY week_start ROWS UNBOUNDED PRECEDING)')} AS running_revenue_by_type
FROM (SELECT CAST(date_trunc('week', visit_date) AS DATE) AS week_start, 'Mon' AS week_start_day, ticket_type,
  count(*) AS visit_count, {money('sum(final_price)')} AS total_revenue, {avg_of('final_price')} AS avg_spend_per_visit,
  CAST(NULL AS DECIMAL(28,2)) AS avg_rating FROM raw_tickets GROUP BY ALL)
""")
def weekly_running_revenue(spark, sf):
    tickets = stg_tickets(spark, sf).withColumnRenamed("final_price", "total_visit_spend")
    return demos.weekly_revenue(tickets.withColumn("avg_rating", F.lit(None).cast("double")))
