"""Scans, projections, joins, aggregates, windows, sorting, sets and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from registry.base import avg_of, money, query, rd, table
from registry.inputs import pos_with_customer
from registry.models import dim_customers, orders_calendar, stg_tickets
from tidemark.functions import (
    cast_price, contains_any, count_rows, days_between, halloween_bucket, mean, money_mean, money_sum, months_between_dates,
    percent, quotient, ratio,
)
from tidemark.metrics import Catalog, Metric, SemanticModel
from tidemark.operators import compare, joins, projection, ranks
from tidemark.operators.calendar import numbered_days
from tidemark.session import fresh_path
from tidemark.sources import readers, writers
from tidemark.sources.table import Table

CENTS = "CAST({} AS DECIMAL(18,2))"
PRICE = CENTS.format("o_totalprice")
LINE_PRICE = CENTS.format("l_extendedprice")


def orders(spark, sf):
    """Orders with the price as an exact decimal and the order day."""
    return table(spark, sf, "orders").withColumns(
        {"price": F.col("o_totalprice").cast("decimal(18,2)"), "day": F.to_date("o_orderdate")}
    )


def lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))


def events(spark, sf):
    return table(spark, sf, "events").withColumns(
        {"amount": F.col("value").cast("decimal(18,2)"), "day": F.to_date("ts")}
    )


# === scans, sources, sinks =================================================================

CSV_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("o_orderdate", TimestampNTZType()), StructField("o_orderpriority", StringType()),
])


@query("S01_read_csv", "FROM orders")
def read_csv(spark, sf):
    path = fresh_path(spark, "csv")
    table(spark, sf, "orders").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, CSV_SCHEMA)


@query("S02_source_alias", """
SELECT 'online' AS channel, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'physical', count(*) FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def source_alias(spark, sf):
    known = readers.Sources(spark, {"online": f"{sf}/orders.parquet"}).alias("physical", of="online")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    online = known.table("online").where(urgent).agg(F.lit("online").alias("channel"), count_rows().alias("n"))
    physical = known.table("physical").where(~urgent).agg(F.lit("physical").alias("channel"), count_rows().alias("n"))
    return online.unionByName(physical)


query("S03_event_time_window", """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'
""")(lambda s, d: readers.event_window(
    table(s, d, "events"), "ts", "2024-01-10 00:00:00", "2024-01-17 00:00:00"
).select("event_id", "ts", "user_id", "event_type"))

REGION_CODES = [("AF", "AFRICA"), ("AM", "AMERICA"), ("AS", "ASIA"), ("EU", "EUROPE")]


@query("S04_inline_values", """
SELECT n_nationkey, n_name, code FROM nation JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (VALUES ('AF', 'AFRICA'), ('AM', 'AMERICA'), ('AS', 'ASIA'), ('EU', 'EUROPE')) v(code, name) ON name = r_name
""")
def inline_values(spark, sf):
    codes = F.broadcast(readers.inline_rows(spark, REGION_CODES))  # four constant rows
    named = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.join(codes, F.col("col2") == F.col("r_name"), "left").select(
        "n_nationkey", "n_name", F.col("col1").alias("code")
    )


@query("S05_row_generator", """
SELECT g AS seq, CAST((SELECT min(o_orderdate) FROM orders) AS DATE) + CAST(g AS INT) AS spine_date
FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS g)
""")
def row_generator(spark, sf):
    source = orders(spark, sf)
    n, first = source.agg(count_rows(), F.min("day")).first()
    return readers.generated_rows(spark, n).withColumn(
        "spine_date", F.date_add(F.lit(first), F.col("seq").cast("int"))
    )


query("S06_view", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")(
    lambda s, d: writers.as_view(table(s, d, "orders").groupBy("o_orderstatus").agg(count_rows().alias("n")), "status_counts")
)
query("S07_ephemeral", f"""
SELECT l_returnflag, {money(f'sum({LINE_PRICE})')} AS total FROM lineitem WHERE l_quantity > 10 GROUP BY ALL
""")(lambda s, d: lines(s, d).where("l_quantity > 10").groupBy("l_returnflag").agg(money_sum("price").alias("total")))


@query("S08_create_table_as", f"""
SELECT o_custkey, count(*) AS n, {money(f'sum({PRICE})')} AS total FROM orders GROUP BY ALL
""")
def create_table_as(spark, sf):
    built = orders(spark, sf).groupBy("o_custkey").agg(count_rows().alias("n"), money_sum("price").alias("total"))
    return writers.create_table_as(built, fresh_path(spark, "ctas"))


@query("S09_temp_table", """
SELECT o_orderpriority, count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY ALL
""")
def temp_table(spark, sf):
    summary = orders(spark, sf).groupBy("o_orderpriority").agg(count_rows().alias("n"), F.min("day").alias("first_day"))
    return writers.temp_table(summary, "order_summary")


@query("S10_event_log", """
SELECT event_id, ts, event_type, CAST(ts AS DATE) AS event_date FROM events
WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 7
""")
def event_log(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type")
    log = writers.EventLog(spark, fresh_path(spark, "log"), "ts", retention_days=7)
    log.append(rows.where("event_id % 2 = 0"))
    log.append(rows.where("event_id % 2 = 1"))
    log.expire(as_of=rows.agg(F.max(F.to_date("ts"))).first()[0])
    return log.read()


@query("S11_insert_select", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def insert_select(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = Table(spark, fresh_path(spark, "insert"))
    target.overwrite(rows.where("o_orderstatus = 'F'"))
    target.append(rows.where("o_orderstatus <> 'F'").select("o_orderstatus", "o_custkey", "o_orderkey"))
    return target.read()


@query("S12_truncate", "SELECT o_orderkey, o_custkey FROM orders WHERE false")
def truncate(spark, sf):
    target = Table(spark, fresh_path(spark, "truncate"))
    target.overwrite(table(spark, sf, "orders").select("o_orderkey", "o_custkey"))
    target.truncate()
    return target.read()


query("S13_variant", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")(lambda s, d: readers.with_variant(table(s, d, "events"), "props", "parsed").select(
    "event_id", F.variant_get("parsed", "$.k", "bigint").alias("k")
))


@query("S14_declared_schema", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def declared_schema(spark, sf):
    declared = StructType([
        StructField("o_orderkey", LongType(), False), StructField("o_custkey", LongType(), False),
        StructField("o_orderdate", DateType(), True),
    ])
    return readers.declare(table(spark, sf, "orders"), declared)


# === projection, filter, predicate =========================================================

query("P01_base_model", f"""
SELECT l_orderkey AS order_id, CAST(l_quantity AS INT) AS quantity, l_returnflag = 'R' AS is_returned,
  {CENTS.format('l_tax')} AS tax, CAST(l_linenumber AS BIGINT) + 1 AS next_line, 'run-1' AS dbt_run_id, 'base' AS dbt_model_name,
  'dev' AS dbt_env, TIMESTAMP '2002-01-01 00:00:00' AS dbt_updated_at
FROM lineitem WHERE l_quantity > 5
""")(lambda s, d: projection.base_model(
    table(s, d, "lineitem"),
    {"l_orderkey": "order_id", "l_quantity": "quantity", "(l_returnflag = 'R')": "is_returned", "l_tax": "tax"},
    where="l_quantity > 5",
    casts={"quantity": "int", "tax": "decimal(18,2)"},
    extra_expressions={"CAST(l_linenumber AS BIGINT) + 1": "next_line"},
    audit=projection.audit_columns("run-1", "base", "dev", F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")),
))
query("P02_columns_except", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")(
    lambda s, d: projection.columns_except(table(s, d, "customer"), ["C_ACCTBAL", "c_name"])
)
query("P03_cast_price", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS price, "
      "CAST(o_totalprice AS DECIMAL(12,4)) AS fine FROM orders")(
    lambda s, d: table(s, d, "orders").select(
        "o_orderkey", cast_price("o_totalprice").alias("price"), cast_price("o_totalprice", 12, 4).alias("fine")
    )
)
query("P04_typed_null", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS DECIMAL(10,2)) AS credit FROM customer")(
    lambda s, d: table(s, d, "customer").select(
        "c_custkey", projection.null_of("string").alias("address"), projection.null_of("decimal(10,2)").alias("credit")
    )
)
query("P05_searched_case", """
SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END AS size
FROM orders
""")(lambda s, d: table(s, d, "orders").select(
    "o_orderkey",
    F.when(F.col("o_totalprice") < 100000, "small").when(F.col("o_totalprice") < 300000, "medium").otherwise("large").alias("size"),
))


@query("P06_simple_case", "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 5 WHEN 'LARGE' THEN 4 WHEN 'SMALL' THEN 2 ELSE 3 END AS level FROM part")
def simple_case(spark, sf):
    from tidemark.functions import value_map

    return table(spark, sf, "part").select("p_partkey", value_map("p_type", {"PROMO": 5, "LARGE": 4, "SMALL": 2}, 3).alias("level"))


query("P07_iff", "SELECT o_orderkey, if(nullif(o_orderstatus, 'P') = 'F', 'done', 'open') AS state FROM orders")(
    lambda s, d: table(s, d, "orders").select(
        "o_orderkey", F.when(F.nullif("o_orderstatus", F.lit("P")) == "F", "done").otherwise("open").alias("state")
    )
)
query("P08_inequality_filter", "SELECT o_orderkey FROM orders WHERE nullif(o_orderpriority, '5-LOW') <> '1-URGENT'")(
    lambda s, d: table(s, d, "orders").where(F.nullif("o_orderpriority", F.lit("5-LOW")) != "1-URGENT").select("o_orderkey")
)
query("P09_is_not_null", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE nullif(l_returnflag, 'N') IS NOT NULL")(
    lambda s, d: table(s, d, "lineitem").where(F.nullif("l_returnflag", F.lit("N")).isNotNull()).select("l_orderkey", "l_linenumber")
)
query("P10_between", """
SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
AND o_totalprice BETWEEN 50000 AND 200000
""")(lambda s, d: table(s, d, "orders").where(
    F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz"))
    & F.col("o_totalprice").between(50000, 200000)
).select("o_orderkey"))
query("P11_in_not_in", """
SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND nullif(o_orderstatus, 'P') NOT IN ('F')
""")(lambda s, d: table(s, d, "orders").where(
    F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.nullif("o_orderstatus", F.lit("P")).isin("F")
).select("o_orderkey"))
query("P12_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' OR p_name ILIKE '%blue%'")(
    lambda s, d: table(s, d, "part").where(contains_any("p_name", "RING", "blue")).select("p_partkey", "p_name")
)
query("P13_boolean_column", "SELECT o_orderkey, o_totalprice >= 100000 AS is_large FROM orders")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", (F.col("o_totalprice") >= 100000).alias("is_large"))
)


@query("P14_lateral_alias", f"""
SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS high, {rd('count(*) FILTER (value > 50)', 'count(*)', 4)} AS high_rate
FROM events GROUP BY ALL
""")
def lateral_alias(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("lateral_alias_events")
    return spark.sql("""
        SELECT event_type, count(*) AS n, count_if(value > 50) AS high,
          CAST(((high * 20000 + n) DIV (2 * n)) * 0.0001 AS DECIMAL(28,4)) AS high_rate
        FROM lateral_alias_events GROUP BY event_type""")


@query("P15_alias_in_where", """
SELECT CAST((SELECT min(o_orderdate) FROM orders) AS DATE) + CAST(g AS INT) AS spine_date
FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS g)
WHERE CAST((SELECT min(o_orderdate) FROM orders) AS DATE) + CAST(g AS INT) <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
""")
def alias_in_where(spark, sf):
    n, first, last = orders(spark, sf).agg(count_rows(), F.min("day"), F.max("day")).first()
    return numbered_days(spark, first, n, last)


query("P16_parameter_stamp", "SELECT o_orderkey, 90 AS window_days, 'v1' AS rule FROM orders")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", F.lit(90).alias("window_days"), F.lit("v1").alias("rule"))
)


@query("P17_feature_flag", f"SELECT o_orderkey, CAST(round({PRICE} * 1.10, 2) AS DECIMAL(18,2)) AS revenue FROM orders")
def feature_flag(spark, sf):
    raised = projection.feature_flag({"use_new_pricing_model": "true"}, "use_new_pricing_model")
    price = F.col("price")
    revenue = F.round(price * F.lit("1.10").cast("decimal(3,2)"), 2).cast("decimal(18,2)") if raised else price
    return orders(spark, sf).select("o_orderkey", revenue.alias("revenue"))


query("P18_look_back", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= DATE '2001-07-01' - 90")(
    lambda s, d: projection.look_back(orders(s, d), "day", 90, "2001-07-01").select("o_orderkey", "day")
)


@query("P19_mask_pii", """
SELECT c_custkey, sha256(c_name) AS hashed, '***REDACTED***' AS redacted, left(c_name, 2) || '****' AS partly,
  CAST(NULL AS VARCHAR) AS unknown, c_name AS in_prod FROM customer
""")
def mask(spark, sf):
    from tidemark.functions import mask_pii

    return table(spark, sf, "customer").select(
        "c_custkey", mask_pii("c_name", "hash").alias("hashed"), mask_pii("c_name", "redact").alias("redacted"),
        mask_pii("c_name", "partial").alias("partly"), mask_pii("c_name", "other").alias("unknown"),
        mask_pii("c_name", "hash", "prod").alias("in_prod"),
    )


@query("P20_row_filter", """
SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
""")
def row_filter(spark, sf):
    allowed = table(spark, sf, "nation").select(
        F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")).alias("viewer"), F.col("n_nationkey").alias("value")
    )
    return joins.visible_rows(table(spark, sf, "supplier"), "s_nationkey", allowed, "region-2", admins=("admin",)).select(
        "s_suppkey", "s_nationkey"
    )


# === joins =================================================================================

query("J01_left_join_dimension", "SELECT o_orderkey, day_of_week, is_weekend FROM orders LEFT JOIN orders_cal ON CAST(o_orderdate AS DATE) = date_day")(
    lambda s, d: orders(s, d).join(F.broadcast(orders_calendar(s, d)), F.col("day") == F.col("date_day"), "left").select(
        "o_orderkey", "day_of_week", "is_weekend"
    )
)


@query("J02_composite_preaggregated", """
SELECT event_id, user_id, CAST(ts AS DATE) AS day, clicks, views
FROM events e
LEFT JOIN (SELECT user_id u, CAST(ts AS DATE) d, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY ALL) c
  ON u = user_id AND d = CAST(ts AS DATE)
LEFT JOIN (SELECT user_id u2, CAST(ts AS DATE) d2, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY ALL) v
  ON u2 = user_id AND d2 = CAST(ts AS DATE)
WHERE event_type = 'purchase'
""")
def composite_preaggregated(spark, sf):
    e = events(spark, sf)
    key = ["user_id", "day"]
    clicks = e.where("event_type = 'click'").groupBy(*key).agg(count_rows().alias("clicks"))
    views = e.where("event_type = 'view'").groupBy(*key).agg(count_rows().alias("views"))
    bought = e.where("event_type = 'purchase'").select("event_id", *key)
    return bought.join(clicks, key, "left").join(views, key, "left")


query("J03_fan_out", "SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")(
    lambda s, d: table(s, d, "orders").select("o_orderkey").join(
        table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
        F.col("o_orderkey") == F.col("l_orderkey"), "left",
    ).drop("l_orderkey")
)
query("J04_inner_join", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", "o_custkey").join(
        table(s, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "c_mktsegment")
)


@query("J05_full_outer_zero", f"""
SELECT day, coalesce(orders, 0) AS orders, coalesce(lines, 0) AS lines
FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY ALL)
FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS lines FROM lineitem GROUP BY ALL) USING (day)
""")
def full_outer_zero(spark, sf):
    ordered = orders(spark, sf).groupBy("day").agg(count_rows().alias("orders"))
    shipped = lines(spark, sf).groupBy(F.to_date("l_shipdate").alias("day")).agg(count_rows().alias("lines"))
    return joins.full_outer_zero(ordered, shipped, "day")


query("J06_cross_join_one_row", "SELECT o_orderkey, (SELECT count(*) FROM supplier) AS suppliers FROM orders")(
    lambda s, d: joins.with_totals(
        table(s, d, "orders").select("o_orderkey"), table(s, d, "supplier").agg(count_rows().alias("suppliers"))
    )
)
query("J07_row_multiplier", "SELECT o_orderkey, CAST(k AS INT) AS item FROM orders, (VALUES (1), (2), (3)) t(k)")(
    lambda s, d: joins.multiply_rows(table(s, d, "orders").select("o_orderkey"), 3, "item")
)


@query("J08_round_robin", """
SELECT o_orderkey, s_suppkey FROM orders JOIN (
  SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS slot, count(*) OVER () AS n FROM supplier)
ON slot = ((o_orderkey - 1) % n + n) % n
""")
def round_robin(spark, sf):
    numbered = ranks.number_rows(table(spark, sf, "supplier").select("s_suppkey"), {"s_suppkey": F.asc}, "slot")
    dealt = joins.assign_round_robin(table(spark, sf, "orders").select("o_orderkey"), F.col("o_orderkey"), numbered, "slot")
    return dealt.select("o_orderkey", "s_suppkey")


query("J09_self_join", """
SELECT a.s_suppkey, a.s_name, b.s_name AS manager_name FROM supplier a LEFT JOIN supplier b ON b.s_suppkey = a.s_suppkey // 10
""")(lambda s, d: joins.with_parent_name(
    table(s, d, "supplier").withColumn("boss", F.floor(F.col("s_suppkey") / 10).cast("long")), "s_suppkey", "boss", "s_name", "manager_name"
).select("s_suppkey", "s_name", "manager_name"))
query("J10_transformed_key", """
SELECT c_custkey, coalesce(n_name, lower('n' || c_nationkey)) AS place
FROM customer LEFT JOIN nation ON 'N' || n_nationkey = 'N' || c_nationkey AND n_nationkey < 20
""")(lambda s, d: joins.lookup_upper(
    table(s, d, "customer").withColumn("code", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))),
    "code",
    table(s, d, "nation").where("n_nationkey < 20").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), "n_name"
    ),
    "place",
).select("c_custkey", "place"))


@query("J11_flag_join", """
WITH f AS (SELECT DISTINCT nullif(o_orderstatus, 'P') AS a, o_orderpriority AS b, o_totalprice > 250000 AS c FROM orders)
SELECT o_orderkey, f.a || '/' || f.b || '/' || CAST(f.c AS VARCHAR) AS flag_key FROM orders
LEFT JOIN f ON nullif(o_orderstatus, 'P') = f.a AND o_orderpriority = f.b AND (o_totalprice > 250000) = f.c
""")
def flag_join(spark, sf):
    flagged = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("a"), F.col("o_orderpriority").alias("b"),
        (F.col("o_totalprice") > 250000).alias("c"),
    )
    junk = flagged.select("a", "b", "c").distinct().withColumn(
        "flag_key", F.concat("a", F.lit("/"), "b", F.lit("/"), F.col("c").cast("string"))
    )
    return flagged.join(junk, ["a", "b", "c"], "left").select("o_orderkey", "flag_key")


@query("J12_gap_filling", """
SELECT date_day AS day, coalesce(n, 0) AS n, last_price FROM orders_cal
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, max(o_totalprice) AS last_price FROM orders
           WHERE o_orderpriority = '1-URGENT' GROUP BY ALL) ON d = date_day
""")
def gap_filling(spark, sf):
    urgent = orders(spark, sf).where("o_orderpriority = '1-URGENT'")
    daily = urgent.groupBy("day").agg(count_rows().alias("n"), F.max("o_totalprice").alias("last_price"))
    spine = orders_calendar(spark, sf).select(F.col("date_day").alias("day"))
    return joins.fill_gaps(spine, daily, "day", zero=["n"], keep=["last_price"])


@query("J13_join_to_baseline", f"""
WITH s AS (SELECT user_id, event_type, {avg_of('CAST(value AS DECIMAL(18,2))')} AS avg_value FROM events GROUP BY ALL)
SELECT s.user_id, event_type, avg_value, best FROM s JOIN (SELECT user_id, max(avg_value) AS best FROM s GROUP BY ALL) b
ON b.user_id = s.user_id
""")
def join_to_baseline(spark, sf):
    stats = events(spark, sf).groupBy("user_id", "event_type").agg(money_mean("amount").alias("avg_value"))
    best = stats.groupBy("user_id").agg(F.max("avg_value").alias("best"))
    return stats.join(best, "user_id")


query("J14_anti_join", """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')
""")(lambda s, d: joins.orphans(
    table(s, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey",
    table(s, d, "customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey",
))


@query("J15_upsert_match", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'updated' ELSE 'kept' END AS action FROM orders
""")
def upsert_match(spark, sf):
    target = table(spark, sf, "orders").select("o_orderkey")
    batch = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    updated = target.join(batch, "o_orderkey", "left_semi").withColumn("action", F.lit("updated"))
    return updated.unionByName(target.join(batch, "o_orderkey", "left_anti").withColumn("action", F.lit("kept")))


# === aggregation ===========================================================================

query("A01_group_by", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {money(f'sum({LINE_PRICE})')} AS total, {avg_of(LINE_PRICE)} AS average,
  min(l_quantity) AS least, max(l_quantity) AS most FROM lineitem GROUP BY ALL
""")(lambda s, d: lines(s, d).groupBy("l_returnflag", "l_linestatus").agg(
    count_rows().alias("n"), money_sum("price").alias("total"), money_mean("price").alias("average"),
    F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"),
))
query("A02_count_distinct", f"""
SELECT CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_custkey) AS buyers, count(o_orderkey) AS orders,
  {money(f'sum({PRICE})')} AS total FROM orders GROUP BY ALL
""")(lambda s, d: orders(s, d).groupBy("day").agg(
    F.count_distinct("o_custkey").alias("buyers"), F.count("o_orderkey").alias("orders"), money_sum("price").alias("total")
))
query("A03_conditional_sum", f"""
SELECT l_shipdate, {money(f"coalesce(sum({LINE_PRICE}) FILTER (l_returnflag = 'R'), 0)")} AS returned,
  {money(f"coalesce(sum({LINE_PRICE}) FILTER (l_returnflag <> 'R'), 0)")} AS kept FROM lineitem GROUP BY ALL
""")(lambda s, d: lines(s, d).groupBy("l_shipdate").agg(
    money_sum(F.when(F.col("l_returnflag") == "R", F.col("price")).otherwise(0)).alias("returned"),
    money_sum(F.when(F.col("l_returnflag") != "R", F.col("price")).otherwise(0)).alias("kept"),
))
query("A04_count_if", "SELECT event_type, count(*) FILTER (value > 100) AS high, count(*) FILTER (value < 1) AS low FROM events GROUP BY ALL")(
    lambda s, d: table(s, d, "events").groupBy("event_type").agg(
        F.count_if(F.col("value") > 100).alias("high"), F.count_if(F.col("value") < 1).alias("low")
    )
)
query("A05_conditional_max", """
SELECT user_id, max(value) FILTER (event_type = 'purchase') AS top_purchase, max(value) FILTER (event_type = 'view') AS top_view
FROM events GROUP BY ALL
""")(lambda s, d: table(s, d, "events").groupBy("user_id").agg(
    F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("top_purchase"),
    F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("top_view"),
))
query("A06_guarded_ratio", f"""
SELECT user_id, {rd("count(*) FILTER (event_type = 'purchase') * 100", "count(*) FILTER (event_type = 'click')")} AS per_click
FROM events GROUP BY ALL
""")(lambda s, d: table(s, d, "events").groupBy("user_id").agg(
    percent(F.count_if(F.col("event_type") == "purchase"), F.count_if(F.col("event_type") == "click")).alias("per_click")
))
query("A07_ratio_or_zero", f"""
SELECT o_custkey, coalesce({rd(f"sum({PRICE}) FILTER (o_orderstatus = 'F')", "count(*) FILTER (o_orderstatus = 'F')")}, 0) AS per_done
FROM orders GROUP BY ALL
""")(lambda s, d: orders(s, d).groupBy("o_custkey").agg(
    F.coalesce(
        quotient(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("price"))), F.count_if(F.col("o_orderstatus") == "F")),
        F.lit(0).cast("decimal(28,2)"),
    ).alias("per_done")
))


@query("A08_two_level", f"""
WITH c AS (SELECT o_custkey, count(*) AS n, sum({PRICE}) AS total FROM orders GROUP BY ALL)
SELECT c_mktsegment, count(c_custkey) AS customers, {avg_of('coalesce(n, 0)')} AS avg_orders,
  {rd('sum(coalesce(total, 0))', 'count(c_custkey)')} AS avg_total
FROM customer LEFT JOIN c ON o_custkey = c_custkey GROUP BY ALL
""")
def two_level(spark, sf):
    per_customer = orders(spark, sf).groupBy("o_custkey").agg(count_rows().alias("n"), money_sum("price").alias("total"))
    joined = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(
        per_customer, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).fillna(0, ["n", "total"])
    return joined.groupBy("c_mktsegment").agg(
        F.count("c_custkey").alias("customers"), mean("n").alias("avg_orders"), mean("total").alias("avg_total")
    )


query("A09_global_aggregate", f"SELECT count(*) AS n, {money('sum(CAST(value AS DECIMAL(18,2)))')} AS total, max(ts) AS latest FROM events")(
    lambda s, d: events(s, d).agg(count_rows().alias("n"), money_sum("amount").alias("total"), F.max("ts").alias("latest"))
)
query("A10_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority, o_totalprice > 250000 AS is_large FROM orders")(
    lambda s, d: table(s, d, "orders").select(
        "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") > 250000).alias("is_large")
    ).distinct()
)


@query("A11_derived_bucket", """
SELECT CASE WHEN n = 0 THEN 'Halloween Day' WHEN n BETWEEN 1 AND 7 THEN 'Week of Halloween'
  WHEN n BETWEEN 8 AND 30 THEN 'October Pre-Halloween' WHEN n BETWEEN 31 AND 60 THEN '2 Months Before'
  WHEN n BETWEEN -14 AND -1 THEN 'Post Halloween (2 wks)' WHEN n < 0 THEN 'Off Season' ELSE 'Far Out' END AS bucket,
  count(*) AS orders
FROM (SELECT make_date(year(o_orderdate), 10, 31) - CAST(o_orderdate AS DATE) AS n FROM orders) GROUP BY ALL
""")
def derived_bucket(spark, sf):
    from tidemark.functions import days_to_halloween

    return orders(spark, sf).groupBy(halloween_bucket(days_to_halloween("day")).alias("bucket")).agg(count_rows().alias("orders"))


query("A12_having_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")(
    lambda s, d: projection.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])
)
query("A13_detail_and_overall", f"""
SELECT event_type, user_id % 5 AS band, {avg_of('CAST(value AS DECIMAL(18,2))')} AS avg_value, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT 'All Events', user_id % 5, {avg_of('CAST(value AS DECIMAL(18,2))')}, count(*) FROM events GROUP BY ALL
""")(lambda s, d: projection.with_overall(
    events(s, d).withColumn("band", F.col("user_id") % 5), "event_type", ["band"], "All Events",
    avg_value=money_mean("amount"), n=count_rows(),
))
query("A14_span_and_rate", f"""
SELECT o_custkey, max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) AS active_days,
  {rd(f"sum({PRICE})", "datediff('month', min(o_orderdate), max(o_orderdate))")} AS per_month
FROM orders GROUP BY ALL
""")(lambda s, d: orders(s, d).groupBy("o_custkey").agg(
    days_between(F.min("day"), F.max("day")).cast("long").alias("active_days"),
    quotient(F.sum("price"), months_between_dates(F.min("day"), F.max("day"))).alias("per_month"),
))
query("A15_derived_dimension", f"SELECT o_orderpriority, CAST({avg_of(PRICE)} AS DECIMAL(10,2)) AS price FROM orders GROUP BY ALL")(
    lambda s, d: orders(s, d).groupBy("o_orderpriority").agg(money_mean("price").cast("decimal(10,2)").alias("price"))
)


@query("A16_average_of_averages", f"""
WITH u AS (SELECT user_id, event_type, CAST({avg_of('CAST(value AS DECIMAL(18,2))', 6)} AS DECIMAL(12,6)) AS a FROM events GROUP BY ALL)
SELECT event_type, {avg_of('a', 4)} AS avg_of_users FROM u GROUP BY ALL
""")
def average_of_averages(spark, sf):
    users = events(spark, sf).groupBy("user_id", "event_type").agg(mean("amount", 6).cast("decimal(12,6)").alias("a"))
    return users.groupBy("event_type").agg(mean("a", 4).alias("avg_of_users"))


# === windows ===============================================================================

query("W01_row_number_id", "SELECT row_number() OVER (ORDER BY n_name) AS id, n_name FROM nation")(
    lambda s, d: ranks.number_rows(table(s, d, "nation").select("n_name"), {"n_name": F.asc}, "id")
)
query("W02_rank_nulls_last", """
SELECT p_brand, avg_size, rank() OVER (ORDER BY avg_size DESC NULLS LAST, p_brand) AS place
FROM (SELECT p_brand, max(p_retailprice) FILTER (p_brand <> 'Brand#7') AS avg_size FROM part GROUP BY p_brand)
""")(lambda s, d: ranks.rank_rows(
    table(s, d, "part").groupBy("p_brand").agg(F.max("p_retailprice").alias("m")).select(
        "p_brand", F.when(F.col("p_brand") != "Brand#7", F.col("m")).alias("avg_size")
    ),
    {"avg_size": F.desc_nulls_last, "p_brand": F.asc}, "place",
))
query("W03_rank_over_aggregates", f"""
SELECT user_id, count(*) AS n, rank() OVER (ORDER BY {avg_of('CAST(value AS DECIMAL(18,2))')} DESC, count(*) DESC) AS place
FROM events GROUP BY ALL
""")(lambda s, d: ranks.rank_rows(
    events(s, d).groupBy("user_id").agg(count_rows().alias("n"), money_mean("amount").alias("avg_value")),
    {"avg_value": F.desc, "n": F.desc}, "place",
).drop("avg_value"))
query("W04_rank_nullable_ratio", """
SELECT p_partkey, rank() OVER (ORDER BY p_retailprice / CAST(nullif(p_size % 10, 0) AS DOUBLE) DESC NULLS FIRST) AS place FROM part
""")(lambda s, d: ranks.rank_rows(
    table(s, d, "part").select("p_partkey", ratio(F.col("p_retailprice"), F.col("p_size") % 10).alias("r")),
    {"r": F.desc_nulls_first}, "place",
).drop("r"))
query("W05_dense_rank", "SELECT o_orderkey, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS place FROM orders")(
    lambda s, d: ranks.rank_rows(
        table(s, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"),
        {"o_totalprice": F.desc}, "place", ["o_orderpriority"], dense=True,
    ).select("o_orderkey", "place")
)
query("W06_running_sum", f"""
SELECT o_orderkey, {money(f'sum({PRICE}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)')} AS running
FROM orders
""")(lambda s, d: ranks.running_total(
    orders(s, d).select("o_orderkey", "o_custkey", "day", "price"), ["o_custkey"],
    {"day": F.asc, "o_orderkey": F.asc}, "price", "running",
).select("o_orderkey", F.col("running").cast("decimal(28,2)").alias("running")))
query("W07_group_average", f"""
SELECT o_orderkey, {rd(f'sum({PRICE}) OVER w', 'count(*) OVER w')} AS group_avg,
  {rd(f'{PRICE} * (count(*) OVER w) - (sum({PRICE}) OVER w)', 'count(*) OVER w')} AS delta
FROM orders WINDOW w AS (PARTITION BY o_orderpriority)
""")(lambda s, d: ranks.with_group_sum(orders(s, d), ["o_orderpriority"], "price", "total", "n").select(
    "o_orderkey", quotient(F.col("total"), F.col("n")).alias("group_avg"),
    quotient(F.col("price") * F.col("n") - F.col("total"), F.col("n")).alias("delta"),
))


@query("W08_global_sequence", """
SELECT o_orderkey, k AS item, row_number() OVER (ORDER BY o_orderkey, k) AS seq
FROM orders, (SELECT CAST(unnest(range(1, 4)) AS INT) AS k)
""")
def global_sequence(spark, sf):
    items = joins.multiply_rows(table(spark, sf, "orders").select("o_orderkey"), 3, "item")
    return ranks.number_rows(items, {"o_orderkey": F.asc, "item": F.asc}, "seq")


@query("W09_share_of_total", f"""
SELECT o_orderstatus, count(*) AS n, {rd('count(*) * 100', 'sum(count(*)) OVER ()')} AS share FROM orders GROUP BY ALL
""")
def share_of_total(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(count_rows().alias("n"))
    total = counts.agg(F.sum("n").alias("all_rows"))
    return joins.with_totals(counts, total).select("o_orderstatus", "n", percent(F.col("n"), F.col("all_rows")).alias("share"))


# === sort, limit, sets =====================================================================

query("O01_order_by", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_custkey", F.desc("o_totalprice"))
)
query("O02_nulls_last", "SELECT p_partkey, nullif(p_size, 7) AS size FROM part ORDER BY size DESC NULLS LAST, p_partkey")(
    lambda s, d: table(s, d, "part").select("p_partkey", F.nullif("p_size", F.lit(7)).alias("size")).orderBy(
        F.desc_nulls_last("size"), "p_partkey"
    )
)
query("O03_optional_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500")(
    lambda s, d: projection.dev_limit(
        table(s, d, "orders").select("o_orderkey", "o_totalprice"), 500, F.desc("o_totalprice"), F.col("o_orderkey")
    )
)
query("O04_top_offenders", """
SELECT l_orderkey, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1
ORDER BY row_count DESC, l_orderkey LIMIT 5
""")(lambda s, d: projection.top_duplicates(table(s, d, "lineitem"), ["l_orderkey"], 5))


@query("U01_union_all", "SELECT o_orderkey, o_orderpriority FROM orders")
def union_all(spark, sf):
    both = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return both.where(urgent).unionByName(both.where(~urgent).select("o_orderpriority", "o_orderkey"))


@query("U02_union_of_grains", """
SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT event_type, NULL, count(*) FROM events GROUP BY ALL
""")
def union_of_grains(spark, sf):
    e = table(spark, sf, "events")
    fine = e.groupBy("event_type", "user_id").agg(count_rows().alias("n"))
    # The coarse grain is rolled up from the fine one, not read again.
    coarse = fine.groupBy("event_type").agg(F.sum("n").alias("n"))
    return fine.unionByName(coarse, allowMissingColumns=True)


def changed_orders(spark, sf):
    return table(spark, sf, "orders").where("o_orderkey % 10 <> 3").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 10 == 4, "X").otherwise(F.col("o_orderstatus"))
    )


CHANGED = """
WITH a AS (SELECT * EXCLUDE (o_totalprice) FROM orders),
b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM a WHERE o_orderkey % 10 <> 3)
"""
query("U03_compare_relations", CHANGED + f""", r AS (
SELECT in_a, in_b, count(*) AS count FROM (
  SELECT true AS in_a, true AS in_b, t.* FROM (FROM a INTERSECT FROM b) t
  UNION ALL SELECT true, false, t.* FROM (FROM a EXCEPT FROM b) t
  UNION ALL SELECT false, true, t.* FROM (FROM b EXCEPT FROM a) t) GROUP BY ALL)
SELECT *, {rd('count * 100', '(SELECT sum(count) FROM r)')} AS percent_of_total FROM r
""")(lambda s, d: compare.compare_relations(table(s, d, "orders"), changed_orders(s, d), exclude=["O_TOTALPRICE"]))
query("U03_differing_rows", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'only_a' ELSE 'changed' END AS status FROM orders WHERE o_orderkey % 10 IN (3, 4)
""")(lambda s, d: compare.differing_rows(table(s, d, "orders"), changed_orders(s, d), ["o_orderkey"]))


def corrected_orders(spark, sf):
    """The orders after a small correction: few keys differ."""
    status = F.when(F.col("o_orderkey") % 501 == 4, "X").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").where("o_orderkey % 500 <> 3").withColumn("o_orderstatus", status)


query("U03_compare_by_key", """
WITH b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 501 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders WHERE o_orderkey % 500 <> 3),
r AS (SELECT in_a, in_b, count(*) AS count FROM (
  SELECT true AS in_a, true AS in_b, t.* FROM (FROM orders INTERSECT FROM b) t
  UNION ALL SELECT true, false, t.* FROM (FROM orders EXCEPT FROM b) t
  UNION ALL SELECT false, true, t.* FROM (FROM b EXCEPT FROM orders) t) GROUP BY ALL)
""" + f"SELECT *, {rd('count * 100', '(SELECT sum(count) FROM r)')} AS percent_of_total FROM r")(
    lambda s, d: compare.compare_relations(table(s, d, "orders"), corrected_orders(s, d), key=["o_orderkey"])
)
query("U03_differing_by_digest", """
SELECT o_orderkey, CASE WHEN o_orderkey % 500 = 3 THEN 'only_a' ELSE 'changed' END AS status FROM orders
WHERE o_orderkey % 500 = 3 OR (o_orderkey % 501 = 4 AND o_orderstatus <> 'X')
""")(lambda s, d: compare.differing_rows(table(s, d, "orders"), corrected_orders(s, d), ["o_orderkey"], buckets=compare.BUCKETS))

# === physical layout =======================================================================


@query("L01_cluster_by", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders")
def cluster_by(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", "day", "o_orderpriority")
    target = Table(spark, fresh_path(spark, "clustered"))
    target.overwrite(writers.clustered(rows, "day", "o_orderpriority"))
    return target.read()


@query("L01_cluster_by_curve", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders
WHERE o_custkey BETWEEN (SELECT CAST(max(o_custkey) // 4 AS BIGINT) FROM orders) AND (SELECT CAST(max(o_custkey) // 3 AS BIGINT) FROM orders)
""")
def cluster_by_curve(spark, sf):
    """A filter on the second of three columns that the files are laid out by."""
    rows = orders(spark, sf).select("o_orderkey", "o_custkey", "day", "o_orderpriority")
    target = Table(spark, fresh_path(spark, "curve"))
    target.overwrite(writers.interleaved(rows, "day", "o_custkey", "o_orderpriority", files=64, bits=4))
    last = rows.agg(F.max("o_custkey")).first()[0] or 0
    return target.read().where(F.col("o_custkey").between(last // 4, last // 3))


@query("L02_partition_config", """
SELECT l_orderkey, l_linenumber, l_quantity, CAST(date_trunc('year', l_shipdate) AS DATE) AS ship_period
FROM lineitem
""")
def partition_config(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", writers.partition_column("l_shipdate", "year").alias("ship_period")
    )
    target = Table(spark, fresh_path(spark, "partitioned"), "ship_period")
    target.overwrite(rows)
    return target.read()


# === metric layer ==========================================================================


def catalog(spark, sf) -> Catalog:
    # Order keys stand for visits, lines for in-park sales.
    tickets = stg_tickets(spark, sf).select("ticket_id", "customer_id", "visit_date", "ticket_type", "final_price")
    sales = pos_with_customer(spark, sf).select(
        "transaction_id", "customer_id", "visit_date", "category", "quantity", "total_amount"
    )
    who = dim_customers(spark, sf)
    return Catalog(
        [
            SemanticModel("visits", tickets, {"visit": "ticket_id"}, {"customer": "customer_id"}, ("ticket_type",), ("visit_date",)),
            SemanticModel("sales", sales, {"transaction": "transaction_id"}, {"customer": "customer_id"}, ("category",), ("visit_date",)),
            SemanticModel("customers", who, {"customer": "customer_id"}, {}, ("loyalty_tier", "age_group"), ("registration_date",)),
        ],
        [
            Metric("ticket_revenue", "sum", "final_price", "visits"),
            Metric("total_visits", "count_distinct", "ticket_id", "visits"),
            Metric("total_sales", "sum", "total_amount", "sales"),
            Metric("total_items_sold", "sum", "quantity", "sales"),
            Metric("total_transactions", "count_distinct", "transaction_id", "sales"),
            Metric("active_days", "count_distinct", "visit_date", "visits"),
            Metric("sales_per_free_visit", "derived", "total_sales / (total_visits - total_visits)", inputs=("total_sales", "total_visits")),
            Metric("average_revenue_per_visit", "derived", "ticket_revenue / nullif(total_visits, 0)",
                   inputs=("ticket_revenue", "total_visits")),
            Metric("average_order_value", "derived", "total_sales / nullif(total_transactions, 0)",
                   inputs=("total_sales", "total_transactions")),
        ],
    )


MONEY20 = "CAST({} AS DECIMAL(20,2))"
query("M01_sum_metric", f"SELECT {MONEY20.format('sum(total_amount)')} AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_items_sold FROM raw_pos")(
    lambda s, d: catalog(s, d).query(["total_sales", "total_items_sold"])
)
query("M02_count_distinct_metric", "SELECT ticket_type, count(DISTINCT ticket_id) AS total_visits FROM raw_tickets GROUP BY ALL")(
    lambda s, d: catalog(s, d).query(["total_visits"], ["ticket_type"])
)
query("M03_derived_metric", f"""
SELECT ticket_type, CAST(sum(final_price) AS DOUBLE) / count(DISTINCT ticket_id) AS average_revenue_per_visit,
  {MONEY20.format('sum(final_price)')} AS ticket_revenue FROM raw_tickets GROUP BY ALL
""")(lambda s, d: catalog(s, d).query(["average_revenue_per_visit", "ticket_revenue"], ["ticket_type"]))
query("M04_categorical_dimension", f"SELECT category, {MONEY20.format('sum(total_amount)')} AS total_sales FROM raw_pos GROUP BY ALL")(
    lambda s, d: catalog(s, d).query(["total_sales"], ["category"])
)
query("M05_time_dimension", f"""
SELECT CAST(date_trunc('month', visit_date) AS DATE) AS metric_time, {MONEY20.format('sum(final_price)')} AS ticket_revenue
FROM raw_tickets WHERE ticket_type = 'day_pass' GROUP BY ALL
""")(lambda s, d: catalog(s, d).query(["ticket_revenue"], ["metric_time"], where="ticket_type = 'day_pass'", grain="month"))
query("M06_entity_join", f"""
SELECT loyalty_tier, ticket_type, {MONEY20.format('sum(final_price)')} AS ticket_revenue
FROM raw_tickets LEFT JOIN dim_customers_q USING (customer_id) WHERE age_group <> '55+' GROUP BY ALL
""")(lambda s, d: catalog(s, d).query(["ticket_revenue"], ["loyalty_tier", "ticket_type"], where="age_group <> '55+'"))
query("M06_distinct_through_entity", f"""
SELECT loyalty_tier, count(DISTINCT visit_date) AS active_days, count(DISTINCT ticket_id) AS total_visits,
  {MONEY20.format('sum(final_price)')} AS ticket_revenue
FROM raw_tickets LEFT JOIN dim_customers_q USING (customer_id) WHERE ticket_type <> 'day_pass' GROUP BY ALL
""")(lambda s, d: catalog(s, d).query(["active_days", "total_visits", "ticket_revenue"], ["loyalty_tier"], where="ticket_type <> 'day_pass'"))
query("M05_zero_denominator", f"""
SELECT CAST(date_trunc('year', visit_date) AS DATE) AS metric_time, {MONEY20.format('sum(total_amount)')} AS total_sales,
  CAST(NULL AS DOUBLE) AS sales_per_free_visit FROM raw_pos GROUP BY ALL
""")(lambda s, d: catalog(s, d).query(["total_sales", "sales_per_free_visit"], ["metric_time"], grain="year"))
query("M07_multi_fact", f"""
WITH v AS (SELECT CAST(date_trunc('quarter', visit_date) AS DATE) AS metric_time, loyalty_tier,
    sum(final_price) AS a, count(DISTINCT ticket_id) AS b
  FROM raw_tickets LEFT JOIN dim_customers_q USING (customer_id) GROUP BY ALL),
p AS (SELECT CAST(date_trunc('quarter', visit_date) AS DATE) AS metric_time, loyalty_tier,
    sum(total_amount) AS c, count(DISTINCT transaction_id) AS d
  FROM raw_pos LEFT JOIN dim_customers_q USING (customer_id) GROUP BY ALL)
SELECT metric_time, loyalty_tier, {MONEY20.format('a')} AS ticket_revenue, b AS total_visits,
  {MONEY20.format('c')} AS total_sales, CAST(c AS DOUBLE) / d AS average_order_value
FROM v FULL JOIN p USING (metric_time, loyalty_tier)
""")(lambda s, d: catalog(s, d).query(
    ["ticket_revenue", "total_visits", "total_sales", "average_order_value"], ["metric_time", "loyalty_tier"], grain="quarter"
))
query("M07_multi_fact_total", f"""
SELECT {MONEY20.format('(SELECT sum(final_price) FROM raw_tickets)')} AS ticket_revenue,
  {MONEY20.format('(SELECT sum(total_amount) FROM raw_pos)')} AS total_sales
""")(lambda s, d: catalog(s, d).query(["ticket_revenue", "total_sales"]))
