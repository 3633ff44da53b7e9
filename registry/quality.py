"""Data tests, contracts, quarantine, audit and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from registry.base import AS_OF, query, rd, table
from registry.inputs import feed
from registry.models import dim_customers, fct_visits, stamp, stg_tickets
from tidemark import publish
from tidemark.operators import compare, projection, quality as q
from tidemark.operators.quality import Check
from tidemark.session import fresh_path
from tidemark.sources.table import Table

GAPS = "nullif(o_orderstatus, 'P')"


def orders(spark, sf):
    """Orders with a status that may be missing."""
    return table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))


def lines(spark, sf):
    return table(spark, sf, "lineitem")


query("Q01_not_null", f"SELECT o_orderkey, {GAPS} AS status FROM orders WHERE o_orderstatus = 'P'")(
    lambda s, d: q.not_null(orders(s, d), "status").select("o_orderkey", "status")
)
query("Q02_unique", "SELECT nullif(l_orderkey, 1) AS k, count(*) AS row_count FROM lineitem WHERE l_orderkey <> 1 GROUP BY 1 HAVING count(*) > 1")(
    lambda s, d: q.unique(lines(s, d).select(F.nullif("l_orderkey", F.lit(1)).alias("k")), "k")
)
query("Q03_accepted_values", f"SELECT o_orderkey, {GAPS} AS status FROM orders WHERE {GAPS} NOT IN ('O')")(
    lambda s, d: q.accepted_values(orders(s, d), "status", ["O"]).select("o_orderkey", "status")
)
query("Q04_relationships", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")(
    lambda s, d: q.relationships(
        table(s, d, "orders"), "o_custkey", table(s, d, "customer").where("c_nationkey < 20"), "c_custkey"
    ).select("o_orderkey", "o_custkey")
)
query("Q05_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")(
    lambda s, d: q.unique_combination(lines(s, d), ["l_orderkey", "l_linenumber"])
)
query("Q06_values_between", """
SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45
UNION ALL SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_discount > 0.08
""")(lambda s, d: q.values_between(lines(s, d), "l_quantity", 5, 45).select("l_orderkey", "l_quantity", "l_discount").unionByName(
    q.values_between(lines(s, d), "l_discount", high=0.08).select("l_orderkey", "l_quantity", "l_discount")
))


@query("Q07_date_column_order", """
SELECT CAST(o_orderdate AS DATE) AS earlier_value, CAST(l_shipdate AS DATE) AS later_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) >= CAST(l_shipdate AS DATE)
""")
def date_column_order(spark, sf):
    shipped = lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("shipped"))
    both = shipped.join(table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered")), "o_orderkey")
    return q.date_order(both, "ordered", "shipped", allow_equal=False)


query("Q08_boolean_matches", "SELECT o_orderkey FROM orders WHERE coalesce(nullif(o_orderstatus, 'P') = 'F', false) <> (o_totalprice > 250000)")(
    lambda s, d: q.boolean_matches(
        orders(s, d).withColumn("is_done", F.col("status") == "F"), "is_done", "o_totalprice > 250000"
    ).select("o_orderkey")
)
query("Q09_rating_in_range", "SELECT rating FROM raw_feedback WHERE rating < 2 OR rating > 4")(
    lambda s, d: q.rating_in_range(feed(s, d, "raw_feedback"), "rating", 2, 4)
)
query("Q10_valid_types", "SELECT ticket_type FROM raw_tickets WHERE ticket_type NOT IN ('day_pass', 'annual_pass')")(
    lambda s, d: q.valid_types(feed(s, d, "raw_tickets"), "ticket_type", ["day_pass", "annual_pass"])
)
query("Q11_required_when", "SELECT feedback_id, ride_id FROM raw_feedback WHERE category = 'ride' AND ride_id IS NULL")(
    lambda s, d: q.required_when(feed(s, d, "raw_feedback"), "ride_id", "category = 'ride'").select("feedback_id", "ride_id")
)
query("Q12_where_clause", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice < 5000")(
    lambda s, d: q.failing_within(table(s, d, "orders"), "o_orderpriority = '1-URGENT'", "o_totalprice < 5000").select("o_orderkey")
)
@query("Q05_many_keys", """
WITH a AS (SELECT l_partkey, l_suppkey, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1),
b AS (SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT 0 AS key_number, l_partkey, l_suppkey, CAST(NULL AS BIGINT) AS l_orderkey, CAST(NULL AS INT) AS l_linenumber, row_count FROM a
UNION ALL SELECT 1, NULL, NULL, l_orderkey, l_linenumber, row_count FROM b
""")
def many_keys(spark, sf):
    repeated = q.repeated_keys(table(spark, sf, "lineitem"), [("l_partkey", "l_suppkey"), ("l_orderkey", "l_linenumber")])
    return repeated.withColumnRenamed("_set", "key_number")


query("Q13_no_duplicate_combination", "SELECT l_orderkey, l_partkey, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")(
    lambda s, d: projection.duplicates(lines(s, d), ["l_orderkey", "l_partkey"])
)
REVIEW = """
SELECT event_id, customer_id, payment_amount_raw, TRY_CAST(payment_amount_raw AS DECIMAL(12,2)) AS payment_amount, currency,
  payment_status, event_timestamp, CASE WHEN event_id % 50 = 0 THEN 'malformed_amount' ELSE 'negative_amount' END AS review_reason
FROM payment_feed WHERE event_id % 50 = 0 OR (event_id % 70 = 0 AND payment_amount_raw <> '-0.00')
"""
query("Q14_warn_if_rows_exist", REVIEW)(
    lambda s, d: q.rows_exist(q.quarantine(feed(s, d, "payment_feed"), "payment_amount_raw")[1])
)
query("Q15_singular_assertion", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice - 1000 < 0")(
    lambda s, d: lines(s, d).where(F.col("l_extendedprice") - 1000 < 0).select("l_orderkey", "l_linenumber", "l_extendedprice")
)


@query("Q16_test_runner", """
WITH n AS (
SELECT 'status filled' AS check_name, count(*) FILTER (o_orderstatus = 'P') AS failures FROM orders
UNION ALL SELECT 'price positive', count(*) FILTER (o_totalprice < 0) FROM orders
UNION ALL SELECT 'urgent only', count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice < 5000) FROM orders
UNION ALL SELECT 'customer unique', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY ALL HAVING count(*) > 1)))
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN check_name = 'status filled' THEN 'error' WHEN check_name = 'urgent only'
  THEN if(failures >= 1000000, 'error', 'warn') ELSE 'warn' END AS status FROM n
""")
def test_runner(spark, sf):
    rows = orders(spark, sf)
    return q.run_checks(rows, [
        Check("status filled", breaks=q.breaks_not_null("status")),
        Check("price positive", breaks=q.breaks_between("o_totalprice", low=0)),
        Check("urgent only", breaks=q.breaks_between("o_totalprice", low=5000), where="o_orderpriority = '1-URGENT'", error_if=1_000_000),
        Check("customer unique", rows=q.unique(rows, "o_custkey"), severity="warn"),
    ])


@query("Q16_store_failures", f"SELECT o_orderkey, {GAPS} AS status FROM orders WHERE o_orderstatus = 'P'")
def store_failures(spark, sf):
    path = fresh_path(spark, "failures")
    q.store_failures(q.not_null(orders(spark, sf), "status").select("o_orderkey", "status"), path)
    return spark.read.parquet(path)


query("Q17_quality_score", f"""
SELECT customer_id, {rd('''(4 + if(email LIKE '%@example.com', 3, 0) + 2 + if(phone IS NULL, 0, 1)) * 100''', "12", 1)} AS score
FROM stg_customers_q
""")(lambda s, d: _scored(s, d))


def _scored(spark, sf):
    from registry.models import stg_customers

    checks = [
        ("customer_id", "not_null", 4), ("email", "valid_email", 3), ("loyalty_points", "positive", 2), ("phone", "not_null", 1),
        ("phone", "no_such_kind", 2),
    ]
    return stg_customers(spark, sf).select("customer_id", q.quality_score(checks).alias("score"))


@query("Q18_contract", "SELECT visit_key, customer_id, visit_date, ticket_type, CAST(total_visit_spend AS DECIMAL(12,2)) AS total_visit_spend, "
       "CAST(avg_rating AS DECIMAL(4,2)) AS avg_rating FROM fct_visits_q")
def contract(spark, sf):
    from pyspark.sql.types import DateType

    from tidemark.plans import demos

    declared = StructType([
        StructField("visit_key", StringType()), StructField("customer_id", LongType()), StructField("visit_date", DateType()),
        StructField("ticket_type", StringType()), StructField("total_visit_spend", DecimalType(12, 2)),
        StructField("avg_rating", DecimalType(4, 2)),
    ])
    return q.enforce_contract(demos.governed_visits(fct_visits(spark, sf)), declared)


query("Q19_quarantine_review", REVIEW)(lambda s, d: q.quarantine(feed(s, d, "payment_feed"), "payment_amount_raw")[1])
query("Q19_quarantine_good", """
SELECT *, CAST(payment_amount_raw AS DECIMAL(12,2)) AS payment_amount FROM payment_feed
WHERE event_id % 50 <> 0 AND (event_id % 70 <> 0 OR payment_amount_raw = '-0.00')
""")(lambda s, d: q.quarantine(feed(s, d, "payment_feed"), "payment_amount_raw")[0])
AMOUNT = "TRY_CAST(payment_amount_raw AS DECIMAL(12,2))"
COUNTS = f"""count(*) AS total_events, count(*) FILTER ({AMOUNT} IS NULL) AS malformed_amount_events,
  count(*) FILTER ({AMOUNT} < 0) AS negative_amount_events"""
QUALITY = f"""
SELECT *, {rd('events_requiring_review', 'total_events', 4)} AS review_rate, 'safe' AS policy_mode
FROM (SELECT {COUNTS}, count(*) FILTER (coalesce({AMOUNT}, -1) < 0) AS events_requiring_review FROM payment_feed)
"""
query("Q20_feed_quality", QUALITY)(lambda s, d: q.feed_quality(feed(s, d, "payment_feed"), "payment_amount_raw"))
VALIDATED = f"SELECT event_id, customer_id, {AMOUNT} AS payment_amount, currency, payment_status, event_timestamp FROM payment_feed"


@query("Q21_safe_parse", VALIDATED)
def safe_parse(spark, sf):
    from tidemark.plans.demos import validated_payments

    return validated_payments(feed(spark, sf, "payment_feed"))


@query("Q21_strict_parse", VALIDATED + " WHERE event_id % 50 <> 0")
def strict_parse(spark, sf):
    from tidemark.plans.demos import validated_payments

    clean = feed(spark, sf, "payment_feed").where("payment_amount_raw <> 'NOT_A_NUMBER'")
    return validated_payments(clean, strict=True)


query("Q22_incident_summary", f"SELECT {COUNTS}, count(*) FILTER (payment_status = 'declined') AS declined_events FROM payment_feed")(
    lambda s, d: q.incident_summary(feed(s, d, "payment_feed"), "payment_amount_raw")
)


@query("Q23_policy_modes", """
SELECT 'safe' AS mode, 'passed' AS outcome UNION ALL SELECT 'warn', 'warned' UNION ALL SELECT 'error',
  if((SELECT count(*) FROM payment_feed WHERE event_id % 50 = 0) > 0, 'raised', 'passed') UNION ALL SELECT 'other', 'refused'
""")
def policy_modes(spark, sf):
    import warnings

    payments = feed(spark, sf, "payment_feed")
    outcomes = []
    for mode in ("safe", "warn", "error", "other"):
        with warnings.catch_warnings(record=True) as seen:
            warnings.simplefilter("always")
            try:
                q.apply_policy(q.feed_quality(payments, "payment_amount_raw", mode), mode)
                outcome = "warned" if seen else "passed"
            except q.QualityError:
                outcome = "raised"
            except ValueError:
                outcome = "refused"
        outcomes.append((mode, outcome))
    return spark.createDataFrame(outcomes, "mode string, outcome string")


@query("Q24_key_checks", """
WITH v AS (SELECT ticket_id, customer_id FROM raw_tickets), n AS (
SELECT 'not_null visit_date' AS check_name, 0 AS failures
UNION ALL SELECT 'primary_key not_null ticket_id', 0
UNION ALL SELECT 'primary_key unique ticket_id', count(*) - count(DISTINCT ticket_id) FROM v
UNION ALL SELECT 'unique customer_id', count(*) FROM (SELECT customer_id FROM v GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key customer_id', count(*) FROM v WHERE customer_id NOT IN (SELECT c_custkey FROM customer))
SELECT check_name, CAST(failures AS BIGINT) AS failures, if(failures = 0, 'pass', 'error') AS status FROM n
""")
def key_checks(spark, sf):
    tickets = stg_tickets(spark, sf)
    parents = q.foreign_key_lists(["customer_id"], [dim_customers(spark, sf)], ["customer_id"])
    return q.run_checks(tickets, q.key_checks(tickets, "ticket_id", ["customer_id"], ["visit_date"], parents))


query("Q25_audit_columns", f"""
SELECT ticket_id, final_price, TIMESTAMP '{AS_OF} 00:00:00' AS dbt_updated_at, 'run-7' AS dbt_run_id, 'tickets' AS dbt_model_name,
  'prod' AS dbt_env FROM raw_tickets
""")(lambda s, d: stg_tickets(s, d).select("ticket_id", "final_price").withColumns(
    projection.audit_columns("run-7", "tickets", "prod", stamp())
))


@query("Q26_run_log", """
SELECT 'run-1' AS run_id, 'orders_copy' AS model_name, 'main' AS target_schema, 'dev' AS target_env, 'success' AS status,
  (SELECT count(*) FROM orders) AS rows_loaded, true AS is_timed
UNION ALL SELECT 'run-1', 'lines_copy', 'main', 'dev', 'success', (SELECT count(*) FROM lineitem), true
""")
def run_log(spark, sf):
    log = publish.RunLog(spark, fresh_path(spark, "log"), "run-1")
    log.build("orders_copy", table(spark, sf, "orders"), Table(spark, fresh_path(spark, "built")))
    log.build("lines_copy", table(spark, sf, "lineitem"), Table(spark, fresh_path(spark, "built")))
    timed = (F.col("elapsed_seconds") >= 0) & (F.col("completed_at") >= F.col("started_at"))
    return log.read().select("run_id", "model_name", "target_schema", "target_env", "status", "rows_loaded", timed.alias("is_timed"))


@query("Q27_write_audit_publish", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def write_audit_publish(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    target = Table(spark, fresh_path(spark, "wap"))
    rules = lambda df: [
        Check("key unique", rows=q.unique(df, "o_orderkey")), Check("no pending", breaks=F.col("o_orderstatus") == "P")
    ]
    publish.write_audit_publish(target, rows.where("o_orderstatus = 'F'"), rules)
    try:
        publish.write_audit_publish(target, rows, rules)  # holds pending orders and stays unpublished
    except q.QualityError:
        pass
    publish.write_audit_publish(target, rows.where("o_orderstatus <> 'P'"), rules)
    return target.read()


@query("Q27_backup_and_restore", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def backup_and_restore(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    target = Table(spark, fresh_path(spark, "backup"))
    good = target.overwrite(rows.where("o_orderstatus = 'F'"))
    target.overwrite(rows)
    target.restore(good)
    target.vacuum(keep=1)
    return target.read()


query("Q28_relation_diff", """
SELECT ticket_id, 'changed' AS status FROM raw_tickets WHERE promo_code = ''
""")(lambda s, d: compare.differing_rows(
    stg_tickets(s, d), feed(s, d, "raw_tickets"), ["ticket_id"], exclude=["is_discounted"]
))
