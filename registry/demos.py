"""The further published tables, each as a whole query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry.base import AS_OF, AS_OF_EVENTS, avg_of, cte, money, query, rd, steps, table
from registry.inputs import feed, pos_with_customer
from registry.marts import MEAN_RATING, RAW_RATING
from registry.models import (
    dim_customers, events_calendar, fct_sales, fct_visits, stamp, stg_customers, stg_tickets,
)
from registry.tables import CHECKED, snapshot_sql, two_runs
from tidemark import history, incremental
from tidemark.operators import projection
from tidemark.operators.quality import Check, breaks_not_null
from tidemark.plans import core, demos, staging
from tidemark.publish import RunLog, write_audit_publish
from tidemark.session import fresh_path
from tidemark.sources import writers
from tidemark.sources.table import Table

VISITS = "SELECT ticket_id, customer_id, visit_date, ticket_type, total_visit_spend, avg_rating FROM fct_visits_q"


def summary(spark, sf):
    return demos.visit_summary(fct_visits(spark, sf))


query("demo_01_audit", f"""
SELECT *, TIMESTAMP '2002-01-01 00:00:00' AS dbt_updated_at, 'run-1' AS dbt_run_id, 'visits' AS dbt_model_name, 'dev' AS dbt_env FROM ({VISITS})
""")(lambda s, d: summary(s, d).withColumns(projection.audit_columns("run-1", "visits", "dev", stamp())))


@query("demo_02_incremental_filter", "SELECT ticket_id, customer_id, visit_date, ticket_type, base_price, final_price FROM raw_tickets")
def demo_02(spark, sf):
    rows = stg_tickets(spark, sf).select("ticket_id", "customer_id", "visit_date", "ticket_type", "base_price", "final_price")
    target = Table(spark, fresh_path(spark, "demo02"))
    for last in ("1999-12-31", "2005-01-01"):
        arrived = rows.where(F.col("visit_date") <= F.lit(last).cast("date"))
        incremental.merge(target, incremental.incremental_filter(arrived, target, "visit_date"), "ticket_id")
    return target.read()


query("demo_03_pii_masking", """
SELECT customer_id, first_name, last_name, sha256(email) AS email_masked, left(phone, 2) || '****' AS phone_masked,
  '***REDACTED***' AS address_masked, age, is_vip_member FROM stg_customers_q
""")(lambda s, d: demos.masked_customers(stg_customers(s, d)))
query("demo_04_dynamic_columns", "SELECT * EXCLUDE (item_name) FROM raw_pos")(
    lambda s, d: projection.columns_except(staging.pos_transactions(pos_with_customer(s, d)), ["item_name"])
)


@query("demo_05_row_access_policy", """
SELECT employee_id, full_name, department, role, zone_assignment, hire_date, hourly_rate FROM stg_employees_q
WHERE zone_assignment IN (SELECT 'Zone ' || n_nationkey FROM nation WHERE n_regionkey = 1)
""")
def demo_05(spark, sf):
    from tidemark.operators.joins import visible_rows

    people = demos.employee_directory(core.dim_employees(staging.employees(feed(spark, sf, "raw_employees")), AS_OF))
    allowed = table(spark, sf, "nation").select(
        F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")).alias("viewer"),
        F.concat(F.lit("Zone "), F.col("n_nationkey").cast("string")).alias("value"),
    )
    return visible_rows(people, "zone_assignment", allowed, "region-1", admins=("admin",))


query("demo_06_surrogate_key", """
SELECT md5(transaction_id || '-' || customer_id || '-' || visit_date) AS sk_transaction, transaction_id, customer_id, visit_date,
  category, total_amount, payment_method FROM raw_pos
""")(lambda s, d: demos.keyed_transactions(staging.pos_transactions(pos_with_customer(s, d))))


@query("demo_07_zero_downtime", VISITS)
def demo_07(spark, sf):
    target = Table(spark, fresh_path(spark, "demo07"))
    write_audit_publish(target, summary(spark, sf), lambda df: [Check("ticket", breaks=breaks_not_null("ticket_id"))])
    return target.read()


query("demo_08_data_quality", f"""
SELECT customer_id, first_name, last_name, email, phone, is_vip_member,
  {rd("(4 + if(email LIKE '%@example.com', 3, 0) + 2 + if(phone IS NULL, 0, 1)) * 100", "10", 1)} AS dq_score FROM stg_customers_q
""")(lambda s, d: demos.scored_customers(stg_customers(s, d)))


@query("demo_09_clustering", VISITS)
def demo_09(spark, sf):
    return writers.create_table_as(writers.clustered(summary(spark, sf), "visit_date", "ticket_type"), fresh_path(spark, "demo09"))


query("demo_10_feature_flag_off", "SELECT ticket_id, customer_id, visit_date, ticket_type, final_price, final_price AS revenue FROM raw_tickets")(
    lambda s, d: demos.priced_tickets(stg_tickets(s, d))
)
query("demo_10_feature_flag_on", """
SELECT ticket_id, customer_id, visit_date, ticket_type, final_price, CAST(round(final_price * 1.10, 2) AS DECIMAL(12,2)) AS revenue FROM raw_tickets
""")(lambda s, d: demos.priced_tickets(stg_tickets(s, d), {"use_new_pricing_model": True}))
query("demo_11_generic_tests", """
SELECT ticket_id, t.customer_id, t.visit_date, ticket_type, rating AS satisfaction_rating
FROM ev_tickets t LEFT JOIN raw_feedback f ON f.customer_id = t.customer_id AND f.visit_date = t.visit_date
""")(lambda s, d: demos.tickets_with_ratings(stg_tickets(s, d, "ev_tickets"), staging.feedback(feed(s, d, "raw_feedback"))))
query("demo_12_date_spine", f"""
SELECT date_day AS visit_date, coalesce(n, 0) AS total_visits, {money('coalesce(total, 0)')} AS total_revenue, avg_rating
FROM events_cal LEFT JOIN (SELECT visit_date, count(*) AS n, sum(total_visit_spend) AS total, {RAW_RATING} AS avg_rating
  FROM fct_visits_q GROUP BY ALL) ON visit_date = date_day
""")(lambda s, d: demos.daily_visits(events_calendar(s, d).select(F.col("date_day").alias("visit_date")), fct_visits(s, d)))
query("demo_13_query_tag", VISITS)(lambda s, d: summary(s, d))


@query("demo_14_scd", "SELECT customer_id, first_name, last_name, email, dbt_scd_id, dbt_updated_at, dbt_valid_from, dbt_valid_to, "
       "true AS is_current_record FROM (" + snapshot_sql(
           "stg_customers_q", "customer_id", "customer_id % 11 = 0", "customer_id % 13 = 0",
           {"loyalty_points": "CASE WHEN customer_id % 6 = 0 THEN loyalty_points + 50 ELSE loyalty_points END"}, CHECKED, True)
       + ") WHERE dbt_valid_to IS NULL")
def demo_14(spark, sf):
    raised = F.col("loyalty_points") + F.when(F.col("customer_id") % 6 == 0, 50).otherwise(0)
    kept = two_runs(
        spark, stg_customers(spark, sf), "customer_id", "customer_id % 11 = 0", "customer_id % 13 = 0", {"loyalty_points": raised},
        check_columns=CHECKED, hard_deletes=True,
    )
    return history.scd_columns(kept.current(), "customer_id", "first_name", "last_name", "email")


@query("demo_15_partitioning", VISITS)
def demo_15(spark, sf):
    target = Table(spark, fresh_path(spark, "demo15"))
    for last in ("2024-01-20", "2024-12-31"):
        arrived = summary(spark, sf).where(F.col("visit_date") <= F.lit(last).cast("date"))
        fresh = incremental.incremental_filter(arrived, target, "visit_date")
        incremental.merge(target, writers.clustered(fresh, "visit_date", "ticket_type"), "ticket_id")
    return target.read()


query("demo_16_temp_table", f"""
SELECT ticket_type, count(*) AS total_visits, {avg_of('total_visit_spend')} AS avg_spend, {MEAN_RATING} AS avg_rating,
  min(visit_date) AS first_visit, max(visit_date) AS last_visit FROM fct_visits_q GROUP BY ALL
""")(lambda s, d: writers.temp_table(demos.visits_by_type(fct_visits(s, d)), "visits_by_type"))
query("demo_19_sales_projection", """
SELECT transaction_id, customer_id, visit_date, category, item_name, quantity, unit_price, total_amount, payment_method, location FROM raw_pos
""")(lambda s, d: fct_sales(s, d).select(
    "transaction_id", "customer_id", "visit_date", "category", "item_name", "quantity", "unit_price", "total_amount", "payment_method", "location"
))
query("demo_20_constraints", """
SELECT visit_key AS sale_id, ticket_id, customer_id, visit_date, ticket_type, ticket_price, in_park_spend, total_visit_spend, avg_rating FROM fct_visits_q
""")(lambda s, d: demos.constrained_visits(fct_visits(s, d)))
query("demo_26_ephemeral_consumer", f"""
WITH e AS (SELECT *, {steps('total_amount', [(100, 'high'), (40, 'mid')], 'low')} AS spending_tier,
  CASE WHEN category IN ('Fast Food', 'Craft Bev') THEN 'Food & Beverage' WHEN category = 'Gift Merch' THEN 'Merchandise'
       WHEN category = 'Ticket Upgrade' THEN 'Ticket' ELSE 'Other' END AS revenue_category FROM ev_pos)
SELECT revenue_category, spending_tier, payment_method, count(*) AS transaction_count, {money('sum(total_amount)')} AS total_revenue,
  {avg_of('total_amount')} AS avg_transaction_value, count(*) FILTER (total_amount >= 100) AS high_value_count,
  {rd('count(*) FILTER (total_amount >= 100) * 100', 'count(*)', 1)} AS high_value_pct FROM e GROUP BY ALL
""")(lambda s, d: demos.transaction_summary(demos.enriched_transactions(staging.pos_transactions(feed(s, d, "ev_pos")))))
query("demo_27_sales_by_outlet", f"""
SELECT visit_date, category, location, count(*) AS transaction_count, {money('sum(total_amount)')} AS total_revenue,
  {avg_of('total_amount', None)} AS avg_transaction_value, min(total_amount) AS min_transaction_value,
  max(total_amount) AS max_transaction_value FROM raw_pos GROUP BY ALL
""")(lambda s, d: demos.sales_by_outlet(fct_sales(s, d)))
query("demo_28_date_window", f"""
SELECT customer_id, count(*) AS visit_count, {money('sum(total_visit_spend)')} AS total_spend, {avg_of('total_visit_spend')} AS avg_spend_per_visit,
  {MEAN_RATING} AS avg_rating, min(visit_date) AS first_visit_in_window, max(visit_date) AS last_visit_in_window, 30 AS window_days
FROM fct_visits_q WHERE visit_date >= DATE '{AS_OF_EVENTS}' - 30 GROUP BY customer_id
""")(lambda s, d: demos.recent_customers(fct_visits(s, d), 30, AS_OF_EVENTS))
query("demo_29_spend_tiers", f"""
SELECT customer_id, visit_date, ticket_type, total_visit_spend, avg_rating,
  {steps('total_visit_spend', [(300, 'High'), (100, 'Mid')], 'Low')} AS spend_tier, 300 AS tier_high_threshold, 100 AS tier_mid_threshold
FROM fct_visits_q
""")(lambda s, d: demos.spend_tiers(fct_visits(s, d)))
query("demo_30_visit_windows", f"""
SELECT ticket_id, customer_id, ticket_type, visit_date, total_visit_spend, avg_rating,
  {money('sum(total_visit_spend) OVER (PARTITION BY customer_id ORDER BY visit_date, ticket_id ROWS UNBOUNDED PRECEDING)')} AS running_total_spend,
  dense_rank() OVER (PARTITION BY ticket_type ORDER BY total_visit_spend DESC) AS spend_rank_in_ticket_type,
  {rd('sum(total_visit_spend) OVER w', 'count(*) OVER w')} AS avg_spend_for_ticket_type,
  {rd('total_visit_spend * (count(*) OVER w) - (sum(total_visit_spend) OVER w)', 'count(*) OVER w')} AS spend_vs_ticket_avg
FROM fct_visits_q WINDOW w AS (PARTITION BY ticket_type)
""")(lambda s, d: demos.visit_windows(fct_visits(s, d)))
query("demo_31_visits_with_customers", """
SELECT customer_id, loyalty_tier, customer_value_segment, age_group, visit_date, ticket_type, total_visit_spend, avg_rating
FROM fct_visits_q JOIN dim_customers_q USING (customer_id)
""")(lambda s, d: demos.visits_with_customers(fct_visits(s, d), dim_customers(s, d)))
query("demo_32_weekly_revenue", f"""
SELECT *, {money('sum(total_revenue) OVER (PARTITION BY ticket_type ORDER BY week_start ROWS UNBOUNDED PRECEDING)')} AS running_revenue_by_type
FROM (SELECT CAST(date_trunc('week', visit_date) AS DATE) AS week_start, 'Mon' AS week_start_day, ticket_type, count(*) AS visit_count,
  {money('sum(total_visit_spend)')} AS total_revenue, {avg_of('total_visit_spend')} AS avg_spend_per_visit, {MEAN_RATING} AS avg_rating
  FROM fct_visits_q GROUP BY ALL)
""")(lambda s, d: demos.weekly_revenue(fct_visits(s, d)))
cte("ltv_q", f"""
SELECT customer_id, loyalty_tier, customer_value_segment, is_vip_member, registration_date, count(*) AS total_visits,
  min(visit_date) AS first_visit_date, max(visit_date) AS last_visit_date, max(visit_date) - min(visit_date) AS active_days,
  {money('sum(total_visit_spend)')} AS lifetime_spend, {avg_of('total_visit_spend')} AS avg_spend_per_visit,
  {MEAN_RATING} AS avg_satisfaction_rating,
  {rd("sum(total_visit_spend)", "datediff('month', min(visit_date), max(visit_date))")} AS avg_monthly_spend,
  {steps('sum(total_visit_spend)', [(500, 'Platinum'), (200, 'Gold'), (50, 'Silver')], 'Bronze')} AS ltv_segment
FROM fct_visits_q JOIN dim_customers_q USING (customer_id) GROUP BY ALL
""")


@query("demo_33_customer_ltv", "FROM ltv_q")
def demo_33(spark, sf):
    target = Table(spark, fresh_path(spark, "demo33"))
    RunLog(spark, fresh_path(spark, "log"), "run-33").build(
        "customer_ltv", demos.customer_ltv(fct_visits(spark, sf), dim_customers(spark, sf)), target
    )
    return target.read()


query("demo_34_contract_table", "SELECT visit_key, customer_id, visit_date, ticket_type, CAST(total_visit_spend AS DECIMAL(12,2)) AS "
      "total_visit_spend, CAST(avg_rating AS DECIMAL(4,2)) AS avg_rating FROM fct_visits_q")(
    lambda s, d: demos.governed_visits(fct_visits(s, d))
)
query("demo_38_upstream", "SELECT customer_id, 1 AS force_failure FROM raw_customers")(lambda s, d: demos.failing_probe(dim_customers(s, d)))
query("demo_38_downstream", "SELECT count(*) AS customer_count FROM customer")(lambda s, d: demos.customer_count(dim_customers(s, d)))
query("demo_40_base_model", """
SELECT transaction_id AS sales_transaction_id, customer_id, visit_date, category AS product_category, item_name AS product_name, quantity,
  unit_price, total_amount AS gross_revenue, payment_method, location AS location_name, false AS is_guest_checkout,
  TIMESTAMP '2002-01-01 00:00:00' AS dbt_updated_at, 'run-40' AS dbt_run_id, 'sales_base' AS dbt_model_name, 'dev' AS dbt_env FROM raw_pos
""")(lambda s, d: projection.base_model(
    pos_with_customer(s, d),
    {
        "transaction_id": "sales_transaction_id", "customer_id": "customer_id", "visit_date": "visit_date",
        "category": "product_category", "item_name": "product_name", "quantity": "quantity", "unit_price": "unit_price",
        "total_amount": "gross_revenue", "payment_method": "payment_method", "location": "location_name",
        "(customer_id is null)": "is_guest_checkout",
    },
    where="transaction_id is not null",
    audit=projection.audit_columns("run-40", "sales_base", "dev", stamp()),
))


# === incremental tables over the modelled facts =============================================


@query("demo_21_incremental_merge", """
WITH f AS (SELECT *, CAST(date_trunc('year', purchase_date) AS DATE) AS purchase_year FROM ticket_sales_q),
late AS (SELECT * FROM f WHERE sale_id % 5 = 2 AND purchase_date >= DATE '2001-01-01')
SELECT * REPLACE (
  CASE WHEN sale_id % 5 = 2 AND purchase_date >= DATE '2001-01-01' THEN CAST(ticket_price + 10 AS DECIMAL(10,2)) ELSE ticket_price END AS ticket_price,
  CASE WHEN sale_id % 5 = 1 OR (sale_id % 5 = 2 AND purchase_date >= DATE '2001-01-01') THEN TIMESTAMP '2002-02-01' ELSE updated_at END AS updated_at,
  CASE WHEN sale_id % 5 = 1 THEN TIMESTAMP '2002-02-01' ELSE created_at END AS created_at)
FROM f
""")
def demo_21(spark, sf):
    from registry.models import ticket_sales

    sales = ticket_sales(spark, sf).withColumn("purchase_year", F.trunc("purchase_date", "year"))
    target = Table(spark, fresh_path(spark, "demo21"), "purchase_year")
    rule = dict(key="sale_id", update_columns=["ticket_price", "discount_percent", "discount_category", "updated_at"],
                on_schema_change="sync_all_columns")
    incremental.merge(target, incremental.newer_rows(sales.where("sale_id % 5 <> 1"), target, "updated_at"), **rule)
    now = F.lit("2002-02-01 00:00:00").cast("timestamp_ntz")
    changed = (F.col("sale_id") % 5 == 2) & (F.col("purchase_date") >= F.lit("2001-01-01").cast("date"))
    price = F.when(changed, F.col("ticket_price") + 10).otherwise(F.col("ticket_price")).cast("decimal(10,2)")
    arrived = sales.where((F.col("sale_id") % 5 == 1) | changed).withColumns(
        {"ticket_price": price, "created_at": now, "updated_at": now}
    )
    incremental.merge(target, incremental.newer_rows(arrived, target, "updated_at"), since=dt.date(2001, 1, 1), outside="raise", **rule)
    return target.read()


@query("demo_22_incremental_append", "FROM fct_sales_q")
def demo_22(spark, sf):
    target = Table(spark, fresh_path(spark, "demo22"))
    for last in ("1999-06-30", "2005-01-01"):
        arrived = fct_sales(spark, sf).where(F.col("visit_date") <= F.lit(last).cast("date"))
        incremental.append(target, incremental.newer_rows(arrived, target, "visit_date", "1900-01-01"))
    return target.read()


DAILY_VISITS = f"""SELECT visit_date, ticket_type, count(DISTINCT customer_id) AS unique_visitors, count(*) AS total_visits,
  {money('sum(ticket_price)')} AS total_ticket_revenue, {money('sum(in_park_spend)')} AS total_in_park_spend,
  {money('sum(total_visit_spend)')} AS total_visit_spend, {MEAN_RATING} AS avg_satisfaction_rating,
  min(ticket_price) AS min_ticket_price, max(ticket_price) AS max_ticket_price FROM fct_visits_q GROUP BY visit_date, ticket_type"""


@query("demo_23_incremental_delete_insert", f"""
SELECT * REPLACE (CASE WHEN visit_date >= DATE '2024-01-22' THEN total_visits ELSE total_visits + 50 END AS total_visits) FROM ({DAILY_VISITS})
""")
def demo_23(spark, sf):
    daily = demos.daily_visit_summary(fct_visits(spark, sf))
    target = Table(spark, fresh_path(spark, "demo23"))
    early = daily.where("visit_date <= DATE '2024-01-25'").withColumn("total_visits", F.col("total_visits") + 50)
    incremental.delete_insert(target, early, "visit_date")
    incremental.delete_insert(target, incremental.look_back_rows(daily, target, "visit_date", 3), "visit_date")
    return target.read()


MONTHLY_REVENUE = f"""SELECT CAST(date_trunc('month', visit_date) AS DATE) AS revenue_month, category, location, payment_method,
  {money('sum(total_amount)')} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  count(DISTINCT transaction_id) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
  {avg_of('total_amount')} AS avg_transaction_value, max(total_amount) AS max_transaction_value
  FROM fct_sales_q GROUP BY ALL"""


@query("demo_24_incremental_insert_overwrite", f"""
SELECT * REPLACE (CASE WHEN revenue_month >= DATE '2001-06-01' THEN total_units_sold ELSE total_units_sold + 5 END AS total_units_sold)
FROM ({MONTHLY_REVENUE})
""")
def demo_24(spark, sf):
    monthly = demos.monthly_revenue(fct_sales(spark, sf))
    target = Table(spark, fresh_path(spark, "demo24"), "revenue_month")
    incremental.insert_overwrite(target, monthly.withColumn("total_units_sold", F.col("total_units_sold") + 5))
    incremental.insert_overwrite(target, incremental.month_window(monthly, "revenue_month", as_of="2001-07-15"), "partitions")
    return target.read()


EVENT_SALES = """SELECT ticket_id AS sale_id, customer_id, visit_date AS purchase_date, CAST(visit_date AS TIMESTAMP) AS purchase_ts,
  final_price AS ticket_price, purchase_channel FROM ev_tickets"""


@query("demo_25_incremental_microbatch", f"""
SELECT * REPLACE (if(purchase_date >= DATE '2024-01-25', 'checked', purchase_channel) AS purchase_channel) FROM ({EVENT_SALES})
""")
def demo_25(spark, sf):
    sales = stg_tickets(spark, sf, "ev_tickets").select(
        F.col("ticket_id").alias("sale_id"), "customer_id", F.col("visit_date").alias("purchase_date"),
        F.col("visit_date").cast("timestamp_ntz").alias("purchase_ts"), F.col("final_price").alias("ticket_price"), "purchase_channel",
    )
    target = Table(spark, fresh_path(spark, "demo25"), "purchase_date")
    begin, stop, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 29), dt.datetime(2024, 2, 1)
    incremental.microbatch(target, sales, "purchase_ts", begin, stop)
    checked = sales.withColumn("purchase_channel", F.lit("checked"))
    incremental.microbatch(target, checked, "purchase_ts", begin, end, look_back=3)
    return target.read()
