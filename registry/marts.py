"""Every modelled table as a query of its own."""

from __future__ import annotations

from registry.base import AS_OF, AS_OF_EVENTS, avg_of, hu, money, query, rd, steps
from registry.inputs import feed, pos_with_customer
from registry.models import (
    AGE_LIMITS, DAY_PART, STAMP, daily, dim_customers, dim_rides, fct_sales, fct_visits, key_sql,
    orders_calendar, ride_metrics, stamp, stg_customers, stg_tickets, ticket_sales, visits,
)
from tidemark.plans import analytics, core, staging

# --- staging -------------------------------------------------------------------------------

query("stg_customers", "FROM stg_customers_q")(lambda s, d: stg_customers(s, d))
query("stg_employees", "FROM stg_employees_q")(lambda s, d: staging.employees(feed(s, d, "raw_employees")))
query("stg_rides", "FROM stg_rides_q")(lambda s, d: staging.rides(feed(s, d, "raw_rides")))
query("stg_visitor_feedback", "FROM stg_feedback_q")(lambda s, d: staging.feedback(feed(s, d, "raw_feedback")))
query("stg_pos_transactions", "FROM raw_pos")(lambda s, d: staging.pos_transactions(pos_with_customer(s, d)))
query("stg_tickets", "FROM stg_tickets_q")(lambda s, d: stg_tickets(s, d))
query("stg_online_sales", "FROM online_q")(lambda s, d: staging.online_sales(feed(s, d, "raw_tickets")))
query("stg_physical_sales", "FROM physical_q")(lambda s, d: staging.physical_sales(feed(s, d, "raw_tickets")))
TICKET_TYPES = f"""
SELECT row_number() OVER (ORDER BY ticket_type) AS ticket_id, ticket_type AS ticket_type_name,
  CAST(NULL AS VARCHAR) AS description, CAST({avg_of('base_price')} AS DECIMAL(10,2)) AS price,
  CAST(NULL AS DATE) AS launch_date, ticket_type IN ('weekend_pass', 'annual_pass') AS includes_fast_pass,
  ticket_type = 'annual_pass' AS includes_vip_benefits,
  CASE ticket_type WHEN 'annual_pass' THEN 5 WHEN 'weekend_pass' THEN 4 WHEN 'day_pass' THEN 3 ELSE 2 END AS fear_level,
  CASE ticket_type WHEN 'annual_pass' THEN 240 WHEN 'weekend_pass' THEN 180 ELSE 120 END AS duration_minutes,
  CAST(NULL AS VARCHAR) AS house_category, TIMESTAMP '{STAMP}' AS created_at, TIMESTAMP '{STAMP}' AS updated_at
FROM raw_tickets GROUP BY ticket_type
"""
query("stg_ticket_types", TICKET_TYPES)(lambda s, d: staging.ticket_types(feed(s, d, "raw_tickets"), stamp()))
query("stg_haunted_houses", "FROM houses_q")(lambda s, d: staging.haunted_houses(feed(s, d, "raw_rides")))
query("stg_haunted_tickets", "FROM haunted_tickets_q")(
    lambda s, d: staging.haunted_tickets(feed(s, d, "raw_tickets"), feed(s, d, "raw_rides"))
)
query("stg_haunted_feedback", "FROM haunted_feedback_q")(
    lambda s, d: staging.haunted_feedback(feed(s, d, "raw_feedback"), feed(s, d, "raw_rides"))
)

# --- intermediate --------------------------------------------------------------------------

query("int_daily_revenue", "FROM daily_q")(lambda s, d: daily(s, d))
query("int_customer_visits", "FROM visits_q")(lambda s, d: visits(s, d))
query("int_ride_metrics", "FROM ride_metrics_q")(lambda s, d: ride_metrics(s, d))

# --- star schema ---------------------------------------------------------------------------

query("dim_customers", "FROM dim_customers_q")(lambda s, d: dim_customers(s, d))
query("dim_employees", f"""
SELECT {key_sql('e.employee_id')} AS employee_key, e.employee_id, e.full_name, e.department, e.role, e.hire_date,
  e.hourly_rate, CAST(e.hourly_rate * 2080 AS DECIMAL(14,2)) AS estimated_annual_salary, e.manager_id,
  m.full_name AS manager_name, e.is_active, e.zone_assignment,
  datediff('year', e.hire_date, DATE '{AS_OF}') AS years_of_service
FROM stg_employees_q e LEFT JOIN stg_employees_q m ON m.employee_id = e.manager_id
""")(lambda s, d: core.dim_employees(staging.employees(feed(s, d, "raw_employees")), AS_OF))
query("dim_rides", "FROM dim_rides_q")(lambda s, d: dim_rides(s, d))
query("dim_ticket_types", TICKET_TYPES)(
    lambda s, d: core.dim_ticket_types(staging.ticket_types(feed(s, d, "raw_tickets"), stamp()))
)
query("dim_transaction_flags", "FROM flags_q")(lambda s, d: core.dim_transaction_flags(ticket_sales(s, d)))
query("dim_dates", "FROM orders_cal")(lambda s, d: orders_calendar(s, d))
query("metric_time_spine", "SELECT date_day FROM orders_cal")(lambda s, d: orders_calendar(s, d).select("date_day"))
query("fct_all_ticket_sales", "FROM ticket_sales_q")(lambda s, d: ticket_sales(s, d))
query("fct_sales", "FROM fct_sales_q")(lambda s, d: fct_sales(s, d))
query("fct_visits", "FROM fct_visits_q")(lambda s, d: fct_visits(s, d))
query("fct_sales_with_junk_key", """
SELECT sale_id, customer_id, ticket_id, purchase_date, visit_date, transaction_flag_key, ticket_price, discount_percent,
  visit_hour, payment_method, created_at, updated_at
FROM ticket_sales_q LEFT JOIN flags_q USING (purchase_channel, is_online, discount_category, same_day_visit,
  advance_purchase, visit_time_category, business_season)
""")(lambda s, d: core.sales_with_junk_key(ticket_sales(s, d)))
query("fct_haunted_tickets", """
SELECT ticket_id, customer_id, haunted_house_id, haunted_house_name, capacity, fear_level, visit_date, ticket_price,
  created_at, updated_at FROM haunted_tickets_q LEFT JOIN houses_q USING (haunted_house_id)
""")(lambda s, d: core.fct_haunted_tickets(
    staging.haunted_tickets(feed(s, d, "raw_tickets"), feed(s, d, "raw_rides")),
    staging.haunted_houses(feed(s, d, "raw_rides")),
))

# --- aggregate marts -----------------------------------------------------------------------


@query("mart_daily_revenue", f"""
SELECT date_day, day_of_week, month_name, quarter, year, is_weekend,
  {money('coalesce(ticket_revenue, 0)')} AS ticket_revenue, {money('coalesce(in_park_revenue, 0)')} AS in_park_revenue,
  {money('coalesce(food_revenue, 0)')} AS food_revenue, {money('coalesce(merch_revenue, 0)')} AS merch_revenue,
  {money('coalesce(total_revenue, 0)')} AS total_revenue, coalesce(unique_visitors, 0) AS unique_visitors,
  coalesce(tickets_sold, 0) AS tickets_sold,
  coalesce({rd('total_revenue', 'unique_visitors')}, 0) AS revenue_per_visitor
FROM orders_cal LEFT JOIN daily_q ON visit_date = date_day
WHERE date_day BETWEEN DATE '1995-01-01' AND DATE '{AS_OF}'
""")
def mart_daily_revenue(spark, sf):
    return analytics.daily_revenue_mart(orders_calendar(spark, sf), daily(spark, sf), "1995-01-01", AS_OF)


@query("agg_customer_lifetime_value", f"""
WITH per_customer AS (
  SELECT customer_id, count(*) AS n, sum(ticket_price) AS t, sum(in_park_spend) AS p, sum(total_visit_spend) AS s,
    CAST({rd('sum(total_visit_spend)', 'count(*)', 6)} AS DECIMAL(18,6)) AS per_visit
  FROM fct_visits_q GROUP BY ALL),
joined AS (
  SELECT loyalty_tier, customer_value_segment, customer_id, coalesce(n, 0) AS n, coalesce(t, 0) AS t,
    coalesce(p, 0) AS p, coalesce(s, 0) AS s, coalesce(per_visit, 0) AS per_visit
  FROM dim_customers_q LEFT JOIN per_customer USING (customer_id))
SELECT loyalty_tier, customer_value_segment, count(customer_id) AS total_customers,
  {avg_of('t')} AS avg_lifetime_ticket_revenue, {avg_of('p')} AS avg_lifetime_in_park_spend,
  {avg_of('s')} AS avg_lifetime_total_spend, {avg_of('n')} AS avg_visits, {avg_of('per_visit')} AS avg_spend_per_visit,
  {money('sum(s)')} AS total_segment_revenue, {avg_of('s')} AS clv
FROM joined GROUP BY ALL
""")
def agg_customer_lifetime_value(spark, sf):
    return analytics.customer_lifetime_value(dim_customers(spark, sf), fct_visits(spark, sf))


query("agg_customer_spending_profile", f"""
SELECT customer_gender AS gender, {steps('customer_age', AGE_LIMITS, '55+', '<')} AS age_group, count(*) AS total_visits,
  {avg_of('ticket_price')} AS avg_ticket_price, {money('sum(ticket_price)')} AS total_spend,
  {avg_of('satisfaction_rating')} AS avg_satisfaction
FROM house_feedback GROUP BY ALL
""")(lambda s, d: analytics.customer_spending_profile(feed(s, d, "house_feedback")))
query("agg_fear_vs_ratings", f"""
SELECT visitor_type, fear_level, {avg_of('satisfaction_rating')} AS avg_satisfaction, count(*) AS total_visits
FROM house_feedback GROUP BY visitor_type, fear_level
UNION ALL SELECT 'All Visitors', fear_level, {avg_of('satisfaction_rating')}, count(*) FROM house_feedback GROUP BY fear_level
""")(lambda s, d: analytics.fear_vs_ratings(feed(s, d, "house_feedback")))


@query("agg_halloween_spending", f"""
SELECT *, {steps('avg_ticket_price', [(200, 'premium'), (100, 'standard'), (40, 'budget')], 'discount')} AS spend_tier
FROM (
  SELECT CASE WHEN days_to_halloween < -14 THEN 'Off Season' WHEN days_to_halloween < 0 THEN 'Post Halloween (2 wks)'
      WHEN days_to_halloween = 0 THEN 'Halloween Day' WHEN days_to_halloween < 8 THEN 'Week of Halloween'
      WHEN days_to_halloween < 31 THEN 'October Pre-Halloween' WHEN days_to_halloween < 61 THEN '2 Months Before'
      ELSE 'Far Out' END AS date_bucket,
    count(sale_id) AS total_tickets, {money('sum(ticket_price)')} AS total_revenue,
    {avg_of('ticket_price')} AS avg_ticket_price, {avg_of('discount_percent')} AS avg_discount_pct
  FROM ticket_sales_q JOIN orders_cal ON visit_date = date_day WHERE visit_date >= DATE '1996-01-01' GROUP BY 1)
""")
def agg_halloween_spending(spark, sf):
    return analytics.halloween_spending(ticket_sales(spark, sf), orders_calendar(spark, sf), "1996-01-01")


REC_RATE = rd("count(*) FILTER (would_recommend) * 100", "count(*)")
query("agg_happiest_houses", f"""
SELECT haunted_house_name, count(*) AS total_visits, {avg_of('satisfaction_rating')} AS avg_satisfaction,
  {REC_RATE} AS recommendation_rate,
  rank() OVER (ORDER BY {avg_of('satisfaction_rating', None)} DESC, count(*) DESC) AS happiness_rank
FROM house_feedback WHERE satisfaction_rating >= 3 GROUP BY haunted_house_name
""")(lambda s, d: analytics.happiest_houses(feed(s, d, "house_feedback")))
query("agg_house_by_time", f"""
SELECT haunted_house_name, visit_hour, {DAY_PART.format(h='visit_hour')} AS time_slot, count(*) AS total_visits,
  {money('sum(ticket_price)')} AS total_revenue, {avg_of('ticket_price')} AS avg_ticket_price,
  {avg_of('satisfaction_rating')} AS avg_satisfaction, {REC_RATE} AS recommendation_rate
FROM house_feedback GROUP BY haunted_house_name, visit_hour
""")(lambda s, d: analytics.house_by_time(feed(s, d, "house_feedback")))
query("agg_ride_popularity", "FROM popularity_q")(lambda s, d: analytics.ride_popularity(dim_rides(s, d)))
query("agg_ticket_value", f"""
WITH g AS (
  SELECT haunted_house_name, CASE WHEN includes_vip_benefits THEN if(includes_fast_pass, 'VIP + Fast Pass', 'VIP Only')
      WHEN includes_fast_pass THEN 'Fast Pass Only' ELSE 'Standard' END AS ticket_tier,
    {avg_of('satisfaction_rating')} AS avg_satisfaction, {avg_of('ticket_price')} AS avg_price, count(*) AS visit_count
  FROM house_feedback GROUP BY ALL)
SELECT *, {rd('avg_satisfaction * 100', 'avg_price', 4)} AS value_index,
  rank() OVER (ORDER BY avg_satisfaction / avg_price DESC NULLS FIRST) AS value_rank FROM g
""")(lambda s, d: analytics.ticket_value(feed(s, d, "house_feedback")))
query("agg_vip_satisfaction", f"""
WITH g AS (SELECT haunted_house_name, includes_vip_benefits AS is_vip, {avg_of('satisfaction_rating')} AS a
           FROM house_feedback GROUP BY ALL),
b AS (SELECT haunted_house_name, max(a) FILTER (is_vip) AS v, max(a) FILTER (NOT is_vip) AS n FROM g GROUP BY ALL)
SELECT haunted_house_name, is_vip, a AS avg_satisfaction,
  CAST(v - n AS DECIMAL(28,2)) AS satisfaction_gap
FROM g JOIN b USING (haunted_house_name)
""")(lambda s, d: analytics.vip_satisfaction(feed(s, d, "house_feedback")))
query("agg_visitor_recommendations", f"""
SELECT *, {steps('recommendation_rate', [(70, 'Promoter'), (50, 'Passive')], 'Detractor')} AS nps_segment,
  rank() OVER (ORDER BY recommendation_rate DESC) AS promoter_rank
FROM (SELECT visitor_type, {REC_RATE} AS recommendation_rate, count(*) AS total_visits FROM house_feedback GROUP BY ALL)
""")(lambda s, d: analytics.visitor_recommendations(feed(s, d, "house_feedback")))

MEAN_RATING = avg_of(hu("avg_rating", 6))
RAW_RATING = avg_of("CAST(avg_rating AS DECIMAL(22,12))", None)


@query("customer_revenue_retention_summary", f"""
WITH r AS (
  SELECT customer_id, count(*) AS total_visits, min(visit_date) AS first_visit_date,
    max(visit_date) AS most_recent_visit_date, {money('sum(ticket_price)')} AS lifetime_ticket_revenue,
    {money('sum(in_park_spend)')} AS lifetime_in_park_spend, {money('sum(total_visit_spend)')} AS lifetime_total_spend,
    {avg_of('total_visit_spend', None)} AS avg_spend_per_visit, {RAW_RATING} AS avg_visit_rating,
    CAST(sum(feedback_count) AS BIGINT) AS feedback_submissions,
    count(*) FILTER (is_discounted) AS discounted_visit_count, count(*) FILTER (is_same_day_visit) AS same_day_visit_count,
    count(*) FILTER (is_advance_purchase) AS advance_purchase_visit_count,
    {avg_of('booking_lead_days')} AS avg_booking_lead_days
  FROM fct_visits_q GROUP BY customer_id)
SELECT customer_id, first_name, last_name, email, registration_date, loyalty_tier, customer_value_segment,
  customer_lifecycle_stage, r.* EXCLUDE (customer_id), DATE '{AS_OF_EVENTS}' - most_recent_visit_date AS days_since_last_visit,
  total_visits > 1 AS is_repeat_visitor,
  {steps('lifetime_total_spend', [(250, 'High Value'), (100, 'Mid Value')], 'Standard')} AS behavioral_value_segment,
  CASE WHEN DATE '{AS_OF_EVENTS}' - most_recent_visit_date <= 90 THEN 'Active'
       WHEN DATE '{AS_OF_EVENTS}' - most_recent_visit_date <= 365 THEN 'Cooling' ELSE 'Lapsed' END AS recency_segment,
  CASE WHEN DATE '{AS_OF_EVENTS}' - most_recent_visit_date > 365 THEN 'High'
       WHEN DATE '{AS_OF_EVENTS}' - most_recent_visit_date > 90 THEN 'Medium' ELSE 'Low' END AS retention_risk_level
FROM dim_customers_q JOIN r USING (customer_id)
""")
def customer_revenue_retention_summary(spark, sf):
    return analytics.revenue_retention_summary(dim_customers(spark, sf), fct_visits(spark, sf), AS_OF_EVENTS)


query("ride_satisfaction_opportunities", """
SELECT * EXCLUDE (has_reviews, review_volume_rank, rating_rank),
  CASE WHEN total_reviews = 0 THEN 'Collect More Feedback'
       WHEN avg_wait_minutes >= 25 AND avg_rating < 3 THEN 'Improve Guest Experience'
       WHEN avg_rating < 4 THEN 'Monitor Performance' WHEN total_reviews < 3 THEN 'Build Awareness'
       WHEN avg_wait_minutes < 25 THEN 'Promote Ride' ELSE 'Monitor Performance' END AS recommended_action,
  CASE WHEN total_reviews = 0 THEN 'Medium' WHEN avg_wait_minutes >= 25 AND avg_rating < 3 THEN 'High'
       WHEN avg_rating >= 4 AND total_reviews < 3 THEN 'Medium' ELSE 'Low' END AS action_priority
FROM popularity_q
""")(lambda s, d: analytics.ride_opportunities(analytics.ride_popularity(dim_rides(s, d))))
