"""Spark frames and check sub-queries of the modelled tables over the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.base import AS_OF, FEAR_SQL, POINTS_SQL, SCARE_SQL, avg_of, cte, hu, money, rd, steps
from registry.inputs import feed, pos_with_customer
from tidemark.operators.calendar import calendar, spine_over
from tidemark.plans import core, intermediate, staging

STAMP = "2002-01-01 00:00:00"


def stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


# --- Spark ---------------------------------------------------------------------------------


def orders_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return calendar(spine_over(feed(spark, sf, "raw_tickets"), "visit_date"))


def events_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return calendar(spine_over(feed(spark, sf, "payment_feed"), F.to_date("event_timestamp")))


def stg_tickets(spark, sf, source="raw_tickets") -> DataFrame:
    raw = feed(spark, sf, source)
    return staging.tickets(raw, raw)


def stg_customers(spark, sf, as_of=AS_OF) -> DataFrame:
    return staging.customers(feed(spark, sf, "raw_customers"), as_of)


def dim_customers(spark, sf, as_of=AS_OF) -> DataFrame:
    return core.dim_customers(stg_customers(spark, sf, as_of), as_of)


def daily(spark, sf) -> DataFrame:
    pos = staging.pos_transactions(feed(spark, sf, "raw_pos_lines"))
    return intermediate.daily_revenue(stg_tickets(spark, sf), pos)


def visits(spark, sf) -> DataFrame:
    """Visits of the event data, where tickets, sales and feedback share guests and days."""
    return intermediate.customer_visits(
        stg_tickets(spark, sf, "ev_tickets"),
        staging.pos_transactions(feed(spark, sf, "ev_pos")),
        staging.feedback(feed(spark, sf, "raw_feedback")),
    )


def fct_visits(spark, sf) -> DataFrame:
    return core.fct_visits(visits(spark, sf), events_calendar(spark, sf))


def ride_metrics(spark, sf) -> DataFrame:
    return intermediate.ride_metrics(
        staging.rides(feed(spark, sf, "raw_rides")), staging.feedback(feed(spark, sf, "raw_feedback"))
    )


def dim_rides(spark, sf) -> DataFrame:
    return core.dim_rides(ride_metrics(spark, sf))


def ticket_sales(spark, sf) -> DataFrame:
    raw = feed(spark, sf, "raw_tickets")
    return core.all_ticket_sales(staging.online_sales(raw), staging.physical_sales(raw), stamp())


def fct_sales(spark, sf) -> DataFrame:
    return core.fct_sales(staging.pos_transactions(pos_with_customer(spark, sf)), orders_calendar(spark, sf))


# --- check sub-queries ---------------------------------------------------------------------

AGE_LIMITS = [(18, "Under 18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
SEASON = (
    "CASE WHEN month({d}) IN (10, 11) THEN 'Halloween Season' WHEN month({d}) BETWEEN 6 AND 8 THEN 'Summer' "
    "WHEN month({d}) IN (12, 1, 2) THEN 'Winter' WHEN month({d}) BETWEEN 3 AND 5 THEN 'Spring' ELSE 'Fall' END"
)
DAY_PART = (
    "CASE WHEN {h} BETWEEN 0 AND 11 THEN 'Morning' WHEN {h} BETWEEN 12 AND 17 THEN 'Afternoon' "
    "WHEN {h} BETWEEN 18 AND 20 THEN 'Evening' ELSE 'Night' END"
)


def key_sql(*columns: str) -> str:
    return "md5(" + " || '-' || ".join(
        f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns
    ) + ")"


CALENDAR_COLUMNS = f"""
  d AS date_day, CAST(year(d) AS INT) AS year, CAST(year(d) AS INT) AS year_number,
  CAST(month(d) AS INT) AS month_number, strftime(d, '%b') AS month_name, CAST(day(d) AS INT) AS day_number,
  CAST(dayofweek(d) AS INT) AS day_of_week_number, strftime(d, '%a') AS day_of_week, CAST(quarter(d) AS INT) AS quarter,
  dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%m-%d') = '10-31' AS is_halloween,
  CAST(make_date(year(d), 10, 31) - d AS INT) AS days_to_halloween,
  {SEASON.format(d='d')} AS business_season
"""


def calendar_sql(days: str) -> str:
    return f"SELECT {CALENDAR_COLUMNS} FROM ({days})"


def span_sql(column: str, source: str) -> str:
    return (
        f"SELECT CAST(unnest(generate_series(min({column}), max({column}), INTERVAL 1 DAY)) AS DATE) AS d FROM {source}"
    )


cte("orders_cal", calendar_sql(span_sql("CAST(o_orderdate AS DATE)", "orders")))
cte("events_cal", calendar_sql(span_sql("CAST(ts AS DATE)", "events")))

cte("stg_customers_q", f"""
SELECT customer_id, first_name, last_name, lower(email) AS email, phone,
  CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
  CAST(NULL AS VARCHAR) AS zip_code, CAST(datediff('year', date_of_birth, DATE '{AS_OF}') AS INT) AS age,
  CAST(NULL AS VARCHAR) AS gender,
  coalesce(membership_type IN ('gold', 'platinum'), false) AS is_vip_member, false AS marketing_opt_in,
  {SCARE_SQL} AS preferred_scare_level,
  {POINTS_SQL} AS loyalty_points,
  CAST(created_at AS DATE) AS registration_date, created_at, created_at AS updated_at
FROM raw_customers
""")
cte("dim_customers_q", f"""
SELECT customer_id, first_name, last_name, email,
  regexp_full_match(email, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}') AS is_valid_email,
  phone, address, city, state, state AS state_name, zip_code, age, gender, is_vip_member, marketing_opt_in,
  preferred_scare_level, loyalty_points, registration_date,
  {steps('age', AGE_LIMITS, '55+', '<')} AS age_group,
  {steps('loyalty_points', [(1000, 'Gold'), (500, 'Silver')], 'Bronze')} AS loyalty_tier,
  CASE WHEN is_vip_member AND loyalty_points >= 1000 THEN 'High Value'
       WHEN is_vip_member OR loyalty_points >= 500 THEN 'Mid Value' ELSE 'Standard' END AS customer_value_segment,
  CASE WHEN months <= 3 THEN 'New' WHEN months <= 12 THEN 'Growing' ELSE 'Established' END AS customer_lifecycle_stage,
  CASE WHEN loyalty_points < 100 AND months > 6 THEN 'High' WHEN loyalty_points < 300 THEN 'Medium' ELSE 'Low' END
    AS retention_risk_level,
  CASE WHEN NOT is_vip_member AND loyalty_points >= 400 THEN 'VIP Upgrade'
       WHEN marketing_opt_in AND NOT is_vip_member THEN 'Premium Pass' ELSE 'None' END AS upsell_opportunity,
  created_at, updated_at
FROM (SELECT *, datediff('month', registration_date, DATE '{AS_OF}') AS months FROM stg_customers_q)
""")
cte("stg_employees_q", """
SELECT employee_id, first_name, last_name, first_name || ' ' || last_name AS full_name, department, role, hire_date,
  hourly_rate, manager_id, is_active, zone_assignment, CAST(hire_date AS TIMESTAMP) AS updated_at
FROM raw_employees
""")
cte("stg_rides_q", """
SELECT ride_id, ride_name, ride_type, nullif(CAST(min_height_cm AS INT), 0) AS min_height_cm, thrill_level,
  CAST(capacity_per_hour AS INT) AS capacity_per_hour, zone, is_haunted, opened_date, status,
  CAST(avg_wait_minutes AS INT) AS avg_wait_minutes, CAST(opened_date AS TIMESTAMP) AS updated_at
FROM raw_rides
""")
cte("stg_feedback_q", """
SELECT feedback_id, customer_id, visit_date, ride_id, rating, category, sentiment, comments, submitted_at,
  CASE WHEN rating > 3 THEN 'positive' WHEN rating = 3 THEN 'neutral' ELSE 'negative' END AS rating_category
FROM raw_feedback
""")
STG_TICKETS = """
SELECT ticket_id, customer_id, ticket_type, purchase_date, visit_date, purchase_channel, base_price, discount_amount,
  final_price, nullif(promo_code, '') AS promo_code, discount_amount > 0 AS is_discounted
FROM {source}
"""
cte("stg_tickets_q", STG_TICKETS.format(source="raw_tickets"))
cte("stg_ev_tickets_q", STG_TICKETS.format(source="ev_tickets"))
cte("daily_q", f"""
SELECT visit_date, {money('coalesce(tr, 0)')} AS ticket_revenue, {money('coalesce(pr, 0)')} AS in_park_revenue,
  {money('coalesce(food, 0)')} AS food_revenue, {money('coalesce(merch, 0)')} AS merch_revenue,
  {money('coalesce(tr, 0) + coalesce(pr, 0)')} AS total_revenue,
  coalesce(uv, 0) AS unique_visitors, coalesce(n, 0) AS tickets_sold
FROM (SELECT visit_date, sum(final_price) AS tr, count(DISTINCT customer_id) AS uv, count(ticket_id) AS n
      FROM stg_tickets_q GROUP BY ALL)
FULL JOIN (SELECT visit_date, sum(total_amount) AS pr, sum(total_amount) FILTER (category = 'food') AS food,
             sum(total_amount) FILTER (category = 'merchandise') AS merch FROM raw_pos_lines GROUP BY ALL)
USING (visit_date)
""")
cte("visits_q", f"""
SELECT ticket_id, customer_id, visit_date, ticket_type, purchase_date, purchase_channel, is_discounted,
  final_price AS ticket_price, CAST(coalesce(spend, 0) AS DECIMAL(14,2)) AS in_park_spend,
  CAST(final_price + coalesce(spend, 0) AS DECIMAL(14,2)) AS total_visit_spend,
  CAST(visit_date - purchase_date AS BIGINT) AS booking_lead_days, visit_date = purchase_date AS is_same_day_visit,
  visit_date - purchase_date >= 7 AS is_advance_purchase, avg_rating,
  coalesce(reviews, 0) AS feedback_count, coalesce(reviews, 0) > 0 AS has_feedback
FROM stg_ev_tickets_q
LEFT JOIN (SELECT customer_id, visit_date, sum(total_amount) AS spend FROM ev_pos GROUP BY ALL)
  USING (customer_id, visit_date)
LEFT JOIN (SELECT customer_id, visit_date, {avg_of('rating', None)} AS avg_rating, count(*) AS reviews
           FROM raw_feedback GROUP BY ALL) USING (customer_id, visit_date)
""")
cte("fct_visits_q", f"""
SELECT {key_sql('ticket_id')} AS visit_key, ticket_id, customer_id, visit_date, day_of_week, month_name, quarter, year,
  is_weekend, ticket_type, purchase_date, purchase_channel, booking_lead_days, is_same_day_visit, is_advance_purchase,
  is_discounted, ticket_price, in_park_spend, total_visit_spend, feedback_count, has_feedback, avg_rating
FROM visits_q LEFT JOIN events_cal ON visit_date = date_day
""")
cte("ride_metrics_q", f"""
SELECT ride_id, ride_name, ride_type, min_height_cm, thrill_level, zone, is_haunted, status, opened_date,
  capacity_per_hour, avg_wait_minutes, coalesce(n, 0) AS total_reviews, coalesce(avg_rating, 0) AS avg_rating,
  coalesce(pos, 0) AS positive_reviews, coalesce(mid, 0) AS neutral_reviews, coalesce(neg, 0) AS negative_reviews,
  coalesce({rd('pos * 100', 'n')}, 0) AS positive_review_pct, n IS NOT NULL AS has_reviews,
  CASE WHEN n IS NULL THEN 'No Reviews' WHEN n = 1 THEN 'Single Review' WHEN n < 5 THEN 'Low Volume'
       ELSE 'Established' END AS review_count_band
FROM stg_rides_q LEFT JOIN (
  SELECT ride_id, count(*) AS n, {avg_of('rating', None)} AS avg_rating, count(*) FILTER (rating > 3) AS pos,
    count(*) FILTER (rating = 3) AS mid, count(*) FILTER (rating < 3) AS neg
  FROM raw_feedback WHERE category = 'ride' AND ride_id IS NOT NULL GROUP BY ride_id) USING (ride_id)
""")
cte("dim_rides_q", f"""
SELECT {key_sql('ride_id')} AS ride_key, * REPLACE ({hu('avg_rating')} AS avg_rating) FROM ride_metrics_q
""")
CHANNEL = """
SELECT ticket_id AS sale_id, customer_id, ticket_id, purchase_date, visit_date,
  CAST(NULL AS TIMESTAMP) AS purchase_timestamp, final_price AS ticket_price,
  CAST(CASE WHEN base_price > 0 THEN round(CAST(discount_amount AS DOUBLE) / base_price * 100, 2) ELSE 0 END
    AS DECIMAL(5,2)) AS discount_percent,
  CAST(NULL AS INT) AS visit_hour, '{payment}' AS payment_method, '{channel}' AS purchase_channel, {online} AS is_online
FROM raw_tickets WHERE (purchase_channel = 'online') = {online}
"""
cte("online_q", CHANNEL.format(payment="credit_card", channel="online", online="true"))
cte("physical_q", CHANNEL.format(payment="cash", channel="physical", online="false"))
cte("ticket_sales_q", f"""
SELECT sale_id, customer_id, ticket_id, purchase_date, visit_date, purchase_timestamp, ticket_price, discount_percent,
  CASE WHEN discount_percent = 0 THEN 'No Discount' WHEN discount_percent < 10 THEN 'Low Discount'
       WHEN discount_percent < 25 THEN 'Mid Discount' ELSE 'High Discount' END AS discount_category,
  visit_hour, payment_method, purchase_channel, is_online, purchase_date = visit_date AS same_day_visit,
  purchase_date < visit_date AS advance_purchase, 'Night' AS visit_time_category,
  {SEASON.format(d='visit_date')} AS business_season,
  TIMESTAMP '{STAMP}' AS created_at, TIMESTAMP '{STAMP}' AS updated_at
FROM (FROM online_q UNION ALL FROM physical_q)
""")
cte("flags_q", f"""
SELECT {key_sql('purchase_channel', 'is_online', 'discount_category', 'same_day_visit', 'advance_purchase',
                'visit_time_category', 'business_season')} AS transaction_flag_key, *,
  concat_ws(' | ', purchase_channel, if(is_online, 'online', 'offline'), discount_category,
    if(same_day_visit, 'same_day', 'advance'), visit_time_category, business_season) AS flag_combo_label
FROM (SELECT DISTINCT purchase_channel, is_online, discount_category, same_day_visit, advance_purchase,
        visit_time_category, business_season FROM ticket_sales_q)
""")
cte("fct_sales_q", f"""
SELECT {key_sql('transaction_id')} AS sales_key, transaction_id, customer_id, visit_date, day_of_week, month_name,
  quarter, year, is_weekend, category, item_name, quantity, unit_price, total_amount, payment_method, location
FROM raw_pos LEFT JOIN orders_cal ON visit_date = date_day
""")
cte("houses_q", f"""
SELECT ride_id AS haunted_house_id, ride_name AS haunted_house_name, CAST(capacity_per_hour AS INT) AS capacity,
  {FEAR_SQL} AS fear_level
FROM raw_rides WHERE is_haunted
""")
cte("haunted_tickets_q", """
SELECT ticket_id, customer_id, haunted_house_id, visit_date, final_price AS ticket_price,
  CAST(purchase_date AS TIMESTAMP) AS created_at, CAST(purchase_date AS TIMESTAMP) AS updated_at
FROM raw_tickets
JOIN (SELECT haunted_house_id, row_number() OVER (ORDER BY haunted_house_id) - 1 AS slot, count(*) OVER () AS slots
      FROM houses_q) ON slot = ((ticket_id - 1) % slots + slots) % slots
""")
cte("haunted_feedback_q", """
SELECT feedback_id, CAST(NULL AS BIGINT) AS sale_id, coalesce(haunted_house_name, 'Unknown House') AS haunted_house_name,
  coalesce(fear_level, 3) AS fear_level, CAST(NULL AS DECIMAL(10,2)) AS ticket_price,
  CAST(NULL AS BOOLEAN) AS includes_vip_benefits, CAST(NULL AS BOOLEAN) AS includes_fast_pass, category AS visitor_type,
  CAST(NULL AS INT) AS customer_age, CAST(NULL AS VARCHAR) AS customer_gender, rating AS satisfaction_rating,
  rating >= 4 AS would_recommend, visit_date, CAST(NULL AS INT) AS visit_hour
FROM raw_feedback LEFT JOIN houses_q ON ride_id = haunted_house_id
""")
cte("popularity_q", """
SELECT ride_key, ride_id, ride_name, ride_type, thrill_level, zone, is_haunted, status, capacity_per_hour,
  avg_wait_minutes, total_reviews, avg_rating, positive_review_pct, has_reviews, review_count_band,
  CASE WHEN avg_rating >= 4.5 THEN 'Top Rated' WHEN avg_rating >= 3.5 THEN 'Well Rated'
       WHEN avg_rating >= 2.5 THEN 'Average' WHEN avg_rating > 0 THEN 'Below Average' ELSE 'Not Yet Rated' END AS rating_tier,
  CASE WHEN total_reviews >= 3 THEN 'Proven Favorite' WHEN total_reviews > 0 THEN 'Emerging Interest'
       ELSE 'Needs Awareness' END AS popularity_segment,
  CASE WHEN total_reviews = 0 THEN 'No Feedback Yet'
       WHEN avg_wait_minutes >= 25 AND avg_rating < 3 THEN 'High Wait / Low Satisfaction'
       WHEN avg_rating < 4 THEN 'Monitor'
       WHEN avg_wait_minutes >= 25 THEN 'High Wait / Strong Satisfaction'
       ELSE 'Low Wait / Strong Satisfaction' END AS wait_experience_segment,
  rank() OVER (ORDER BY total_reviews DESC, avg_rating DESC NULLS LAST) AS review_volume_rank,
  rank() OVER (ORDER BY avg_rating DESC NULLS LAST, total_reviews DESC) AS rating_rank
FROM dim_rides_q
""")
