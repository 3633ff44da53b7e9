"""Declared column types of the feeds, and the logical names they are read under."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.readers import Sources, read_csv

# --- Fixed values --------------------------------------------------------------------------
RAW = {
    "raw_customers": "customer_id string, first_name string, last_name string, email string, phone string, "
    "date_of_birth date, membership_type string, signup_channel string, created_at timestamp_ntz, is_active boolean",
    "raw_employees": "employee_id string, first_name string, last_name string, department string, role string, "
    "hire_date date, hourly_rate decimal(10,2), manager_id string, is_active boolean, zone_assignment string",
    "raw_feedback": "feedback_id string, customer_id string, visit_date date, ride_id string, rating int, "
    "category string, sentiment string, comments string, submitted_at timestamp_ntz",
    "raw_rides": "ride_id string, ride_name string, ride_type string, min_height_cm int, thrill_level string, "
    "capacity_per_hour int, zone string, is_haunted boolean, opened_date date, status string, avg_wait_minutes int",
    "raw_sales_transactions": "transaction_id string, customer_id string, visit_date date, category string, "
    "item_name string, quantity int, unit_price decimal(10,2), total_amount decimal(10,2), payment_method string, "
    "location string",
    "raw_tickets": "ticket_id string, customer_id string, ticket_type string, purchase_date date, visit_date date, "
    "purchase_channel string, base_price decimal(10,2), discount_amount decimal(12,4), final_price decimal(10,2), "
    "promo_code string",
    "raw_haunted_events": "event_id string, event_name string, event_start_date date, event_end_date date, "
    "event_type string, external_partner string, tickets_allocated int, tickets_sold int, revenue decimal(12,2), "
    "description string",
}
SALE = (
    "sale_id string, customer_id string, ticket_id string, purchase_date date, visit_date date, "
    "ticket_price decimal(10,2), discount_percent decimal(5,2), discount_category string"
)
SALE_FLAGS = (
    "payment_method string, purchase_channel string, is_online boolean, same_day_visit boolean, "
    "advance_purchase boolean, visit_time_category string, business_season string"
)
SAMPLES = {
    "merge": f"{SALE}, visit_hour int, {SALE_FLAGS}, created_at timestamp_ntz, updated_at timestamp_ntz",
    "append": "sales_key string, transaction_id string, customer_id string, visit_date date, day_of_week string, "
    "month_name string, quarter int, year int, is_weekend boolean, category string, item_name string, quantity int, "
    "unit_price decimal(10,2), total_amount decimal(10,2), payment_method string, location string, "
    "_loaded_at timestamp_ntz",
    "delete_insert": "visit_date date, ticket_type string, unique_visitors int, total_visits int, "
    "total_ticket_revenue decimal(12,2), total_in_park_spend decimal(12,2), total_visit_spend decimal(12,2), "
    "avg_satisfaction_rating decimal(4,2), min_ticket_price decimal(10,2), max_ticket_price decimal(10,2)",
    "insert_overwrite": "revenue_month date, category string, location string, payment_method string, "
    "total_revenue decimal(14,2), total_units_sold int, total_transactions int, unique_customers int, "
    "avg_transaction_value decimal(10,2), max_transaction_value decimal(10,2)",
    "microbatch": f"{SALE}, {SALE_FLAGS}, purchase_ts timestamp_ntz, updated_at timestamp_ntz",
    "payment_events": "event_id string, customer_id string, payment_amount_raw string, currency string, "
    "payment_status string, event_timestamp timestamp_ntz",
}
# Logical name -> feed. Several names read the same feed.
LOGICAL = {
    "customer_data.customers": "raw_customers",
    "park_assets.rides": "raw_rides",
    "park_assets.ticket_types": "raw_tickets",
    "sales.ticket_sales_online": "raw_tickets",
    "sales.ticket_sales_physical": "raw_tickets",
    "feedback.visitor_feedback": "raw_feedback",
    "external_haunted.haunted_houses": "raw_rides",
    "external_haunted.haunted_house_tickets": "raw_tickets",
    "employees.employees": "raw_employees",
    "sales_transactions.sales_transactions": "raw_sales_transactions",
}
# -------------------------------------------------------------------------------------------


def csv_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw feeds from `<folder>/<feed>.csv`, with their declared types."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in RAW.items()}


def logical_sources(spark: SparkSession, feeds: dict[str, str | DataFrame]) -> Sources:
    """Feeds under all their logical names; a feed is a DataFrame or a parquet path."""
    return Sources(spark, {logical: feeds[feed] for logical, feed in LOGICAL.items() if feed in feeds})
