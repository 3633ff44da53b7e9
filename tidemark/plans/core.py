"""Star schema: dimensions and facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    age_group, business_season, customer_value_segment, days_between, discount_category, estimated_annual_salary,
    half_up, is_valid_email, lifecycle_stage, loyalty_tier, months_between_dates, retention_risk, state_table,
    surrogate_key, upsell_opportunity, visit_time_of_day, years_between,
)
from tidemark.operators.joins import if_small, lookup_upper, with_parent_name
from tidemark.operators.projection import as_of_day
from tidemark.plans.staging import NTZ
from tidemark.sources.readers import inline_rows

FLAGS = [
    "purchase_channel", "is_online", "discount_category", "same_day_visit", "advance_purchase",
    "visit_time_category", "business_season",
]
CALENDAR_ATTRIBUTES = ["day_of_week", "month_name", "quarter", "year", "is_weekend"]


def dim_customers(staged: DataFrame, as_of=None) -> DataFrame:
    # Fifty constant rows, safe to broadcast.
    states = F.broadcast(inline_rows(staged.sparkSession, state_table()))
    named = lookup_upper(staged, "state", states, "state_name")
    vip, points = F.col("is_vip_member"), F.col("loyalty_points")
    months = months_between_dates(F.col("registration_date"), as_of_day(as_of))
    return named.select(
        "customer_id", "first_name", "last_name", "email",
        is_valid_email("email").alias("is_valid_email"),
        "phone", "address", "city", "state", "state_name", "zip_code", "age", "gender",
        "is_vip_member", "marketing_opt_in", "preferred_scare_level", "loyalty_points", "registration_date",
        age_group("age").alias("age_group"),
        loyalty_tier(points).alias("loyalty_tier"),
        customer_value_segment(vip, points).alias("customer_value_segment"),
        lifecycle_stage(months).alias("customer_lifecycle_stage"),
        retention_risk(points, months).alias("retention_risk_level"),
        upsell_opportunity(vip, points, F.col("marketing_opt_in")).alias("upsell_opportunity"),
        "created_at", "updated_at",
    )


def dim_employees(staged: DataFrame, as_of=None) -> DataFrame:
    named = with_parent_name(staged, "employee_id", "manager_id", "full_name", "manager_name")
    return named.select(
        surrogate_key("employee_id").alias("employee_key"),
        "employee_id", "full_name", "department", "role", "hire_date", "hourly_rate",
        estimated_annual_salary(F.col("hourly_rate")).alias("estimated_annual_salary"),
        "manager_id", "manager_name", "is_active", "zone_assignment",
        years_between(F.col("hire_date"), as_of_day(as_of)).cast("long").alias("years_of_service"),
    )


def dim_rides(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        surrogate_key("ride_id").alias("ride_key"),
        "ride_id", "ride_name", "ride_type", "min_height_cm", "thrill_level", "zone", "is_haunted", "status",
        "opened_date", "capacity_per_hour", "avg_wait_minutes", "total_reviews",
        half_up(F.col("avg_rating")).alias("avg_rating"),
        "positive_reviews", "neutral_reviews", "negative_reviews", "positive_review_pct", "has_reviews",
        "review_count_band",
    )


def dim_ticket_types(staged: DataFrame) -> DataFrame:
    return staged.select(
        "ticket_id", "ticket_type_name", "description", "price", "launch_date", "includes_fast_pass",
        "includes_vip_benefits", "fear_level", "duration_minutes", "house_category", "created_at", "updated_at",
    )


def all_ticket_sales(online: DataFrame, physical: DataFrame, at: Column | None = None) -> DataFrame:
    """Both channels as one fact with its derived flags."""
    stamp = F.now().cast(NTZ) if at is None else at
    bought, visited = F.col("purchase_date"), F.col("visit_date")
    return online.unionByName(physical).select(
        "sale_id", "customer_id", "ticket_id", "purchase_date", "visit_date", "purchase_timestamp", "ticket_price",
        "discount_percent",
        discount_category("discount_percent").alias("discount_category"),
        "visit_hour", "payment_method", "purchase_channel", "is_online",
        (bought == visited).alias("same_day_visit"),
        (days_between(bought, visited) > 0).alias("advance_purchase"),
        visit_time_of_day("visit_hour").alias("visit_time_category"),
        business_season(visited).alias("business_season"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def dim_transaction_flags(sales: DataFrame) -> DataFrame:
    """Junk dimension: the flag combinations that occur. The partial aggregate removes repeats early."""
    def either(flag: str, yes: str, no: str) -> Column:
        return F.when(F.col(flag), F.lit(yes)).otherwise(F.lit(no))

    parts = [
        F.col("purchase_channel"),
        either("is_online", "online", "offline"),
        F.coalesce("discount_category", F.lit("no_discount")),
        either("same_day_visit", "same_day", "advance"),
        F.col("visit_time_category"),
        F.col("business_season"),
    ]
    label = parts[0]
    for part in parts[1:]:
        label = F.concat(label, F.lit(" | "), part)
    combinations = sales.select(*FLAGS).distinct()
    return combinations.select(
        surrogate_key(*FLAGS).alias("transaction_flag_key"), *FLAGS, label.alias("flag_combo_label")
    )


def sales_with_junk_key(sales: DataFrame) -> DataFrame:
    """Flags replaced by the key of their combination, which is a function of the flags: no join and no shuffle.
    Plain equality: a sale with a NULL flag has no key."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in FLAGS])
    return sales.select(
        "sale_id", "customer_id", "ticket_id", "purchase_date", "visit_date",
        F.when(known, surrogate_key(*FLAGS)).alias("transaction_flag_key"), "ticket_price",
        "discount_percent", "visit_hour", "payment_method", "created_at", "updated_at",
    )


def with_calendar(facts: DataFrame, calendar: DataFrame, date: str = "visit_date") -> DataFrame:
    """Attach calendar attributes. The calendar has one row per day of a bounded span, so it is broadcast."""
    days = calendar.select(F.col("date_day").alias("_day"), *CALENDAR_ATTRIBUTES)
    return facts.join(F.broadcast(days), F.col(date) == F.col("_day"), "left").drop("_day")


def fct_sales(pos: DataFrame, calendar: DataFrame) -> DataFrame:
    return with_calendar(pos, calendar).select(
        surrogate_key("transaction_id").alias("sales_key"),
        "transaction_id", "customer_id", "visit_date", *CALENDAR_ATTRIBUTES,
        "category", "item_name", "quantity", "unit_price", "total_amount", "payment_method", "location",
    )


def fct_visits(visits: DataFrame, calendar: DataFrame) -> DataFrame:
    return with_calendar(visits, calendar).select(
        surrogate_key("ticket_id").alias("visit_key"),
        "ticket_id", "customer_id", "visit_date", *CALENDAR_ATTRIBUTES,
        "ticket_type", "purchase_date", "purchase_channel", "booking_lead_days", "is_same_day_visit",
        "is_advance_purchase", "is_discounted", "ticket_price", "in_park_spend", "total_visit_spend",
        "feedback_count", "has_feedback", "avg_rating",
    )


def fct_haunted_tickets(tickets: DataFrame, houses: DataFrame) -> DataFrame:
    return tickets.join(if_small(houses), "haunted_house_id", "left").select(
        "ticket_id", "customer_id", "haunted_house_id", "haunted_house_name", "capacity", "fear_level", "visit_date",
        "ticket_price", "created_at", "updated_at",
    )
