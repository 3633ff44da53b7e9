"""Raw feeds to typed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    cast_price, discount_percent, fear_level, is_vip, loyalty_points, money_mean, rating_category, scare_level,
    value_map, would_recommend, years_between,
)
from tidemark.operators.joins import assign_round_robin
from tidemark.operators.projection import as_of_day, null_of
from tidemark.operators.ranks import number_rows

NTZ = "timestamp_ntz"

# Attributes by ticket type, and the placeholder for feedback without a house.
FAST_PASS_TYPES = ("weekend_pass", "annual_pass")
VIP_TYPES = ("annual_pass",)
TYPE_FEAR = ({"annual_pass": 5, "weekend_pass": 4, "day_pass": 3}, 2)
TYPE_MINUTES = ({"annual_pass": 240, "weekend_pass": 180}, 120)
NO_HOUSE = "Unknown House"


def customers(raw: DataFrame, as_of=None) -> DataFrame:
    membership = F.col("membership_type")
    created = F.col("created_at").cast(NTZ)
    padding = [null_of("string").alias(c) for c in ("address", "city", "state", "zip_code")]
    return raw.select(
        "customer_id", "first_name", "last_name",
        F.lower("email").alias("email"),
        "phone", *padding,
        years_between(F.col("date_of_birth"), as_of_day(as_of)).cast("int").alias("age"),
        null_of("string").alias("gender"),
        is_vip(membership).alias("is_vip_member"),
        F.lit(False).alias("marketing_opt_in"),
        scare_level(membership).cast("int").alias("preferred_scare_level"),
        loyalty_points(membership).cast("int").alias("loyalty_points"),
        created.cast("date").alias("registration_date"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def employees(raw: DataFrame) -> DataFrame:
    hired = F.col("hire_date").cast("date")
    return raw.select(
        "employee_id", "first_name", "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "department", "role",
        hired.alias("hire_date"),
        cast_price("hourly_rate").alias("hourly_rate"),
        "manager_id",
        F.col("is_active").cast("boolean").alias("is_active"),
        "zone_assignment",
        hired.cast(NTZ).alias("updated_at"),
    )


def rides(raw: DataFrame) -> DataFrame:
    opened = F.col("opened_date").cast("date")
    return raw.select(
        "ride_id", "ride_name", "ride_type",
        F.nullif(F.col("min_height_cm").cast("int"), F.lit(0)).alias("min_height_cm"),
        "thrill_level",
        F.col("capacity_per_hour").cast("int").alias("capacity_per_hour"),
        "zone",
        F.col("is_haunted").cast("boolean").alias("is_haunted"),
        opened.alias("opened_date"),
        "status",
        F.col("avg_wait_minutes").cast("int").alias("avg_wait_minutes"),
        opened.cast(NTZ).alias("updated_at"),
    )


def feedback(raw: DataFrame) -> DataFrame:
    rating = F.col("rating").cast("int")
    return raw.select(
        "feedback_id", "customer_id",
        F.col("visit_date").cast("date").alias("visit_date"),
        "ride_id",
        rating.alias("rating"),
        "category", "sentiment", "comments",
        F.col("submitted_at").cast(NTZ).alias("submitted_at"),
        rating_category(rating).alias("rating_category"),
    )


def pos_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id", "customer_id",
        F.col("visit_date").cast("date").alias("visit_date"),
        "category", "item_name",
        F.col("quantity").cast("int").alias("quantity"),
        cast_price("unit_price").alias("unit_price"),
        cast_price("total_amount").alias("total_amount"),
        "payment_method", "location",
    )


def tickets(online: DataFrame, physical: DataFrame) -> DataFrame:
    """Both sales channels, each cut from its own source. Rows without a channel belong to neither."""
    both = online.where(F.col("purchase_channel") == "online").unionByName(
        physical.where(F.col("purchase_channel") != "online")
    )
    return both.select(
        "ticket_id", "customer_id", "ticket_type",
        F.col("purchase_date").cast("date").alias("purchase_date"),
        F.col("visit_date").cast("date").alias("visit_date"),
        "purchase_channel",
        cast_price("base_price").alias("base_price"),
        cast_price("discount_amount", 12, 4).alias("discount_amount"),
        cast_price("final_price").alias("final_price"),
        F.nullif("promo_code", F.lit("")).alias("promo_code"),
        F.coalesce(F.col("discount_amount") > 0, F.lit(False)).alias("is_discounted"),
    )


def _channel_sales(rows: DataFrame, payment: str, channel: str, online: bool) -> DataFrame:
    pct = discount_percent(cast_price("discount_amount", 12, 4), cast_price("base_price"))
    return rows.select(
        F.col("ticket_id").alias("sale_id"), "customer_id", "ticket_id",
        F.col("purchase_date").cast("date").alias("purchase_date"),
        F.col("visit_date").cast("date").alias("visit_date"),
        null_of(NTZ).alias("purchase_timestamp"),
        cast_price("final_price").alias("ticket_price"),
        pct.alias("discount_percent"),
        null_of("int").alias("visit_hour"),
        F.lit(payment).alias("payment_method"),
        F.lit(channel).alias("purchase_channel"),
        F.lit(online).alias("is_online"),
    )


def online_sales(raw: DataFrame) -> DataFrame:
    return _channel_sales(raw.where(F.col("purchase_channel") == "online"), "credit_card", "online", True)


def physical_sales(raw: DataFrame) -> DataFrame:
    return _channel_sales(raw.where(F.col("purchase_channel") != "online"), "cash", "physical", False)


def ticket_types(raw: DataFrame, at: Column | None = None) -> DataFrame:
    """One row per ticket type with its average base price; numbered by name."""
    kind = F.col("ticket_type")
    stamp = F.now().cast(NTZ) if at is None else at
    types = raw.groupBy("ticket_type").agg(money_mean(cast_price("base_price")).cast("decimal(10,2)").alias("price"))
    return number_rows(types, {"ticket_type": F.asc_nulls_last}, "ticket_id").select(
        "ticket_id",
        kind.alias("ticket_type_name"),
        null_of("string").alias("description"),
        "price",
        null_of("date").alias("launch_date"),
        F.coalesce(kind.isin(*FAST_PASS_TYPES), F.lit(False)).alias("includes_fast_pass"),
        F.coalesce(kind.isin(*VIP_TYPES), F.lit(False)).alias("includes_vip_benefits"),
        value_map(kind, *TYPE_FEAR).cast("int").alias("fear_level"),
        value_map(kind, *TYPE_MINUTES).cast("int").alias("duration_minutes"),
        null_of("string").alias("house_category"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def haunted_houses(raw_rides: DataFrame) -> DataFrame:
    return raw_rides.where(F.col("is_haunted")).select(
        F.col("ride_id").alias("haunted_house_id"),
        F.col("ride_name").alias("haunted_house_name"),
        F.col("capacity_per_hour").cast("int").alias("capacity"),
        fear_level("thrill_level").cast("int").alias("fear_level"),
    )


def haunted_tickets(raw_tickets: DataFrame, raw_rides: DataFrame, number: Column | None = None) -> DataFrame:
    """Tickets dealt out evenly over the haunted houses by a running ticket number.

    `number` is a numeric expression; by default the ticket id itself.
    """
    houses = raw_rides.where(F.col("is_haunted")).select(F.col("ride_id").alias("haunted_house_id"))
    numbered = number_rows(houses, {"haunted_house_id": F.asc}, "house_rank")
    dealt = assign_round_robin(
        raw_tickets, F.col("ticket_id").cast("long") if number is None else number, numbered, "house_rank"
    )
    bought = F.col("purchase_date").cast(NTZ)
    return dealt.select(
        "ticket_id", "customer_id", "haunted_house_id",
        F.col("visit_date").cast("date").alias("visit_date"),
        cast_price("final_price").alias("ticket_price"),
        bought.alias("created_at"),
        bought.alias("updated_at"),
    )


def haunted_feedback(raw_feedback: DataFrame, raw_rides: DataFrame) -> DataFrame:
    houses = raw_rides.where(F.col("is_haunted")).select(
        F.col("ride_id").alias("_ride"), "ride_name", "thrill_level"
    )
    joined = raw_feedback.join(houses, F.col("ride_id") == F.col("_ride"), "left")
    return joined.select(
        "feedback_id",
        null_of("long").alias("sale_id"),
        F.coalesce("ride_name", F.lit(NO_HOUSE)).alias("haunted_house_name"),
        fear_level("thrill_level").cast("int").alias("fear_level"),
        null_of("decimal(10,2)").alias("ticket_price"),
        null_of("boolean").alias("includes_vip_benefits"),
        null_of("boolean").alias("includes_fast_pass"),
        F.col("category").alias("visitor_type"),
        null_of("int").alias("customer_age"),
        null_of("string").alias("customer_gender"),
        F.col("rating").cast("int").alias("satisfaction_rating"),
        would_recommend(F.col("rating")).alias("would_recommend"),
        F.col("visit_date").cast("date").alias("visit_date"),
        null_of("int").alias("visit_hour"),
    )
