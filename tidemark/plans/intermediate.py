"""Shared intermediate results. They are never stored: Catalyst plans them inside their callers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_between, mean, money_sum, percent, review_count_band
from tidemark.operators.joins import full_outer_zero

MONEY = "decimal(28,2)"  # totals
ROW_MONEY = "decimal(14,2)"  # amounts of one visit


def daily_revenue(tickets: DataFrame, pos: DataFrame) -> DataFrame:
    """Ticket and in-park revenue per visit date."""
    def spent_on(category: str):
        return money_sum(F.when(F.col("category") == category, F.col("total_amount")).otherwise(F.lit(0)))

    by_ticket = tickets.groupBy("visit_date").agg(
        money_sum("final_price").alias("ticket_revenue"),
        F.count_distinct("customer_id").alias("unique_visitors"),
        F.count("ticket_id").alias("tickets_sold"),
    )
    by_pos = pos.groupBy("visit_date").agg(
        money_sum("total_amount").alias("in_park_revenue"),
        spent_on("food").alias("food_revenue"),
        spent_on("merchandise").alias("merch_revenue"),
    )
    total = (F.col("ticket_revenue") + F.col("in_park_revenue")).cast(MONEY)
    joined = full_outer_zero(by_ticket, by_pos, "visit_date").withColumn("total_revenue", total)
    return joined.select(
        "visit_date",
        *[F.col(c).cast(MONEY).alias(c) for c in ("ticket_revenue", "in_park_revenue", "food_revenue", "merch_revenue")],
        "total_revenue", "unique_visitors", "tickets_sold",
    )


def customer_visits(tickets: DataFrame, pos: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row per ticket with the spend and the feedback of the same guest and day.

    Both right sides are aggregated to the join key first, so a ticket never fans out.
    """
    key = ["customer_id", "visit_date"]
    spend = pos.groupBy(*key).agg(money_sum("total_amount").alias("in_park_spend"))
    opinion = feedback.groupBy(*key).agg(
        mean("rating", None).alias("avg_rating"), F.count(F.lit(1)).alias("feedback_count")
    )
    joined = tickets.join(spend, key, "left").join(opinion, key, "left")
    in_park = F.coalesce(F.col("in_park_spend"), F.lit(0)).cast(ROW_MONEY)
    lead = days_between(F.col("purchase_date"), F.col("visit_date"))
    reviews = F.coalesce(F.col("feedback_count"), F.lit(0))
    return joined.select(
        "ticket_id", "customer_id", "visit_date", "ticket_type", "purchase_date", "purchase_channel", "is_discounted",
        F.col("final_price").alias("ticket_price"),
        in_park.alias("in_park_spend"),
        (F.col("final_price") + in_park).cast(ROW_MONEY).alias("total_visit_spend"),
        lead.cast("long").alias("booking_lead_days"),
        (lead == 0).alias("is_same_day_visit"),
        (lead >= 7).alias("is_advance_purchase"),
        "avg_rating",
        reviews.alias("feedback_count"),
        (reviews > 0).alias("has_feedback"),
    )


def ride_metrics(rides: DataFrame, feedback: DataFrame) -> DataFrame:
    """Rides with their review counts; rides without a review keep zeros."""
    rating = F.col("rating")
    reviews = feedback.where(F.col("ride_id").isNotNull() & (F.col("category") == "ride")).groupBy("ride_id").agg(
        F.count("feedback_id").alias("total_reviews"),
        mean("rating", None).alias("avg_rating"),
        F.count_if(rating >= 4).alias("positive_reviews"),
        F.count_if(rating == 3).alias("neutral_reviews"),
        F.count_if(rating <= 2).alias("negative_reviews"),
    )
    counts = ["total_reviews", "avg_rating", "positive_reviews", "neutral_reviews", "negative_reviews"]
    joined = rides.join(reviews, "ride_id", "left").fillna(0, counts)
    n = F.col("total_reviews")
    return joined.select(
        "ride_id", "ride_name", "ride_type", "min_height_cm", "thrill_level", "zone", "is_haunted", "status",
        "opened_date", "capacity_per_hour", "avg_wait_minutes", *counts,
        F.coalesce(percent(F.col("positive_reviews"), n), F.lit(0).cast("decimal(28,2)")).alias("positive_review_pct"),
        (n > 0).alias("has_reviews"),
        review_count_band(n).alias("review_count_band"),
    )
