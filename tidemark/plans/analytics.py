"""Aggregate marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    action_priority, age_group, behavioral_segment, count_rows, days_between, halloween_bucket, mean, mean_of_means,
    money_mean, money_sum,
    nps_segment, popularity_segment, quotient, rating_tier, ratio, recency_risk, recency_segment, recommended_action,
    share_true, spending_tier, ticket_tier, value_index, visit_time_of_day, wait_experience,
)
from tidemark.operators.joins import fill_gaps
from tidemark.operators.projection import as_of_day, with_overall
from tidemark.operators.ranks import rank_many, rank_rows



def daily_revenue_mart(calendar: DataFrame, daily: DataFrame, start="2024-01-01", as_of=None) -> DataFrame:
    """Every calendar day from `start` to the run day, with zeros where nothing was sold."""
    days = calendar.where(F.col("date_day").between(F.lit(str(start)).cast("date"), as_of_day(as_of))).select(
        "date_day", "day_of_week", "month_name", "quarter", "year", "is_weekend"
    )
    measures = [c for c in daily.columns if c != "visit_date"]
    filled = fill_gaps(days, daily.withColumnRenamed("visit_date", "date_day"), "date_day", zero=measures)
    per_visitor = F.coalesce(quotient(F.col("total_revenue"), F.col("unique_visitors")), F.lit(0).cast("decimal(28,2)"))
    return filled.withColumn("revenue_per_visitor", per_visitor)


def customer_lifetime_value(customers: DataFrame, visits: DataFrame) -> DataFrame:
    """Visits rolled up per customer, then per tier and segment; the best segment first."""
    per_customer = visits.groupBy("customer_id").agg(
        count_rows().alias("total_visits"),
        money_sum("ticket_price").alias("lifetime_ticket_revenue"),
        money_sum("in_park_spend").alias("lifetime_in_park_spend"),
        money_sum("total_visit_spend").alias("lifetime_total_spend"),
    )
    joined = customers.select("customer_id", "loyalty_tier", "customer_value_segment").join(
        per_customer, "customer_id", "left"
    ).fillna(0)
    # Six digits per customer make the sum of averages exact and independent of the row order.
    spend_per_visit = quotient(F.col("lifetime_total_spend"), F.col("total_visits"), 6)
    joined = joined.withColumn("_per_visit", F.coalesce(spend_per_visit, F.lit(0)).cast("decimal(18,6)"))
    spend = F.sum("lifetime_total_spend")
    return joined.groupBy("loyalty_tier", "customer_value_segment").agg(
        F.count("customer_id").alias("total_customers"),
        money_mean("lifetime_ticket_revenue").alias("avg_lifetime_ticket_revenue"),
        money_mean("lifetime_in_park_spend").alias("avg_lifetime_in_park_spend"),
        money_mean("lifetime_total_spend").alias("avg_lifetime_total_spend"),
        mean("total_visits").alias("avg_visits"),
        mean("_per_visit").alias("avg_spend_per_visit"),
        spend.cast("decimal(28,2)").alias("total_segment_revenue"),
        quotient(spend, F.count("customer_id")).alias("clv"),
    ).orderBy(F.desc("clv"), "loyalty_tier", "customer_value_segment")


def customer_spending_profile(feedback: DataFrame) -> DataFrame:
    grouped = feedback.groupBy(F.col("customer_gender").alias("gender"), age_group("customer_age").alias("age_group"))
    return grouped.agg(
        count_rows().alias("total_visits"),
        money_mean("ticket_price").alias("avg_ticket_price"),
        money_sum("ticket_price").alias("total_spend"),
        mean("satisfaction_rating").alias("avg_satisfaction"),
    )


def fear_vs_ratings(feedback: DataFrame) -> DataFrame:
    """Satisfaction per visitor type and fear level, with one overall row per fear level."""
    return with_overall(
        feedback, "visitor_type", ["fear_level"], "All Visitors",
        avg_satisfaction=mean("satisfaction_rating"), total_visits=count_rows(),
    )


def halloween_spending(sales: DataFrame, calendar: DataFrame, start="2023-01-01") -> DataFrame:
    """Ticket spend by distance to Halloween.

    The calendar is a bounded spine and is broadcast; the start date is pushed to the scan.
    """
    recent = sales.where(F.col("visit_date") >= F.lit(str(start)).cast("date"))
    days = F.broadcast(calendar.select(F.col("date_day").alias("visit_date"), "days_to_halloween"))
    bucketed = recent.join(days, "visit_date").groupBy(halloween_bucket(F.col("days_to_halloween")).alias("date_bucket"))
    return bucketed.agg(
        F.count("sale_id").alias("total_tickets"),
        money_sum("ticket_price").alias("total_revenue"),
        money_mean("ticket_price").alias("avg_ticket_price"),
        mean("discount_percent").alias("avg_discount_pct"),
    ).withColumn("spend_tier", spending_tier("avg_ticket_price"))


def happiest_houses(feedback: DataFrame, min_rating: int = 3) -> DataFrame:
    """Low ratings are dropped before the recommendation rate is taken, as the ranking defines it."""
    happy = feedback.where(F.col("satisfaction_rating") >= min_rating).groupBy("haunted_house_name").agg(
        count_rows().alias("total_visits"),
        mean("satisfaction_rating").alias("avg_satisfaction"),
        share_true(F.col("would_recommend")).alias("recommendation_rate"),
        mean("satisfaction_rating", None).alias("_exact"),
    )
    ranked = rank_rows(happy, {"_exact": F.desc_nulls_first, "total_visits": F.desc}, "happiness_rank")
    return ranked.drop("_exact")


def house_by_time(feedback: DataFrame) -> DataFrame:
    grouped = feedback.groupBy("haunted_house_name", "visit_hour", visit_time_of_day("visit_hour").alias("time_slot"))
    return grouped.agg(
        count_rows().alias("total_visits"),
        money_sum("ticket_price").alias("total_revenue"),
        money_mean("ticket_price").alias("avg_ticket_price"),
        mean("satisfaction_rating").alias("avg_satisfaction"),
        share_true(F.col("would_recommend")).alias("recommendation_rate"),
    )


def ride_popularity(rides: DataFrame) -> DataFrame:
    rating, reviews, wait = F.col("avg_rating"), F.col("total_reviews"), F.col("avg_wait_minutes")
    labelled = rides.select(
        "ride_key", "ride_id", "ride_name", "ride_type", "thrill_level", "zone", "is_haunted", "status",
        "capacity_per_hour", "avg_wait_minutes", "total_reviews", "avg_rating", "positive_review_pct", "has_reviews",
        "review_count_band",
        rating_tier(rating).alias("rating_tier"),
        popularity_segment(reviews).alias("popularity_segment"),
        wait_experience(wait, rating, reviews).alias("wait_experience_segment"),
    )
    by_volume = {"total_reviews": F.desc, "avg_rating": F.desc_nulls_last}
    by_rating = {"avg_rating": F.desc_nulls_last, "total_reviews": F.desc}
    return rank_many(labelled, {"review_volume_rank": by_volume, "rating_rank": by_rating})


def ticket_value(feedback: DataFrame) -> DataFrame:
    """Satisfaction per price by house and benefit tier; a missing price ranks first, as NULL sorts highest."""
    tier = ticket_tier(F.col("includes_vip_benefits"), F.col("includes_fast_pass"))
    grouped = feedback.groupBy("haunted_house_name", tier.alias("ticket_tier")).agg(
        mean("satisfaction_rating").alias("avg_satisfaction"),
        money_mean("ticket_price").alias("avg_price"),
        count_rows().alias("visit_count"),
    )
    valued = grouped.withColumns(
        {
            "value_index": value_index(F.col("avg_satisfaction"), F.col("avg_price")),
            "_value": ratio(F.col("avg_satisfaction"), F.col("avg_price")),
        }
    )
    return rank_rows(valued, {"_value": F.desc_nulls_first}, "value_rank").drop("_value")


def vip_satisfaction(feedback: DataFrame) -> DataFrame:
    stats = feedback.groupBy("haunted_house_name", F.col("includes_vip_benefits").alias("is_vip")).agg(
        mean("satisfaction_rating").alias("avg_satisfaction")
    )
    # A house has at most three rows here (with, without, unknown), so the window groups are tiny.
    house = Window.partitionBy("haunted_house_name")
    with_vip = F.max(F.when(F.col("is_vip"), F.col("avg_satisfaction"))).over(house)
    without = F.max(F.when(~F.col("is_vip"), F.col("avg_satisfaction"))).over(house)
    return stats.withColumn("satisfaction_gap", (with_vip - without).cast("decimal(28,2)"))


def visitor_recommendations(feedback: DataFrame) -> DataFrame:
    rates = feedback.groupBy("visitor_type").agg(
        share_true(F.col("would_recommend")).alias("recommendation_rate"), count_rows().alias("total_visits")
    )
    labelled = rates.withColumn("nps_segment", nps_segment(F.col("recommendation_rate")))
    return rank_rows(labelled, {"recommendation_rate": F.desc_nulls_first}, "promoter_rank")


def revenue_retention_summary(customers: DataFrame, visits: DataFrame, as_of=None) -> DataFrame:
    """One row per customer with visits: value, recency and risk. Aggregated before the join."""
    rollup = visits.groupBy("customer_id").agg(
        count_rows().alias("total_visits"),
        F.min("visit_date").alias("first_visit_date"),
        F.max("visit_date").alias("most_recent_visit_date"),
        money_sum("ticket_price").alias("lifetime_ticket_revenue"),
        money_sum("in_park_spend").alias("lifetime_in_park_spend"),
        money_sum("total_visit_spend").alias("lifetime_total_spend"),
        money_mean("total_visit_spend", None).alias("avg_spend_per_visit"),
        mean_of_means("avg_rating").alias("avg_visit_rating"),
        F.sum("feedback_count").alias("feedback_submissions"),
        F.count_if("is_discounted").alias("discounted_visit_count"),
        F.count_if("is_same_day_visit").alias("same_day_visit_count"),
        F.count_if("is_advance_purchase").alias("advance_purchase_visit_count"),
        mean("booking_lead_days").alias("avg_booking_lead_days"),
    )
    who = customers.select(
        "customer_id", "first_name", "last_name", "email", "registration_date", "loyalty_tier",
        "customer_value_segment", "customer_lifecycle_stage",
    )
    days = days_between(F.col("most_recent_visit_date"), as_of_day(as_of)).cast("long")
    joined = who.join(rollup, "customer_id").withColumn("days_since_last_visit", days)
    since = F.col("days_since_last_visit")
    return joined.withColumns(
        {
            "is_repeat_visitor": F.col("total_visits") > 1,
            "behavioral_value_segment": behavioral_segment(F.col("lifetime_total_spend")),
            "recency_segment": recency_segment(since),
            "retention_risk_level": recency_risk(since),
        }
    )


def ride_opportunities(popularity: DataFrame) -> DataFrame:
    rule = (F.col("avg_wait_minutes"), F.col("avg_rating"), F.col("total_reviews"))
    return popularity.select(
        "ride_key", "ride_id", "ride_name", "ride_type", "thrill_level", "zone", "is_haunted", "status",
        "capacity_per_hour", "avg_wait_minutes", "total_reviews", "avg_rating", "positive_review_pct",
        "review_count_band", "rating_tier", "popularity_segment", "wait_experience_segment",
        recommended_action(*rule).alias("recommended_action"),
        action_priority(*rule).alias("action_priority"),
    )
