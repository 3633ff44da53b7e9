"""Further published tables over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    days_between, half_up, is_deep_discount, is_high_value, ltv_segment, mask_pii, mean, mean_of_means, money_mean,
    money_sum, month_start, months_between_dates, percent, plain_key, quotient, revenue_category, spend_tier, transaction_tier, week_start,
)
from tidemark.operators.joins import fill_gaps
from tidemark.operators.projection import dev_limit, feature_flag, look_back
from tidemark.operators.quality import parse_amount, quality_score
from tidemark.operators.ranks import rank_rows, running_total, with_group_sum

VISIT_COLUMNS = ["ticket_id", "customer_id", "visit_date", "ticket_type", "total_visit_spend", "avg_rating"]
SALE_COLUMNS = [
    "sale_id", "customer_id", "ticket_id", "purchase_date", "visit_date", "ticket_price", "discount_percent",
    "discount_category", "updated_at",
]
# Score weights, service fee.
SCORE = [("customer_id", "not_null", 4), ("email", "valid_email", 3), ("first_name", "not_null", 2), ("phone", "not_null", 1)]
SERVICE_FEE = 1.10


def visit_summary(visits: DataFrame) -> DataFrame:
    return visits.select(*VISIT_COLUMNS)


def masked_customers(customers: DataFrame, environment: str = "dev") -> DataFrame:
    return customers.select(
        "customer_id", "first_name", "last_name",
        mask_pii("email", "hash", environment).alias("email_masked"),
        mask_pii("phone", "partial", environment).alias("phone_masked"),
        mask_pii("address", "redact", environment).alias("address_masked"),
        "age", "is_vip_member",
    )


def employee_directory(employees: DataFrame) -> DataFrame:
    return employees.select(
        "employee_id", "full_name", "department", "role", "zone_assignment", "hire_date", "hourly_rate"
    )


def keyed_transactions(pos: DataFrame) -> DataFrame:
    return pos.select(
        plain_key("transaction_id", "customer_id", "visit_date").alias("sk_transaction"),
        "transaction_id", "customer_id", "visit_date", "category", "total_amount", "payment_method",
    )


def scored_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "first_name", "last_name", "email", "phone", "is_vip_member", quality_score(SCORE).alias("dq_score")
    )


def priced_tickets(tickets: DataFrame, params: dict | None = None) -> DataFrame:
    """Revenue by the old or the new pricing model, chosen when the plan is built."""
    price = F.col("final_price")
    if feature_flag(params or {}, "use_new_pricing_model"):
        revenue = F.round(price * F.lit(SERVICE_FEE).cast("decimal(3,2)"), 2).cast("decimal(12,2)")
    else:
        revenue = price
    return tickets.select("ticket_id", "customer_id", "visit_date", "ticket_type", "final_price", revenue.alias("revenue"))


def tickets_with_ratings(tickets: DataFrame, feedback: DataFrame) -> DataFrame:
    """Every ticket with each rating of the same guest and day; several ratings give several rows."""
    rated = feedback.select("customer_id", "visit_date", F.col("rating").alias("satisfaction_rating"))
    return tickets.select("ticket_id", "customer_id", "visit_date", "ticket_type").join(
        rated, ["customer_id", "visit_date"], "left"
    )


def daily_visits(spine: DataFrame, visits: DataFrame) -> DataFrame:
    """Visits per day of a spine named `visit_date`, days without visits included."""
    daily = visits.groupBy("visit_date").agg(
        F.count(F.lit(1)).alias("total_visits"),
        money_sum("total_visit_spend").alias("total_revenue"),
        mean_of_means("avg_rating").alias("avg_rating"),
    )
    return fill_gaps(spine, daily, "visit_date", zero=["total_visits", "total_revenue"], keep=["avg_rating"])


def _mean_rating() -> Column:
    """Averages of a few ratings each, so six decimals of them are exact enough for two."""
    return mean(half_up(F.col("avg_rating"), 6))


def visits_by_type(visits: DataFrame) -> DataFrame:
    return visits.groupBy("ticket_type").agg(
        F.count(F.lit(1)).alias("total_visits"),
        money_mean("total_visit_spend").alias("avg_spend"),
        _mean_rating().alias("avg_rating"),
        F.min("visit_date").alias("first_visit"),
        F.max("visit_date").alias("last_visit"),
    )


def daily_visit_summary(visits: DataFrame) -> DataFrame:
    return visits.groupBy("visit_date", "ticket_type").agg(
        F.count_distinct("customer_id").alias("unique_visitors"),
        F.count(F.lit(1)).alias("total_visits"),
        money_sum("ticket_price").alias("total_ticket_revenue"),
        money_sum("in_park_spend").alias("total_in_park_spend"),
        money_sum("total_visit_spend").alias("total_visit_spend"),
        _mean_rating().alias("avg_satisfaction_rating"),
        F.min("ticket_price").alias("min_ticket_price"),
        F.max("ticket_price").alias("max_ticket_price"),
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    keys = [month_start(F.col("visit_date")).alias("revenue_month"), "category", "location", "payment_method"]
    return sales.groupBy(*keys).agg(
        money_sum("total_amount").alias("total_revenue"),
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("transaction_id").alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        money_mean("total_amount").alias("avg_transaction_value"),
        F.max("total_amount").alias("max_transaction_value"),
    )


def constrained_visits(visits: DataFrame) -> DataFrame:
    return visits.where(F.col("visit_date").isNotNull() & F.col("customer_id").isNotNull()).select(
        F.col("visit_key").alias("sale_id"), "ticket_id", "customer_id", "visit_date", "ticket_type", "ticket_price",
        "in_park_spend", "total_visit_spend", "avg_rating",
    )


def enriched_transactions(pos: DataFrame) -> DataFrame:
    """Never stored: callers take it over as part of their own plan."""
    return pos.withColumns(
        {
            "spending_tier": transaction_tier("total_amount"),
            "revenue_category": revenue_category("category"),
            "is_high_value": is_high_value("total_amount"),
        }
    )


def transaction_summary(enriched: DataFrame) -> DataFrame:
    n, high = F.col("transaction_count"), F.col("high_value_count")
    grouped = enriched.groupBy("revenue_category", "spending_tier", "payment_method").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        money_sum("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_transaction_value"),
        F.count_if("is_high_value").alias("high_value_count"),
    )
    share = percent(high, n, 1)
    return grouped.withColumn("high_value_pct", share).orderBy("revenue_category", F.desc("total_revenue"))


def sales_by_outlet(sales: DataFrame) -> DataFrame:
    return sales.groupBy("visit_date", "category", "location").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        money_sum("total_amount").alias("total_revenue"),
        money_mean("total_amount", None).alias("avg_transaction_value"),
        F.min("total_amount").alias("min_transaction_value"),
        F.max("total_amount").alias("max_transaction_value"),
    )


def recent_customers(visits: DataFrame, days: int = 90, as_of=None) -> DataFrame:
    """Visit frequency in a rolling window, stamped with the window used."""
    return look_back(visits, "visit_date", days, as_of).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("visit_count"),
        money_sum("total_visit_spend").alias("total_spend"),
        money_mean("total_visit_spend").alias("avg_spend_per_visit"),
        _mean_rating().alias("avg_rating"),
        F.min("visit_date").alias("first_visit_in_window"),
        F.max("visit_date").alias("last_visit_in_window"),
        F.lit(days).alias("window_days"),
    )


def spend_tiers(visits: DataFrame, high: int = 300, mid: int = 100) -> DataFrame:
    return visits.where(F.col("total_visit_spend").isNotNull()).select(
        "customer_id", "visit_date", "ticket_type", "total_visit_spend", "avg_rating",
        spend_tier("total_visit_spend", high, mid).alias("spend_tier"),
        F.lit(high).alias("tier_high_threshold"),
        F.lit(mid).alias("tier_mid_threshold"),
    )


def visit_windows(visits: DataFrame) -> DataFrame:
    """Running spend per guest, spend rank and distance to the average per ticket type.

    Ticket types are few and guests may be hot, so none of the three uses a plain window.
    Ties on the date are broken by the ticket id.
    """
    spent = visits.where(F.col("total_visit_spend").isNotNull()).select(
        "ticket_id", "customer_id", "ticket_type", "visit_date", "total_visit_spend", "avg_rating"
    )
    spend = F.col("total_visit_spend")
    running = running_total(spent, ["customer_id"], {"visit_date": F.asc, "ticket_id": F.asc}, spend, "running_total_spend")
    # Both steps below read the blocks stored by the first, not the visits again.
    compared = with_group_sum(running, ["ticket_type"], "total_visit_spend", "_sum", "_n")
    ranked = rank_rows(compared, {"total_visit_spend": F.desc}, "spend_rank_in_ticket_type", ["ticket_type"], dense=True)
    return ranked.select(
        "ticket_id", "customer_id", "ticket_type", "visit_date", "total_visit_spend", "avg_rating",
        F.col("running_total_spend").cast("decimal(28,2)").alias("running_total_spend"),
        "spend_rank_in_ticket_type",
        quotient(F.col("_sum"), F.col("_n")).alias("avg_spend_for_ticket_type"),
        quotient(spend * F.col("_n") - F.col("_sum"), F.col("_n")).alias("spend_vs_ticket_avg"),
    )


def visits_with_customers(visits: DataFrame, customers: DataFrame, limit: int | None = None) -> DataFrame:
    who = customers.select("customer_id", "loyalty_tier", "customer_value_segment", "age_group")
    joined = visits.join(who, "customer_id").select(
        "customer_id", "loyalty_tier", "customer_value_segment", "age_group", "visit_date", "ticket_type",
        "total_visit_spend", "avg_rating",
    )
    return dev_limit(joined, limit)


def weekly_revenue(visits: DataFrame) -> DataFrame:
    """Monday weeks with a running revenue per type. The window runs over weekly aggregates, few per type."""
    weekly = visits.where(F.col("total_visit_spend").isNotNull()).groupBy(
        week_start(F.col("visit_date")).alias("week_start"), "ticket_type"
    ).agg(
        F.count(F.lit(1)).alias("visit_count"),
        money_sum("total_visit_spend").alias("total_revenue"),
        money_mean("total_visit_spend").alias("avg_spend_per_visit"),
        _mean_rating().alias("avg_rating"),
    )
    to_here = Window.partitionBy("ticket_type").orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    return weekly.withColumns(
        {
            "week_start_day": F.dayname("week_start"),
            "running_revenue_by_type": F.sum("total_revenue").over(to_here).cast("decimal(28,2)"),
        }
    ).orderBy("week_start", "ticket_type")


def customer_ltv(visits: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime value per customer. Visits are rolled up before the join, so a hot guest costs one row."""
    first, last = F.min("visit_date"), F.max("visit_date")
    spend = F.sum("total_visit_spend")
    rollup = visits.groupBy("customer_id").agg(
        F.count("visit_date").alias("total_visits"),
        first.alias("first_visit_date"),
        last.alias("last_visit_date"),
        days_between(first, last).cast("long").alias("active_days"),
        spend.cast("decimal(28,2)").alias("lifetime_spend"),
        money_mean("total_visit_spend").alias("avg_spend_per_visit"),
        _mean_rating().alias("avg_satisfaction_rating"),
        quotient(spend, months_between_dates(first, last)).alias("avg_monthly_spend"),
    )
    who = customers.select(
        "customer_id", "loyalty_tier", "customer_value_segment", "is_vip_member", "registration_date"
    )
    return who.join(rollup, "customer_id").withColumn("ltv_segment", ltv_segment(F.col("lifetime_spend")))


def governed_visits(visits: DataFrame) -> DataFrame:
    return visits.where(F.col("visit_date").isNotNull()).select(
        "visit_key", "customer_id", "visit_date", "ticket_type",
        F.col("total_visit_spend").cast("decimal(12,2)").alias("total_visit_spend"),
        F.col("avg_rating").cast("decimal(4,2)").alias("avg_rating"),
    )


def drifting_sales(sales: DataFrame, mode: str = "baseline") -> DataFrame:
    """Sales with a column added or dropped, by drift mode."""
    columns = [c for c in SALE_COLUMNS if not (mode == "drop_legacy_column" and c == "discount_category")]
    rows = sales.select(*columns)
    return rows.withColumn("is_deep_discount", is_deep_discount("discount_percent")) if mode == "add_new_column" else rows


def contracted_sales(sales: DataFrame, mode: str = "baseline") -> DataFrame:
    """The added column is always there and only filled in the new mode."""
    flag = is_deep_discount("discount_percent") if mode == "add_new_column" else F.lit(None).cast("boolean")
    return sales.select(
        "sale_id", "customer_id", "ticket_id", "purchase_date", "visit_date",
        F.col("ticket_price").cast("decimal(10,2)").alias("ticket_price"),
        F.col("discount_percent").cast("decimal(5,2)").alias("discount_percent"),
        "updated_at", flag.alias("is_deep_discount"),
    )


def failing_probe(customers: DataFrame, force_failure: bool = False) -> DataFrame:
    """One row per customer; fails at run time on request, to rehearse a broken upstream table."""
    marker = F.expr("1 / 0").cast("int") if force_failure else F.lit(1)
    return customers.select("customer_id", marker.alias("force_failure"))


def customer_count(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count(F.lit(1)).alias("customer_count"))


def validated_payments(feed: DataFrame, strict: bool = False) -> DataFrame:
    return feed.select(
        "event_id", "customer_id", parse_amount("payment_amount_raw", strict).alias("payment_amount"), "currency",
        "payment_status", "event_timestamp",
    )
