"""All modelled tables by name over one set of sources and run parameters."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.history import History
from tidemark.operators.calendar import calendar, date_spine, date_spine_inclusive
from tidemark.operators.projection import dev_limit, look_back
from tidemark.operators.quality import apply_policy, enforce, enforce_contract, feed_quality, quarantine, run_checks
from tidemark.plans import analytics, core, demos, intermediate, staging
from tidemark.plans.params import with_defaults
from tidemark.plans.rules import MODELS
from tidemark.sources.readers import Sources
from tidemark.sources.writers import clustered


# Tracked tables: rows, key and how a change is seen. Prices are keyed by the name of their ticket type, as its number
# is a rank that changes when a type is added.
TRACKED = {
    "customers": (lambda w: w.stg_customers, "customer_id", dict(check_columns=[
        "first_name", "last_name", "email", "phone", "address", "city", "state", "zip_code", "is_vip_member",
        "marketing_opt_in", "loyalty_points",
    ], hard_deletes=True)),
    "rides": (lambda w: w.stg_rides, "ride_id", dict(updated_at="updated_at")),
    "employees": (lambda w: w.stg_employees, "employee_id", dict(updated_at="updated_at", hard_deletes=True)),
    "haunted_house_attributes": (lambda w: w.stg_haunted_houses, "haunted_house_id", dict(
        check_columns=["haunted_house_name", "capacity", "fear_level"])),
    "product_pricing_history": (lambda w: w.stg_ticket_types, "ticket_type_name", dict(
        check_columns=["price", "includes_fast_pass", "includes_vip_benefits", "fear_level", "duration_minutes"])),
    "ticket_sales_history": (lambda w: w.stg_online_sales.unionByName(w.stg_physical_sales), "sale_id", dict(
        check_columns=["ticket_price", "discount_percent", "payment_method"])),
    "visitor_feedback_changes": (lambda w: w.stg_haunted_feedback, "feedback_id", dict(
        check_columns=["satisfaction_rating", "would_recommend"])),
}


class Warehouse:
    """Lazy tables: `Warehouse(...).agg_daily_revenue` is a DataFrame. Ranked tables store blocks in the
    shared folder; nothing else is stored.

    A table used by several others is planned once per use; Spark shares equal exchanges.
    """

    def __init__(self, spark: SparkSession, sources: Sources, params: dict | None = None, numeric_ticket=None):
        self.spark, self.source = spark, sources.table
        self.params = with_defaults(params)
        self.as_of = self.params["as_of"]
        self.numeric_ticket = numeric_ticket  # numeric expression over ticket_id, where that is text

    # -- staging

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.source("customer_data.customers"), self.as_of)

    @cached_property
    def stg_employees(self) -> DataFrame:
        return staging.employees(self.source("employees.employees"))

    @cached_property
    def stg_rides(self) -> DataFrame:
        return staging.rides(self.source("park_assets.rides"))

    @cached_property
    def stg_ticket_types(self) -> DataFrame:
        return staging.ticket_types(self.source("park_assets.ticket_types"))

    @cached_property
    def stg_tickets(self) -> DataFrame:
        return staging.tickets(self.source("sales.ticket_sales_online"), self.source("sales.ticket_sales_physical"))

    @cached_property
    def stg_online_sales(self) -> DataFrame:
        return staging.online_sales(self.source("sales.ticket_sales_online"))

    @cached_property
    def stg_physical_sales(self) -> DataFrame:
        return staging.physical_sales(self.source("sales.ticket_sales_physical"))

    @cached_property
    def stg_visitor_feedback(self) -> DataFrame:
        return staging.feedback(self.source("feedback.visitor_feedback"))

    @cached_property
    def stg_pos_transactions(self) -> DataFrame:
        return staging.pos_transactions(self.source("sales_transactions.sales_transactions"))

    @cached_property
    def stg_haunted_houses(self) -> DataFrame:
        return staging.haunted_houses(self.source("external_haunted.haunted_houses"))

    @cached_property
    def stg_haunted_tickets(self) -> DataFrame:
        tickets = self.source("external_haunted.haunted_house_tickets")
        return staging.haunted_tickets(tickets, self.source("external_haunted.haunted_houses"), self.numeric_ticket)

    @cached_property
    def stg_haunted_feedback(self) -> DataFrame:
        return staging.haunted_feedback(
            self.source("feedback.visitor_feedback"), self.source("external_haunted.haunted_houses")
        )

    # -- intermediate

    @cached_property
    def int_daily_revenue(self) -> DataFrame:
        return intermediate.daily_revenue(self.stg_tickets, self.stg_pos_transactions)

    @cached_property
    def int_customer_visits(self) -> DataFrame:
        return intermediate.customer_visits(self.stg_tickets, self.stg_pos_transactions, self.stg_visitor_feedback)

    @cached_property
    def int_ride_metrics(self) -> DataFrame:
        return intermediate.ride_metrics(self.stg_rides, self.stg_visitor_feedback)

    # -- star schema

    @cached_property
    def dim_dates(self) -> DataFrame:
        return calendar(date_spine(self.spark, self.params["date_spine_start"], self.params["date_spine_end"]))

    @cached_property
    def metric_time_spine(self) -> DataFrame:
        return self.dim_dates.select("date_day")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.stg_customers, self.as_of)

    @cached_property
    def dim_employees(self) -> DataFrame:
        return core.dim_employees(self.stg_employees, self.as_of)

    @cached_property
    def dim_rides(self) -> DataFrame:
        return core.dim_rides(self.int_ride_metrics)

    @cached_property
    def dim_ticket_types(self) -> DataFrame:
        return core.dim_ticket_types(self.stg_ticket_types)

    @cached_property
    def dim_transaction_flags(self) -> DataFrame:
        return core.dim_transaction_flags(self.fct_all_ticket_sales)

    @cached_property
    def fct_all_ticket_sales(self) -> DataFrame:
        return core.all_ticket_sales(self.stg_online_sales, self.stg_physical_sales)

    @cached_property
    def fct_sales(self) -> DataFrame:
        return core.fct_sales(self.stg_pos_transactions, self.dim_dates)

    @cached_property
    def fct_sales_with_junk_key(self) -> DataFrame:
        return core.sales_with_junk_key(self.fct_all_ticket_sales)

    @cached_property
    def fct_visits(self) -> DataFrame:
        return core.fct_visits(self.int_customer_visits, self.dim_dates)

    @cached_property
    def fct_haunted_tickets(self) -> DataFrame:
        return core.fct_haunted_tickets(self.stg_haunted_tickets, self.stg_haunted_houses)

    # -- marts

    @cached_property
    def agg_daily_revenue(self) -> DataFrame:
        start = self.params["daily_revenue_start"]
        return analytics.daily_revenue_mart(self.dim_dates, self.int_daily_revenue, start, self.as_of)

    @cached_property
    def agg_customer_lifetime_value(self) -> DataFrame:
        return analytics.customer_lifetime_value(self.dim_customers, self.fct_visits)

    @cached_property
    def agg_customer_spending_profile(self) -> DataFrame:
        return analytics.customer_spending_profile(self.stg_haunted_feedback)

    @cached_property
    def agg_fear_vs_ratings(self) -> DataFrame:
        return analytics.fear_vs_ratings(self.stg_haunted_feedback)

    @cached_property
    def agg_halloween_spending(self) -> DataFrame:
        start = self.params["halloween_analysis_start_date"]
        return analytics.halloween_spending(self.fct_all_ticket_sales, self.dim_dates, start)

    @cached_property
    def agg_happiest_houses(self) -> DataFrame:
        return analytics.happiest_houses(self.stg_haunted_feedback, self.params["min_satisfaction_rating"])

    @cached_property
    def agg_house_by_time(self) -> DataFrame:
        return analytics.house_by_time(self.stg_haunted_feedback)

    @cached_property
    def agg_ride_popularity(self) -> DataFrame:
        return analytics.ride_popularity(self.dim_rides)

    @cached_property
    def agg_ticket_value(self) -> DataFrame:
        return analytics.ticket_value(self.stg_haunted_feedback)

    @cached_property
    def agg_vip_satisfaction(self) -> DataFrame:
        return analytics.vip_satisfaction(self.stg_haunted_feedback)

    @cached_property
    def agg_visitor_recommendations(self) -> DataFrame:
        return analytics.visitor_recommendations(self.stg_haunted_feedback)

    @cached_property
    def customer_revenue_retention_summary(self) -> DataFrame:
        return analytics.revenue_retention_summary(self.dim_customers, self.fct_visits, self.as_of)

    @cached_property
    def ride_satisfaction_opportunities(self) -> DataFrame:
        return analytics.ride_opportunities(self.agg_ride_popularity)

    # -- published tables steered by parameters

    @cached_property
    def masked_customers(self) -> DataFrame:
        return demos.masked_customers(self.stg_customers, self.params["environment"])

    @cached_property
    def priced_tickets(self) -> DataFrame:
        return demos.priced_tickets(self.stg_tickets, self.params)

    @cached_property
    def daily_visits(self) -> DataFrame:
        """Days of the year in which the Halloween analysis starts."""
        start = self.params["halloween_analysis_start_date"]
        spine = date_spine_inclusive(self.spark, start, f"{start[:4]}-12-31", name="visit_date")
        return demos.daily_visits(spine, self.fct_visits)

    @cached_property
    def recent_customers(self) -> DataFrame:
        return demos.recent_customers(self.fct_visits, self.params["lookback_days"], self.as_of)

    @cached_property
    def spend_tiers(self) -> DataFrame:
        return demos.spend_tiers(self.fct_visits, self.params["spend_tier_high"], self.params["spend_tier_mid"])

    @cached_property
    def visit_windows(self) -> DataFrame:
        return demos.visit_windows(self.fct_visits)

    @cached_property
    def visits_with_customers(self) -> DataFrame:
        limit = self.params["dev_row_limit"]
        return dev_limit(demos.visits_with_customers(self.fct_visits, self.dim_customers), limit, F.col("customer_id"))

    @cached_property
    def weekly_revenue(self) -> DataFrame:
        return demos.weekly_revenue(self.fct_visits)

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return demos.customer_ltv(self.fct_visits, self.dim_customers)

    @cached_property
    def drifting_sales(self) -> DataFrame:
        return demos.drifting_sales(self.fct_all_ticket_sales, self.params["drift_mode"])

    @cached_property
    def contracted_sales(self) -> DataFrame:
        return demos.contracted_sales(self.fct_all_ticket_sales, self.params["drift_mode"])

    @cached_property
    def clustered_visits(self) -> DataFrame:
        return clustered(self.fct_visits, *self.params["cluster_columns"])

    @cached_property
    def recent_sales(self) -> DataFrame:
        """All sales; in development the last few days before the run day."""
        if self.params["environment"] != "dev":
            return self.fct_sales
        return look_back(self.fct_sales, "visit_date", self.params["dev_lookback_days"], self.as_of)

    # -- tests and contracts

    def report(self, name: str) -> DataFrame:
        """(check_name, failures, status) of the rules of a table."""
        df = getattr(self, name)
        return run_checks(df, MODELS[name].checks(df, lambda other: getattr(self, other)))

    def tested(self, name: str) -> DataFrame:
        """The table, if its rules hold; broken rules of severity error raise."""
        enforce(self.report(name))
        return getattr(self, name)

    def contracted(self, name: str, contract: StructType) -> DataFrame:
        """The table in the declared columns and types; a difference raises."""
        return enforce_contract(getattr(self, name), contract)

    # -- payment feed

    def payments(self, feed: DataFrame) -> DataFrame:
        """Typed payments; with `strict_validation` an unreadable amount is an error at run time."""
        return demos.validated_payments(feed, strict=self.params["strict_validation"])

    def payment_review_queue(self, feed: DataFrame) -> DataFrame:
        return quarantine(feed, "payment_amount_raw")[1]

    def payment_quality(self, feed: DataFrame) -> DataFrame:
        """Counts of the feed; `exception_mode` decides whether events to review pass, warn or raise."""
        mode = self.params["exception_mode"]
        return apply_policy(feed_quality(feed, "payment_amount_raw", mode), mode)

    # -- histories

    def histories(self, folder: str) -> dict[str, History]:
        """Stored histories of the tables that are tracked, below `folder`."""
        return {name: History(self.spark, f"{folder}/{name}", key, **rule) for name, (_, key, rule) in TRACKED.items()}

    def take_histories(self, folder: str, as_of) -> None:
        """Bring all histories up to the staged tables."""
        for name, kept in self.histories(folder).items():
            kept.take(TRACKED[name][0](self), as_of)

    @classmethod
    def names(cls) -> list[str]:
        return [n for n, v in vars(cls).items() if isinstance(v, cached_property)]
