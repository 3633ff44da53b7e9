"""Data tests that belong to the modelled tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.operators import quality
from tidemark.operators.quality import Check


@dataclass(frozen=True)
class Rules:
    """What holds for a table: its key, columns that are never NULL, values, ranges, orders and parents."""

    key: str | None = None
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    between: dict[str, tuple] = field(default_factory=dict)
    ordered: tuple[tuple[str, str], ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)  # foreign key -> (table, key)

    def checks(self, df: DataFrame, table: Callable[[str], DataFrame]) -> list[Check]:
        found = [Check(f"{c} not null", breaks=quality.breaks_not_null(c)) for c in dict.fromkeys(filter(None, (self.key, *self.not_null)))]
        found += [Check(f"{c} accepted values", breaks=quality.breaks_accepted(c, v)) for c, v in self.accepted.items()]
        found += [Check(f"{c} in range", breaks=quality.breaks_between(c, *limits)) for c, limits in self.between.items()]
        found += [Check(f"{a} not after {b}", breaks=quality.breaks_order(a, b), severity="warn") for a, b in self.ordered]
        if self.key:
            found.append(Check(f"{self.key} unique", unique=(self.key,)))
        for fk, (parent, key) in self.parents.items():
            found.append(Check(f"{fk} in {parent}", rows=quality.relationships(df, fk, table(parent), key), severity="warn"))
        return found


MODELS = {
    "stg_customers": Rules("customer_id", ("registration_date",), between={"loyalty_points": (0, None)}),
    "stg_rides": Rules("ride_id", ("ride_name",)),
    "stg_tickets": Rules("ticket_id", ("customer_id", "visit_date"), ordered=(("purchase_date", "visit_date"),),
                         parents={"customer_id": ("stg_customers", "customer_id")}),
    "stg_visitor_feedback": Rules("feedback_id", between={"rating": (1, 5)}),
    "dim_customers": Rules("customer_id", ("loyalty_tier", "customer_value_segment")),
    "dim_rides": Rules("ride_key", ("ride_id",), between={"avg_rating": (0, 5)}),
    "fct_visits": Rules("visit_key", ("ticket_id", "visit_date"), between={"total_visit_spend": (0, None)},
                        parents={"customer_id": ("dim_customers", "customer_id")}),
    "fct_sales": Rules("sales_key", ("transaction_id", "visit_date")),
    "agg_daily_revenue": Rules("date_day", ("total_revenue", "unique_visitors")),
    "customer_revenue_retention_summary": Rules("customer_id", ("total_visits",), between={"total_visits": (1, None)}),
}
