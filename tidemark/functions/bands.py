"""Business labels. Every label is a first-match rule over a stated table of limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_col, quotient
from tidemark.functions.text import contains_any

__all__ = [
    "action_priority", "age_group", "at_least", "behavioral_segment", "customer_value_segment",
    "discount_category", "discount_percent", "estimated_annual_salary", "fear_level", "first_true",
    "is_deep_discount", "is_high_value", "is_vip", "lifecycle_stage", "loyalty_points", "loyalty_tier",
    "ltv_segment", "nps_segment", "popularity_segment", "rating_category", "rating_tier",
    "recency_risk", "recency_segment", "recommended_action", "retention_risk", "revenue_category",
    "review_count_band", "scare_level", "spend_tier", "spending_tier", "ticket_tier",
    "transaction_tier", "upsell_opportunity", "value_index", "value_map", "visit_time_of_day",
    "wait_experience", "would_recommend",
]


def first_true(rules: list[tuple[Column, object]], otherwise: object) -> Column:
    """Label of the first rule that holds; a NULL condition does not hold."""
    picked = F
    for condition, label in rules:
        picked = picked.when(condition, F.lit(label))
    return picked.otherwise(F.lit(otherwise))


def at_least(c: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the highest limit reached; steps run from high to low."""
    return first_true([(c >= limit, label) for limit, label in steps], otherwise)


def below(c: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first limit not reached; steps run from low to high."""
    return first_true([(c < limit, label) for limit, label in steps], otherwise)


def value_map(c: Column | str, table: dict, otherwise: object) -> Column:
    """Code to value."""
    return first_true([(as_col(c) == key, value) for key, value in table.items()], otherwise)


# --- Fixed values: limits and labels -------------------------------------------------------
SPENDING_TIER = ([(200, "premium"), (100, "standard"), (40, "budget")], "discount")
TRANSACTION_TIER = ([(100, "high"), (40, "mid")], "low")
HIGH_VALUE_AMOUNT = 100
HOURS = ([((0, 11), "Morning"), ((12, 17), "Afternoon"), ((18, 20), "Evening")], "Night")
AGE = ([(18, "Under 18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")], "55+")
LOYALTY = ([(1000, "Gold"), (500, "Silver")], "Bronze")
DISCOUNTS = ([(10, "Low Discount"), (25, "Mid Discount")], "High Discount")
NO_DISCOUNT = "No Discount"
DEEP_DISCOUNT = 20
VIP_TIERS = ("gold", "platinum")
SCARE = ({"platinum": 3, "gold": 2}, 1)
POINTS = ({"platinum": 1000, "gold": 500, "silver": 250}, 100)
FEAR = ({"extreme": 5, "high": 4, "medium": 3, "low": 2}, 3)
RATING_TIER = ([(4.5, "Top Rated"), (3.5, "Well Rated"), (2.5, "Average")], "Below Average")
POPULARITY = ([(3, "Proven Favorite"), (1, "Emerging Interest")], "Needs Awareness")
NPS = ([(70, "Promoter"), (50, "Passive")], "Detractor")
BEHAVIOUR = ([(250, "High Value"), (100, "Mid Value")], "Standard")
LTV = ([(500, "Platinum"), (200, "Gold"), (50, "Silver")], "Bronze")
WAIT_LIMIT_MINUTES = 25
ACTIVE_DAYS, COOLING_DAYS = 90, 365
NEW_MONTHS, GROWING_MONTHS, RISK_MONTHS = 3, 12, 6
RISK_POINTS_HIGH, RISK_POINTS_MEDIUM = 100, 300
UPSELL_POINTS = 400
WEEKLY_HOURS, WEEKS = 40, 52
# -------------------------------------------------------------------------------------------


def spending_tier(c: Column | str) -> Column:
    return at_least(as_col(c), *SPENDING_TIER)


def transaction_tier(c: Column | str) -> Column:
    return at_least(as_col(c), *TRANSACTION_TIER)


def is_high_value(c: Column | str) -> Column:
    return as_col(c) >= HIGH_VALUE_AMOUNT


def spend_tier(c: Column | str, high: float = 300, mid: float = 100) -> Column:
    return at_least(as_col(c), [(high, "High"), (mid, "Mid")], "Low")


def visit_time_of_day(hour: Column | str) -> Column:
    """Day part of an hour; a missing hour counts as night."""
    slots, night = HOURS
    return first_true([(as_col(hour).between(*span), label) for span, label in slots], night)


def discount_percent(discount: Column, base: Column) -> Column:
    """Discount as percent of the base price, 0 where there is no positive base."""
    share = F.round(discount / F.nullif(base, F.lit(0).cast("decimal(10,2)")) * 100, 2)
    return F.when(base > 0, share).otherwise(F.lit(0)).cast("decimal(5,2)")


def discount_category(percent: Column | str) -> Column:
    pct = as_col(percent)
    steps, top = DISCOUNTS
    return F.when(pct == 0, F.lit(NO_DISCOUNT)).otherwise(below(pct, steps, top))


def is_deep_discount(percent: Column | str) -> Column:
    return F.coalesce(as_col(percent) >= DEEP_DISCOUNT, F.lit(False))


def age_group(age: Column | str) -> Column:
    return below(as_col(age), *AGE)


def loyalty_tier(points: Column | str) -> Column:
    return at_least(as_col(points), *LOYALTY)


def is_vip(membership: Column | str) -> Column:
    return F.coalesce(as_col(membership).isin(*VIP_TIERS), F.lit(False))


def scare_level(membership: Column | str) -> Column:
    return value_map(membership, *SCARE)


def loyalty_points(membership: Column | str) -> Column:
    return value_map(membership, *POINTS)


def customer_value_segment(vip: Column, points: Column) -> Column:
    return first_true([(vip & (points >= 1000), "High Value"), (vip | (points >= 500), "Mid Value")], "Standard")


def lifecycle_stage(months: Column) -> Column:
    return first_true([(months <= NEW_MONTHS, "New"), (months <= GROWING_MONTHS, "Growing")], "Established")


def retention_risk(points: Column, months: Column) -> Column:
    rules = [
        ((points < RISK_POINTS_HIGH) & (months > RISK_MONTHS), "High"),
        (points < RISK_POINTS_MEDIUM, "Medium"),
    ]
    return first_true(rules, "Low")


def upsell_opportunity(vip: Column, points: Column, opted_in: Column) -> Column:
    return first_true([(~vip & (points >= UPSELL_POINTS), "VIP Upgrade"), (opted_in & ~vip, "Premium Pass")], "None")


def fear_level(thrill: Column | str) -> Column:
    return value_map(thrill, *FEAR)


def rating_category(rating: Column) -> Column:
    return first_true([(rating >= 4, "positive"), (rating == 3, "neutral")], "negative")


def would_recommend(rating: Column) -> Column:
    return F.coalesce(rating >= 4, F.lit(False))


def review_count_band(n: Column) -> Column:
    return first_true([(n == 0, "No Reviews"), (n == 1, "Single Review"), (n.between(2, 4), "Low Volume")], "Established")


def rating_tier(rating: Column) -> Column:
    steps, low = RATING_TIER
    return F.when(rating > 0, at_least(rating, steps, low)).otherwise(F.lit("Not Yet Rated"))


def popularity_segment(reviews: Column) -> Column:
    return at_least(reviews, *POPULARITY)


def wait_experience(wait: Column, rating: Column, reviews: Column) -> Column:
    long_wait, reviewed = wait >= WAIT_LIMIT_MINUTES, reviews > 0
    rules = [
        (long_wait & (rating < 3) & reviewed, "High Wait / Low Satisfaction"),
        (long_wait & (rating >= 4) & reviewed, "High Wait / Strong Satisfaction"),
        (~long_wait & (rating >= 4) & reviewed, "Low Wait / Strong Satisfaction"),
        (reviews == 0, "No Feedback Yet"),
    ]
    return first_true(rules, "Monitor")


def _opportunity(wait: Column, rating: Column, reviews: Column) -> list[tuple[Column, str, str]]:
    long_wait = wait >= WAIT_LIMIT_MINUTES
    return [
        (reviews == 0, "Collect More Feedback", "Medium"),
        (long_wait & (rating < 3), "Improve Guest Experience", "High"),
        ((rating >= 4) & (reviews >= 3) & ~long_wait, "Promote Ride", "Low"),
        ((rating >= 4) & (reviews < 3), "Build Awareness", "Medium"),
    ]


def recommended_action(wait: Column, rating: Column, reviews: Column) -> Column:
    return first_true([(c, action) for c, action, _ in _opportunity(wait, rating, reviews)], "Monitor Performance")


def action_priority(wait: Column, rating: Column, reviews: Column) -> Column:
    return first_true([(c, priority) for c, _, priority in _opportunity(wait, rating, reviews)], "Low")


def behavioral_segment(spend: Column) -> Column:
    return at_least(spend, *BEHAVIOUR)


def recency_segment(days: Column) -> Column:
    return first_true([(days <= ACTIVE_DAYS, "Active"), (days <= COOLING_DAYS, "Cooling")], "Lapsed")


def recency_risk(days: Column) -> Column:
    return first_true([(days > COOLING_DAYS, "High"), (days > ACTIVE_DAYS, "Medium")], "Low")


def nps_segment(rate: Column) -> Column:
    return at_least(rate, *NPS)


def ticket_tier(vip: Column, fast: Column) -> Column:
    """Benefit tier; a missing flag counts as no benefit."""
    return first_true([(vip & fast, "VIP + Fast Pass"), (vip, "VIP Only"), (fast, "Fast Pass Only")], "Standard")


def ltv_segment(spend: Column) -> Column:
    return at_least(spend, *LTV)


def revenue_category(category: Column | str) -> Column:
    rules = [
        (contains_any(category, "food", "bev"), "Food & Beverage"),
        (contains_any(category, "merch"), "Merchandise"),
        (contains_any(category, "ticket"), "Ticket"),
    ]
    return first_true(rules, "Other")


def estimated_annual_salary(hourly: Column) -> Column:
    return F.round(hourly * WEEKLY_HOURS * WEEKS, 2).cast("decimal(14,2)")


def value_index(satisfaction: Column, price: Column) -> Column:
    """Satisfaction per unit of price, times 100; NULL for a zero or missing price."""
    return quotient(satisfaction * F.lit(100), price, 4)
