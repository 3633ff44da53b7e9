"""Given rows and the listed columns of the expected rows."""

import datetime as dt
from decimal import Decimal as D

import pytest

from tidemark.plans import core, demos, intermediate, staging

TICKET = (
    "ticket_id string, customer_id string, ticket_type string, purchase_date date, visit_date date, purchase_channel string, "
    "base_price decimal(10,2), discount_amount decimal(12,4), final_price decimal(10,2), promo_code string"
)
POS = (
    "transaction_id string, customer_id string, visit_date date, category string, item_name string, quantity int, "
    "unit_price decimal(10,2), total_amount decimal(10,2), payment_method string, location string"
)
FEEDBACK = (
    "feedback_id string, customer_id string, visit_date date, ride_id string, rating int, category string, sentiment string, "
    "comments string, submitted_at timestamp_ntz"
)
RIDE = (
    "ride_id string, ride_name string, ride_type string, min_height_cm int, thrill_level string, capacity_per_hour int, zone string, "
    "is_haunted boolean, opened_date date, status string, avg_wait_minutes int"
)


def day(text):
    return dt.date.fromisoformat(text)


def ticket(no, customer, visit, price, bought=None, discount="0", channel="online"):
    return (f"T{no}", customer, "day_pass", day(bought or visit), day(visit), channel, D(price), D(discount), D(price), "")


def sale(no, customer, visit, category, amount):
    return (f"S{no}", customer, day(visit), category, "item", 1, D(amount), D(amount), "cash", "stand")


def review(no, customer, visit, ride, rating, category="ride"):
    return (f"F{no}", customer, day(visit), ride, rating, category, "x", "x", dt.datetime(2024, 6, 1))


def ride(no, haunted=False, thrill="low"):
    return (f"{no}", f"Ride {no}", "dark", 0, thrill, 100, "Z", haunted, day("2010-01-01"), "active", 10)


@pytest.fixture
def make(rows):
    return {
        "tickets": lambda *r: staging.tickets(rows(TICKET, *r), rows(TICKET, *r)),
        "pos": lambda *r: staging.pos_transactions(rows(POS, *r)),
        "feedback": lambda *r: staging.feedback(rows(FEEDBACK, *r)),
        "rides": lambda *r: staging.rides(rows(RIDE, *r)),
    }


def only(df, *columns):
    found = df.select(*columns).collect()
    assert len(found) == 1
    return tuple(found[0])


DAILY = ["ticket_revenue", "in_park_revenue", "food_revenue", "merch_revenue", "total_revenue", "unique_visitors", "tickets_sold"]


def test_daily_revenue_tickets_only(make):
    df = intermediate.daily_revenue(
        make["tickets"](ticket(1, "C1", "2024-06-01", "80"), ticket(2, "C2", "2024-06-01", "40")), make["pos"]()
    )
    assert only(df, *DAILY) == (D(120), 0, 0, 0, D(120), 2, 2)


def test_daily_revenue_sales_only(make):
    df = intermediate.daily_revenue(make["tickets"](), make["pos"](sale(1, "C1", "2024-06-02", "food", "25")))
    assert only(df, *DAILY) == (0, D(25), D(25), 0, D(25), 0, 0)


def test_daily_revenue_both(make):
    pos = make["pos"](*[
        sale(i, "C1", "2024-06-03", c, a) for i, (c, a) in enumerate([("food", "30"), ("merchandise", "20"), ("game", "10")])
    ])
    df = intermediate.daily_revenue(make["tickets"](ticket(1, "C1", "2024-06-03", "60")), pos)
    assert only(df, *DAILY) == (D(60), D(60), D(30), D(20), D(120), 1, 1)


METRICS = ["total_reviews", "avg_rating", "positive_reviews", "negative_reviews", "positive_review_pct"]


def test_ride_without_feedback(make):
    df = intermediate.ride_metrics(make["rides"](ride(1)), make["feedback"]())
    assert only(df, *METRICS) == (0, 0, 0, 0, 0)


def test_ride_metrics(make):
    reviews = make["feedback"](*[review(i, "C1", "2024-06-01", "2", r) for i, r in enumerate([5, 4, 3, 4])])
    assert only(intermediate.ride_metrics(make["rides"](ride(2)), reviews), *METRICS) == (4, 4.0, 3, 0, 75.0)


def test_ride_metrics_ignore_missing_ride(make):
    reviews = make["feedback"](
        review(1, "C1", "2024-06-01", "3", 5), review(2, "C1", "2024-06-01", None, 1), review(3, "C1", "2024-06-01", None, 2)
    )
    assert only(intermediate.ride_metrics(make["rides"](ride(3)), reviews), *METRICS) == (1, 5.0, 1, 0, 100.0)


def test_same_day_visit(make):
    df = intermediate.customer_visits(make["tickets"](ticket(1, "C1", "2024-07-01", "55")), make["pos"](), make["feedback"]())
    columns = ["in_park_spend", "total_visit_spend", "booking_lead_days", "is_same_day_visit", "is_advance_purchase",
               "feedback_count", "has_feedback", "avg_rating"]
    assert only(df, *columns) == (0, D(55), 0, True, False, 0, False, None)


def test_visit_does_not_fan_out(make):
    df = intermediate.customer_visits(
        make["tickets"](ticket(1, "C1", "2024-07-10", "80", bought="2024-07-01")),
        make["pos"](sale(1, "C1", "2024-07-10", "food", "35"), sale(2, "C1", "2024-07-10", "game", "25")),
        make["feedback"](review(1, "C1", "2024-07-10", "1", 4), review(2, "C1", "2024-07-10", "1", 5)),
    )
    columns = ["in_park_spend", "total_visit_spend", "booking_lead_days", "is_same_day_visit", "is_advance_purchase",
               "feedback_count", "has_feedback"]
    assert only(df, *columns) == (D(60), D(140), 9, False, True, 2, True)


def test_is_discounted(make):
    df = make["tickets"](ticket(1, "C1", "2024-07-01", "55", discount="20"), ticket(2, "C1", "2024-07-01", "55", channel="kiosk"))
    assert {r.ticket_id: r.is_discounted for r in df.collect()} == {"T1": True, "T2": False}


def test_haunted_houses(rows):
    houses = staging.haunted_houses(rows(RIDE, ride(1, True, "extreme"), ride(2))).collect()
    assert [(h.haunted_house_id, h.fear_level) for h in houses] == [("1", 5)]


def test_no_haunted_house_gives_no_ticket(rows):
    raw = rows(TICKET, ticket(1, "C1", "2024-07-01", "55"))
    numbered = raw.withColumn("ticket_id", raw.ticket_id.substr(2, 9).cast("long"))
    assert staging.haunted_tickets(numbered, rows(RIDE, ride(2))).count() == 0
    feedback = staging.haunted_feedback(rows(FEEDBACK, review(1, "C1", "2024-06-01", "2", 5)), rows(RIDE, ride(2))).first()
    assert (feedback.haunted_house_name, feedback.fear_level) == ("Unknown House", 3)


def test_transaction_tiers(make):
    amounts = ["150", "100", "99.99", "40", "39.99"]
    df = demos.enriched_transactions(make["pos"](*[sale(i, "C", "2024-06-01", "food", a) for i, a in enumerate(amounts)]))
    got = {r.total_amount: (r.spending_tier, r.is_high_value) for r in df.collect()}
    assert [got[D(a).quantize(D("0.01"))] for a in amounts] == [
        ("high", True), ("high", True), ("mid", False), ("mid", False), ("low", False)
    ]


def test_revenue_categories(make):
    names = ["Fast Food", "Craft Bev", "Gift Merch", "Ticket Upgrade", "Parking"]
    df = demos.enriched_transactions(make["pos"](*[sale(i, "C", "2024-06-01", n, "1") for i, n in enumerate(names)]))
    got = {r.category: r.revenue_category for r in df.collect()}
    assert [got[n] for n in names] == ["Food & Beverage", "Food & Beverage", "Merchandise", "Ticket", "Other"]


def test_spend_tiers(rows):
    schema = "customer_id string, visit_date date, ticket_type string, total_visit_spend decimal(10,2), avg_rating double"
    amounts = ["350", "300", "299.99", "100", "99.99", "10"]
    df = demos.spend_tiers(rows(schema, *[("C", day("2024-06-01"), "t", D(a), None) for a in amounts]))
    got = {r.total_visit_spend: r.spend_tier for r in df.collect()}
    assert [got[D(a).quantize(D("0.01"))] for a in amounts] == ["High", "High", "Mid", "Mid", "Low", "Low"]


def test_state_lookup(rows):
    from tidemark.functions import state_table
    from tidemark.operators.joins import lookup_upper
    from tidemark.sources.readers import inline_rows

    df = rows("id int, state string", (1, "ca"), (2, "ZZ"), (3, None))
    named = lookup_upper(df, "state", inline_rows(df.sparkSession, state_table()), "state_name")
    assert {r.id: r.state_name for r in named.collect()} == {1: "California", 2: "ZZ", 3: None}
    assert len(state_table()) == 50


def test_null_flags_find_no_junk_key(rows):
    schema = "sale_id int, customer_id int, ticket_id int, purchase_date date, visit_date date, ticket_price decimal(10,2), " \
             "discount_percent decimal(5,2), visit_hour int, payment_method string, created_at timestamp_ntz, updated_at timestamp_ntz, " \
             + ", ".join(f"{c} string" for c in core.FLAGS)
    head = (1, day("2024-01-01"), day("2024-01-01"), D(1), D(0), None, "cash", None, None)
    full = (1, 1, *head, *["x"] * 7)
    gap = (2, 1, *head, *["x"] * 6, None)
    sales = rows(schema, full, gap)
    flags = core.dim_transaction_flags(sales.withColumns({c: sales[c] == "x" for c in ("is_online", "same_day_visit")}))
    got = {r.sale_id: r.transaction_flag_key for r in core.sales_with_junk_key(sales).collect()}
    assert got[2] is None and got[1] is not None
    assert flags.where("transaction_flag_key IS NOT NULL").count() == 2
