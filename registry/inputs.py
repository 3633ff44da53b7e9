"""The test tables in the shape of the raw feeds. One expression text serves both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registry.base import cte, table

TICKET_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(9,2)) * 0.001 AS DECIMAL(10,2))"
TICKET_PCT = "CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_orderkey % 40 END AS DECIMAL(4,0))"
TICKET_DISCOUNT = f"CAST({TICKET_PRICE} * {TICKET_PCT} * 0.01 AS DECIMAL(12,4))"
EVENT_PCT = "CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 40 END AS DECIMAL(4,0))"
EVENT_PRICE = "CAST(value AS DECIMAL(10,2))"
EVENT_DISCOUNT = f"CAST({EVENT_PRICE} * {EVENT_PCT} * 0.01 AS DECIMAL(12,4))"
RATING = "CAST(1 + CAST(FLOOR(value) AS BIGINT) % 5 AS INT)"
LINE_AMOUNT = (
    "CAST(CAST(l_extendedprice AS DECIMAL(8,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) * 0.01 AS DECIMAL(10,2))"
)
LINE_CATEGORY = (
    "CASE WHEN l_returnflag = 'A' THEN 'food' WHEN l_returnflag = 'N' THEN 'merchandise' "
    "WHEN l_linestatus = 'F' THEN 'game' ELSE 'photo' END"
)
LINE = {
    "transaction_id": "l_orderkey * 10 + l_linenumber",
    "customer_id": "CAST(NULL AS BIGINT)",
    "visit_date": "CAST(l_shipdate AS DATE)",
    "category": LINE_CATEGORY,
    "item_name": "'Item ' || CAST(l_partkey AS STRING)",
    "quantity": "CAST(l_quantity AS INT)",
    "unit_price": "CAST(CAST(l_extendedprice AS DECIMAL(8,2)) * 0.001 AS DECIMAL(10,2))",
    "total_amount": LINE_AMOUNT,
    "payment_method": "CASE l_linenumber % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'cash' WHEN 2 THEN 'kiosk' "
    "ELSE 'mobile' END",
    "location": "'Stand ' || CAST(l_suppkey % 10 AS STRING)",
}

# name -> (table, row condition, {column: expression}); {TS} is the zone-free timestamp type.
FEEDS: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "raw_tickets": ("orders", None, {
        "ticket_id": "o_orderkey",
        "customer_id": "o_custkey",
        "ticket_type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'annual_pass' WHEN '2-HIGH' THEN 'weekend_pass' "
        "WHEN '4-NOT SPECIFIED' THEN 'group_pass' ELSE 'day_pass' END",
        "purchase_date": "CAST(o_orderdate AS DATE) - CAST(o_orderkey % 15 AS INT)",
        "visit_date": "CAST(o_orderdate AS DATE)",
        "purchase_channel": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'online' WHEN o_orderstatus = 'O' THEN 'in_park' "
        "WHEN o_orderstatus = 'F' THEN 'kiosk' ELSE 'phone' END",
        "base_price": TICKET_PRICE,
        "discount_amount": TICKET_DISCOUNT,
        "final_price": f"CAST({TICKET_PRICE} - {TICKET_DISCOUNT} AS DECIMAL(10,2))",
        "promo_code": "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'P' || CAST(o_orderkey % 7 AS STRING) END",
    }),
    "raw_pos_lines": ("lineitem", None, LINE),
    "raw_customers": ("customer", None, {
        "customer_id": "c_custkey",
        "first_name": "c_name",
        "last_name": "c_mktsegment",
        "email": "CASE WHEN c_custkey % 10 = 0 THEN c_name ELSE REPLACE(c_name, '#', '.') || '@Example.com' END",
        "phone": "CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE '+1-555-' || LPAD(CAST(c_custkey % 10000 AS STRING), 4, '0') END",
        "date_of_birth": "DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INT)",
        "membership_type": "CASE WHEN c_acctbal >= 7500 THEN 'platinum' WHEN c_acctbal >= 5000 THEN 'gold' "
        "WHEN c_acctbal >= 2500 THEN 'silver' WHEN c_acctbal >= 0 THEN 'standard' END",
        "signup_channel": "CASE c_custkey % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'in_park' ELSE 'referral' END",
        "created_at": "CAST(DATE '1999-01-01' + CAST((c_custkey * 31) % 1090 AS INT) AS {TS})",
        "is_active": "c_custkey % 9 <> 0",
    }),
    "raw_rides": ("part", None, {
        "ride_id": "p_partkey",
        "ride_name": "p_name || ' ' || CAST(p_partkey % 97 AS STRING)",
        "ride_type": "p_brand",
        "min_height_cm": "CASE WHEN p_size % 5 = 0 THEN 0 ELSE 90 + p_size END",
        "thrill_level": "CASE p_type WHEN 'PROMO' THEN 'extreme' WHEN 'LARGE' THEN 'high' WHEN 'MEDIUM' THEN 'medium' "
        "WHEN 'SMALL' THEN 'low' ELSE 'mild' END",
        "capacity_per_hour": "p_size * 20",
        "zone": "'Zone ' || CAST(p_partkey % 6 AS STRING)",
        "is_haunted": "p_partkey % 5 = 0",
        "opened_date": "DATE '1990-01-01' + CAST(p_partkey % 3000 AS INT)",
        "status": "CASE p_partkey % 7 WHEN 0 THEN 'closed' WHEN 1 THEN 'maintenance' ELSE 'active' END",
        "avg_wait_minutes": "p_size",
    }),
    "raw_employees": ("supplier", None, {
        "employee_id": "s_suppkey",
        "first_name": "s_name",
        "last_name": "'Nation ' || CAST(s_nationkey AS STRING)",
        "department": "CASE s_suppkey % 3 WHEN 0 THEN 'operations' WHEN 1 THEN 'merchandise' ELSE 'food_beverage' END",
        "role": "CASE WHEN s_suppkey < 10 THEN 'Lead' ELSE 'Associate' END",
        "hire_date": "DATE '1995-06-01' + CAST((s_suppkey * 41) % 2300 AS INT)",
        "hourly_rate": "CAST(10 + s_suppkey % 40 + 0.25 AS DECIMAL(10,2))",
        "manager_id": "CASE WHEN s_suppkey < 10 THEN NULL ELSE CAST(FLOOR(s_suppkey / 10) AS BIGINT) END",
        "is_active": "s_suppkey % 8 <> 0",
        "zone_assignment": "'Zone ' || CAST(s_nationkey AS STRING)",
    }),
    "raw_feedback": ("events", "event_type = 'view'", {
        "feedback_id": "event_id",
        "customer_id": "user_id",
        "visit_date": "CAST(ts AS DATE)",
        "ride_id": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 150 END",
        "rating": RATING,
        "category": "CASE user_id % 5 WHEN 0 THEN 'food' WHEN 1 THEN 'staff' WHEN 2 THEN 'general' ELSE 'ride' END",
        "sentiment": f"CASE WHEN {RATING} > 3 THEN 'good' ELSE 'bad' END",
        "comments": "props",
        "submitted_at": "ts",
    }),
    "ev_tickets": ("events", "event_type = 'purchase'", {
        "ticket_id": "event_id",
        "customer_id": "user_id",
        "ticket_type": "CASE event_id % 4 WHEN 0 THEN 'day_pass' WHEN 1 THEN 'weekend_pass' WHEN 2 THEN 'annual_pass' "
        "ELSE 'group_pass' END",
        "purchase_date": "CAST(ts AS DATE) - CAST(event_id % 12 AS INT)",
        "visit_date": "CAST(ts AS DATE)",
        "purchase_channel": "CASE event_id % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'kiosk' ELSE 'phone' END",
        "base_price": EVENT_PRICE,
        "discount_amount": EVENT_DISCOUNT,
        "final_price": f"CAST({EVENT_PRICE} - {EVENT_DISCOUNT} AS DECIMAL(10,2))",
        "promo_code": "CASE WHEN event_id % 3 = 0 THEN '' ELSE 'P' || CAST(event_id % 7 AS STRING) END",
    }),
    "ev_pos": ("events", "event_type = 'click'", {
        "transaction_id": "event_id",
        "customer_id": "user_id",
        "visit_date": "CAST(ts AS DATE)",
        "category": "CASE event_id % 5 WHEN 0 THEN 'Fast Food' WHEN 1 THEN 'Craft Bev' WHEN 2 THEN 'Gift Merch' "
        "WHEN 3 THEN 'Ticket Upgrade' ELSE 'Parking' END",
        "item_name": "'Item ' || CAST(event_id % 40 AS STRING)",
        "quantity": "CAST(1 + event_id % 4 AS INT)",
        "unit_price": "CAST(value AS DECIMAL(10,2))",
        "total_amount": "CAST(CAST(value AS DECIMAL(10,2)) * (1 + event_id % 4) AS DECIMAL(10,2))",
        "payment_method": "CASE event_id % 3 WHEN 0 THEN 'cash' WHEN 1 THEN 'mobile' ELSE 'credit_card' END",
        "location": "'Stand ' || CAST(user_id % 7 AS STRING)",
    }),
    # Haunted feedback with the columns filled that the raw feed leaves empty.
    "house_feedback": ("events", "event_type = 'view'", {
        "feedback_id": "event_id",
        "haunted_house_name": "'House ' || CAST(user_id % 23 AS STRING)",
        "fear_level": "CAST(2 + user_id % 4 AS INT)",
        "ticket_price": "CASE WHEN user_id % 23 = 7 THEN NULL ELSE CAST(value AS DECIMAL(10,2)) END",
        "includes_vip_benefits": "CASE event_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END",
        "includes_fast_pass": "CASE event_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE ELSE NULL END",
        "visitor_type": "CASE user_id % 5 WHEN 0 THEN 'food' WHEN 1 THEN 'staff' WHEN 2 THEN 'general' ELSE 'ride' END",
        "customer_age": "CAST(CASE WHEN event_id % 19 = 0 THEN NULL ELSE 12 + event_id % 60 END AS INT)",
        "customer_gender": "CASE event_id % 2 WHEN 0 THEN 'f' ELSE 'm' END",
        "satisfaction_rating": RATING,
        "would_recommend": f"{RATING} >= 4",
        "visit_date": "CAST(ts AS DATE)",
        "visit_hour": "CAST(EXTRACT(HOUR FROM ts) AS INT)",
    }),
    "payment_feed": ("events", None, {
        "event_id": "event_id",
        "customer_id": "user_id",
        "payment_amount_raw": "CASE WHEN event_id % 50 = 0 THEN 'NOT_A_NUMBER' "
        "WHEN event_id % 70 = 0 THEN '-' || CAST(CAST(value AS DECIMAL(12,2)) AS STRING) "
        "ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END",
        "currency": "'USD'",
        "payment_status": "CASE WHEN event_type = 'error' THEN 'declined' ELSE 'captured' END",
        "event_timestamp": "ts",
    }),
}


def feed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, where, columns = FEEDS[name]
    rows = table(spark, sf, source)
    if where:
        rows = rows.where(where)
    return rows.selectExpr(*[f"{e.replace('{TS}', 'TIMESTAMP_NTZ')} AS {c}" for c, e in columns.items()])


def pos_with_customer(spark: SparkSession, sf: str) -> DataFrame:
    """In-park sales with the customer of the order. Both sides are cut to their columns before the join."""
    columns = {**LINE, "customer_id": "o_custkey"}
    who = table(spark, sf, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    joined = table(spark, sf, "lineitem").join(who, "l_orderkey")
    return joined.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


for _name, (_source, _where, _columns) in FEEDS.items():
    _list = ", ".join(f"{e.replace('{TS}', 'TIMESTAMP')} AS {c}" for c, e in _columns.items())
    cte(_name, f"SELECT {_list} FROM {_source}" + (f" WHERE {_where}" if _where else ""))
_list = ", ".join(f"{e} AS {c}" for c, e in {**LINE, "customer_id": "o_custkey"}.items())
cte("raw_pos", f"SELECT {_list} FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
