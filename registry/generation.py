"""Synthetic data generation. Sizes and parents come from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import cte, hu, query, table
from registry.functions import unit_sql
from tidemark import datagen
from tidemark.datagen import Draws, Generator
from tidemark.functions import count_rows
from tidemark.operators.joins import multiply_rows

SEED = 11


def unit(name: str, column: str, row: str = "o_orderkey") -> str:
    return f"({unit_sql(SEED, name, column, row)})"


def whole(name: str, column: str, low: int, high: int, row: str = "o_orderkey") -> str:
    return f"(CAST(floor({unit(name, column, row)} * {high - low + 1}) AS BIGINT) + {low})"


def per_order(key: str, sql: str):
    """A projection over orders with draws of its own."""
    def register(make):
        def run(spark, sf):
            d = Draws(SEED, key[:3], "o_orderkey")
            return make(table(spark, sf, "orders"), d)

        query(key, sql)(run)
        return make

    return register


STATUS = "CASE WHEN {u} < 0.72 THEN 'delivered' WHEN {u} < 0.82 THEN 'cancelled' WHEN {u} < 0.87 THEN 'refunded' WHEN {u} < 0.95 " \
         "THEN 'out_for_delivery' WHEN {u} < 0.98 THEN 'preparing' ELSE 'accepted' END"


@per_order("G01_padded_keys", "SELECT o_orderkey, 'ORD' || lpad(CAST(o_orderkey AS VARCHAR), 13, '0') AS order_id FROM orders")
def padded_keys(rows, d):
    return rows.select("o_orderkey", datagen.code("ORD", F.col("o_orderkey"), 13).alias("order_id"))


@per_order("G02_uniform_pick", f"SELECT o_orderkey, ['platinum', 'gold', 'silver', 'bronze'][{whole('G02', 'tier', 1, 4)}] AS tier FROM orders")
def uniform_pick(rows, d):
    return rows.select("o_orderkey", d.pick("tier", datagen.TIERS).alias("tier"))


@per_order("G03_weighted_status", f"SELECT o_orderkey, {STATUS.format(u=unit('G03', 'status'))} AS status FROM orders")
def weighted_status(rows, d):
    return rows.select("o_orderkey", datagen.status_of(d.unit("status")).alias("status"))


@per_order("G04_conditional_nulls", f"""
SELECT o_orderkey, CASE WHEN u >= 0.82 THEN {whole('G04', 'partner', 1, 5000)} END AS partner,
  CASE WHEN u >= 0.72 AND u < 0.82 THEN 'cancelled' END AS reason FROM (SELECT *, {unit('G04', 'status')} AS u FROM orders)
""")
def conditional_nulls(rows, d):
    draw = d.unit("status")
    return rows.select(
        "o_orderkey", F.when(draw >= 0.82, d.whole("partner", 1, 5000)).alias("partner"),
        F.when((draw >= 0.72) & (draw < 0.82), "cancelled").alias("reason"),
    )


@per_order("G05_random_times", f"SELECT o_orderkey, o_orderdate + to_seconds({whole('G05', 'at', 60, 300)}) AS accepted_at FROM orders")
def random_times(rows, d):
    return rows.select("o_orderkey", d.seconds_after("at", F.col("o_orderdate"), 60, 300).alias("accepted_at"))


@per_order("G06_children", f"""
SELECT o_orderkey, k AS item, (o_orderkey - 1) * 3 + k AS item_number, {whole('G06', 'quantity', 1, 5, "o_orderkey || '/' || k")} AS quantity
FROM orders, (SELECT CAST(unnest(range(1, 4)) AS INT) AS k)
""")
def children(rows, _):
    d = Draws(SEED, "G06", F.concat_ws("/", "o_orderkey", "item"))
    number = (F.col("o_orderkey") - 1) * 3 + F.col("item")
    return multiply_rows(rows.select("o_orderkey"), 3, "item").select(
        "o_orderkey", "item", number.alias("item_number"), d.whole("quantity", 1, 5).alias("quantity")
    )


@per_order("G07_child_by_status", """
SELECT 'DLV' || lpad(CAST(o_orderkey AS VARCHAR), 13, '0') AS delivery_id, o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def child_by_status(rows, d):
    return rows.where(F.col("o_orderstatus").isin("F", "O")).select(
        datagen.code("DLV", F.col("o_orderkey"), 13).alias("delivery_id"), "o_orderkey"
    )


@per_order("G08_bernoulli", f"SELECT o_orderkey FROM orders WHERE {unit('G08', 'rated')} < 0.7")
def bernoulli(rows, d):
    return rows.where(d.flag("rated", 0.70)).select("o_orderkey")


@per_order("G09_normal", f"""
SELECT o_orderkey, CAST(floor((4.0 + 0.6 * sqrt(-2.0 * ln(1.0 - {unit('G09', 'rating/r')})) * cos(6.283185307179586 * {unit('G09', 'rating/a')}))
  * 10 + 0.5) AS BIGINT) AS rating_tenths FROM orders
""")
def normal(rows, d):
    rating = d.normal("rating", 4.0, 0.6)
    return rows.select("o_orderkey", F.floor(rating * 10 + 0.5).alias("rating_tenths"))


@per_order("G10_money_chain", f"""
WITH b AS (SELECT o_orderkey, CAST({whole('G10', 'subtotal', 50, 2000)} AS DECIMAL(12,2)) AS subtotal, {unit('G10', 'promo')} < 0.2 AS has,
  CAST(floor((0.05 + {unit('G10', 'rate')} * 0.25) * 10000 + 0.5) / 10000 AS DECIMAL(6,4)) AS rate FROM orders),
c AS (SELECT *, CASE WHEN subtotal < 150 THEN 40 WHEN subtotal < 500 THEN 30 ELSE 0 END AS fee,
  CASE WHEN has THEN CAST(subtotal * rate AS DECIMAL(10,2)) ELSE 0 END AS promo, CAST(subtotal * 0.05 AS DECIMAL(10,2)) AS tax FROM b)
SELECT o_orderkey, subtotal, CAST(fee AS DECIMAL(8,2)) AS fee, CAST(promo AS DECIMAL(10,2)) AS promo, tax,
  CAST(subtotal + fee + 5 - promo + tax AS DECIMAL(12,2)) AS total FROM c
""")
def money_chain(rows, d):
    subtotal = datagen.money(d.whole("subtotal", 50, 2000), 12)
    rate = (F.floor((F.lit(0.05) + d.unit("rate") * 0.25) * 10000 + 0.5) / 10000).cast("decimal(6,4)")
    chain = rows.select("o_orderkey", subtotal.alias("subtotal"), d.flag("promo", 0.20).alias("has"), rate.alias("rate")).withColumns(
        {
            "fee": datagen.delivery_fee(F.col("subtotal")),
            "promo": datagen.money(F.when(F.col("has"), F.round(F.col("subtotal") * F.col("rate"), 2)).otherwise(F.lit(0))),
            "tax": datagen.money(F.round(F.col("subtotal") * F.lit("0.05").cast("decimal(3,2)"), 2)),
        }
    )
    total = F.col("subtotal") + F.col("fee") + 5 - F.col("promo") + F.col("tax")
    return chain.select("o_orderkey", "subtotal", "fee", "promo", "tax", datagen.money(total, 12).alias("total"))


# --- the whole data set, sized by the order table --------------------------------------------


def generator(spark, sf) -> Generator:
    """As many orders, customers and restaurants as the test tables hold orders, customers and parts."""
    size = {n: table(spark, sf, n).count() for n in ("orders", "customer", "part", "supplier")}
    return Generator(spark, size["orders"], SEED, customers=size["customer"], restaurants=size["part"], partners=size["supplier"])


# Check SQL of the generated tables: the same draws by md5, with the sizes as sub-queries.
N = {
    "areas": "(SELECT count(*) * 5000 // 50000 FROM orders)", "promotions": "(SELECT count(*) * 5000 // 50000 FROM orders)",
    "menu_items": "(SELECT count(*) * 25000 // 50000 FROM orders)", "addresses": "(SELECT count(*) * 15000 // 50000 FROM orders)",
    "orders": "(SELECT count(*) FROM orders)", "customers": "(SELECT count(*) FROM customer)",
    "restaurants": "(SELECT count(*) FROM part)", "partners": "(SELECT count(*) FROM supplier)",
}
LOADED = f"TIMESTAMP '{datagen.LOADED_AT}'"
YEAR, DAY = 31_536_000, 86_400


class Sql:
    """Draws of one table as SQL; `row` identifies a row."""

    def __init__(self, table: str, row: str = "i"):
        self.table, self.row = table, row

    def unit(self, column: str) -> str:
        return unit(self.table, column, self.row)

    def whole(self, column: str, low: int, high: int | str) -> str:
        return f"(CAST(floor({self.unit(column)} * ({high} - {low} + 1)) AS BIGINT) + {low})"

    def pick(self, column: str, values: list[str]) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + f"][{self.whole(column, 1, len(values))}]"

    def flag(self, column: str, share: float) -> str:
        return f"({self.unit(column)} < {share})"

    def after(self, column: str, start: str, low: int, high: int) -> str:
        return f"({start} + to_seconds({self.whole(column, low, high)}))"

    def normal(self, column: str, center: float, spread: float, places: int) -> str:
        draw = f"sqrt(-2.0 * ln(1.0 - {self.unit(column + '/r')})) * cos(6.283185307179586 * {self.unit(column + '/a')})"
        return hu(f"{center}::DOUBLE + {spread}::DOUBLE * {draw}", places)


def code(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR))) AS INTEGER), '0')"


def numbered(name: str) -> str:
    return f"(SELECT unnest(range(1, {N[name]} + 1)) AS i)"


def money(expr: str, digits: int = 10) -> str:
    return f"CAST({expr} AS DECIMAL({digits},2))"


def select(source: str, **columns: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}"


def start(day: str) -> str:
    return f"TIMESTAMP '{day} 00:00:00'"


CHECK = {}
d = Sql("areas")
CHECK["areas"] = select(
    numbered("areas"), area_id=code("AREA", "i", 6), city_id=code("", d.whole("city", 1, 20), 2), area_name=code("Area_", "i", 6),
    pin_code=code("", d.whole("pin", 100000, 999999), 6), _fivetran_synced=LOADED,
)
d = Sql("promotions")
VALID_FROM = f"DATE '2020-01-01' + CAST({d.whole('from', 0, 1460)} AS INT)"
CHECK["promotions"] = select(
    f"(SELECT *, {d.pick('kind', datagen.DISCOUNT_TYPES)} AS kind FROM {numbered('promotions')})",
    promo_id=code("PRO", "i", 8), promo_code=code("CODE", "i", 8), promo_name="'Promotion ' || i",
    promo_description="'Synthetic promotion ' || i", discount_type="kind",
    discount_value=money(f"CASE kind WHEN 'percentage' THEN {d.whole('percent', 10, 50)} WHEN 'flat' THEN {d.whole('flat', 20, 200)} ELSE 0 END"),
    promo_funder=d.pick("funder", datagen.FUNDERS), min_order_value=money(d.whole("minimum", 0, 300)),
    max_redemptions=f"CAST({d.whole('redemptions', 100, 100_000)} AS INT)",
    max_redemptions_per_customer=f"CAST({d.whole('per_customer', 1, 5)} AS INT)", is_new_customer_only=d.flag("new_only", 0.2),
    eligible_cuisine_types="'null'", valid_from=VALID_FROM, valid_to=f"{VALID_FROM} + CAST({d.whole('length', 30, 180)} AS INT)",
    is_active=d.flag("active", 0.7), updated_at=d.after("updated", start("2020-01-01"), 0, 4 * YEAR), _fivetran_synced=LOADED,
)
d = Sql("restaurants")
CHECK["restaurants"] = select(
    numbered("restaurants"), restaurant_id=code("RST", "i", 8), restaurant_name=code("Restaurant_", "i", 8),
    city_id=code("", d.whole("city", 1, 20), 2), area_id=code("AREA", d.whole("area", 1, N["areas"]), 6),
    cuisine_type=d.pick("cuisine", datagen.CUISINES), restaurant_tier=d.pick("tier", datagen.TIERS), is_active=d.flag("active", 0.92),
    is_verified=d.flag("verified", 0.85), is_purely_vegetarian=d.flag("vegetarian", 0.15),
    average_prep_time_minutes=f"CAST({d.whole('prep', 10, 60)} AS INT)", minimum_order_amount=money(d.whole("minimum", 50, 300)),
    average_cost_for_two=money(d.whole("for_two", 200, 1500)),
    commission_rate=f"CAST({d.pick('commission', datagen.COMMISSIONS)} AS DOUBLE)", overall_rating=d.normal("rating", 4.0, 0.6, 1),
    total_ratings_count=f"CAST({d.whole('ratings', 0, 50_000)} AS INT)", created_at=d.after("created", start("2015-01-01"), 0, 5 * YEAR),
    updated_at=d.after("updated", start("2020-01-01"), 0, 4 * YEAR), _fivetran_synced=LOADED,
)
d = Sql("menu_items")
CHECK["menu_items"] = select(
    numbered("menu_items"), menu_item_id=code("MI", "i", 10), restaurant_id=code("RST", d.whole("restaurant", 1, N["restaurants"]), 8),
    item_name=code("Item_", "i", 10), item_category=d.pick("course", datagen.COURSES), base_price=money(d.whole("price", 50, 800)),
    is_vegetarian=d.flag("vegetarian", 0.45), is_available=d.flag("available", 0.9), _fivetran_synced=LOADED,
)
d = Sql("customers")
CHECK["customers"] = select(
    numbered("customers"), customer_id=code("C", "i", 10), customer_name=code("Customer_", "i", 10),
    customer_email="'user' || i || '@example.com'", customer_phone=code("+91", d.whole("phone", 7_000_000_000, 9_999_999_999), 10),
    city_id=code("", d.whole("city", 1, 20), 2), acquisition_channel=d.pick("channel", datagen.CHANNELS),
    customer_segment=d.pick("segment", datagen.SEGMENTS), is_active=d.flag("active", 0.88), is_pro_subscriber=d.flag("pro", 0.25),
    created_at=d.after("created", start("2015-01-01"), 0, 5 * YEAR), last_login_at=d.after("login", start("2024-01-01"), 0, YEAR),
    updated_at=d.after("updated", start("2020-01-01"), 0, 4 * YEAR), _fivetran_synced=LOADED,
)
d = Sql("addresses")
CHECK["customer_addresses"] = select(
    numbered("addresses"), address_id=code("ADDR", "i", 12), customer_id=code("C", d.whole("customer", 1, N["customers"]), 10),
    address_text=f"'House ' || {d.whole('house', 1, 999)} || ', Block ' || chr(CAST({d.whole('block', 65, 90)} AS INT)) || ', Locality ' || "
    + code("", d.whole("locality", 1, 1000), 4),
    area_id=code("AREA", d.whole("area", 1, N["areas"]), 6), is_default=d.flag("default", 0.6), _fivetran_synced=LOADED,
)
d = Sql("partners")
CHECK["delivery_partners"] = select(
    numbered("partners"), delivery_partner_id=code("DP", "i", 9), partner_name=code("Partner_", "i", 9),
    partner_phone=code("+91", d.whole("phone", 7_000_000_000, 9_999_999_999), 10), vehicle_type=d.pick("vehicle", datagen.VEHICLES),
    home_city_id=code("", d.whole("city", 1, 20), 2), is_verified=d.flag("verified", 0.9), is_active=d.flag("active", 0.85),
    total_deliveries_completed=f"CAST({d.whole('deliveries', 0, 10_000)} AS INT)", average_rating=d.normal("rating", 4.1, 0.5, 2),
    acceptance_rate=hu(f"0.60::DOUBLE + {d.unit('acceptance')} * 0.38::DOUBLE", 3),
    onboarded_at=d.after("onboarded", start("2015-01-01"), 0, 5 * YEAR), updated_at=d.after("updated", start("2020-01-01"), 0, 4 * YEAR),
    _fivetran_synced=LOADED,
)
d = Sql("orders")
cte("made_orders_base", f"""
SELECT *, {STATUS.format(u='u')} AS status, CASE WHEN subtotal < 150 THEN 40 WHEN subtotal < 500 THEN 30 ELSE 0 END AS fee,
  CASE WHEN has_promo THEN {money('subtotal * rate')} ELSE 0 END AS promo, {money('subtotal * 0.05')} AS tax
FROM (SELECT i, {d.unit('status')} AS u, {d.flag('promo', 0.2)} AS has_promo, {money(d.whole('subtotal', 50, 2000), 12)} AS subtotal,
  CAST({hu(f"0.05::DOUBLE + {d.unit('promo_rate')} * 0.25::DOUBLE", 4)} AS DECIMAL(6,4)) AS rate,
  {d.after('ordered', start('2020-01-01'), 0, 4 * YEAR)} AS ordered_at FROM {numbered('orders')})
""")


def when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


DONE, MOVING = "status IN ('delivered', 'refunded')", "u >= 0.82"
cte("made_orders", select(
    "made_orders_base", i="i", order_id=code("ORD", "i", 13), customer_id=code("C", d.whole("customer", 1, N["customers"]), 10),
    restaurant_id=code("RST", d.whole("restaurant", 1, N["restaurants"]), 8),
    delivery_partner_id=when(MOVING, code("DP", d.whole("partner", 1, N["partners"]), 9)), city_id=code("", d.whole("city", 1, 20), 2),
    promo_id=when("has_promo", code("PRO", d.whole("promo_id", 1, N["promotions"]), 8)), subtotal_amount="subtotal",
    delivery_fee=money("fee", 8), platform_fee="CAST(5 AS DECIMAL(8,2))", promo_discount_amount=money("promo"), tax_amount="tax",
    total_amount=money("subtotal + fee + 5 - promo + tax", 12), order_status="status",
    cancellation_reason=when("status = 'cancelled'", d.pick("reason", datagen.CANCEL_REASONS)),
    is_contactless_delivery=d.flag("contactless", 0.3), ordered_at="ordered_at",
    accepted_at=when(MOVING, d.after("accepted", "ordered_at", 60, 300)), prepared_at=when(MOVING, d.after("prepared", "ordered_at", 900, 2700)),
    picked_up_at=when(DONE, d.after("picked_up", "ordered_at", 2100, 3600)),
    delivered_at=when(DONE, d.after("delivered", "ordered_at", 2700, 5400)),
    cancelled_at=when("status = 'cancelled'", d.after("cancelled", "ordered_at", 60, 1800)),
    updated_at=d.after("updated", "ordered_at", 2700, DAY), _fivetran_synced=LOADED,
))
CHECK["orders"] = "SELECT * EXCLUDE (i) FROM made_orders"
d = Sql("order_items", "order_id || '/' || k")
ITEM = d.whole("item", 1, N["menu_items"])
CHECK["order_items"] = select(
    "made_orders, (SELECT unnest(range(1, 4)) AS k)", order_item_id=code("OI", "(i - 1) * 3 + k", 13), order_id="order_id",
    menu_item_id=code("MI", ITEM, 10), restaurant_id="restaurant_id", item_name=code("Item_", ITEM, 10),
    item_category=d.pick("course", datagen.COURSES), is_vegetarian=d.flag("vegetarian", 0.45),
    quantity=f"CAST({d.whole('quantity', 1, 5)} AS INT)", unit_price=money(d.whole("price", 50, 800)),
    customization_price_delta=money(f"CASE WHEN {d.flag('custom', 0.2)} THEN {d.whole('extra', 10, 100)} ELSE 0 END", 8),
    created_at=LOADED, _fivetran_synced=LOADED,
)
d = Sql("deliveries", "order_id")
CHECK["deliveries"] = select(
    "made_orders WHERE order_status IN ('delivered', 'out_for_delivery', 'refunded')", delivery_id=code("DLV", "i", 13), order_id="order_id",
    delivery_partner_id="coalesce(delivery_partner_id, " + code("DP", d.whole("partner", 1, N["partners"]), 9) + ")",
    delivery_status="CASE WHEN order_status = 'out_for_delivery' THEN order_status ELSE 'delivered' END",
    failure_reason=when(d.flag("failed", 0.03), d.pick("failure", datagen.DELIVERY_FAILURES)),
    assigned_at=d.after("assigned", "ordered_at", 30, 180), en_route_restaurant_at=d.after("en_route", "ordered_at", 180, 480),
    arrived_restaurant_at=d.after("arrived", "ordered_at", 600, 1800),
    picked_up_at=f"coalesce(picked_up_at, {d.after('picked_up', 'ordered_at', 1200, 2400)})",
    delivered_at=f"coalesce(delivered_at, {d.after('delivered', 'ordered_at', 2400, 4800)})",
    delivery_distance_km=hu(f"1.0::DOUBLE + {d.unit('distance')} * 24.0::DOUBLE"),
    route_distance_km=hu(f"1.5::DOUBLE + {d.unit('route')} * 33.5::DOUBLE"), updated_at=d.after("updated", "ordered_at", 3000, 90_000),
    _fivetran_synced=LOADED,
)
d = Sql("payments", "order_id")
CHECK["payments"] = select(
    "made_orders", payment_id=code("PAY", "i", 13), order_id="order_id",
    payment_status=f"CASE WHEN order_status = 'cancelled' AND {d.flag('failed', 0.3)} THEN 'failed' "
    f"WHEN order_status IN ('delivered', 'refunded') AND {d.flag('returned', 0.02)} THEN 'refunded' ELSE 'success' END",
    payment_method=d.pick("method", datagen.PAID_BY), payment_amount="total_amount",
    gateway_fee=money(f"total_amount * CAST({hu('0.005::DOUBLE + ' + d.unit('fee') + ' * 0.02::DOUBLE', 4)} AS DECIMAL(6,4))", 8),
    paid_at=d.after("paid", "ordered_at", 0, 300), settlement_date=f"CAST(ordered_at AS DATE) + CAST({d.whole('settled', 1, 3)} AS INT)",
    _loaded_at=LOADED,
)
d = Sql("ratings", "order_id")
cte("made_ratings", select(
    f"made_orders WHERE order_status = 'delivered' AND {d.flag('rated', 0.7)}", i="i", rating_id=code("RTG", "i", 13), order_id="order_id",
    customer_id="customer_id", restaurant_id="restaurant_id", delivery_partner_id="delivery_partner_id",
    food_rating=f"CAST({d.whole('food', 1, 5)} AS INT)", delivery_rating=f"CAST({d.whole('delivery', 1, 5)} AS INT)",
    overall_rating=f"({d.whole('food', 1, 5)} + {d.whole('delivery', 1, 5)}) / 2.0::DOUBLE",
    rated_at=d.after("rated_at", "delivered_at", 1800, 2 * DAY), _airbyte_extracted_at=LOADED,
))
CHECK["ratings"] = "SELECT * EXCLUDE (i) FROM made_ratings"
d = Sql("reviews", "rating_id")
CHECK["reviews"] = select(
    f"made_ratings WHERE {d.flag('reviewed', 0.5)}", review_id=code("RVW", "i", 13), rating_id="rating_id",
    review_text=d.pick("text", datagen.REVIEW_TEXTS),
    sentiment_label="CASE WHEN overall_rating < 3 THEN 'negative' WHEN overall_rating < 4 THEN 'neutral' ELSE 'positive' END",
    submitted_at=d.after("submitted", "rated_at", 0, DAY), _airbyte_extracted_at=LOADED,
)
d = Sql("redemptions", "order_id")
FAILED = f"order_status = 'cancelled' AND {d.flag('failed', 0.15)}"
CHECK["promo_redemptions"] = select(
    "made_orders WHERE promo_id IS NOT NULL", redemption_id=code("RDM", "i", 13), order_id="order_id", promo_id="promo_id",
    customer_id="customer_id", discount_amount_applied="promo_discount_amount",
    redemption_status=f"CASE WHEN {FAILED} THEN 'failed' ELSE 'success' END", failure_reason=when(FAILED, "'promo_expired'"),
    redeemed_at="ordered_at", _fivetran_synced=LOADED,
)
d = Sql("tickets", "order_id")
cte("made_tickets", select(
    f"made_orders WHERE {d.flag('opened', 0.1)}", i="i", ticket_id=code("TKT", "i", 12), customer_id="customer_id", order_id="order_id",
    assigned_agent_id=code("AGT", d.whole("agent", 1, 500), 6), ticket_category=d.pick("category", datagen.TICKET_CATEGORIES),
    ticket_status=d.pick("state", datagen.TICKET_STATES), priority=d.pick("priority", datagen.PRIORITIES),
    resolution_code=when(d.flag("resolved", 0.8), d.pick("resolution", datagen.RESOLUTIONS)),
    csat_score=f"CAST({when(d.flag('scored', 0.75), d.whole('csat', 1, 5))} AS INT)", created_at="ordered_at",
    first_response_at=d.after("response", "ordered_at", 300, 7200),
    resolved_at=when(d.flag("closed", 0.8), d.after("closing", "ordered_at", 3600, 2 * DAY)),
    updated_at=d.after("updated", "ordered_at", 3600, 3 * DAY), _airbyte_extracted_at=LOADED,
))
CHECK["support_tickets"] = "SELECT * EXCLUDE (i) FROM made_tickets"
d = Sql("comments", "ticket_id || '/' || k")
CHECK["ticket_comments"] = select(
    "made_tickets, (SELECT unnest(range(1, 3)) AS k)", comment_id=code("CMT", "(i - 1) * 2 + k", 13), ticket_id="ticket_id",
    commenter_type="CASE k WHEN 1 THEN 'customer' ELSE 'agent' END", comment_text=d.pick("text", datagen.COMMENT_TEXTS),
    commented_at=f"created_at + to_seconds(k * {d.whole('wait', 1800, 7200)})", _airbyte_extracted_at=LOADED,
)


def generated(name: str) -> None:
    def run(spark, sf):
        df = generator(spark, sf).table(name)
        variant = [f.name for f in df.schema if f.dataType.typeName() == "variant"]
        return df.withColumns({c: F.to_json(c) for c in variant})

    query(f"gen_{name}", CHECK[name])(run)


for _name in CHECK:
    generated(_name)


@query("gen_integrity", """
SELECT t AS child, CAST(0 AS BIGINT) AS orphans FROM (VALUES ('order_items'), ('deliveries'), ('payments'), ('ratings'), ('reviews'),
  ('promo_redemptions'), ('support_tickets'), ('ticket_comments'), ('orders')) v(t)
""")
def integrity(spark, sf):
    """Children without a parent, per table; keys of generated parents are made again, not stored."""
    from tidemark.incremental import union_all
    from tidemark.operators.joins import orphans

    made = generator(spark, sf)
    t = {name: made.table(name) for name in made.TABLES}
    links = [
        ("order_items", "order_id", "orders", "order_id"), ("deliveries", "order_id", "orders", "order_id"),
        ("payments", "order_id", "orders", "order_id"), ("ratings", "order_id", "orders", "order_id"),
        ("reviews", "rating_id", "ratings", "rating_id"), ("promo_redemptions", "promo_id", "promotions", "promo_id"),
        ("support_tickets", "order_id", "orders", "order_id"), ("ticket_comments", "ticket_id", "support_tickets", "ticket_id"),
        ("orders", "customer_id", "customers", "customer_id"),
    ]
    counts = [
        orphans(t[child].select(fk), fk, t[parent].select(key), key).agg(count_rows().alias("orphans")).select(
            F.lit(child).alias("child"), "orphans"
        )
        for child, fk, parent, key in links
    ]
    return union_all(counts)
