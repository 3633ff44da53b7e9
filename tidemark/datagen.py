"""Synthetic order-delivery data.

Every random draw is a hash of (seed, table, column, row number). So a row has the same values
whichever executor makes it, however often, and children can be generated from their parents
without storing them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_col, half_up
from tidemark.operators.joins import multiply_rows
from tidemark.sources.readers import inline_rows

NTZ = "timestamp_ntz"
LOADED_AT = "2025-01-01 00:00:00"

# --- Fixed values --------------------------------------------------------------------------
PAYMENT_METHODS = [
    ("PM01", "upi", "digital", 0.0050), ("PM02", "credit_card", "card", 0.0200), ("PM03", "debit_card", "card", 0.0150),
    ("PM04", "net_banking", "digital", 0.0100), ("PM05", "wallet", "digital", 0.0075),
    ("PM06", "cash_on_delivery", "cash", 0.0000), ("PM07", "emi", "credit", 0.0250), ("PM08", "pay_later", "credit", 0.0300),
    ("PM09", "phonepe", "digital", 0.0050), ("PM10", "amazon_pay", "digital", 0.0060),
]
CUISINES = [
    "north_indian", "south_indian", "chinese", "fast_food", "pizza", "biryani", "desserts", "beverages",
    "continental", "mughlai", "thai", "italian", "mexican", "other",
]
TIERS = ["platinum", "gold", "silver", "bronze"]
COMMISSIONS = ["0.25", "0.22", "0.20", "0.18"]
COURSES = ["Starter", "Main Course", "Dessert", "Beverage", "Snack", "Bread", "Rice", "Combo", "Salad", "Soup"]
CHANNELS = ["organic", "paid_social", "referral", "promo", "app_store", "unknown"]
SEGMENTS = ["premium", "regular", "occasional", "new"]
VEHICLES = ["bicycle", "motorcycle", "scooter", "car"]
DISCOUNT_TYPES = ["percentage", "flat", "free_delivery"]
FUNDERS = ["platform", "restaurant"]
# Upper limit of the draw -> status.
STATUS_LIMITS = [
    (0.72, "delivered"), (0.82, "cancelled"), (0.87, "refunded"), (0.95, "out_for_delivery"), (0.98, "preparing"),
    (1.0, "accepted"),
]
CANCEL_REASONS = ["customer_cancelled", "restaurant_rejected", "no_delivery_partner", "payment_failed", "other"]
DELIVERY_FAILURES = ["partner_unavailable", "address_not_found", "customer_unavailable"]
PAID_BY = [
    "upi", "upi", "credit_card", "debit_card", "net_banking", "wallet", "cash_on_delivery", "phonepe", "amazon_pay",
    "pay_later",
]
REVIEW_TEXTS = [f"review {i}" for i in range(1, 6)]
TICKET_CATEGORIES = [
    "missing_item", "wrong_item", "late_delivery", "damaged_food", "payment_issue", "refund_request", "account_issue",
    "restaurant_complaint", "other",
]
TICKET_STATES = ["open", "in_progress", "resolved", "closed"]
PRIORITIES = ["high", "medium", "low"]
RESOLUTIONS = ["full_refund", "partial_refund", "replacement_sent", "no_action"]
COMMENT_TEXTS = [f"comment {i}" for i in range(1, 7)]
CITIES = 20
DAY, YEAR = 86_400, 31_536_000
ITEMS_PER_ORDER, COMMENTS_PER_TICKET = 3, 2
PROMO_SHARE, RATED_SHARE, REVIEWED_SHARE, TICKET_SHARE = 0.20, 0.70, 0.50, 0.10
DELIVERED_STATES = ("delivered", "out_for_delivery", "refunded")
# -------------------------------------------------------------------------------------------


class Draws:
    """Random columns for one table; `row` identifies a row."""

    def __init__(self, seed: int, table: str, row: Column | str):
        self.prefix, self.row = f"{seed}|{table}|", as_col(row)

    def unit(self, name: str) -> Column:
        """Uniform on [0, 1): 52 bits of an md5 digest."""
        digest = F.md5(F.concat(F.lit(f"{self.prefix}{name}|"), self.row.cast("string")))
        return F.conv(F.left(digest, F.lit(13)), 16, 10).cast("double") / F.lit(float(2**52))

    def whole(self, name: str, low: int, high: int | Column) -> Column:
        """Uniform whole number from low to high, both included."""
        return F.floor(self.unit(name) * (F.lit(high) - F.lit(low) + 1)).cast("long") + F.lit(low).cast("long")

    def pick(self, name: str, values: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), self.whole(name, 1, len(values)).cast("int"))

    def flag(self, name: str, share: float) -> Column:
        return self.unit(name) < share

    def seconds_after(self, name: str, start: Column, low: int, high: int) -> Column:
        return start + F.make_dt_interval(secs=self.whole(name, low, high).cast("decimal(18,6)"))

    def normal(self, name: str, center: float, spread: float) -> Column:
        """Normal draw by the Box-Muller rule."""
        radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - self.unit(f"{name}/r")))
        return F.lit(center) + F.lit(spread) * radius * F.cos(F.lit(6.283185307179586) * self.unit(f"{name}/a"))


def code(prefix: str, number: Column, width: int) -> Column:
    """Padded key such as ORD0000000000001. Longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def status_of(draw: Column) -> Column:
    picked = F
    for limit, label in STATUS_LIMITS:
        picked = picked.when(draw < limit, F.lit(label))
    return picked.otherwise(F.lit(STATUS_LIMITS[-1][1]))


def delivery_fee(subtotal: Column) -> Column:
    return F.when(subtotal < 150, 40).when(subtotal < 500, 30).otherwise(0).cast("decimal(8,2)")


def money(c: Column, precision: int = 10) -> Column:
    return c.cast(f"decimal({precision},2)")


class Generator:
    """All tables for `n_orders` orders; the other sizes keep the usual proportions unless given."""

    # Rows per 50,000 orders.
    PROPORTIONS = {
        "areas": 5_000, "promotions": 5_000, "restaurants": 5_000, "menu_items": 25_000, "customers": 10_000,
        "addresses": 15_000, "partners": 5_000, "orders": 50_000,
    }

    def __init__(self, spark: SparkSession, n_orders: int, seed: int = 1, **sizes: int):
        self.spark, self.seed = spark, seed
        self.n = {k: max(1, v * n_orders // 50_000) for k, v in self.PROPORTIONS.items()} | {"orders": n_orders} | sizes
        self.loaded = F.lit(LOADED_AT).cast(NTZ)

    def _rows(self, table: str, n: int | None = None) -> tuple[DataFrame, Draws, Column]:
        rows = self.spark.range(1, (n or self.n[table]) + 1).withColumnRenamed("id", "row_num")
        return rows, Draws(self.seed, table, "row_num"), F.col("row_num")

    def _start(self, day: str) -> Column:
        return F.lit(f"{day} 00:00:00").cast(NTZ)

    def cities(self) -> DataFrame:
        """Numbered cities; the first ones are the large ones and were opened first."""
        number = F.col("id")
        tier = F.when(number <= 6, F.lit("1")).when(number <= 15, F.lit("2")).otherwise(F.lit("3"))
        return self.spark.range(1, CITIES + 1).select(
            code("", number, 2).alias("city_id"),
            code("City_", number, 2).alias("city_name"),
            code("State_", F.pmod(number, F.lit(12)) + 1, 2).alias("state"),
            tier.alias("tier"),
            F.add_months(F.lit("2015-01-01").cast("date"), (number * 3).cast("int")).alias("launch_date"),
            (tier == "1").alias("is_metro"),
            F.lit(True).alias("is_active"),
            self.loaded.alias("_fivetran_synced"),
        )

    def payment_methods(self) -> DataFrame:
        names = ("payment_method_id", "payment_method_name", "payment_method_group", "gateway_fee_rate")
        return inline_rows(self.spark, PAYMENT_METHODS, *names).withColumn(
            "gateway_fee_rate", F.col("gateway_fee_rate").cast("double")
        )

    def areas(self) -> DataFrame:
        rows, d, i = self._rows("areas")
        return rows.select(
            code("AREA", i, 6).alias("area_id"),
            code("", d.whole("city", 1, 20), 2).alias("city_id"),
            code("Area_", i, 6).alias("area_name"),
            code("", d.whole("pin", 100000, 999999), 6).alias("pin_code"),
            self.loaded.alias("_fivetran_synced"),
        )

    def promotions(self) -> DataFrame:
        rows, d, i = self._rows("promotions")
        kind = d.pick("kind", DISCOUNT_TYPES)
        value = (
            F.when(kind == "percentage", d.whole("percent", 10, 50))
            .when(kind == "flat", d.whole("flat", 20, 200))
            .otherwise(F.lit(0))
        )
        starts = F.date_add(F.lit("2020-01-01").cast("date"), d.whole("from", 0, 1460).cast("int"))
        return rows.select(
            code("PRO", i, 8).alias("promo_id"),
            code("CODE", i, 8).alias("promo_code"),
            F.concat(F.lit("Promotion "), i.cast("string")).alias("promo_name"),
            F.concat(F.lit("Synthetic promotion "), i.cast("string")).alias("promo_description"),
            kind.alias("discount_type"),
            money(value).alias("discount_value"),
            d.pick("funder", FUNDERS).alias("promo_funder"),
            money(d.whole("minimum", 0, 300)).alias("min_order_value"),
            d.whole("redemptions", 100, 100_000).cast("int").alias("max_redemptions"),
            d.whole("per_customer", 1, 5).cast("int").alias("max_redemptions_per_customer"),
            d.flag("new_only", 0.20).alias("is_new_customer_only"),
            F.parse_json(F.lit("null")).alias("eligible_cuisine_types"),
            starts.alias("valid_from"),
            F.date_add(starts, d.whole("length", 30, 180).cast("int")).alias("valid_to"),
            d.flag("active", 0.70).alias("is_active"),
            d.seconds_after("updated", self._start("2020-01-01"), 0, 4 * YEAR).alias("updated_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def restaurants(self) -> DataFrame:
        rows, d, i = self._rows("restaurants")
        return rows.select(
            code("RST", i, 8).alias("restaurant_id"),
            code("Restaurant_", i, 8).alias("restaurant_name"),
            code("", d.whole("city", 1, 20), 2).alias("city_id"),
            code("AREA", d.whole("area", 1, self.n["areas"]), 6).alias("area_id"),
            d.pick("cuisine", CUISINES).alias("cuisine_type"),
            d.pick("tier", TIERS).alias("restaurant_tier"),
            d.flag("active", 0.92).alias("is_active"),
            d.flag("verified", 0.85).alias("is_verified"),
            d.flag("vegetarian", 0.15).alias("is_purely_vegetarian"),
            d.whole("prep", 10, 60).cast("int").alias("average_prep_time_minutes"),
            money(d.whole("minimum", 50, 300)).alias("minimum_order_amount"),
            money(d.whole("for_two", 200, 1500)).alias("average_cost_for_two"),
            d.pick("commission", COMMISSIONS).cast("double").alias("commission_rate"),
            half_up(d.normal("rating", 4.0, 0.6), 1).alias("overall_rating"),
            d.whole("ratings", 0, 50_000).cast("int").alias("total_ratings_count"),
            d.seconds_after("created", self._start("2015-01-01"), 0, 5 * YEAR).alias("created_at"),
            d.seconds_after("updated", self._start("2020-01-01"), 0, 4 * YEAR).alias("updated_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def menu_items(self) -> DataFrame:
        rows, d, i = self._rows("menu_items")
        return rows.select(
            code("MI", i, 10).alias("menu_item_id"),
            code("RST", d.whole("restaurant", 1, self.n["restaurants"]), 8).alias("restaurant_id"),
            code("Item_", i, 10).alias("item_name"),
            d.pick("course", COURSES).alias("item_category"),
            money(d.whole("price", 50, 800)).alias("base_price"),
            d.flag("vegetarian", 0.45).alias("is_vegetarian"),
            d.flag("available", 0.90).alias("is_available"),
            self.loaded.alias("_fivetran_synced"),
        )

    def customers(self) -> DataFrame:
        rows, d, i = self._rows("customers")
        return rows.select(
            code("C", i, 10).alias("customer_id"),
            code("Customer_", i, 10).alias("customer_name"),
            F.concat(F.lit("user"), i.cast("string"), F.lit("@example.com")).alias("customer_email"),
            code("+91", d.whole("phone", 7_000_000_000, 9_999_999_999), 10).alias("customer_phone"),
            code("", d.whole("city", 1, 20), 2).alias("city_id"),
            d.pick("channel", CHANNELS).alias("acquisition_channel"),
            d.pick("segment", SEGMENTS).alias("customer_segment"),
            d.flag("active", 0.88).alias("is_active"),
            d.flag("pro", 0.25).alias("is_pro_subscriber"),
            d.seconds_after("created", self._start("2015-01-01"), 0, 5 * YEAR).alias("created_at"),
            d.seconds_after("login", self._start("2024-01-01"), 0, YEAR).alias("last_login_at"),
            d.seconds_after("updated", self._start("2020-01-01"), 0, 4 * YEAR).alias("updated_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def addresses(self) -> DataFrame:
        rows, d, i = self._rows("addresses")
        text = F.concat(
            F.lit("House "), d.whole("house", 1, 999).cast("string"),
            F.lit(", Block "), F.chr(d.whole("block", 65, 90)),
            F.lit(", Locality "), code("", d.whole("locality", 1, 1000), 4),
        )
        return rows.select(
            code("ADDR", i, 12).alias("address_id"),
            code("C", d.whole("customer", 1, self.n["customers"]), 10).alias("customer_id"),
            text.alias("address_text"),
            code("AREA", d.whole("area", 1, self.n["areas"]), 6).alias("area_id"),
            d.flag("default", 0.60).alias("is_default"),
            self.loaded.alias("_fivetran_synced"),
        )

    def partners(self) -> DataFrame:
        rows, d, i = self._rows("partners")
        return rows.select(
            code("DP", i, 9).alias("delivery_partner_id"),
            code("Partner_", i, 9).alias("partner_name"),
            code("+91", d.whole("phone", 7_000_000_000, 9_999_999_999), 10).alias("partner_phone"),
            d.pick("vehicle", VEHICLES).alias("vehicle_type"),
            code("", d.whole("city", 1, 20), 2).alias("home_city_id"),
            d.flag("verified", 0.90).alias("is_verified"),
            d.flag("active", 0.85).alias("is_active"),
            d.whole("deliveries", 0, 10_000).cast("int").alias("total_deliveries_completed"),
            half_up(d.normal("rating", 4.1, 0.5), 2).alias("average_rating"),
            half_up(F.lit(0.60) + d.unit("acceptance") * F.lit(0.38), 3).alias("acceptance_rate"),
            d.seconds_after("onboarded", self._start("2015-01-01"), 0, 5 * YEAR).alias("onboarded_at"),
            d.seconds_after("updated", self._start("2020-01-01"), 0, 4 * YEAR).alias("updated_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def orders(self) -> DataFrame:
        """One status draw decides status, reason, partner and all times; one promo draw both promo amounts."""
        rows, d, i = self._rows("orders")
        base = rows.withColumns(
            {
                "status_draw": d.unit("status"),
                "has_promo": d.flag("promo", PROMO_SHARE),
                "subtotal": money(d.whole("subtotal", 50, 2000), 12),
                "promo_rate": half_up(F.lit(0.05) + d.unit("promo_rate") * F.lit(0.25), 4).cast("decimal(6,4)"),
                "ordered_at": d.seconds_after("ordered", self._start("2020-01-01"), 0, 4 * YEAR),
            }
        )
        subtotal, draw, ordered = F.col("subtotal"), F.col("status_draw"), F.col("ordered_at")
        status = status_of(draw)
        completed = status.isin("delivered", "refunded")
        under_way = draw >= 0.82
        fee, platform = delivery_fee(subtotal), F.lit(5).cast("decimal(8,2)")
        promo = money(F.when(F.col("has_promo"), F.round(subtotal * F.col("promo_rate"), 2)).otherwise(F.lit(0)))
        tax = money(F.round(subtotal * F.lit("0.05").cast("decimal(3,2)"), 2))

        def at(name: str, condition: Column, low: int, high: int) -> Column:
            return F.when(condition, d.seconds_after(name, ordered, low, high))

        return base.select(
            code("ORD", i, 13).alias("order_id"),
            code("C", d.whole("customer", 1, self.n["customers"]), 10).alias("customer_id"),
            code("RST", d.whole("restaurant", 1, self.n["restaurants"]), 8).alias("restaurant_id"),
            F.when(under_way, code("DP", d.whole("partner", 1, self.n["partners"]), 9)).alias("delivery_partner_id"),
            code("", d.whole("city", 1, 20), 2).alias("city_id"),
            F.when(F.col("has_promo"), code("PRO", d.whole("promo_id", 1, self.n["promotions"]), 8)).alias("promo_id"),
            subtotal.alias("subtotal_amount"),
            fee.alias("delivery_fee"),
            platform.alias("platform_fee"),
            promo.alias("promo_discount_amount"),
            tax.alias("tax_amount"),
            money(subtotal + fee + platform - promo + tax, 12).alias("total_amount"),
            status.alias("order_status"),
            F.when(status == "cancelled", d.pick("reason", CANCEL_REASONS)).alias("cancellation_reason"),
            d.flag("contactless", 0.30).alias("is_contactless_delivery"),
            "ordered_at",
            at("accepted", under_way, 60, 300).alias("accepted_at"),
            at("prepared", under_way, 900, 2700).alias("prepared_at"),
            at("picked_up", completed, 2100, 3600).alias("picked_up_at"),
            at("delivered", completed, 2700, 5400).alias("delivered_at"),
            at("cancelled", status == "cancelled", 60, 1800).alias("cancelled_at"),
            d.seconds_after("updated", ordered, 2700, DAY).alias("updated_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def _child(self, prefix: str, parent_key: str, width: int, part: Column | None = None, parts: int = 1) -> Column:
        """Key of a child, numbered after its parent; no global numbering and so no sort is needed."""
        number = F.regexp_extract(parent_key, r"(\d+)$", 1).cast("long")
        return code(prefix, number if part is None else (number - 1) * parts + part, width)

    def order_items(self, orders: DataFrame) -> DataFrame:
        lines = multiply_rows(orders.select("order_id", "restaurant_id"), ITEMS_PER_ORDER, "item_num")
        d = Draws(self.seed, "order_items", F.concat_ws("/", "order_id", "item_num"))
        item = d.whole("item", 1, self.n["menu_items"])
        extra = F.when(d.flag("custom", 0.20), d.whole("extra", 10, 100)).otherwise(F.lit(0))
        return lines.select(
            self._child("OI", "order_id", 13, F.col("item_num"), ITEMS_PER_ORDER).alias("order_item_id"),
            "order_id",
            code("MI", item, 10).alias("menu_item_id"),
            "restaurant_id",
            code("Item_", item, 10).alias("item_name"),
            d.pick("course", COURSES).alias("item_category"),
            d.flag("vegetarian", 0.45).alias("is_vegetarian"),
            d.whole("quantity", 1, 5).cast("int").alias("quantity"),
            money(d.whole("price", 50, 800)).alias("unit_price"),
            money(extra, 8).alias("customization_price_delta"),
            self.loaded.alias("created_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def deliveries(self, orders: DataFrame) -> DataFrame:
        d = Draws(self.seed, "deliveries", "order_id")
        ordered = F.col("ordered_at")
        sent = orders.where(F.col("order_status").isin(*DELIVERED_STATES))
        partner = code("DP", d.whole("partner", 1, self.n["partners"]), 9)
        on_the_way = F.col("order_status") == "out_for_delivery"
        return sent.select(
            self._child("DLV", "order_id", 13).alias("delivery_id"),
            "order_id",
            F.coalesce("delivery_partner_id", partner).alias("delivery_partner_id"),
            F.when(on_the_way, F.lit("out_for_delivery")).otherwise(F.lit("delivered")).alias("delivery_status"),
            F.when(d.flag("failed", 0.03), d.pick("failure", DELIVERY_FAILURES)).alias("failure_reason"),
            d.seconds_after("assigned", ordered, 30, 180).alias("assigned_at"),
            d.seconds_after("en_route", ordered, 180, 480).alias("en_route_restaurant_at"),
            d.seconds_after("arrived", ordered, 600, 1800).alias("arrived_restaurant_at"),
            F.coalesce("picked_up_at", d.seconds_after("picked_up", ordered, 1200, 2400)).alias("picked_up_at"),
            F.coalesce("delivered_at", d.seconds_after("delivered", ordered, 2400, 4800)).alias("delivered_at"),
            half_up(F.lit(1.0) + d.unit("distance") * F.lit(24.0), 2).alias("delivery_distance_km"),
            half_up(F.lit(1.5) + d.unit("route") * F.lit(33.5), 2).alias("route_distance_km"),
            d.seconds_after("updated", ordered, 3000, 90_000).alias("updated_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def payments(self, orders: DataFrame) -> DataFrame:
        d = Draws(self.seed, "payments", "order_id")
        status, total = F.col("order_status"), F.col("total_amount")
        outcome = (
            F.when((status == "cancelled") & d.flag("failed", 0.30), F.lit("failed"))
            .when(status.isin("delivered", "refunded") & d.flag("returned", 0.02), F.lit("refunded"))
            .otherwise(F.lit("success"))
        )
        fee_rate = half_up(F.lit(0.005) + d.unit("fee") * F.lit(0.02), 4).cast("decimal(6,4)")
        return orders.select(
            self._child("PAY", "order_id", 13).alias("payment_id"),
            "order_id",
            outcome.alias("payment_status"),
            d.pick("method", PAID_BY).alias("payment_method"),
            total.alias("payment_amount"),
            money(F.round(total * fee_rate, 2), 8).alias("gateway_fee"),
            d.seconds_after("paid", F.col("ordered_at"), 0, 300).alias("paid_at"),
            F.date_add(F.to_date("ordered_at"), d.whole("settled", 1, 3).cast("int")).alias("settlement_date"),
            self.loaded.alias("_loaded_at"),
        )

    def ratings(self, orders: DataFrame) -> DataFrame:
        d = Draws(self.seed, "ratings", "order_id")
        rated = orders.where((F.col("order_status") == "delivered") & d.flag("rated", RATED_SHARE))
        food, delivery = d.whole("food", 1, 5), d.whole("delivery", 1, 5)
        return rated.select(
            self._child("RTG", "order_id", 13).alias("rating_id"),
            "order_id", "customer_id", "restaurant_id", "delivery_partner_id",
            food.cast("int").alias("food_rating"),
            delivery.cast("int").alias("delivery_rating"),
            ((food + delivery) / F.lit(2.0)).alias("overall_rating"),
            d.seconds_after("rated_at", F.col("delivered_at"), 1800, 2 * DAY).alias("rated_at"),
            self.loaded.alias("_airbyte_extracted_at"),
        )

    def reviews(self, ratings: DataFrame) -> DataFrame:
        d = Draws(self.seed, "reviews", "rating_id")
        overall = F.col("overall_rating")
        mood = F.when(overall >= 4.0, "positive").when(overall >= 3.0, "neutral").otherwise("negative")
        return ratings.where(d.flag("reviewed", REVIEWED_SHARE)).select(
            self._child("RVW", "rating_id", 13).alias("review_id"),
            "rating_id",
            d.pick("text", REVIEW_TEXTS).alias("review_text"),
            mood.alias("sentiment_label"),
            d.seconds_after("submitted", F.col("rated_at"), 0, DAY).alias("submitted_at"),
            self.loaded.alias("_airbyte_extracted_at"),
        )

    def redemptions(self, orders: DataFrame) -> DataFrame:
        """Status and failure reason come from one draw, so they always agree."""
        d = Draws(self.seed, "redemptions", "order_id")
        failed = (F.col("order_status") == "cancelled") & d.flag("failed", 0.15)
        return orders.where(F.col("promo_id").isNotNull()).select(
            self._child("RDM", "order_id", 13).alias("redemption_id"),
            "order_id", "promo_id", "customer_id",
            F.col("promo_discount_amount").alias("discount_amount_applied"),
            F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("redemption_status"),
            F.when(failed, F.lit("promo_expired")).alias("failure_reason"),
            F.col("ordered_at").alias("redeemed_at"),
            self.loaded.alias("_fivetran_synced"),
        )

    def support_tickets(self, orders: DataFrame) -> DataFrame:
        d = Draws(self.seed, "tickets", "order_id")
        ordered = F.col("ordered_at")
        return orders.where(d.flag("opened", TICKET_SHARE)).select(
            self._child("TKT", "order_id", 12).alias("ticket_id"),
            "customer_id", "order_id",
            code("AGT", d.whole("agent", 1, 500), 6).alias("assigned_agent_id"),
            d.pick("category", TICKET_CATEGORIES).alias("ticket_category"),
            d.pick("state", TICKET_STATES).alias("ticket_status"),
            d.pick("priority", PRIORITIES).alias("priority"),
            F.when(d.flag("resolved", 0.80), d.pick("resolution", RESOLUTIONS)).alias("resolution_code"),
            F.when(d.flag("scored", 0.75), d.whole("csat", 1, 5)).cast("int").alias("csat_score"),
            ordered.alias("created_at"),
            d.seconds_after("response", ordered, 300, 7200).alias("first_response_at"),
            F.when(d.flag("closed", 0.80), d.seconds_after("closing", ordered, 3600, 2 * DAY)).alias("resolved_at"),
            d.seconds_after("updated", ordered, 3600, 3 * DAY).alias("updated_at"),
            self.loaded.alias("_airbyte_extracted_at"),
        )

    def ticket_comments(self, tickets: DataFrame) -> DataFrame:
        lines = multiply_rows(tickets.select("ticket_id", "created_at"), COMMENTS_PER_TICKET, "cmt_num")
        d = Draws(self.seed, "comments", F.concat_ws("/", "ticket_id", "cmt_num"))
        wait = d.whole("wait", 1800, 7200) * F.col("cmt_num")
        return lines.select(
            self._child("CMT", "ticket_id", 13, F.col("cmt_num"), COMMENTS_PER_TICKET).alias("comment_id"),
            "ticket_id",
            F.when(F.col("cmt_num") == 1, F.lit("customer")).otherwise(F.lit("agent")).alias("commenter_type"),
            d.pick("text", COMMENT_TEXTS).alias("comment_text"),
            (F.col("created_at") + F.make_dt_interval(secs=wait.cast("decimal(18,6)"))).alias("commented_at"),
            self.loaded.alias("_airbyte_extracted_at"),
        )

    # table -> (method, parent table)
    TABLES = {
        "cities": ("cities", None), "areas": ("areas", None), "payment_methods": ("payment_methods", None),
        "promotions": ("promotions", None), "restaurants": ("restaurants", None), "menu_items": ("menu_items", None),
        "customers": ("customers", None), "customer_addresses": ("addresses", None),
        "delivery_partners": ("partners", None), "orders": ("orders", None), "order_items": ("order_items", "orders"),
        "deliveries": ("deliveries", "orders"), "payments": ("payments", "orders"), "ratings": ("ratings", "orders"),
        "reviews": ("reviews", "ratings"), "promo_redemptions": ("redemptions", "orders"),
        "support_tickets": ("support_tickets", "orders"), "ticket_comments": ("ticket_comments", "support_tickets"),
    }

    def table(self, name: str) -> DataFrame:
        """One of the 18 tables; its parents are part of the plan and need not be stored."""
        method, parent = self.TABLES[name]
        make = getattr(self, method)
        return make() if parent is None else make(self.table(parent))
