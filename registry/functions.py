"""Scalar functions and business labels: one projection over a whole table each."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import AS_OF, AS_OF_EVENTS, FEAR_SQL, POINTS_SQL, SCARE_SQL, hu, query, rd, steps, table
from registry.inputs import feed
from registry.models import AGE_LIMITS, DAY_PART, SEASON, key_sql
from tidemark import functions as f
from tidemark.datagen import Draws

KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "events": "event_id", "part": "p_partkey", "supplier": "s_suppkey"}


def projection(key: str, source: str, make, **columns: str) -> None:
    """Register a projection: `make()` gives the Spark columns by name, `columns` their check SQL."""
    row = KEYS[source]
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())

    def run(spark, sf):
        return table(spark, sf, source).select(row, *[c.alias(n) for n, c in make().items()])

    query(key, f"SELECT {row}, {listed} FROM {source}")(run)


def c(name: str):
    return F.col(name)


def day(name: str):
    return F.to_date(name)


D = "CAST(o_orderdate AS DATE)"
RUN = f"DATE '{AS_OF}'"


def run_day():
    return F.lit(AS_OF).cast("date")


# === functions =============================================================================

projection("F01_lower_upper", "customer", lambda: {"low": F.lower("c_name"), "up": F.upper("c_mktsegment")},
           low="lower(c_name)", up="upper(c_mktsegment)")
projection("F02_concat_operator", "customer",
           lambda: {"full_name": F.concat("c_name", F.lit(" "), F.nullif("c_mktsegment", F.lit("BUILDING")))},
           full_name="c_name || ' ' || nullif(c_mktsegment, 'BUILDING')")
projection("F03_concat_ws", "customer",
           lambda: {"strict": f.concat_ws_strict("-", c("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING"))),
                    "plain": F.concat("c_name", F.lit("/"), "c_mktsegment")},
           strict="c_name || '-' || nullif(c_mktsegment, 'BUILDING')", plain="concat(c_name, '/', c_mktsegment)")
projection("F04_left", "customer", lambda: {"head": F.left("c_mktsegment", F.lit(3))}, head="left(c_mktsegment, 3)")
projection("F05_lpad", "orders", lambda: {"padded": F.lpad(c("o_orderkey").cast("string"), 6, "0"),
                                          "cut": F.lpad("o_orderpriority", 3, "x")},
           padded="lpad(CAST(o_orderkey AS VARCHAR), 6, '0')", cut="left(o_orderpriority, 3)")
projection("F06_chr", "customer", lambda: {"letter": F.chr(F.lit(65) + c("c_custkey") % 26)}, letter="chr(CAST(65 + c_custkey % 26 AS INT))")
projection("F07_nullif", "part", lambda: {"size": F.nullif("p_size", F.lit(10))}, size="nullif(p_size, 10)")
projection("F08_coalesce", "part", lambda: {"size": F.coalesce(F.nullif("p_size", F.lit(10)), F.lit(0))},
           size="coalesce(nullif(p_size, 10), 0)")
projection("F09_ilike", "part", lambda: {"hit": c("p_name").ilike("%RING%")}, hit="p_name ILIKE '%RING%'")
projection("F10_regexp_full_match", "customer",
           lambda: {"whole": f.full_match("c_name", r"Customer#0*[0-9]{1,3}"), "part": f.full_match("c_name", r"#0+")},
           whole="regexp_full_match(c_name, 'Customer#0*[0-9]{1,3}')", part="regexp_full_match(c_name, '#0+')")
projection("F11_hash", "customer", lambda: {"m": F.md5("c_name"), "s": F.sha2("c_name", 256)}, m="md5(c_name)", s="sha256(c_name)")
projection("F12_round", "orders",
           lambda: {"exact": F.round(c("o_totalprice").cast("decimal(18,2)"), 1).cast("decimal(18,1)"),
                    "double": f.half_up(c("o_totalprice") / 7.0, 2)},
           exact="CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DECIMAL(18,1))", double=hu("o_totalprice / 7.0::DOUBLE"))
projection("F13_mod", "orders",
           lambda: {"slot": f.round_robin(c("o_orderkey"), F.lit(7)), "signed": -c("o_orderkey") % 7},
           slot="((o_orderkey - 1) % 7 + 7) % 7 + 1", signed="-o_orderkey % 7")
projection("F14_arithmetic", "orders",
           lambda: {"total": (c("o_orderkey") + 3) * 2 - c("o_custkey"), "share": c("o_custkey") / (c("o_orderkey") + 1)},
           total="(o_orderkey + 3) * 2 - o_custkey", share="o_custkey / (o_orderkey + 1)")
projection("F15_casts", "orders",
           lambda: {"t": c("o_orderkey").cast("string"), "d": day("o_orderdate"), "n": c("o_totalprice").cast("decimal(12,1)")},
           t="CAST(o_orderkey AS VARCHAR)", d=D, n="CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(12,1))")
query("F16_to_decimal", "SELECT event_id, CAST(payment_amount_raw AS DECIMAL(12,2)) AS amount FROM payment_feed WHERE event_id % 50 <> 0")(
    lambda s, d: feed(s, d, "payment_feed").where("payment_amount_raw <> 'NOT_A_NUMBER'").select(
        "event_id", c("payment_amount_raw").cast("decimal(12,2)").alias("amount")
    )
)
query("F17_try_to_decimal", "SELECT event_id, TRY_CAST(payment_amount_raw AS DECIMAL(12,2)) AS amount FROM payment_feed")(
    lambda s, d: feed(s, d, "payment_feed").select("event_id", c("payment_amount_raw").try_cast("decimal(12,2)").alias("amount"))
)
projection("F18_run_date", "orders", lambda: {"age": F.datediff(run_day(), day("o_orderdate")).cast("long")}, age=f"{RUN} - {D}")
projection("F19_datediff_day", "orders",
           lambda: {"n": f.days_between(day("o_orderdate"), run_day()).cast("long")}, n=f"datediff('day', {D}, {RUN})")
projection("F20_datediff_month", "orders",
           lambda: {"n": f.months_between_dates(day("o_orderdate"), run_day()).cast("long")}, n=f"datediff('month', {D}, {RUN})")
projection("F21_datediff_year", "orders",
           lambda: {"n": f.years_between(day("o_orderdate"), run_day()).cast("long")}, n=f"datediff('year', {D}, {RUN})")
projection("F22_datediff_second", "events",
           lambda: {"n": f.seconds_between(c("ts"), F.lit(f"{AS_OF_EVENTS} 00:00:00.5").cast("timestamp_ntz"))},
           n=f"datediff('second', ts, TIMESTAMP '{AS_OF_EVENTS} 00:00:00.5')")
projection("F23_dateadd", "orders",
           lambda: {"d": f.add_days(day("o_orderdate"), -90), "m": F.add_months(day("o_orderdate"), 1),
                    "s": f.add_seconds(c("o_orderdate"), (c("o_orderkey") % 100).cast("decimal(18,6)"))},
           d=f"{D} - 90", m=f"CAST({D} + INTERVAL 1 MONTH AS DATE)", s="o_orderdate + to_seconds(o_orderkey % 100)")
projection("F24_date_trunc", "orders",
           lambda: {"w": f.week_start(day("o_orderdate")), "m": f.month_start(day("o_orderdate"))},
           w=f"CAST(date_trunc('week', {D}) AS DATE)", m=f"CAST(date_trunc('month', {D}) AS DATE)")
projection("F25_date_from_parts", "orders",
           lambda: {"d": F.make_date(F.year("o_orderdate"), F.lit(10), F.lit(31))}, d="make_date(year(o_orderdate), 10, 31)")
projection("F26_date_parts", "orders",
           lambda: {"y": F.year("o_orderdate").cast("long"), "m": F.month("o_orderdate").cast("long"),
                    "d": F.day("o_orderdate").cast("long"), "q": F.quarter("o_orderdate").cast("long")},
           y="year(o_orderdate)", m="month(o_orderdate)", d="day(o_orderdate)", q="quarter(o_orderdate)")
projection("F27_day_of_week", "orders",
           lambda: {"n": f.day_of_week_number(c("o_orderdate")).cast("long"), "w": f.is_weekend(c("o_orderdate"))},
           n="dayofweek(o_orderdate)", w="dayofweek(o_orderdate) IN (0, 6)")
projection("F28_names", "orders", lambda: {"d": F.dayname("o_orderdate"), "m": F.monthname("o_orderdate")},
           d="strftime(o_orderdate, '%a')", m="strftime(o_orderdate, '%b')")
projection("F29_convert_timezone", "events",
           lambda: {"utc": f.utc_now(c("ts")), "from_ist": f.utc_now(c("ts"), "Asia/Kolkata")},
           utc="ts", from_ist="ts - INTERVAL '5 hours 30 minutes'")
projection("F30_is_null", "part", lambda: {"missing": F.nullif("p_size", F.lit(10)).isNull()}, missing="nullif(p_size, 10) IS NULL")


def unit_sql(seed: int, name: str, column: str, row: str) -> str:
    """Check SQL of a uniform draw."""
    return f"CAST(CAST('0x' || left(md5('{seed}|{name}|{column}|' || {row}), 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"


def draws() -> Draws:
    return Draws(7, "orders", "o_orderkey")


projection("F31_random", "orders",
           lambda: {"u": draws().unit("u"), "dice": draws().whole("dice", 1, 6), "rare": draws().flag("rare", 0.2)},
           u=unit_sql(7, "orders", "u", "o_orderkey"),
           dice=f"CAST(floor(({unit_sql(7, 'orders', 'dice', 'o_orderkey')}) * 6) AS BIGINT) + 1",
           rare=f"({unit_sql(7, 'orders', 'rare', 'o_orderkey')}) < 0.2::DOUBLE")
projection("F32_parse_json", "events",
           lambda: {"k": F.variant_get(F.parse_json("props"), "$.k", "bigint"), "text": F.get_json_object("props", "$.k")},
           k="CAST(json_extract(props, '$.k') AS BIGINT)", text="json_extract_string(props, '$.k')")
projection("F33_surrogate_key", "orders",
           lambda: {"k": f.surrogate_key("o_orderkey", F.nullif("o_orderstatus", F.lit("P")), c("o_totalprice") > 200000)},
           k=key_sql("o_orderkey", "nullif(o_orderstatus, 'P')", "o_totalprice > 200000"))
projection("F34_plain_key", "orders",
           lambda: {"k": f.plain_key("o_orderkey", F.nullif("o_orderstatus", F.lit("P")), day("o_orderdate"))},
           k=f"md5(o_orderkey || '-' || nullif(o_orderstatus, 'P') || '-' || {D})")


@query("F35_scalar_subquery", "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'view') - INTERVAL 1 DAY")
def scalar_subquery(spark, sf):
    rows = table(spark, sf, "events")
    top = rows.where("event_type = 'view'").agg(F.max("ts").alias("m")).first().m  # one value, a literal for the scan
    return rows.where(c("ts") > F.lit(top).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")).select("event_id", "ts")


# === business labels =======================================================================

PRICE, PRICE_SQL = "o_totalprice", "o_totalprice / 1000"


def price():
    return c("o_totalprice") / 1000


projection("F40_spending_tier", "orders", lambda: {"tier": f.spending_tier(price())},
           tier=steps(PRICE_SQL, [(200, "premium"), (100, "standard"), (40, "budget")], "discount"))
projection("F41_visit_time_of_day", "events",
           lambda: {"slot": f.visit_time_of_day(F.hour("ts")), "unknown": f.visit_time_of_day(F.lit(None).cast("int"))},
           slot=DAY_PART.format(h="hour(ts)"), unknown="'Night'")
projection("F42_discount_category", "orders", lambda: {"band": f.discount_category(c("o_orderkey") % 40)},
           band="CASE WHEN o_orderkey % 40 = 0 THEN 'No Discount' WHEN o_orderkey % 40 < 10 THEN 'Low Discount' "
                "WHEN o_orderkey % 40 < 25 THEN 'Mid Discount' ELSE 'High Discount' END")
projection("F43_business_season", "orders", lambda: {"season": f.business_season("o_orderdate")}, season=SEASON.format(d="o_orderdate"))
projection("F44_days_to_halloween", "orders", lambda: {"n": f.days_to_halloween(day("o_orderdate")).cast("long")},
           n=f"make_date(year(o_orderdate), 10, 31) - {D}")
projection("F45_halloween_bucket", "orders", lambda: {"bucket": f.halloween_bucket(c("o_orderkey") % 200 - 100)},
           bucket="CASE WHEN o_orderkey % 200 < 86 THEN 'Off Season' WHEN o_orderkey % 200 < 100 THEN 'Post Halloween (2 wks)' "
                  "WHEN o_orderkey % 200 = 100 THEN 'Halloween Day' WHEN o_orderkey % 200 <= 107 THEN 'Week of Halloween' "
                  "WHEN o_orderkey % 200 <= 130 THEN 'October Pre-Halloween' WHEN o_orderkey % 200 <= 160 THEN '2 Months Before' "
                  "ELSE 'Far Out' END")
projection("F46_age_group", "customer", lambda: {"band": f.age_group(F.nullif(c("c_custkey") % 80, F.lit(5)))},
           band=steps("nullif(c_custkey % 80, 5)", AGE_LIMITS, "55+", "<"))
projection("F47_loyalty_tier", "customer", lambda: {"tier": f.loyalty_tier("c_acctbal")},
           tier=steps("c_acctbal", [(1000, "Gold"), (500, "Silver")], "Bronze"))


def vip():
    return c("c_custkey") % 3 == 0


projection("F48_customer_value_segment", "customer", lambda: {"segment": f.customer_value_segment(vip(), c("c_acctbal"))},
           segment="CASE WHEN c_acctbal >= 1000 THEN if(c_custkey % 3 = 0, 'High Value', 'Mid Value') "
                   "WHEN c_acctbal >= 500 OR c_custkey % 3 = 0 THEN 'Mid Value' ELSE 'Standard' END")
projection("F49_lifecycle_stage", "customer", lambda: {"stage": f.lifecycle_stage(c("c_custkey") % 20)},
           stage=steps("c_custkey % 20", [(4, "New"), (13, "Growing")], "Established", "<"))
projection("F50_retention_risk", "customer", lambda: {"risk": f.retention_risk(c("c_acctbal"), c("c_custkey") % 20)},
           risk="CASE WHEN c_acctbal >= 300 THEN 'Low' WHEN c_acctbal < 100 AND c_custkey % 20 > 6 THEN 'High' ELSE 'Medium' END")
projection("F51_upsell_opportunity", "customer",
           lambda: {"offer": f.upsell_opportunity(vip(), c("c_acctbal"), c("c_nationkey") % 2 == 0)},
           offer="CASE WHEN c_custkey % 3 = 0 THEN 'None' WHEN c_acctbal >= 400 THEN 'VIP Upgrade' "
                 "WHEN c_nationkey % 2 = 0 THEN 'Premium Pass' ELSE 'None' END")
query("F52_membership", f"""
SELECT customer_id, coalesce(membership_type IN ('platinum', 'gold'), false) AS vip, {SCARE_SQL} AS scare, {POINTS_SQL} AS points
FROM raw_customers
""")(lambda s, d: feed(s, d, "raw_customers").select(
    "customer_id", f.is_vip("membership_type").alias("vip"), f.scare_level("membership_type").alias("scare"),
    f.loyalty_points("membership_type").alias("points"),
))
query("F53_fear_level", f"SELECT ride_id, {FEAR_SQL} AS fear FROM raw_rides")(lambda s, d: feed(s, d, "raw_rides").select("ride_id", f.fear_level("thrill_level").alias("fear")))
query("F54_rating_category", """
SELECT feedback_id, CASE WHEN rating < 3 THEN 'negative' WHEN rating < 4 THEN 'neutral' ELSE 'positive' END AS mood,
  rating > 3 AS recommends FROM raw_feedback
""")(lambda s, d: feed(s, d, "raw_feedback").select(
    "feedback_id", f.rating_category(c("rating")).alias("mood"), f.would_recommend(c("rating")).alias("recommends")
))
projection("F55_review_count_band", "part", lambda: {"band": f.review_count_band(c("p_size") % 8)},
           band=steps("p_size % 8", [(1, "No Reviews"), (2, "Single Review"), (5, "Low Volume")], "Established", "<"))


def stars():
    return (c("p_partkey") % 11) / 2.0


def reviews():
    return c("p_partkey") % 6


STARS, REVIEWS = "(p_partkey % 11) / 2.0", "p_partkey % 6"
projection("F56_rating_tier", "part",
           lambda: {"tier": f.rating_tier(stars()), "fame": f.popularity_segment(reviews()),
                    "wait": f.wait_experience(c("p_size"), stars(), reviews())},
           tier=f"CASE WHEN {STARS} = 0 THEN 'Not Yet Rated' WHEN {STARS} < 2.5 THEN 'Below Average' WHEN {STARS} < 3.5 "
                f"THEN 'Average' WHEN {STARS} < 4.5 THEN 'Well Rated' ELSE 'Top Rated' END",
           fame=steps(REVIEWS, [(3, "Proven Favorite"), (1, "Emerging Interest")], "Needs Awareness"),
           wait=f"CASE WHEN {REVIEWS} = 0 THEN 'No Feedback Yet' WHEN {STARS} >= 4 THEN if(p_size < 25, 'Low', 'High') || "
                f"' Wait / Strong Satisfaction' WHEN {STARS} < 3 AND p_size >= 25 THEN 'High Wait / Low Satisfaction' ELSE 'Monitor' END")
projection("F57_recommended_action", "part",
           lambda: {"action": f.recommended_action(c("p_size"), stars(), reviews()),
                    "priority": f.action_priority(c("p_size"), stars(), reviews())},
           action=f"CASE WHEN {REVIEWS} = 0 THEN 'Collect More Feedback' WHEN p_size >= 25 AND {STARS} < 3 THEN "
                  f"'Improve Guest Experience' WHEN {STARS} < 4 THEN 'Monitor Performance' WHEN {REVIEWS} < 3 THEN "
                  "'Build Awareness' WHEN p_size < 25 THEN 'Promote Ride' ELSE 'Monitor Performance' END",
           priority=f"CASE WHEN {REVIEWS} = 0 THEN 'Medium' WHEN p_size >= 25 AND {STARS} < 3 THEN 'High' "
                    f"WHEN {STARS} >= 4 AND {REVIEWS} < 3 THEN 'Medium' ELSE 'Low' END")
projection("F58_customer_segments", "orders",
           lambda: {"value": f.behavioral_segment(price()), "recency": f.recency_segment(c("o_orderkey") % 500),
                    "risk": f.recency_risk(c("o_orderkey") % 500)},
           value=steps(PRICE_SQL, [(250, "High Value"), (100, "Mid Value")], "Standard"),
           recency=steps("o_orderkey % 500", [(91, "Active"), (366, "Cooling")], "Lapsed", "<"),
           risk=steps("o_orderkey % 500", [(91, "Low"), (366, "Medium")], "High", "<"))
projection("F59_nps_segment", "orders", lambda: {"segment": f.nps_segment(c("o_orderkey") % 101)},
           segment=steps("o_orderkey % 101", [(70, "Promoter"), (50, "Passive")], "Detractor"))
query("F60_ticket_tier", """
SELECT feedback_id, CASE WHEN includes_vip_benefits THEN if(includes_fast_pass, 'VIP + Fast Pass', 'VIP Only')
  WHEN includes_fast_pass THEN 'Fast Pass Only' ELSE 'Standard' END AS tier FROM house_feedback
""")(lambda s, d: feed(s, d, "house_feedback").select(
    "feedback_id", f.ticket_tier(c("includes_vip_benefits"), c("includes_fast_pass")).alias("tier")
))
projection("F61_ltv_segment", "orders", lambda: {"segment": f.ltv_segment(c("o_totalprice") / 800)},
           segment=steps("o_totalprice / 800", [(500, "Platinum"), (200, "Gold"), (50, "Silver")], "Bronze"))
projection("F62_spend_tier", "orders",
           lambda: {"usual": f.spend_tier(price()), "raised": f.spend_tier(price(), 400, 150)},
           usual=steps(PRICE_SQL, [(300, "High"), (100, "Mid")], "Low"), raised=steps(PRICE_SQL, [(400, "High"), (150, "Mid")], "Low"))
query("F63_transaction_tier", f"""
SELECT transaction_id, {steps('total_amount', [(100, 'high'), (40, 'mid')], 'low')} AS tier, total_amount >= 100 AS high,
  CASE WHEN lower(category) LIKE '%food%' OR lower(category) LIKE '%bev%' THEN 'Food & Beverage'
       WHEN lower(category) LIKE '%merch%' THEN 'Merchandise' WHEN lower(category) LIKE '%ticket%' THEN 'Ticket'
       ELSE 'Other' END AS revenue_category FROM ev_pos
""")(lambda s, d: feed(s, d, "ev_pos").select(
    "transaction_id", f.transaction_tier("total_amount").alias("tier"), f.is_high_value("total_amount").alias("high"),
    f.revenue_category("category").alias("revenue_category"),
))
query("F64_discount_percent", """
SELECT ticket_id, CAST(CASE WHEN base_price > 0 THEN round(CAST(discount_amount AS DOUBLE) / base_price * 100, 2) ELSE 0 END
  AS DECIMAL(5,2)) AS pct FROM raw_tickets
""")(lambda s, d: feed(s, d, "raw_tickets").select(
    "ticket_id", f.discount_percent(c("discount_amount"), c("base_price")).alias("pct")
))
query("F65_annual_salary", "SELECT employee_id, CAST(hourly_rate * 2080 AS DECIMAL(14,2)) AS salary FROM raw_employees")(
    lambda s, d: feed(s, d, "raw_employees").select("employee_id", f.estimated_annual_salary(c("hourly_rate")).alias("salary"))
)
projection("F66_value_index", "part", lambda: {"value": f.value_index(stars(), F.lit(1) * (c("p_size") % 10))},
           value=rd(f"{STARS} * 100", "nullif(p_size % 10, 0)", 4))
projection("F67_is_deep_discount", "orders", lambda: {"deep": f.is_deep_discount(F.nullif(c("o_orderkey") % 40, F.lit(3)))},
           deep="o_orderkey % 40 >= 20")
