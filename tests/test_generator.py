import pytest
from pyspark.sql import functions as F

from tidemark.datagen import Generator


@pytest.fixture(scope="module")
def gen(spark):
    return Generator(spark, 2000, seed=3)


def test_rates(gen):
    orders = gen.table("orders")
    shares = {r.order_status: r["count"] / 2000 for r in orders.groupBy("order_status").count().collect()}
    for status, share in (("delivered", 0.72), ("cancelled", 0.10), ("refunded", 0.05), ("out_for_delivery", 0.08)):
        assert abs(shares[status] - share) < 0.04
    assert abs(orders.where("promo_id IS NOT NULL").count() / 2000 - 0.2) < 0.04


def test_money_adds_up(gen):
    off = gen.table("orders").where(
        "total_amount <> subtotal_amount + delivery_fee + platform_fee - promo_discount_amount + tax_amount"
        " OR (promo_id IS NULL AND promo_discount_amount <> 0)"
    )
    assert off.count() == 0


def test_times_follow_status(gen):
    orders = gen.table("orders")
    assert orders.where("(cancelled_at IS NOT NULL) <> (order_status = 'cancelled')").count() == 0
    assert orders.where("(cancellation_reason IS NOT NULL) <> (order_status = 'cancelled')").count() == 0
    assert orders.where("(delivered_at IS NOT NULL) <> (order_status IN ('delivered', 'refunded'))").count() == 0


def test_rows_do_not_depend_on_partitioning(gen, spark):
    one = gen.table("order_items")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    other = Generator(spark, 2000, seed=3).table("order_items")
    assert one.exceptAll(other).count() == 0
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_keys_are_unique_and_sizes_fit(gen):
    sizes = {"orders": 2000, "order_items": 6000, "payments": 2000, "cities": 20, "payment_methods": 10, "customers": 400}
    for name, n in sizes.items():
        df = gen.table(name)
        assert df.count() == n and df.select(df.columns[0]).distinct().count() == n
    tickets = gen.table("support_tickets").count()
    assert gen.table("ticket_comments").count() == 2 * tickets
    assert gen.table("promotions").where(F.col("valid_to") < F.col("valid_from")).count() == 0
