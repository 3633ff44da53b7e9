"""All modelled tables built from CSV files with text keys, as a user would."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans.warehouse import Warehouse
from tidemark.sources.schemas import LOGICAL, RAW, SAMPLES, csv_feeds, logical_sources

FILES = {
    "raw_customers": [
        "C001,Ann,Lee,Ann.Lee@Mail.com,555,1990-05-01,gold,online,2023-01-05 10:00:00,true",
        "C002,Bo,Kay,bo,,1970-01-01,silver,phone,2024-02-01 00:00:00,false",
    ],
    "raw_employees": ["E001,Al,Roe,ops,Lead,2020-01-01,20.00,,true,Z", "E002,Di,Fox,ops,Crew,2022-01-01,15.50,E001,true,Z"],
    "raw_feedback": ["F1,C001,2024-06-01,R001,5,ride,good,ok,2024-06-02 00:00:00", "F2,C002,2024-06-01,,2,food,bad,no,2024-06-02 00:00:00"],
    "raw_rides": ["R001,Dragon,coaster,100,low,370,A,false,2010-06-25,active,28", "R002,House,dark,0,extreme,500,B,true,2012-01-01,active,10"],
    "raw_sales_transactions": ["S1,C001,2024-06-01,food,Pie,2,5.00,10.00,cash,Hall"],
    "raw_tickets": [
        "T001,C001,day_pass,2024-05-20,2024-06-01,online,60.00,10,50.00,P1",
        "T002,C002,annual_pass,2024-06-01,2024-06-01,kiosk,300.00,0,300.00,",
        "T003,C002,day_pass,2024-06-03,2024-06-04,,60.00,0,60.00,",
    ],
    "raw_haunted_events": ["H1,Fest,2024-10-01,2024-10-31,party,Co,10,5,100.00,x"],
}


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    for name, lines in FILES.items():
        header = ",".join(c.split()[0] for c in RAW[name].replace("(10,2)", "").replace("(12,2)", "").replace("(12,4)", "").split(", "))
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")
    number = F.regexp_extract("ticket_id", r"(\d+)", 1).cast("long")
    sources = logical_sources(spark, csv_feeds(spark, f"file://{folder}"))
    return Warehouse(spark, sources, {"as_of": "2024-06-05", "halloween_analysis_start_date": "2024-01-01"}, number)


@pytest.mark.parametrize("name", Warehouse.names())
def test_every_table_builds(house, name):
    assert getattr(house, name).columns and getattr(house, name).count() >= 0


def test_values(house):
    assert house.stg_tickets.count() == 2  # a ticket without a channel belongs to neither channel
    visit = house.fct_visits.where("ticket_id = 'T001'").first()
    assert (float(visit.total_visit_spend), visit.booking_lead_days, visit.avg_rating) == (60.0, 12, 5.0)
    days = house.agg_daily_revenue
    assert days.agg(F.min("date_day"), F.max("date_day")).first() == (dt.date(2024, 1, 1), dt.date(2024, 6, 5))
    top = days.where("date_day = DATE '2024-06-01'").first()
    assert (float(top.total_revenue), top.unique_visitors, top.revenue_per_visitor) == (360.0, 2, 180.0)
    assert house.stg_haunted_tickets.count() == 3
    assert house.dim_employees.where("employee_id = 'E002'").first().manager_name == "Al Roe"
    ann = house.dim_customers.where("customer_id = 'C001'").first()
    assert (ann.is_valid_email, ann.age, ann.customer_lifecycle_stage, ann.upsell_opportunity) == (True, 34, "Established", "None")


def test_schemas_and_names(spark):
    for ddl in [*RAW.values(), *SAMPLES.values()]:
        assert spark.createDataFrame([], ddl).columns
    assert set(LOGICAL.values()) <= set(RAW)


def test_every_parameter_changes_a_result(house, spark, rows):
    from tidemark.operators.quality import QualityError
    from tidemark.plans.params import DEFAULTS

    def other(**params):
        return Warehouse(spark, type("S", (), {"table": staticmethod(house.source)})(), {**house.params, **params}, house.numeric_ticket)

    assert "is_deep_discount" in other(drift_mode="add_new_column").drifting_sales.columns
    assert "is_deep_discount" not in house.drifting_sales.columns
    assert other(drift_mode="add_new_column").contracted_sales.where("is_deep_discount IS NOT NULL").count() > 0
    assert house.contracted_sales.where("is_deep_discount IS NOT NULL").count() == 0
    assert (house.recent_sales.count(), other(dev_lookback_days=10).recent_sales.count(), other(environment="prod").recent_sales.count()) == (0, 1, 1)
    plans = [w.clustered_visits._jdf.queryExecution().optimizedPlan().toString() for w in (house, other(cluster_columns=["ticket_id"]))]
    assert "RepartitionByExpression [visit_date" in plans[0] and "RepartitionByExpression [ticket_id" in plans[1]
    feed = rows(
        "event_id string, customer_id string, payment_amount_raw string, currency string, payment_status string, event_timestamp string",
        ("1", "c", "10.00", "EUR", "ok", "2024-01-01 00:00:00"), ("2", "c", "oops", "EUR", "ok", "2024-01-01 00:00:00"),
    ).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
    assert house.payments(feed).where("payment_amount IS NULL").count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        other(strict_validation=True).payments(feed).collect()
    assert house.payment_review_queue(feed).count() == 1
    assert house.payment_quality(feed).first().policy_mode == "safe"
    with pytest.raises(QualityError):
        other(exception_mode="error").payment_quality(feed)
    assert set(house.params) == set(DEFAULTS)


def test_histories_of_the_warehouse(house, path):
    folder = path("histories")
    house.take_histories(folder, "2024-06-05 00:00:00")
    house.take_histories(folder, "2024-06-06 00:00:00")
    kept = house.histories(folder)
    assert kept["customers"].read().count() == house.stg_customers.count()
    assert kept["rides"].table.version() == 1
    assert len(kept) == 7 and all(k.read().where("dbt_valid_to IS NOT NULL").isEmpty() for k in kept.values())
    assert kept["ticket_sales_history"].read().count() == house.stg_tickets.count()
    assert kept["product_pricing_history"].read().count() == house.stg_ticket_types.count()


def test_rules_of_the_tables(house):
    from tidemark.operators.quality import QualityError
    from tidemark.plans.rules import MODELS

    for name in MODELS:
        assert house.report(name).where("status = 'error'").count() == 0, name
    assert house.tested("fct_visits").count() == house.fct_visits.count()
    contract = house.fct_visits.schema
    assert house.contracted("fct_visits", contract).schema == contract
    with pytest.raises(ValueError):
        house.contracted("fct_visits", house.stg_tickets.schema)
    broken = Warehouse.__new__(Warehouse)
    broken.__dict__.update(house.__dict__, stg_rides=house.stg_rides.unionByName(house.stg_rides))
    with pytest.raises(QualityError, match="ride_id unique"):
        broken.tested("stg_rides")


def test_findings_are_stored_by_option(rows, spark, path):
    from tidemark.operators import quality as q

    folder = path("findings")
    df = rows("k int, v int", (1, None), (2, 5))
    report = q.run_checks(df, [q.Check("v not null", breaks=q.breaks_not_null("v"), store=folder)])
    assert report.first().failures == 1 and spark.read.parquet(folder).count() == 1
