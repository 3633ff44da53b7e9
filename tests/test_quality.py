import datetime as dt
import warnings

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark import publish
from tidemark.operators import projection, quality as q
from tidemark.operators.quality import Check
from tidemark.plans.demos import validated_payments
from tidemark.plans.params import with_defaults
from tidemark.sources.table import Table

FEED = "event_id string, customer_id string, payment_amount_raw string, currency string, payment_status string, event_timestamp timestamp_ntz"


@pytest.fixture
def payments(rows):
    at = dt.datetime(2024, 1, 1)
    return rows(
        FEED,
        ("EVT-1001", "C1", "10.00", "USD", "captured", at), ("EVT-1002", "C2", "20.00", "USD", "declined", at),
        ("EVT-1003", "C3", "NOT_A_NUMBER", "USD", "captured", at), ("EVT-1004", "C4", "-25.00", "USD", "captured", at),
        ("EVT-1005", "C5", "30.00", "USD", "captured", at),
    )


def test_feed_quality_numbers(payments):
    summary = q.feed_quality(payments, "payment_amount_raw").first()
    assert tuple(summary)[:4] == (5, 1, 1, 2) and str(summary[4]) == "0.4000"
    assert q.incident_summary(payments, "payment_amount_raw").first().declined_events == 1


def test_quarantine_splits_the_whole_feed(payments):
    good, review = q.quarantine(payments, "payment_amount_raw")
    assert {r.event_id: r.review_reason for r in review.collect()} == {
        "EVT-1003": "malformed_amount", "EVT-1004": "negative_amount"
    }
    assert sorted(r.event_id for r in good.select("event_id").unionByName(review.select("event_id")).collect()) == [
        f"EVT-100{i}" for i in range(1, 6)
    ]


def test_strict_mode_raises(payments):
    assert validated_payments(payments).count() == 5
    with pytest.raises((PySparkException, Py4JJavaError)):
        validated_payments(payments, strict=True).collect()


def test_policy(payments):
    summary = q.feed_quality(payments, "payment_amount_raw")
    assert q.apply_policy(summary, "safe") is summary
    with pytest.warns(UserWarning):
        q.apply_policy(summary, "WARN")
    with pytest.raises(q.QualityError):
        q.apply_policy(summary, "error")
    with pytest.raises(ValueError):
        q.apply_policy(summary, "loud")


def test_runner_severity_and_limits(rows):
    df = rows("k int, v int", (1, 1), (1, None), (2, -5))
    report = {r.check_name: (r.failures, r.status) for r in q.run_checks(df, [
        Check("v filled", breaks=q.breaks_not_null("v"), severity="warn"),
        Check("v positive", breaks=q.breaks_between("v", low=0)),
        Check("v positive in 1", breaks=q.breaks_between("v", low=0), where="k = 1"),
        Check("k unique", rows=q.unique(df, "k"), error_if=10),
        Check("v small", breaks=q.breaks_between("v", high=0), warn_if=5, error_if=9),
    ]).collect()}
    assert report == {
        "v filled": (1, "warn"), "v positive": (1, "error"), "v positive in 1": (0, "pass"), "k unique": (1, "warn"), "v small": (1, "pass"),
    }


def test_enforce(rows):
    df = rows("v int", (1,), (None,))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        q.enforce(q.run_checks(df, [Check("v", breaks=q.breaks_not_null("v"), severity="warn")]))
    with pytest.raises(q.QualityError, match="v: 1"):
        q.enforce(q.run_checks(df, [Check("v", breaks=q.breaks_not_null("v"))]))


def test_rules(rows):
    df = rows("a int, b int, flag boolean", (1, 2, True), (2, 2, None), (3, 2, False), (None, 2, True))
    assert q.date_order(df, "a", "b").count() == 1
    assert q.date_order(df, "a", "b", allow_equal=False).count() == 2
    assert q.boolean_matches(df, "flag", "a = 1").count() == 1
    assert q.required_when(df, "a", "flag").count() == 1
    assert q.failing_within(df, "flag", "a = 1").count() == 1
    assert q.accepted_values(df, "a", [1, 2]).count() == 1
    with pytest.raises(ValueError):
        q.breaks_between("a")


def test_contract(rows):
    df = rows("a int, b string", (1, "x"))
    good = StructType([StructField("b", StringType()), StructField("a", IntegerType())])
    assert q.enforce_contract(df, good).columns == ["b", "a"]
    bad = StructType([StructField("a", StringType()), StructField("c", StringType())])
    assert len(q.contract_violations(df, bad)) == 3
    with pytest.raises(q.QualityError):
        q.enforce_contract(df, bad)


def test_score_counts_unknown_kinds_as_weight(rows):
    df = rows("email string, n int", ("a@b.co", 5), ("nobody", None)).select(
        q.quality_score([("email", "valid_email", 3), ("n", "positive", 1), ("n", "odd", 4)]).alias("s")
    )
    assert [r.s for r in df.collect()] == [50.0, 0.0]


def test_unequal_foreign_key_lists(rows):
    with pytest.raises(ValueError):
        q.foreign_key_lists(["a", "b"], [rows("a int", (1,))], ["a"])


def test_failed_audit_leaves_the_table_alone(spark, rows, path):
    table = Table(spark, path())
    rule = lambda df: [Check("v", breaks=q.breaks_not_null("v"))]
    publish.write_audit_publish(table, rows("v int", (1,)), rule)
    with pytest.raises(q.QualityError):
        publish.write_audit_publish(table, rows("v int", (None,)), rule)
    assert [r.v for r in table.read().collect()] == [1]


def test_freshness_without_rows_is_an_error(rows):
    rule = publish.Freshness("t", dt.timedelta(hours=1), dt.timedelta(hours=2))
    empty = rows("t timestamp_ntz")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert publish.freshness("x", empty, rule, now).first().status == "error"


def test_run_log_keeps_the_last_state(spark, rows, path):
    log = publish.RunLog(spark, path("log"), "r1")
    target = Table(spark, path())
    log.build("m", rows("v int", (1,), (2,)), target)
    record = log.read().first()
    assert (record.status, record.rows_loaded) == ("success", 2)
    assert log.table.read().count() == 2


def test_base_model_and_columns(rows):
    df = rows("a int, b string", (1, "x"))
    with pytest.raises(ValueError):
        projection.base_model(df, {})
    assert projection.base_model(df, {"(a + 1)": "c", "b": "d"}, casts={"c": "string"}).collect()[0].asDict() == {"c": "2", "d": "x"}
    assert projection.columns_except(df, ["B"]).columns == ["a"]
    with pytest.raises(ValueError):
        projection.columns_except(df, ["nope"])


def test_parameters():
    assert with_defaults({"lookback_days": 30})["lookback_days"] == 30
    with pytest.raises(ValueError):
        with_defaults({"look_back": 1})
    assert projection.feature_flag({"x": "True"}, "x") and not projection.feature_flag({}, "x")


def test_no_checks_give_an_empty_report(rows):
    report = q.run_checks(rows("a int", (1,)), [])
    assert report.columns == ["check_name", "failures", "status"] and report.collect() == []
    q.enforce(report)


def test_row_rules_are_audited_by_the_write_itself(spark, rows, path, monkeypatch):
    table, jobs = Table(spark, path()), spark.sparkContext.statusTracker()
    rules = lambda df: [
        Check("positive", breaks=F.col("v") <= 0, where="k <> 'skip'", warn_if=1, error_if=2),
        Check("there", breaks=q.breaks_not_null("v")),
    ]
    monkeypatch.setattr(publish, "run_checks", lambda *a: pytest.fail("the candidate was read again"))
    schema = "k string, v int"
    spark.sparkContext.setJobGroup("audit", "audit")
    publish.write_audit_publish(table, rows(schema, ("a", 1), ("skip", -1)), rules)
    assert len(jobs.getJobIdsForGroup("audit")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.warns(UserWarning, match="positive"):
        publish.write_audit_publish(table, rows(schema, ("a", 1), ("b", 0)), rules)
    for bad in ([("a", 0), ("b", 0)], [("a", None)]):
        with pytest.raises(q.QualityError):
            publish.write_audit_publish(table, rows(schema, *bad), rules)
    assert table.version() == 2 and table.read().count() == 2
    publish.write_audit_publish(table, rows(schema, ("a", 1)).limit(0), rules)
    assert table.read().count() == 0
    monkeypatch.undo()
    grouped = lambda df: [*rules(df), Check("once", rows=q.unique(df, "k"))]
    with pytest.raises(q.QualityError, match="once"):
        publish.write_audit_publish(table, rows(schema, ("a", 1), ("a", 2)), grouped)


def test_many_keys_are_checked_in_one_scan(spark, rows, path):
    schema = "a int, b string, c int, v int"
    data = [(1, "x", 1, 1), (2, "x", 1, 2), (2, None, 1, 3), (None, None, 2, 4), (None, "y", 2, 5), (3, "y", 2, 6)]
    where = path()
    rows(schema, *data).write.parquet(where)
    df = spark.read.parquet(where)
    checks = [
        Check("a", unique=("a",)), Check("b", unique=("b",)), Check("v", unique=("v",)), Check("a again", unique=("a",), where="a > 2"),
        Check("a and c", unique=("a", "c")), Check("c and a", unique=("c", "a"), severity="warn"), Check("b, c", unique=("b", "c")),
    ]
    report = q.run_checks(df, checks)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    assert {r.check_name: r.failures for r in report.collect()} == {c.name: c.findings(df).count() for c in checks}
    assert {r.check_name: (r.failures, r.status) for r in report.collect()} == {
        "a": (1, "error"), "b": (2, "error"), "v": (0, "pass"), "a again": (0, "pass"), "a and c": (2, "error"), "c and a": (2, "warn"),
        "b, c": (2, "error"),
    }
    found = {(r._set, r.a, r.b, r.row_count) for r in q.repeated_keys(df, [("a",), ("b", "c")]).collect()}
    assert found == {(0, 2, None, 2), (1, None, "x", 2), (1, None, "y", 2)}


def test_key_checks_read_the_table_twice(spark, rows, path):
    where = path()
    rows("k int, a int, b int", (1, 1, 1), (2, 2, 1), (2, 3, None)).write.parquet(where)
    df = spark.read.parquet(where)
    report = q.run_checks(df, q.key_checks(df, "k", ["a", "b"], ["b"]))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert {r.check_name: r.failures for r in report.collect()} == {
        "not_null b": 1, "primary_key not_null k": 0, "primary_key unique k": 1, "unique a": 0, "unique b": 1,
    }


def test_a_key_of_an_empty_table(rows):
    df = rows("k int", (1,)).limit(0)
    assert [tuple(r) for r in q.run_checks(df, [Check("k", unique=("k",))]).collect()] == [("k", 0, "pass")]
