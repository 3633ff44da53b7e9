"""Publishing: write-audit-publish, freshness, and the run log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import seconds_between
from tidemark.operators.quality import Check, enforce, findings_of, judge, outcome, run_checks
from tidemark.sources.table import Table


def write_audit_publish(table: Table, df: DataFrame, checks: Callable[[DataFrame], list[Check]]) -> int:
    """Write a candidate, test what was written, and only then make it visible. A refused candidate is deleted.

    Findings of row rules are counted by the write itself; only rules that group or join, or store their findings,
    read the candidate again. The former version stays available to `Table.restore`.
    """
    base = table.version()
    by_row = {i: c for i, c in enumerate(checks(df)) if c.breaks is not None and c.store is None}
    seen = Observation()
    counted = [findings_of(c).alias(f"n{i}") for i, c in by_row.items()]
    staged = table.stage(df.observe(seen, *counted) if counted else df)
    try:
        report = []
        if counted:
            counts = seen.get
            report = [(c.name, n, outcome(c, n)) for i, c in by_row.items() for n in [counts.get(f"n{i}", 0)]]
        candidate = staged.read()
        rest = [c for i, c in enumerate(checks(candidate)) if i not in by_row]
        judge(report)
        if rest:
            enforce(run_checks(candidate, rest))
    except Exception:
        staged.discard()
        raise
    return table.publish(staged, base=base)


# --- freshness -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Freshness:
    """Limits on the age of a source's newest row; None for a source that is not measured."""

    loaded_at: str
    warn_after: dt.timedelta | None = None
    error_after: dt.timedelta | None = None
    where: str | None = None


def freshness(name: str, df: DataFrame, rule: Freshness | None, as_of: Column) -> DataFrame:
    """(source, max_loaded_at, age_seconds, status) as one row."""
    if rule is None:
        return df.sparkSession.range(1).select(
            F.lit(name).alias("source"),
            F.lit(None).cast("timestamp_ntz").alias("max_loaded_at"),
            F.lit(None).cast("long").alias("age_seconds"),
            F.lit("disabled").alias("status"),
        )
    rows = df if rule.where is None else df.where(rule.where)
    newest = rows.agg(F.max(F.col(rule.loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    aged = newest.withColumn("age_seconds", seconds_between(F.col("max_loaded_at"), as_of))

    def older_than(limit: dt.timedelta | None) -> Column:
        # A source without rows is older than any limit.
        return F.lit(False) if limit is None else F.coalesce(
            F.col("age_seconds") > int(limit.total_seconds()), F.lit(True)
        )

    status = F.when(older_than(rule.error_after), "error").when(older_than(rule.warn_after), "warn").otherwise("pass")
    return aged.select(F.lit(name).alias("source"), "max_loaded_at", "age_seconds", status.alias("status"))


# --- run log -------------------------------------------------------------------------------

LOG_SCHEMA = (
    "run_id string, model_name string, target_schema string, target_env string, "
    "logged_at timestamp_ntz, status string, rows_loaded long"
)


class RunLog:
    """Append-only log of builds: one record at the start, one at the end."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, schema: str = "main", environment: str = "dev"):
        self.spark, self.table = spark, Table(spark, path)
        self.run_id, self.schema, self.environment = run_id, schema, environment

    def _write(self, model: str, status: str, rows: int | None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        record = (self.run_id, model, self.schema, self.environment, now, status, rows)
        self.table.append(self.spark.createDataFrame([record], LOG_SCHEMA))

    def build(self, model: str, df: DataFrame, target: Table) -> int:
        """Build a table between a start and an end record; rows are counted by the write itself."""
        self._write(model, "running", None)
        seen = Observation()
        version = target.overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        self._write(model, "success", seen.get["rows"])
        return version

    def read(self) -> DataFrame:
        """One row per (run, model) with its latest state."""
        started = F.min("logged_at")
        last = F.max_by(F.struct("status", "rows_loaded", "logged_at"), "logged_at")
        runs = self.table.read().groupBy("run_id", "model_name", "target_schema", "target_env").agg(
            started.alias("started_at"), last.alias("_last")
        )
        done = F.when(F.col("_last.status") != "running", F.col("_last.logged_at"))
        return runs.select(
            "run_id", "model_name", "target_schema", "target_env", "started_at",
            done.alias("completed_at"),
            F.col("_last.status").alias("status"),
            F.col("_last.rows_loaded").alias("rows_loaded"),
            seconds_between(F.col("started_at"), done).cast("double").alias("elapsed_seconds"),
        )
