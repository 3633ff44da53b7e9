"""Registration of queries and assembly of check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
CTES: dict[str, str] = {}

AS_OF = "2002-01-01"  # run day of queries over orders and lineitem
AS_OF_EVENTS = "2024-02-15"  # run day of queries over events


def query(key: str, sql: str | None = None):
    """Register `fn(spark, sf_dir)`; `sql` may use the named sub-queries of this package."""
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            CHECKS[key] = sql
        return fn

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the footers once, not for every query."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def cte(name: str, body: str) -> None:
    CTES[name] = body


def assembled(body: str) -> str:
    """Check SQL with the sub-queries it names put in front, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", text) and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    heads = ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    body = body.strip()
    # A body with its own WITH continues the list.
    return f"WITH {heads},\n{body[4:]}" if body.upper().startswith("WITH ") else f"WITH {heads}\n{body}"


# Membership and thrill level to their numbers, as check SQL.
SCARE_SQL = "CASE membership_type WHEN 'platinum' THEN 3 WHEN 'gold' THEN 2 ELSE 1 END"
POINTS_SQL = "CASE membership_type WHEN 'platinum' THEN 1000 WHEN 'gold' THEN 500 WHEN 'silver' THEN 250 ELSE 100 END"
FEAR_SQL = "CASE thrill_level WHEN 'extreme' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 ELSE 3 END"


# --- SQL building blocks -------------------------------------------------------------------


def hu(expr: str, places: int = 2) -> str:
    """A double rounded half away from zero, by its first twelve decimals."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {places}) AS DECIMAL(28,{places}))"


def rd(top: str, bottom: str, places: int = 2) -> str:
    """top / bottom rounded half away from zero: schoolbook division of 128-bit integers, NULL for a zero divisor."""
    n, d = (f"CAST(CAST({side} AS DECIMAL(24,6)) * 1000000 AS HUGEINT)" for side in (top, bottom))
    whole = f"(abs({n}) * {10**places}) // abs({d})"
    rest = f"(abs({n}) * {10**places}) % abs({d})"
    up = f"{whole} + CASE WHEN {rest} * 2 >= abs({d}) THEN 1 ELSE 0 END"
    signed = f"CASE WHEN {d} = 0 THEN NULL WHEN ({n} < 0) = ({d} < 0) THEN {up} ELSE -({up}) END"
    unit = f"CAST('{1 / 10**places:.{places}f}' AS DECIMAL({places + 1},{places}))"
    return f"CAST(CAST({signed} AS DECIMAL(30,0)) * {unit} AS DECIMAL(28,{places}))"


def avg_of(expr: str, places: int | None = 2) -> str:
    raw = f"CAST(sum({expr}) AS DOUBLE) / count({expr})"
    return f"({raw})" if places is None else rd(f"sum({expr})", f"count({expr})", places)


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,2))"


def steps(expr: str, limits: list[tuple[float, str]], otherwise: str, op: str = ">=") -> str:
    arms = " ".join(f"WHEN {expr} {op} {limit} THEN '{label}'" for limit, label in limits)
    return f"CASE {arms} ELSE '{otherwise}' END"
