"""Column-level operators on whole DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_columns(run_id: str, model: str, environment: str, at: Column | None = None) -> dict[str, Column]:
    """The four lineage columns of a built table."""
    return {
        "dbt_updated_at": F.now().cast("timestamp_ntz") if at is None else at,
        "dbt_run_id": F.lit(run_id),
        "dbt_model_name": F.lit(model),
        "dbt_env": F.lit(environment),
    }


def base_model(
    source: DataFrame,
    column_mapping: dict[str, str],
    where: str | None = None,
    casts: dict[str, str] | None = None,
    extra_expressions: dict[str, str] | None = None,
    audit: dict[str, Column] | None = None,
) -> DataFrame:
    """Rename, cast, filter and derive from a declaration.

    Keys of `column_mapping` are column names, or SQL expressions if they hold a blank, a dot
    or start with a bracket; `extra_expressions` maps expression to name.
    """
    if not column_mapping:
        raise ValueError("base_model needs a non-empty column_mapping")
    casts = casts or {}

    def source_column(text: str) -> Column:
        text = text.strip()
        is_expression = text.startswith("(") or " " in text or "." in text
        return F.expr(text) if is_expression else source[text]

    def built(text: str, target: str) -> Column:
        column = source_column(text)
        return (column.cast(casts[target]) if casts.get(target) else column).alias(target)

    chosen = [built(text, target) for text, target in column_mapping.items()]
    extra = [F.expr(text).alias(target) for text, target in (extra_expressions or {}).items()]
    rows = source if where is None else source.where(where)
    return rows.select(*chosen, *extra, *[c.alias(n) for n, c in (audit or {}).items()])


def columns_except(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """All columns but the listed ones, compared without case; names that do not exist are an error."""
    unwanted = {c.lower() for c in exclude}
    unknown = unwanted - {c.lower() for c in df.columns}
    if unknown:
        raise ValueError(f"columns to exclude do not exist: {sorted(unknown)}")
    kept = [c for c in df.columns if c.lower() not in unwanted]
    if not kept:
        raise ValueError("no column would be left")
    return df.select(*kept)


def null_of(type_name: str) -> Column:
    """A typed NULL, to pad a schema."""
    return F.lit(None).cast(type_name)


def feature_flag(params: dict, name: str, default: bool = False) -> bool:
    """A boolean run parameter; texts such as 'true' or '0' are understood."""
    value = params.get(name, default)
    if isinstance(value, str):
        return value.strip().lower() in {"true", "1", "yes", "y", "t", "on"}
    return bool(value)


def as_of_day(as_of: str | dt.date | None) -> Column:
    """The day a run counts as today."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def look_back(df: DataFrame, column: str, days: int, as_of: str | dt.date | None = None) -> DataFrame:
    """Rows of the last `days` days. The bare column is compared, so the filter reaches the scan."""
    return df.where(F.col(column) >= F.date_sub(as_of_day(as_of), days))


def dev_limit(df: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """At most `limit` rows if a limit is set; give an order to make the choice repeatable."""
    if limit is None:
        return df
    return (df.orderBy(*order) if order else df).limit(limit)


def top_duplicates(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The `k` most repeated keys."""
    return duplicates(df, keys).orderBy(F.desc("row_count"), *keys).limit(k)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def with_overall(df: DataFrame, detail: str, by: list[str], label: str, **measures: Column) -> DataFrame:
    """Measures per (detail, by) plus one row per `by` over all details, in one pass.

    `grouping` tells the total rows from a data value that happens to equal `label`.
    """
    keys = [F.col(detail), *[F.col(c) for c in by]]
    sets = [[F.col(detail), *[F.col(c) for c in by]], [F.col(c) for c in by]]
    aggregated = df.groupingSets(sets, *keys).agg(
        F.grouping(detail).alias("_total"), *[m.alias(n) for n, m in measures.items()]
    )
    named = F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(detail))
    return aggregated.select(named.alias(detail), *by, *measures)
