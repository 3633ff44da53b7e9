"""Data tests. A test returns the rows that break the rule; no rows means it passed."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import as_col, looks_like_email, percent, quotient
from tidemark.operators.joins import orphans
from tidemark.operators.projection import duplicates


class QualityError(ValueError):
    """A rule of severity error was broken."""


# --- rules over single rows ----------------------------------------------------------------
# Each gives the condition under which a row breaks the rule. NULL means "does not break it".


def breaks_not_null(column: str) -> Column:
    return F.col(column).isNull()


def breaks_accepted(column: str, values: Iterable) -> Column:
    return ~F.col(column).isin(*values)


def breaks_between(column: str, low=None, high=None) -> Column:
    """Outside [low, high]; either end may be open."""
    if low is None and high is None:
        raise ValueError("give a lower or an upper limit")
    c = F.col(column)
    if low is None:
        return c > high
    return c < low if high is None else (c < low) | (c > high)


def breaks_order(earlier: str, later: str, allow_equal: bool = True) -> Column:
    a, b = F.col(earlier), F.col(later)
    return a > b if allow_equal else a >= b


def breaks_match(column: str, condition: Column | str) -> Column:
    """The boolean column disagrees with the condition, NULL counted as false."""
    wanted = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(F.col(column), F.lit(False)) != F.coalesce(wanted, F.lit(False))


def breaks_required_when(column: str, condition: Column | str) -> Column:
    scope = F.expr(condition) if isinstance(condition, str) else condition
    return scope & F.col(column).isNull()


def breaks_within(row_condition: str, failure_condition: str) -> Column:
    return F.expr(row_condition) & F.expr(failure_condition)


# --- tests ---------------------------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(breaks_not_null(column))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values; NULLs are left out before the shuffle."""
    return duplicates(df.where(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(breaks_accepted(column, values))


def relationships(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    return orphans(child, fk, parent, key)


def unique_combination(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicates(df, keys)


def repeated_keys(df: DataFrame, key_sets: list[tuple[str, ...]]) -> DataFrame:
    """Keys of several sets that occur more than once, from one scan: (_set, key columns, row_count).

    `_set` is the number of the set in `key_sets`; columns outside of it are NULL. Counts are combined before the one
    shuffle, so a hot value moves as one row for each task. As in `unique`, a set of one column leaves NULL out.
    """
    if len({frozenset(keys) for keys in key_sets}) < len(key_sets):
        raise ValueError("two of the keys have the same columns")
    columns = list(dict.fromkeys(c for keys in key_sets for c in keys))
    counted = df.groupingSets([[F.col(c) for c in keys] for keys in key_sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_grouping"), F.count(F.lit(1)).alias("row_count")
    )
    number, keep = F, F.col("row_count") > 1
    for i, keys in enumerate(key_sets):
        absent = sum(1 << (len(columns) - 1 - at) for at, c in enumerate(columns) if c not in keys)
        number = number.when(F.col("_grouping") == absent, F.lit(i))
        if len(keys) == 1:
            keep = keep & ((F.col("_grouping") != absent) | F.col(keys[0]).isNotNull())
    return counted.where(keep).select(number.alias("_set"), *columns, "row_count")


def values_between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.where(breaks_between(column, low, high))


def date_order(df: DataFrame, earlier: str, later: str, allow_equal: bool = True) -> DataFrame:
    broken = df.where(breaks_order(earlier, later, allow_equal))
    return broken.select(F.col(earlier).alias("earlier_value"), F.col(later).alias("later_value"))


def boolean_matches(df: DataFrame, column: str, condition: Column | str) -> DataFrame:
    return df.where(breaks_match(column, condition))


def rating_in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(breaks_between(column, low, high)).select(column)


def valid_types(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(breaks_accepted(column, values)).select(column)


def required_when(df: DataFrame, column: str, condition: Column | str) -> DataFrame:
    return df.where(breaks_required_when(column, condition))


def failing_within(df: DataFrame, row_condition: str, failure_condition: str) -> DataFrame:
    return df.where(row_condition).where(failure_condition)


def rows_exist(df: DataFrame) -> DataFrame:
    """Every row is a finding; meant for severity warn."""
    return df


# --- runner --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named rule with its options.

    `breaks` is a row condition; `unique` the columns of a key, whose repeated values are the findings; `rows` a
    DataFrame of findings for rules that need another grouping or a join. `warn_if` and `error_if` are limits on the number of findings. With `store`, a path, the findings are
    written there when the checks run.
    """

    name: str
    breaks: Column | None = None
    rows: DataFrame | None = None
    unique: tuple[str, ...] = ()
    severity: str = "error"
    where: str | None = None
    warn_if: int = 1
    error_if: int = 1
    store: str | None = None

    def findings(self, df: DataFrame) -> DataFrame:
        if self.unique:
            found = unique(df, *self.unique) if len(self.unique) == 1 else unique_combination(df, list(self.unique))
        else:
            found = self.rows if self.breaks is None else df.where(self.breaks)
        return found if self.where is None else found.where(self.where)


REPORT_SCHEMA = "check_name string, failures long, status string"


def findings_of(check: Check) -> Column:
    """The number of rows that break a row rule, as an aggregate."""
    scope = F.lit(True) if check.where is None else F.expr(check.where)
    return F.count_if(scope & check.breaks)


def outcome(check: Check, failures: int) -> str:
    """What a number of findings means."""
    if check.severity == "error" and failures >= check.error_if:
        return "error"
    return "warn" if failures >= check.warn_if else "pass"


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, failures, status) for every check.

    All row rules of the table are counted in one pass over it and all its keys in another; other grouped rules bring
    their own.
    """
    def status(check: Check) -> Column:
        n = F.col("failures")
        bad = F.when(n >= check.error_if, F.lit("error")) if check.severity == "error" else F.when(F.lit(False), F.lit(""))
        return bad.when(n >= check.warn_if, F.lit("warn")).otherwise(F.lit("pass"))

    def listed(counted: DataFrame, several: list[Check]) -> DataFrame:
        """A row with a count for each check (n0, n1, ...) as one row for each check."""
        entries = [
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("failures"), F.lit(i).alias("_i"))
            for i, c in enumerate(several)
        ]
        picked = F
        for i, c in enumerate(several):
            picked = picked.when(F.col("_i") == i, status(c))
        return counted.select(F.inline(F.array(*entries))).withColumn("status", picked).drop("_i")

    for check in checks:
        if check.store is not None:
            store_failures(check.findings(df), check.store)
    results = []
    if row_checks := [c for c in checks if c.breaks is not None]:
        counts = [findings_of(c).alias(f"n{i}") for i, c in enumerate(row_checks)]
        results.append(listed(df.agg(*counts), row_checks))
    if keyed := [c for c in checks if c.unique]:
        sets = list(dict.fromkeys(tuple(sorted(set(c.unique))) for c in keyed))
        scope = [F.lit(True) if c.where is None else F.expr(c.where) for c in keyed]
        counts = [
            F.count_if((F.col("_set") == sets.index(tuple(sorted(set(c.unique))))) & scope[i]).alias(f"n{i}") for i, c in enumerate(keyed)
        ]
        results.append(listed(repeated_keys(df, sets).agg(*counts), keyed))
    for check in checks:
        if check.rows is not None:
            results.append(listed(check.findings(df).agg(F.count(F.lit(1)).alias("n0")), [check]))
    if not results:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, results)


def store_failures(findings: DataFrame, path: str) -> None:
    findings.write.mode("overwrite").parquet(path)


def enforce(report: DataFrame) -> None:
    """Raise on errors, warn on warnings. The report has one row per check."""
    judge([tuple(r) for r in report.where(F.col("status") != "pass").select("check_name", "failures", "status").collect()])


def judge(report: list[tuple[str, int, str]]) -> None:
    """`enforce` for rows (check_name, failures, status) that are at hand."""
    errors = [f"{name}: {n}" for name, n, status in report if status == "error"]
    for name, n, status in report:
        if status == "warn":
            warnings.warn(f"{name}: {n} findings", stacklevel=3)
    if errors:
        raise QualityError("; ".join(errors))


# --- score, contract, keys -----------------------------------------------------------------


def quality_score(checks: list[tuple[str, str, int]]) -> Column:
    """0-100 weighted score of (column, kind, weight); an unknown kind earns nothing but still weighs."""
    tests = {
        "not_null": lambda c: F.col(c).isNotNull(),
        "positive": lambda c: F.col(c) > 0,
        "valid_email": looks_like_email,
    }
    total = sum(weight for _, _, weight in checks)
    earned = F.lit(0)
    for column, kind, weight in checks:
        if kind in tests:
            earned = earned + F.when(tests[kind](column), F.lit(weight)).otherwise(F.lit(0))
    return percent(earned, F.lit(total), 1)


def contract_violations(df: DataFrame, contract: StructType) -> list[str]:
    """Differences in names and types; column order does not matter."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in contract}
    found = [f"missing column {n} {t}" for n, t in wanted.items() if n not in actual]
    found += [f"undeclared column {n} {t}" for n, t in actual.items() if n not in wanted]
    found += [
        f"column {n} is {actual[n]}, declared {t}" for n, t in wanted.items() if n in actual and actual[n] != t
    ]
    return found


def enforce_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """The frame in contract order, or an error before anything is written."""
    found = contract_violations(df, contract)
    if found:
        raise QualityError("; ".join(found))
    return df.select(*contract.fieldNames())


def key_checks(
    df: DataFrame,
    primary_key: str | None = None,
    unique_keys: Iterable[str] = (),
    not_null_columns: Iterable[str] = (),
    foreign_keys: Iterable[tuple[str, DataFrame, str]] = (),
) -> list[Check]:
    """Checks behind declared keys; pass them to `run_checks`."""
    checks = [Check(f"not_null {c}", breaks=breaks_not_null(c)) for c in not_null_columns]
    if primary_key:
        checks.append(Check(f"primary_key not_null {primary_key}", breaks=breaks_not_null(primary_key)))
        checks.append(Check(f"primary_key unique {primary_key}", unique=(primary_key,)))
    checks += [Check(f"unique {c}", unique=(c,)) for c in unique_keys]
    checks += [
        Check(f"foreign_key {fk}", rows=relationships(df, fk, parent, key)) for fk, parent, key in foreign_keys
    ]
    return checks


def foreign_key_lists(columns: list[str], parents: list[DataFrame], keys: list[str]) -> list[tuple[str, DataFrame, str]]:
    """Zip three parallel lists; unequal lengths are an error."""
    if not len(columns) == len(parents) == len(keys):
        raise ValueError("foreign key lists differ in length")
    return list(zip(columns, parents, keys))


# --- feed quarantine -----------------------------------------------------------------------

# Fixed values.
MALFORMED, NEGATIVE = "malformed_amount", "negative_amount"
POLICY_MODES = ("safe", "warn", "error")


def parse_amount(raw: Column | str, strict: bool = False, type_name: str = "decimal(12,2)") -> Column:
    """Text to amount; unreadable text is NULL, or an error at run time in strict mode."""
    text = as_col(raw)
    return text.cast(type_name) if strict else text.try_cast(type_name)


def review_reason(amount: Column) -> Column:
    return F.when(amount.isNull(), F.lit(MALFORMED)).when(amount < 0, F.lit(NEGATIVE))


def quarantine(feed: DataFrame, raw: str, amount: str = "payment_amount") -> tuple[DataFrame, DataFrame]:
    """(good rows, rows to review with a reason); together they are the whole feed."""
    parsed = feed.withColumn(amount, parse_amount(raw)).withColumn("review_reason", review_reason(F.col(amount)))
    return parsed.where(F.col("review_reason").isNull()).drop("review_reason"), parsed.where(
        F.col("review_reason").isNotNull()
    )


def feed_quality(feed: DataFrame, raw: str, mode: str = "safe") -> DataFrame:
    """Counts of malformed and negative amounts and the share to review, in one pass."""
    amount = parse_amount(raw)
    counts = feed.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(amount.isNull()).alias("malformed_amount_events"),
        F.count_if(amount < 0).alias("negative_amount_events"),
        F.count_if(amount.isNull() | (amount < 0)).alias("events_requiring_review"),
    )
    rate = quotient(F.col("events_requiring_review"), F.col("total_events"), 4)
    return counts.withColumn("review_rate", rate).withColumn("policy_mode", F.lit(mode.lower()))


def incident_summary(feed: DataFrame, raw: str, status: str = "payment_status") -> DataFrame:
    amount = parse_amount(raw)
    return feed.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(amount.isNull()).alias("malformed_amount_events"),
        F.count_if(amount < 0).alias("negative_amount_events"),
        F.count_if(F.col(status) == "declined").alias("declined_events"),
    )


def apply_policy(summary: DataFrame, mode: str = "safe") -> DataFrame:
    """Pass, warn or raise when events need review; the summary has one row."""
    mode = mode.lower()
    if mode not in POLICY_MODES:
        raise ValueError(f"policy mode must be one of {', '.join(POLICY_MODES)}, not {mode}")
    if mode != "safe":
        count = summary.first().events_requiring_review
        message = f"{count} events have a malformed or negative amount"
        if count and mode == "error":
            raise QualityError(message)
        if count:
            warnings.warn(message, stacklevel=2)
    return summary
