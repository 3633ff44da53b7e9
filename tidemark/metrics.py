"""Metric queries: declare facts, dimensions and metrics once, then ask for any slice."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import full_outer_same, with_totals

# What stands behind a division sign: a name, a number, a call or a bracket without brackets inside.
DIVISOR = re.compile(r"/\s*(\w+(?:\.\d+)?(?:\([^()]*\))?|\([^()]*\))")
GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class SemanticModel:
    """One table with its join keys and the columns it may be grouped by.

    `primary` and `foreign` map an entity name to a key column. `times` lists date columns, the
    first of which is the default time axis.
    """

    name: str
    df: DataFrame
    primary: dict[str, str] = field(default_factory=dict)
    foreign: dict[str, str] = field(default_factory=dict)
    dimensions: tuple[str, ...] = ()
    times: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    """A sum or distinct count over a model, or an expression over other metrics."""

    name: str
    agg: str
    expr: str
    model: str | None = None
    inputs: tuple[str, ...] = ()


class Catalog:
    def __init__(self, models: list[SemanticModel], metrics: list[Metric]):
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}
        for metric in metrics:
            if metric.agg not in ("sum", "count_distinct", "derived"):
                raise ValueError(f"metric {metric.name}: unknown aggregation {metric.agg}")

    def query(
        self, metrics: list[str], group_by: list[str] = (), where: str | None = None, grain: str | None = None
    ) -> DataFrame:
        """One row per group with the requested metrics.

        A group is a dimension name, or `metric_time` for the default time axis of each model
        at `grain`. `where` is a condition over the requested groups and other dimensions of
        the models involved.
        """
        simple = self._simple(metrics)
        by_model: dict[str, list[Metric]] = {}
        for name in simple:
            by_model.setdefault(self.metrics[name].model, []).append(self.metrics[name])
        parts = [self._aggregate(self.models[m], wanted, list(group_by), where, grain) for m, wanted in by_model.items()]

        # Facts meet only after each is aggregated to the requested groups.
        result = parts[0]
        for part in parts[1:]:
            result = full_outer_same(result, part, list(group_by)) if group_by else with_totals(result, part)
        return self._derived(result, metrics).select(*group_by, *metrics)

    def _simple(self, names: list[str]) -> list[str]:
        found: list[str] = []
        for name in names:
            if name not in self.metrics:
                raise KeyError(f"unknown metric {name}; known: {', '.join(sorted(self.metrics))}")
            metric = self.metrics[name]
            for simple in self._simple(list(metric.inputs)) if metric.agg == "derived" else [name]:
                if simple not in found:
                    found.append(simple)
        return found

    def _derived(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """Add derived metrics, inputs first. Inputs enter as doubles, so counts divide exactly; a quotient by zero is NULL."""
        for name in names:
            metric = self.metrics[name]
            if metric.agg != "derived":
                continue
            rows = self._derived(rows, list(metric.inputs))
            doubles = rows.select(*rows.columns, *[F.col(i).cast("double").alias(f"{i}__in") for i in metric.inputs])
            text = metric.expr
            for i in sorted(metric.inputs, key=len, reverse=True):
                text = re.sub(rf"\b{i}\b", f"{i}__in", text)
            rows = doubles.withColumn(name, F.expr(DIVISOR.sub(r"/ nullif(\1, 0)", text))).drop(*[f"{i}__in" for i in metric.inputs])
        return rows

    def _aggregate(
        self, model: SemanticModel, metrics: list[Metric], group_by: list[str], where: str | None, grain: str | None
    ) -> DataFrame:
        if "metric_time" in group_by:
            if grain not in GRAINS:
                raise ValueError(f"grain must be one of {', '.join(GRAINS)}, not {grain}")
            if not model.times:
                raise ValueError(f"{model.name} has no time axis")
        named = [g for g in group_by if g != "metric_time"]
        rows = model.df
        if "metric_time" in group_by:
            rows = rows.withColumn("metric_time", F.date_trunc(grain, F.col(model.times[0])).cast("date"))
        own = set(model.dimensions) | set(model.times)
        used = [d for d in self._dimensions() if d in self._names(where)]
        fetched = [d for d in dict.fromkeys([*named, *used]) if d not in own]
        if not fetched:
            rows = rows.where(where) if where else rows
            return rows.groupBy(*group_by).agg(*[_measure(m).alias(m.name) for m in metrics])
        plan = self._parents(model, fetched)
        kept = [c for c in dict.fromkeys([*group_by, *used]) if c in own or c == "metric_time"]
        keys = list(dict.fromkeys([*kept, *(key for key, _, _, _ in plan)]))

        def rolled_up(reduced: DataFrame, measures: list[Column]) -> DataFrame:
            for key, parent, entity, columns in plan:
                dims = parent.df.select(F.col(parent.primary[entity]).alias("_entity"), *columns)
                reduced = reduced.join(dims, F.col(key) == F.col("_entity"), "left").drop("_entity")
            return (reduced.where(where) if where else reduced).groupBy(*group_by).agg(*measures)

        # A fact is reduced before dimensions meet it: what adds up to one row for each foreign key, a distinct count to
        # one for each foreign key and value. Exact, whatever the type of the values; a bitmap for each key would hold
        # 4 KB even for a single value.
        parts = []
        if adding := [m for m in metrics if _adds_up(m, model)]:
            kinds = dict(rows.agg(*[_measure(m).alias(m.name) for m in adding]).dtypes)
            reduced = rows.groupBy(*keys).agg(*[_measure(m).alias(m.name) for m in adding])
            parts.append(rolled_up(reduced, [F.sum(m.name).cast(kinds[m.name]).alias(m.name) for m in adding]))
        for m in metrics:
            if m not in adding:
                values = rows.select(*keys, F.expr(m.expr).alias("_value")).distinct()
                parts.append(rolled_up(values, [F.count_distinct("_value").alias(m.name)]))
        result = parts[0]
        for part in parts[1:]:
            result = full_outer_same(result, part, group_by) if group_by else with_totals(result, part)
        return result

    def _dimensions(self) -> list[str]:
        return list(dict.fromkeys(d for m in self.models.values() for d in (*m.dimensions, *m.times)))

    def _names(self, where: str | None) -> set[str]:
        """Words of a condition outside of its string literals."""
        return set(re.findall(r"\w+", re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"", " ", where or "")))

    def _parents(self, model: SemanticModel, wanted: list[str]) -> list[tuple[str, SemanticModel, str, list[str]]]:
        """(foreign key, model, entity, dimensions) for the dimensions that the model lacks."""
        plan, left = [], list(wanted)
        for entity, key in model.foreign.items():
            parent = next((m for m in self.models.values() if entity in m.primary), None)
            columns = [d for d in left if parent is not None and d in parent.dimensions]
            if columns:
                plan.append((key, parent, entity, columns))
                left = [d for d in left if d not in columns]
        if left:
            raise KeyError(f"{model.name} can be neither grouped nor filtered by {left}")
        return plan


def _measure(metric: Metric) -> Column:
    value = F.expr(metric.expr)
    return F.count_distinct(value) if metric.agg == "count_distinct" else F.sum(value)


def _adds_up(metric: Metric, model: SemanticModel) -> bool:
    """Parts of the metric add up to the whole: sums, and distinct counts of the model's own key."""
    return metric.agg == "sum" or metric.expr in model.primary.values()
