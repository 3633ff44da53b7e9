"""Slowly changing history: one row per key and period of validity."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.incremental import DuplicateKeys, NullKeys, evolve, require_keys
from tidemark.session import cut
from tidemark.sources.table import Staged, Table, align

SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
STAMP = "timestamp_ntz"


def _stamp(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast(STAMP)


def _opened(source: DataFrame, key: str, stamp: Column) -> DataFrame:
    scd_id = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), stamp.cast("string")))
    return source.withColumns(
        {
            "dbt_scd_id": scd_id,
            "dbt_updated_at": stamp,
            "dbt_valid_from": stamp,
            "dbt_valid_to": F.lit(None).cast(STAMP),
        }
    )


def _fresh(source: DataFrame, key: str, as_of, check_columns: list[str] | None, updated_at: str | None) -> DataFrame:
    """The source as newly opened rows."""
    if (check_columns is None) == (updated_at is None):
        raise ValueError("give either check_columns or updated_at")
    missing = [c for c in [key, *(check_columns or [updated_at])] if c not in source.columns]
    if missing:
        raise ValueError(f"columns not in the source: {missing}")
    return _opened(source, key, _stamp(as_of) if updated_at is None else F.col(updated_at).cast(STAMP))


def snapshot(
    current: DataFrame | None,
    source: DataFrame,
    key: str,
    as_of,
    check_columns: list[str] | None = None,
    updated_at: str | None = None,
    hard_deletes: bool = False,
) -> DataFrame:
    """New state of the open rows after reading `source` at `as_of`: unchanged, closed and opened rows.

    Every row of the source needs a key of its own (`History` checks that).

    Give `check_columns` to compare values, or `updated_at` to compare change stamps (a stamp
    not newer than the stored one is ignored). `current` holds only open rows; closed ones are
    final and need not be read. One full outer join on the key, NULL-safe comparison. A column that one side lacks is
    NULL there.
    """
    now, fresh = _stamp(as_of), _fresh(source, key, as_of, check_columns, updated_at)
    if current is None:
        return fresh
    schema = evolve(current.schema, fresh.schema, "append_new_columns")
    return _compared(align(current, schema), align(fresh, schema), key, now, check_columns, hard_deletes, True)


def _compared(
    current: DataFrame, fresh: DataFrame, key: str, now: Column, check_columns: list[str] | None, hard_deletes: bool, unchanged: bool
) -> DataFrame:
    """Closed and opened rows, with the unchanged ones if asked for."""
    columns = fresh.columns
    both = _paired(current, fresh, key)
    return both.select(F.inline(_outcome(now, check_columns, hard_deletes, unchanged))).select(*columns)


def _paired(current: DataFrame, fresh: DataFrame, key: str, *more: Column) -> DataFrame:
    """Stored and arriving row of each key side by side, with more columns of the arriving one."""
    columns = current.columns
    old = current.select(F.struct(*columns).alias("old"), F.col(key).alias("_old_key"))
    new = fresh.select(F.struct(*columns).alias("new"), F.col(key).alias("_new_key"), *more)
    return old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")


def _outcome(now: Column, check_columns: list[str] | None, hard_deletes: bool, unchanged: bool) -> Column:
    """What becomes of a pair: the rows to store, as an array."""
    if check_columns is not None:
        differs = [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns]
        changed = reduce(lambda a, b: a | b, differs)
    else:
        changed = F.col("new.dbt_updated_at") > F.col("old.dbt_updated_at")
    is_new, is_gone = F.col("old").isNull(), F.col("new").isNull()

    def closed(at: Column) -> Column:
        return F.col("old").withField("dbt_valid_to", at)

    kept = F.array("old") if unchanged else F.slice(F.array("old"), 1, 0)
    return (
        F.when(is_new, F.array("new"))
        .when(is_gone, F.array(closed(now)) if hard_deletes else kept)
        .when(changed, F.array(closed(F.col("new.dbt_valid_from")), F.col("new")))
        .otherwise(kept)
    )


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("dbt_valid_to").isNull())


def scd_columns(history: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns with the validity columns and a flag for the open row."""
    return history.select(*columns, *SCD_COLUMNS, F.col("dbt_valid_to").isNull().alias("is_current_record"))


class _Buckets(Table):
    """Rows in slots that are also hash buckets of the key, so a join on the key reads them without an exchange."""

    def __init__(self, spark, path: str, key: str):
        super().__init__(spark, path, partition_by="slot")
        self.key = key

    def count(self) -> int:
        """Number of buckets, fixed by the first write."""
        return self.last_tag("buckets")

    def slot(self, buckets: int) -> Column:
        """The bucket that Spark gives to a key, counted from 1."""
        return F.pmod(F.hash(self.key), F.lit(buckets)).cast("int") + 1

    def stage_in(self, df: DataFrame, buckets: int) -> Staged:
        self._buckets = buckets
        return self.stage(df)

    def _write(self, df: DataFrame, target: str) -> None:
        # Only tables of the catalog can have buckets. The name goes, the files stay.
        name = f"tidemark_{uuid.uuid4().hex}"
        df.write.partitionBy(self.partition_by).bucketBy(self._buckets, self.key).option("path", target).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    @contextmanager
    def bucketed(self, names: list[str], version: int) -> Iterator[DataFrame]:
        """Chosen slots as a table of the catalog that knows their buckets, for as long as the block runs."""
        info, name = self.commit_info(version), f"tidemark_{uuid.uuid4().hex}"
        schema = StructType.fromJson(info["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (slot) "
            f"CLUSTERED BY (`{self.key}`) INTO {self.count()} BUCKETS LOCATION '{self.path}/data'"
        )
        try:
            places = [f"PARTITION ({n}) LOCATION '{self.path}/data/{d}'" for n in names for d in info["parts"][n]]
            for at in range(0, len(places), 500):
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(places[at : at + 500])}")
            yield self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")


class History:
    """A stored history. Closed rows lie in slot 0 and are never rewritten. Open rows lie in slots that are hash buckets
    of their key: a run compares them with the source without moving them, and rewrites only slots with a changed key.

    `slots` is fixed by the first run; by default it follows from the rows, one for each million. A column that the
    source gains is NULL in older rows, one that it loses is NULL in newer ones; types stay those first stored.
    """

    CLOSED = 0
    ROWS_IN_SLOT = 1_000_000

    def __init__(self, spark, path: str, key: str, slots: int | None = None, **rule):
        self.table = _Buckets(spark, path, key)
        self.key, self.slots, self.rule = key, slots, rule

    def _placed(self, rows: DataFrame, buckets: int) -> DataFrame:
        own = self.table.slot(buckets)
        return rows.withColumn("slot", F.when(F.col("dbt_valid_to").isNull(), own).otherwise(self.CLOSED))

    def _open_slots(self, version: int | None = None) -> list[str]:
        return [n for n in self.table.partitions(version) if n != self.table.partition_name(self.CLOSED)]

    def take(self, source: DataFrame, as_of) -> int:
        """Bring the history up to `source`. A key twice, or a row without one, is an error; so is a run that another
        run has overtaken, as it would undo what that one wrote."""
        base = self.table.version()
        fresh = _fresh(source, self.key, as_of, self.rule.get("check_columns"), self.rule.get("updated_at"))
        if not base:
            fresh = cut(fresh)  # read by the test of the keys and by the writer
            rows = require_keys(fresh, self.key)
            buckets = self.slots or max(1, -(-rows // self.ROWS_IN_SLOT))
            return self.table.publish(self.table.stage_in(self._placed(fresh, buckets), buckets), base=base, tag=("buckets", buckets))
        buckets = self.table.count()
        stored_schema = StructType([f for f in self.table.schema(base) if f.name != "slot"])
        schema = evolve(stored_schema, fresh.schema, "append_new_columns")
        with self.table.bucketed(self._open_slots(base), base) as stored:
            seen = Observation()
            changes = self._changes(stored.drop("slot"), align(fresh, schema), schema, _stamp(as_of), buckets)
            changes = cut(changes.observe(
                seen, F.collect_set(self.table.slot(buckets)).alias("slots"), F.count_if(F.col(self.key).isNull()).alias("nulls"),
                F.max(F.when(F.col("_times") > 1, F.col(self.key))).alias("double"),
            ))
            found = seen.get  # as many numbers as slots
            if found["nulls"]:
                raise NullKeys(f"rows without {self.key}")
            if found["double"] is not None:
                raise DuplicateKeys(f"{self.key} occurs more than once, e.g. {found['double']}")
            if not found["slots"]:
                return base if schema == stored_schema else self.table.set_schema(StructType([*schema.fields, self.table.schema(base)["slot"]]))
            names = {s: self.table.partition_name(s) for s in found["slots"]}
            present = set(names.values()) & set(self.table.partitions(base))
            changes = changes.drop("_times")
            old = align(stored.where(F.col("slot").isin([s for s in names if names[s] in present])).drop("slot"), schema)
            kept = old.join(changes.select(self.key).distinct(), self.key, "left_anti").select(*schema.names)
            rows = self._placed(kept.unionByName(changes), buckets)
            return self.table.publish(self.table.stage_in(rows, buckets), replaced=present, base=base)

    def _changes(self, stored: DataFrame, fresh: DataFrame, schema: StructType, now: Column, buckets: int) -> DataFrame:
        """Closed and opened rows, and all rows of the source whose key is not theirs alone. The source is dealt into
        the buckets once; that serves the count of its keys as well as the join."""
        times = F.count(F.lit(1)).over(Window.partitionBy(self.key))
        dealt = fresh.repartition(buckets, F.col(self.key)).withColumn("_times", times)
        both = _paired(align(stored, schema), dealt.select(*schema.names, "_times"), self.key, F.col("_times"))
        rows = _outcome(now, self.rule.get("check_columns"), self.rule.get("hard_deletes", False), False)
        wrong = F.col("new").isNotNull() & (F.col("_new_key").isNull() | (F.col("_times") > 1))
        return both.select("_times", F.inline(F.when(wrong, F.array("new")).otherwise(rows))).select(*schema.names, "_times")

    def read(self) -> DataFrame:
        return self.table.read().drop("slot")

    def current(self) -> DataFrame:
        """Open rows; only their partitions are read."""
        return self.table.read(only=self._open_slots()).drop("slot")
