"""Incremental loads into versioned tables: merge, append, delete and insert, overwrite, microbatch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, StructType, TimestampNTZType

from tidemark.operators.projection import as_of_day
from tidemark.session import cut
from tidemark.sources.readers import event_window
from tidemark.sources.table import Table, align

# Types whose text gives the value back, so that bounds can become literals.
BOUNDED_TYPES = (NumericType, StringType, DateType, TimestampNTZType)
SCHEMA_POLICIES = ("fail", "append_new_columns", "sync_all_columns")


class DuplicateKeys(ValueError):
    """A batch holds a key twice, so the row to keep is undefined."""


class NullKeys(ValueError):
    """A batch holds rows without a key; they would match nothing and be added by every run."""


class OutsideWindow(ValueError):
    """A batch holds keys whose stored row lies outside the merge window."""


# --- choosing the rows to load -------------------------------------------------------------


def high_water_mark(table: Table, column: str, default=None) -> str | None:
    """Largest stored value as Spark's text: one row to the driver, so the filter becomes a literal that scans can use.

    Text goes out and comes back in the session's time zone; that of the driver's machine plays no part.
    """
    top = table.read().agg(F.max(column).cast("string")).first()[0] if table.exists() else None
    return default if top is None else top


def newer_rows(source: DataFrame, table: Table, column: str, default=None, inclusive: bool = False) -> DataFrame:
    """Rows past the target's maximum. Strict by default, so later rows that share the boundary
    value are lost; `inclusive` re-reads the boundary and is safe for keyed loads."""
    mark = high_water_mark(table, column, default)
    if mark is None:
        return source
    kind = table.schema()[column].dataType if table.exists() else source.schema[column].dataType
    limit = F.lit(str(mark)).cast(kind).cast(source.schema[column].dataType)
    return source.where(F.col(column) >= limit if inclusive else F.col(column) > limit)


def incremental_filter(
    source: DataFrame, table: Table, column: str, environment: str = "prod", days: int = 3, as_of=None
) -> DataFrame:
    """First run: everything. Development: the last few days. Otherwise: past the target's maximum."""
    if not table.exists():
        return source
    if environment == "dev":
        return source.where(F.col(column) >= F.date_sub(as_of_day(as_of), days))
    return newer_rows(source, table, column)


def look_back_rows(source: DataFrame, table: Table, column: str, days: int = 3, as_of=None) -> DataFrame:
    """Rows from `days` before the target's maximum on; late corrections are taken in again."""
    if not table.exists():
        return source
    mark = high_water_mark(table, column)
    start = as_of_day(as_of) if mark is None else F.lit(mark).cast("timestamp_ntz").cast("date")
    return source.where(F.col(column) >= F.date_sub(start, days))


def month_window(source: DataFrame, column: str, as_of=None, months_back: int = 1) -> DataFrame:
    """The current month and the months before it that are still open to corrections."""
    return source.where(F.col(column) >= F.trunc(F.add_months(as_of_day(as_of), -months_back), "month"))


# --- schema drift --------------------------------------------------------------------------


def evolve(current: StructType, incoming: StructType, policy: str) -> StructType:
    """The target schema after a batch arrives. A column keeps the type it was first stored with."""
    if policy not in SCHEMA_POLICIES:
        raise ValueError(f"schema policy must be one of {', '.join(SCHEMA_POLICIES)}, not {policy}")
    if policy == "sync_all_columns":
        known = {f.name: f for f in current}
        return StructType([known.get(f.name, f) for f in incoming])
    new = [f for f in incoming if f.name not in current.fieldNames()]
    if new and policy == "fail":
        raise ValueError(f"new columns in the batch: {[f.name for f in new]}")
    return StructType(current.fields + new)


def _evolved(table: Table, batch: DataFrame, policy: str) -> StructType:
    current = table.schema()
    wanted = evolve(current, batch.schema, policy)
    if table.partition_by and table.partition_by not in wanted.fieldNames():
        raise ValueError(f"the partition column {table.partition_by} cannot be dropped")
    return wanted


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    return align(df.select(*[c for c in df.columns if c in schema.fieldNames()]), schema)


# --- strategies ----------------------------------------------------------------------------


def require_keys(batch: DataFrame, key: str) -> int:
    """Number of rows of a batch, if each has a key of its own; one job."""
    counts = batch.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    double = F.when(F.col("key").isNotNull() & (F.col("n") > 1), F.col("key"))
    found = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min(double).alias("double"), F.count_if(F.col("key").isNull()).alias("nulls")
    ).first()
    if found["nulls"]:
        raise NullKeys(f"rows without {key}")
    if found["double"] is not None:
        raise DuplicateKeys(f"{key} occurs more than once, e.g. {found['double']}")
    return found["n"]


def latest_per_key(batch: DataFrame, key: str, stamp: str) -> DataFrame:
    """One row per key, the one with the latest stamp; `max_by` combines before the shuffle."""
    rest = [c for c in batch.columns if c != key]
    picked = batch.groupBy(key).agg(F.max_by(F.struct(*rest), stamp).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def between_keys(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows from the smallest to the largest key of the batch.

    The two bounds are literals, so a scan skips files and row groups whose keys all lie outside; a feed with rising
    keys reads the newest files alone. Keys of another type than the stored ones are compared by the join only.
    """
    kind = batch.schema[key].dataType
    if stored.schema[key].dataType != kind or not isinstance(kind, BOUNDED_TYPES):
        return stored
    low, high = batch.agg(F.min(key).cast("string"), F.max(key).cast("string")).first()
    return stored.where(F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def touched_partitions(table: Table, names: list[str], batch: DataFrame, key: str) -> list[str]:
    """Those of the named partitions that hold a key of the batch; all of them if the table is not partitioned."""
    if table.partition_by is None:
        return names
    stored = between_keys(table.read(only=names), batch, key)
    hit = stored.select(*{table.partition_by, key}).join(batch.select(key), key, "left_semi")
    # At most one value per partition of the table, as the text that names it.
    values = [r[0] for r in hit.select(F.col(table.partition_by).cast("string")).distinct().collect()]
    touched = [table.partition_name(v) for v in values]
    if unknown := set(touched) - set(names):
        raise ValueError(f"no directory for the partitions {sorted(unknown)}")
    return touched


def merge(
    table: Table,
    batch: DataFrame,
    key: str,
    update_columns: Iterable[str] | None = None,
    since: object = None,
    outside: str = "raise",
    on_schema_change: str = "fail",
) -> int:
    """Upsert by key. Stored rows are never deleted.

    `update_columns` limits what a match changes (all columns if None). `since` limits the
    search for matches to partitions from that value on; keys stored in older partitions raise,
    or with outside="insert" come in as second rows. Partitions without a match are not rewritten.
    """
    if not table.exists():
        require_keys(batch, key)
        return table.overwrite(batch)
    schema = _evolved(table, batch, on_schema_change)
    base = table.version()
    names = table.partitions()
    inside = names if since is None else table.partitions_from(since)
    batch = cut(batch)  # read several times below, so fix its rows once
    if not require_keys(batch, key) and schema == table.schema():
        return base
    keys = batch.select(key)

    if outside == "raise" and len(inside) < len(names):
        outer = between_keys(table.read(only=set(names) - set(inside)), batch, key)
        older = outer.select(key).join(keys, key, "left_semi").head(3)
        if older:
            raise OutsideWindow(f"keys stored before {since}, e.g. {[r[0] for r in older]}")

    touched = names if table.partition_by is None else touched_partitions(table, inside, batch, key)
    stored = _conform(table.read(only=touched), schema)
    incoming = _conform(batch, schema)
    if update_columns is None:
        rows = stored.join(keys, key, "left_anti").unionByName(incoming)
    else:
        rows = _update_listed(stored, incoming, key, set(update_columns), batch.columns)
    return table.publish(table.stage(rows), replaced=touched, base=base)


def _update_listed(
    stored: DataFrame, incoming: DataFrame, key: str, update: set[str], sent: list[str]
) -> DataFrame:
    new = incoming.select(*[F.col(c).alias(f"_new_{c}") for c in incoming.columns])
    joined = stored.withColumn("_stored", F.lit(True)).join(new, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    arrived = F.col(f"_new_{key}").isNotNull()

    def value(c: str) -> Column:
        if c in update and c in sent:
            return F.when(arrived, F.col(f"_new_{c}")).otherwise(F.col(c))
        return F.when(F.col("_stored").isNull(), F.col(f"_new_{c}")).otherwise(F.col(c))

    return joined.select(*[value(c).alias(c) for c in stored.columns])


def append(table: Table, batch: DataFrame, on_schema_change: str = "append_new_columns", full_refresh: bool = False) -> int:
    """Insert only. A ledger must not be rebuilt, so a full refresh is refused."""
    if full_refresh:
        raise ValueError("an append-only table does not allow a full refresh")
    if not table.exists():
        return table.overwrite(batch)
    schema = _evolved(table, batch, on_schema_change)
    return table.publish(table.stage(_conform(batch, schema)), replaced=())


def delete_insert(table: Table, batch: DataFrame, key: str, on_schema_change: str = "sync_all_columns") -> int:
    """Delete every stored row whose key value occurs in the batch, then insert the batch.

    Only partitions that hold such a row are rewritten.
    """
    if not table.exists():
        return table.overwrite(batch)
    schema = _evolved(table, batch, on_schema_change)
    rows = _conform(batch, schema)
    if table.partition_by == key:
        return table.replace_partitions(rows)
    base = table.version()
    batch = cut(rows)
    touched = touched_partitions(table, table.partitions(), batch, key)
    kept = _conform(table.read(only=touched), schema).join(batch.select(key).distinct(), key, "left_anti")
    return table.publish(table.stage(kept.unionByName(batch)), replaced=touched, base=base)


def insert_overwrite(
    table: Table, batch: DataFrame, mode: str = "partitions", on_schema_change: str = "sync_all_columns"
) -> int:
    """Replace the whole table (mode "table") or only the partitions of the batch (mode "partitions")."""
    if mode not in ("table", "partitions"):
        raise ValueError(f"mode must be table or partitions, not {mode}")
    if mode == "table" or not table.exists():
        return table.overwrite(batch)
    if table.partition_by is None:
        raise ValueError("mode partitions needs a partitioned table")
    return table.replace_partitions(_conform(batch, _evolved(table, batch, on_schema_change)))


# --- microbatch ----------------------------------------------------------------------------


def batch_windows(begin: dt.datetime, end: dt.datetime, size: str = "day") -> Iterator[tuple[dt.datetime, dt.datetime]]:
    """Half-open windows [start, stop) that cover begin to end."""
    def step(t: dt.datetime) -> dt.datetime:
        if size in ("hour", "day"):
            return t + dt.timedelta(**{f"{size}s": 1})
        month = 0 if size == "year" else t.month % 12
        return t.replace(year=t.year + (1 if month == 0 else 0), month=month + 1)

    start = floor_of(begin, size)
    while start < end:
        stop = step(start)
        yield start, stop
        start = stop


def load_window(
    table: Table, source: DataFrame, ts: str, start: dt.datetime, stop: dt.datetime, on_schema_change: str = "sync_all_columns"
) -> int:
    """Replace what the table holds of [start, stop) by what the source holds now; safe to repeat.

    The table is partitioned by day. Whole days are replaced as they are; of a day that the window cuts, the stored
    rows outside of it are written again. Consecutive windows may share one call: a backfill of many days is one
    Spark job. Columns that the source gained, lost or changed in type go by the policy, whatever the window.
    """
    rows = event_window(source, ts, start, stop)
    if not table.exists():
        return table.overwrite(rows)
    base, first = table.version(), start.date()
    last = (stop - dt.timedelta(microseconds=1)).date()
    days = [table.partition_name(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)]
    schema = _evolved(table, rows, on_schema_change)
    rows = _conform(rows, schema)
    if start.time() == dt.time() and stop.time() == dt.time():
        return table.publish(table.stage(rows), replaced=days, base=base)
    stored = _conform(table.read(only=set(days) & set(table.partitions())), schema)
    low, high = (F.lit(str(t)).cast(stored.schema[ts].dataType) for t in (start, stop))
    outside = stored.where((F.col(ts) < low) | (F.col(ts) >= high))
    return table.publish(table.stage(outside.unionByName(rows)), replaced=days, base=base)


def floor_of(moment: dt.datetime, size: str) -> dt.datetime:
    """Start of the batch that holds a moment."""
    if size not in ("hour", "day", "month", "year"):
        raise ValueError(f"unknown batch size {size}")
    start = moment.replace(minute=0, second=0, microsecond=0)
    if size != "hour":
        start = start.replace(hour=0)
    if size in ("month", "year"):
        start = start.replace(day=1)
    return start.replace(month=1) if size == "year" else start


def batches_before(start: dt.datetime, n: int, size: str) -> dt.datetime:
    """Start of the n-th batch before the one that begins at `start`."""
    if size in ("hour", "day"):
        return start - dt.timedelta(**{f"{size}s": n})
    months = start.year * 12 + start.month - 1 - n * (12 if size == "year" else 1)
    return start.replace(year=months // 12, month=months % 12 + 1)


def microbatch(
    table: Table, source: DataFrame, ts: str, begin: dt.datetime, end: dt.datetime, look_back: int = 0, size: str = "day",
    on_schema_change: str = "sync_all_columns",
) -> list[tuple[dt.datetime, dt.datetime]]:
    """Load every window from `begin`, or from `look_back` batches before the last one that has rows.

    The first load takes all windows in one job. Later ones commit window by window, so a
    failed window can be repeated alone with `load_window`. An empty range loads nothing.
    """
    mark = high_water_mark(table, ts)
    if mark is None:
        windows = list(batch_windows(begin, end, size))
        if windows:
            load_window(table, source, ts, windows[0][0], windows[-1][1], on_schema_change)
        return windows
    reached = floor_of(dt.datetime.fromisoformat(mark), size)
    windows = list(batch_windows(max(begin, batches_before(reached, look_back, size)), end, size))
    for lo, hi in windows:
        load_window(table, source, ts, lo, hi, on_schema_change)
    return windows


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of same-shaped frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
