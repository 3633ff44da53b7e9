"""Streams into versioned tables: auto-refreshed aggregates, microbatch loads, event logs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import incremental
from tidemark.functions import surrogate_key
from tidemark.session import cut
from tidemark.sources.table import Table, align

SLOT = "slot"
REFRESH_MODES = ("AUTO", "FULL", "INCREMENTAL")
INITIALIZE = ("ON_CREATE", "ON_SCHEDULE")
LAG = re.compile(r"^\d+ (second|minute|hour|day)s?$")


@dataclass(frozen=True)
class RefreshOptions:
    """How fresh an aggregate is kept. `target_lag` is a span such as '1 minute', or DOWNSTREAM."""

    target_lag: str
    refresh_mode: str = "AUTO"
    initialize: str = "ON_CREATE"

    def __post_init__(self):
        if not self.target_lag or not (self.target_lag == "DOWNSTREAM" or LAG.match(self.target_lag)):
            raise ValueError("target_lag must be a span such as '1 minute', or DOWNSTREAM")
        if self.refresh_mode.upper() not in REFRESH_MODES:
            raise ValueError(f"refresh_mode must be one of {', '.join(REFRESH_MODES)}, not {self.refresh_mode}")
        if self.initialize.upper() not in INITIALIZE:
            raise ValueError(f"initialize must be one of {', '.join(INITIALIZE)}, not {self.initialize}")


@dataclass(frozen=True)
class Part:
    """A measure that is kept in parts: `of` aggregates new rows, `merge` two or more parts, by default by adding."""

    of: Column
    merge: Callable[[Column | str], Column] = F.sum


def event_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    ts: str,
    glob: str = "*.parquet",
    late: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of parquet files. Watermarks need a zoned timestamp, so the event time is cast (UTC).

    Without `late` no row is ever dropped as late. With it, the state of groups is released if one of their keys is
    an event-time window (`event_day`); a date made from the event time carries no watermark.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(folder)
    rows = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    return rows.withWatermark(ts, late) if late else rows


def event_day(ts: str) -> Column:
    """The day of an event as a window, so that a watermark can close it."""
    return F.window(ts, "1 day")


def _write(stream: DataFrame, sink, mode: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(sink)
        .start()
    )


def add_up(
    target: Table, batch: DataFrame, keys: dict[str, Column], parts: dict[str, Part], slots: int, tag: tuple[str, int]
) -> int:
    """Add a batch to an aggregate that is stored in slots by a hash of its keys; only the batch's slots are read and
    rewritten. The tag names the writer and its epoch: an epoch that is committed already changes nothing."""
    if tag[1] <= target.last_tag(tag[0]):
        return target.version()
    base = target.version()
    grouped = batch.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*[p.of.alias(n) for n, p in parts.items()])
    grouped = cut(grouped.withColumn(SLOT, F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")))
    touched = [r[0] for r in grouped.select(SLOT).distinct().collect()]  # as many numbers as slots
    if not base:
        return target.publish(target.stage(grouped), base=base, tag=tag)
    names = {target.partition_name(s) for s in touched} & set(target.partitions(base))
    both = target.read(only=names, version=base).unionByName(align(grouped, target.schema(base)))
    merged = both.groupBy(SLOT, *keys).agg(*[p.merge(n).alias(n) for n, p in parts.items()])
    return target.publish(target.stage(align(merged, target.schema(base))), replaced=names, base=base, tag=tag)


def keep_fresh(
    stream: DataFrame,
    keys: dict[str, Column] | list[str],
    measures: dict[str, Column | Part],
    target: Table,
    options: RefreshOptions,
    checkpoint: str,
    once: bool = False,
    slots: int = 16,
) -> StreamingQuery | None:
    """Maintain `groupBy(keys).agg(measures)` in `target`. A key that is a window is stored as its first day.

    `checkpoint` belongs to the target: a restarted process goes on where the last one stopped.

    INCREMENTAL (and AUTO) adds each batch to what is stored, if all measures are a `Part`: the target is partitioned
    by `slot`, and a trigger reads and rewrites only the slots of its groups; no state is held, and late rows always
    count. With other measures the aggregate is kept as streaming state, and the groups that a batch changed are merged.
    FULL writes the complete result on each trigger. ON_SCHEDULE leaves the first load to a later call. `once` drains
    what is there and stops.
    """
    if options.initialize.upper() == "ON_SCHEDULE" and not once:
        return None
    full = options.refresh_mode.upper() == "FULL"
    trigger = {"availableNow": True} if once or options.target_lag == "DOWNSTREAM" else {"processingTime": options.target_lag}
    named = {k: F.col(k) for k in keys} if isinstance(keys, list) else keys
    parts = {n: m for n, m in measures.items() if isinstance(m, Part)}
    if parts and len(parts) == len(measures) and not full:
        if target.partition_by != SLOT:
            raise ValueError(f"an aggregate that is added up needs a table partitioned by {SLOT}")

        def add(batch: DataFrame, epoch: int) -> None:
            add_up(target, batch, named, parts, slots, (checkpoint, epoch))

        return _write(stream, add, "append", checkpoint, trigger)
    whole = [(m.of if isinstance(m, Part) else m).alias(n) for n, m in measures.items()]
    grouped = stream.groupBy(*[c.alias(k) for k, c in named.items()]).agg(*whole)
    windows = [f.name for f in grouped.schema if f.name in named and isinstance(f.dataType, StructType)]
    grouped = grouped.withColumns({w: F.col(f"{w}.start").cast("date") for w in windows})

    def write(batch: DataFrame, epoch: int) -> None:
        if full:
            target.overwrite(batch)
            return
        # Groups are matched by a hash of their keys, NULL counted as a value.
        incremental.merge(target, batch.withColumn("group_key", surrogate_key(*named)), "group_key")

    return _write(grouped, write, "complete" if full else "update", checkpoint, trigger)


def stream_into(stream: DataFrame, target: Table, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a table. Each epoch commits with its number and the checkpoint's folder, so an epoch that is
    replayed after a restart is skipped."""
    def write(batch: DataFrame, epoch: int) -> None:
        if epoch > target.last_tag(checkpoint):
            target.append(batch, tag=(checkpoint, epoch))

    return _write(stream, write, "append", checkpoint, trigger or {"availableNow": True})
