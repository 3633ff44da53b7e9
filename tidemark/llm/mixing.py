"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted the same number of times, as a rule not a whole number. Its whole part is
taken as it is; the fractions are rounded in pairs: mass, counted in words, moves at random from one document to the
other until the fraction of one is 0 or 1, so each keeps its expectation and the words of both never change. Long
documents come first, so what is undecided at the end is short. Blocks of documents are rounded side by side; what
each leaves undecided, one fraction at most, goes up a tree of blocks to the root of its source.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repeats import written_out
from tidemark.llm.shipping import shipped
from tidemark.llm.storage import stored
from tidemark.operators.ranks import number_rows

shipped(__name__)

WORD = r"[^\x20\x09-\x0D]+"
FAN = 4096  # fractions that one task pairs at a time
DUST = 1e-9  # a fraction nearer to a whole number is one
STATE = "source string, block long, id long, size long, n long, base long, up long, left double"


def rounded(size: np.ndarray, left: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(1 where a fraction was rounded up, what is left of each fraction) after pairing in the given order.

    Words move between the two of a pair until the fraction of one is 0 or 1; the direction is drawn so that both
    keep their expectation. size * (up + rest) sums up to size * left, and at most one fraction is left over.
    """
    up, rest = np.zeros(len(left), np.int64), np.zeros(len(left))
    held, p, big = -1, 0.0, 0
    for i, (own, q, draw) in enumerate(zip(size.tolist(), left.tolist(), draws.tolist())):
        if q <= 0.0:
            continue
        if held < 0:
            held, p, big = i, q, own
            continue
        room, given, full, back = big * (1.0 - p), own * q, big * p, own * (1.0 - q)
        to_held, from_held = min(room, given), min(full, back)
        if draw * (to_held + from_held) < from_held:
            if room <= given:
                up[held], last, rest_of = 1, i, q - room / own
            else:
                last, rest_of = held, p + given / big
        elif full <= back:
            last, rest_of = i, q + full / own
        else:
            up[i], last, rest_of = 1, held, p - back / big
        if rest_of > 1.0 - DUST:
            up[last] = 1
        if DUST < rest_of <= 1.0 - DUST:
            big = own if last == i else big
            held, p = last, rest_of
        else:
            held = -1
    if held >= 0:
        rest[held] = p
    return up, rest


def _paired(table: pa.Table) -> pa.Table:
    """One block: its fractions from the longest document to the shortest, then in the order of their draws."""
    size, draws = table["size"].to_numpy(), table["draw"].to_numpy()
    order = np.lexsort((table["id"].fill_null(-1).to_numpy(), draws, -size))
    table = table.take(pa.array(order)).drop_columns(["draw"])
    up, rest = rounded(size[order], table["left"].to_numpy(), draws[order])
    at = table.schema.get_field_index
    table = table.set_column(at("up"), "up", pa.array(table["up"].to_numpy() + up))
    return table.set_column(at("left"), "left", pa.array(rest))


def _targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """sources (source, source_size, entries) with weight and target: one share for each weight, but no more than
    `most` times the source; the excess is shared anew among the others until none is above."""
    cycle = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    placed = number_rows(sources, {"source": F.asc_nulls_last}, "place")
    placed = stored(placed.withColumn("weight", cycle[((F.col("place") - 1) % len(weights)).cast("int")]), "sources")
    share, full = F.lit(-1.0), -1
    while True:  # a few scalars each time; every round but the last finds another source that is full
        is_full = F.col("weight") * share > most * F.col("source_size")
        total, known, open_weight, now = placed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(is_full, most * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0)), F.count_if(is_full),
        ).first()
        if now == full:
            return placed.withColumn("target", F.when(is_full, most * F.col("source_size")).otherwise(F.col("weight") * share).cast("double"))
        full = now
        share = F.lit((total - known) / open_weight if open_weight else float(total))


def mixed(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 11,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every row of docs.

    size: words in the text, runs of anything but the six ASCII white-space characters; null and empty texts have
    none and are taken no times. Sources in the order of code points, null last, take the weights in turn; the
    targets share all words by weight, `most` times a source's own words at most. copies: 0 to `most`, the whole
    number below or above target / source_size; taken: copies times size. A source's words differ from its target
    by less than one document, as a rule a short one. Draws hang on seed, id and size only, so reruns agree however the rows
    lie. Ids are integers; rows that share an id, null ids too, are rounded apart. Rows that are equal in id, source
    and size are counted before the shuffle, so no key is too hot. No rows give no rows; other columns are not
    returned.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), words.alias("size"))
    entries = stored(sized.groupBy("id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    sources = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("entries"))
    sources = stored(_targets(sources, weights, most), "targets").select(
        "source", "source_size", "target", F.ceil(F.col("entries") / FAN).alias("blocks")
    )
    own = sources.select(F.col("source").alias("_source"), F.col("source_size").alias("_size"), "target", "blocks")
    wanted = F.when(F.col("size") > 0, F.least(F.col("target") / F.col("_size"), F.lit(float(most)))).otherwise(0.0)
    whole = F.floor(wanted + DUST)
    fraction = F.greatest(wanted - whole, F.lit(0.0))
    # Equal rows are paired with each other first: whole ones of them are rounded up, one keeps the rest.
    together = F.col("n") * fraction
    raised = F.floor(together + DUST)
    rest = F.when(together - raised > DUST, together - raised).otherwise(0.0)
    state = entries.join(own, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.col("blocks")).alias("block"), "id", "size", "n",
        whole.cast("long").alias("base"), raised.cast("long").alias("up"), rest.cast("double").alias("left"),
    )
    most_blocks = sources.agg(F.max("blocks")).first()[0] or 1
    decided, level = [], 0
    while True:
        level += 1
        draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), "id", "size"), 11) / F.lit(float(1 << 53))
        paired = state.withColumn("draw", draw).groupBy("source", "block").applyInArrow(_paired, STATE)
        paired = stored(paired, "rounded")
        decided.append(paired.where("left = 0"))
        state = paired.where("left > 0")
        if most_blocks == 1:
            break
        most_blocks = -(-most_blocks // FAN)
        state = state.withColumn("block", F.pmod(F.col("block"), F.lit(most_blocks)))
    # The last fraction of a source is a draw of its own.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(0), "id", "size"), 11) / F.lit(float(1 << 53))
    decided.append(state.withColumn("up", F.col("up") + (draw < F.col("left")).cast("long")))
    result = decided[0]
    for more in decided[1:]:
        result = result.unionByName(more)
    copies = F.col("base") + (F.col("copy") < F.col("up")).cast("long")
    result = written_out(result, F.col("n")).withColumn("copies", copies)
    return result.join(own, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("id").alias(id_col), "source", "size", F.col("_size").alias("source_size"), "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )
