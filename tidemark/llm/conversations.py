"""Repair of the turn structure of conversations at least cost, with the least audit among the cheapest.

A repaired conversation is empty or an optional system turn and then pairs of user and assistant. Rows are kept,
given another role, deleted, or inserted; the cheapest way is a shortest path over (row, state) with four states. After
the costs to the end are known, the nodes are ranked by the audit letters that lie ahead of them, by one letter, then
by two, four and so on: a node's rank over twice the length is that of the pair (its own rank, the rank of the node that
its pointer reaches), and pointers double with the ranks. They lead along the least path without walking it.

Rows are sorted by conversation and turn over all partitions, so a conversation of any length is cut into segments.
A segment's costs are a small matrix from entry to exit state; only conversations that cross a border between two
partitions need others' matrices, at most two for each partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shipping import shipped
from tidemark.llm.storage import stored
from tidemark.operators.joins import join_same
from tidemark.session import cut

shipped(__name__)

SPACE = " \t\n\x0b\x0c\r"
RULES = "su", "ua", "au"  # neighbours that a well-formed conversation may have
START, SYSTEM, USER, ASSISTANT = range(4)  # the last role of the repaired rows so far
NEVER = 1 << 60
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3  # what edits cost
CUT_OFF = 3  # what an undeleted truncated row costs besides
LETTERS = "DIKR"  # in the order of ASCII
D, I, K, R = range(4)
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the one role that an edit may add in a state
END = (0, 2 * INSERT, INSERT, 0)  # costs from each state after the last row
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = "s", "u", "a"  # initials; others have the number 3
EDITS = "part int, step long, edit string, n long, turn long, role string, text string, blank long, duplicate long, truncated long, illegal long, cost long"


def _arcs(kind: int) -> list[list[tuple[int, int, int]]]:
    """From each state over one row: (letter, cost, next state). kind: 4 * fault class + initial; class 2 must go."""
    fault, initial = divmod(kind, 4)
    more = CUT_OFF if fault == 1 else 0
    out = []
    for state in range(4):
        arcs = [(D, DELETE, state)]
        if fault < 2:
            target = {0: SYSTEM, 1: USER, 2: ASSISTANT}.get(initial)
            if (state, target) in ((START, SYSTEM), (state, GIVEN[state])):
                arcs.append((K, KEEP + more, target))
            arcs.append((R, REROLE + more, GIVEN[state]))
        out.append(arcs)
    return out


ARCS = [_arcs(kind) for kind in range(12)]
INSERTS = [(state, GIVEN[state]) for state in range(4)]


def _inserted(costs: list[int]) -> list[int]:
    """Costs from the states of one place when rows may be inserted there as well."""
    for _ in range(2):  # two rows at most: a third would lead back
        costs = [min(own, INSERT + costs[GIVEN[state]]) for state, own in enumerate(costs)]
    return costs


def costs_ahead(kinds: list[int], counts: list[int], end: tuple[int, ...]) -> list[list[int]]:
    """Least cost from each (row, state) to the end; `end` holds the costs of the states behind the last row."""
    ahead = [list(end)]
    for kind, count in zip(reversed(kinds), reversed(counts)):
        nxt = ahead[-1]
        if kind >= 8:
            here = [DELETE * count + cost for cost in nxt]
        else:
            here = [min(cost + nxt[to] for _, cost, to in arcs) for arcs in ARCS[kind]]
        ahead.append(_inserted(here))
    ahead.reverse()
    return ahead


def matrix(kinds: list[int], counts: list[int]) -> list[int]:
    """Least costs from entry state to exit state, rows of the matrix one after the other."""
    columns = [costs_ahead(kinds, counts, tuple(0 if s == out else NEVER for s in range(4)))[0] for out in range(4)]
    return [min(columns[out][entry], NEVER) for entry in range(4) for out in range(4)]


class Paths:
    """The least of the cheapest paths through several segments, from all their nodes at once."""

    def __init__(self, segments: list[tuple[list[int], list[int], tuple[int, ...], bool]]):
        """segments: (kinds, counts, costs behind the last row, whether the conversation ends there)."""
        letters, targets, self.first = [], [], []
        for kinds, counts, end, closes in segments:
            ahead = costs_ahead(kinds, counts, end)
            base = len(letters)
            self.first.append(base)
            for i, costs in enumerate(ahead):
                nxt = ahead[i + 1] if i < len(kinds) else None
                for state, cost in enumerate(costs):
                    node = base + 4 * i
                    letter, target = -1, node + state  # behind the last row the path ends, or leaves the segment
                    if nxt is not None and kinds[i] >= 8:
                        if DELETE * counts[i] + nxt[state] == cost:
                            letter, target = D, node + 4 + state
                    elif nxt is not None:
                        for edit, price, to in ARCS[kinds[i]][state]:
                            if price + nxt[to] == cost and (letter < 0 or edit < letter):
                                letter, target = edit, node + 4 + to
                    may_insert = (nxt is not None or closes) and cost < NEVER
                    if may_insert and INSERT + costs[GIVEN[state]] == cost and (letter < 0 or I < letter):
                        letter, target = I, node + GIVEN[state]
                    letters.append(letter)
                    targets.append(target)
        self.letters = np.array(letters, np.int64)
        self.pointers = [np.array(targets, np.int64)]
        self.ranks = self.letters + 1
        self._double()

    def _double(self) -> None:
        """Ranks by 2, 4, ... letters ahead, and pointers that many arcs ahead, until all paths have ended."""
        while True:
            pointer = self.pointers[-1]
            if (self.letters[pointer] < 0).all():
                return
            _, self.ranks = np.unique(self.ranks * (len(self.ranks) + 5) + self.ranks[pointer], return_inverse=True)
            self.pointers.append(pointer[pointer])

    def end(self, segment: int, state: int) -> int:
        """The state in which the least path leaves a segment."""
        return int((self.pointers[-1][self.first[segment] + state] - self.first[segment]) % 4)

    def along(self, starts: np.ndarray) -> np.ndarray:
        """All nodes of the paths from the given nodes, path after path; each path's last node is left out."""
        nodes, owner, step = starts, np.arange(len(starts)), np.zeros(len(starts), np.int64)
        for k in range(len(self.pointers) - 1, -1, -1):
            further = self.pointers[k][nodes]
            new = self.letters[further] >= 0
            nodes, owner = np.concatenate([nodes, further[new]]), np.concatenate([owner, owner[new]])
            step = np.concatenate([step, step[new] + (1 << k)])
        live = self.letters[nodes] >= 0
        order = np.lexsort((step[live], owner[live]))
        return nodes[live][order]


class Sorted:
    """Rows of one partition, conversation after conversation, as they arrive in batches."""

    def __init__(self, batches: Iterator[pa.RecordBatch], solve, least: int = 4096):
        self.batches, self.solve, self.least = batches, solve, least

    def __iter__(self):
        """solve(table, starts of its conversations, whether one of them is the partition's first, its last)."""
        held, first = [], True
        for batch in self.batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < self.least:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = self._starts(table)
            if len(starts) > 1:
                done = int(starts[-1])
                yield from self.solve(table.slice(0, done), starts[:-1], first, False)
                held, first = table.slice(done).to_batches(), False
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from self.solve(table, self._starts(table), first, True)

    @staticmethod
    def _starts(table: pa.Table) -> np.ndarray:
        conv = table["conv"].combine_chunks()
        codes = conv.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))


def _units(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of the table, kind, count, fault) of each step of the paths: a row with its repeats is one that may stay
    and a run that must go, or a run alone."""
    fault, initial, n = (table[c].to_numpy() for c in ("fault", "initial", "n"))
    must = (fault == BLANK) | (fault == DUPLICATE)
    split = ~must & (n > 1)
    rows = np.repeat(np.arange(len(n)), 1 + split)
    run = np.zeros(len(rows), bool)
    run[1:] = rows[1:] == rows[:-1]
    goes = run | must[rows]
    kinds = np.where(goes, 8, np.where(fault[rows] == TRUNCATED, 4, 0)) + initial[rows]
    counts = np.where(must[rows], n[rows], np.where(run, n[rows] - 1, 1))
    return rows, kinds, counts, np.where(run, DUPLICATE, fault[rows])


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a partition with the costs of their segments."""

    def solve(table, starts, first, last):
        rows, kinds, counts, _ = _units(table)
        bounds = np.searchsorted(rows, np.append(starts, table.num_rows))
        wanted = ([0] if first else []) + ([len(starts) - 1] if last else [])
        for at in sorted(set(wanted)):
            own = slice(bounds[at], bounds[at + 1])
            head, tail = int(starts[at]), int(rows[own.stop - 1])
            yield pa.RecordBatch.from_arrays([
                table["part"].combine_chunks().slice(head, 1), table["conv"].combine_chunks().slice(head, 1),
                pa.array([first and at == 0]), pa.array([last and at == len(starts) - 1]),
                pa.array([int(table["initial"][tail].as_py())], pa.int64()),
                pa.array([matrix(kinds[own].tolist(), counts[own].tolist())], pa.list_(pa.int64())),
            ], ["part", "conv", "first", "last", "tail", "costs"])

    yield from Sorted(batches, solve)


def _exits(ends: dict):
    """For segments with known costs behind them: the state in which each entry state leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(table, starts, first, last):
            rows, kinds, counts, _ = _units(table)
            bounds = np.searchsorted(rows, np.append(starts, table.num_rows))
            parts, convs = table["part"].combine_chunks(), table["conv"].combine_chunks()
            for at in sorted({0, len(starts) - 1}):
                head = int(starts[at])
                known = ends.get((parts[head].as_py(), convs[head].as_py()))
                if known is not None:
                    own = slice(bounds[at], bounds[at + 1])
                    paths = Paths([(kinds[own].tolist(), counts[own].tolist(), known[0], known[1])])
                    out = [paths.end(0, state) for state in range(4)]
                    yield pa.RecordBatch.from_arrays(
                        [parts.slice(head, 1), convs.slice(head, 1), pa.array([out], pa.list_(pa.int64()))], ["part", "conv", "exits"]
                    )

        yield from Sorted(batches, solve)

    return run


def _edited(known: dict, crossing: bool | None = None):
    """The edits of all conversations, or of those that do or do not cross partitions alone.

    known: (part, conv) -> (entry state, costs behind, closes, initial before), for those that do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(table, starts, first, last):
            if crossing is not None:
                parts, convs = table["part"].combine_chunks(), table["conv"].combine_chunks()
                sizes = np.diff(np.append(starts, table.num_rows))
                wanted = np.array([((parts[h].as_py(), convs[h].as_py()) in known) == crossing for h in starts.tolist()])
                table = table.filter(pa.array(np.repeat(wanted, sizes)))
                starts = (np.cumsum(sizes * wanted) - sizes)[wanted]
                if not len(starts):
                    return
            rows, kinds, counts, faults = _units(table)
            bounds = np.searchsorted(rows, np.append(starts, table.num_rows))
            parts, convs = table["part"].combine_chunks(), table["conv"].combine_chunks()
            entries, before, segments = [], [], []
            for at, head in enumerate(starts.tolist()):
                own = slice(bounds[at], bounds[at + 1])
                inside = 0 < at < len(starts) - 1
                entry, end, closes, previous = (None if inside else known.get((parts[head].as_py(), convs[head].as_py()))) or (START, END, True, -1)
                entries.append(entry)
                before.append(previous)
                segments.append((kinds[own].tolist(), counts[own].tolist(), end, closes))
            paths = Paths(segments)
            firsts = np.array(paths.first)
            nodes = paths.along(firsts + np.array(entries))
            owner = np.searchsorted(firsts, nodes, side="right") - 1
            unit = bounds[owner] + (nodes - firsts[owner]) // 4
            letters = paths.letters[nodes]
            added = letters == I
            unit = np.minimum(unit, len(rows) - 1)
            source = rows[unit]
            # Neighbours of the rows as they were.
            initial = table["initial"].to_numpy()
            previous = np.concatenate([[-1], initial[:-1]])
            previous[starts] = before
            legal = np.isin(previous * 4 + initial, [4 * ROLES.index(a) + ROLES.index(b) for a, b in RULES]) | (previous < 0)
            run_of = np.concatenate([[False], rows[1:] == rows[:-1]])
            whole = (kinds >= 8) & ~run_of
            broken = np.where(run_of, counts, np.where(whole, counts - 1, 0) + ~legal[rows])
            price = np.where(letters == D, DELETE * counts[unit], np.where(letters == R, REROLE, 0)) + np.where(
                (letters != D) & (kinds[unit] // 4 == 1), CUT_OFF, 0
            )
            tally = {name: np.where(~added & (faults[unit] == code), counts[unit], 0) for name, code in (
                ("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))}
            new_role = np.array(["", "", "user", "assistant"], object)[(paths.pointers[0][nodes] - firsts[owner]) % 4]
            at = pa.array(source)
            role = np.where(added | (letters == R), new_role, table["role"].take(at).to_numpy(zero_copy_only=False))
            text = pc.if_else(pa.array(added), "", table["text"].combine_chunks().take(at).cast(pa.string()))
            turn = pc.if_else(pa.array(added), pa.scalar(None, pa.int64()), table["turn"].combine_chunks().take(at).cast(pa.int64()))
            # Steps go on from batch to batch: the first row's place in the partition leads, as a row has at most
            # two units with two insertions before each.
            step = (int(table["place"][0].as_py()) << 3) + np.arange(len(nodes))
            yield pa.RecordBatch.from_arrays([
                convs.take(pa.array(starts[owner])), parts.take(pa.array(starts[owner])), pa.array(step, pa.int64()),
                pa.array(np.array(list(LETTERS), object)[letters]), pa.array(np.where(added, 1, counts[unit]), pa.int64()),
                turn, pa.array(role, pa.string()), text,
                *(pa.array(t, pa.int64()) for t in tally.values()),
                pa.array(np.where(added, 0, broken[unit]), pa.int64()), pa.array(np.where(added, INSERT, price), pa.int64()),
            ], ["conv", "part", "step", "edit", "n", "turn", "role", "text", *tally, "illegal", "cost"])

        yield from Sorted(batches, solve)

    return run


def _chained(rows) -> list[list]:
    """Border segments of conversations that cross partitions, in order."""
    chains, open_chain = [], None
    for row in sorted((r for r in rows), key=lambda r: (r.part, not r.first)):
        if row.first and open_chain and open_chain[-1].conv == row.conv:
            open_chain.append(row)
        else:
            open_chain = [row] if row.last else None
            if open_chain:
                chains.append(open_chain)
        if not row.last:
            open_chain = None
    return [c for c in chains if len(c) > 1]


class _Placed:
    """The rows of all conversations in order, with their faults, and what the segments of conversations that cross
    partitions need to know of each other."""

    def __init__(self, turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str):
        given = turns.select(
            F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        )
        self.rows = cut(self._sorted(given))  # the same rows in the same partitions for all passes
        self.conv = f"conv {self.rows.schema['conv'].dataType.simpleString()}"
        self.known = self._crossing()

    @staticmethod
    def _sorted(given: DataFrame) -> DataFrame:
        """Rows that say the same as others of their conversation are found by digests; these rows alone are counted."""
        digest = F.unhex(F.sha2("text", 256))
        same = given.select("conv", "role", digest.alias("digest"), "turn").groupBy("conv", "role", "digest")
        repeats = same.agg(F.count("*").alias("times"), F.min(F.struct("turn")).alias("earliest")).where("times > 1")
        repeats = stored(repeats.drop("times"), "repeats")
        marked = join_same(given.withColumn("digest", digest), repeats, ["conv", "role", "digest"]).drop("digest")
        once = marked.where("earliest IS NULL").withColumn("n", F.lit(1).cast("long"))
        more = marked.where("earliest IS NOT NULL").groupBy("conv", "turn", "role", "text", "earliest").agg(F.count("*").alias("n"))
        stripped = F.rtrim(F.col("text"), F.lit(SPACE))
        initial = F.substring("role", 1, 1)
        number = F.lit(len(ROLES))
        for code, letter in enumerate(ROLES):
            number = F.when(initial == letter, code).otherwise(number)
        seen = F.col("earliest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("earliest.turn"))
        fault = (
            F.when(stripped == "", BLANK).when(seen, DUPLICATE)
            .when(F.substring(stripped, -1, 1).isin(".", "!", "?"), NONE).otherwise(TRUNCATED)
        )
        rows = once.unionByName(more).select(
            "conv", "turn", "role", "text", "n", fault.cast("int").alias("fault"), number.cast("int").alias("initial")
        )
        keys = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role")]
        rows = rows.repartitionByRange(*keys, F.substring("text", 1, 256)).sortWithinPartitions(*keys, F.asc("text"))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        return rows.select("*", F.spark_partition_id().alias("part"), place.alias("place"))

    def _crossing(self) -> dict:
        """(part, conv) -> (entry state, costs behind, whether the conversation ends there, initial before), at most
        two for each partition."""
        slim = self.rows.select("conv", "part", "fault", "initial", "n")
        found = slim.mapInArrow(_borders, f"part int, {self.conv}, first boolean, last boolean, tail long, costs array<long>").collect()
        chains, ends, known = _chained(found), {}, {}
        for chain in chains:
            end = END
            for at in range(len(chain) - 1, -1, -1):
                row = chain[at]
                ends[row.part, row.conv] = end, at == len(chain) - 1
                end = tuple(min(row.costs[4 * s + out] + end[out] for out in range(4)) for s in range(4))
        if chains:
            exits = slim.mapInArrow(_exits(ends), f"part int, {self.conv}, exits array<long>").collect()
            left = {(r.part, r.conv): r.exits for r in exits}
            for chain in chains:
                state, before = START, -1
                for row in chain:
                    known[row.part, row.conv] = (state, *ends[row.part, row.conv], before)
                    state, before = left[row.part, row.conv][state], row.tail
        return known


def edits(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The edits that repair each conversation at least cost, one row each, in the order (part, step):
    (conv, part, step, edit, n, turn, role, text, blank, duplicate, truncated, illegal, cost).

    edit: K a kept row, R one with another role, I an empty one inserted, D one deleted; n: rows that it stands for,
    over one only for deleted repeats. turn, role and text are those after the edit (for D, before). The first fault
    of a row counts: blank (nothing but the six ASCII white-space characters), duplicate (role and text seen earlier),
    truncated (its last other character is none of .!?). illegal: neighbours before the repair, counted at the second
    one, whose initials are none of su, ua, au. The cheapest edits are taken; of several, those whose letters come
    first in ASCII.

    Rows are in the order of turn (nulls first), role and text; null roles and texts count as empty, a null
    conversation id is a conversation of its own. Equal rows are counted before they are sorted, so neither a long
    conversation nor a repeated row is collected in one task; memory holds one conversation's part of a partition. No
    rows give no edits; other columns are not returned.
    """
    placed = _Placed(turns, conv_col, turn_col, role_col, text_col)
    return placed.rows.mapInArrow(_edited(placed.known), f"{placed.conv}, {EDITS}")


SUMS = "blank", "duplicate", "truncated", "illegal", "cost"
SUMMARY = ", ".join(f"{c} long" for c in SUMS) + ", audit string, repaired_sha256 string"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted edits -> (conv, sums, audit, digest of the repaired rows), one conversation at a time."""
    none = object()
    conv, sums, letters, digest, started, done = none, [], [], None, False, []

    def written(kind):
        columns = list(zip(*done))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:6]), *(pa.array(c, pa.string()) for c in columns[6:])]
        return pa.RecordBatch.from_arrays(arrays, ["conv", *SUMS, "audit", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        counted = zip(*(batch.column(c).to_pylist() for c in SUMS))
        for name, edit, n, role, text, own in zip(*(batch.column(c).to_pylist() for c in ("conv", "edit", "n", "role", "text")), counted):
            if name != conv:
                if conv is not none:
                    done.append((conv, *sums, "".join(letters), digest.hexdigest()))
                conv, sums, letters, digest, started = name, [0] * len(SUMS), [], hashlib.sha256(), False
            sums = [a + b for a, b in zip(sums, own)]
            letters.append(edit * n)
            if edit != "D":
                digest.update(("\n" if started else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                started = True
        if done:
            yield written(kind)
            done = []
    if conv is not none:
        done.append((conv, *sums, "".join(letters), digest.hexdigest()))
        yield written(kind)


def _finished(known: dict):
    """Edits and summary at once, of the conversations that lie in one partition."""
    solved = _edited(known, crossing=False)
    return lambda batches: _digested(solved(batches))


def repaired(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each conversation of `turns`: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256). gaps: missing numbers between the smallest and the largest turn, nulls left aside. audit: the
    edits' letters in order. The digest is that of the repaired `role:text`, joined by line feeds; it is taken while
    the rows stream by, in bounded memory. Only conversations that cross partitions are shuffled for it. See `edits`
    for the rest."""
    placed = _Placed(turns, conv_col, turn_col, role_col, text_col)
    summary = f"{placed.conv}, {SUMMARY}"
    result = placed.rows.mapInArrow(_finished(placed.known), summary)
    if placed.known:
        kept: Column = F.when(F.col("edit") != "D", F.col("text"))
        lines = placed.rows.mapInArrow(_edited(placed.known, crossing=True), f"{placed.conv}, {EDITS}").withColumn("text", kept)
        lines = lines.repartition("conv").sortWithinPartitions("conv", "part", "step")
        result = result.unionByName(lines.mapInArrow(_digested, summary))
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = placed.rows.groupBy("conv").agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    return join_same(result, gaps, ["conv"])
