"""Repairs beside a search over all edit sequences, state by state, that keeps the least (cost, audit)."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversations, queries

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def broken(rows):
    """The damage of the query, row by row, in the order of turn, role and text."""
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if fault == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row[1:])
    return {conv: repair(sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for conv, g in groups.items()}


def repair(rows):
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        rest = text.strip(SPACES)
        faults.append(1 if not rest else 2 if (role, text) in seen else 3 if rest[-1] not in ".!?" else 0)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") or not (a and b) for a, b in zip(initials, initials[1:]))

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                to = NEXT[state]
                new = (cost + 3, audit + "I", [*lines, FULL[to] + ":"])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        following = {}
        for state, (cost, audit, lines) in best.items():
            ways = [(state, 4, "D", None)]
            if fault not in (1, 2):
                more = 3 if fault == 3 else 0
                if (state, role[:1]) in STEP:
                    ways.append((STEP[state, role[:1]], more, "K", f"{role}:{text}"))
                ways.append((NEXT[state], 3 + more, "R", f"{FULL[NEXT[state]]}:{text}"))
            for to, price, letter, line in ways:
                new = (cost + price, audit + letter, lines if line is None else [*lines, line])
                if to not in following or new[:2] < following[to][:2]:
                    following[to] = new
        best = inserted(following)
    cost, audit, lines = min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def drawn(n, seed, conversations_of=6):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sage"])
        text = draw.choice(["Yes.", "No!", "why", " ", "", None, "é?\n", "a. b", "ok. \t", "Long " * draw.randrange(4) + "end."])
        rows.append((draw.choice([*range(conversations_of), None]), draw.choice([*range(30), None]), role, text))
    return rows


def result(df):
    return {r.conv: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_plain_search(spark, seed):
    rows = drawn(400, seed, 60)
    given = [(c, t, r or "", x or "") for c, t, r, x in rows]
    got = result(conversations.repaired(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(given)


def test_long_conversations_cross_partitions(spark):
    rows = drawn(3000, 7, 3) + [(1, 5, "user", "Again.")] * 900
    given = [(c, t, r or "", x or "") for c, t, r, x in rows]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = conversations.edits(spark.createDataFrame(rows, SCHEMA))
        assert found.select("conv", "part").distinct().count() > found.select("conv").distinct().count()
        assert result(conversations.repaired(spark.createDataFrame(rows, SCHEMA))) == plain(given)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranks_order_nodes_by_what_lies_ahead():
    draw = random.Random(3)
    segments = [([draw.randrange(12) for _ in range(n)], [1] * n, conversations.END, True) for n in (1, 2, 9, 30)]
    paths = conversations.Paths(segments)

    def ahead(node):
        out = []
        while paths.letters[node] >= 0:
            out.append(paths.letters[node])
            node = paths.pointers[0][node]
        return out

    words = [ahead(node) for node in range(len(paths.letters))]
    by_rank = sorted(range(len(words)), key=lambda n: paths.ranks[n])
    assert [words[n] for n in by_rank] == sorted(words)


def test_the_query(spark, tmp_path):
    rows = drawn(500, 11, 80) + [(500, 1, "user", "Hi."), (501, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "'y' AS edit", "1 AS n", "2 AS part").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in queries.QUERIES["op12_conversations"](spark, str(tmp_path)).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {row[0]: nothing for row in rows} | plain(broken(rows))
    assert got == want and len(got) == len({r[0] for r in rows})


def test_no_rows_and_a_very_long_text(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repaired(empty).collect() == []
    rows = [(1, 1, "user", "word " * 400_000 + "end."), (1, 2, "assistant", "x" * 2_000_000)]
    assert result(conversations.repaired(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
