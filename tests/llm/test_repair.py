"""Repairs against searches that try everything."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from ordertally.llm import repair
from ordertally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SHAPE = "conv_id bigint, turn bigint, role string, text string, place int, edit string, fault int"
GOOD = re.compile(r"(s?(ua)+)?")
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}


def faults_of(rows):
    """Rows of (turn, role, text) in order; the first fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def tried(rows):
    """Cost, letters and repaired turns: every choice of edits, with two inserts at a gap."""
    faults = faults_of(rows)
    gap = [[]] + [[c] for c in "ua"] + [list(c) for c in itertools.product("ua", repeat=2)]
    names = {"u": "user", "a": "assistant"}
    found = []

    def go(k, cost, letters, turns):
        for inserted in gap:
            more = [(names[c], "") for c in inserted]
            price, word = cost + 2 * len(more), letters + "I" * len(more)
            if k == len(rows):
                initials = "".join(role[:1] or "?" for role, _ in turns + more)
                if GOOD.fullmatch(initials):
                    found.append((price, word, turns + more))
                continue
            _, role, text = rows[k]
            go(k + 1, price + 3, word + "D", turns + more)
            if faults[k] not in ("blank", "duplicate"):
                extra = price + (faults[k] == "truncated")
                go(k + 1, extra, word + "K", turns + more + [(role, text)])
                for name in names.values():
                    go(k + 1, extra + 2, word + "R", turns + more + [(name, text)])

    go(0, 0, "", [])
    return min(found, key=lambda way: way[:2])


def slow(rows):
    """The same by whole strings, for long conversations: the least (cost, letters) of a state."""
    faults = faults_of(rows)
    keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    turn = {0: 2, 1: 2, 2: 3, 3: 2}

    def relaxed(ways):
        for _ in range(3):
            for state, (cost, word) in list(ways.items()):
                offer(ways, turn[state], cost + 2, word + "I")
        return ways

    def offer(ways, state, cost, word):
        if state not in ways or (cost, word) < ways[state]:
            ways[state] = (cost, word)

    ways = relaxed({0: (0, "")})
    for (_, role, _), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (cost, word) in ways.items():
            offer(new, state, cost + 3, word + "D")
            if fault not in ("blank", "duplicate"):
                extra = cost + (fault == "truncated")
                if state in keep.get(role[:1], {}):
                    offer(new, keep[role[:1]][state], extra, word + "K")
                offer(new, turn[state], extra + 2, word + "R")
        ways = relaxed(new)
    return min(ways[s] for s in (0, 3) if s in ways)


def applied(rows, letters):
    """The turns that the letters leave."""
    rest, turns, last = list(rows), [], ""
    for letter in letters:
        role, text = "", ""
        if letter != "I":
            _, role, text = rest.pop(0)
        if letter == "D":
            continue
        if letter in "RI":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        turns.append((role, text))
    assert not rest
    return turns


def answer(rows):
    cost, letters = slow(rows)
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    text = "\n".join(f"{role}:{said}" for role, said in applied(rows, letters))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")),
        illegal,
        cost,
        letters,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def in_order(rows):
    by_key = defaultdict(list)
    for key, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        by_key[key].append((turn is not None, turn or 0, role, text, turn))
    return {
        key: [(turn, role, text) for *_, role, text, turn in sorted(some, key=lambda r: r[:4])]
        for key, some in by_key.items()
    }


def shown(frame):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = frame.collect()
    found = {r["conv_id"]: tuple(r[c] for c in columns) for r in rows}
    assert len(found) == len(rows)
    return found


def edits_of(rows, settle_rows=repair.SETTLE_ROWS):
    one = repair.Repair(1, settle_rows)
    out = []
    for (turn, role, text), fault in zip(rows, faults_of(rows), strict=True):
        out += one.add(turn, role, text, fault)
        assert len(one.rows) <= one.settle_rows
    return [*out, *one.end()]


def some_rows(rng, count):
    roles = ["user", "assistant", "system", "tool", "", "umpire"]
    texts = ["fine.", "good!", "cut", " ", "", "x?", "other.", "y. \n"]
    return [
        (k, rng.choice(roles[: rng.choice((3, 6))]), rng.choice(texts[:6]) if rng.random() < 0.4 else f"t{k}{rng.choice('.,')}")
        for k in range(count)
    ]


def test_against_every_choice():
    rng = random.Random(1)
    for _ in range(60):
        rows = some_rows(rng, rng.randrange(4) if rng.random() < 0.2 else rng.randrange(3))
        cost, letters, turns = tried(rows)
        edits = edits_of(rows)
        assert "".join(e[2] for e in edits) == letters
        assert sum(e[5] for e in edits) == cost
        assert [(e[7], e[8]) for e in edits if e[2] != "D"] == turns
        assert slow(rows) == (cost, letters)


@pytest.mark.parametrize("settle_rows", [1, 3, 1024])
def test_long_ones(settle_rows):
    rng = random.Random(settle_rows)
    for _ in range(40):
        rows = some_rows(rng, rng.randrange(120))
        edits = edits_of(rows, settle_rows)
        assert (sum(e[5] for e in edits), "".join(e[2] for e in edits)) == slow(rows)
        assert [e[1] for e in edits] == list(range(len(edits)))


def test_comparison_survives_collisions(monkeypatch):
    """With a hash that says nothing, letters decide."""
    monkeypatch.setattr(repair, "_PRIME", 1)
    rng = random.Random(5)
    for _ in range(20):
        rows = some_rows(rng, rng.randrange(40))
        assert "".join(e[2] for e in edits_of(rows)) == slow(rows)[1]


def test_ancestors():
    ways = [repair.Way()]
    for k in range(100):
        ways.append(repair.Way("DIKR"[k % 4], ways[-1]))
    assert all(ways[100].at(k) is ways[k] for k in range(101))


AWKWARD = [
    (1, 1, "user", "Hello.", 1, "x", 1),
    (1, 1, "user", "Hello.", 1, "x", 1),
    (1, None, "system", "Rules.", None, None, None),
    (1, 7, None, None, 1, "x", 1),
    (1, 7, "assistant", "Half", 1, "x", 1),
    (None, 2, "assistant", "No key.", 1, "x", 1),
    (None, 1, "assistant", "No key.", 1, "x", 1),
    (2, None, None, None, 1, "x", 1),
    (3, 3, "assistant", "a. " * 30_000, 1, "x", 1),
    (3, 2, "user", "b " * 30_000, 1, "x", 1),
    (4, 2, "user", "tie.", 1, "x", 1),
    (4, 2, "assistant", "tie.", 1, "x", 1),
]


def test_awkward(spark):
    frame = spark.createDataFrame(AWKWARD, SHAPE).repartition(3)
    found = shown(repair.totals(repair.repaired(frame)))
    expected = {key: answer(rows) for key, rows in in_order([r[:4] for r in AWKWARD]).items()}
    assert found == expected


def test_empty(spark):
    frame = spark.createDataFrame([], SHAPE)
    assert repair.totals(repair.repaired(frame)).collect() == []


def damage(rows):
    for key, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (key, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (key, turn, "user" if kind == 4 else role, text)
        yield from [row] * (2 if kind == 3 else 1)


def test_damage(spark):
    rows = [(k, t, "assistant", f"a{k}. b!") for k in range(40) for t in (None, 0, 1)] + [(None, 1, None, None)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = sorted(map(tuple, repair.damaged(frame).collect()), key=repr)
    assert found == sorted(damage(rows), key=repr)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    left = in_order(damage(rows))
    empty = (*[0] * 6, "", hashlib.sha256(b"").hexdigest())
    expected = {key: answer(left[key]) if key in left else empty for key, *_ in rows}
    assert shown(QUERIES["op12_repair"](spark, SF_DIR)) == expected


def test_nothing_is_left(spark, tmp_path):
    """A conversation whose rows are all dropped is there all the same."""
    gone = [k for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][:3]
    rows = [(k, 0, "user", "Hi.") for k in [*gone, -5]]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = shown(QUERIES["op12_repair"](spark, str(tmp_path)))
    for key in gone:
        assert found[key] == (*[0] * 6, "", hashlib.sha256(b"").hexdigest())
    assert len(found) == len(gone) + 1
