"""Conversation repair against plain Python: an exhaustive search and the state machine."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest

from linktide.llm.alternation import align
from linktide.llm.conversations import damaged, intact, op12_conversation_repair, repaired

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, n int, `cost` int, place string"


def steps(state, turn):
    """``(edit, cost, next state)`` without insertions; states: "", s, u, a."""
    if turn is not None:
        yield "D", 3, state
        if turn != "x":
            more, role = int(turn.isupper()), turn.lower()
            wanted = "a" if state == "u" else "u"
            yield ("K", more, wanted) if role == wanted else ("R", 2 + more, wanted)
            if state == "" and role == "s":
                yield "K", more, "s"


def inserted(paths):
    for _ in range(3):
        for state, (cost, audit) in list(paths.items()):
            after = "a" if state == "u" else "u"
            paths[after] = min(paths.get(after, (cost + 2, audit + "I")), (cost + 2, audit + "I"))
    return paths


def cheapest(turns):
    paths = {"": (0, "")}
    for turn in turns:
        found = {}
        for state, (cost, audit) in inserted(paths).items():
            for edit, price, after in steps(state, turn):
                path = cost + price, audit + edit
                found[after] = min(found.get(after, path), path)
        paths = found
    return min(p for s, p in inserted(paths).items() if s in ("", "a"))


def exhaustive(turns, most_inserts=3):
    """Every sequence of edits with up to ``most_inserts`` insertions, spelled out."""
    best = None
    for plan in product("DKR", repeat=len(turns)):
        if any(t == "x" and e != "D" for t, e in zip(turns, plan, strict=True)):
            continue
        for gaps in product(range(most_inserts + 1), repeat=len(turns) + 1):
            if sum(gaps) > most_inserts:
                continue
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(plan, gaps[1:], strict=True))
            # What stands there in the end: a kept initial, or a role of one's choice.
            at, shape, cost = 0, "", 0
            for edit in audit:
                turn = turns[at] if edit != "I" else ""
                at += edit != "I"
                cost += {"D": 3, "I": 2, "K": 0, "R": 2}[edit]
                cost += edit in "KR" and turn.isupper()
                shape += "" if edit == "D" else turn.lower() if edit == "K" else "?"
            body = shape.removeprefix("s")
            if any(c not in ("?", "ua"[k % 2]) for k, c in enumerate(body)) or len(body) % 2 or (shape and not body):
                continue
            best = min(best or (cost, audit), (cost, audit))
    return best


def test_alignment_against_all_edits():
    rng = random.Random(3)
    for _ in range(60):
        turns = "".join(rng.choice("suaSUAox") for _ in range(rng.randrange(5)))
        assert align(turns) == exhaustive(turns) == cheapest(turns), turns


def test_alignment_of_blocks():
    rng = random.Random(5)
    for n in (1, 31, 32, 33, 64, 65, 300):
        for letters in ("ua", "suaUAox", "x", "s", "uuuS"):
            turns = "".join(rng.choice(letters) for _ in range(n))
            assert align(turns) == cheapest(turns), turns


def expected(rows, damage=True):
    """Rows of the registered query from ``[(conv_id, turn, role, text)]``."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        after = groups[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    found = []
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, letters, faults = set(), "", Counter()
        for _, role, text in turns:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (
                "blank" if not words else "duplicate" if (role, text) in seen
                else "truncated" if words[-1] not in ".!?" else ""
            )
            seen.add((role, text))
            faults[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(letters)
        lines, at, last = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else turns[at][1:]
            at += edit != "I"
            if edit != "D":
                role = role if edit == "K" else "assistant" if last == "u" else "user"
                last = role[:1]
                lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return Counter(found)


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_registered_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()]
    result = op12_conversation_repair(spark, sf_dir)
    assert result.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert Counter(map(tuple, result.collect())) == expected(rows)


def odd_rows():
    rng = random.Random(8)
    rows = [
        (None, None, None, None), (None, 1, "user", "hi."), (1, 5, "", ""), (1, 5, "", ""), (1, None, "robot", "x" * 200_000),
        (2, 1, "User", "Hi!"), (2, 9, "user", "Hi!"), (2, 9, "assistant", " \t\n"), (3, 3, "system", "s."), (4, 1, "u", " "),
    ]
    rows += [(conv, 7, "user", "dropped") for conv in range(100, 160)]
    for conv in range(10, 40):
        for turn in range(rng.randrange(1, 90)):
            role = rng.choice(["user", "assistant"] * 5 + ["system", "tool", None])
            text = rng.choice(["a.", "b", "", "é! ", None, f"{turn}?", f"{turn} c"])
            rows += [(conv, rng.choice([turn, turn * 2, None]), role, text)] * rng.choice([1, 1, 1, 2])
    rows += [(77, k, "ua"[k % 2] + "x", rng.choice([f"t{k}.", f"t{k}", "again."])) for k in range(1500)]
    return rows


@pytest.mark.parametrize("long_turns", [100_000, 20])
@pytest.mark.parametrize("damage", [True, False])
def test_odd_rows_short_and_in_pieces(spark, scratch, long_turns, damage):
    rows = odd_rows()
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)
    found = repaired((damaged if damage else intact)(table), scratch, long_turns)
    assert Counter(map(tuple, found.collect())) == expected(rows, damage)


def test_long_conversation_of_gone_turns(spark, scratch):
    turns = spark.createDataFrame([(1, None, True, "user", "x")] * 30, "conv_id long, turn long, gone boolean, role string, text string")
    nothing = hashlib.sha256().hexdigest()
    assert [tuple(r) for r in repaired(turns, scratch, 10).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_empty_table(spark, scratch):
    table = spark.createDataFrame([], SCHEMA)
    assert repaired(damaged(table), scratch).collect() == []
