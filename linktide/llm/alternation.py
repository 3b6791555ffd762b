"""Alignment of turns to the grammar ``(s?(ua)+)?`` by Wagner-Fischer tables.

Turns come as one letter each: ``s``, ``u``, ``a`` for the role's initial, ``o`` for any other,
in upper case if the turn is truncated, and ``x`` if it has to go. A block of turns is
aligned to every feasible length of the alternating string that can stand there. The grammar
only has four states between turns, so long conversations are aligned block by block and the
blocks' best alignments are put together; every alignment of a block ends with a turn, so
audits of a block are never a prefix of one another and can be compared block by block.
"""

from __future__ import annotations

from functools import lru_cache

# What an edit costs. A truncated turn that stays costs one more.
INSERT, DELETE, REROLE, TRUNCATED = 2, 3, 2, 1
BLOCK_TURNS = 32
# States: nothing yet, after s, after u, after a. The text may end at the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# What a text in this state needs to end: cost and audit.
ENDING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
_FAR = 1 << 60


def _target(first: str, length: int) -> str:
    """The grammar's string of this length that begins with ``first``."""
    alternating = ("au" if first == "a" else "ua") * (length // 2 + 1)
    return (first + alternating if first == "s" else alternating)[:length]


def _least_cost(turns: int, forced: int, length: int) -> int:
    """A bound for every alignment: insertions and deletions that the lengths alone ask for."""
    deleted = max(forced, turns - length)
    return DELETE * deleted + INSERT * max(0, length - turns + deleted)


def _straight(turns: str, target: str) -> int:
    """The cost of one plain alignment, the incumbent that the first band is cut by."""
    cost = DELETE * turns.count("x")
    kept = turns.replace("x", "")
    if target[:1] == "s":
        at = kept.lower().find("s")
        if at < 0:
            return _FAR
        cost += DELETE * at + TRUNCATED * (kept[at] == "S")
        kept, target = kept[at + 1 :], target[1:]
    extra = len(kept) - len(target)
    cost += DELETE * max(0, extra) + INSERT * max(0, -extra)
    kept, target = kept[max(0, extra) :], target[max(0, -extra) :]
    for turn, wanted in zip(kept, target, strict=True):
        cost += REROLE * (turn.lower() != wanted) + TRUNCATED * turn.isupper()
    return cost


def _aligned(turns: str, target: str, most: int) -> tuple[int, str] | None:
    """The least cost of up to ``most`` and its ASCII-least audit; None if there is none.

    The table has the cost from a cell to the end, for cells whose diagonal can be on a
    path of cost ``most`` (Ukkonen's band); the audit is read from its first cell on.
    """
    m, n = len(turns), len(target)

    def drift(k: int) -> int:
        return INSERT * k if k > 0 else -DELETE * k

    band = [k for k in range(-m, n + 1) if drift(k) + drift(n - m - k) <= most]
    if not band or not band[0] <= 0 <= band[-1]:
        return None
    low, high = band[0], band[-1]
    width = high - low + 1
    last = [_FAR] * (width + 1)
    if low <= n - m <= high:
        last[n - m - low] = 0
    table = [last]
    for i in range(m - 1, -1, -1):
        turn, below = turns[i], table[-1]
        role, extra = turn.lower(), TRUNCATED * turn.isupper()
        row = [_FAR] * (width + 1)
        for k in range(min(high, n - i), max(low, -i) - 1, -1):
            j, at = i + k, k - low
            best = below[at - 1] + DELETE if at else _FAR
            if j < n:
                wanted = target[j]
                if wanted != "s":
                    best = min(best, row[at + 1] + INSERT)
                if turn != "x" and (role == wanted or wanted != "s"):
                    best = min(best, below[at] + extra + REROLE * (role != wanted))
            row[at] = best
        table.append(row)
    table.reverse()
    if table[0][-low] > most:
        return None
    i = j = 0
    audit = []
    while i < m:
        turn, at = turns[i], j - i - low
        left = table[i][at]
        if at and table[i + 1][at - 1] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < n and target[j] != "s" and table[i][at + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turn.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return table[0][-low], "".join(audit)


def _best_by_end(turns: str, first: str) -> dict[str, tuple[int, str]]:
    """Per last letter of the target ("" for the empty one) the cheapest alignment of
    ``turns`` to any target that begins with ``first``, ties by audit."""
    found: dict[str, tuple[int, str]] = {}
    m, forced = len(turns), turns.count("x")
    for end in ("", "s", "u", "a"):
        lengths = [n for n in range(2 * m + 4) if _target(first, n)[-1:] == end]
        if not lengths:
            continue
        most = min(_straight(turns, _target(first, n)) for n in lengths)
        best = None
        # Lengths far from the turns cost more than the incumbent by their distance alone.
        for n in sorted(lengths, key=lambda n: _least_cost(m, forced, n)):
            if _least_cost(m, forced, n) > most:
                break
            aligned = _aligned(turns, _target(first, n), most)
            if aligned and (best is None or aligned < best):
                best, most = aligned, aligned[0]
        if best:
            found[end] = best
    return found


@lru_cache(maxsize=20_000)
def block_table(turns: str) -> dict[tuple[int, int], tuple[int, str]]:
    """``{(state before, state after): (cost, audit)}`` of a block of turns."""
    ends = {first: _best_by_end(turns, first) for first in "sua"}
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for before, firsts in ((START, "su"), (SYSTEM, "u"), (USER, "a"), (ASSISTANT, "u")):
        for first in firsts:
            for end, aligned in ends[first].items():
                key = before, _STATE_OF.get(end, before)
                found[key] = min(found.get(key, aligned), aligned)
    return found


def advance(
    paths: dict[int, tuple[int, str]], table: dict[tuple[int, int], tuple[int, str]]
) -> dict[int, tuple[int, str, int, str]]:
    """The best paths after one more block, by state: cost, audit, and the state and the
    block's audit that they came by."""
    found: dict[int, tuple[int, str, int, str]] = {}
    for (before, after), (cost, audit) in table.items():
        if before in paths:
            path = (paths[before][0] + cost, paths[before][1] + audit, before, audit)
            if after not in found or path[:2] < found[after][:2]:
                found[after] = path
    return found


def ended(paths: dict[int, tuple[int, str]]) -> tuple[int, str, int]:
    """Cost and audit of the best path with its ending, and the state it ends from."""
    return min((c + ENDING[s][0], audit + ENDING[s][1], s) for s, (c, audit) in paths.items())


def align(turns: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    paths = {START: (0, "")}
    for k in range(0, len(turns), BLOCK_TURNS):
        paths = {s: p[:2] for s, p in advance(paths, block_table(turns[k : k + BLOCK_TURNS])).items()}
    return ended(paths)[:2]
