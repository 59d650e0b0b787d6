"""Cheapest edits that turn a run of chat turns into ``(s?(ua)+)?``: alignment with every feasible target length.

A conversation is cut into segments.  The alternating grammar has four states - nothing yet, after the system turn,
after a user turn, after an assistant turn - so what a segment does to a conversation is known once its best edits from
every state to every state are: segments of a conversation are aligned independently and chained afterwards.  Edits are
written by their initials: D (delete, 3), I (insert, 2), K (keep, 0), R (rerole, 2); a truncated turn that stays adds 1.
"""

from __future__ import annotations

from typing import NamedTuple

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: States: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
NO = 1 << 40
#: Inserts that end a conversation from each state.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


class Turn(NamedTuple):
    """What alignment needs of a turn: its role's initial, whether it must go, and whether it is truncated."""

    initial: str
    gone: bool
    truncated: bool


def _targets(state: int, length: int) -> list[tuple[str, int]]:
    """Strings of a length that the grammar allows from a state on, with the state after each."""
    if not length:
        return [("", state)]
    first = "au" if state == USER else "ua"
    plain = (first * length)[:length]
    out = [(plain, USER if plain[-1] == "u" else ASSISTANT)]
    if state == START:
        after = ("s" + plain)[:length]
        out.append((after, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[after[-1]]))
    return out


def _greedy(turns: list[Turn], state: int) -> tuple[int, int]:
    """Cost and state of keeping what fits, inserting before what fits one place later, giving the rest a new role."""
    cost = 0
    for turn in turns:
        wanted = "a" if state == USER else "u"
        if turn.initial == wanted or (turn.initial == "s" and state == START):
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[turn.initial]
        elif turn.initial in ("u", "a"):
            cost += INSERT
            state = USER if turn.initial == "u" else ASSISTANT
        else:
            cost += REROLE
            state = USER if wanted == "u" else ASSISTANT
        cost += TRUNCATED * turn.truncated
    return cost, state


def _align(turns: list[Turn], target: str, limit: int, base: int) -> tuple[int, str] | None:
    """Least cost of aligning turns with a target and the ASCII-least edits of that cost; None beyond ``limit``.

    ``table[i][j - i - low]`` is the cost of turns i.. against target j..; cells that lie so far off both corners that
    their inserts and deletes alone exceed the limit are never filled.  The last edit always consumes a turn.
    """
    n, m = len(turns), len(target)
    shift = m - n
    room = limit - base - 2 * abs(shift)
    if room < 0:
        return None
    low, high = min(0, shift) - room // 4, max(0, shift) + room // 4
    width = high - low + 1
    below = [NO] * (width + 1)
    below[shift - low] = 0
    table = [below]
    for i in range(n - 1, -1, -1):
        turn = turns[i]
        extra = TRUNCATED if turn.truncated else 0
        row = [NO] * (width + 1)
        for k in range(width - 1, -1, -1):
            j = i + low + k
            if j < 0 or j > m:
                continue
            best = below[k - 1] + DELETE if k else NO
            if j < m:
                wanted = target[j]
                cost = row[k + 1] + INSERT if wanted != "s" else NO
                if cost < best:
                    best = cost
                if turn.initial == wanted:
                    cost = below[k] + extra
                elif wanted != "s":
                    cost = below[k] + extra + REROLE
                else:
                    cost = NO
                if cost < best:
                    best = cost
            row[k] = best
        table.append(row)
        below = row
    table.reverse()
    total = table[0][-low]
    if total > limit:
        return None
    edits, i, j = [], 0, 0
    while i < n:
        k, left = j - i - low, table[i][j - i - low]
        turn = turns[i]
        extra = TRUNCATED if turn.truncated else 0
        if k and table[i + 1][k - 1] + DELETE == left:
            edits.append("D")
            i += 1
        elif j < m and target[j] != "s" and table[i][k + 1] + INSERT == left:
            edits.append("I")
            j += 1
        else:
            edits.append("K" if turn.initial == target[j] and table[i + 1][k] + extra == left else "R")
            i, j = i + 1, j + 1
    return total, "".join(edits)


def _woven(turns: list[Turn], edits: str) -> str:
    """The edits with a D for each turn that must go, before any insert at the same place."""
    out, at = [], 0
    for turn in turns:
        if turn.gone:
            out.append("D")
            continue
        while edits[at] == "I":
            out.append("I")
            at += 1
        out.append(edits[at])
        at += 1
    return "".join(out)


def best_edits(turns: list[Turn], state: int) -> dict[int, tuple[int, str]]:
    """For each state that a segment can end in from ``state``: least cost and ASCII-least edits.

    Target lengths are tried from the nearest to the number of turns outwards; the cost found so far (at first that of
    a greedy repair) bounds the band of the next alignment and ends the search when inserts or deletes alone cost more.
    """
    stay = [turn for turn in turns if not turn.gone]
    forced = DELETE * (len(turns) - len(stay))
    base = TRUNCATED * sum(turn.truncated for turn in stay)
    n = len(stay)
    greedy, end = _greedy(stay, state)
    limits = {to: DELETE * n if to == state else NO for to in range(4)}
    if n:
        # one more edit moves the greedy repair to the other of the two states that alternate
        for to in (USER, ASSISTANT):
            limits[to] = min(limits[to], greedy + (0 if to == end else DELETE + REROLE))
        if state == START:
            limits[SYSTEM] = min([DELETE * (n - 1) + TRUNCATED * turn.truncated for turn in stay if turn.initial == "s"], default=NO)
    found: dict[int, tuple[int, str]] = {}
    for far in range(n * 2 + 3):
        if all(base + 2 * far > limit for limit in limits.values() if limit < NO):
            break
        for length in {n - far, n + far}:
            if length < 0:
                continue
            for target, to in _targets(state, length):
                if limits[to] >= NO:
                    continue
                result = _align(stay, target, limits[to], base)
                if result and (to not in found or result < found[to]):
                    found[to] = result
                    limits[to] = result[0]
    return {to: (cost + forced, _woven(turns, edits)) for to, (cost, edits) in found.items()}


def chain(tables: list[dict[int, dict[int, tuple[int, int]]]]) -> list[tuple[int, int]]:
    """The states (before, after) of each segment of a conversation, in order, on its cheapest ASCII-least way.

    Each table gives, by the state before and the state after, the cost and the rank of the edits among those from the
    same state.  Edits of a segment end with a turn, so none begins with all of another and ranks decide.
    """
    rest = [{state: INSERT * len(tail) for state, tail in TAIL.items()}]
    for table in reversed(tables):
        after = rest[-1]
        rest.append({state: min((cost + after[to] for to, (cost, _) in ways.items()), default=NO) for state, ways in table.items()})
    rest.reverse()
    state, out = START, []
    for k, table in enumerate(tables):
        ways = table[state]
        to = min((to for to, (cost, _) in ways.items() if cost + rest[k + 1][to] == rest[k][state]), key=lambda to: ways[to][1])
        out.append((state, to))
        state = to
    return out
