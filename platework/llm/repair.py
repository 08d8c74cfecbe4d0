"""The cheapest repair of a conversation's turns: bidirectional Dijkstra over the lattice of rows read and grammar state.

A conversation of any length is cut into chunks of ``CHUNK`` rows. A chunk inside a conversation yields the cheapest edits
between each pair of states, so that chunks are solved apart from each other and joined by their costs afterwards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from itertools import product

#: Rows of a chunk; bounds the lattice that a search holds.
CHUNK = 1024
#: Edits: what they cost. A truncated row that is not deleted costs one more.
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: A row's sign: its role (system, user, assistant, other) and its first fault (none, truncated, blank, duplicate).
ROLES, FAULTS = "sua", ("", "truncated", "blank", "duplicate")
SIGNS = "ABCDEFGHIJKLMNOP"
#: States after what was written: nothing, the system's turn, a user's, an assistant's. A user's turn follows all but
#: its own kind; a conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
_WRITES = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_READS = {START: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
ENDS = (START, ASSISTANT)
_WRITTEN_FROM = {t: [s for s in range(4) if _WRITES[s] == t] for t in range(4)}

Found = tuple[int, str]


def sign(role: str, fault: int) -> str:
    """``role``'s first letter decides; ``fault`` is a place in ``FAULTS``."""
    at = ROLES.find(role[:1]) if role else -1
    return SIGNS[4 * (at if at >= 0 else 3) + fault]


def _row(letter: str) -> tuple[int, bool, int]:
    role, fault = divmod(SIGNS.index(letter), 4)
    return role, fault >= 2, int(fault == 1)


def _onward(rows, node):
    at, state = node
    if at < len(rows):
        role, gone, more = rows[at]
        if not gone:
            if role in _READS[state]:
                yield KEEP + more, "K", (at + 1, _READS[state][role])
            yield REROLE + more, "R", (at + 1, _WRITES[state])
        yield DELETE, "D", (at + 1, state)
    yield INSERT, "I", (at, _WRITES[state])


def _backward(rows, node):
    at, state = node
    if at:
        role, gone, more = rows[at - 1]
        if not gone:
            for before in range(4):
                if _READS[before].get(role) == state:
                    yield KEEP + more, "K", (at - 1, before)
            for before in _WRITTEN_FROM[state]:
                yield REROLE + more, "R", (at - 1, before)
        yield DELETE, "D", (at - 1, state)
    for before in _WRITTEN_FROM[state]:
        yield INSERT, "I", (at, before)


def cheapest(signs: str, entry: int, exits: Iterable[int]) -> Found | None:
    """Least cost, and of the audits with that cost the least in ASCII order, from ``entry`` before the first row to one
    of ``exits`` after the last; None where no edits lead there.

    Two searches meet. Nodes of equal cost are settled in the order of their rows, the reverse ones from the end, as
    keeping costs nothing: then a settled node's audit is the least of all with its cost. The searches go on until no
    crossing can cost as little as the best one, so that all crossings of that cost are seen.
    """
    rows = [_row(x) for x in signs]
    size = len(rows)
    best = ({(0, entry): (0, "")}, {(size, s): (0, "") for s in exits})
    heaps = [[(0, 0, entry)], [(0, 0, s) for s in exits]]
    heapq.heapify(heaps[1])
    settled = (set(), set())
    least = float("inf")
    for node in best[0].keys() & best[1].keys():
        least = 0
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= least:
        side = int(heaps[1][0][0] < heaps[0][0][0])
        cost, rank, state = heapq.heappop(heaps[side])
        node = (size - rank if side else rank, state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = best[side][node][1]
        for more, letter, to in (_backward if side else _onward)(rows, node):
            new = (cost + more, letter + audit if side else audit + letter)
            old = best[side].get(to)
            if old is None or new < old:
                best[side][to] = new
                if old is None or new[0] < old[0]:
                    heapq.heappush(heaps[side], (new[0], size - to[0] if side else to[0], to[1]))
                if (other := best[1 - side].get(to)) is not None:
                    least = min(least, new[0] + other[0])
    crossings = (
        (f[0] + b[0], f[1] + b[1]) for node, f in best[0].items() if (b := best[1].get(node)) is not None)
    return min((x for x in crossings if x[0] == least), default=None)


def transfers(signs: str, whole: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a chunk: for a ``whole`` conversation from its start to its end, else between all
    states between which edits lead."""
    if whole:
        found = cheapest(signs, START, ENDS)
        return [(START, ASSISTANT, *found)]
    found = ((a, b, cheapest(signs, a, (b,))) for a, b in product(range(4), repeat=2))
    return [(a, b, *x) for a, b, x in found if x is not None]


class Joined:
    """Chunks of one conversation, joined in their order: per state the cheapest way there, least audit first. Ways share
    their beginnings, so that memory is that of the chunks' audits."""

    def __init__(self):
        self.ways = {START: (0, None, "")}

    def add(self, chunk: list[tuple[int, int, int, str]]) -> None:
        new = {}
        for entry, leave, cost, audit in chunk:
            if (before := self.ways.get(entry)) is not None:
                way = (before[0] + cost, before, audit)
                if leave not in new or self._less(way, new[leave]):
                    new[leave] = way
        self.ways = new

    def result(self) -> tuple[int, list[str]]:
        """Cost and audit, the latter in pieces."""
        found = None
        for state in ENDS:
            way = self.ways.get(state)
            if way is not None and (found is None or self._less(way, found)):
                found = way
        pieces, way = [], found
        while way is not None:
            pieces.append(way[2])
            way = way[1]
        return found[0], pieces[::-1]

    @staticmethod
    def _less(one, other) -> bool:
        if one[0] != other[0]:
            return one[0] < other[0]
        a, b = [], []
        while one is not other:
            a.append(one[2])
            b.append(other[2])
            one, other = one[1], other[1]
        return "".join(reversed(a)) < "".join(reversed(b))


class Written:
    """Applies an audit to rows one by one: each step gives the turns that are written."""

    NAMES = {USER: "user", ASSISTANT: "assistant"}

    def __init__(self, pieces: Iterable[str]):
        self.letters = (x for piece in pieces for x in piece)
        self.state = START

    def _insert(self):
        self.state = _WRITES[self.state]
        return self.NAMES[self.state], ""

    def row(self, role: str, text: str):
        """What the edits before and at this row write: (role, text) each."""
        for letter in self.letters:
            if letter == "I":
                yield self._insert()
                continue
            if letter == "K":
                self.state = _READS[self.state][ROLES.index(role[0])]
                yield role, text
            elif letter == "R":
                self.state = _WRITES[self.state]
                yield self.NAMES[self.state], text
            return

    def rest(self):
        """What is inserted after the last row."""
        for _ in self.letters:
            yield self._insert()
