"""Cheapest audits of a conversation as a persistent dynamic programme.

A row is one symbol: the initial of its role (s, u, a, or o for any other), a capital if its text is
truncated, or x if it has to go. The programme's state is what the repaired rows end with: nothing, s, u or
a. Each state keeps its cost and one node, whose path from the root spells the edits so far; equal
prefixes share their nodes. A node has its parent, a jump to a far ancestor (binary lifting with one
pointer a node, whose length depends on the depth alone) and the rolling hash of its path. Of equal costs the
path of least letters stays: the longest common prefix of two paths is found by lifting both while
their hashes differ, and checked on the nodes themselves, so that a collision changes nothing.

Edits are D (delete), I (insert), K (keep) and R (rerole). Inserts stand before a row or at the end,
so paths over the same rows are never prefixes of one another. Blocks of rows can therefore be
solved apart, from every state, and chained: of two paths that differ before a block the
earlier part decides, and equal parts lead to one state.
"""

from __future__ import annotations

from array import array
from functools import cmp_to_key, lru_cache

STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Conversations of so many rows or fewer are remembered by their symbols.
REMEMBERED_ROWS, REMEMBERED = 64, 1 << 16
_BASE, _PRIME = 911_382_323, (1 << 61) - 1
_NONE = (1 << 60, -1)
_TURNS = (START, SYSTEM, ASSISTANT)  # states that a user row may follow


class Paths:
    """A tree of edits: node 0 is the root."""

    def __init__(self) -> None:
        self.parent, self.jump, self.depth = array("q", [0]), array("q", [0]), array("q", [0])
        self.hash, self.letter = array("q", [0]), bytearray(b" ")

    def add(self, node: int, letter: str) -> int:
        over = self.jump[node]
        level = self.depth
        even = level[node] - level[over] == level[over] - level[self.jump[over]]
        self.parent.append(node)
        self.jump.append(self.jump[over] if even else node)
        level.append(level[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % _PRIME)
        self.letter.append(ord(letter))
        return len(level) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            over = self.jump[node]
            node = over if self.depth[over] >= depth else self.parent[node]
        return node

    def spelled(self, node: int) -> str:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return out[::-1].decode()

    def _same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth spell the same, by their letters down to the node they share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def compare(self, a: int, b: int) -> int:
        """Negative if a's path is less than b's in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        h, up, far = self.hash, self.parent, self.jump
        if h[x] == h[y] and self._same(x, y):
            return self.depth[a] - self.depth[b]
        low, high = x, y
        while h[up[x]] != h[up[y]]:
            if h[far[x]] != h[far[y]]:
                x, y = far[x], far[y]
            else:
                x, y = up[x], up[y]
        if self.letter[x] != self.letter[y] and self._same(up[x], up[y]):
            return self.letter[x] - self.letter[y]
        one, two = self.spelled(low), self.spelled(high)  # hashes collided
        return -1 if one < two else 1


def _better(paths: Paths, a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    if a[1] < 0 or b[1] < 0 or a[1] == b[1]:
        return a if b[1] < 0 else b
    return a if paths.compare(a[1], b[1]) < 0 else b


def _best(paths: Paths, stay: tuple[int, int], steps: list[tuple[int, int, str]]) -> tuple[int, int]:
    """The best of an entry and of (cost, node, letter) steps; only steps of least cost become nodes."""
    least = min([stay[0], *(s[0] for s in steps)])
    if least >= _NONE[0]:
        return _NONE
    found = stay if stay[0] == least else _NONE
    for cost, node, letter in steps:
        if cost == least:
            found = _better(paths, found, (cost, paths.add(node, letter)))
    return found


def _inserted(paths: Paths, at: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Entries after the inserts that may stand here; more than two in a row never pay."""
    user = _best(paths, at[USER], [(at[q][0] + INSERT, at[q][1], "I") for q in _TURNS])
    assistant = _best(paths, at[ASSISTANT], [(user[0] + INSERT, user[1], "I")])
    return [at[START], at[SYSTEM], user, assistant]


def _over(paths: Paths, at: list[tuple[int, int]], symbol: str) -> list[tuple[int, int]]:
    """Entries after one row."""
    at = _inserted(paths, at)
    steps: list[list[tuple[int, int, str]]] = [[(at[q][0] + DELETE, at[q][1], "D")] for q in range(STATES)]
    if symbol != "x":
        role, more = symbol.lower(), TRUNCATED * symbol.isupper()
        if role == "s":
            steps[SYSTEM].append((at[START][0] + KEEP + more, at[START][1], "K"))
        for before, after, own in (*((q, USER, "u") for q in _TURNS), (USER, ASSISTANT, "a")):
            # A row that can be kept is never cheaper reroled to the same end.
            cost, letter = (KEEP, "K") if role == own else (REROLE, "R")
            steps[after].append((at[before][0] + cost + more, at[before][1], letter))
    return [_best(paths, _NONE, s) for s in steps]


def solved(symbols: str, start: int = START) -> tuple[Paths, list[tuple[int, int]]]:
    """The tree and each state's (cost, node) after all rows, from one state."""
    paths = Paths()
    at = [(0, 0) if q == start else _NONE for q in range(STATES)]
    for symbol in symbols:
        at = _over(paths, at, symbol)
    return paths, at


def _audit(symbols: str) -> tuple[int, str]:
    paths, at = solved(symbols)
    at = _inserted(paths, at)
    cost, node = _better(paths, at[START], at[ASSISTANT])
    return cost, paths.spelled(node)


_remembered = lru_cache(REMEMBERED)(_audit)


def audit(symbols: str) -> tuple[int, str]:
    """Least cost and least edits that make a conversation of these rows legal."""
    return _remembered(symbols) if len(symbols) <= REMEMBERED_ROWS else _audit(symbols)


def summary(symbols: str) -> tuple[list[int], list[int]]:
    """For each state before and after a block: the cost, -1 if there is no way, and the place of its edits among those from the same state."""
    costs, places = [-1] * STATES**2, [-1] * STATES**2
    for start in range(STATES):
        paths, at = solved(symbols, start)
        reached = [q for q in range(STATES) if at[q][1] >= 0]
        reached.sort(key=cmp_to_key(lambda a, b, p=paths, e=at: p.compare(e[a][1], e[b][1])))
        for place, q in enumerate(reached):
            costs[start * STATES + q], places[start * STATES + q] = at[q][0], place
    return costs, places


def chain(blocks: list[tuple[list[int], list[int]]]) -> tuple[int, list[int], str]:
    """Least cost over all blocks, the state before each and after the last, and the inserts at the end."""
    at = {START: (0, 0)}  # cost and place of the edits among those of all states
    back: list[dict[int, int]] = []
    for costs, places in blocks:
        best: dict[int, tuple[int, int, int, int]] = {}
        for before, (cost, place) in at.items():
            for after in range(STATES):
                own = costs[before * STATES + after]
                if own >= 0:
                    way = (cost + own, place, places[before * STATES + after], before)
                    best[after] = min(best.get(after, way), way)
        order = sorted(best, key=lambda q, b=best: b[q][1:3])
        at = {q: (best[q][0], order.index(q)) for q in best}
        back.append({q: best[q][3] for q in best})
    tails = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    cost, _, state = min((cost + INSERT * len(tails[q]), place, q) for q, (cost, place) in at.items())
    states = [state]
    for step in reversed(back):
        states.append(step[states[-1]])
    return cost, states[::-1], tails[state]


def fragment(symbols: str, before: int, after: int) -> str:
    """The edits of one block between two states."""
    paths, at = solved(symbols, before)
    return paths.spelled(at[after][1])


def follow(state: int, letter: str, symbol: str = "") -> tuple[int, str | None]:
    """The state after an edit, and the role that the edit gives its row (None: its own, or no row)."""
    if letter == "D":
        return state, None
    if letter == "K":
        return {"s": SYSTEM, "u": USER, "a": ASSISTANT}[symbol.lower()], None
    return (ASSISTANT, "assistant") if state == USER else (USER, "user")
