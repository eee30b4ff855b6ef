"""Cheapest repair of a sequence of roles under a grammar: generalised LR over a graph of stacks.

All stacks that an edited prefix can lead to are kept side by side as nodes (state, node below).
Equal tops are merged: the smaller (cost, audit) stays. An audit has one letter an edit: D delete,
I insert, K keep, R rerole. Inserts stand before the row they precede or at the end, so
of two audits over the same rows neither is the beginning of the other, and their order never
changes as edits are added. It is enough to keep the order, not the audits.
"""

from __future__ import annotations

from collections.abc import Sequence

#: The grammar of ``(s?(ua)+)?`` by initials of roles, and the edits' costs.
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
INITIALS = "sua"
#: What a row allows: anything, anything at a truncated text's cost, or its deletion only.
FINE, CUT, GONE = 0, 1, 2

#: Tops in the order of their audits: (node, cost over the base).
Tops = tuple[tuple[int, int], ...]
#: For each top, in order: the place of the top it came from, the edits, and the roles they give.
Trail = tuple[tuple[int, str, str], ...]


def row_code(initial: str, fault: int) -> int:
    """A row as a small number: its role's initial and what it allows."""
    at = INITIALS.find(initial) if initial else -1
    return 3 * (at if at >= 0 else 3) + fault


class RoleRepair:
    """The tables of the grammar, the nodes of its stacks, and the steps met so far."""

    def __init__(self, rules: Sequence[tuple[str, str]] = RULES):
        self.rules = [("S", rules[0][0]), *rules]
        self.heads = {head for head, _ in self.rules}
        self.follow = self._follow()
        self.states = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        symbols = sorted({x for _, body in self.rules for x in body})
        for state, items in enumerate(self.states):  # grows while it is walked
            for x in symbols:
                moved = {(r, d + 1) for r, d in items if self.rules[r][1][d : d + 1] == x}
                if moved:
                    target = self._closure(moved)
                    if target not in self.states:
                        self.states.append(target)
                    self.goto[state, x] = self.states.index(target)
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.shifts: dict[tuple[int, str], tuple[int, ...]] = {}
        for node, _ in enumerate(self.nodes):  # every stack that is ever a top, in a fixed order
            for x in INITIALS:
                self.shift(node, x)
        self.size = len(self.nodes)  # what accepting adds is never a top
        self.inserts = [[(x, n) for x in "ua" for n in self.shift(k, x)] for k in range(self.size)]
        self.ends = [self._accepts(k) for k in range(self.size)]
        self.known: dict[tuple[Tops, int], tuple[Tops, int, Trail]] = {}

    def _follow(self) -> dict[str, set[str]]:
        empty = {h for h, body in self.rules if not body}
        first: dict[str, set[str]] = {h: set() for h in self.heads}
        follow: dict[str, set[str]] = {h: set() for h in self.heads}
        follow["S"].add("$")
        while True:
            before = sum(map(len, [*first.values(), *follow.values()]))
            for head, body in self.rules:
                if all(x in empty for x in body):
                    empty.add(head)
                for k, x in enumerate(body):
                    if all(y in empty for y in body[:k]):
                        first[head] |= first.get(x, {x})
                    if x in self.heads:
                        rest = body[k + 1 :]
                        for j, y in enumerate(rest):
                            follow[x] |= first.get(y, {y})
                            if y not in empty:
                                break
                        if all(y in empty for y in rest):
                            follow[x] |= follow[head]
            if before == sum(map(len, [*first.values(), *follow.values()])):
                return follow

    def _closure(self, items: set[tuple[int, int]]) -> frozenset:
        todo, found = list(items), set(items)
        while todo:
            rule, dot = todo.pop()
            ahead = self.rules[rule][1][dot : dot + 1]
            for k, (head, _) in enumerate(self.rules):
                if head == ahead and (k, 0) not in found:
                    found.add((k, 0))
                    todo.append((k, 0))
        return frozenset(found)

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self.nodes:
            self.nodes.append((state, below))
        return self.nodes.index((state, below))

    def _reduced(self, node: int, ahead: str) -> set[int]:
        """The node and all it reduces to before ``ahead``."""
        found, todo = {node}, [node]
        while todo:
            at = todo.pop()
            for rule, dot in self.states[self.nodes[at][0]]:
                head, body = self.rules[rule]
                if dot < len(body) or ahead not in self.follow[head] or head == "S":
                    continue
                below = at
                for _ in body:
                    below = self.nodes[below][1]
                new = self._node(self.goto[self.nodes[below][0], head], below)
                if new not in found:
                    found.add(new)
                    todo.append(new)
        return found

    def shift(self, node: int, symbol: str) -> tuple[int, ...]:
        """Tops after ``symbol`` is read on ``node``; none if the grammar does not allow it."""
        if (node, symbol) not in self.shifts:
            tops = []
            for at in sorted(self._reduced(node, symbol)):
                state = self.goto.get((self.nodes[at][0], symbol))
                if state is not None:
                    tops.append(self._node(state, at))
            self.shifts[node, symbol] = tuple(tops)
        return self.shifts[node, symbol]

    def _accepts(self, node: int) -> bool:
        return any((0, 1) in self.states[self.nodes[k][0]] for k in self._reduced(node, "$"))

    def _with_inserts(self, tops: Tops) -> dict[int, tuple[int, int, str, str]]:
        """For each node the least (cost, place, edits, roles) by inserts alone."""
        best = {node: (cost, place, "", "") for place, (node, cost) in enumerate(tops)}
        todo = list(best)
        while todo:
            node = todo.pop()
            cost, place, edits, roles = best[node]
            for role, new in self.inserts[node]:
                entry = (cost + INSERT, place, edits + "I", roles + role)
                if new not in best or entry < best[new]:
                    best[new] = entry
                    todo.append(new)
        return best

    def step(self, tops: Tops, code: int) -> tuple[Tops, int, Trail]:
        """The tops after one row, what their least cost has grown by, and where they came from."""
        known = self.known.get((tops, code))
        if known is not None:
            return known
        initial, fault = code // 3, code % 3
        best: dict[int, tuple[int, int, str, str]] = {}
        for node, (cost, place, edits, roles) in self._with_inserts(tops).items():
            found = [(node, cost + DELETE, "D", "-")]
            if fault != GONE:
                more = TRUNCATED * (fault == CUT)
                if initial < len(INITIALS):
                    x = INITIALS[initial]
                    found += [(n, cost + more, "K", x) for n in self.shift(node, x)]
                found += [
                    (n, cost + more + REROLE, "R", x) for x in "ua" for n in self.shift(node, x)
                ]
            for new, total, edit, role in found:
                entry = (total, place, edits + edit, roles + role)
                if new not in best or entry < best[new]:
                    best[new] = entry
        ordered = sorted(best.items(), key=lambda kv: kv[1][1:])
        base = min(entry[0] for _, entry in ordered)
        after = tuple((node, entry[0] - base) for node, entry in ordered)
        known = after, base, tuple(entry[1:] for _, entry in ordered)
        self.known[tops, code] = known
        return known

    def run(self, codes: bytes, node: int = 0) -> tuple[Tops, int, list[Trail]]:
        """All rows from the stack ``node`` on: the tops, their base cost, and the way there."""
        tops: Tops = ((node, 0),)
        cost, trail, known = 0, [], self.known
        for code in codes:
            found = known.get((tops, code)) or self.step(tops, code)
            tops = found[0]
            cost += found[1]
            trail.append(found[2])
        return tops, cost, trail

    def finish(self, tops: Tops) -> tuple[int, int, str, str]:
        """(cost, place, edits, roles) of the best end: inserts until the grammar accepts."""
        return min(e for node, e in self._with_inserts(tops).items() if self.ends[node])

    @staticmethod
    def way(trail: Sequence[Trail], place: int) -> tuple[list[str], list[str]]:
        """Edits and roles of every row on the way to the top at ``place``."""
        edits, roles = [], []
        for step in reversed(trail):
            place, letters, given = step[place]
            edits.append(letters)
            roles.append(given)
        return edits[::-1], roles[::-1]
