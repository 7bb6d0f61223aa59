"""Cheapest edits of a sequence of turns, with edit sequences shared as linked nodes.

A node is an edit sequence: its last edit, its parent, its length, a rolling hash of the whole sequence,
and its ancestors 1, 2, 4, ... edits up. Extending a sequence costs one node, whatever its length, and old
sequences stay valid. Two sequences of equal cost compare at the first edit in which they differ: both are
lifted to equal length, then as long as their hashes differ by the largest powers of two. Equal
hashes are no proof, so the common part is verified edit by edit up to a node that both share or a pair verified before.

The roles that remain must spell ``(s?(ua)+)?``. States: 0 nothing yet, 1 after the system turn, 2 after a
user, 3 after an assistant. In every state one role only may come next by inserting or rewriting, so
the edits alone tell the result, and no sequence can be a proper prefix of an equally cheap one in the same state:
the rest would be insertions, which cost.

Where all live sequences share their beginning, that beginning is final. ``Audit`` gives it away
from time to time, so memory follows the undecided end. That is short unless the last row can still
decide about the first, as where every role is unknown and the number of rows tells which of them goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: An undeleted truncated row costs this more.
TRUNCATED_COST = 1
#: The role that may be inserted or written in each state, and the state after it.
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: State after keeping a row with this initial.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
FINAL = (0, 3)

_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class EditTree:
    """All edit sequences of one conversation; node 0 is the empty one."""

    def __init__(self) -> None:
        self.edit, self.row, self.role = [""], [None], [""]
        self.depth, self.hash = [0], [0]
        self.up: list[tuple[int, ...]] = [()]
        self._same: set[tuple[int, int]] = set()

    def extend(self, parent: int, edit: str, row: Any = None, role: str = "") -> int:
        """The sequence of ``parent`` with one more edit of ``row``; ``role`` is the one written."""
        node, ups, up = len(self.edit), [parent], self.up
        while len(ups) <= len(up[ups[-1]]):
            ups.append(up[ups[-1]][len(ups) - 1])
        up.append(tuple(ups))
        self.edit.append(edit)
        self.row.append(row)
        self.role.append(role)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _PRIME)
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` with ``depth`` edits."""
        steps = self.depth[node] - depth
        while steps:
            bit = steps.bit_length() - 1
            node = self.up[node][bit]
            steps -= 1 << bit
        return node

    def _verified(self, a: int, b: int) -> bool:
        """Whether two nodes of equal depth and hash stand for the same edits."""
        passed = []
        while a != b:
            if (a, b) in self._same:
                break
            if self.edit[a] != self.edit[b]:
                return False
            passed.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        self._same.update(passed)
        return True

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix of two sequences."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self.lifted(a, depth), self.lifted(b, depth)
        if a == b:
            return depth
        if self.hash[a] != self.hash[b]:
            for bit in range(len(self.up[a]) - 1, -1, -1):
                if bit < len(self.up[a]) and self.hash[self.up[a][bit]] != self.hash[self.up[b][bit]]:
                    a, b = self.up[a][bit], self.up[b][bit]
            a, b = self.up[a][0], self.up[b][0]
        if self._verified(a, b):
            return self.depth[a]
        # Different edits with equal hashes: the plain way.
        parts = zip(self.path(a), self.path(b))
        return next(i for i, (x, y) in enumerate(parts) if self.edit[x] != self.edit[y])

    def path(self, node: int, above: int = 0) -> list[int]:
        """The nodes of a sequence in order, without those up to depth ``above``."""
        nodes = []
        while self.depth[node] > above:
            nodes.append(node)
            node = self.up[node][0]
        return nodes[::-1]

    def less(self, a: int, edit_a: str, b: int, edit_b: str) -> bool:
        """Whether ``a`` and then ``edit_a`` is ASCII-less than ``b`` and then ``edit_b``."""
        if a == b:
            return edit_a < edit_b
        shared, da, db = self.common(a, b), self.depth[a], self.depth[b]
        at_a = edit_a if shared == da else self.edit[self.lifted(a, shared + 1)]
        at_b = edit_b if shared == db else self.edit[self.lifted(b, shared + 1)]
        return (at_a, da) < (at_b, db)


class Audit:
    """Edits rows as they come; ``rows`` are given back with the edits chosen for them."""

    #: Nodes after which the shared beginning is given away.
    LIMIT = 20_000

    def __init__(self, limit: int = LIMIT):
        self._limit = limit
        self._tree = EditTree()
        #: By state: cost and node of the best sequence so far.
        self._best: dict[int, tuple[int, int]] = {0: (0, 0)}

    def _with_insertions(self) -> dict[int, tuple[int, int]]:
        """The best sequences when turns may be inserted here; two in a row at most, for more lead back."""
        offers: dict[int, list] = {s: [] for s in range(4)}
        best = dict(self._best)
        for target, sources in ((2, (0, 1, 3)), (3, (2,))):
            for source in sources:
                if source in best:
                    cost, node = best[source]
                    offers[target].append((cost + COSTS[INSERT], node, INSERT, None, NEXT[source][0]))
            best |= self._chosen({target: offers[target]}, best)
        return best

    def _chosen(self, offers: dict[int, list], known: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """By state, the cheapest offer, ties ASCII-least; ``known`` competes with it."""
        tree, best = self._tree, {}
        for state, several in offers.items():
            top = None
            for offer in several:
                if top is None or offer[0] < top[0] or (offer[0] == top[0] and tree.less(offer[1], offer[2], top[1], top[2])):
                    top = offer
            if top is None:
                continue
            cost, node, edit, row, role = top
            old = known.get(state)
            if old and (old[0] < cost or (old[0] == cost and tree.less(old[1], "", node, edit))):
                continue
            best[state] = cost, tree.extend(node, edit, row, role)
        return best

    def add(self, row: Any, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[str, Any, str]]:
        """Take the next row; yields edits that have become final, as (edit, row, role written)."""
        before, offers = self._with_insertions(), {s: [] for s in range(4)}
        more = TRUNCATED_COST if truncated else 0
        for state, (cost, node) in before.items():
            offers[state].append((cost + COSTS[DELETE], node, DELETE, row, ""))
            if must_go:
                continue
            kept = KEPT.get((state, initial))
            if kept is not None:
                offers[kept].append((cost + COSTS[KEEP] + more, node, KEEP, row, ""))
            role, after = NEXT[state]
            offers[after].append((cost + COSTS[REROLE] + more, node, REROLE, row, role))
        self._best = self._without_hopeless(self._chosen(offers, {}))
        if len(self._tree.edit) > self._limit:
            yield from self._give_away()

    @staticmethod
    def _without_hopeless(best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """Leave out sequences whose every end another one reaches for less.

        After an assistant turn everything may follow that may follow at the start or after a system turn, except the
        system turn itself, which can be deleted.
        """
        if 3 not in best and 2 not in best:
            return best
        least = min(best[s][0] + more for s, more in ((3, 0), (2, COSTS[INSERT])) if s in best)
        most = {0: least + COSTS[DELETE], 1: least}
        return {s: b for s, b in best.items() if s not in most or b[0] <= most[s]}

    def _give_away(self) -> Iterator[tuple[str, Any, str]]:
        old, nodes = self._tree, [node for _, node in self._best.values()]
        final = nodes[0]
        for other in nodes[1:]:
            depth = min(old.depth[final], old.depth[other])
            final, other = old.lifted(final, depth), old.lifted(other, depth)
            while final != other:
                bit = max((b for b in range(len(old.up[final])) if old.up[final][b] != old.up[other][b]), default=0)
                final, other = old.up[final][bit], old.up[other][bit]
        for node in old.path(final):
            yield old.edit[node], old.row[node], old.role[node]
        # The undecided ends move to a new tree; what they share stays shared.
        tree, moved = EditTree(), {final: 0}
        for node in nodes:
            for x in old.path(node, old.depth[final]):
                if x not in moved:
                    moved[x] = tree.extend(moved[old.up[x][0]], old.edit[x], old.row[x], old.role[x])
        self._tree = tree
        self._best = {state: (cost, moved[node]) for state, (cost, node) in self._best.items()}
        self._limit = max(self._limit, 2 * len(tree.edit))

    def finish(self) -> tuple[int, list[tuple[str, Any, str]]]:
        """Total cost, and the edits not given away yet."""
        best, tree = self._with_insertions(), self._tree
        self._best = best
        ends = [best[state] for state in FINAL if state in best]
        least = min(cost for cost, _ in ends)
        nodes = [node for cost, node in ends if cost == least]
        last = nodes[0] if len(nodes) == 1 or tree.less(nodes[0], "", nodes[1], "") else nodes[1]
        return least, [(tree.edit[x], tree.row[x], tree.role[x]) for x in tree.path(last)]
