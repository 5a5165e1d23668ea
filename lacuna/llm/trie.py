"""Sets in a prefix tree, and the search for similar ones in it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class Forest:
    """Union-find; the root of a group is its smallest member."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


class Node:
    """A run of tokens shared by all sets below; ``one`` is a set below if all sets below are known to be in its group.

    ``shortest`` and ``longest`` are sizes of sets below, ``reach`` the largest size that any of them can be similar to.
    """

    __slots__ = ("run", "children", "ends", "shortest", "longest", "reach", "one")

    def __init__(self, run: np.ndarray, size: int, reach: int, one: int) -> None:
        self.run, self.shortest, self.longest, self.reach, self.one = run, size, size, reach, one
        self.children: dict[int, Node] = {}
        self.ends: list[int] = []


class SetTrie:
    """Sets of small integers, each sorted; numbers are handed out so that common tokens come first and paths are shared."""

    def __init__(self, sets: Sequence[np.ndarray], reach: Sequence[int], percent: int) -> None:
        self.sets, self.reach, self.percent = sets, reach, percent
        self.forest = Forest(len(sets))
        self.root = Node(np.zeros(0, np.int64), 0, 0, -1)
        self.root.shortest = 1 << 60
        self.inside = np.zeros(1 + max((int(s[-1]) for s in sets if len(s)), default=0), bool)

    def insert(self, k: int) -> None:
        tokens, node, at = self.sets[k], self.root, 0
        size = len(tokens)
        while True:
            node.shortest, node.longest = min(node.shortest, size), max(node.longest, size)
            node.reach = max(node.reach, self.reach[k])
            if node.one >= 0 and self.forest.find(node.one) != self.forest.find(k):
                node.one = -1
            if at == size:
                node.ends.append(k)
                return
            child = node.children.get(int(tokens[at]))
            if child is None:
                leaf = Node(tokens[at:], size, self.reach[k], k)
                leaf.ends.append(k)
                node.children[int(tokens[at])] = leaf
                return
            m = min(len(child.run), size - at)
            differs = child.run[:m] != tokens[at:at + m]
            same = int(differs.argmax()) if differs.any() else m
            if same < len(child.run):
                middle = Node(child.run[:same], child.shortest, child.reach, child.one)
                middle.longest = child.longest
                child.run = child.run[same:]
                middle.children[int(child.run[0])] = child
                node.children[int(tokens[at])] = middle
                child = middle
            node, at = child, at + same

    def link(self, k: int) -> list[tuple[int, int]]:
        """Join set ``k`` with the groups of all similar sets inserted so far; the links that joined groups.

        The walk carries the overlap along shared paths. A subtree is left out when even the tokens that remain cannot
        reach the bound for any size below it, or when everything below is already in the set's own group.
        """
        x, forest, percent = self.sets[k], self.forest, self.percent
        n, reach = len(x), self.reach[k]
        found: list[tuple[int, int]] = []
        self.inside[x] = True
        stack: list[tuple[Node, int, int, bool]] = [(self.root, 0, 0, False)]
        while stack:
            node, depth, overlap, done = stack.pop()
            if done:  # all below has been seen: is it one group now?
                members = [c.one for c in node.children.values()] + node.ends
                if members and min(members) >= 0:
                    first = forest.find(members[0])
                    if all(forest.find(m) == first for m in members):
                        node.one = members[0]
                continue
            if node.one >= 0 and forest.find(node.one) == forest.find(k) or node.reach < n or node.shortest > reach:
                continue
            if len(node.run):
                depth += len(node.run)
                overlap += int(np.count_nonzero(self.inside[node.run]))
                left = n - int(np.searchsorted(x, node.run[-1], "right"))
                size = min(max(depth + left, node.shortest), node.longest)
                if (100 + percent) * (overlap + min(left, size - depth)) < percent * (n + size):
                    continue
            for y in node.ends:
                if (100 + percent) * overlap >= percent * (n + depth) and forest.union(k, y):
                    found.append((y, k))
            if node.children:
                stack.append((node, depth, overlap, True))
                # Paths whose next token is in the set come last here, that is, they are walked first.
                stack += sorted(((c, depth, overlap, False) for c in node.children.values()),
                                key=lambda s: bool(self.inside[s[0].run[0]]))
        self.inside[x] = False
        return found


def promising(place: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which sets can have a similar one, and each one's reach. ``place`` and ``owner`` list the tokens' numbers and their sets.

    Tokens that no other set has cannot be shared, so a set with ``shared`` others has no partner of more than
    ``reach`` tokens, and a pair must lie in each other's reach. Sets without one go, which leaves more tokens to one set
    alone; this is repeated until nothing changes.
    """
    alive = np.ones(len(sizes), bool)
    while True:
        kept = alive[owner]
        times = np.bincount(place[kept], minlength=int(place.max()) + 1)
        shared = np.bincount(owner[kept][times[place[kept]] > 1], minlength=len(sizes))
        reach = (100 + percent) * shared // percent - sizes
        index = np.flatnonzero(alive)
        order = index[np.argsort(sizes[index], kind="stable")]
        best = np.maximum.accumulate(reach[order])  # largest reach of any set up to this size
        upto = np.searchsorted(sizes[order], reach[index], "right") - 1
        good = (upto >= 0) & (best[np.maximum(upto, 0)] >= sizes[index])
        if good.all():
            return alive, reach
        alive[index[~good]] = False
        if not alive.any():
            return alive, reach


def similar_links(sets: Sequence[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all sets of each group of similar ones, by position in ``sets`` (arrays of distinct tokens)."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
    alive, reach = promising(place, owner, sizes, percent)
    members = np.flatnonzero(alive)
    if len(members) < 2:
        return []
    place, owner = place[alive[owner]], owner[alive[owner]]
    times = np.bincount(place)
    rank = np.empty(len(times), np.int64)
    rank[np.lexsort((np.arange(len(times)), -times))] = np.arange(len(times))
    numbered = [np.sort(x) for x in np.split(rank[place], np.cumsum(sizes[members])[:-1])]
    trie = SetTrie(numbered, reach[members].tolist(), percent)
    links: list[tuple[int, int]] = []
    for k in sorted(range(len(numbered)), key=lambda i: len(numbered[i])):
        links += trie.link(k)
        trie.insert(k)
    return [(int(members[a]), int(members[b])) for a, b in links]
