"""An R-tree over count vectors, for joins by overlap.

The tokens of a set are hashed into groups; the numbers of tokens by group are the
set's point.  Two sets share at most the sum of their coordinates' minima, and a set
shares with anything below a tree node at most the sum of minima with the node's
largest coordinates.  A branch is left when that bound, or the sizes below it, rule
out the similarity.
"""

from __future__ import annotations

import numpy as np

LEAF = 32
LISTED = 500_000


def groups_of(size: int) -> int:
    """A power of two that grows with the set, at least 64.  The noise of a fixed number
    of groups would hide the difference of large sets."""
    return max(64, 1 << max(0, size // 8 - 1).bit_length())


def counts(tokens: np.ndarray) -> np.ndarray:
    """The point of a set of 64-bit tokens."""
    groups = groups_of(len(tokens))
    return np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups).astype(np.int32)


def fold(point: np.ndarray, groups: int) -> np.ndarray:
    """The same set's point in fewer groups."""
    return point.reshape(-1, groups).sum(axis=0)


def pack(point: np.ndarray) -> bytes:
    """One byte a coordinate where that is enough, else four; the first byte tells."""
    small = point.max(initial=0) < 256
    return (b"\1" if small else b"\4") + point.astype(np.uint8 if small else "<i4").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8 if packed[0] == 1 else "<i4", offset=1).astype(np.int32)


def needed(a, b, percent: int):
    """The least overlap of sets of sizes a and b with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """A packed tree over points; sorted by size, then by leading coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int, fan: int = LEAF):
        self.percent, self.fan = percent, fan
        band = (np.log(np.maximum(sizes, 1)) / np.log(100 / percent)).astype(np.int64)
        self.order = np.lexsort((points[:, 2], points[:, 1], points[:, 0], band))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > fan:
            top, low, high = self.levels[-1]
            at = np.arange(0, len(top), fan)
            self.levels.append((np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def find(self, point: np.ndarray, size: int) -> np.ndarray:
        """Places of the points whose bound allows the similarity."""
        live = np.arange(len(self.levels[-1][0]))
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = (x[live] for x in self.levels[k])
            bound = np.minimum(top, point).sum(axis=1)
            least = np.maximum(low, -(-self.percent * size // 100))
            fits = (high * 100 >= self.percent * size) & (low * self.percent <= 100 * size) & (bound >= needed(size, least, self.percent))
            live = live[fits]
            if k:
                live = (live[:, None] * self.fan + np.arange(self.fan)).ravel()
                live = live[live < len(self.levels[k - 1][0])]
        return self.order[live]


class Overlaps:
    """Exact overlaps inside a group of sorted token sets."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets])
        self.lists: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def links(self, i: int, j: int) -> bool:
        a, b = (self.sets[i], self.sets[j]) if self.sizes[i] <= self.sizes[j] else (self.sets[j], self.sets[i])
        shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return 100 * shared >= self.percent * (len(a) + len(b) - shared)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that link with i, by the lists of sets of each token."""
        if self.lists is None:
            owner = np.repeat(np.arange(len(self.sets), dtype=np.int32), self.sizes)
            tokens = np.concatenate(self.sets)
            by = np.argsort(tokens, kind="stable").astype(np.int32)
            tokens, owner = tokens[by], owner[by]
            begin = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            self.lists = tokens[begin], owner, np.append(begin, len(tokens))
        tokens, owner, begin = self.lists
        at = np.searchsorted(tokens, self.sets[i])
        low, long = begin[at], begin[at + 1] - begin[at]
        shared, ends = np.zeros(len(self.sets), np.int64), np.cumsum(long)
        done = 0
        while done < len(low):
            # Some lists at a time, so that memory follows neither their number nor length.
            to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + LISTED, side="right")))
            n = long[done:to]
            rows = np.repeat(low[done:to] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            shared += np.bincount(owner[rows], minlength=len(self.sets))
            done = to
        shared = shared[others]
        return others[100 * shared >= self.percent * (self.sizes[i] + self.sizes[others] - shared)]


def spanning_links(points: list[np.ndarray], sizes: np.ndarray, percent: int, exact: Overlaps | None = None, hubs: int = 4) -> list[tuple[int, int]]:
    """Links that connect the same places as all links do.

    A link is a pair whose bound allows the similarity and, with ``exact``, that has it.
    Pairs that are connected already are not looked at again; no other pair is left
    out.  Places with many links are tried first, then all others at once.  Sizes are
    taken in bands so wide that only neighbours can link; each band and the next have
    a tree, in the groups of its smallest set.
    """
    n = len(points)
    part, degree, links = np.arange(n), np.zeros(n, np.int64), []
    band = np.floor(np.log(np.maximum(sizes, 1)) / np.log(100 / percent * 1.0001)).astype(np.int64)

    def join(i: int, near: np.ndarray) -> None:
        for j in near.tolist():
            if part[j] != part[i]:
                links.append((j, i))
                degree[[i, j]] += 1
                part[part == part[j]] = part[i]

    for b in np.unique(band).tolist():
        members = np.flatnonzero((band == b) | (band == b + 1))
        if len(members) < 2:
            continue
        groups = min(len(points[k]) for k in members.tolist())
        some = np.stack([fold(points[k], groups) for k in members.tolist()])
        tree = CountTree(some, sizes[members], percent)
        for at, i in enumerate(members.tolist()):
            if band[i] != b:
                continue
            near = members[tree.find(some[at], int(sizes[i]))]
            near = near[((near < i) | (band[near] > b)) & (part[near] != part[i])]
            if not len(near):
                continue
            if exact is None:
                _, first = np.unique(part[near], return_index=True)
                join(i, near[first])
                continue
            for j in near[np.argsort(-degree[near], kind="stable")[:hubs]].tolist():
                if part[j] != part[i] and exact.links(i, j):
                    join(i, np.array([j]))
            near = near[part[near] != part[i]]
            if len(near) > hubs:
                near = exact.linked(i, near)
                _, first = np.unique(part[near], return_index=True)
                join(i, near[first])
            else:
                join(i, np.array([j for j in near.tolist() if exact.links(i, j)], np.int64))
    return links
