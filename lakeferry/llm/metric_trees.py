"""Metric trees by the anchors hierarchy, built middle-out over the points of one part.

Of n points some sqrt(n) become anchors: each next one is the point farthest from its
anchor, and it takes the points that are nearer to it. Only points farther from their
anchor than half the distance between the two anchors can be, so only these are
looked at. Anchors are the middle of the tree: above, the two balls that fit into the
smallest common ball are joined until one is left; below, each anchor's points are
split in the same way until ``LEAF`` are left, or all are alike.

Every ball caches its points' sum and number. To find the nearest of some entries for
all points, candidate entries are passed down from the root: an entry that is farther
from a ball's pivot than the nearest one by more than the ball's diameter can be
nearest to none of its points and leaves the list. A ball with one candidate left is
owned by it as a whole, and its cached sum and number are all that is needed. Only
the points of leaves that stay undecided are compared with what is left. Bounds are
used with a margin for rounding; decisions are made on whole numbers.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LEAF, MARGIN = 48, 1e-9


class Tree(NamedTuple):
    """Points in tree order, so that a ball is a range of them; children are -1 below a leaf."""

    order: np.ndarray
    points: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pivot: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=-1))


def anchors(points: np.ndarray, wanted: int) -> tuple[np.ndarray, int]:
    """The anchor of every point, and how many anchors there are."""
    owner, away, chosen = np.zeros(len(points), dtype=np.int64), _lengths(points - points[0]), [0]
    while len(chosen) < wanted:
        farthest = int(away.argmax())
        if away[farthest] == 0:
            break
        apart = _lengths(points[chosen] - points[farthest])
        maybe = np.flatnonzero(away > apart[owner] / 2)
        distance = _lengths(points[maybe] - points[farthest])
        nearer = distance < away[maybe]
        taken = maybe[nearer]
        owner[taken], away[taken] = len(chosen), distance[nearer]
        chosen.append(farthest)
    return owner, len(chosen)


class _Builder:
    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.children: list[tuple[int, int]] = []
        self.members: list[np.ndarray | None] = []

    def _ball(self, left: int, right: int, members: np.ndarray | None) -> int:
        self.children.append((left, right))
        self.members.append(members)
        return len(self.children) - 1

    def split(self, members: np.ndarray) -> int:
        """The root of a tree over ``members``."""
        points = self.points[members]
        if len(members) <= LEAF:
            return self._ball(-1, -1, members)
        owner, n = anchors(points, max(2, int(np.sqrt(len(members)))))
        if n == 1:
            return self._ball(-1, -1, members)
        middle = [np.flatnonzero(owner == a) for a in range(n)]
        centre = np.stack([points[m].mean(axis=0) for m in middle])
        radius = np.array([_lengths(points[m] - c).max() for m, c in zip(middle, centre)])
        roots = [self.split(members[m]) for m in middle]
        return self._join(roots, centre, radius, np.array([len(m) for m in middle], dtype=float))

    def _join(self, roots: list[int], centre: np.ndarray, radius: np.ndarray, weight: np.ndarray) -> int:
        """Joins two balls at a time, those whose common ball is smallest."""

        def common(i: int | slice) -> np.ndarray:
            """Radius of the ball about the joint centre, for ball ``i`` with every other."""
            a, b = centre[i][..., None, :], centre[None]
            apart, both = _lengths(a - b), weight[i][..., None] + weight
            return np.maximum(apart * weight / both + radius[i][..., None], apart * weight[i][..., None] / both + radius)

        cost = common(slice(None))
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(roots) - 1):
            i, j = divmod(int(cost.argmin()), len(roots))
            joint = cost[i, j]
            roots[i] = self._ball(roots[i], roots[j], None)
            centre[i] = (centre[i] * weight[i] + centre[j] * weight[j]) / (weight[i] + weight[j])
            radius[i], weight[i] = joint, weight[i] + weight[j]
            gone = np.isinf(cost[i])
            row = common(np.array([i]))[0]
            row[gone] = np.inf
            row[[i, j]] = np.inf
            cost[i], cost[:, i] = row, row
            cost[j], cost[:, j] = np.inf, np.inf
        return roots[int(weight.argmax())]


def grow(points: np.ndarray) -> Tree:
    """The tree over the rows of ``points`` (whole numbers)."""
    builder = _Builder(points)
    root = builder.split(np.arange(len(points)))
    n, width = len(builder.children), points.shape[1]
    first, last = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    pieces, filled, stack = [], 0, [(root, False)]
    while stack:
        ball, seen = stack.pop()
        left, right = builder.children[ball]
        if seen:
            last[ball] = filled
        elif left < 0:
            first[ball], filled = filled, filled + len(builder.members[ball])
            last[ball] = filled
            pieces.append(builder.members[ball])
        else:
            first[ball] = filled
            stack += [(ball, True), (right, False), (left, False)]
    order = np.concatenate(pieces)
    ordered, floats = points[order], builder.points[order]
    # Sums of whole numbers of 52 bits over a block stay within 64 only for 2**11 points.
    kind = np.int64 if float(np.abs(points).max(initial=0)) * len(points) < 2.0**62 else object
    sums = np.zeros((n, width), dtype=kind)
    pivot, radius = np.zeros((n, width)), np.zeros(n)
    for ball in range(n):
        a, b = first[ball], last[ball]
        sums[ball] = ordered[a:b].astype(kind).sum(axis=0)
        pivot[ball] = floats[a:b].mean(axis=0)
        radius[ball] = _lengths(floats[a:b] - pivot[ball]).max()
    left, right = (np.array([c[i] for c in builder.children], dtype=np.int32) for i in (0, 1))
    # The root comes first.
    place = np.arange(n)
    place[[0, root]] = place[[root, 0]]
    moved = np.argsort(place)
    left, right = (np.where(c < 0, -1, moved[np.maximum(c, 0)]).astype(np.int32)[place] for c in (left, right))
    return Tree(order.astype(np.int32), ordered, first[place], last[place], left, right, pivot[place], radius[place], sums[place])


def exact_squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number vectors, exact: 64-bit numbers, or Python's where these are too short."""
    top = (float(np.abs(points).max(initial=0)) + float(np.abs(entries).max(initial=0))) ** 2 * points.shape[1]
    if top < 2.0**53:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)).astype(np.int64)
    kind = np.int64 if top < 2.0**62 else object
    out = np.zeros((len(points), len(entries)), dtype=kind)
    for k, entry in enumerate(entries):
        difference = points.astype(kind) - entry.astype(kind)
        out[:, k] = (difference * difference).sum(axis=1)
    return out


def _distinct(entries: np.ndarray) -> np.ndarray:
    """Whether an entry is the first of its value; a later one loses every tie."""
    seen, out = set(), np.zeros(len(entries), dtype=bool)
    for i, entry in enumerate(map(tuple, entries.tolist())):
        out[i] = entry not in seen
        seen.add(entry)
    return out


def owners(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Who owns what: (ball, entry) of the balls owned as a whole, and of the points left, ball -1.

    Returns three arrays: first and last position in tree order, and the entry; a
    ball's cached sum belongs to its range. Points compared singly are ranges of one.
    """
    balls, _, spans = walk(tree, entries)
    return tuple(np.concatenate(c) for c in zip((tree.first[balls[0]], tree.last[balls[0]], balls[1]), (spans[0], spans[0] + 1, spans[1])))


def walk(tree: Tree, entries: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], int, tuple[np.ndarray, np.ndarray]]:
    """((owned balls, their entries), distances measured, (points left, their entries)), ties to the lower entry."""
    floats = entries.astype(np.float64)
    scale = max(1.0, float(np.abs(floats).max(initial=0)), float(np.abs(tree.pivot).max(initial=0)))
    margin = MARGIN * scale * max(1, floats.shape[1])
    active, candidates = np.array([0]), _distinct(entries)[None]
    owned, owner, left_over, masks, measured = [], [], [], [], 0
    while len(active):
        measured += int(candidates.sum())
        away = np.where(candidates, _lengths(tree.pivot[active][:, None] - floats), np.inf)
        reach = away.min(axis=1) + 2 * tree.radius[active] + margin
        candidates = candidates & (away <= reach[:, None])
        whole = candidates.sum(axis=1) == 1
        owned.append(active[whole])
        owner.append(candidates[whole].argmax(axis=1))
        leaf = ~whole & (tree.left[active] < 0)
        left_over.append(active[leaf])
        masks.append(candidates[leaf])
        inner = ~whole & ~leaf
        active, candidates = (
            np.concatenate([tree.left[active[inner]], tree.right[active[inner]]]),
            np.concatenate([candidates[inner], candidates[inner]]),
        )
    balls, mask = np.concatenate(left_over), np.concatenate(masks)
    sizes = (tree.last[balls] - tree.first[balls]).astype(np.int64)
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(tree.first[balls], sizes)
    nearest = np.zeros(len(place), dtype=np.int64)
    if len(place):
        squares = exact_squares(tree.points[place], entries)
        open_ = np.repeat(mask, sizes, axis=0)
        measured += int(open_.sum())
        beyond = np.iinfo(np.int64).max if squares.dtype != object else max(squares.max(), 0) + 1
        nearest = np.where(open_, squares, beyond).argmin(axis=1)
    return (np.concatenate(owned), np.concatenate(owner)), measured, (place, nearest)


def nearest(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of every point, in the points' first order."""
    first, last, entry = owners(tree, entries)
    out = np.zeros(len(tree.order), dtype=np.int64)
    turn = np.argsort(first, kind="stable")
    out[tree.order] = np.repeat(entry[turn], (last - first)[turn])
    return out


def totals(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum, number) of the points nearest to each entry, from cached sums where a ball is owned."""
    (balls, owner), _, (place, entry) = walk(tree, entries)
    sums = np.zeros(entries.shape, dtype=tree.sums.dtype)
    counts = np.zeros(len(entries), dtype=np.int64)
    np.add.at(sums, owner, tree.sums[balls])
    np.add.at(counts, owner, (tree.last[balls] - tree.first[balls]).astype(np.int64))
    np.add.at(sums, entry, tree.points[place].astype(tree.sums.dtype))
    np.add.at(counts, entry, 1)
    return sums, counts
