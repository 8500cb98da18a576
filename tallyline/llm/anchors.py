"""Metric trees by the anchors hierarchy, over all parts of a chunk of vectors.

A ball of n points is divided by about sqrt(n) anchors, each of which takes from the others the
points that are nearer to it, and so on within an anchor; from the anchors upward, the two balls whose
union is smallest are merged until one is left. So trees grow from the middle. Every ball caches the
number and the sum of its points and its radius about their mean.

``settled`` gives each point its nearest entry without looking at most of them: a ball inherits the
candidate entries of the ball above, drops those that some other is nearer than for every point
inside, and is owned as a whole once one is left. Points of the last balls are compared with the
candidates left to them, in integers, so the answer is exact, ties included.
"""

from __future__ import annotations

import io
import math
from dataclasses import dataclass, fields

import numpy as np

# Points that are not divided further.
LEAF = 48
# Bounds are in floating point; what they tell apart by less than this share stays undecided.
SLACK = 1e-9


@dataclass
class Forest:
    """One tree for each part. Nodes of all trees stand in common arrays, the roots first."""

    points: np.ndarray  # (n, parts, width) integers
    order: np.ndarray  # (parts, n): the points of a tree, those of a node side by side
    part: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray  # -1 for a leaf
    right: np.ndarray
    sums: np.ndarray  # (nodes, width) integers
    radius: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f.name: getattr(self, f.name) for f in fields(self)})
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Forest:
        with np.load(io.BytesIO(data)) as arrays:
            return Forest(**{f.name: arrays[f.name] for f in fields(Forest)})


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(axis=-1))


def _anchors(points: np.ndarray) -> list[np.ndarray]:
    """The points of each anchor; one group if all points are the same."""
    pivots = [points[0]]
    owner = np.zeros(len(points), dtype=np.int64)
    distance = _distances(points, points[0])
    for i in range(1, math.isqrt(len(points) - 1) + 1):
        # The point farthest from its anchor, which is in the widest one, is the next anchor.
        farthest = int(distance.argmax())
        if distance[farthest] == 0:
            break
        between = _distances(np.array(pivots), points[farthest])
        # By the triangle inequality, no nearer point of an anchor can be won.
        contested = np.flatnonzero(2 * distance > between[owner])
        away = _distances(points[contested], points[farthest])
        won = away < distance[contested]
        owner[contested[won]] = i
        distance[contested[won]] = away[won]
        pivots.append(points[farthest])
    return [g for i in range(len(pivots)) if len(g := np.flatnonzero(owner == i))]


# A tree as it grows: the indexes of a leaf's points, or the two trees below.
Tree = np.ndarray | tuple


def _merged(trees: list[Tree], means: np.ndarray, sizes: np.ndarray, radii: np.ndarray) -> Tree:
    """One tree over all, joining the two balls of smallest union again and again."""
    trees, left = list(trees), len(trees)

    def unions(i: int) -> np.ndarray:
        return (_distances(means, means[i]) + radii + radii[i]) / 2

    cost = np.array([unions(i) for i in range(left)])
    np.fill_diagonal(cost, np.inf)
    while left > 1:
        a, b = divmod(int(cost.argmin()), len(trees))
        trees[a] = (trees[a], trees[b])
        radius = cost[a, b]
        means[a] = (means[a] * sizes[a] + means[b] * sizes[b]) / (sizes[a] + sizes[b])
        sizes[a] += sizes[b]
        radii[a] = radius
        cost[b] = cost[:, b] = np.inf
        gone = np.isinf(cost[a])
        cost[a] = np.where(gone, np.inf, unions(a))
        cost[a, b] = cost[a, a] = np.inf
        cost[:, a] = cost[a]
        left -= 1
    return trees[a]


def _grown(points: np.ndarray, index: np.ndarray) -> Tree:
    if len(index) <= LEAF:
        return index
    groups = _anchors(points[index])
    if len(groups) == 1:
        return index
    means = np.array([points[index[g]].mean(axis=0) for g in groups])
    radii = np.array([_distances(points[index[g]], m).max() for g, m in zip(groups, means)])
    sizes = np.array([float(len(g)) for g in groups])
    return _merged([_grown(points, index[g]) for g in groups], means, sizes, radii)


def planted(points: np.ndarray) -> Forest:
    """The trees of all parts of the points, an array (n, parts, width) of integers."""
    n, parts, _ = points.shape
    order = np.empty((parts, n), dtype=np.int32)
    part, start, end, left, right = ([0] * parts for _ in range(5))
    for p in range(parts):
        grown = _grown(points[:, p].astype(np.float64), np.arange(n))
        done, todo = 0, [(p, grown)]
        part[p] = p
        ranges: dict[int, tuple[int, int]] = {}
        nodes: list[int] = []
        while todo:
            node, tree = todo.pop()
            nodes.append(node)
            if isinstance(tree, tuple):
                left[node], right[node] = len(part), len(part) + 1
                for values, value in ((part, p), (start, 0), (end, 0), (left, -1), (right, -1)):
                    values += [value, value]
                todo += [(right[node], tree[1]), (left[node], tree[0])]
            else:
                left[node] = right[node] = -1
                ranges[node] = (done, done + len(tree))
                order[p, done : done + len(tree)] = tree
                done += len(tree)
        for node in reversed(nodes):
            if left[node] >= 0:
                ranges[node] = ranges[left[node]][0], ranges[right[node]][1]
            start[node], end[node] = ranges[node]
    arrays = [np.array(x, dtype=np.int32) for x in (part, start, end, left, right)]
    part, start, end = arrays[:3]
    sums = np.empty((len(part), points.shape[2]), dtype=np.int64)
    radius = np.empty(len(part))
    for p in range(parts):
        placed = points[order[p], p].astype(np.int64)
        for node in np.flatnonzero(part == p):
            inside = placed[start[node] : end[node]]
            sums[node] = inside.sum(axis=0)
            radius[node] = _distances(inside, sums[node] / len(inside)).max()
    return Forest(points, order, *arrays, sums, radius)


def settled(forest: Forest, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of every point's parts, and the number and sum of what each entry owns.

    ``book`` is an array (parts, entries, width) of integers; returned are the entries (n, parts),
    counts (parts, entries) and sums (parts, entries, width).
    """
    n, parts, width = forest.points.shape
    entries = book.shape[1]
    codes = np.empty((parts, n), dtype=np.int16)
    counts = np.zeros((parts, entries), dtype=np.int64)
    sums = np.zeros((parts, entries, width), dtype=np.int64)
    nodes = np.arange(parts)
    candidates = np.ones((parts, entries), dtype=bool)
    while len(nodes):
        own = book[forest.part[nodes]].astype(np.float64)
        size = (forest.end - forest.start)[nodes]
        mean = forest.sums[nodes] / size[:, None]
        away = ((mean[:, None] - own) ** 2).sum(axis=2)
        away[~candidates] = np.inf
        best = away.argmin(axis=1)
        at = np.arange(len(nodes))
        nearest = away[at, best][:, None]
        apart = _distances(own, own[at, best][:, None])
        # No point of the ball is as near to such an entry as to the best one.
        reach = 2 * forest.radius[nodes][:, None] * apart
        candidates &= ~(away - nearest > reach + SLACK * (away + nearest + reach + 1))
        whole = candidates.sum(axis=1) == 1
        for node, entry in zip(nodes[whole], best[whole]):
            p = forest.part[node]
            codes[p, forest.order[p, forest.start[node] : forest.end[node]]] = entry
        np.add.at(counts, (forest.part[nodes[whole]], best[whole]), size[whole])
        np.add.at(sums, (forest.part[nodes[whole]], best[whole]), forest.sums[nodes[whole]])
        last = ~whole & (forest.left[nodes] < 0)
        _compared(forest, book, nodes[last], candidates[last], codes, counts, sums)
        below = ~whole & ~last
        nodes, candidates = (
            np.concatenate([forest.left[nodes[below]], forest.right[nodes[below]]]),
            np.concatenate([candidates[below]] * 2),
        )
    return codes.T, counts, sums


def _compared(forest, book, leaves, candidates, codes, counts, sums) -> None:
    """Settle the points of undecided leaves by their exact distances to the candidates."""
    # Some leaves at a time: a leaf of equal points may hold the whole chunk.
    for node, left in zip(leaves, candidates):
        p = forest.part[node]
        inside = forest.order[p, forest.start[node] : forest.end[node]]
        points = forest.points[inside, p].astype(np.int64)
        choice = np.flatnonzero(left)
        away = ((points[:, None] - book[p, choice][None]) ** 2).sum(axis=2)
        found = choice[away.argmin(axis=1)]
        codes[p, inside] = found
        counts[p] += np.bincount(found, minlength=len(counts[p]))
        np.add.at(sums[p], found, points)
