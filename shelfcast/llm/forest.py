"""Random-projection trees learned from a sample, and the search that pops their leaves from one queue."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Sampled rows that a leaf of the learned trees holds at least.
LEAF_SAMPLE = 32
#: What a visit costs besides its comparisons, as a number of rows compared: a query is sent, the best of a leaf return.
VISIT_ROWS = 1024


@dataclass
class Tree:
    """Node i has the children 2i+1 and 2i+2; a row goes right where its projection reaches the threshold."""

    directions: np.ndarray
    thresholds: np.ndarray
    spreads: np.ndarray
    depth: int

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf number (from 0) of each row."""
        node = np.zeros(len(vectors), dtype=np.int64)
        for _ in range(self.depth):
            right = np.einsum("ij,ij->i", vectors, self.directions[node]) >= self.thresholds[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


def grow(sample: np.ndarray, depth: int, chance: np.random.Generator) -> Tree:
    """One tree of a depth: each node splits its sampled rows at the median along the line through two of them."""
    count, width = (1 << depth) - 1, sample.shape[1]
    tree = Tree(np.zeros((count, width), dtype=np.float32), np.zeros(count, dtype=np.float32), np.ones(count, dtype=np.float32), depth)
    node = np.zeros(len(sample), dtype=np.int64)
    for level in range(depth):
        for at in range((1 << level) - 1, (1 << level + 1) - 1):
            inside = sample[node == at]
            line = np.zeros(width)
            if len(inside) > 1:
                a, b = chance.choice(len(inside), 2, replace=False)
                line = inside[a].astype(np.float64) - inside[b]
            if not line.any():
                line = chance.normal(size=width)
            tree.directions[at] = line / np.sqrt(line @ line)
            if len(inside):
                places = inside @ tree.directions[at]
                tree.thresholds[at] = np.median(places)
                tree.spreads[at] = max(float(places.std()), 1e-12)
        node = 2 * node + 1 + (np.einsum("ij,ij->i", sample, tree.directions[node]) >= tree.thresholds[node])
    return tree


@dataclass
class Forest:
    """Trees and ``steepness``: a neighbour lies on the query's side of a node with 1 / (1 + exp(-steepness * margin))."""

    trees: list[Tree]
    steepness: float

    def sides(self, queries: np.ndarray) -> list[np.ndarray]:
        """For each tree the chance, by query and node, that a neighbour of the query goes right."""
        out = []
        for tree in self.trees:
            margins = (queries @ tree.directions.T - tree.thresholds) / tree.spreads
            out.append(1 / (1 + np.exp(-np.clip(self.steepness * margins, -50, 50))))
        return out

    def visits(self, chances: list[np.ndarray], wanted: float) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) of one query, best first from one queue over all trees.

        A leaf's chance is the product along its path.  The search ends when a neighbour that the trees place
        independently has been in a visited leaf of some tree with probability ``wanted``.
        """
        queue = [(-1.0, tree, 0) for tree in range(len(self.trees))]
        missed, out = [1.0] * len(self.trees), []
        while queue:
            chance, tree, node = heapq.heappop(queue)
            inner = (1 << self.trees[tree].depth) - 1
            if node < inner:
                right = float(chances[tree][node])
                heapq.heappush(queue, (chance * right, tree, 2 * node + 2))
                heapq.heappush(queue, (chance * (1 - right), tree, 2 * node + 1))
                continue
            out.append((tree, node - inner))
            missed[tree] = max(0.0, missed[tree] + chance)
            if np.prod(missed) <= 1 - wanted:
                break
        return out


def _cut(tree: Tree, depth: int) -> Tree:
    """The upper levels of a tree."""
    count = (1 << depth) - 1
    return Tree(tree.directions[:count], tree.thresholds[:count], tree.spreads[:count], depth)


def _steepness(margins: np.ndarray) -> float:
    """The likeliest steepness for margins of queries on the sides of their neighbours."""
    grid = np.geomspace(0.05, 50, 80)
    return float(min(grid, key=lambda steep: np.logaddexp(0, -steep * margins).sum()))


def learn(sample: np.ndarray, rows: int, neighbours: int, trees: int, leaf_rows: int, wanted: float, seed: int = 7) -> Forest:
    """A forest for ``rows`` rows like the sampled ones.

    Trees are grown until leaves would hold ``leaf_rows`` rows, or fewer than LEAF_SAMPLE sampled ones, and cut where
    the search of sampled queries costs least: each visit costs the rows of the leaf and VISIT_ROWS.  Vectors without
    clusters need a share of all rows whatever the depth and get few, large leaves.  The steepness is the likeliest for
    the nearest sampled rows of 256 sampled queries; in the whole table neighbours lie nearer, so that the search errs
    to more leaves.
    """
    sample = sample.astype(np.float32)
    most = 0
    while (rows >> most) > leaf_rows and (len(sample) >> most + 1) >= LEAF_SAMPLE:
        most += 1
    if not most:
        return Forest([grow(sample, 0, np.random.default_rng(seed))], 1.0)
    chance = np.random.default_rng(seed)
    grown = [grow(sample, most, chance) for _ in range(trees)]
    queries = np.arange(0, len(sample), max(1, len(sample) // 256))
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    near = max(1, round(neighbours * len(sample) / rows))
    nearest = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    asked, found = np.repeat(queries, near), nearest.ravel()
    margins = np.empty((trees, most, len(found)))
    for k, tree in enumerate(grown):
        node = np.zeros(len(found), dtype=np.int64)
        for level in range(most):
            line, at = tree.directions[node], tree.thresholds[node]
            right = np.einsum("ij,ij->i", sample[found], line) >= at
            margin = (np.einsum("ij,ij->i", sample[asked], line) - at) / tree.spreads[node]
            margins[k, level] = np.where(right, margin, -margin)
            node = 2 * node + 1 + right
    best: tuple[float, Forest] | None = None
    for depth in range(1, most + 1):
        forest = Forest([_cut(tree, depth) for tree in grown], _steepness(margins[:, :depth].ravel()))
        chances = forest.sides(sample[queries[::8]])
        visits = sum(len(forest.visits([chance[row] for chance in chances], wanted)) for row in range(len(queries[::8])))
        cost = visits * ((rows >> depth) + VISIT_ROWS)
        if best is None or cost < best[0]:
            best = cost, forest
    return best[1]
