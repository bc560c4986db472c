"""Boosted regression trees over binned rows: sums of rows, the choice of splits, the loop over trees.

Nodes are numbered as in a heap: the children of node i are 2i + 1 and 2i + 2. Of two siblings only
the one of fewer rows is summed; the other is the rest of their parent. Only numpy is needed here, so
that workers start quickly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np

# Rows that are worked on at once.
BLOCK_ROWS = 1 << 16
# A node of a smaller variance is a leaf.
PURE = 2.0**-52
# Gains that differ by less than this part of a node's mean square are equal, smaller ones are none:
# sums of doubles are not exact, and the first of equal splits should win in whatever order rows come.
NOISE = 1e-12
# Positives are counted in units of this beside the count of rows, in one double.
POSITIVE = 2.0**26


def finite(values: np.ndarray) -> None:
    if not np.isfinite(values).all():
        raise ValueError("a feature is missing, NaN or infinite")


def cut_points(values: np.ndarray, weights: np.ndarray, max_bins: int) -> np.ndarray:
    """At most `max_bins` - 1 ascending thresholds that part the weight of the values evenly."""
    finite(values)
    distinct, place = np.unique(values, return_inverse=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    if len(distinct) <= max_bins:
        return between
    reached = np.cumsum(np.bincount(place, weights))
    stride = reached[-1] / max_bins
    cuts, target = [], stride
    for i in range(len(between)):
        if abs(reached[i] - target) < abs(reached[i + 1] - target):
            cuts.append(between[i])
            target += stride
    return np.array(cuts)


@dataclass(frozen=True)
class Grid:
    """Thresholds of the features. A code holds the bins of two features, `bits` wide each.

    A bin is the number of thresholds below the value, so the bins 0 to b are those at or below
    threshold b.
    """

    cuts: list[np.ndarray]
    weights: np.ndarray  # of a row by its label, 0 or 1

    @property
    def bits(self) -> int:
        return max(len(c) for c in self.cuts).bit_length()

    @property
    def pairs(self) -> int:
        return -(-len(self.cuts) // 2)

    def codes(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((self.pairs, len(columns[0])), np.uint16)
        for f, (x, at) in enumerate(zip(columns, self.cuts)):
            finite(x)
            out[f // 2] |= np.searchsorted(at, x, side="left").astype(np.uint16) << (f % 2 * self.bits)
        return out


@dataclass
class Tree:
    """Arrays by node; `feature` is -1 where there is no split, `place` the last bin that goes left."""

    feature: np.ndarray
    place: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    weight: np.ndarray
    total: np.ndarray
    square: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.full(n, -1.0), np.zeros(n, int), *np.zeros((3, n)))

    def value(self) -> np.ndarray:
        return np.divide(self.total, self.weight, out=np.zeros_like(self.total), where=self.weight > 0)

    def impurity(self) -> np.ndarray:
        spread = self.square - self.total * self.value()
        return np.divide(spread, self.weight, out=np.zeros_like(self.total), where=self.weight > 0)

    def close(self, squares: np.ndarray) -> None:
        """Take the squared residuals of the leaves, which are known when all rows have come there."""
        self.square = np.where(self.feature < 0, squares, self.square)

    def listed(self, cuts: list[np.ndarray]) -> list[tuple]:
        """The nodes in the order and form in which Spark ML saves them."""
        value, impurity, leaf = self.value(), self.impurity(), self.feature < 0
        for node in np.flatnonzero(~leaf)[::-1]:
            left, right = 2 * node + 1, 2 * node + 2
            if leaf[left] and leaf[right] and value[left] == value[right]:
                leaf[node], value[node] = True, value[left]
        out = []

        def put(node: int) -> int:
            """Returns the number of the node, after which those below it come."""
            out.append(None)
            k, left, right, gain, split = len(out) - 1, -1, -1, -1.0, (-1, [], -1)
            if not leaf[node]:
                f = int(self.feature[node])
                left, right, gain = put(2 * node + 1), put(2 * node + 2), float(self.gain[node])
                split = (f, [float(cuts[f][self.place[node]])], -1)
            stats = [float(x[node]) for x in (self.weight, self.total, self.square)]
            out[k] = (k, float(value[node]), float(impurity[node]), stats, int(self.rows[node]), gain, left, right, split)
            return k

        put(0)
        return out


@dataclass
class Block:
    """Coded rows with their label and the margin that the trees so far give them.

    `square` has the sums of weighted squared residuals by node of the last tree, None before it.
    """

    codes: np.ndarray
    label: np.ndarray
    margin: np.ndarray
    square: np.ndarray | None = None
    node: np.ndarray | None = field(default=None, init=False)

    def at_root(self) -> None:
        """Put all rows at the root. Residuals are the labels as -1 and 1 for the first tree, then the
        negative gradient of the logistic loss."""
        self.node = np.zeros(len(self.label), int)
        self.residual = sign = self.label * 2.0 - 1.0
        if self.square is not None:
            with np.errstate(over="ignore"):
                self.residual = 4.0 * sign / (1.0 + np.exp(2.0 * sign * self.margin))

    def step(self, tree: Tree, grid: Grid) -> None:
        """Put all rows that are at a split on its left or right."""
        n, f = len(self.label), np.maximum(tree.feature, 0)
        start, shift = f // 2 * n, f % 2 * grid.bits
        at = self.codes.ravel()[start[self.node] + np.arange(n)]
        right = (at >> shift[self.node] & ((1 << grid.bits) - 1)) > tree.place[self.node]
        self.node = np.where((tree.feature >= 0)[self.node], 2 * self.node + 1 + right, self.node)

    def squares(self, grid: Grid, n_nodes: int) -> np.ndarray:
        return np.bincount(self.node, grid.weights[self.label] * self.residual**2, n_nodes)

    def moved(self, tree: Tree, rate: float, grid: Grid) -> Block:
        """The block after one more tree, whose leaves the rows have come to."""
        margin = self.margin + rate * tree.value()[self.node]
        return Block(self.codes, self.label, margin, self.squares(grid, len(tree.feature)))


def walked(held: Iterable[Block], tree: Tree, level: int, grid: Grid) -> Iterator[Block]:
    """The blocks with their rows after `level` splits."""
    for block in held:
        block.at_root()
        for _ in range(level):
            block.step(tree, grid)
        yield block


def blocks(rows: Iterable, grid: Grid) -> Iterator[Block]:
    """Rows of (codes, label) as bytes, put together to larger blocks."""
    def joined(parts: list) -> Block:
        label = np.concatenate([y for _, y in parts])
        return Block(np.concatenate([x for x, _ in parts], axis=1), label, np.zeros(len(label)))

    parts, held = [], 0
    for codes, label in rows:
        label = np.frombuffer(label, np.int8)
        parts.append((np.frombuffer(codes, np.uint16).reshape(grid.pairs, len(label)), label))
        held += len(label)
        if held >= BLOCK_ROWS:
            yield joined(parts)
            parts, held = [], 0
    if parts:
        yield joined(parts)


@dataclass
class Sums:
    """By wanted node, feature and bin: rows of either label and weighted residuals; by node: squares."""

    rows: np.ndarray
    total: np.ndarray
    square: np.ndarray
    last_square: np.ndarray | None

    def __add__(self, other: Sums) -> Sums:
        last = None if self.last_square is None else self.last_square + other.last_square
        return Sums(self.rows + other.rows, self.total + other.total, self.square + other.square, last)


def summed(held: Iterable[Block], tree: Tree, wanted: list[int], grid: Grid) -> Iterator[Sums]:
    """The sums over all blocks for the `wanted` ones of the nodes that rows are at; none without blocks."""
    width, features = 1 << grid.bits, len(grid.cuts)
    slot = np.full(len(tree.feature), -1)
    slot[wanted] = np.arange(len(wanted))
    both = np.zeros((grid.pairs, len(wanted) * width**2), complex)
    square, last = 0, None
    for block in held:
        square = square + block.squares(grid, len(slot))
        if block.square is not None:
            last = block.square if last is None else last + block.square
        first = slot[block.node]
        taken = np.flatnonzero(first >= 0)
        every = len(taken) == len(first)
        first = first[taken] * width**2
        label = block.label[taken]
        heft = grid.weights[label] * block.residual[taken] + 1j * (1.0 + POSITIVE * label)
        for codes, sums in zip(block.codes, both):
            np.add.at(sums, first + (codes if every else codes[taken]), heft)
    if np.ndim(square):
        both = both.reshape(grid.pairs, len(wanted), width, width)
        sides = np.stack([both.sum(2), both.sum(3)], axis=1).reshape(-1, len(wanted), width)[:features]
        positives = np.floor(sides.imag / POSITIVE)
        rows = np.stack([sides.imag - positives * POSITIVE - positives, positives], axis=-1).astype(int)
        yield Sums(rows.swapaxes(0, 1), sides.real.swapaxes(0, 1), square, last)


def split_nodes(tree: Tree, nodes: list[int], rows: np.ndarray, total: np.ndarray, grid: Grid) -> list[int]:
    """Give `nodes` their best split where one gains; returns those that got one.

    `rows` is by node, feature, bin and label, `total` by node, feature and bin.
    """
    n_left = np.cumsum(rows.sum(-1), axis=2)
    w_left = np.cumsum(rows @ grid.weights, axis=2)
    s_left = np.cumsum(total, axis=2)
    n_all, w_all, s_all = n_left[..., -1:], w_left[..., -1:], s_left[..., -1:]
    w_right, s_right = w_all - w_left, s_all - s_left

    def part(s: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.divide(s * s, w, out=np.zeros_like(s), where=w > 0)

    gain = part(s_left, w_left) + part(s_right, w_right) - part(s_all, w_all)
    gain = np.divide(gain, w_all, out=np.zeros_like(gain), where=w_all > 0)
    is_cut = np.arange(total.shape[2]) < np.array([len(c) for c in grid.cuts])[:, None]
    gain = np.where((n_left > 0) & (n_left < n_all) & is_cut, gain, -np.inf)
    impurity, found = tree.impurity(), []
    for k, node in enumerate(nodes):
        noise = NOISE * tree.square[node] / tree.weight[node] if tree.weight[node] > 0 else 0.0
        best = gain[k].max()
        if abs(impurity[node]) < PURE or best <= noise:
            continue
        f, b = np.unravel_index(np.argmax(gain[k] >= best - noise), gain[k].shape)
        tree.feature[node], tree.place[node], tree.gain[node] = f, b, gain[k, f, b]
        children = [2 * node + 1, 2 * node + 2]
        tree.rows[children] = n_left[k, f, b], n_all[k, f, 0] - n_left[k, f, b]
        tree.weight[children] = w_left[k, f, b], w_right[k, f, b]
        tree.total[children] = s_left[k, f, b], s_right[k, f, b]
        found.append(node)
    return found


class Rows(Protocol):
    """Where the blocks are."""

    def sums(self, tree: Tree, level: int, wanted: list[int]) -> Sums:
        """Of the rows after `level` splits of the tree, level after level from 0 on."""

    def move(self, tree: Tree, rate: float) -> None:
        """Add a finished tree to the margins; closes it before or as the next one begins."""


class HeldRows:
    """All blocks in the memory of one task."""

    def __init__(self, held: Iterable[Block], grid: Grid):
        self.blocks, self.grid, self.level = list(held), grid, 0

    def _go(self, tree: Tree, level: int) -> None:
        for block in self.blocks:
            if level:
                block.step(tree, self.grid)
            else:
                block.at_root()
        self.level = level

    def sums(self, tree: Tree, level: int, wanted: list[int]) -> Sums:
        self._go(tree, level)
        return next(summed(self.blocks, tree, wanted, self.grid))

    def move(self, tree: Tree, rate: float) -> None:
        self._go(tree, self.level + 1)
        self.blocks = [block.moved(tree, rate, self.grid) for block in self.blocks]
        tree.close(sum(block.square for block in self.blocks))


def grown(source: Rows, depth: int, grid: Grid) -> Tree:
    """The next tree."""
    tree = Tree.empty(depth)
    nodes, wanted, parents = [0], [0], {}
    for level in range(max(depth, 1)):
        sums = source.sums(tree, level, wanted)
        if level == 0:
            by_label = sums.rows[0, 0].sum(0)
            tree.rows[0], tree.weight[0], tree.total[0] = by_label.sum(), by_label @ grid.weights, sums.total[0, 0].sum()
        tree.square[nodes] = sums.square[nodes]
        known = dict(zip(wanted, zip(sums.rows, sums.total)))
        for node in nodes:
            if node not in known:
                twin, whole = known[node + 1 if node % 2 else node - 1], parents[(node - 1) // 2]
                known[node] = (whole[0] - twin[0], whole[1] - twin[1])
        rows, total = (np.stack(x) for x in zip(*(known[node] for node in nodes)))
        split = split_nodes(tree, nodes, rows, total, grid) if depth else []
        parents = {node: known[node] for node in split}
        nodes, wanted = [], []
        for left, right in ((2 * node + 1, 2 * node + 2) for node in split):
            if divisible := [child for child in (left, right) if tree.rows[child] > 1]:
                nodes += divisible
                wanted.append(left if tree.rows[left] <= tree.rows[right] else right)
        if not nodes:
            break
    return tree


def boosted(source: Rows, n_trees: int, rate: float, depth: int, grid: Grid) -> list[Tree]:
    """All trees; the first one counts in full."""
    trees = []
    for k in range(n_trees):
        trees.append(grown(source, depth, grid))
        source.move(trees[-1], rate if k else 1.0)
    return trees
