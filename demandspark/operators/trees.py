"""Regression trees, forests and boosted trees grown from binned rows.

Rows are coded once: each feature's value becomes the number of its bin (at
most ``maxBins``; thresholds from a bounded sample, midpoints between the
values where there are few). Features whose bins hang on each other (an hour,
its sine, the time of day) share a column: one byte stands for the combination
of their bins, and sums per combination add up to those per bin. Columns are
kept in blocks of rows. A split lowers the squared error most; ties go to the
first feature and threshold.

* While a node has more than LOCAL rows, its split comes from sums per node,
  feature and bin: the tasks add up their blocks, a tree of tasks adds up
  theirs. At most SLOTS nodes are counted in one pass, whatever their number.
* Rows of smaller nodes are dealt by (tree, node), and each task finishes its
  nodes' subtrees. So the sums of the many deep nodes are never sent around,
  and no task holds more than LOCAL rows of a node.

Boosting needs its trees one after the other: over at most LOCAL rows one task
grows them all, over more rows they come from sums over all blocks, which keep
the sum of the trees so far (written anew every REFRESH rounds).
To the driver come sums of at most SLOTS nodes and the grown trees.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCAL = 1_000_000  # rows of a node whose subtree one task finishes
SLOTS = 2_048  # nodes that are counted in one pass
DEALT = 200_000_000  # row copies that are dealt at once
PART = 500_000  # row copies that one task gets, unless one node has more
BLOCK = 50_000  # rows of a block
REFRESH = 2  # boosting rounds between two writings of the blocks' sums
SAMPLE = 10_000  # rows that thresholds come from
SHARED = 128  # combinations of bins in a shared column of the sample
WIDE = 1 << 20  # combinations of a column's bins that a table tells apart
CELLS = 500_000  # sums that a task holds for a group of nodes


class Tree(NamedTuple):
    """Parallel arrays: split feature (-1: leaf), last bin that goes left, left child (the right one follows), value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def leaves(self, codes: np.ndarray, layout: Layout | None = None) -> np.ndarray:
        """The leaf of each row of ``codes``: a row of bins for each feature, or one for each column of ``layout``."""
        n, inner = codes.shape[1], self.feature >= 0
        at, flat = np.zeros(n, np.int64), codes.ravel()
        # a leaf leads to itself
        cut, left = np.where(inner, self.cut, 255), np.where(inner, self.left, np.arange(len(inner))).astype(np.int64)
        feature = np.where(inner, self.feature, 0).astype(np.int64)
        place = (feature if layout is None else layout.column[feature]) * n
        table = None if layout is None else layout.bins.ravel()
        rows, level = np.arange(n), np.zeros(1, np.int64)
        while len(level := level[inner[level]]):
            level = np.concatenate([left[level], left[level] + 1])
            code = flat[place[at] + rows]
            if table is not None:
                code = table[feature[at] * 256 + code]
            at = left[at] + (code > cut[at])
        return at


class Layout:
    """Where the sums of features' bins lie (``starts``), and the columns that hold the bins: ``keys`` are the
    combinations of a column's bins (the number of a combination is its code), ``bins`` each feature's bin of every code."""

    def __init__(self, widths: Sequence[int], columns: Sequence[Sequence[int]], keys: Sequence[np.ndarray]):
        self.widths, self.columns, self.keys = list(widths), [list(c) for c in columns], list(keys)
        self.starts = np.concatenate([[0], np.cumsum(widths)])
        self.edges = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        self.column, self.bins = np.empty(len(widths), np.int64), np.zeros((len(widths), 256), np.uint8)
        self.adding = []  # of each column, which combinations make up a bin
        for g, (own, key) in enumerate(zip(self.columns, self.keys)):
            self.column[own] = g
            for f in reversed(own):
                self.bins[f, :len(key)] = key % widths[f]
                key = key // widths[f]
            shape = [np.arange(widths[f]) == self.bins[f, :len(key), None] for f in own]
            self.adding.append(np.concatenate(shape, axis=1).astype(float))

    def key(self, codes: np.ndarray, g: int) -> np.ndarray:
        """The combination of a column's bins in each row (``codes``: features x rows)."""
        out = np.zeros(codes.shape[1], np.int64)
        for f in self.columns[g]:
            out = out * self.widths[f] + codes[f]
        return out

    def packed(self, codes: np.ndarray) -> np.ndarray:
        """The codes in columns (columns x rows) of bins (features x rows)."""
        out = np.empty((len(self.keys), codes.shape[1]), np.uint8)
        for g, k in enumerate(self.keys):
            if (room := math.prod(self.widths[f] for f in self.columns[g])) <= WIDE:
                number = np.zeros(room, np.uint8)
                number[k] = np.arange(len(k))
                out[g] = number[self.key(codes, g)]
            else:
                out[g] = np.searchsorted(k, self.key(codes, g))
        return out

    def seen(self, codes: np.ndarray, g: int) -> np.ndarray:
        """The different combinations in a column, sorted."""
        key, room = self.key(codes, g), math.prod(self.widths[f] for f in self.columns[g])
        return np.flatnonzero(np.bincount(key, minlength=room)) if room <= WIDE else np.unique(key)

    def by_bin(self, found: np.ndarray) -> np.ndarray:
        """The sums per bin of sums (2, nodes, cells) per combination."""
        out = np.empty((*found.shape[:2], self.starts[-1]))
        for g, own in enumerate(self.columns):
            some = found[:, :, self.edges[g]:self.edges[g + 1]] @ self.adding[g]
            lo = 0
            for f in own:
                out[:, :, self.starts[f]:self.starts[f + 1]] = some[:, :, lo:(lo := lo + self.widths[f])]
        return out


def sharing(codes: np.ndarray, widths: Sequence[int]) -> list[list[int]]:
    """Features that go into a column together: the rows (``codes``) have few combinations of their bins."""
    columns, number, size = [], [], []  # features; the combination of each row; how many there are
    for f, width in enumerate(widths):
        best = None
        for g, own in enumerate(columns):
            if math.prod(widths[x] for x in own) * width >= 1 << 62:
                continue
            key = number[g] * width + codes[f]
            seen = np.bincount(key, minlength=size[g] * width) > 0
            many = int(seen.sum())
            if many <= min(SHARED, 2 * max(size[g], width)) and (best is None or many / size[g] < best[0]):
                best = many / size[g], g, (np.cumsum(seen) - 1)[key], many
        if best is None:
            columns.append([f])
            number.append(codes[f].astype(np.int64))
            size.append(width)
        else:
            _, g, number[g], size[g] = best
            columns[g].append(f)
    return columns


class Growing:
    """A tree while it grows: node numbers never change; ``gains`` is what each feature's splits bring."""

    def __init__(self, features: int, total: float, n: float):
        self.feature, self.cut, self.left, self.value, self.n, self.depth = [-1], [0], [0], [total / n], [n], [0]
        self.gains = np.zeros(features)

    def split(self, node: int, gain: float, feature: int, cut: int, sides: Sequence[tuple[float, float]]) -> list[int]:
        self.gains[feature] += gain
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for n, total in sides:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(total / n)
            self.n.append(n)
            self.depth.append(self.depth[node] + 1)
        return [len(self.feature) - 2, len(self.feature) - 1]

    def graft(self, node: int, below: Tree, gains: np.ndarray) -> None:
        """Put a finished subtree in the place of a leaf."""
        shift = len(self.feature) - 1  # the subtree's node 1 becomes the next one
        self.gains += gains
        self.feature[node], self.cut[node], self.value[node] = int(below.feature[0]), int(below.cut[0]), float(below.value[0])
        self.left[node] = int(below.left[0]) + shift
        for own, more in ((self.feature, below.feature), (self.cut, below.cut), (self.value, below.value)):
            own.extend(more[1:].tolist())
        self.left.extend((below.left[1:] + shift).tolist())

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int16), np.array(self.cut, np.int16), np.array(self.left, np.int32), np.array(self.value))


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds of one feature: midpoints between its values, or where there are too many, near equal shares of the rows."""
    value, count = np.unique(values, return_counts=True)
    middle = (value[:-1] + value[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    stride = len(values) / bins
    target, upto, out = stride, np.cumsum(count), []
    for i in range(1, len(value)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def sums(codes: np.ndarray, layout: Layout, rows: np.ndarray | None, at: np.ndarray, nodes: int, weight: np.ndarray | None, wy: np.ndarray) -> np.ndarray:
    """(2, nodes, cells): weight (None: 1) and weighted target of the ``rows`` (None: all; ``at``: their node) per node and code of every column."""
    out = np.empty((2, nodes, layout.edges[-1]))
    for g in range(len(codes)):
        lo, hi = layout.edges[g], layout.edges[g + 1]
        own = codes[g] if rows is None else codes[g][rows]
        key = at * (hi - lo) + own if nodes > 1 else own.astype(np.int64)
        out[0, :, lo:hi] = np.bincount(key, weight, nodes * (hi - lo)).reshape(nodes, -1)
        out[1, :, lo:hi] = np.bincount(key, wy, nodes * (hi - lo)).reshape(nodes, -1)
    return out


def best_splits(found: np.ndarray, starts: np.ndarray, least: float, allowed: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Per node: gain (squared error), feature (-1: none), cut, and rows and target sum of the left side."""
    k = found.shape[1]
    gain, feature, cut, left = np.zeros(k), np.full(k, -1), np.zeros(k, int), np.zeros((2, k))
    every = np.arange(k)
    for f in range(len(starts) - 1):
        lo, hi = starts[f], starts[f + 1]
        if hi - lo < 2:
            continue
        (nl, sl) = upto = found[:, :, lo:hi].cumsum(2)
        n, s = nl[:, -1:], sl[:, -1:]
        nl, sl = nl[:, :-1], sl[:, :-1]
        nr, sr = n - nl, s - sl
        fits = (nl >= least) & (nr >= least)
        score = np.where(fits, sl * sl / np.where(fits, nl, 1) + sr * sr / np.where(fits, nr, 1), -np.inf)
        at = score.argmax(1)
        own = score[every, at] - (s * s / np.maximum(n, 1e-300))[:, 0]
        # what rounding leaves is no gain, and no better than another feature's
        better = own > np.maximum(gain * (1 + 1e-12), 1e-12 * np.abs(score[every, at]))
        if allowed is not None:
            better &= allowed[:, f]
        gain[better], feature[better], cut[better] = own[better], f, at[better]
        left[:, better] = upto[:, every, at][:, better]
    return gain, feature, cut, *left


def grown(codes: np.ndarray, y: np.ndarray, weight: np.ndarray, layout: Layout, depth: int, least: float,
          allow: Callable[[int], np.ndarray] | None = None) -> tuple[Tree, np.ndarray, np.ndarray]:
    """The tree of these rows (``codes``: columns x rows), its features' gains and the leaf of each row."""
    wy, plain = weight * y, bool((weight == 1).all())
    gains, leaf = np.zeros(len(layout.widths)), np.zeros(len(y), np.int64)
    value = [np.array([wy.sum() / weight.sum()])]
    size, flat, n = 1, codes.ravel(), len(y)
    most = max(1, CELLS // int(layout.edges[-1]))
    splits = []  # (nodes, features, cuts, left children)

    def counted(rows: np.ndarray | None, at: np.ndarray, nodes: int) -> np.ndarray:
        if rows is None:
            return sums(codes, layout, None, at, nodes, None if plain else weight, wy)
        return sums(codes, layout, rows, at, nodes, None if plain else weight[rows], wy[rows])

    # groups of at most ``most`` nodes of a level: their numbers, depth, rows, the rows' nodes, and sums
    waiting = [(np.zeros(1, np.int64), 0, np.arange(n), np.zeros(n, np.int64), counted(None, np.zeros(n, np.int64), 1))] if depth else []
    while waiting:
        nodes, level, rows, at, found = waiting.pop()
        gain, f, c, nl, sl = best_splits(layout.by_bin(found), layout.starts, least, allow(len(nodes)) if allow else None)
        own = np.flatnonzero(f >= 0)
        if not len(own):
            leaf[rows] = nodes[at]
            continue
        np.add.at(gains, f[own], gain[own])
        all_ = found[:, own, :layout.edges[1]].sum(2)
        sides = np.stack([np.stack([nl[own], all_[0] - nl[own]], 1), np.stack([sl[own], all_[1] - sl[own]], 1)])  # (rows and sum, node, side)
        first = size + 2 * np.arange(len(own))
        splits.append((nodes[own], f[own], c[own], first))
        value.append((sides[1] / sides[0]).ravel())
        size += 2 * len(own)
        # where the rows go
        number = np.full(len(nodes), -1)
        number[own] = np.arange(len(own))
        if len(own) < len(nodes):
            stays = number[at] >= 0
            leaf[rows[~stays]] = nodes[at[~stays]]
            rows, at = rows[stays], at[stays]
        goes = 2 * number[:, None] + (layout.bins[f] > c[:, None])
        to = goes.ravel()[(at << 8) + flat[(layout.column[f] * n)[at] + rows]]
        if level + 1 == depth:
            leaf[rows] = first[0] + to
            continue
        open_ = sides[0] >= 2 * least
        # of two open children the one with fewer rows is counted, the other is what it leaves of the parent
        counts = open_ & ~open_[:, ::-1]
        both = np.flatnonzero(open_.all(1))
        fewer = sides[0][both].argmin(1)
        counts[both, fewer] = True
        slot = np.full(2 * len(own), -1)
        chosen = np.flatnonzero(counts.ravel())
        slot[chosen] = np.arange(len(chosen))
        opened = np.flatnonzero(open_.ravel())
        place = slot[to]
        some = place >= 0
        part = counted(rows[some], place[some], len(chosen)) if len(chosen) else None
        children = np.empty((2, len(opened), layout.edges[-1]))
        chosen, left_over = slot[opened] >= 0, opened[slot[opened] < 0]
        if chosen.any():
            children[:, chosen] = part[:, slot[opened[chosen]]]
        if len(left_over):
            rest = found[:, own[left_over // 2]] - part[:, slot[left_over ^ 1]]
            rest[1][rest[0] == 0] = 0.0
            children[:, ~chosen] = rest
        index = np.full(2 * len(own), -1)
        index[opened] = np.arange(len(opened))
        at = index[to]
        if len(opened) < 2 * len(own):
            ends = at < 0
            leaf[rows[ends]] = first[0] + to[ends]
            rows, at = rows[~ends], at[~ends]
        numbers = first[0] + opened
        if len(opened) <= most:
            if len(opened):
                waiting.append((numbers, level + 1, rows, at, children))
            continue
        for lo in range(0, len(opened), most):
            here = (at >= lo) & (at < lo + most)
            waiting.append((numbers[lo:lo + most], level + 1, rows[here], at[here] - lo, children[:, lo:lo + most].copy()))
    tree = Tree(np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size, np.int32), np.concatenate(value))
    for nodes, f, c, first in splits:
        tree.feature[nodes], tree.cut[nodes], tree.left[nodes] = f, c, first
    return tree, gains, leaf


class Block(NamedTuple):
    """Rows: a number to draw with, codes (columns x rows), target, the sum of the trees so far, and what was drawn (tree -> weights)."""

    number: int
    codes: np.ndarray
    y: np.ndarray
    sum: np.ndarray
    drawn: dict[int, np.ndarray] | None = None


class Binned:
    """The coded rows of a training table, kept while models are grown from them."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, bins: int = 32, seed: int = 42):
        self.features, names = list(features), [*features, label]
        rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
        self.n = n = rows.count()
        if not n:
            raise ValueError("no rows to grow trees from")
        most = max(bins * bins, SAMPLE)
        some = rows if n <= most else rows.sample(False, most / n, seed)
        sample = np.array(some.drop(f"x{len(self.features)}").limit(2 * most).collect(), dtype=float)  # about SAMPLE rows
        self.cuts = cuts = [thresholds(x[np.isfinite(x)], min(bins, n)) for x in sample.T] if len(sample) else [np.empty(0)] * len(self.features)
        widths = [len(c) + 1 for c in cuts]
        columns = sharing(encoded(np.nan_to_num(sample).T, cuts), widths) if len(sample) else [[f] for f in range(len(widths))]

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, i, waiting = TaskContext.get().partitionId(), 0, []

            def block() -> pa.RecordBatch:
                codes, y = (np.concatenate(p, axis=-1) for p in zip(*waiting))
                return pa.RecordBatch.from_arrays([pa.array([(part << 32) + i]), pa.array([codes.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["number", "codes", "y"])

            for batch in batches:
                if batch.num_rows:
                    *x, y = [c.to_numpy(zero_copy_only=False).astype(float, copy=False) for c in batch.columns]
                    if any(np.isnan(v).any() for v in (*x, y)):
                        raise ValueError("a feature or label is NULL or NaN: impute or reject such rows first")
                    waiting.append((encoded(x, cuts), y))
                    if sum(len(y) for _, y in waiting) >= BLOCK:
                        yield block()
                        i, waiting = i + 1, []
            if waiting:
                yield block()

        def unpacked(r) -> tuple[int, np.ndarray, np.ndarray]:
            y = np.frombuffer(r["y"])
            return r["number"], np.frombuffer(r["codes"], np.uint8).reshape(-1, len(y)), y

        parts = max(1, min(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / 10_000)))
        parts = max(parts, math.ceil(n / (10 * BLOCK)))
        plain = rows.mapInArrow(coded, "number long, codes binary, y binary").repartition(parts).rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)
        every = Layout(widths, columns, [np.empty(0, np.int64)] * len(columns))
        keys = plain.mapPartitions(lambda some: [_combinations(every, some)]).treeReduce(_united)
        # a column with more combinations than a byte holds is taken apart
        split = [[c] if k is not None else [[f] for f in c] for c, k in zip(columns, keys)]
        keys = [[k] if k is not None else [np.arange(widths[f]) for f in c] for c, k in zip(columns, keys)]
        self.starts = layout = Layout(widths, sum(split, []), sum(keys, []))
        self.blocks = plain.map(lambda b: Block(b[0], layout.packed(b[1]), b[2], np.zeros(len(b[2])))).persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks.count()
        plain.unpersist()

    def close(self) -> None:
        self.blocks.unpersist()


Keys = list  # of each column the combinations found, None if there are more than 256


def _combinations(layout: Layout, blocks: Iterator[tuple]) -> Keys:
    out = [np.empty(0, np.int64)] * len(layout.columns)
    for _, codes, _ in blocks:
        out = _united(out, [layout.seen(codes, g) for g in range(len(out))])
    return out


def _united(a: Keys, b: Keys) -> Keys:
    every = [None if x is None or y is None else np.union1d(x, y) for x, y in zip(a, b)]
    return [k if k is not None and len(k) <= 256 else None for k in every]


def encoded(x: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value (features x rows): how many thresholds are below it."""
    out = np.empty((len(x), len(x[0])), np.uint8)
    for f, (c, v) in enumerate(zip(cuts, x)):
        out[f] = v > c[0] if len(c) == 1 else np.searchsorted(c, v, side="left")
    return out


Draw = Callable[[Block, int], np.ndarray]  # the weight of each row for a tree
Target = Callable[[Block], np.ndarray]


def _counted(blocks: RDD, layout: Layout, partial: dict[int, Tree], wanted: list[tuple[int, int]], draw: Draw, target: Target) -> np.ndarray:
    """Sums per bin of the wanted (tree, node)s over all rows, SLOTS of them in a pass."""
    parts = []
    for lo in range(0, len(wanted), SLOTS):
        slots: dict[int, np.ndarray] = {}
        for i, (t, node) in enumerate(wanted[lo:lo + SLOTS]):
            slots.setdefault(t, np.full(len(partial[t].feature), -1))[node] = i
        size, own = len(wanted[lo:lo + SLOTS]), {t: partial[t] for t in slots}

        def add(some: Iterator[Block], slots=slots, size=size, own=own) -> Iterator[np.ndarray]:
            out = np.zeros((2, size, layout.edges[-1]))
            for b in some:
                y = target(b)
                for t, tree in own.items():
                    weight, at = draw(b, t), slots[t]
                    at = np.full(len(y), at[0]) if len(at) == 1 else at[tree.leaves(b.codes, layout)]
                    here = np.flatnonzero((at >= 0) & (weight > 0))
                    if len(here):
                        at, weight = at[here], weight[here]
                        first, last = at.min(), at.max() + 1
                        out[:, first:last] += sums(b.codes, layout, None if len(here) == len(y) else here, at - first, last - first,
                                                   None if (weight == 1).all() else weight, weight * y[here])
            yield layout.by_bin(out)

        parts.append(blocks.mapPartitions(add).treeReduce(np.add))
    return np.concatenate(parts, axis=1)


def _grow_top(blocks: RDD, layout: Layout, trees: dict[int, Growing], depth: int, least: float, above: float, draw: Draw, target: Target,
              allow: Callable[[int], np.ndarray] | None = None) -> None:
    """Split the nodes of more than ``above`` rows from sums over all rows, level by level."""
    open_ = [(t, 0) for t, g in trees.items() if g.n[0] > above]
    known: dict[tuple[int, int], np.ndarray] = {}  # the sums of nodes whose children are open
    pairs: dict[tuple[int, int], tuple[tuple[int, int], tuple[int, int]]] = {}  # node -> parent and sibling
    while open_:
        # of two children the smaller one is counted, the other is what it leaves of the parent
        less = [min(x, pairs[x][1], key=lambda y: (trees[y[0]].n[y[1]], y[1])) if x in pairs else x for x in open_]
        counted = {x: i for i, x in enumerate(dict.fromkeys(less))}
        partial = {t: trees[t].tree() for t in {t for t, _ in counted}}
        found = _counted(blocks, layout, partial, list(counted), draw, target)
        every = np.empty((2, len(open_), layout.starts[-1]))
        for i, x in enumerate(open_):
            if x in counted:
                every[:, i] = found[:, counted[x]]
            else:
                parent, sibling = pairs[x]
                every[:, i] = known[parent] - found[:, counted[sibling]]
                every[1, i][every[0, i] == 0] = 0.0
        allowed = allow(len(open_)) if allow else None
        gain, feature, cut, nl, sl = best_splits(every, layout.starts, least, allowed)
        n, s = every[:, :, :layout.starts[1]].sum(2)
        following, known = [], {}
        for i, (t, node) in enumerate(open_):
            g = trees[t]
            if not node and n[i]:
                g.value[0], g.n[0] = s[i] / n[i], n[i]
            if feature[i] >= 0:
                a, b = g.split(node, gain[i], int(feature[i]), int(cut[i]), [(nl[i], sl[i]), (n[i] - nl[i], s[i] - sl[i])])
                known[t, node] = every[:, i]
                pairs[t, a], pairs[t, b] = ((t, node), (t, b)), ((t, node), (t, a))
                following += [(t, x) for x in (a, b) if g.n[x] > max(above, 2 * least - 1) and g.depth[x] < depth]
        open_ = following


def _dealt(nodes: dict[tuple[int, int], float], parts: int) -> dict[tuple[int, int], int]:
    """A part for each (tree, node), near equal in rows."""
    loads, out = [(0.0, i) for i in range(parts)], {}
    for x, n in sorted(nodes.items(), key=lambda x: (-x[1], x[0])):
        load, i = heapq.heappop(loads)
        out[x] = i
        heapq.heappush(loads, (load + n, i))
    return out


def _order(x: np.ndarray) -> np.ndarray:
    """The stable order of non-negative numbers (16 bits sort fastest)."""
    return np.argsort(x.astype(np.uint16) if len(x) and x.max() < 1 << 16 else x, kind="stable")


def _finished(blocks: RDD, layout: Layout, growing: dict[int, Growing], depth: int, least: float, draw: Draw) -> None:
    """Deal the rows of the nodes that are left to split and put their subtrees, finished in tasks, in place."""
    nodes = {(t, x): g.n[x] for t, g in growing.items() for x, (f, d) in enumerate(zip(g.feature, g.depth)) if f < 0 and d < depth and g.n[x] >= 2 * least}
    if not nodes:
        return
    total = sum(nodes.values())
    parts = max(min(3 * blocks.context.defaultParallelism, len(nodes)), math.ceil(total / PART))
    to, below = _dealt(nodes, parts), {x: depth - growing[x[0]].depth[x[1]] for x in nodes}
    partial, place = {t: growing[t].tree() for t in {t for t, _ in nodes}}, {}
    for (t, x), i in to.items():
        place.setdefault(t, np.full(len(partial[t].feature), -1))[x] = i

    def deal(b: Block, partial=partial, place=place) -> Iterator[tuple]:
        for t, tree in partial.items():
            weight, leaf = draw(b, t), tree.leaves(b.codes, layout)
            part = place[t][leaf]
            rows = np.flatnonzero((weight > 0) & (part >= 0))
            rows = rows[_order(part[rows])]
            own = part[rows]
            ends = np.flatnonzero(np.diff(own, append=-1)) + 1
            for lo, hi in zip([0, *ends[:-1]], ends):
                some = rows[lo:hi]
                yield int(own[lo]), (t, b.number, leaf[some].astype(np.int32), b.codes[:, some], b.y[some], weight[some].astype(np.uint8))

    def finish(dealt: Iterator[tuple], below=below) -> Iterator[tuple[int, int, Tree, np.ndarray]]:
        pieces: dict[int, list] = {}
        for _, (t, *piece) in dealt:
            pieces.setdefault(t, []).append(piece)
        while pieces:
            t, some = pieces.popitem()
            _, leaf, codes, y, weight = zip(*sorted(some, key=lambda p: p[0]))
            leaf = np.concatenate(leaf)
            order = _order(leaf)
            y, weight = np.concatenate(y)[order], np.concatenate(weight)[order].astype(float)
            codes, leaf = np.take(np.concatenate(codes, axis=1), order, axis=1), leaf[order]
            ends = np.flatnonzero(np.diff(leaf, append=-1)) + 1
            for lo, hi in zip([0, *ends[:-1]], ends):
                node = int(leaf[lo])
                yield t, node, *grown(np.ascontiguousarray(codes[:, lo:hi]), y[lo:hi], weight[lo:hi], layout, below[t, node], least)[:2]

    for t, node, tree, gains in blocks.flatMap(deal).partitionBy(parts, int).mapPartitions(finish).collect():
        growing[t].graft(node, tree, gains)
    blocks.context._jvm.System.gc()  # the dealt rows' files go with what names them


def forest(data: Binned, trees: int, depth: int, least: float = 1, seed: int = 42, bagged: bool = True) -> list[tuple[Tree, np.ndarray]]:
    """Trees of ``depth`` levels at most with their features' gains: each over its own Poisson(1) draw of
    the rows, or one over all of them."""
    def draw(b: Block, t: int) -> np.ndarray:
        if b.drawn is not None:
            return b.drawn[t]
        return np.random.default_rng([seed, t, b.number]).poisson(1.0, len(b.y)) if bagged else np.ones(len(b.y), np.int64)

    def target(b: Block) -> np.ndarray:
        return b.y

    layout, out = data.starts, []
    together, dealt = max(1, SLOTS // math.ceil(data.n / LOCAL)), max(1, DEALT // data.n)
    for first in range(0, trees, together):
        growing = {t: Growing(len(layout.widths), 0.0, data.n) for t in range(first, min(first + together, trees))}
        blocks = data.blocks
        if data.n > LOCAL:  # several passes: draw once
            own = [*growing]
            blocks = blocks.map(lambda b, own=own: b._replace(drawn={t: draw(b, t).astype(np.uint8) for t in own})).persist(StorageLevel.MEMORY_AND_DISK)
            _grow_top(blocks, layout, growing, depth, least, LOCAL, draw, target)
        for lo in range(first, first + len(growing), dealt):
            _finished(blocks, layout, {t: growing[t] for t in growing if lo <= t < lo + dealt}, depth, least, draw)
        if blocks is not data.blocks:
            blocks.unpersist()
        out += [(g.tree(), g.gains) for g in growing.values()]
    return out


def boosted(data: Binned, rounds: int, depth: int, step: float, least: float = 1, rate: float = 1.0, share: float = 1.0, seed: int = 42) -> list[tuple[float, Tree, np.ndarray]]:
    """Trees with their weights and gains: the first fits the target, each other one twice what is left of it
    (the squared error's gradient), over ``rate`` of the rows, each node with ``share`` of the features."""
    layout, width = data.starts, len(data.starts.widths)
    taken = max(1, math.ceil(share * width))

    def draw(b: Block, t: int) -> np.ndarray:
        return np.ones(len(b.y), np.uint8) if rate >= 1 else (np.random.default_rng([seed, t, b.number]).random(len(b.y)) < rate).astype(np.uint8)

    def allowing() -> Callable[[int], np.ndarray] | None:
        rng = np.random.default_rng(seed)
        return (lambda nodes: rng.random((nodes, width)).argsort(1) < taken) if taken < width else None

    def boost(some: Iterator[Block]) -> Iterator[tuple[float, Tree, np.ndarray]]:
        every, allow = sorted(some, key=lambda b: b.number), allowing()
        codes, y = np.concatenate([b.codes for b in every], axis=1), np.concatenate([b.y for b in every])
        every = [b._replace(codes=None) for b in every]
        upto = np.zeros(len(y))
        for r in range(rounds):
            left = 2 * (y - upto) if r else y
            taking = np.concatenate([draw(b, r) for b in every]) > 0
            if taking.all():
                tree, gains, leaf = grown(codes, left, np.ones(len(y)), layout, depth, least, allow)
            elif taking.any():
                leaf, rows, others = np.empty(len(y), np.int64), np.flatnonzero(taking), np.flatnonzero(~taking)
                tree, gains, leaf[rows] = grown(np.take(codes, rows, axis=1), left[rows], np.ones(len(rows)), layout, depth, least, allow)
                leaf[others] = tree.leaves(np.take(codes, others, axis=1), layout)
            else:  # no row was drawn
                tree, gains, leaf = Growing(width, 0.0, 1).tree(), np.zeros(width), np.zeros(len(y), np.int64)
            weight = step if r else 1.0
            yield weight, tree, gains
            upto += weight * tree.value[leaf]

    if data.n <= LOCAL:
        return data.blocks.coalesce(1).mapPartitions(boost).collect()
    blocks, pending, out, allow = data.blocks, [], [], allowing()
    for r in range(rounds):
        def upto(b: Block, pending=tuple(pending)) -> np.ndarray:
            return sum((weight * tree.value[tree.leaves(b.codes, layout)] for weight, tree in pending), b.sum)

        def target(b: Block, upto=upto, first=not r) -> np.ndarray:
            return b.y if first else 2 * (b.y - upto(b))

        if len(pending) == REFRESH:
            before, blocks = blocks, blocks.map(lambda b, upto=upto: b._replace(sum=upto(b))).persist(StorageLevel.MEMORY_AND_DISK)
            blocks.count()
            if before is not data.blocks:
                before.unpersist()
            pending = []

            def target(b: Block) -> np.ndarray:
                return 2 * (b.y - b.sum)
        g = Growing(width, 0.0, data.n)
        _grow_top(blocks, layout, {r: g}, depth, least, 0, draw, target, allow)
        weight = step if r else 1.0
        out.append((weight, g.tree(), g.gains))
        pending.append((weight, out[-1][1]))
    if blocks is not data.blocks:
        blocks.unpersist()
    return out


class TreeModel:
    """Grown trees as a fitted model: ``transform`` adds ``prediction``, the weighted sum of the trees."""

    def __init__(self, features: Sequence[str], cuts: Sequence[np.ndarray], trees: list[tuple[float, Tree]], gains: np.ndarray):
        self.features, self.cuts, self.trees = list(features), list(cuts), trees
        self.featureImportances = Vectors.dense(gains / gains.sum() if gains.sum() > 0 else gains)
        self.stages = [self]

    def transform(self, df: DataFrame) -> DataFrame:
        told = df.sparkSession.sparkContext.broadcast((self.cuts, self.trees))

        @F.pandas_udf("double")
        def predict(*columns):
            cuts, trees = told.value
            x = [c.to_numpy(float) for c in columns]
            if any(np.isnan(v).any() for v in x):
                raise ValueError("a feature is NULL or NaN: impute or reject such rows first")
            codes, out = encoded(x, cuts), np.zeros(len(x[0]))
            for weight, tree in trees:
                out += weight * tree.value[tree.leaves(codes)]
            return type(columns[0])(out)

        return df.withColumn("prediction", predict(*[F.col(c).cast("double") for c in self.features]))


def fit(data: Binned, est) -> TreeModel:
    """The model of Spark ML's decision tree, random forest or boosted tree ``est`` (its parameters), grown from binned rows."""
    kind, depth, least, seed = type(est).__name__, est.getMaxDepth(), est.getMinInstancesPerNode(), est.getSeed() % (1 << 32)
    if kind == "GBTRegressor":
        strategy = est.getFeatureSubsetStrategy()
        found = boosted(data, est.getMaxIter(), depth, est.getStepSize(), least, est.getSubsamplingRate(), 1.0 if strategy in ("all", "auto") else float(strategy), seed)
        trees, gains = [(w, t) for w, t, _ in found], [g for *_, g in found]
    else:
        count = est.getNumTrees() if kind == "RandomForestRegressor" else 1
        grown_ = forest(data, count, depth, least, seed, bagged=count > 1)
        # a forest's trees count alike, whatever their gains
        trees, gains = [(1 / count, t) for t, _ in grown_], [g / g.sum() if g.sum() > 0 else g for _, g in grown_]
    return TreeModel(data.features, data.cuts, trees, np.sum(gains, axis=0))


def grows(est) -> bool:
    """Whether ``fit`` covers the estimator's parameters."""
    kind = type(est).__name__
    if kind not in ("DecisionTreeRegressor", "RandomForestRegressor", "GBTRegressor") or est.getMinInfoGain() > 0 or est.isDefined("weightCol") or est.getImpurity() != "variance":
        return False
    strategy = "all" if kind == "DecisionTreeRegressor" else est.getFeatureSubsetStrategy()
    if kind == "GBTRegressor":
        return strategy in ("all", "auto") or "." in strategy
    return strategy == "all" and (kind == "DecisionTreeRegressor" or est.getSubsamplingRate() == 1.0 and est.getBootstrap()) and est.getMinWeightFractionPerNode() == 0
