"""Random forests on binned columns, grown from counts of classes by node and bin.

Rows stay where they are, in a few bytes: columns of few bins share one. While a node of a tree has many rows,
one pass over all rows counts its classes by bin, for every tree at once; only counts
are shuffled. A node with at most ``LOCAL_ROWS`` draws sends its rows, once, to the task
that grows all of its subtree. What is grown is Spark's forest: Poisson draws a tree and
row, Gini, at most 32 bins a number, a random subset of the slots a node, splits whose
sides predict the same class taken back. The trees are written as a Spark model.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.session import durable, shared_path

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Draws of a node that one task grows to the end.
LOCAL_ROWS = 2_000_000
#: Rows of a block, which a task holds at once.
ROWS_PER_BLOCK = 1_000_000
#: Open nodes of a tree whose counts meet in one group, and counts weighed at once.
NODES_PER_GROUP, COUNTS_AT_ONCE = 64, 1 << 20
#: Bytes of rows that a task of the local step receives, about.
BYTES_PER_TASK = 64 << 20
#: Rows that the bins of numbers are found on, as in Spark.
SAMPLED_ROWS = 10_000
#: Bins of columns that are counted as one.
JOINT_BINS = 64
LEAF, LOCAL, OPEN = -1, -2, -3
BLOCK = "part int, block int, rows int, codes binary, labels binary"
COUNTS = "tree int, chunk int, counts binary"
DECISION = "tree int, heap int, bin int, gain double, c0 bigint, c1 bigint, l0 bigint, l1 bigint"
SENT = "tree int, heap int, rows int, codes binary, labels binary, draws binary"
GROWN = "tree int, heap array<int>, bin array<int>, gain array<double>, c0 array<bigint>, c1 array<bigint>"
NODE = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
        "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


@dataclass
class Plan:
    """The columns' bins, the slots they stand for, and how trees grow. A category's bin
    is a slot of its own, split off from all others; a number's bins are one slot, split
    after each but the last."""

    bins: list[int]
    thresholds: list[np.ndarray | None]
    groups: list[list[int]]
    column: np.ndarray
    code: np.ndarray
    slot: np.ndarray
    slots: int
    subset: int
    trees: int
    depth: int
    least: int
    weights: tuple[float, float]
    seed: int

    @property
    def starts(self) -> list[int]:
        return [0, *np.cumsum(self.bins).tolist()]

    @property
    def joint(self) -> list[int]:
        return [math.prod(self.bins[j] for j in g) for g in self.groups]

    @property
    def dtype(self):
        most = max(self.joint)
        return np.uint8 if most <= 256 else np.uint16 if most <= 65536 else np.uint32

    def __post_init__(self):
        # which side each joint code of a group takes at each split of its columns
        self.group, self.first = np.zeros((2, len(self.column)), np.int64)
        self.equal, self.wide = np.array([self.thresholds[j] is None for j in self.column]), np.zeros(len(self.column), bool)
        sides, at = [np.zeros(1, bool)], 1
        for g, (members, size) in enumerate(zip(self.groups, self.joint)):
            places = np.unravel_index(np.arange(size), [self.bins[j] for j in members])
            for j, own in zip(members, places):
                for b in np.flatnonzero(self.column == j):
                    self.group[b], self.wide[b] = g, size > max(JOINT_BINS, 256)
                    if not self.wide[b]:
                        sides.append(own == self.code[b] if self.equal[b] else own > self.code[b])
                        self.first[b] = at
                        at += size
        self.sides = np.concatenate(sides)

    def second(self, split: np.ndarray, joint: np.ndarray) -> np.ndarray:
        """Whether rows of these joint codes go to the second side of these splits."""
        wide = self.wide[split]
        if not wide.any():
            return self.sides[self.first[split] + joint]
        direct = np.where(self.equal[split], joint == self.code[split], joint > self.code[split])
        return np.where(wide, direct, self.sides[np.where(wide, 0, self.first[split] + joint)])


def grouped(bins: Sequence[int]) -> list[list[int]]:
    """Columns in groups of at most ``JOINT_BINS`` bins together, largest first."""
    groups: list[list[int]] = []
    for j in sorted(range(len(bins)), key=lambda j: -bins[j]):
        room = next((g for g in groups if math.prod(bins[k] for k in g) * bins[j] <= JOINT_BINS), None)
        groups.append([j]) if room is None else room.append(j)
    return groups


def bin_borders(values: np.ndarray, most: int) -> np.ndarray:
    """Borders between the values, if there are few, else at even shares of the rows."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) < most:
        return middle
    stride = target = len(values) / most
    total, borders = counts[0], []
    for i in range(1, len(found)):
        if abs(total - target) < abs(total + counts[i] - target):
            borders.append(middle[i - 1])
            target += stride
        total += counts[i]
    return np.array(borders[:most - 1])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers as evenly spread hashes of 64 bits."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _allowed(plan: Plan, tree: int, heap: np.ndarray) -> np.ndarray:
    """Which slots each node may split by: drawn by tree and node alone."""
    keys = _mixed(np.uint64(plan.seed) + _mixed(np.uint64(tree + 1) * np.uint64(1 << 32) + heap.astype(np.uint64)))
    lots = _mixed(keys[:, None] + np.arange(plan.slots, dtype=np.uint64)[None, :])
    allowed = np.zeros(lots.shape, bool)
    first = np.argpartition(lots, plan.subset - 1, axis=1)[:, :plan.subset]
    np.put_along_axis(allowed, first, True, axis=1)
    return allowed


def _best(plan: Plan, counts: np.ndarray, tree: int, heap: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best split of each node, as its bin (or LEAF), gain and counts of the lower side.
    ``counts``: nodes × classes × bins."""
    total = counts[:, :, :plan.bins[0]].sum(axis=2)
    low = np.empty_like(counts)
    for j, (at, size) in enumerate(zip(plan.starts, plan.bins)):
        part = counts[:, :, at:at + size]
        low[:, :, at:at + size] = total[:, :, None] - part if plan.thresholds[j] is None else np.cumsum(part, axis=2)
    rows = low[:, 0] + low[:, 1]
    fits = (rows >= plan.least) & (total.sum(axis=1)[:, None] - rows >= plan.least) & _allowed(plan, tree, heap)[:, plan.slot]
    w0, w1 = plan.weights
    a0, a1 = low[:, 0] * w0, low[:, 1] * w1
    t0, t1 = (total[:, 0] * w0)[:, None], (total[:, 1] * w1)[:, None]
    b0, b1, a, t = t0 - a0, t1 - a1, a0 + a1, t0 + t1
    b = t - a
    with np.errstate(divide="ignore", invalid="ignore"):
        # gain = Gini of the node less the sides', each by its share of the weight
        gain = (((a0 * a0 + a1 * a1) / a + (b0 * b0 + b1 * b1) / b) - (t0 * t0 + t1 * t1) / t) / t
    gain = np.where(fits, gain, -1.0)
    best = gain.argmax(axis=1)
    lines = np.arange(len(best))
    won = gain[lines, best]
    return np.where(won > 0.0, best, LEAF), won, low[lines, 0, best].astype(np.int64), low[lines, 1, best].astype(np.int64)


def _counted(plan: Plan, codes: np.ndarray, labels: np.ndarray, draws: np.ndarray, at: np.ndarray, nodes: int) -> np.ndarray:
    """Draws by node, class and bin; ``at`` is each row's node."""
    out, base = np.empty((nodes, 2, sum(plan.bins))), at * 2 + labels
    for g, (members, size) in enumerate(zip(plan.groups, plan.joint)):
        found = np.bincount(base * size + codes[g], weights=draws, minlength=nodes * 2 * size)
        found = found.reshape(nodes, 2, *(plan.bins[j] for j in members))
        for i, j in enumerate(members):
            others = tuple(k + 2 for k in range(len(members)) if k != i)
            out[:, :, plan.starts[j]:plan.starts[j] + plan.bins[j]] = found.sum(axis=others) if others else found
    return out


def _terminal(plan: Plan, heap: np.ndarray, c0: np.ndarray, c1: np.ndarray) -> np.ndarray:
    return (heap >= 1 << plan.depth) | (c0 == 0) | (c1 == 0) | (c0 + c1 < 2 * plan.least)


def _grown(plan: Plan, tree: int, root: int, codes: np.ndarray, labels: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, ...]:
    """The whole subtree below ``root``: heap, bin, gain and counts of its nodes."""
    labels, draws = labels.astype(np.int64), draws.astype(float)
    heap, at = np.array([root]), np.zeros(len(labels), np.int64)
    c1 = np.array([int(draws[labels == 1].sum())])
    c0 = np.array([int(draws.sum())]) - c1
    out = []
    if _terminal(plan, heap, c0, c1)[0]:
        return heap, np.array([LEAF]), np.array([-1.0]), c0, c1
    together = max(1, COUNTS_AT_ONCE // (2 * sum(plan.joint)))
    while len(heap):
        order = np.argsort(at, kind="stable") if len(heap) > together else None
        if order is not None:
            codes, labels, draws, at = codes[:, order], labels[order], draws[order], at[order]
        found = []
        for first in range(0, len(heap), together):
            part = heap[first:first + together]
            rows = slice(None) if order is None else slice(*np.searchsorted(at, [first, first + len(part)]))
            counts = _counted(plan, codes[:, rows], labels[rows], draws[rows], at[rows] - first, len(part))
            found.append(_best(plan, counts, tree, part))
        split, gain, l0, l1 = map(np.concatenate, zip(*found))
        out.append((heap, split, np.where(split >= 0, gain, -1.0), c0, c1))
        inner = split >= 0
        pairs = lambda low, all_: np.stack([low, all_ - low], axis=1)[inner].ravel()
        child, d0, d1 = np.stack([2 * heap, 2 * heap + 1], axis=1)[inner].ravel(), pairs(l0, c0), pairs(l1, c1)
        ends = _terminal(plan, child, d0, d1)
        out.append((child[ends], np.full(ends.sum(), LEAF), np.full(ends.sum(), -1.0), d0[ends], d1[ends]))
        heap, c0, c1 = child[~ends], d0[~ends], d1[~ends]
        if not len(heap):
            break
        # where the sides of a node lead; rows whose side ended, or whose node did, leave
        leads = np.full(2 * len(inner), -1)
        leads[np.repeat(inner, 2)] = np.where(ends, -1, np.cumsum(~ends) - 1)
        by = np.maximum(split, 0)[at]
        to = leads[2 * at + plan.second(by, codes[plan.group[by], np.arange(len(by))])]
        stays = np.flatnonzero(to >= 0)
        if len(stays) < len(to):
            codes, labels, draws, to = codes.take(stays, axis=1), labels[stays], draws[stays], to[stays]
        at = to
    return tuple(map(np.concatenate, zip(*out)))


def _blocks(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part, block, rows, codes, labels in zip(*[c.to_pylist() for c in batch.columns]):
            yield part, block, np.frombuffer(codes, plan.dtype).reshape(-1, rows), np.frombuffer(labels, np.uint8)


def _drawn(plan: Plan, part: int, block: int, codes: np.ndarray, labels: np.ndarray, tree: int, top: np.ndarray) -> tuple[np.ndarray, ...]:
    """A tree's rows of a block, their draws, and where each has got in the tree so far."""
    draws = np.random.default_rng([plan.seed, part, block, tree]).poisson(1.0, len(labels))
    rows = np.flatnonzero(draws)
    at = np.ones(len(rows), np.int64)
    while True:
        split = top[at]
        moves = np.flatnonzero(split >= 0)
        if not len(moves):
            break
        split, here = split[moves], rows[moves]
        at[moves] = 2 * at[moves] + plan.second(split, codes[plan.group[split], here])
    return rows, draws[rows], at


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def _codes(plan: Plan, x: np.ndarray) -> np.ndarray:
    """Joint codes, groups × rows, of rows of values."""
    own = [x[:, j].astype(np.int64) if t is None else np.searchsorted(t, x[:, j], side="left") for j, t in enumerate(plan.thresholds)]
    return np.stack([np.ravel_multi_index([own[j] for j in g], [plan.bins[j] for j in g]) for g in plan.groups]).astype(plan.dtype)


def _binned(plan: Plan, values: DataFrame) -> DataFrame:
    """Blocks of rows, a code a group of columns. ``values``: _label, _values (categories' places, numbers)."""

    def cut(batches):
        from pyspark import TaskContext

        part, block, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def leave():
            codes, labels = np.concatenate([h[0] for h in held], axis=1), np.concatenate([h[1] for h in held])
            return _batch([(part, block, len(labels), codes.tobytes(), labels.tobytes())], BLOCK)

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            held.append((_codes(plan, x), batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8)))
            rows += batch.num_rows
            if rows >= ROWS_PER_BLOCK:
                yield leave()
                block, held, rows = block + 1, [], 0
        if held:
            yield leave()

    return durable(values.select("_label", "_values").mapInArrow(cut, BLOCK))


def _open_nodes_split(plan: Plan, blocks: DataFrame, top: np.ndarray) -> pa.Table:
    """One pass: the best splits of all open nodes."""
    opened = [np.flatnonzero(t == OPEN) for t in top]

    def count(batches):
        sums: dict[int, np.ndarray] = {}
        for part, block, codes, labels in _blocks(plan, batches):
            for tree, heap in enumerate(opened):
                if not len(heap):
                    continue
                rows, draws, at = _drawn(plan, part, block, codes, labels, tree, top[tree])
                here = top[tree][at] == OPEN
                rows, draws, at = rows[here], draws[here], np.searchsorted(heap, at[here])
                found = _counted(plan, codes[:, rows], labels[rows], draws, at, len(heap)).astype(np.int64)
                sums[tree] = sums[tree] + found if tree in sums else found
        for tree, found in sums.items():
            chunks = range(0, len(found), NODES_PER_GROUP)
            yield _batch([(tree, k // NODES_PER_GROUP, found[k:k + NODES_PER_GROUP].tobytes()) for k in chunks], COUNTS)

    def decide(key, table):
        tree, chunk = key[0].as_py(), key[1].as_py()
        heap = opened[tree][chunk * NODES_PER_GROUP:(chunk + 1) * NODES_PER_GROUP]
        counts = sum(np.frombuffer(c.as_buffer(), np.int64) for c in table.column("counts")).astype(float).reshape(len(heap), 2, -1)
        split, gain, l0, l1 = _best(plan, counts, tree, heap)
        total = counts[:, :, :plan.bins[0]].sum(axis=2).astype(np.int64)
        ends = _terminal(plan, heap, total[:, 0], total[:, 1])
        split = np.where(ends, LEAF, split)
        return pa.Table.from_batches([_batch([(tree, *row) for row in zip(
            heap.tolist(), split.tolist(), gain.tolist(), *total.T.tolist(), l0.tolist(), l1.tolist())], DECISION)])

    return blocks.mapInArrow(count, COUNTS).groupBy("tree", "chunk").applyInArrow(decide, DECISION).toArrow()


def _subtrees(plan: Plan, blocks: DataFrame, top: np.ndarray, tasks: int) -> DataFrame:
    """The nodes left to one task each, grown to the end."""

    def send(batches):
        for part, block, codes, labels in _blocks(plan, batches):
            for tree in range(plan.trees):
                rows, draws, at = _drawn(plan, part, block, codes, labels, tree, top[tree])
                here = np.flatnonzero(top[tree][at] == LOCAL)
                order = here[np.argsort(at[here].astype(np.uint16 if plan.depth < 16 else np.int64), kind="stable")]
                rows, draws, at = rows[order], np.minimum(draws[order], 255).astype(np.uint8), at[order]
                heap, first = np.unique(at, return_index=True)
                lots = [(tree, int(h), b - a, np.ascontiguousarray(codes[:, rows[a:b]]).tobytes(), labels[rows[a:b]].tobytes(), draws[a:b].tobytes())
                        for h, a, b in zip(heap, first.tolist(), [*first[1:].tolist(), len(rows)])]
                if lots:
                    yield _batch(lots, SENT)

    def grow(key, table):
        tree, heap = key[0].as_py(), key[1].as_py()
        parts = list(zip(*[table.column(c).to_pylist() for c in ("rows", "codes", "labels", "draws")]))
        codes = np.concatenate([np.frombuffer(c, plan.dtype).reshape(-1, n) for n, c, _, _ in parts], axis=1)
        labels, draws = (np.concatenate([np.frombuffer(p[i], np.uint8) for p in parts]) for i in (2, 3))
        return pa.Table.from_batches([_batch([(tree, *_grown(plan, tree, heap, codes, labels, draws))], GROWN)])

    sent = blocks.mapInArrow(send, SENT).repartition(tasks, "tree", "heap")
    return sent.groupBy("tree", "heap").applyInArrow(grow, GROWN)


def _nodes(plan: Plan, tree: int, heap: np.ndarray, split: np.ndarray, gain: np.ndarray, c0: np.ndarray, c1: np.ndarray) -> pa.Table:
    """A tree's nodes as Spark stores them, parents first; splits whose sides both end
    and predict the same class are taken back."""
    size = 2 << plan.depth
    place = np.full(2 * size, -1)
    place[heap] = np.arange(len(heap))
    stats = np.stack([c0 * plan.weights[0], c1 * plan.weights[1]], axis=1)
    says, inner = (stats[:, 1] > stats[:, 0]).astype(float), split >= 0
    for depth in range(plan.depth - 1, -1, -1):
        here = np.flatnonzero(inner & (heap >= 1 << depth) & (heap < 2 << depth))
        low, high = place[2 * heap[here]], place[2 * heap[here] + 1]
        inner[here[~inner[low] & ~inner[high] & (says[low] == says[high])]] = False
    alive = np.zeros(2 * size, bool)
    alive[1] = True
    for depth in range(plan.depth):
        here = heap[inner & (heap >= 1 << depth) & (heap < 2 << depth) & alive[heap]]
        alive[2 * here] = alive[2 * here + 1] = True
    kept = np.sort(heap[alive[heap]])
    number = np.full(2 * size, -1)
    number[kept] = np.arange(len(kept))
    at = place[kept]
    goes, b = inner[at], np.maximum(split[at], 0)
    value = np.array([0.5 if plan.thresholds[j] is None else plan.thresholds[j][c] for j, c in zip(plan.column[b[goes]], plan.code[b[goes]])])
    weight = stats[at].sum(axis=1)
    impurity = 1.0 - (stats[at] ** 2).sum(axis=1) / weight ** 2
    lists = lambda values, lengths: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values, pa.float64()))
    i32 = lambda v: pa.array(v, pa.int32())
    cut = pa.StructArray.from_arrays([i32(np.where(goes, plan.slot[b], -1)), lists(value, goes.astype(int)), i32(np.full(len(at), -1))],
                                     ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = pa.StructArray.from_arrays(
        [i32(number[kept]), pa.array(says[at]), pa.array(impurity), lists(stats[at].ravel(), np.full(len(at), 2)), pa.array((c0 + c1)[at], pa.int64()),
         pa.array(np.where(goes, gain[at], -1.0)), i32(np.where(goes, number[2 * kept], -1)), i32(np.where(goes, number[2 * kept + 1], -1)), cut],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": i32(np.full(len(at), tree)), "nodeData": data})


@dataclass
class Scorer:
    """A forest's nodes, tree after tree: their splits, lower children and shares of each class."""

    plan: Plan
    roots: np.ndarray
    split: np.ndarray
    low: np.ndarray
    shares: np.ndarray

    def score(self, values: Column) -> Column:
        """Probability of class 1 as Spark's model gives it, rows of a batch walking each tree together."""
        plan, roots, split, low, shares = self.plan, self.roots, self.split, self.low, self.shares

        def score(given):
            codes = _codes(plan, given.flatten().to_numpy(zero_copy_only=False).reshape(len(given), -1)).astype(np.int64)
            votes = np.zeros((2, len(given)))
            for root in roots:
                node, moves = np.full(len(given), root), np.arange(len(given))
                while len(moves):
                    at = node[moves]
                    by = split[at]
                    inner = np.flatnonzero(by >= 0)
                    moves, by, at = moves[inner], by[inner], at[inner]
                    node[moves] = low[at] + plan.second(by, codes[plan.group[by], moves])
                votes += shares[:, node]
            return pa.array(votes[1] / (votes[0] + votes[1]))

        def scored(given: pa.Array) -> pa.Array:
            return score(given) if len(given) else pa.array([], pa.float64())

        return F.arrow_udf(scored, "double")(values)


def _scorer(plan: Plan, nodes: DataFrame) -> Scorer:
    n, s = F.col("nodeData"), F.col("nodeData.split")
    found = nodes.select(
        "treeID", n["id"].alias("id"), n["leftChild"].alias("low"), s["featureIndex"].alias("slot"),
        F.get(s["leftCategoriesOrThreshold"], 0).alias("at"), n["impurityStats"][0].alias("c0"), n["impurityStats"][1].alias("c1")).toArrow()
    tree, number, low, slot, at, c0, c1 = (found.column(i).to_numpy() for i in range(7))
    order = np.lexsort((number, tree))
    number, low, slot, at, c0, c1 = (x[order] for x in (number, low, slot, at, c0, c1))
    roots = np.flatnonzero(number == 0)
    sizes = np.diff([*roots, len(number)])
    split = np.full(len(slot), LEAF, np.int64)
    first = {int(plan.slot[b]): b for b in reversed(range(len(plan.slot)))}
    for k, b in first.items():
        here = np.flatnonzero(slot == k)
        borders = plan.thresholds[plan.column[b]]
        split[here] = b if borders is None else b + np.searchsorted(borders, at[here])
    shares = np.stack([c0 / (c0 + c1), c1 / (c0 + c1)])
    return Scorer(plan, roots, split, low + np.repeat(roots, sizes), shares)


def fit_forest(values: DataFrame, estimator: RandomForestClassifier, levels: Sequence[int],
               numbers: int) -> tuple[RandomForestClassificationModel, Scorer]:
    """The forest, and what scores rows by it, of ``estimator`` (its trees, depth, bins, least rows, seed) for two classes.

    ``values`` has _label (0 or 1), _weight (one a class) and _values: the places of the
    categories, which have so many ``levels`` (and a slot more each, for values never
    seen), then the ``numbers``. It is read several times: cut its lineage before.
    """
    spark = values.sparkSession
    classes = {r["_label"]: r for r in values.groupBy("_label").agg(F.max("_weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()}
    if not classes or set(classes) - {0.0, 1.0}:
        raise ValueError(f"labels are {sorted(map(str, classes))}, not 0 and 1")
    total, most = sum(r["n"] for r in classes.values()), estimator.getMaxBins()
    fraction = min(1.0, max(most * most, SAMPLED_ROWS) / total)
    sampled = values.sample(fraction=fraction, seed=estimator.getSeed()) if fraction < 1.0 else values
    found = np.array([r[0] for r in sampled.select(F.slice("_values", len(levels) + 1, max(numbers, 1))).collect()], float).reshape(-1, numbers)
    borders = [None] * len(levels) + [bin_borders(found[:, j], most) for j in range(numbers)]
    bins = [*(n + 1 for n in levels), *(len(b) + 1 for b in borders[len(levels):])]
    first = np.cumsum([0, *(n + 1 for n in levels)])
    slots = int(first[-1]) + numbers
    trees = estimator.getNumTrees()
    plan = Plan(
        bins, borders, grouped(bins), np.repeat(np.arange(len(bins)), bins), np.concatenate([np.arange(n) for n in bins]),
        np.concatenate([*(first[j] + np.arange(n + 1) for j, n in enumerate(levels)), *(np.full(n, first[-1] + j) for j, n in enumerate(bins[len(levels):]))]),
        slots, slots if trees == 1 else math.ceil(math.sqrt(slots)), trees, estimator.getMaxDepth(), estimator.getMinInstancesPerNode(),
        tuple(classes[y]["w"] if y in classes else 1.0 for y in (0.0, 1.0)), estimator.getSeed() % (1 << 63))
    blocks = _binned(plan, values)

    # ---- nodes of many rows, a level a pass
    top = np.full((trees, 2), LEAF, np.int32)
    top[:, 1] = OPEN if total > LOCAL_ROWS else LOCAL
    done: list[tuple] = []
    while (top == OPEN).any():
        top = np.concatenate([top, np.full_like(top, LEAF)], axis=1)
        for tree, heap, split, gain, c0, c1, l0, l1 in zip(*[c.to_numpy() for c in _open_nodes_split(plan, blocks, top).columns]):
            top[tree, heap] = split
            done.append((tree, heap, split, gain if split >= 0 else -1.0, c0, c1))
            if split < 0:
                continue
            for child, d0, d1 in ((2 * heap, l0, l1), (2 * heap + 1, c0 - l0, c1 - l1)):
                if _terminal(plan, np.array(child), np.array(d0), np.array(d1)):
                    done.append((tree, child, LEAF, -1.0, d0, d1))
                else:
                    top[tree, child] = LOCAL if d0 + d1 <= LOCAL_ROWS else OPEN

    # ---- all others, each in one task
    width = (len(plan.groups) * np.dtype(plan.dtype).itemsize + 2) * 0.64
    tasks = max(3 * spark.sparkContext.defaultParallelism, math.ceil(total * trees * width / BYTES_PER_TASK))
    grown = _subtrees(plan, blocks, top, min(tasks, int((top == LOCAL).sum()) or 1))
    if done:
        by_tree: dict[int, list] = {}
        for tree, *node in done:
            by_tree.setdefault(int(tree), []).append([x.item() if hasattr(x, "item") else x for x in node])
        grown = grown.unionByName(spark.createDataFrame([(t, *map(list, zip(*rows))) for t, rows in by_tree.items()], GROWN))

    def assemble(key, table):
        columns = [table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("heap", "bin", "gain", "c0", "c1")]
        return _nodes(plan, key[0].as_py(), *columns)

    nodes = grown.groupBy("tree").applyInArrow(assemble, NODE)
    # a model of as many trees and slots, whose nodes are then these
    y = F.col("id").cast("double")
    two = spark.range(0, 2, 1, 1).select(array_to_vector(F.array_repeat(y, slots)).alias(estimator.getFeaturesCol()),
                                         y.alias(estimator.getLabelCol()), F.lit(1.0).alias(estimator.getWeightCol()))
    path = shared_path(spark, "forest")
    estimator.fit(two).write().save(path)
    nodes.write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path), _scorer(plan, spark.read.parquet(f"{path}/data"))
