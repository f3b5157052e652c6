"""Random forests of tables that Spark's own forest cannot hold.

Spark's estimator caches every row with one count per tree and visits each row once per tree and level, row by row: some 500
bytes and 120 x 5 visits a row.  ``fit`` grows the same forest from the same bins, bootstrap, feature subsets, gains
and pruning, and gives it back as Spark's own model.  Rows are kept as blocks of bin numbers (two bytes a feature); a row's
count in a tree is drawn from the block's and the tree's number whenever it is needed, so it is not kept at all.  Each level
is one pass: tasks add up the label statistics of every open node, feature and bin, the sums meet per tree (``reduceByKey``),
and only the chosen splits reach the driver.

What differs from Spark's estimator: the random draws, and the thresholds of a feature with more values than bins (quantiles of
all rows here, of a sample there).  With ``bootstrap=False`` and all features the trees are equal, which is tested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import remove_folder, work_dir

BLOCK_ROWS = 32_768  # a block and its temporary arrays stay in a core's cache
QUANTILES_PER_BIN = 16  # ranks of the quantiles are exact to this part of a bin
_EPSILON = np.finfo(float).eps


@dataclass(frozen=True)
class Bins:
    """How one feature is binned: by thresholds, or one bin a category."""

    thresholds: tuple[float, ...] = ()
    categories: int = 0

    @property
    def n(self) -> int:
        return self.categories or len(self.thresholds) + 1


@dataclass(frozen=True)
class Law:
    """What is the same for all nodes."""

    bins: tuple[Bins, ...]
    classes: int  # 0: regression
    trees: int
    subset: int
    depth: int
    seed: int
    bootstrap: bool
    min_rows: int
    min_gain: float

    @property
    def width(self) -> int:
        """Statistics a bin: rows of each class, or rows, sum and sum of squares."""
        return self.classes or 3

    def features(self, tree: int, node: int) -> tuple[int, ...]:
        """The features that a node may split on."""
        return _subset(len(self.bins), self.subset, self.seed, tree, node)


@lru_cache(maxsize=1 << 16)
def _subset(n: int, k: int, seed: int, tree: int, node: int) -> tuple[int, ...]:
    return tuple(range(n)) if n == k else tuple(np.random.default_rng([seed, 1, tree, node]).choice(n, k, replace=False).tolist())


@dataclass
class Node:
    stats: np.ndarray | None = None
    open: bool = True
    valid: bool = True
    gain: float = -1.0
    feature: int = -1
    left: object = None  # last bin that goes left, or the categories that do


# ------------------------------------------------------------------ statistics
def impurity(stats: np.ndarray, classes: int) -> np.ndarray:
    """Gini impurity or variance along the last axis; 0 without rows."""
    n = stats.sum(-1) if classes else stats[..., 0]
    some = np.where(n > 0, n, 1.0)
    if classes:
        return np.where(n > 0, 1.0 - ((stats / some[..., None]) ** 2).sum(-1), 0.0)
    return np.where(n > 0, (stats[..., 2] - stats[..., 1] ** 2 / some) / some, 0.0)


def rows_of(stats: np.ndarray, classes: int) -> np.ndarray:
    return stats.sum(-1) if classes else stats[..., 0]


def predicted(stats: np.ndarray, classes: int) -> float:
    return float(np.argmax(stats)) if classes else float(stats[1] / stats[0]) if stats[0] else 0.0


def best_of_feature(law: Law, feature: int, stats: np.ndarray, parent: np.ndarray):
    """The best split of one feature: gain, what goes left, statistics of both sides; None without a valid one."""
    bins = law.bins[feature]
    if bins.categories:
        n = rows_of(stats, law.classes)
        centre = stats[:, 1] if law.classes else stats[:, 1] / np.where(n > 0, n, 1.0)
        order = np.argsort(np.where(n > 0, centre, np.finfo(float).max), kind="stable")
        stats = stats[order]
    left = np.cumsum(stats, axis=0)
    left, right = left[:-1], left[-1] - left[:-1]
    if not len(left):
        return None
    n_left, n_right = rows_of(left, law.classes), rows_of(right, law.classes)
    total = n_left + n_right
    gain = impurity(parent, law.classes) - n_left / total * impurity(left, law.classes) - n_right / total * impurity(right, law.classes)
    gain = np.where((n_left < law.min_rows) | (n_right < law.min_rows) | (gain < law.min_gain), -np.inf, gain)
    at = int(np.argmax(gain))
    if not np.isfinite(gain[at]):
        return None
    return float(gain[at]), tuple(order[:at + 1].tolist()) if bins.categories else at, left[at], right[at]


def best_splits(law: Law, tree: int, nodes: Sequence[tuple[int, np.ndarray | None]], sums: np.ndarray) -> list[tuple]:
    """(tree, node, its statistics, best split of its features or None) for the nodes whose ``sums`` these are."""
    size = len(sums) // law.width
    table = sums.reshape(size, -1) if law.classes else np.column_stack([sums[:2 * size].reshape(size, 2), sums[2 * size:]])
    out, at = [], 0
    for node, stats in nodes:
        best = None
        for feature in law.features(tree, node):
            own = table[at:at + law.bins[feature].n]
            at += len(own)
            stats = own.sum(0) if stats is None else stats
            found = best_of_feature(law, feature, own, stats) if len(own) > 1 else None
            if found and (best is None or found[0] > best[1]):
                best = (feature, *found)
        out.append((tree, node, stats, best))
    return out


# ------------------------------------------------------------------ passes over the rows
def _poisson_table() -> tuple[np.ndarray, np.ndarray]:
    """Poisson(1) counts by 16 random bits, and the cumulative shares that settle the undecided ones (marked 255)."""
    cumulative = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    low = np.searchsorted(cumulative, np.arange(65_536) / 65_536, side="right")
    high = np.searchsorted(cumulative, (np.arange(65_536) + 1 - 1e-9) / 65_536, side="right")
    return np.where(low == high, low, 255).astype(np.uint8), cumulative


_COUNTS, _CUMULATIVE = _poisson_table()


def drawn(seed: int, block: int, tree: int, n: int) -> np.ndarray:
    """How often each row of a block occurs in a tree's bootstrap sample: Poisson(1), the same whenever it is asked."""
    source = np.random.SFC64([seed, 0, block, tree])
    bits = source.random_raw(-(-n // 4)).view(np.uint16)[:n]
    counts = _COUNTS.take(bits)
    undecided = np.flatnonzero(counts == 255)
    shares = (bits[undecided] + np.random.Generator(source).random(len(undecided))) / 65_536
    counts[undecided] = np.searchsorted(_CUMULATIVE, shares, side="right")
    return counts


class Paths:
    """The way of a row through a tree to its open nodes, all of one level, as tables by node.

    A node's statistics lie together, feature by feature and bin by bin; ``starts`` are their places in the sums.
    """

    def __init__(self, law: Law, tree: int, grown: dict[int, Node], nodes: Sequence[int]):
        self.steps, level = [], nodes[0].bit_length() - 1
        for depth in range(level):
            here = [grown.get(n, Node()) for n in range(1 << depth, 2 << depth)]
            features = np.array([max(node.feature, 0) for node in here])
            goes = np.zeros((len(here), max(law.bins[f].n for f in features)), np.uint8)  # 1: to the right
            for row, node in zip(goes, here):
                if isinstance(node.left, tuple):
                    row[:] = 1
                    row[list(node.left)] = 0
                elif node.feature >= 0:
                    row[node.left + 1:] = 1
            self.steps.append((features, goes))
        self.wanted = np.zeros(1 << level, bool)
        self.features, self.starts = np.zeros((2, law.subset, 1 << level), np.intp)
        self.size = 0
        for node in nodes:
            place = node - (1 << level)
            self.wanted[place] = True
            for k, f in enumerate(law.features(tree, node)):
                self.features[k, place], self.starts[k, place] = f, self.size
                self.size += law.bins[f].n

    def add(self, law: Law, tree: int, block: int, binned: np.ndarray, label: np.ndarray, sums: np.ndarray) -> None:
        """Add one block's rows to the sums of the open nodes."""
        n = len(label)
        counts = drawn(law.seed, block, tree, n) if law.bootstrap else np.ones(n, np.uint8)
        rows, flat = np.flatnonzero(counts != 0), binned.ravel()
        at = np.zeros(len(rows), np.intp)
        for features, goes in self.steps:
            x = flat.take((features * n).take(at) + rows)
            at = 2 * at + goes.ravel().take(at * goes.shape[1] + x)
        if not self.wanted.all():  # rows in finished leaves
            kept = np.flatnonzero(self.wanted.take(at))
            rows, at = rows.take(kept), at.take(kept)
        weight, y = counts.take(rows).astype(float), label.take(rows)
        if law.classes:
            classes = y.astype(np.intp)
        else:
            pairs = np.empty(len(rows), complex)  # rows and sum in one go
            pairs.real, pairs.imag = weight, weight * y
            squares, firsts = pairs.imag * y, sums[:2 * self.size].view(complex)
        for features, starts in zip(self.features, self.starts):
            place = starts.take(at) + flat.take((features * n).take(at) + rows)
            if law.classes:
                np.add.at(sums, place * law.classes + classes, weight)
            else:
                np.add.at(firsts, place, pairs)
                np.add.at(sums[2 * self.size:], place, squares)


def level_splits(blocks: RDD, law: Law, forest: list[dict[int, Node]], asked: dict[int, list[int]]) -> list[tuple]:
    """The best splits of the ``asked`` nodes (tree -> nodes of one level): one pass over the blocks."""
    shared = blocks.ctx.broadcast((law, {t: forest[t] for t in asked}))

    def add(rows: Iterator) -> Iterator[tuple[int, np.ndarray]]:
        law, grown = shared.value
        paths = {t: Paths(law, t, grown[t], nodes) for t, nodes in asked.items()}
        sums = {t: np.zeros(path.size * law.width) for t, path in paths.items()}
        for block, binned, label in rows:
            label = np.frombuffer(label)
            binned = np.frombuffer(binned, bin_type(law.bins)).reshape(len(law.bins), -1)
            for t, path in paths.items():
                path.add(law, t, block, binned, label, sums[t])
        return iter(sums.items())

    def split(item: tuple[int, np.ndarray]) -> list[tuple]:
        law, grown = shared.value
        return best_splits(law, item[0], [(n, grown[item[0]][n].stats) for n in asked[item[0]]], item[1])

    parts = min(len(asked), blocks.getNumPartitions())
    found = blocks.mapPartitions(add).reduceByKey(np.add, parts).flatMap(split).collect()  # one split per node
    shared.unpersist()
    return found


def bin_type(bins: Sequence[Bins]):
    return np.uint16 if max(b.n for b in bins) <= 65_536 else np.uint32


def write_blocks(rows: DataFrame, inputs: Sequence[str], label: str, bins: Sequence[Bins], folder: str) -> None:
    """The rows as blocks: bin numbers feature by feature, and the labels."""
    kind, bins = bin_type(bins), list(bins)

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, n, made = TaskContext.get().partitionId(), [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            y = table.column(len(inputs)).to_numpy().astype(float)
            cols = [table.column(i).to_numpy().astype(float) for i in range(len(inputs))]
            binned = np.stack([x.astype(kind) if b.categories else np.searchsorted(b.thresholds, x).astype(kind) for x, b in zip(cols, bins)])
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + made]), pa.array([binned.tobytes()], pa.binary()),
                                               pa.array([y.tobytes()], pa.binary())], names=["block", "binned", "label"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block()
                held, n, made = [], 0, made + 1
        if n:
            yield block()

    (rows.select(*[F.col(c).cast("double") for c in inputs], F.col(label).cast("double"))
     .mapInArrow(to_blocks, "block long, binned binary, label binary").write.option("parquet.block.size", 32 << 20).parquet(folder))


# ------------------------------------------------------------------ bins
def find_bins(rows: DataFrame, inputs: Sequence[str], max_bins: int) -> tuple[Bins, ...]:
    """Categories of the indexed inputs; of the others every middle between two values, or quantiles where they are too many."""
    nominal = {}
    for c in inputs:
        meta = rows.schema[c].metadata.get("ml_attr", {})
        if meta.get("type") == "nominal":
            nominal[c] = len(meta["vals"]) if "vals" in meta else int(meta["num_vals"])
    wide = {c: k for c, k in nominal.items() if k > max_bins}
    if wide:
        raise ValueError(f"max_bins is {max_bins}, but these inputs have more categories: {wide}")
    plain = [c for c in inputs if c not in nominal]
    about = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in plain]).first().asDict() if plain else {}
    thresholds, many = {}, []
    for c in plain:
        # at most max_bins + 1 values reach the driver
        values = sorted(r[0] for r in rows.select(c).distinct().limit(max_bins + 1).collect()) if about[c] <= 2 * max_bins else []
        if 0 < len(values) <= max_bins:
            thresholds[c] = tuple((a + b) / 2.0 for a, b in zip(values, values[1:]))
        else:
            many.append(c)
    if many:
        shares = [k / max_bins for k in range(1, max_bins)]
        cuts = rows.agg(*[F.percentile_approx(c, shares, QUANTILES_PER_BIN * max_bins).alias(c) for c in many]).first()
        thresholds |= {c: tuple(float(v) for v in sorted(set(cuts[c]))) for c in many}
    return tuple(Bins(categories=nominal[c]) if c in nominal else Bins(thresholds[c]) for c in inputs)


# ------------------------------------------------------------------ the forest
def grow(blocks: RDD, law: Law, max_bytes: int) -> list[dict[int, Node]]:
    """All trees, level by level; the sums of one pass stay below ``max_bytes`` (one node's at least)."""
    forest = [{1: Node()} for _ in range(law.trees)]
    for level in range(law.depth):
        waiting = [(t, n) for t, tree in enumerate(forest) for n, node in tree.items() if node.open]
        while waiting:
            asked, size = {}, 0
            while waiting:
                t, n = waiting[-1]
                size += 8 * law.width * sum(law.bins[f].n for f in law.features(t, n))
                if asked and size > max_bytes:
                    break
                asked.setdefault(t, []).append(waiting.pop()[1])
            for t, n, stats, best in level_splits(blocks, law, forest, asked):
                node = forest[t][n]
                node.stats, node.open, node.valid = stats, False, best is not None
                if best and best[1] > 0:
                    node.feature, node.gain, node.left, *sides = best
                    for child, side in zip((2 * n, 2 * n + 1), sides):
                        forest[t][child] = Node(side, open=level + 1 < law.depth and abs(float(impurity(side, law.classes))) >= _EPSILON)
    return forest


def node_rows(law: Law, tree: dict[int, Node]) -> list[tuple]:
    """A tree in the order and form in which Spark saves it; twins that predict the same are one leaf."""
    def build(n: int):
        node = tree[n]
        value, impure = predicted(node.stats, law.classes), float(impurity(node.stats, law.classes))
        if node.feature < 0:
            return (value, impure if node.valid else -1.0, node, None)
        left, right = build(2 * n), build(2 * n + 1)
        if left[3] is None and right[3] is None and left[0] == right[0]:
            return (value, impure, node, None)
        return (value, impure, node, (left, right))

    rows: list = []

    def lay(built) -> int:
        value, impure, node, sides = built
        own, stats = len(rows), node.stats
        rows.append(None)
        count = int(rows_of(stats, law.classes))
        if sides is None:
            rows[own] = (own, value, impure, stats.tolist(), count, -1.0, -1, -1, (-1, [], -1))
            return own
        bins = law.bins[node.feature]
        cut = [float(k) for k in node.left] if bins.categories else [bins.thresholds[node.left]]
        left, right = (lay(s) for s in sides)
        rows[own] = (own, value, impure, stats.tolist(), count, node.gain, left, right, (node.feature, cut, bins.categories or -1))
        return own

    lay(build(1))
    return rows


def as_model(estimator, rows: DataFrame, law: Law, forest: list[dict[int, Node]]):
    """Spark's model with these trees: a saved forest of two rows whose node table is replaced before it is loaded."""
    spark, folder = rows.sparkSession, work_dir(rows.sparkSession, "forest")
    zeros = Vectors.dense([0.0] * len(law.bins))
    toy = spark.createDataFrame([(zeros, float(k)) for k in range(2)], [estimator.getFeaturesCol(), estimator.getLabelCol()])
    model = estimator.fit(toy)
    model.save(folder)
    schema = spark.read.parquet(f"{folder}/data").schema
    remove_folder(spark, f"{folder}/data")
    nodes = [(t, row) for t, tree in enumerate(forest) for row in node_rows(law, tree)]
    spark.createDataFrame(nodes, schema, verifySchema=False).coalesce(1).write.parquet(f"{folder}/data")
    loaded = type(model).load(folder)
    remove_folder(spark, folder)
    return loaded


def fit(estimator, rows: DataFrame, inputs: Sequence[str]):
    """``estimator.fit`` of a table of any size; ``inputs`` are the columns that its vector is assembled from.

    Takes the settings that the models here use: variance or Gini impurity of two classes, feature subsets "auto" or "all".
    """
    spark, label = rows.sparkSession, estimator.getLabelCol()
    classify = isinstance(estimator, RandomForestClassifier)
    strategy, trees = estimator.getFeatureSubsetStrategy(), estimator.getNumTrees()
    if estimator.getImpurity() != ("gini" if classify else "variance") or strategy not in ("auto", "all") or estimator.getSubsamplingRate() != 1.0:
        raise ValueError("only the default impurity, feature subsets 'auto' or 'all' and a sampling rate of 1")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(label).alias("top")).first()
    if classify and seen["top"] is not None and seen["top"] > 1:
        raise ValueError(f"two classes, 0 and 1; {label} goes up to {seen['top']}")
    k = len(inputs)
    subset = k if strategy == "all" or trees == 1 else math.ceil(math.sqrt(k) if classify else k / 3.0)
    law = Law(find_bins(rows, inputs, min(estimator.getMaxBins(), seen["n"])), 2 if classify else 0, trees, subset,
              estimator.getMaxDepth(), estimator.getSeed() & 0x7FFFFFFF, estimator.getBootstrap(),
              estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
    folder = work_dir(spark, "forest_blocks")
    try:
        write_blocks(rows, inputs, label, law.bins, folder)
        blocks = spark.read.parquet(folder).rdd.map(tuple)
        forest = grow(blocks, law, estimator.getMaxMemoryInMB() << 20)
        return as_model(estimator, rows, law, forest)
    finally:
        remove_folder(spark, folder)
