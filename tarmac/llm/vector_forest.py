"""Approximate nearest neighbours (cosine) by a forest of random-projection trees.

Index.  Equal vectors become one node that carries its smallest ids, as many as can ever be
asked for.  Each tree has one random direction per level, orthonormal within the tree, and
one threshold per inner node: the median of a bounded sample's projections there.  Every
node is routed to one leaf of every tree; the trees deepen with the number of vectors
until the sample can no longer support another level.

Search.  A query keeps one priority queue over the subtrees of all trees.  A subtree's
cost is its squared distance from the query along the tree's directions; the cheapest
leaf of any tree comes next.  Queries meet the vectors of a leaf in one group (leaf sizes
are bounded by the thresholds), and each leaf returns its best rows only.  What the
leaves return is reranked on exact cosines in double precision.

How many leaves a query opens is measured, not guessed: for a bounded set of calibration
queries the exact neighbours among all vectors are found by brute force, and the budget is
the smallest one that reaches ``target_recall`` of them.

Defined results: vectors that are null, empty, zero, of another length than most, or hold
null or non-finite components take no part, nor do rows without an id; a row with the
query's own id is never its neighbour; ties go to the smaller id; fewer candidates than
``k`` give fewer rows; a repeated query id is answered once, over all its vectors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed
from tarmac.operators.sampling import bounded_sample

K = 5
TREES = 8
LEAF = 512
# Vectors that the thresholds are fitted on, and the fewest of them that a leaf may have.
SAMPLE = 50_000
SAMPLE_PER_LEAF = 16
CALIBRATION = 96
TARGET_RECALL = 0.96


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# ------------------------------------------------------------------ trees


class Forest:
    """Directions (trees x depth x dims) and thresholds (trees x inner nodes, level by level)."""

    def __init__(self, directions: np.ndarray, thresholds: np.ndarray):
        self.directions, self.thresholds = directions, thresholds
        self.trees, self.depth = directions.shape[:2]

    @classmethod
    def grown(cls, sample: np.ndarray, trees: int, depth: int, seed: int = 23) -> Forest:
        rng = np.random.default_rng(seed)
        dims = sample.shape[1]
        directions = np.zeros((trees, depth, dims))
        thresholds = np.zeros((trees, max(1, 2**depth - 1)))
        for t in range(trees):
            blocks = [np.linalg.qr(rng.standard_normal((dims, dims)))[0].T for _ in range(-(-depth // dims))]
            if depth:
                directions[t] = np.concatenate(blocks)[:depth]
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                along = sample @ directions[t, level]
                order = np.lexsort((along, node))
                counts = np.bincount(node, minlength=2**level)
                ends = np.cumsum(counts)
                for n in np.flatnonzero(counts).tolist():
                    thresholds[t, 2**level - 1 + n] = np.median(along[order[ends[n] - counts[n] : ends[n]]])
                node = 2 * node + (along > thresholds[t, 2**level - 1 + node])
        return cls(directions, thresholds)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number (over all trees) of each row in each tree."""
        out = np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2 * node + (x @ self.directions[t, level] > self.thresholds[t, 2**level - 1 + node])
            out[:, t] = (t << self.depth) + node
        return out

    def search(self, query: np.ndarray) -> Iterator[int]:
        """Leaves of all trees, the nearest first, from one shared priority queue."""
        along = self.directions @ query
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        while queue:
            cost, t, level, node = heapq.heappop(queue)
            while level < self.depth:
                margin = along[t, level] - self.thresholds[t, 2**level - 1 + node]
                side = int(margin > 0)
                heapq.heappush(queue, (cost + margin * margin, t, level + 1, 2 * node + 1 - side))
                node = 2 * node + side
                level += 1
            yield (t << self.depth) + node


# ------------------------------------------------------------------ index


def usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """(_node, _ids, _vector): distinct vectors with their k + 1 smallest ids.

    The rank filter is pushed below the shuffle, so a very common vector sends a few rows per task.
    """
    by_vector = Window.partitionBy("_vector").orderBy("_id")
    few = rows.withColumn("_rank", F.dense_rank().over(by_vector)).where(F.col("_rank") <= k + 1)
    grouped = few.groupBy("_vector").agg(F.array_sort(F.collect_set("_id")).alias("_ids"))
    return checkpointed(grouped.select(F.monotonically_increasing_id().alias("_node"), "_ids", "_vector"))


def _grow(nodes: DataFrame, dims: int, trees: int, leaf: int, sample: int) -> Forest:
    n = nodes.count()
    depth = max(0, min(math.ceil(math.log2(max(1, n / leaf))), int(math.log2(max(1, min(n, sample) / SAMPLE_PER_LEAF)))))

    def fit(batches: Iterable[pa.RecordBatch]):
        x = np.concatenate([np.empty((0, dims)), *[_matrix(b.column(0), dims) for b in batches]])
        forest = Forest.grown(_unit(x), trees, depth)
        yield pa.RecordBatch.from_arrays(
            [pa.array([forest.directions.tobytes()]), pa.array([forest.thresholds.tobytes()])], names=["d", "t"]
        )

    chosen = bounded_sample(nodes, sample, ["_node"]).select("_vector")
    found = chosen.repartition(1).mapInArrow(fit, "d binary, t binary").first()
    directions = np.frombuffer(found["d"]).reshape(trees, depth, dims)
    return Forest(directions, np.frombuffer(found["t"]).reshape(trees, -1))


# ----------------------------------------------------------------- search


def exact_scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines of the rows with a query; the sums run alike for every row, so equal rows tie."""
    return (x * query).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((query * query).sum()))


def best_rows(x: np.ndarray, unit: np.ndarray, ids: list, query: np.ndarray, own, k: int) -> list[tuple[float, int]]:
    """The k best (score, id) among rows; ids holds each row's ids in ascending order."""
    rough = unit @ (query / np.linalg.norm(query))
    take = min(len(x), k + 1)
    cut = np.partition(rough, len(x) - take)[len(x) - take]
    rows = np.flatnonzero(rough >= cut - 1e-9)  # ties at the cut stay in
    scored = zip(exact_scores(x[rows], query).tolist(), rows.tolist())
    pairs = [(-s, i) for s, r in scored for i in ids[r] if i != own]
    return [(-s, i) for s, i in heapq.nsmallest(k, pairs)]


def _budget(nodes: DataFrame, queries: DataFrame, forest: Forest, dims: int, k: int, count: int, target: float) -> int:
    """Leaves to open so that the calibration queries' exact neighbours are found often enough."""
    # at most ``count`` rows
    chosen = bounded_sample(queries, count, ["_id"]).collect()
    if not chosen:
        return 1
    probes = [(r["_id"], np.array(r["_vector"], np.float64)) for r in chosen]

    def brute(batches: Iterable[pa.RecordBatch]):
        best: dict[int, list] = {}
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            unit, ids = _unit(x), batch.column(0).to_pylist()
            where = forest.leaves(unit)
            row_of = {i: r for r, own in enumerate(ids) for i in own}
            for q, (own, vector) in enumerate(probes):
                found = [(s, i, where[row_of[i]].tolist()) for s, i in best_rows(x, unit, ids, vector, own, k)]
                best[q] = sorted(best.get(q, []) + found, key=lambda f: (-f[0], f[1]))[:k]
        rows = [(q, s, i, leaves) for q, found in best.items() for s, i, leaves in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64())))],
            names=["q", "s", "i", "leaves"],
        )

    local = nodes.select("_ids", "_vector").mapInArrow(brute, "q long, s double, i long, leaves array<long>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("s").desc(), "i"))
    exact = local.withColumn("rank", rank).where(F.col("rank") <= k).collect()  # at most count * k rows
    turns = []
    for q, (_, vector) in enumerate(probes):
        wanted = [set(r["leaves"]) for r in exact if r["q"] == q]
        for turn, leaf in enumerate(forest.search(_unit(vector[None])[0]), 1):
            turns += [turn] * sum(leaf in w for w in wanted)
            wanted = [w for w in wanted if leaf not in w]
            if not wanted:
                break
    return sorted(turns)[min(len(turns) - 1, math.ceil(target * len(turns)))] if turns else 1


def neighbours(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    calibration: int = CALIBRATION,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every query row."""
    empty = "query_id long, rank int, vec_id long, score double"
    spark = df.sparkSession
    good = df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_vector"), is_query.alias("_asks")
    )
    common = good.groupBy(F.size("_vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], empty)
    dims = common["n"]
    good = good.where(F.size("_vector") == dims)
    nodes = _nodes(good.select("_id", "_vector"), k)
    queries = good.where("_asks").select("_id", "_vector").distinct()
    forest = _grow(nodes, dims, trees, leaf, sample)
    budget = _budget(nodes, queries, forest, dims, k, calibration, target_recall)
    kind = nodes.schema["_vector"].dataType.simpleString()

    def route(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            leaves = forest.leaves(_unit(_matrix(batch.column(1), dims)))
            rows = pa.array(np.repeat(np.arange(len(leaves)), forest.trees))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves.ravel()), batch.column(0).take(rows), batch.column(1).take(rows)],
                names=["leaf", "_ids", "_vector"],
            )

    def probe(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                opened, rows = [], []
                for row, vector in enumerate(_unit(_matrix(part.column(1), dims))):
                    for _, found in zip(range(budget), forest.search(vector)):
                        opened.append(found)
                        rows.append(row)
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(opened, pa.int64()), part.column(0).take(taken), part.column(1).take(taken)],
                    names=["leaf", "_id", "_vector"],
                )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        queries_here, ids, found = right.column("_id").to_pylist(), left.column("_ids").to_pylist(), []
        if ids and queries_here:
            x = _matrix(left.column("_vector").combine_chunks(), dims)
            unit = _unit(x)
            asked = _matrix(right.column("_vector").combine_chunks(), dims)
            found = [best_rows(x, unit, ids, q, own, k) for own, q in zip(queries_here, asked)]
        kept = [(q, [{"away": -s, "id": i} for s, i in f]) for q, f in zip(queries_here, found) if f]
        return pa.table(
            {
                "query_id": pa.array([q for q, _ in kept], pa.int64()),
                "best": pa.array([b for _, b in kept], pa.list_(pa.struct([("away", pa.float64()), ("id", pa.int64())]))),
            }
        )

    index = nodes.select("_ids", "_vector").mapInArrow(route, f"leaf long, _ids array<long>, _vector {kind}")
    asked = queries.mapInArrow(probe, f"leaf long, _id long, _vector {kind}")
    per_leaf = (
        index.groupBy("leaf").cogroup(asked.groupBy("leaf"))
        .applyInArrow(meet, "query_id long, best array<struct<away: double, id: long>>")
    )
    # at most budget * k entries a query
    merged = per_leaf.groupBy("query_id").agg(F.flatten(F.collect_list("best")).alias("all"))
    nearest = F.slice(F.array_sort(F.array_distinct("all")), 1, k)
    return merged.select("query_id", F.posexplode(nearest).alias("pos", "hit")).select(
        "query_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias("vec_id"),
        (-F.col("hit.away")).alias("score"),
    )
