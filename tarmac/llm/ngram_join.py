"""N-gram Jaccard self-join with a MinHash LSH forest.

Texts are lower-cased and split at white space; a document is the set of its five-word
shingles (a shorter text is one shingle).  Two documents are linked when the Jaccard
similarity of their sets is at least ``threshold``.

1. One pass over the texts gives every document a digest of its set and ``trees`` labels
   of ``max_depth`` MinHash values.  Documents with the same set are one node from here
   on, so groups of copies are never compared.
2. The labels of each tree are range-partitioned and sorted: a prefix trie laid out in
   order, where nodes that share a prefix are neighbours.  Because the node itself is part
   of the sort key, even a prefix that very many nodes share is spread over many tasks.
   Matched prefixes start at full depth and are shortened until the chance that a pair at
   the threshold shares one in any tree reaches ``target_recall``.  Neighbours that share
   such a prefix become candidates of each other.
3. Candidates are gathered into clusters (connected components), and every pair in a
   cluster is verified on the exact sets.  Large clusters are cut into blocks, and a task
   takes two blocks at a time: it returns counts and a spanning forest, never pairs.

Defined results: texts without words (null, empty, blank) have no links and are classes of
their own; repeated rows and copies are members of one class; null ids are members like
others and rank last when a class is named; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, packed_rows, text_or_empty, unpacked_rows
from tarmac.llm.components import components

WORDS = 5
THRESHOLD = 0.8
TREES = 32
MAX_DEPTH = 8
TARGET_RECALL = 0.999
# A block of a large cluster: nodes and shingles that a task holds of it.
BLOCK_NODES = 256
BLOCK_SHINGLES = 4_000_000
CACHE_ENTRIES = 400_000


# ------------------------------------------------------ shingles, signatures


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_HASHES = _WordHashes()
_ODD = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words."""
    split = text.lower().split()
    if not split:
        return np.empty(0, np.uint64)
    if len(_HASHES) > CACHE_ENTRIES:
        _HASHES.clear()
    w = np.fromiter(map(_HASHES.__getitem__, split), np.uint64, len(split))
    n = min(words, len(split))
    h = np.full(len(split) - n + 1, n, np.uint64)
    for k in range(n):
        h += w[k : len(split) - n + 1 + k] * _ODD[k]
    h ^= h >> np.uint64(29)
    h *= _ODD[-1]
    h ^= h >> np.uint64(32)
    return np.unique(h)


def minhash(shingles: np.ndarray, functions: int) -> np.ndarray:
    """16-bit digests of the minimum of each hash function over a non-empty set."""
    rng = np.random.default_rng(17)
    flip = rng.integers(0, 2**32, (functions, 1), dtype=np.uint64).astype(np.uint32)
    odd = (rng.integers(0, 2**31, (functions, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
    x = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    least = np.full(functions, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        part = (x[at : at + 1024] ^ flip) * odd
        np.minimum(least, part.min(axis=1), out=least)
    return (least & np.uint32(0xFFFF)).astype(">u2")


def depth_for_recall(threshold: float, trees: int, max_depth: int, target: float) -> int:
    """Shorten the matched prefix from full depth until pairs at the threshold are found often enough."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= target:
            return depth
    raise ValueError(f"{trees} trees cannot reach a recall of {target} at similarity {threshold}")


def _signed(df: DataFrame, id_col: str, text_col: str, words: int, trees: int, depth: int) -> DataFrame:
    """One checkpointed row per document: _n, _id, _key, _size, _digest, _signature."""
    id_type = df.schema[id_col].dataType.simpleString()

    def sign(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, digests, signatures = [], [], []
                for text in part.column(3).to_pylist():
                    shingles = shingle_set(text, words)
                    sizes.append(len(shingles))
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                    signatures.append(minhash(shingles, trees * depth).tobytes() if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(sizes, pa.int64()),
                     pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                    names=["_n", "_id", "_key", "_size", "_digest", "_signature"],
                )

    rows = df.select(
        F.monotonically_increasing_id().alias("_n"),
        F.col(id_col).alias("_id"),
        row_key(id_col, text_col).alias("_key"),
        text_or_empty(text_col).alias("_text"),
    )
    return checkpointed(
        rows.mapInArrow(sign, f"_n long, _id {id_type}, _key binary, _size long, _digest binary, _signature binary")
    )


def row_key(id_col: str, text_col: str):
    """16 bytes that stand for (id, text): rows with the same key repeat each other."""
    whole = F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("\x00")), text_or_empty(text_col))
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


# ------------------------------------------------------------- candidates


def trie_links(labels: DataFrame, depth: int, max_depth: int) -> DataFrame:
    """Candidate edges (a, b) from rows (tree, label, node).

    ``label`` holds ``max_depth`` values of two bytes, most significant first, so binary
    order is the order of the trie.  Inside a task all nodes of a run that shares a prefix
    of ``depth`` values are linked to the run's smallest node; runs that go on in the next
    task are linked through the tasks' first and last rows.
    """
    width = 2 * max_depth

    def runs(batches: Iterable[pa.RecordBatch]):
        last = first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy()
            node = batch.column(2).to_numpy()
            label = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, width)[:, : 2 * depth]
            if last is not None:  # the run may go on from the batch before
                tree = np.concatenate([[last[0]], tree])
                node = np.concatenate([[last[2]], node])
                label = np.concatenate([last[1][None], label])
            else:
                first = (int(tree[0]), label[0].tobytes(), int(node[0]))
            same = (tree[1:] == tree[:-1]) & (label[1:] == label[:-1]).all(axis=1)
            start = np.flatnonzero(np.concatenate([[True], ~same]))
            hub = np.repeat(np.minimum.reduceat(node, start), np.diff(np.append(start, len(node))))
            linked = hub != node
            last = (tree[-1], label[-1], hub[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[linked]), pa.array(hub[linked]), *[pa.nulls(int(linked.sum()), t) for t in (pa.int32(), pa.binary(), pa.int32())]],
                names=["a", "b", "tree", "prefix", "side"],
            )
        if last is not None:
            edge = [first, (int(last[0]), last[1].tobytes(), int(last[2]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[2] for e in edge], pa.int64()), pa.nulls(2, pa.int64()), pa.array([e[0] for e in edge], pa.int32()),
                 pa.array([e[1] for e in edge], pa.binary()), pa.array([0, 1], pa.int32())],
                names=["a", "b", "tree", "prefix", "side"],
            )

    ordered = labels.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    found = checkpointed(ordered.mapInArrow(runs, "a long, b long, tree int, prefix binary, side int"))
    # two rows per task: a prefix that spans tasks links their first and last nodes
    seams = found.where("side IS NOT NULL").select("a", "tree", "prefix")
    hubs = seams.groupBy("tree", "prefix").agg(F.min("a").alias("b"))
    across = seams.join(hubs, ["tree", "prefix"]).select("a", "b").where("a <> b")
    return found.where("side IS NULL").select("a", "b").unionByName(across)


# ----------------------------------------------------------- verification


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes of all pairs of sets."""
    size = len(sets)
    total = np.zeros((size, size))
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    counts = np.diff(np.append(starts, len(flat)))
    column = np.repeat(np.arange(len(starts)), counts)
    keep = np.repeat(counts > 1, counts)
    column, owner = column[keep], owner[keep]
    if not len(column):
        return total
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    for first in range(0, int(column[-1]) + 1, 4096):
        lo, hi = np.searchsorted(column, [first, first + 4096])
        dense = np.zeros((size, 4096), np.float32)
        dense[owner[lo:hi], column[lo:hi] - first] = 1
        total += dense @ dense.T
    return total


def linked_matrix(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    sizes = np.array([len(s) for s in sets], float)
    shared = shared_counts(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest member's index of each member's connected component."""
    label = np.arange(len(linked))
    while True:
        best = np.where(linked, label[None, :], len(linked)).min(axis=1)
        following = np.minimum(label, best)
        following = following[following]
        if (following == label).all():
            return label
        label = following


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Consecutive rows with the same (cluster, i, j)."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and any(rows[0][k] != row[k] for k in ("cluster", "i", "j")):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def verified(members: DataFrame, threshold: float, words: int) -> DataFrame:
    """(node, links, root, blocks) from rows (cluster, i, j, block, blocks, node, copies, text).

    For a pair of blocks i < j only links between the two are counted, for i = j those inside.
    """

    def verify(batches: Iterable[pa.RecordBatch]):
        for rows in _groups(batches):
            unique = {r["node"]: r for r in rows}  # rows that repeat a node's document
            rows = [unique[n] for n in sorted(unique)]
            if len(rows) < 2 and rows[0]["blocks"] > 1:
                continue
            node = np.array([r["node"] for r in rows])
            copies = np.array([r["copies"] for r in rows])
            linked = linked_matrix([shingle_set(r["text"], words) for r in rows], threshold)
            if rows[0]["i"] != rows[0]["j"]:
                block = np.array([r["block"] for r in rows])
                linked &= block[:, None] != block[None, :]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array((linked * copies[None, :]).sum(axis=1), pa.int64()),
                 pa.array(node[_roots(linked)], pa.int64()), pa.array([rows[0]["blocks"]] * len(rows), pa.int64())],
                names=["node", "links", "root", "blocks"],
            )

    placed = members.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return placed.mapInArrow(verify, "node long, links long, root long, blocks long")


# ------------------------------------------------------------------- join


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per input row: id, class_id, class_size, n_links, keep.

    A class is a connected component of linked documents, named by its smallest id.
    ``n_links`` counts the other rows whose similarity reaches the threshold.  ``keep`` is
    true for one row of each class (one with the smallest id).
    """
    return _joined(df, id_col, text_col, threshold, words, trees, max_depth, target_recall).select(
        F.col("_id").alias(id_col), "class_id", "class_size", "n_links", "keep"
    )


def keep_representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of one document per class, with all their columns."""
    settings = {"threshold": THRESHOLD, "words": WORDS, "trees": TREES, "max_depth": MAX_DEPTH, "target_recall": TARGET_RECALL}
    keys = _joined(df, id_col, text_col, **{**settings, **options}).where("keep").select("_key")
    rows = packed_rows(df, row_key(id_col, text_col).alias("_key")).join(keys.distinct(), "_key", "left_semi")
    first = Window.partitionBy("_key").orderBy(F.xxhash64("_row"))  # rows that repeat id and text
    return unpacked_rows(rows.withColumn("_rank", F.row_number().over(first)).where("_rank = 1"))


def _joined(df, id_col, text_col, threshold, words, trees, max_depth, target_recall) -> DataFrame:
    depth = depth_for_recall(threshold, trees, max_depth, target_recall)
    rows = _signed(df, id_col, text_col, words, trees, max_depth)
    named = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_n").alias("n"))
    classes = rows.where("_size > 0").groupBy("_digest").agg(
        F.min("_n").alias("node"),
        F.count(F.lit(1)).alias("copies"),
        F.min_by("_key", "_n").alias("_key"),
        F.min(named).alias("_named"),
        F.max("_size").alias("_size"),
        F.first("_signature").alias("_signature"),
    )
    width = 2 * max_depth
    labels = classes.select(
        "node", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)),
                                         lambda t: F.expr("_signature").substr(t * width + 1, F.lit(width)))).alias("tree", "label")
    ).select("tree", "label", "node")
    clusters = components(trie_links(labels, depth, max_depth))
    nodes = checkpointed(classes.select("_digest", "node", "copies", "_key", "_named", "_size"))
    clustered = nodes.join(clusters, "node").select("node", "copies", "_key", "_size", F.col("component").alias("cluster"))
    shape = clustered.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("_size") / BLOCK_SHINGLES)).alias("blocks")
    )
    blocked = clustered.join(shape, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    texts = df.select(row_key(id_col, text_col).alias("_key"), text_or_empty(text_col).alias("text"))
    members = (
        texts.join(blocked, "_key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "blocks", "node", "copies", "text")
    )
    pairs = checkpointed(verified(members, threshold, words))
    links = pairs.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.max("blocks").alias("blocks"))
    several = components(pairs.where("blocks > 1").select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = links.join(several, "node", "left").select(
        "node", "links", F.when(F.col("blocks") > 1, F.coalesce("component", "node")).otherwise(F.col("root")).alias("root")
    )
    known = nodes.join(roots, "node", "left").select(
        "_digest", "copies", "_named", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    named_classes = known.groupBy("root").agg(F.min("_named").alias("_first"), F.sum("copies").alias("class_size"))
    by_digest = known.join(named_classes, "root").select("_digest", "n_links", "class_size", "_first")
    return rows.join(by_digest, "_digest", "left").select(
        "_id",
        "_key",
        F.when(F.col("_first").isNull(), F.col("_id")).otherwise(F.col("_first.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("_first").isNull() | (F.col("_first.n") == F.col("_n"))).alias("keep"),
    )
