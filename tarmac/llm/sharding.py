"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

The unit that is placed is a group of equal texts.  Billions of groups cannot be placed
one by one, so they become a bounded number of items:

* heavy groups (over 1/64 of a shard in any of the three measures; at most 64 x shards
  per measure) are items of their own, whole unless their bytes exceed a shard's capacity.
  Then no shard can take the group, and its rows are dealt evenly to the fewest parts that fit;
* all other groups fall into ``cells`` hash cells.

The driver sees only the items' totals.  Items are placed largest first, each into the
shard where the dot product of the item's vector with the shard's residual capacity is
highest, among the shards that still have room for its bytes (bytes are the law that ends
near equal).  The item -> shard table is broadcast (bounded by the parameters).

Slots are numbered 0, 1, ... in every shard without ordering a shard in one task: rows are
numbered in small hash subdivisions of an item, and these get the counts before them.

Defined results: null texts have no bytes and no tokens and equal the empty text; null and
repeated ids are placed like others; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, text_or_empty

SHARDS = 24
CELLS = 1 << 15
HEAVY_SHARE = 1 / 64
ROWS_PER_SUBDIVISION = 100_000
ROW_BYTES = 8

MEASURES = ("size", "tokens", "one")


def pack_vectors(weights: np.ndarray, bins: int, law: int = 0) -> np.ndarray:
    """The bin of each item: largest item first, to the highest dot product with what is left.

    ``weights`` (items x measures) are scaled so that a bin's capacity is 1 in each measure.
    Only bins whose residual in the measure ``law`` still takes the item are candidates, so
    that measure ends near equal; when none takes it, the bin with the most left does.
    """
    totals = weights.sum(axis=0)
    scaled = weights / np.where(totals > 0, totals / bins, 1.0)
    left = np.ones((bins, weights.shape[1]))
    chosen = np.zeros(len(weights), np.int64)
    for item in np.argsort(-scaled.max(axis=1), kind="stable").tolist():
        fits = left[:, law] >= scaled[item, law]
        if fits.any():
            best = int(np.argmax(np.where(fits, left @ scaled[item], -np.inf)))
        else:
            best = int(np.argmax(left[:, law]))
        chosen[item] = best
        left[best] -= scaled[item]
    return chosen


def _dealt(split: DataFrame) -> DataFrame:
    """Rows of split groups with their ``_item``: runs of equal length of a group's numbered rows.

    A group's rows are numbered within the partitions that they were read in (the upper bits of ``_n``).
    """
    placed = split.withColumn("_in", F.shiftright("_n", 33))
    counts = placed.groupBy("_group", "_in").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_group").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_group", "_in", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    local = Window.partitionBy("_group", "_in").orderBy("_n")
    return (
        placed.withColumn("_local", F.row_number().over(local) - 1)
        .join(before, ["_group", "_in"])
        .withColumn("_item", F.col("_item0") + F.expr("(_before + _local) * _parts div _of"))
    )


def shard(
    df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS
) -> DataFrame:
    """One row per input row: id, size, tokens, text_crc32, shard, slot."""
    spark = df.sparkSession
    text = text_or_empty(text_col)
    words = F.size(F.split(F.trim(text), r"\s+"))
    rows = checkpointed(
        df.select(
            F.col(id_col).alias("_id"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.when(F.trim(text) == "", 0).otherwise(words).cast("long").alias("tokens"),
            F.lit(1).cast("long").alias("one"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_group"),
            F.monotonically_increasing_id().alias("_n"),
        )
    )
    groups = rows.groupBy("_group").agg(*[F.sum(m).alias(m) for m in MEASURES])
    total = groups.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    capacity = {m: max(1.0, (total[m] or 0) / shards) for m in MEASURES}
    share = F.greatest(*[F.col(m) / F.lit(capacity[m]) for m in MEASURES])
    # at most len(MEASURES) * shards / HEAVY_SHARE groups can be heavy
    heavy = groups.where(share > HEAVY_SHARE).collect()
    numbered, item = [], cells
    for g in sorted(heavy, key=lambda g: g["_group"]):
        fitting = max(1, int(capacity["size"] // (g["size"] // g["one"])))  # rows of this text that a shard takes
        parts = 1 if g["size"] <= capacity["size"] else -(-g["one"] // fitting)
        numbered.append((g["_group"], item, parts, g["one"]))
        item += parts
    heavy_table = spark.createDataFrame(numbered, "_group long, _item0 long, _parts long, _of long")
    joined = rows.join(F.broadcast(heavy_table), "_group", "left")
    columns = ("_id", "size", "tokens", "one", "text_crc32", "_n")
    itemised = joined.where(F.coalesce("_parts", F.lit(1)) == 1).select(
        *columns, F.coalesce("_item0", F.pmod("_group", F.lit(cells))).alias("_item")
    )
    if any(parts > 1 for _, _, parts, _ in numbered):
        itemised = itemised.unionByName(_dealt(joined.where("_parts > 1")).select(*columns, "_item"))
    items = itemised.groupBy("_item").agg(*[F.sum(m).alias(m) for m in MEASURES]).orderBy("_item").collect()
    weights = np.array([[r[m] for m in MEASURES] for r in items], float).reshape(-1, len(MEASURES))
    chosen = pack_vectors(weights, shards)
    placed = spark.createDataFrame(
        [
            (int(r["_item"]), int(s), int(-(-r["one"] // ROWS_PER_SUBDIVISION)))
            for r, s in zip(items, chosen.tolist())
        ],
        "_item long, shard int, _subs long",
    )
    divided = itemised.join(F.broadcast(placed), "_item").withColumn(
        "_sub", F.pmod(F.xxhash64("_n"), F.col("_subs"))
    )
    counts = divided.groupBy("shard", "_item", "_sub").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_item", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_item", "_sub", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    local = Window.partitionBy("_item", "_sub").orderBy("_n")
    return (
        divided.withColumn("_local", F.row_number().over(local) - 1)
        .join(before, ["_item", "_sub"])
        .select(
            F.col("_id").alias(id_col), "size", "tokens", "text_crc32", "shard",
            (F.col("_before") + F.col("_local")).cast("long").alias("slot"),
        )
    )
