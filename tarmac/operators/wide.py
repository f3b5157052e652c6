"""Categorical columns of any number of values in a fixed number of slots.

``StringIndexer`` sends every label of a column to the driver and makes features as wide as the column
has values.  A bounded index keeps slots of their own for the ``width`` most frequent labels and
shares ``overflow`` hashed slots among all others, so neither the driver nor the models grow with the
number of labels; one more slot is for NULL.  Slot numbers carry their names as column metadata, so the
features of a model still resolve to names.

Labels are counted by a partial aggregation, and the most frequent ones are chosen by a top-k: each task hands on
``width`` rows at most.  The chosen labels (``width`` rows, a parameter) are what is broadcast.

Defined results: ties in frequency go to the smaller label; an empty table leaves only overflow slots; the
empty text is a label; labels that the fit never saw take overflow slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import hash_bucket

OWN_SLOTS = 1000
OVERFLOW_SLOTS = 64
# The most slots of their own that may be asked for: they are broadcast and named in the metadata.
MOST_SLOTS = 100_000


@dataclass(frozen=True)
class BoundedIndex:
    """Labels with slots of their own (most frequent first) and the number of shared slots."""

    labels: tuple[str, ...]
    width: int
    overflow: int

    @property
    def size(self) -> int:
        """All slots: own ones (used or not), shared ones, and the one of NULL."""
        return self.width + self.overflow + 1

    def names(self) -> list[str]:
        """A name for every slot."""
        unused = [f"(unused {k})" for k in range(len(self.labels), self.width)]
        return [*self.labels, *unused, *[f"(other {k})" for k in range(self.overflow)], "(null)"]


def fit_index(df: DataFrame, column: str, width: int = OWN_SLOTS, overflow: int = OVERFLOW_SLOTS) -> BoundedIndex:
    """Slots for the ``width`` most frequent labels of ``column``; at most ``width`` labels reach the driver."""
    if not 0 <= width <= MOST_SLOTS or overflow < 1:
        raise ValueError(f"width must be 0 to {MOST_SLOTS}, overflow at least 1; got {width}, {overflow}")
    label = F.col(f"`{column}`").cast("string")
    counts = df.select(label.alias("label")).where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "label").limit(width).collect() if width else []
    return BoundedIndex(tuple(r["label"] for r in top), width, overflow)


def with_slot(df: DataFrame, column: str, index: BoundedIndex, output: str | None = None) -> DataFrame:
    """``df`` with the slot of ``column`` (double, with nominal metadata) in ``output`` (default ``<column>_slot``).

    The labels join as a broadcast table of ``width`` rows: no row of ``df`` is shuffled.
    """
    output = output or f"{column}_slot"
    spark, label = df.sparkSession, F.col(f"`{column}`").cast("string")
    own = spark.createDataFrame(list(zip(index.labels, range(len(index.labels)))), "_label string, _own int")
    shared = F.lit(index.width) + hash_bucket(label, index.overflow)
    slot = F.when(label.isNull(), F.lit(index.size - 1)).otherwise(F.coalesce(F.col("_own"), shared)).cast("double")
    meta = {"ml_attr": {"type": "nominal", "name": output, "vals": index.names()}}
    joined = df.join(F.broadcast(own), label == F.col("_label"), "left")
    return joined.select(*[df[f"`{c}`"] for c in df.columns if c != output], slot.alias(output, metadata=meta))
