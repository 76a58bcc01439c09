"""Shards of nearly equal bytes: best-fit-decreasing bin packing of whole groups.

Rows with equal texts are one group and stay together. Groups enter in order of size,
largest first; each goes to the bin with the least remaining capacity that still
holds it, found in a balanced tree over (remaining, bin). A bin is opened when none
fits. For a fixed number of shards the capacity is the smallest that needs no more
bins; groups larger than an equal share get a shard of their own, and the others
share the rest.

Groups of one size are alike, so packing needs only how many groups there are of
each size. That table is what the driver packs: its length is the number of
*different* sizes, which is at most the square root of twice the total bytes, and
for a run of equal groups the tree is asked once per bin and not once per group.
The result says which places, in the order (size descending, key), go to which
shard; groups find theirs by place. Rows, groups and slots are numbered by range
sorts, so neither a common text, nor a common size, nor a shard is gathered in one task.

Defined cases: a null text is an empty one (size 16, crc32 0); null ids come first;
repeated rows are rows; an empty table gives an empty result, with fewer groups than
shards the last shards stay empty; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import store
from parcelight.operators import number_rows

OVERHEAD = 16  # bytes a row counts besides its text
# The capacity search stops at one part in this many of an equal share.
PRECISION = 10_000


class CapacityTree:
    """Bins by remaining capacity. A sorted sequence of short sorted leaves (a
    two-level balanced tree): finding, adding and removing touch one leaf."""

    LEAF = 512

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = [[]]

    def _leaf(self, key: tuple[int, int]) -> int:
        low, high = 0, len(self.leaves) - 1
        while low < high:
            middle = (low + high) // 2
            if self.leaves[middle] and self.leaves[middle][-1] >= key:
                high = middle
            else:
                low = middle + 1
        return low

    def add(self, remaining: int, number: int) -> None:
        at = self._leaf((remaining, number))
        insort(self.leaves[at], (remaining, number))
        if len(self.leaves[at]) > self.LEAF:
            half = self.LEAF // 2
            self.leaves[at : at + 1] = [self.leaves[at][:half], self.leaves[at][half:]]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least remaining >= ``size``."""
        at = self._leaf((size, -1))
        place = bisect_left(self.leaves[at], (size, -1))
        if place == len(self.leaves[at]):
            return None
        found = self.leaves[at].pop(place)
        if not self.leaves[at] and len(self.leaves) > 1:
            del self.leaves[at]
        return found


def pack(
    sizes: list[tuple[int, int]], capacity: int, most: int | None = None
) -> list[tuple[int, int, int]] | None:
    """Best-fit decreasing of ``(size, groups)`` into bins of ``capacity``:
    (size, groups, bin) in the order of packing; a larger group has a bin of its
    own. None when more than ``most`` bins would be needed."""
    tree, bins = CapacityTree(), 0
    placed: list[tuple[int, int, int]] = []
    for size, groups in sorted(sizes, reverse=True):
        while groups:
            found = tree.take_tightest(size)
            if found is None:
                if most is not None and bins >= most:
                    return None
                found, bins = (max(capacity, size), bins), bins + 1
            remaining, number = found
            fitting = min(groups, remaining // size)
            placed.append((size, fitting, number))
            groups -= fitting
            tree.add(remaining - fitting * size, number)
    return placed


def pack_into(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Best-fit decreasing into ``shards`` bins of nearly equal fill."""
    left = sorted(((s, n) for s, n in sizes if n), reverse=True)
    total, open_shards = sum(s * n for s, n in left), shards
    placed: list[tuple[int, int, int]] = []
    # Groups beyond an equal share of what is left fill a shard each.
    while left and open_shards > 1 and left[0][0] * open_shards >= total:
        size, groups = left[0]
        placed.append((size, 1, shards - open_shards))
        total, open_shards = total - size, open_shards - 1
        left[0:1] = [(size, groups - 1)] if groups > 1 else []
    if not left:
        return placed
    share = -(-total // open_shards)
    low = max(share, left[0][0])  # holds at least this
    high = share + left[0][0]  # always enough: no bin is opened while one is below the share
    while pack(left, high, open_shards) is None:
        high *= 2
    step = max(1, share // PRECISION)
    while high - low > step:
        middle = (low + high) // 2
        if pack(left, middle, open_shards) is None:
            low = middle + 1
        else:
            high = middle
    if low < high and pack(left, low, open_shards) is not None:
        high = low
    first = shards - open_shards
    return placed + [(s, n, b + first) for s, n, b in pack(left, high, open_shards)]


def shard_by_bytes(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, size, text_crc32, shard, slot (from 0 without gaps) of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows, _ = store(
        docs.select(
            F.col(id_column).alias("_id"),
            (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.unhex(F.md5(body)).alias("_key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("_key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    weighed = groups.select("_key", (F.col("size") * F.col("_n")).alias("_weight"))
    ordered, _ = store(
        number_rows(weighed, [F.desc("_weight"), F.asc("_key")], "_nth", start=0),
        "shard-groups",
    )
    histogram = ordered.groupBy("_weight").agg(F.count(F.lit(1)).alias("n")).collect()
    spans, at = [], 0
    for size, count, shard in pack_into([(r._weight, r.n) for r in histogram], shards):
        spans.append((size, at, at + count, shard))
        at += count
    spark = docs.sparkSession
    chosen = spark.createDataFrame(spans, "_weight long, _from long, _until long, shard int")
    placed = ordered.join(chosen, "_weight").where(
        (F.col("_nth") >= F.col("_from")) & (F.col("_nth") < F.col("_until"))
    )
    homes, _ = store(placed.select("_key", "shard"), "shard-homes")
    homed = rows.join(homes, "_key").select("_id", "size", "text_crc32", "shard", "_key")
    numbered = number_rows(
        homed, [F.asc("shard"), F.asc_nulls_first("_id"), F.asc("_key")], "_n", start=0
    )
    firsts = numbered.groupBy("shard").agg(F.min("_n").alias("_first"))
    return numbered.join(F.broadcast(firsts), "shard").select(  # one row per shard
        F.col("_id").alias(id_column), "size", "text_crc32",
        F.lit("bytes").alias("law"), "shard",
        (F.col("_n") - F.col("_first")).cast("long").alias("slot"),
    )
