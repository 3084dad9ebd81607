"""Sharding by best-fit-decreasing bin packing of groups of equal texts into a fixed number of shards.

A group of equal texts is indivisible. Groups of at least 1/grain of a shard's share are items of their own, of which
there are fewer than shards * grain; the smaller ones are dealt by digest into `bundles` composite items. So the list
that the packer sorts is bounded by parameters, whatever the size of the table; sizes, groups and slots are computed by
Spark. The packer takes items by falling size into the bin with the tightest remaining capacity that still holds them, from
a tree of remaining capacities, and searches the smallest capacity at which the given number of shards suffices. A
group larger than a shard's share gets a shard of its own, and the others share the rest evenly.

Slots are numbered without gaps: a cell is one composite item, or one of `cells` parts (by a hash of the
id) of a large group. Counts per cell (a
bounded list) give each cell its first slot, and rows are numbered inside their cell only, so that neither a shard nor
a hot group is sorted in one task.

Defined results: a null text counts as empty. Repeated rows get a slot each. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from random import Random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .exact_dedup import body


class RoomTree:
    """Bins ordered by remaining capacity, then by number, in a tree that random priorities keep balanced."""

    def __init__(self, seed: int = 1):
        self.root: list | None = None  # [key, priority, left, right]
        self.random = Random(seed)

    def add(self, room: int, number: int) -> None:
        low, high = self._split(self.root, (room, number))
        self.root = self._join(self._join(low, [(room, number), self.random.random(), None, None]), high)

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and returns the tightest bin with at least so much room, of equal ones the first; None if there is none."""
        low, high = self._split(self.root, (least, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2]:
            node = node[2]
        _, rest = self._split(high, (node[0][0], node[0][1] + 1))
        self.root = self._join(low, rest)
        return node[0]

    def _split(self, node: list | None, key: tuple) -> tuple[list | None, list | None]:
        """Trees of the keys below `key` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [*node[:3], low], high
        low, high = self._split(node[2], key)
        return low, [*node[:2], high, node[3]]

    def _join(self, a: list | None, b: list | None) -> list | None:
        """One tree of two; all keys of the first are smaller."""
        if not a or not b:
            return a or b
        if a[1] > b[1]:
            return [*a[:3], self._join(a[3], b)]
        return [*b[:2], self._join(a, b[2]), b[3]]


def best_fit(sizes: list[int], bins: int, capacity: int) -> list[int] | None:
    """Bin of each item (sizes fall), or None where `bins` bins don't suffice."""
    tree, out = RoomTree(), []
    for b in range(bins):
        tree.add(capacity, b)
    for size in sizes:
        found = tree.take(size)
        if found is None:
            return None
        out.append(found[1])
        tree.add(found[0] - size, found[1])
    return out


def pack(items: list[tuple[str, int]], bins: int) -> dict[str, int]:
    """Bin of each item by best fit decreasing, at the smallest capacity (to 1/10,000) that needs no more bins."""
    items = sorted((x for x in items), key=lambda x: (-x[1], x[0]))
    out, first = {}, 0
    while items and bins - first > 1 and items[0][1] * (bins - first) > sum(s for _, s in items):
        out[items.pop(0)[0]] = first  # larger than an even share: a shard of its own
        first += 1
    if not items:
        return out
    sizes, left = [s for _, s in items], bins - first
    low = max(sizes[0], -(-sum(sizes) // left))
    high, best = 2 * low, None
    while (best := best_fit(sizes, left, high)) is None:
        high *= 2
    while high - low > max(1, low // 10_000):
        mid = (low + high) // 2
        if (found := best_fit(sizes, left, mid)) is None:
            low = mid
        else:
            high, best = mid, found
    return out | {key: first + b for (key, _), b in zip(items, best, strict=True)}


def shard(
    docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text", grain: int = 64, bundles: int = 8192, cells: int = 64
) -> DataFrame:
    """One row per row of docs: id, size, crc, shard, slot."""
    spark = docs.sparkSession
    text = body(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = cut(rows, "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    # fewer than shards * grain rows, by the threshold
    large = cut(groups.filter(F.col("group_bytes") * (shards * grain) >= F.lit(total)).select("digest", F.hex("digest").alias("own")), "shard-large")
    named = rows.join(F.broadcast(large), "digest", "left").select(
        "id",
        "size",
        "crc",
        F.pmod(F.xxhash64("id", F.lit(7)), F.when(F.col("own").isNull(), 1).otherwise(F.lit(cells))).alias("cell"),
        F.coalesce("own", F.concat(F.lit("b"), F.pmod(F.xxhash64("digest"), F.lit(bundles)).cast("string"))).alias("item"),
    )
    listed = named.groupBy("item", "cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    sizes: dict[str, int] = {}
    for r in listed:
        sizes[r["item"]] = sizes.get(r["item"], 0) + r["bytes"]
    placed, nexts, plan = pack(list(sizes.items()), shards), [0] * shards, []
    for r in sorted(listed, key=lambda r: (r["item"], r["cell"])):
        b = placed[r["item"]]
        plan.append((r["item"], r["cell"], b, nexts[b]))
        nexts[b] += r["n"]
    at = spark.createDataFrame(plan, "item string, cell long, shard int, first long")
    number = F.row_number().over(Window.partitionBy("item", "cell").orderBy("id", "crc"))
    return named.withColumn("number", number - 1).join(F.broadcast(at), ["item", "cell"]).select(
        "id", "size", "crc", "shard", (F.col("first") + F.col("number")).alias("slot")
    )
