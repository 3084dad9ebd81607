"""The prefix trie of conversations, by range minima over the common prefixes of sorted neighbours.

1. Turns become (digest of role and text, words), conversations become sequences of these, and the sequences are sorted; Spark
   deals them out by ranges of (sequence, id), so copies of one conversation spread over tasks.
2. In each range, `Minima` is a sparse table over the common prefix lengths (LCPs) of neighbours: minima of 1, 2, 4, ... of
   them. Every prefix of every sequence is a candidate. It looks for its left and its right extent by a binary search in the
   table, each for itself: these are the members of a trie node. No stack walks the LCPs.
3. What a node counts are sums over its members' rows: words of all turns from its depth on, minus the words of nodes that start
   in these rows, gives the tokens saved; leaves are rows that the next row doesn't extend. So a node that reaches over a
   border between ranges is the sum of its parts, and a hot prefix sends one row a range. Only the LCP across each border has
   to be known, and there are as many borders as ranges.
4. The digest of a node's own conversations is that of a text as long as these are many. Its pieces are sorted ids of one range
   each; a task reads them in order and hashes as it reads.

Defined results: rows with a null conversation id are dropped. Null roles and texts are empty. Turns are ordered by turn (null
first), then role, then text; repeated rows stay. A conversation's sequence (24 bytes a turn) is held as one row. Extra columns
are ignored. An empty table has no conversations and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release

#: Characters that separate words.
BLANK = "[\\x20\\x09-\\x0D]+"
SLAB = 1 << 20


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, own (array of (key, words)): the turns of each conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    key = F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16)
    words = F.size(F.filter(F.split("text", BLANK), lambda w: w != "")).cast("long")
    each = rows.select("conv_id", F.row_number().over(order).alias("k"), key.alias("key"), words.alias("words"))
    listed = each.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "key", "words"))).alias("own"))
    return listed.select("conv_id", F.transform("own", lambda x: F.struct(x["key"].alias("key"), x["words"].alias("words"))).alias("own"))


def branched(convs: DataFrame, base: Column, head: Column) -> DataFrame:
    """conv_id, own: the first `head` turns of conversation `base`, then the conversation's own turns after its first `head`."""
    wanted = convs.withColumn("base", base).withColumn("head", head.cast("int"))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("first"))
    none = F.expr("filter(own, x -> false)")
    own = F.concat(F.coalesce(F.expr("slice(first, 1, head)"), none), F.expr("slice(own, head + 1, greatest(size(own) - head, 0))"))
    return wanted.join(heads, "base", "left").select("conv_id", own.alias("own"))


class Minima:
    """A sparse table: minima of 1, 2, 4, ... neighbours. lcp[i] is the common prefix of rows i - 1 and i; lcp[0] isn't used."""

    def __init__(self, lcp: np.ndarray):
        self.n, self.levels = len(lcp), [lcp]
        while 2 << len(self.levels) - 1 <= self.n:
            x, span = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(x[:-span], x[span:]))

    def right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row that shares the first `depth` turns with `row`."""
        at = row.copy()
        for k in reversed(range(len(self.levels))):
            level, span = self.levels[k], 1 << k
            go = at + span < self.n
            go[go] = level[at[go] + 1] >= depth[go]
            at[go] += span
        return at

    def left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row that shares the first `depth` turns with `row`."""
        at = row.copy()
        for k in reversed(range(len(self.levels))):
            level, span = self.levels[k], 1 << k
            go = at >= span
            go[go] = level[at[go] - span + 1] >= depth[go]
            at[go] -= span
        return at


class SmallestOf:
    """A sparse table of values, for the smallest one from row a to row b."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            x, span = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(x[:-span], x[span:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.int64)
        level = np.log2(b - a + 1).astype(np.int64)
        for k, x in enumerate(self.levels):
            own = level == k
            out[own] = np.minimum(x[a[own]], x[b[own] - (1 << k) + 1])
        return out


def common_prefixes(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """LCP of each row with the one before (row 0: 0). keys: of all rows, one after another; ends: of the rows in keys."""
    starts, sizes = ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0)
    most = np.minimum(sizes[1:], sizes[:-1])
    row = np.repeat(np.arange(len(most)), most)
    k = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most)
    differ = np.flatnonzero((keys[starts[:-1][row] + k] != keys[starts[1:][row] + k]).any(axis=1))
    out = np.concatenate([[0], most])
    first, at = np.unique(row[differ], return_index=True)
    out[first + 1] = k[differ[at]]
    return out


NODE = "key binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, part bigint, ends binary"


def nodes_of(t: pa.Table) -> pa.Table:
    """The trie nodes of one range of sorted sequences, or what the range adds to them."""
    t = t.sort_by("pos")
    part, n = t.column("part")[0].as_py(), t.num_rows
    ids = t.column("conv_id").to_numpy()
    lists = t.column("own").combine_chunks()
    turns = lists.flatten()
    keys = np.frombuffer(b"".join(turns.field("key").to_pylist()), np.int64).reshape(-1, 2)
    words = turns.field("words").to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    ends = np.cumsum(sizes)
    lcp = common_prefixes(keys, ends)
    before, after = t.column("before")[0].as_py(), t.column("after")[0].as_py()
    first = lcp.copy()
    first[0] = before  # nodes of row i that no row before it has are deeper than first[i]
    total = np.concatenate([[0], np.cumsum(words)])
    upto = lambda row, depth: total[(ends - sizes)[row] + depth] - total[(ends - sizes)[row]]  # noqa: E731  words of a row's first turns
    rows = np.arange(n)
    whole = upto(rows, sizes)
    sums = np.concatenate([[0], np.cumsum(whole)])
    own = np.concatenate([[0], np.cumsum(whole - upto(rows, np.maximum(first, 0)))])  # words of the nodes that start in a row
    leaves = np.concatenate([[0], np.cumsum(np.append(lcp[1:], after) < sizes)])
    same = np.concatenate([[False], (lcp[1:] == sizes[1:]) & (sizes[1:] == sizes[:-1])])
    last = np.append(np.flatnonzero(~same)[1:], n)[np.cumsum(~same) - 1]  # one past the row's equals

    minima, smallest, chains = Minima(lcp), SmallestOf(ids), chained(keys, ends)
    found: dict[str, list] = {name: [] for name in ("row", "depth", "end", "born")}
    children: list[np.ndarray] = []
    for a, b in slabs(sizes + 1):
        row = np.repeat(np.arange(a, b), sizes[a:b] + 1)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(sizes[a:b] + 1) - sizes[a:b] - 1, sizes[a:b] + 1)
        left, right = minima.left(row, depth), minima.right(row, depth)
        born = depth > first[row]
        mine = left == row
        for name, x in (("row", row), ("depth", depth), ("end", right), ("born", born)):
            found[name].append(x[mine])
        child = np.flatnonzero(born & (depth > 0))
        children.append(np.stack([left[child - 1], depth[child - 1]]))  # the prefix one turn shorter stands before it
    row, depth, end, born = (np.concatenate(x) for x in found.values())
    parents, counts = np.unique(np.concatenate(children, axis=1), axis=1, return_counts=True)
    place = np.lexsort([depth, row])
    row, depth, end, born = row[place], depth[place], end[place], born[place]
    span = int(sizes.max(initial=0)) + 1
    n_children = np.zeros(len(row), np.int64)
    n_children[np.searchsorted(row * span + depth, parents[0] * span + parents[1])] = counts
    shorter = np.maximum(depth - 1, 0)
    all_words = sums[end + 1] - sums[row] - (end - row + 1) * upto(row, shorter)
    node_words = own[end + 1] - own[row + 1] + whole[row] - upto(row, np.maximum(shorter, first[row]))
    pieces = [",".join(map(str, ids[r : last[r]].tolist())).encode() if d == sizes[r] else None for r, d in zip(row.tolist(), depth.tolist(), strict=True)]
    name = [chains[r][d] for r, d in zip(row.tolist(), depth.tolist(), strict=True)]
    above = [chains[r][d - 1] if d else None for r, d in zip(row.tolist(), depth.tolist(), strict=True)]
    columns = [pa.array(name, pa.binary()), pa.array(above, pa.binary()), *[pa.array(x) for x in (depth, smallest(row, end), end - row + 1, n_children, leaves[end + 1] - leaves[row], all_words - node_words)]]
    return pa.table([*columns, pa.array([part] * len(row), pa.int64()), pa.array(pieces, pa.binary())], [c.split()[0] for c in NODE.split(", ")])


def slabs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with about SLAB candidates."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLAB, "right")))
        yield a, b
        a = b


def chained(keys: np.ndarray, ends: np.ndarray) -> list[list[bytes]]:
    """For each row the digests of its first 0, 1, 2, ... turns."""
    raw, out, at = keys.tobytes(), [], 0
    for end in ends.tolist():
        path = [b"\0" * 16]
        for k in range(at, end):
            path.append(hashlib.blake2b(path[-1] + raw[16 * k : 16 * k + 16], digest_size=16).digest())
        out.append(path)
        at = end
    return out


def _shared(a: str, b: str) -> Column:
    """How many leading turns two sequences share."""
    same = F.array_position(F.transform(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")), lambda z: z["a"]["key"].eqNullSafe(z["b"]["key"])), False)
    return F.when(same > 0, same - 1).otherwise(F.least(F.size(a), F.size(b)).cast("long"))


def ends_digests(pieces: DataFrame) -> DataFrame:
    """key, ends_sha256 from pieces (key, part, ends): the pieces of a node in order, joined by commas, hashed while they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            keys, shas = [], []
            for key, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        shas.append(state.hexdigest())
                    now, state = key, hashlib.sha256(ends)
                else:
                    state.update(b"," + ends)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], ["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])

    ordered = pieces.repartition("key").sortWithinPartitions("key", "part")
    return ordered.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """convs: conv_id, own (array of (key, words)). One row a node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ordered = convs.repartitionByRange("own", "conv_id").sortWithinPartitions("own", "conv_id")
    rows = cut(ordered.select(F.monotonically_increasing_id().alias("pos"), "conv_id", "own").withColumn("part", F.shiftright("pos", 33)), "trie-rows")
    borders = rows.groupBy("part").agg(F.min_by("own", "pos").alias("low"), F.max_by("own", "pos").alias("high"))
    order = Window.orderBy("part")  # one row a range
    near = borders.withColumn("previous", F.lag("high").over(order)).withColumn("next", F.lead("low").over(order))
    gaps = near.select("part", F.when(F.col("previous").isNull(), -1).otherwise(_shared("previous", "low")).alias("before"), F.when(F.col("next").isNull(), -1).otherwise(_shared("high", "next")).alias("after"))
    parts = cut(rows.join(F.broadcast(gaps), "part").groupBy("part").applyInArrow(nodes_of, NODE), "trie-parts")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = parts.groupBy("key").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums)
    nodes = cut(nodes.join(ends_digests(parts.filter("ends IS NOT NULL")), "key", "left"), "trie-nodes")
    release(rows, parts)
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
