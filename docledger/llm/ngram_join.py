"""N-gram Jaccard join by vertical partitioning.

A document is the set of its word n-grams. N-grams have one global order (by hash), which is cut into fragments; a
document's set falls into one segment per fragment.

1. Candidates. Linked sets of sizes a <= b differ in at most a * (den - num) / num n-grams, so with more non-empty
   segments than that, at least one is the same in both. Sizes fall into levels, each with its own number of fragments; a
   set takes part in its level and, near its lower end, in the one below. A set that falls into too few segments (rare)
   makes its level look at a second cut of the order, under another salt, and so on, so that no link is lost.
2. Filter. Sets that share a segment are compared by the parities of their segment sizes in a much finer cut: each odd
   difference is an n-gram that only one of them has, so pairs with more odd differences than a link may have go. Sets that
   merely share a passage, however common, end here. What remains is grouped (connected components).
3. Overlaps. For each fragment of the order and each pair of blocks of a group, one row gets the segments and counts the
   partial overlaps of all pairs of sets; a second step sums the partial overlaps per pair over the fragments, in strips of
   bounded size. Only links leave it: a spanning forest of them, and their number per document. No row stands for a
   single pair, and no group, however large, meets in one task.

Documents with equal sets are one class from the start. Work on classes is by a 64-bit hash of the set, checked against
a second one; on a collision the join starts again with another salt.

Defined results: texts without words (null, empty) have no n-grams and link with nothing; with fewer words than n, the
whole sequence is the only n-gram. Rows with a null id take part; component ids are the smallest non-null ids. Repeated
rows are equal sets. Extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import cut, release
from .graph import components
from .hashing import LOWER, U, blocks, mix, windows, word_hashes

#: Cuts of the order that a level may look at. A set of few n-grams falls short under one with a chance below 4 in 100.
CUTS = 64
#: N-grams of a block at most, about. Cells of a strip of summed overlaps.
GRAMS, STRIP = 1 << 22, 1 << 14


class Levels:
    """Sizes, and into how many segments each level's sets fall."""

    def __init__(self, num: int, den: int, ratio: float = 1.4):
        self.num, self.den = num, den
        self.bounds = [max(1, -(-num // (den - num)))]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(math.ceil(self.bounds[-1] * ratio) + 1)

    def differ(self, n: int) -> int:
        """Most n-grams in which a set of n and a linked set differ, where the other is larger."""
        return n * (self.den - self.num) // self.num

    @cache  # noqa: B019
    def fragments(self, level: int) -> int:
        """So many that a set of the level's largest size has more non-empty segments than it can differ in n-grams.

        Empty ones are allowed for by seven standard deviations, unless segments became so small that common n-grams
        stood alone in them; sets that this leaves short ask for another cut.
        """
        n = self.bounds[level + 1] - 1
        d = self.differ(n)
        f = d + 2
        while f < 0.4 * n:
            load = n / f
            empty = math.exp(-load)
            if f * (1 - empty) - 7 * math.sqrt(f * empty * max(0.0, 1 - (1 + load) * empty)) >= d + 1:
                break
            f += 1 + f // 100
        return f

    def of(self, n: int) -> list[int]:
        """Levels of a set of n; two linked sets have one in common."""
        k = bisect_right(self.bounds, n) - 1
        if k < 0:
            return []
        return [k - 1, k] if k and n * self.num <= (self.bounds[k] - 1) * self.den else [k]

    def width(self, level: int) -> int:
        """Bits of the parities: two to four for each n-gram of the level's largest set."""
        return max(64, 1 << (2 * self.bounds[level + 1] - 3).bit_length())


def ngram_sets(texts: list[str | None], n: int, salt: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text, with A-Z in lower case."""
    for _, held in blocks(texts):
        h, at = word_hashes([t.translate(LOWER) for t in held], salt)
        grams = windows(h, n, 100 * salt + n)
        for a, b in zip(at[:-1], at[1:], strict=True):
            m = int(b - a)
            yield np.unique(grams[a : b - n + 1]) if m >= n else windows(h[a:b], m, 100 * salt + m) if m else np.zeros(0, U)


def segments(x: np.ndarray, level: int, levels: Levels, turn: int = 0) -> tuple[np.ndarray, bool]:
    """Keys of a set's non-empty segments at a level, in the cut of number `turn`, and whether these are too few.

    The lowest six bits of a key tell the width of the level's parities.
    """
    with np.errstate(over="ignore"):
        y = np.sort(mix(x, 20 + turn)) if turn else x
        f = ((y >> U(32)) * U(levels.fragments(level))) >> U(32)
        first = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        # a link of this level has its smaller set in it, and differs by what that one can at most
        few = len(first) <= levels.differ(min(len(x), levels.bounds[level + 1] - 1))
        keys = mix(np.add.reduceat(mix(y, 3), first) + mix(f[first] + U(level << 32 | turn << 48), 5), 9)
        return keys & ~U(63) | U(levels.width(level).bit_length() - 1), few


def cuts_wanted(x: np.ndarray, levels: Levels) -> list[int]:
    """level * CUTS + turn for levels where the first cut leaves too few segments: the first turn that doesn't."""
    out = []
    for level in levels.of(len(x)):
        turn = 0
        while segments(x, level, levels, turn)[1]:
            turn += 1
            if turn == CUTS:
                raise RuntimeError("no cut of the order spreads a set")
        if turn:
            out.append(level * CUTS + turn)
    return out


def parities(x: np.ndarray, width: int) -> bytes:
    """A bit for each of `width` fine segments: whether it holds an odd number of n-grams."""
    with np.errstate(over="ignore"):
        return np.packbits(np.bincount((mix(x, 7) & U(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def near_forest(size: np.ndarray, bits: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """Edges (positions) that connect the sets which the parities let pass as linked, found breadth first.

    Sets once reached aren't compared again, so that a group of near copies takes about one comparison each. Wider
    parities are folded to the narrowest.
    """
    width = min(len(b) for b in bits)
    table = np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint8).reshape(-1, width), axis=0) for b in bits]).view(np.uint64)
    out, left = [], np.arange(len(bits))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            a = queue.pop()
            odd = np.zeros(len(left), np.int64)
            for k in range(0, len(left), 256):  # bounded memory for wide parities
                odd[k : k + 256] = np.bitwise_count(table[left[k : k + 256]] ^ table[a]).sum(axis=1, dtype=np.int64)
            small, large = np.minimum(size[left], size[a]), np.maximum(size[left], size[a])
            near = (odd * (den + num) <= (small + large) * (den - num)) & (small * den >= large * num)
            out += [(int(a), int(b)) for b in left[near]]
            queue += list(left[near])
            left = left[~near]
    return out


def overlaps(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each of the first sets has in common with each of the second."""
    both = np.concatenate([*rows, *columns])
    out = np.zeros((len(rows), len(columns)), np.float32)
    if not len(both):
        return out.astype(np.int32)
    owner = np.repeat(np.arange(len(rows) + len(columns)), [len(x) for x in (*rows, *columns)])
    order = np.argsort(both, kind="stable")
    both, owner = both[order], owner[order]
    new = np.concatenate([[True], both[1:] != both[:-1]])
    column = np.cumsum(new) - 1
    many = np.bincount(column)[column] > 1
    owner, column = owner[many], column[many]
    if not len(column):
        return out.astype(np.int32)
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    width = 4096  # n-grams at a time; 2 ** 24 of them are exact in single precision
    for low in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [low, low + width])
        m = np.zeros((len(rows) + len(columns), min(width, int(column[-1]) + 1 - low)), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        out += m[: len(rows)] @ m[len(rows) :].T
    return np.rint(out).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as hold all of them."""
    return counts.astype(next(k for k in ("<u1", "<u2", "<u4") if counts.max() <= np.iinfo(k).max)).tobytes()


def unpacked(data: bytes, cells: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // cells}").astype(np.int64)


def strip_links(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray, common: np.ndarray, num: int, den: int) -> list[tuple]:
    """Links between sets u and v of these sizes and overlaps: (u, v, null) of a spanning forest, (set, null, links)."""
    same = u[:, None] == v[None, :]
    i = common.astype(np.int64)
    linked = (den * i >= num * (nu[:, None] + nv[None, :] - i)) & ~same
    out = [(int(a), None, int(c)) for a, c in zip(u, linked.sum(axis=1), strict=True) if c]
    if not same.any():  # two blocks; in one block the other half of the matrix has these
        out += [(int(a), None, int(c)) for a, c in zip(v, linked.sum(axis=0), strict=True) if c]
    place = {int(a): k for k, a in enumerate(np.concatenate([v, u]))}
    root = np.arange(len(u) + len(v))
    for a, row in zip(u, linked, strict=True):
        near = np.flatnonzero(row)
        if not len(near):
            continue
        own = root[place[int(a)]]
        roots, first = np.unique(root[[place[int(b)] for b in v[near]]], return_index=True)
        fresh = roots != own
        if fresh.any():
            out += [(int(a), int(v[near[k]]), None) for k in first[fresh]]
            root[np.isin(root, roots)] = own
    return out


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


EDGES = ["u", "v", "n"], [pa.int64()] * 3


class NgramJoin:
    """One join over one table; see ngram_join()."""

    def __init__(self, docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, tile: int, fragments: int, salt: int = 0):
        self.source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.kind = self.source.schema["id"].dataType.simpleString()
        self.n, self.num, self.den, self.tile, self.fragments, self.salt = n, num, den, tile, fragments, salt
        self.levels = Levels(num, den)

    def sets(self) -> DataFrame:
        """id, n, lo and hi (hashes of the set), bits (parities), more (cuts that the set asks for)."""
        n, salt, levels = self.n, self.salt, self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                rows = []
                for x in ngram_sets(b.column(1).to_pylist(), n, salt):
                    with np.errstate(over="ignore"):
                        lo, hi = (_signed(int(mix(x, k).sum(dtype=U))) for k in (1, 2))
                    rows.append((len(x), lo, hi, parities(x, levels.width(own[-1])) if (own := levels.of(len(x))) else None, cuts_wanted(x, levels)))
                kinds = [pa.int64()] * 3 + [pa.binary(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([b.column(0), *_batch(rows, list("abcde"), kinds).columns], ["id", "n", "lo", "hi", "bits", "more"])

        return self.source.mapInArrow(run, f"id {self.kind}, n bigint, lo bigint, hi bigint, bits binary, more array<int>")

    def keys(self, turns: dict[int, list[int]]) -> DataFrame:
        """g (a segment), v (the set's lo) for each non-empty segment; of equal sets in a task only once."""
        n, salt, levels = self.n, self.salt, self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for b in slices(batches):
                gs, vs = [], []
                for x in ngram_sets(b.column(0).to_pylist(), n, salt):
                    with np.errstate(over="ignore"):
                        lo = mix(x, 1).sum(dtype=U)
                    if not len(x) or int(lo) in seen:
                        continue
                    seen.add(int(lo))
                    own = [segments(x, level, levels, t)[0] for level in levels.of(len(x)) for t in (0, *turns.get(level, ()))]
                    gs += own
                    vs.append(np.full(sum(map(len, own)), lo, U))
                if gs:
                    yield pa.RecordBatch.from_arrays([_long(np.concatenate(gs)), _long(np.concatenate(vs))], ["g", "v"])

        return self.source.select("text").mapInArrow(run, "g bigint, v bigint")

    def candidates(self, sets: DataFrame, classes: DataFrame) -> DataFrame:
        """u, v: edges that connect sets which share a segment and which the parities let pass."""
        asked = [r[0] for r in sets.select(F.explode("more")).distinct().collect()]  # at most CUTS for each of some 80 levels
        keys = self.keys({level: sorted(c % CUTS for c in asked if c // CUTS == level) for level in {c // CUTS for c in asked}})
        shared = cut(keys.groupBy("g").agg(F.min("v").alias("u"), F.max("v").alias("m")).filter("u <> m").select("g"), "ngram-shared")
        found = cut(keys.join(shared.hint("merge"), "g").distinct(), "ngram-segments")
        # segments that the same sets share are one group
        ways = [F.bit_xor(F.xxhash64("v", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
        whole = found.groupBy("g").agg(*ways, F.count(F.lit(1)).alias("k"))
        once = cut(whole.groupBy("x1", "x2").agg(F.min("g").alias("g"), F.max("k").alias("k")).select("g", "k"), "ngram-groups")
        member = found.join(once.hint("merge"), "g").join(classes.select(F.col("lo").alias("v"), "n", "bits"), "v")
        block = F.least(F.lit(512.0), F.pow(F.lit(2.0), 28 - F.col("c").bitwiseAND(63)))  # of 32 MiB of parities at most
        tiled = tiles(member.withColumnRenamed("g", "c"), F.col("k") / F.greatest(block, F.lit(16.0)), "n", "bits")
        out = cut(self.near(tiled), "ngram-near")
        release(shared, found, once)
        return out

    def near(self, tiled: DataFrame) -> DataFrame:
        num, den = self.num, self.den

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, {}

            def done() -> list[tuple]:
                vs = list(held)
                if len(vs) < 2:
                    return []
                return [(vs[a], vs[b]) for a, b in near_forest(np.array([held[v][0] for v in vs]), [held[v][1] for v in vs], num, den)]

            for b in slices(batches):
                out = []
                for c, i, j, v, n, x in zip(*(b.column(k).to_pylist() for k in ("c", "i", "j", "v", "n", "bits")), strict=True):
                    if (c, i, j) != key:
                        out += done()
                        key, held = (c, i, j), {}
                    held[v] = (n, x)
                yield _batch(out, ["u", "v"], EDGES[1][:2])
            yield _batch(done(), ["u", "v"], EDGES[1][:2])

        return tiled.repartition("c", "i", "j").sortWithinPartitions("c", "i", "j").mapInArrow(run, "u bigint, v bigint")

    def loaded(self, members: DataFrame) -> DataFrame:
        """The segments of the members' sets, a row for each fragment: c, k, part, v, n, f, x."""
        n, salt, pieces = self.n, self.salt, self.fragments

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for b in slices(batches):
                texts = b.column(0).to_pylist()
                with np.errstate(over="ignore"):
                    own = [_signed(int(mix(x, 1).sum(dtype=U))) if len(x) else None for x in ngram_sets(texts, n, salt)]
                fresh = []
                for k, v in enumerate(own):
                    if v is not None and v not in seen:
                        seen.add(v)
                        fresh.append(k)
                yield pa.RecordBatch.from_arrays([pa.array([own[k] for k in fresh], pa.int64()), pa.array([texts[k] for k in fresh], pa.string())], ["v", "text"])

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                rows = []
                for c, k, v, x in zip(*(b.column(k).to_pylist() for k in ("c", "k", "v")), ngram_sets(b.column("text").to_pylist(), n, salt), strict=True):
                    at = np.searchsorted(x, np.array([(f << 64) // pieces for f in range(1, pieces)], U))
                    rows += [(c, k, v, len(x), f, y.astype("<u8").tobytes()) for f, y in enumerate(np.split(x, at))]
                yield _batch(rows, ["c", "k", "v", "n", "f", "x"], [pa.int64()] * 4 + [pa.int32(), pa.binary()])

        texts = self.source.select("text").mapInArrow(name, "v bigint, text string")
        # one plan for all sizes: whether the members would fit a broadcast depends on the data
        chosen = texts.join(members.hint("merge"), "v").select("c", "k", "v", "text")
        return chosen.mapInArrow(load, "c bigint, k bigint, v bigint, n bigint, f int, x binary")

    def links(self, groups: DataFrame, classes: DataFrame) -> DataFrame:
        """u, v, n: links of a spanning forest (n null), and numbers of links in a strip (v null). groups: node, root."""
        num, den, tile = self.num, self.den, self.tile
        placed = groups.select(F.col("node").alias("v"), F.col("root").alias("c"))
        sized = placed.join(classes.select(F.col("lo").alias("v"), "n"), "v").groupBy("c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
        blocks = F.ceil(F.greatest(F.col("k") / tile, F.col("n") / GRAMS)).cast("bigint")
        many = cut(sized.select("c", blocks.alias("k")), "group-blocks")
        members = cut(placed.join(many.hint("merge"), "c"), "group-members")
        tiled = tiles(self.loaded(members), F.col("k"), "n", "f", "x").repartition("c", "i", "j", "f").sortWithinPartitions("c", "i", "j", "f", "v")
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4, pa.binary()]
        names = ["c", "i", "j", "s", "f", "u", "w", "nu", "nw", "common"]

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held, ready, size = None, {}, [], 0

            def done() -> None:
                nonlocal size
                if key is None:
                    return
                c, i, j, f = key
                rows, columns = ([v for v in held if held[v][2] == p] for p in (i, j))
                if not rows or not columns or len(held) < 2:
                    return
                common = overlaps([held[v][1] for v in rows], [held[v][1] for v in columns])
                nw = [held[v][0] for v in columns]
                high = max(1, STRIP // len(columns))
                for s in range(0, len(rows), high):
                    part = rows[s : s + high]
                    whose = (part, columns, [held[v][0] for v in part], nw) if f == 0 else (None,) * 4
                    ready.append((c, i, j, s, f, *whose, packed(common[s : s + high])))
                    size += len(ready[-1][-1])

            for b in slices(batches):
                for c, i, j, part, f, v, n, x in zip(*(b.column(k).to_pylist() for k in ("c", "i", "j", "part", "f", "v", "n", "x")), strict=True):
                    if (c, i, j, f) != key:
                        done()
                        key, held = (c, i, j, f), {}
                        if size > 1 << 22:
                            yield _batch(ready, names, kinds)
                            ready, size = [], 0
                    held[v] = (n, np.frombuffer(x, "<u8"), part)
            done()
            yield _batch(ready, names, kinds)

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, sets, common = None, None, None

            def done() -> list[tuple]:
                if key is None:
                    return []
                u, w, nu, nw = map(np.array, sets)
                return strip_links(u, w, nu, nw, common.reshape(len(u), len(w)), num, den)

            for b in slices(batches):
                out = []
                for c, i, j, s, f, *whose, x in zip(*(b.column(k).to_pylist() for k in names), strict=True):
                    if (c, i, j, s) != key:
                        out += done()
                        key, common = (c, i, j, s), 0
                    if f == 0:
                        sets = whose
                    common = common + unpacked(x, len(sets[0]) * len(sets[1]))
                yield _batch(out, *EDGES)
            yield _batch(done(), *EDGES)

        strips = tiled.mapInArrow(partial, "c bigint, i int, j int, s int, f int, u array<bigint>, w array<bigint>, nu array<bigint>, nw array<bigint>, common binary")
        summed = strips.repartition("c", "i", "j", "s").sortWithinPartitions("c", "i", "j", "s", "f").mapInArrow(total, "u bigint, v bigint, n bigint")
        out = cut(summed, "ngram-links")
        release(many, members)
        return out


def tiles(rows: DataFrame, blocks: Column, *columns: str) -> DataFrame:
    """Rows of groups (c, v) in pairs (i, j) of the blocks of their group, of which there are `blocks`; by a hash of v."""
    parts = F.ceil(blocks).cast("int")
    placed = rows.withColumn("part", F.pmod(F.xxhash64("v"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return placed.select("c", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "v", *columns)


def ngram_join(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", tile: int = 512, fragments: int = 8
) -> DataFrame:
    """One row per row of docs: id, n_grams, component (smallest id reachable by links), n_links (linked sets).

    tile: sets of a block. fragments: parts of the global order for which overlaps are counted separately.
    """
    for salt in range(8):
        join = NgramJoin(docs, n, num, den, id_col, text_col, tile, fragments, salt)
        sets = cut(join.sets(), "ngram-sets")
        ways = [F.min("id").alias("least"), F.min("n").alias("n"), F.min("hi").alias("a"), F.max("hi").alias("b"), F.min("bits").alias("bits")]
        classes = cut(sets.filter("n > 0").groupBy("lo").agg(*ways), "ngram-classes")
        if classes.filter("a <> b").isEmpty():
            break
        release(sets, classes)
    else:
        raise RuntimeError("set hashes collide under every salt")
    near = join.candidates(sets, classes)
    groups = cut(components(near), "ngram-groups")
    found = join.links(groups, classes)
    release(near, groups)
    roots = components(found.filter("v IS NOT NULL").select("u", "v"))
    placed = classes.join(roots, classes["lo"] == roots["node"], "left").select("lo", "least", F.coalesce("root", "lo").alias("root"))
    lowest = cut(placed.groupBy("root").agg(F.min("least").alias("component")), "ngram-lowest")
    counts = found.filter("v IS NULL").groupBy(F.col("u").alias("lo")).agg(F.sum("n").alias("n_links"))
    table = cut(placed.join(lowest, "root").join(counts, "lo", "left").select(F.col("lo").alias("key"), "component", "n_links"), "ngram-components")
    release(classes, found, lowest)
    keyed = sets.withColumn("key", F.when(F.col("n") > 0, F.col("lo")))
    return keyed.join(table, "key", "left").select(
        "id", F.col("n").alias("n_grams"), F.coalesce("component", "id").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def keep_smallest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs whose id is the smallest of their component."""
    found = ngram_join(docs, id_col=id_col, text_col=text_col, **options)
    kept = found.filter(F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("__keep")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__keep"]), "left_semi")
