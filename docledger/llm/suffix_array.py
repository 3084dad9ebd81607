"""Substring dedup by a distributed difference-cover suffix array over UTF-8 bytes.

A string of `length` bytes that also starts earlier (smaller document id, or same document, smaller start) is removed.

1. What can't repeat never enters the sort. Every string of `length` bytes has a minimizer, its GRAM bytes of lowest hash.
   Equal strings have equal minimizers at equal places, so a string whose minimizer stands once in the corpus occurs once.
   Consecutive strings with one minimizer are a segment. Segments that repeat whole are settled by their first source (64 bits of the
   minimizer's hash and 64 of the segment's tell them apart); of the first sources, those go on whose minimizer stands in several
   different segments. There, and only there, part of a segment can be found in another. Of these, strings go on whose
   minimizer stands in several segments with most of what surrounds it as well (`inner`).
2. The bytes of these open strings stand in shards, and the suffixes of all shards are sorted by the difference-cover
   algorithm (DC3). A character is STEP bytes. At level j the string is that of the names of level j at a distance of
   STEP * 3 ** j bytes, so the sample of level L is the places whose lowest L digits to base 3 aren't 0. Sampled triples are
   sorted and named, and the names are the string of the next level (`name`). Only prefixes of `length` bytes are compared in
   the end, so the recursion ends when a name spans them.
3. On the way back the remaining suffixes (digit 0) are ordered by (character, rank of the next suffix) and merged with the
   sample: with digit 1 by the same pair, with digit 2 by two characters and a rank (`merge`).
4. In the order of all suffixes adjacent prefixes of `length` bytes are compared, by a 64-bit hash of the prefix: as many
   comparisons as suffixes, none between others. Each run of equal prefixes keeps its first source (`judge`).

Spark deals suffixes out by ranges of their first PREFIX bytes, the same in each step, and back to their shards. Inside a
task they are arrays. Names and ranks are (range, place in the range), so no count has to be known beforehand. Triples that
repeat in a shard are sent once.

Defined results: null and empty texts have no bytes; shorter texts than `length` lose none. A null id counts as larger than
all others. Rows that repeat an id are told apart by their texts (`tag`); among them a string is earlier only if its start is
smaller. Extra columns are ignored. An empty table gives an empty result. A task holds about 40 bytes for each byte of its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import cut, release
from .hashing import BASE, INVERSE, U, mix, powers

GRAM = 32
STEP = 2
SHARD = 1 << 20
#: Bytes that deal suffixes out. No more than a triple of level 1 spans or than are compared: equal ones meet.
PREFIX = 16
#: A range's number stands above this bit of a name, the place in the range below.
PLACE = 40
#: Stands for a null id: larger than any other.
FAR = (1 << 63) - 1
#: Bits of a place in a stretch of text; the rest of the 64 bits are the gram's hash.
AT = 22
#: Most ranges; their bounds (PREFIX bytes each) go to every task.
RANGES = 1 << 17


def prefix_sums(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)))])


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 7) -> np.ndarray:
    """Hashes of the bytes from each start to each end. Equal bytes have equal hashes wherever they stand."""
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start], salt)


def grams(sums: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the strings of n bytes."""
    with np.errstate(over="ignore"):
        return mix((sums[n:] - sums[:-n]) * powers(INVERSE, len(sums) - n), 7)


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def minimizers(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Stretches of the strings of `length` bytes: where a stretch starts, and the place and hash of each string's minimizer."""
    size = (1 << AT) - length
    for at in range(0, len(data) - length + 1, size):
        own = grams(prefix_sums(data[at : at + size + length - 1]), gram)
        place = lowest((own >> U(AT) << U(AT)) | np.arange(len(own), dtype=U), length - gram + 1) & U((1 << AT) - 1)
        yield at, place.astype(np.int64) + at, own[place]


def parsed(texts: list[bytes], length: int, gram: int, limit: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text's segments: the minimizer's hash, the segment's hash, and (start << 16 | number of strings).

    Short texts are hashed together; segments that reach over an end are cut there.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[bytes] = []

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        data = np.frombuffer(b"".join(held), np.uint8)
        if len(data) < length:
            yield from (none for _ in held)
            return
        sizes = np.array([len(t) for t in held])
        ends = np.cumsum(sizes)
        within = sizes >= length
        edges = np.concatenate([(ends - sizes)[within], (ends - length + 1)[within]])  # segments start and end there
        keys, starts, before = [], [], -1
        for at, place, key in minimizers(data, length, gram):
            new = np.concatenate([[int(place[0]) != before], place[1:] != place[:-1]])
            inside = edges[(edges >= at) & (edges < at + len(place))] - at
            new[inside] = True
            new = np.flatnonzero(new)
            keys.append(key[new])
            starts.append(new + at)
            before = int(place[-1])
        key, start = np.concatenate(keys), np.concatenate(starts)
        stop = np.append(start[1:], len(data) - length + 1)
        of = np.searchsorted(ends, start, "right")
        real = stop <= (ends - length + 1)[of]  # the rest reaches over the end of its text
        key, start, stop, of = key[real], start[real], stop[real], of[real]
        whole = spans(prefix_sums(data), start, stop + length - 1)
        place = start - (ends - sizes)[of] << 16 | stop - start
        cuts = np.searchsorted(of, np.arange(len(held) + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield key[a:b].view(np.int64), whole[a:b].view(np.int64), place[a:b]

    size = 0
    for t in texts:
        if held and size + len(t) > limit:
            yield from flush()
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield from flush()


def inner(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string a hash of most of what surrounds its minimizer, and which strings start a run with the same one.

    With `room` bytes around the minimizer, strings whose minimizer starts in the same quarter of it share all but a quarter.
    """
    room = length - gram
    quarter = room // 4
    sums = prefix_sums(data)
    (_, place, _) = next(minimizers(data, length, gram))
    left = place - np.arange(len(place))
    part = np.minimum(left // quarter, 3) if quarter else np.zeros(len(left), np.int64)
    right = np.where(part < 3, room - quarter * (part + 1), 0) if quarter else 0
    with np.errstate(over="ignore"):
        found = mix(spans(sums, place - quarter * part, place + gram + right) + part.astype(U), 11).view(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (part[1:] != part[:-1])
    return found, new


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode() for t in texts]


def _longs(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.int64)


def planes(x: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, then their second bytes, and so on: most of the upper ones are zeros, which pack well."""
    return np.ascontiguousarray(x, np.int64).reshape(-1).view(np.uint8).reshape(-1, 8).T.tobytes()


def numbers(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


class Repeats:
    """The steps up to the suffixes to be sorted, and what they leave to remove."""

    def __init__(self, docs: DataFrame, length: int, id_col: str, text_col: str, gram: int):
        self.length, self.gram = length, min(gram, length)
        text = F.col(text_col).cast("string")
        self.source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FAR)).alias("doc"), F.hash(text).alias("tag"), F.col(id_col).alias("id"), text.alias("text"))

    def segments(self) -> DataFrame:
        """doc, tag, keys, digests, places: each text's segments, as parsed() gives them."""
        length, gram = self.length, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                found = list(parsed(_bytes(b.column("text").to_pylist()), length, gram))
                lists = [_lists([x[k] for x in found]) for k in range(3)]
                yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("tag"), *lists], ["doc", "tag", "keys", "digests", "places"])

        return self.source.select("doc", "tag", "text").mapInArrow(run, "doc bigint, tag int, keys array<bigint>, digests array<bigint>, places array<bigint>").filter("size(keys) > 0")

    def candidates(self) -> DataFrame:
        """key, digest, doc, place, tag: segments whose minimizer stands more than once in the corpus."""
        parts = cut(self.segments(), "suffix-segments")
        each = parts.select(F.explode("keys").alias("key"))
        # written, so that the join can split a hot minimizer and no other shuffle is there beside its own
        twice = cut(each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "suffix-twice")
        rows = parts.select("doc", "tag", F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("digests").alias("digest"), F.col("places").alias("place"))).alias("x"))
        found = cut(rows.select("x.key", "x.digest", "doc", "x.place", "tag").join(twice.hint("merge"), "key"), "suffix-candidates")
        release(parts, twice)
        return found

    def marks(self) -> DataFrame:
        """doc, tag, later, open: places (as in parsed) of the segments to remove whole, and of those to be sorted."""
        found = self.candidates()
        first = F.min(F.struct("doc", "place")).alias("first")
        firsts = cut(found.groupBy("key", "digest").agg(first, F.count(F.lit(1)).alias("copies")), "suffix-firsts")
        several = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("key", F.lit(True).alias("several"))
        # a segment that stands once needs no look at the other copies
        own = firsts.join(several, "key", "left").filter("several OR copies > 1").select("key", "digest", "first", F.coalesce("several", F.lit(False)).alias("several"))
        rows = found.join(own, ["key", "digest"]).select("doc", "tag", "place", (F.struct("doc", "place") > F.col("first")).alias("late"), "several").filter("late OR several")
        late = F.when(F.col("late"), F.col("place")), F.when(~F.col("late"), F.col("place"))
        out = cut(rows.groupBy("doc", "tag").agg(F.collect_list(late[0]).alias("later"), F.collect_list(late[1]).alias("open")), "suffix-marks")
        release(found, firsts)
        return out

    def shards(self, marks: DataFrame) -> DataFrame:
        """shard, text, docs, tags, starts, sizes: the bytes of neighbouring open segments, in rows of about SHARD bytes."""
        length = self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, count, size, held = TaskContext.get().partitionId(), 0, 0, []
            for b in slices(batches):
                for doc, tag, opened, text in zip(b.column("doc").to_pylist(), b.column("tag").to_pylist(), b.column("open").to_pylist(), _bytes(b.column("text").to_pylist()), strict=True):
                    end = -1
                    for at, n in sorted({(x >> 16, x & 0xFFFF) for x in opened}):
                        if at == end:
                            held[-1] = (doc, tag, held[-1][2], text[held[-1][2] : at + n + length - 1])
                            size += n
                        else:
                            held.append((doc, tag, at, text[at : at + n + length - 1]))
                            size += n + length - 1
                        end = at + n
                    if size >= SHARD:
                        yield shard_row(task << 32 | count, held)
                        count, size, held = count + 1, 0, []
            if held:
                yield shard_row(task << 32 | count, held)

        joined = self.source.join(marks.filter("size(open) > 0"), ["doc", "tag"]).select("doc", "tag", "text", "open")
        return cut(joined.mapInArrow(run, "shard bigint, text binary, docs binary, tags binary, starts binary, sizes binary"), "suffix-shards")


def sieved(shards: DataFrame, length: int, gram: int) -> DataFrame:
    """New shards with the strings whose inner() part stands in several places."""

    def parts(x: dict) -> tuple[np.ndarray, np.ndarray]:
        """inner() of the strings, and which of them are none: these reach over a border."""
        found, new = inner(np.frombuffer(x["text"], np.uint8), length, gram)
        whole = Shard(x["text"], length, x["sizes"]).strings()[: len(found)]
        new[1:] |= whole[1:] != whole[:-1]
        return found, new & whole

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found, new = parts(b.to_pylist()[0])
            x, n = np.unique(found[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), b.column("shard")[0].as_py())), pa.array(x), pa.array(n)], ["shard", "x", "n"])

    each = cut(shards.select("shard", "text", "sizes").mapInArrow(counted, "shard bigint, x bigint, n bigint"), "suffix-inner")
    several = each.groupBy("x").agg(F.sum("n").alias("n")).filter("n > 1").select("x")
    lists = each.select("shard", "x").join(several, "x").groupBy("shard").agg(F.collect_list("x").alias("several"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            x = b.drop_columns(["several"]).to_pylist()[0]
            s = Shard(x["text"], length, x["sizes"])
            found, _ = inner(np.frombuffer(x["text"], np.uint8), length, gram)
            alive = s.strings()[: len(found)] & np.isin(found, b.column("several")[0].values.to_numpy())
            edge = np.diff(np.concatenate([[0], alive.astype(np.int8), [0]]))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            ends = np.cumsum(s.sizes)
            of = np.searchsorted(ends, first, "right")
            docs, tags, starts = _longs(x["docs"])[of], _longs(x["tags"])[of], (_longs(x["starts"]) - ends + s.sizes)[of] + first
            yield shard_row(x["shard"], [(*c, x["text"][a : e + length - 1]) for *c, a, e in zip(docs.tolist(), tags.tolist(), starts.tolist(), first.tolist(), last.tolist(), strict=True)])

    out = cut(shards.join(lists, "shard").select(*shards.columns, "several").mapInArrow(run, shards.schema), "suffix-sieved")
    release(shards, each)
    return out


def shard_row(number: int, held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    docs, tags, starts, texts = zip(*held, strict=True)
    longs = [np.array(x, np.int64).tobytes() for x in (docs, tags, starts, [len(t) for t in texts])]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in (b"".join(texts), *longs)]], ["shard", "text", "docs", "tags", "starts", "sizes"])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in arrays])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


class Shard:
    """One shard's text, and values by place."""

    def __init__(self, text: bytes, length: int, sizes: bytes):
        self.n, self.length, self.width = len(text), length, min(PREFIX, length)
        self.data = np.frombuffer(text + bytes(PREFIX + 8), np.uint8)
        self.sizes = _longs(sizes)

    def cover(self, level: int) -> np.ndarray:
        """The sample's places: the lowest `level` digits of the character's number aren't 0."""
        digits = np.arange(self.n) // STEP
        keep = np.ones(self.n, bool)
        for _ in range(level):
            keep &= digits % 3 != 0
            digits //= 3
        return np.flatnonzero(keep)

    def strings(self) -> np.ndarray:
        """Which places start a string that is compared."""
        ends = np.cumsum(self.sizes)
        step = np.zeros(self.n + 1, np.int64)
        np.add.at(step, ends - self.sizes, 1)
        np.add.at(step, ends - self.length + 1, -1)
        return np.cumsum(step[:-1]) > 0

    def needed(self, level: int) -> np.ndarray:
        """Places of the sample whose ranks decide the order of strings: their starts, and what stands within the reach of the merges below."""
        at, reach = self.cover(level), STEP * (3**level - 1)
        count = np.concatenate([[0], np.cumsum(self.strings())])
        return at[count[at + 1] > count[np.maximum(at - reach, 0)]]

    def packed(self, width: int) -> np.ndarray:
        """`width` bytes from each place on as one number, in order; 0 is left for what lies behind the end."""
        out = np.zeros(self.n, np.int64)
        for k in range(width):
            out = out << 8 | self.data[k : k + self.n]
        return out + 1

    def characters(self, level: int, names: bytes | None) -> np.ndarray:
        """The characters of a level by place: bytes, triples of bytes' characters, or names."""
        return self.packed(STEP * 3**level) if level < 2 else self.dense(self.cover(level), numbers(names))

    def dense(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n, np.int64)
        out[at] = values
        return out

    def prefixes(self, at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(sliding_window_view(self.data, self.width)[at]).view(f"S{self.width}").ravel()

    def ranges(self, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The range of each place's suffix. The first bytes decide, but where they are those of a bound."""
        few, edges = min(7, self.width), Shard(bounds.tobytes(), self.length, b"")
        first, edge = self.packed(few)[at], edges.packed(few)[:: self.width]
        out = np.searchsorted(edge, first, "right")
        tied = np.flatnonzero(np.searchsorted(edge, first, "left") < out)
        out[tied] = np.searchsorted(bounds, self.prefixes(at[tied]), "right")
        return out


def shifted(x: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([x[by:], np.zeros(min(by, len(x)), x.dtype)])


def triples(shard: Shard, at: np.ndarray, level: int, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For places of the sample of level + 1: their order by triples, which of them are new in this order, and the triples."""
    step = STEP * 3**level
    own = [chars[at], shifted(chars, step)[at], shifted(chars, 2 * step)[at]]
    order = np.lexsort(own[::-1])
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in own])
    return order, new, own


def merged(c: np.ndarray, c1: np.ndarray, a: np.ndarray, b: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """The number of suffixes before each one.

    c, c1: its first two characters. a: the rank of the suffix itself, with digit 0 of the next one. b: the rank of the next
    suffix with digit 1, of the one after the next with digits 0 and 2.
    """
    groups = [np.flatnonzero(digit == d) for d in range(3)]
    place = np.zeros(len(c), np.int64)
    for own, keys in ((groups[0], (a, c)), (groups[1], (a,)), (groups[2], (a,))):
        place[own[np.lexsort([k[own] for k in keys])]] = np.arange(len(own))
    for d, e, keys in (
        (0, 1, [np.where(digit == 0, a, b), c]),
        (0, 2, [b, c1, c]),
        (1, 2, [a]),
    ):
        both = np.concatenate([groups[d], groups[e]])
        order = np.lexsort([k[both] for k in keys])
        second = order >= len(groups[d])
        before = np.where(second, np.cumsum(~second), np.cumsum(second))
        place[both[order]] += before
    return place


class Sorter:
    """The difference-cover sort of the shards' suffixes."""

    def __init__(self, shards: DataFrame, length: int):
        self.shards, self.length = shards, length
        self.names: dict[int, DataFrame] = {}
        self.top = 1
        while STEP * 3**self.top < length:
            self.top += 1
        self.bounds = self.splitters()

    def splitters(self) -> np.ndarray:
        """Bounds of ranges: one range a shard, RANGES at most, from a sample of at most 8 * RANGES suffixes (PREFIX bytes each)."""
        length, count = self.length, max(1, self.shards.count())
        each = max(1, min(64, 8 * RANGES // count))
        share = min(1.0, 8 * RANGES / count)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 1):
                s = Shard(b.column(0)[0].as_py(), length, b.column(1)[0].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([x.ljust(s.width, b"\0") for x in s.prefixes(np.arange(each) * s.n // each).tolist()], pa.binary())], ["x"])

        chosen = self.shards.filter(F.pmod(F.xxhash64("shard"), F.lit(1 << 20)) < int(share * (1 << 20)))
        some = sorted(bytes(r[0]) for r in chosen.select("text", "sizes").mapInArrow(run, "x binary").collect())
        n = min(count, RANGES)
        return np.array(sorted({some[i * len(some) // n] for i in range(1, n)} if some else []), f"S{min(PREFIX, length)}")

    def with_names(self, level: int) -> DataFrame:
        return self.shards.join(self.names[level], "shard") if level in self.names else self.shards.withColumn("names", F.lit(None).cast("binary"))

    def name(self, level: int) -> None:
        """Sorts and names the sampled triples of a level: its names are the characters of the next one."""
        length, bounds = self.length, self.bounds
        rows, last = self.with_names(level), level + 1 == self.top

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 1):
                x = b.to_pylist()[0]
                s = Shard(x["text"], length, x["sizes"])
                at = s.needed(level + 1) if last else s.cover(level + 1)
                if not len(at):
                    continue
                order, new, own = triples(s, at, level, s.characters(level, x["names"]))
                first = order[new]
                cuts = np.concatenate([[0], np.searchsorted(s.prefixes(at[first]), bounds), [len(first)]])
                full = np.flatnonzero(cuts[1:] > cuts[:-1])
                blocks = [planes(np.concatenate([t[first[cuts[k] : cuts[k + 1]]] for t in own])) for k in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full), pa.array([x["shard"]] * len(full), pa.int64()), pa.array(cuts[:-1][full]), pa.array(blocks, pa.binary())], ["range", "shard", "start", "block"]
                )

        def named(key: tuple, t: pa.Table) -> pa.Table:
            blocks = [numbers(x).reshape(3, -1) for x in t.column("block").to_pylist()]
            own = np.concatenate(blocks, axis=1)
            order = np.lexsort(own[::-1])
            new = np.ones(len(order), bool)
            new[1:] = (own[:, order[1:]] != own[:, order[:-1]]).any(axis=0)
            names = np.empty(len(order), np.int64)
            names[order] = np.cumsum(new) + (key[0].as_py() << PLACE)
            back = np.split(names, np.cumsum([x.shape[1] for x in blocks])[:-1])
            return pa.table([t.column("shard"), t.column("start"), pa.array([planes(x) for x in back], pa.binary())], ["shard", "start", "block"])

        dealt = rows.select("shard", "text", "sizes", "names").mapInArrow(deal, "range bigint, shard bigint, start bigint, block binary")
        found = dealt.groupBy("range").applyInArrow(named, "shard bigint, start bigint, block binary")
        by_shard = found.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("start", "block"))).alias("found"))

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 1):
                x = b.to_pylist()[0]
                s = Shard(x["text"], length, x["sizes"])
                order, new, _ = triples(s, s.needed(level + 1) if last else s.cover(level + 1), level, s.characters(level, x["names"]))
                out = np.empty(len(order), np.int64)
                out[order] = np.concatenate([numbers(y["block"]) for y in x["found"]])[np.cumsum(new) - 1]
                yield pa.RecordBatch.from_arrays([b.column("shard"), pa.array([planes(out)], pa.binary())], ["shard", "names"])

        joined = rows.join(by_shard, "shard").select("shard", "text", "sizes", "names", "found")
        self.names[level + 1] = cut(joined.mapInArrow(placed, "shard bigint, names binary"), f"suffix-names{level + 1}")

    def merge(self, level: int, ranks: DataFrame | None) -> DataFrame:
        """Merges the remaining suffixes of a level with the sample, whose ranks are those of the level above (None: its names).

        shard, ranks: by the needed places of this level. Level 0 gives shard, place instead, a row a range and shard at most: the
        places (32 bits) of strings that also start earlier.
        """
        length, bounds = self.length, self.bounds
        rows, above = self.with_names(level), self.names.get(self.top) if ranks is None else ranks
        rows = rows.join(above.toDF("shard", "above"), "shard") if above is not None else rows.withColumn("above", F.lit(None).cast("binary"))
        longs = 4 if level else 6

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 1):
                x = b.to_pylist()[0]
                s = Shard(x["text"], length, x["sizes"])
                chars = s.characters(level, x["names"])
                if x["above"] is None:
                    rank = s.dense(s.cover(1), s.characters(1, None)[s.cover(1)])
                else:
                    rank = s.dense(s.needed(level + 1), numbers(x["above"]))
                step, at = STEP * 3**level, s.needed(level)
                if not len(at):
                    continue
                digit = at // step % 3
                one, two = shifted(rank, step)[at], shifted(rank, 2 * step)[at]
                ranks = [np.where(digit == 0, one, rank[at]), np.where(digit == 1, one, two)]
                first, second = chars[at], shifted(chars, step)[at]
                if level:
                    table = np.stack([first, second, *ranks])
                else:  # both characters and the digit in one number, start and place in one number
                    ends = np.cumsum(s.sizes)
                    of = np.searchsorted(ends, at, "right")
                    start = (_longs(x["starts"]) - ends + s.sizes)[of] + at
                    table = np.stack([first << 32 | second << 2 | digit, *ranks, grams(prefix_sums(s.data), length)[at].view(np.int64), _longs(x["docs"])[of], start << 32 | at])
                fields = (
                    lambda p: p.astype(np.int32).tobytes() if level else None,
                    lambda p: digit[p].astype(np.int8).tobytes() if level else None,
                    lambda p: planes(table[:, p]),
                )
                to = s.ranges(at, bounds)
                order = np.argsort(to, kind="stable")
                full, first = np.unique(to[order], return_index=True)
                parts = np.split(order, first[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full), pa.array([x["shard"]] * len(full), pa.int64()), *[pa.array([f(p) for p in parts], pa.binary()) for f in fields]],
                    ["range", "shard", "place", "digit", "block"],
                )

        def ranked(key: tuple, t: pa.Table) -> pa.Table:
            blocks = [numbers(x).reshape(longs, -1) for x in t.column("block").to_pylist()]
            own = np.concatenate(blocks, axis=1)
            if not level:
                late = judge(own[3], own[4], own[5] >> 32, merged(own[0] >> 32, (own[0] & 0xFFFFFFFF) >> 2, own[1], own[2], own[0] & 3))
                edges = np.cumsum([x.shape[1] for x in blocks])[:-1]
                parts = [p[k].astype(np.int32).tobytes() for p, k in zip(np.split(own[5], edges), np.split(late, edges), strict=True)]  # the low 32 bits
                some = pa.array([len(x) > 0 for x in parts])
                return pa.table([t.column("shard"), pa.array(parts, pa.binary())], ["shard", "place"]).filter(some)
            before = merged(*own, np.frombuffer(b"".join(t.column("digit").to_pylist()), np.int8))
            back = np.split(before + 1 + (key[0].as_py() << PLACE), np.cumsum([x.shape[1] for x in blocks])[:-1])
            return pa.table([t.column("shard"), t.column("place"), pa.array([planes(x) for x in back], pa.binary())], ["shard", "place", "block"])

        dealt = rows.select("shard", "text", "sizes", "names", "docs", "tags", "starts", "above").mapInArrow(deal, "range bigint, shard bigint, place binary, digit binary, block binary")
        if not level:
            return dealt.groupBy("range").applyInArrow(ranked, "shard bigint, place binary")
        found = dealt.groupBy("range").applyInArrow(ranked, "shard bigint, place binary, block binary")

        @F.pandas_udf("binary")
        def placed(found: pd.Series) -> pd.Series:
            out = []
            for parts in found:
                place = np.concatenate([np.frombuffer(y["place"], np.int32) for y in parts])
                values = np.empty(len(place), np.int64)
                values[place] = np.concatenate([numbers(y["block"]) for y in parts])
                out.append(planes(values))
            return pd.Series(out, dtype=object)

        lists = found.groupBy("shard").agg(F.collect_list(F.struct("place", "block")).alias("found"))
        return cut(lists.select("shard", placed("found").alias("ranks")), f"suffix-ranks{level}")

    def sources(self, late: DataFrame) -> DataFrame:
        """doc, tag, at (32-bit starts), a row a text of a shard, from places of shards.

        Places go back to their shards and become texts' starts there: dealt to texts by the ranges, a text would have a row in each
        range that holds one of its strings.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 1):
                x = b.to_pylist()[0]
                place = np.sort(np.concatenate([np.frombuffer(y, np.int32) for y in x["late"]]))
                docs, tags, starts, sizes = (_longs(x[k]) for k in ("docs", "tags", "starts", "sizes"))
                ends = np.cumsum(sizes)
                of = np.searchsorted(ends, place, "right")
                doc, tag, at = docs[of], tags[of], (starts - ends + sizes)[of] + place
                edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]))
                blocks = [y.astype(np.int32).tobytes() for y in np.split(at, edge[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(doc[edge]), pa.array(tag[edge].astype(np.int32)), pa.array(blocks, pa.binary())], ["doc", "tag", "at"])

        by_shard = late.groupBy("shard").agg(F.collect_list("place").alias("late"))
        return self.shards.select("shard", "docs", "tags", "starts", "sizes").join(by_shard, "shard").mapInArrow(run, "doc bigint, tag int, at binary")

    def repeated(self) -> DataFrame:
        """doc, tag, at (32-bit starts): strings that also start earlier."""
        for level in range(1, self.top):
            self.name(level)
        ranks = None
        for level in range(self.top - 1, 0, -1):
            before, ranks = ranks, self.merge(level, ranks)
            release(*[x for x in (before, self.names.pop(level, None), self.names.pop(self.top, None)) if x is not None])
        found = cut(self.sources(self.merge(0, ranks)), "suffix-repeated")
        release(self.shards, *self.names.values(), *([ranks] if ranks is not None else []))
        return found


def judge(check: np.ndarray, doc: np.ndarray, start: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Compares adjacent prefixes in the order of the suffixes: which strings have an earlier source."""
    order = np.argsort(before, kind="stable")
    check = check[order]
    run = np.concatenate([[0], np.cumsum(check[1:] != check[:-1])])
    by_source = np.lexsort([start[order], doc[order], run])
    order, run = order[by_source], run[by_source]
    doc, start = doc[order], start[order]
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))[run]
    out = np.zeros(len(order), bool)
    out[order] = (doc != doc[first]) | (start != start[first])
    return out


def uncovered(size: int, later: np.ndarray | None, single: list[bytes] | None, length: int) -> np.ndarray:
    """Which of `size` bytes stay."""
    step = np.zeros(size + 1, np.int64)
    if later is not None and len(later):
        at = later >> 16
        np.add.at(step, at, 1)
        np.add.at(step, at + (later & 0xFFFF) + length - 1, -1)
    if single:
        at = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in single]))
        at = at[at + length <= size]
        np.add.at(step, at, 1)
        np.add.at(step, at + length, -1)
    return np.cumsum(step[:-1]) <= 0


def suffix_dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256, and with_text: kept (binary, the bytes that stay)."""
    op = Repeats(docs, length, id_col, text_col, gram)
    marks = op.marks()
    shards = sieved(op.shards(marks), length, op.gram)
    single = Sorter(shards, length).repeated().groupBy("doc", "tag").agg(F.collect_list("at").alias("single"))
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: list[tuple] = []
            for later, one, text in zip(b.column("later"), b.column("single").to_pylist(), _bytes(b.column("text").to_pylist()), strict=True):
                runs = lost = 0
                whole = later.values.to_numpy() if later.is_valid else np.zeros(0, np.int64)
                if len(whole) or one:
                    stay = uncovered(len(text), whole, one, length)
                    lost = int(np.count_nonzero(~stay))
                    runs = int(np.count_nonzero(~stay & np.concatenate([[True], stay[:-1]])))
                    kept = np.frombuffer(text, np.uint8)[stay].tobytes()
                else:
                    kept = text
                out.append((len(text), lost, runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]], names)

    gone = marks.select("doc", "tag", "later").join(single, ["doc", "tag"], "full")
    joined = op.source.join(gone, ["doc", "tag"], "left").select("id", "text", "later", "single")
    kind = op.source.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")
