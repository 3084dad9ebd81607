"""Substring dedup on a compacted De Bruijn graph of words.

Nodes are runs of n - 1 words, edges are windows of n words. Each text is a walk; the walk is cut into segments at the
windows' minimizers (the word k-mer of lowest hash inside a window), so that two equal windows lie in segments with the
same minimizer, at the same place relative to it. A segment of a text is a path without branches within that text.

1. Whole segments are compared first: a join on the segment's hash finds each segment whose words all stand in an
   earlier document. Repeated paths are so compacted to one path with its first source.
2. Where two different segments share a minimizer, paths branch: there, and only there, segments are opened into
   their single edges, and a second join finds each edge's first source.
3. Source coordinates decide: an edge is removed if it starts earlier, in a smaller document or at a smaller position
   of the same one. Runs of removed edges are verified with a second, independent hash taken at their coordinates; the
   joins carry it next to the first one, so that paths which only share one hash stay apart.

A window that repeats inside one document is settled there, so the joins carry document ids and no positions. A
segment or edge that very many documents hold is reduced to its smallest id within each task before the shuffle.

Defined results: null and empty texts have no words. With fewer than n words nothing is removed. Documents with a null
id count as larger than all others, among themselves nothing is earlier. Rows that repeat an id are the same document
as far as order goes: between them nothing is earlier. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import cut, release
from .hashing import U, blocks, mix, windows, word_hashes

K = 5  # words of a minimizer


@dataclass
class Walk:
    """The windows of one text: hashes, the segments between minimizers, and where these start and end."""

    count: int
    edge: np.ndarray
    check: np.ndarray | None
    first: np.ndarray
    last: np.ndarray
    minimizer: np.ndarray
    segment: np.ndarray
    segment_check: np.ndarray | None

    def repeated(self) -> np.ndarray:
        """Windows that start earlier in this text."""
        out = np.ones(self.count, bool)
        out[np.unique(self.edge, return_index=True)[1]] = False
        return out

    def inside(self, chosen: np.ndarray) -> np.ndarray:
        """Windows of the chosen segments."""
        return np.repeat(chosen, self.last - self.first)


NO_WALK = Walk(0, *[np.zeros(0, U)] * 7)


def walks(texts: list[str | None], n: int, second: bool = False) -> Iterator[tuple[bytes, Walk]]:
    """Each text and its walk; second: with hashes from other hashes of the words, for verification.

    Hashes are computed for a block of texts at once; windows that would reach over the end of a text are left out.
    """
    for _, held in blocks(texts):
        h, bounds = word_hashes(held)
        counts = np.maximum(0, np.diff(bounds) - n + 1)
        ends = np.concatenate([[0], np.cumsum(counts)])
        if not ends[-1]:
            yield from ((text, NO_WALK) for text in held)
            continue
        k = min(K, n)
        mins = windows(h, k, 1)
        place = np.repeat(bounds[:-1] - ends[:-1], counts) + np.arange(ends[-1])
        at = (np.arange(len(h) - n + 1) + sliding_window_view(mins, n - k + 1).argmin(axis=1))[place]
        edge = windows(h, n)[place]
        new = np.concatenate([[True], at[1:] != at[:-1]])
        new[ends[:-1][counts > 0]] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], ends[-1])
        minimizer = mins[at[first]]
        check = segment_check = None
        with np.errstate(over="ignore"):
            # a segment: its minimizer, where it starts relative to that, its edges in order
            sums = np.add.reduceat(mix(edge, 2) * ((place - at).astype(U) << U(1) | U(1)), first)
            segment = mix(sums + mix(minimizer, 3), 4)
            if second:
                check = windows(word_hashes(held, 1)[0], n, 5)[place]
                segment_check = np.add.reduceat(mix(check, 6) * (edge | U(1)), first)
        of = np.searchsorted(first, ends)
        for j, text in enumerate(held):
            a, b, x, y = ends[j], ends[j + 1], of[j], of[j + 1]
            if a == b:
                yield text, NO_WALK
            else:
                yield text, Walk(
                    int(b - a), edge[a:b], check[a:b] if second else None, first[x:y] - a, last[x:y] - a, minimizer[x:y], segment[x:y], segment_check[x:y] if second else None
                )


def check32(x: np.ndarray) -> pa.Array:
    return pa.array((x >> U(32)).astype(np.uint32).view(np.int32))


class SubstringDedup:
    def __init__(self, docs: DataFrame, n: int, id_col: str, text_col: str):
        self.n = n
        self.source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def keys(self, first: bool) -> DataFrame:
        """key, c, v for each distinct segment of a document, and for each minimizer.

        A segment's key goes with its second hash c, and v is the document. A minimizer's key goes with c = NO_CHECK, and v
        is the segment (first pass) or the document (second pass).
        """
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                keys, checks, values = [], [], []
                for key, (_, w) in zip(b.column(0).to_pylist(), walks(b.column(1).to_pylist(), n, True), strict=True):
                    if w.count:
                        doc = FAR if key is None else key
                        one, index = np.unique(w.segment, return_index=True)
                        if first:
                            m, of_m = w.minimizer[index], one.view(np.int64)
                        else:
                            m = np.unique(w.minimizer)
                            of_m = np.full(len(m), doc, np.int64)
                        keys += [one, m]
                        checks += [w.segment_check[index] >> U(32), np.full(len(m), NO_CHECK, U)]
                        values += [np.full(len(one), doc, np.int64), of_m]
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(checks).view(np.int64)), pa.array(np.concatenate(values))], ["key", "c", "v"]
                    )

        return self.source.mapInArrow(run, "key bigint, c bigint, v bigint")

    def marks(self) -> DataFrame:
        """id, whole, open: segments of a document that stand whole in an earlier one; minimizers at which paths branch.

        One aggregate finds repeated segments with their first source and minimizers with more than one segment; one join
        brings both to the documents that hold them.
        """
        shared = cut(self.keys(True).groupBy("key", "c").agg(F.min("v").alias("a"), F.max("v").alias("b")).filter("a <> b").select("key", "c", "a"), "substring-shared")
        found = self.keys(False).join(shared, ["key", "c"]).filter(f"c = {NO_CHECK} OR v > a").select(F.col("v").alias("id"), "key", (F.col("c") == NO_CHECK).alias("opens"))
        lists = found.groupBy("id").agg(
            F.collect_list(F.when(~F.col("opens"), F.col("key"))).alias("whole"), F.collect_list(F.when(F.col("opens"), F.col("key"))).alias("open")
        )
        out = cut(lists, "substring-marks")
        release(shared)
        return out

    def edges(self, marks: DataFrame) -> DataFrame:
        """e, c (second hash), id: edges of the opened segments that aren't found whole elsewhere."""
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                out, checks, ids = [], [], []
                for key, whole, opened, (_, w) in zip(
                    b.column("id").to_pylist(), b.column("whole").to_pylist(), b.column("open").to_pylist(), walks(b.column("text").to_pylist(), n, True), strict=True
                ):
                    if w.count:
                        pick = np.isin(w.minimizer, _u(opened)) & ~np.isin(w.segment, _u(whole))
                        at = np.flatnonzero(w.inside(pick))
                        one, index = np.unique(w.edge[at], return_index=True)
                        out.append(one)
                        checks.append(w.check[at][index])
                        ids.append(np.full(len(one), FAR if key is None else key, np.int64))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), check32(np.concatenate(checks)), pa.array(np.concatenate(ids))], ["e", "c", "id"])

        joined = self.source.join(marks, F.coalesce(self.source["id"], F.lit(FAR)) == marks["id"]).select(marks["id"], "whole", "open", "text")
        return joined.mapInArrow(run, "e bigint, c int, id bigint")

    def removed(self) -> DataFrame:
        """id, whole, edges: what to remove from each document that has something to remove."""
        marks = self.marks()
        rows = cut(self.edges(marks), "substring-edges")
        firsts = rows.groupBy("e", "c").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("e", "c", "a")
        later = cut(rows.join(firsts, ["e", "c"]).filter("id > a").groupBy("id").agg(F.collect_list("e").alias("edges")), "substring-later")
        release(rows)
        return marks.select("id", "whole").join(later, "id", "left").filter("size(whole) > 0 OR edges IS NOT NULL")


#: In the place of a second hash (32 bits): the key is a minimizer.
NO_CHECK = 1 << 40
#: Stands for a null id: larger than any other.
FAR = (1 << 63) - 1


def _u(x: list[int] | np.ndarray | None) -> np.ndarray:
    return np.array([] if x is None else x, np.int64).view(U)


def covered(w: Walk, whole: list[int] | None, edges: list[int] | None, n: int, words: int) -> np.ndarray:
    """Words covered by a removed window."""
    gone = np.zeros(words + 1, np.int64)
    if w.count:
        bad = w.repeated()
        if whole is not None and len(whole):
            bad |= w.inside(np.isin(w.segment, _u(whole)))
        if edges is not None and len(edges):
            bad |= np.isin(w.edge, _u(edges))
        at = np.flatnonzero(bad)
        np.add.at(gone, at, 1)
        np.add.at(gone, at + n, -1)
    return np.cumsum(gone[:-1]) > 0


def substring_dedup(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, kept_sha256, and with_text: kept (the kept words, null if all are)."""
    op = SubstringDedup(docs, n, id_col, text_col)
    removed = op.removed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            total, lost, sha, kept = [], [], [], []
            for whole, edges, (text, w) in zip(b.column("whole").to_pylist(), b.column("edges").to_pylist(), walks(b.column("text").to_pylist(), n), strict=True):
                words = text.split()
                gone = covered(w, whole, edges, n, len(words))
                k = int(gone.sum())
                if k:
                    words = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
                line = b" ".join(words)
                total.append(len(gone))
                lost.append(k)
                sha.append(hashlib.sha256(line).hexdigest())
                kept.append(line.decode() if k and with_text else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names)

    names = ["id", "n_words", "n_removed", "kept_sha256", "kept"]
    marks = removed.withColumnRenamed("id", "__id")
    joined = op.source.join(marks, F.coalesce(op.source["id"], F.lit(FAR)) == marks["__id"], "left").select("id", "text", "whole", "edges")
    out = joined.mapInArrow(run, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return out if with_text else out.drop("kept")


def remove_repeats(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with all columns, the repeated words cut from the text.

    A text that loses words becomes its kept words joined by one space (the empty text, if it loses all); other texts stay
    as they are. chars_col, where docs has it, follows the text.
    """
    op = SubstringDedup(docs, n, id_col, text_col)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, wholes: pd.Series, edges: pd.Series) -> pd.Series:
        out = []
        for t, whole, edge, (text, w) in zip(texts, wholes, edges, walks(list(texts), n), strict=True):
            words = text.split()
            gone = covered(w, whole, edge, n, len(words))
            out.append(b" ".join(x for x, g in zip(words, gone.tolist(), strict=True) if not g).decode() if gone.any() else t)
        return pd.Series(out, dtype=object)

    removed = op.removed().select(F.col("id").alias("__id"), F.col("whole").alias("__whole"), F.col("edges").alias("__edges"))
    joined = docs.join(removed, F.coalesce(docs[id_col].cast("long"), F.lit(FAR)) == removed["__id"], "left")
    out = joined.withColumn("__kept", kept(docs[text_col].cast("string"), "__whole", "__edges"))
    new = {text_col: F.col("__kept")}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("__kept").eqNullSafe(docs[text_col]), docs[chars_col]).otherwise(F.length("__kept").cast(docs.schema[chars_col].dataType))
    return out.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])
