"""Cost-balanced packing of documents into token sequences.

A document is its ids and an end id. Runs of `length` tokens become sequences of their own; what remains of each document
is packed. A task gathers remainders into blocks of about `block_tokens` tokens (its memory is bounded by that and the
longest document), opens the sequences that the block's tokens fill exactly (the last few shorter, at powers of two),
and deals the remainders by falling estimated attention cost (linear * n + quadratic * n * n) to the sequence of lowest
cost that still has room for them. A remainder that fits nowhere whole when its turn comes is cut over the sequences with
most room, which then are nearly as large as it is, so that it becomes few pieces. As every sequence is full, a block
has about one cut a sequence, whoever bears it.

Sequence ids are unique: the number of the input partition and a count inside it; a task that runs again gives the same
ids. Nothing is shuffled.

Defined results: a null text is the empty text, one piece with the end id. Repeated rows are packed once each. Extra
columns are ignored. With a tokenizer's JSON file, its added tokens are found in any text, as the tokenizers library does.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec, slices

Piece = tuple[int, int, int, int, int]  # document, start, length, sequence, offset


def cost(n: int, linear: float = 1.0, quadratic: float = 1 / 2048) -> float:
    """Estimated cost of attention over one piece of n tokens."""
    return linear * n + quadratic * n * n


def pack_block(lengths: list[tuple[int, int, int]], capacity: int) -> list[Piece]:
    """Pieces for (document, start, length < capacity) in sequences from 0: descending cost, lowest-cost bin with room.

    The bins hold the block's tokens exactly: full sequences, and what is left as sequences of falling powers of two,
    which aren't padded.
    """
    total, out = sum(n for _, _, n in lengths), []
    size = np.array([capacity] * (total // capacity) + [1 << k for k in range(capacity.bit_length(), -1, -1) if (total % capacity) >> k & 1])
    room, spent = size.copy(), np.zeros(len(size))

    def put(doc: int, start: int, n: int, b: int) -> None:
        out.append((doc, start, n, b, int(size[b] - room[b])))
        room[b] -= n
        spent[b] += cost(n)

    for doc, start, n in sorted(lengths, key=lambda x: (-x[2], x[0], x[1])):
        b = int(np.where(room >= n, spent, np.inf).argmin())
        if room[b] >= n:
            put(doc, start, n, b)
            continue
        while n:  # fits nowhere whole: cut over the bins with most room, while these are still large
            b = int(room.argmax())
            take = min(n, int(room[b]))
            put(doc, start, take, b)
            start, n = start + take, n - take
    return out


def pack(
    docs: DataFrame, ranks_path: str, end_id: int = 1, length: int = 2048, block_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = codec(ranks_path), np.array([end_id], "<u4").tobytes()
        base, ids_type = TaskContext.get().partitionId() << 36, None
        held: list[tuple[object, bytes, int, int]] = []  # id, ids that remain, where they start, the document's tokens
        tokens = used = 0
        rows: list[tuple] = []

        def flush() -> None:
            nonlocal tokens, used, held
            for doc, start, n, seq, at in pack_block([(k, s, len(x) // 4) for k, (_, x, s, _) in enumerate(held)], length):
                key, ids, first, total = held[doc]
                part = ids[4 * (start - first) : 4 * (start - first + n)]
                rows.append((key, start, n, zlib.crc32(part), total, base + used + seq, at))
            used += tokens // length + (tokens % length).bit_count()
            held, tokens = [], 0

        def batch() -> pa.RecordBatch:
            out = list(zip(*rows, strict=True)) or [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, ids_type if k == 0 else pa.int64()) for k, x in enumerate(out)], names)

        for b in slices(batches):
            ids_type = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = own.encode(text or "") + end
                total = len(ids) // 4
                full = total // length * length
                for start in range(0, full, length):
                    rows.append((key, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, base + used, 0))
                    used += 1
                if total > full:
                    held.append((key, ids[4 * full :], full, total))
                    tokens += total - full
                    if tokens >= block_tokens:
                        flush()
            if len(rows) > 10_000:
                yield batch()
        flush()
        if rows:
            yield batch()

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, " + ", ".join(f"{x} bigint" for x in names[1:]))
