"""Byte-level BPE encoding and decoding as a tree reduction over text segments.

A text is halved down to leaves. A node is (head, ids, tail): ids are tokens that no neighbour can change, head and tail
are the text left and right of them whose tokens still can. Joining two nodes encodes the window tail + head between
them; where a node has no stable token yet, all of it joins the window, which so grows until it does. The join is
associative, and the tokens outside a window are final because windows end at stable cuts only:

    A stable cut is a single space with a non-space on both sides. Of the pattern's alternatives, only a run of white
    space contains white space after its first character, so a match can't reach over such a space from the left, and
    what starts at the space doesn't depend on what is left of it. A look-ahead is used behind white space only, and
    the left side doesn't end with any.

Decoding maps halves of the id list to bytes and concatenates them up the same tree.

Defined results: a null text is the empty text and has no ids. Any Unicode text is encoded whole; lone surrogates can't
occur in Spark strings. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYNC = re.compile(r"(?<=\S) (?=\S)")
LEAF_CHARS = 512
LEAF_IDS = 256
CACHED = 300_000
_CODECS: dict[str, Codec] = {}


class _Open(Exception):
    """A space isn't a stable cut."""


class _Chunks(dict):
    """Ids (little-endian unsigned 32-bit) of ' ' + chunk by chunk, for chunks between stable cuts."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Open
        ids = self.codec.raw(" " + chunk)
        if len(chunk) <= 40:
            if len(self) >= CACHED:
                self.clear()
            self[chunk] = ids
        return ids


class Codec:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.chunks = _Chunks(self)

    def raw(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, chunk by chunk between its stable cuts."""
        if not text:
            return b""
        end = text[-1].isspace()
        for parts in (text.split(" "), None):
            parts = SYNC.split(text) if parts is None else parts
            last = [self.raw(" " + parts.pop())] if end and len(parts) > 1 and parts[-1] and not parts[-1][0].isspace() else []
            try:
                return b"".join([self.raw(parts[0]), *map(self.chunks.__getitem__, parts[1:]), *last])
            except _Open:
                continue
        return self.raw(text)

    def leaf(self, text: str) -> tuple[str, bytes | None, str]:
        """The node of a segment. ids is None where the segment has no two stable cuts."""
        first = SYNC.search(text)
        if first is None:
            return text, None, ""
        at = text.rfind(" ")
        while not (0 < at < len(text) - 1 and not text[at - 1].isspace() and not text[at + 1].isspace()):
            at = text.rfind(" ", 0, at)
        return text[: first.start()], self.encode_from(text[first.start() : at]), text[at:]

    def encode_from(self, text: str) -> bytes:
        """Ids of a text that starts and ends at stable cuts."""
        if not text:
            return b""
        try:
            return b"".join(map(self.chunks.__getitem__, text[1:].split(" ")))
        except _Open:
            return b"".join(self._open(x) for x in SYNC.split(text[1:]))

    def _open(self, chunk: str) -> bytes:
        try:
            return self.chunks[chunk]
        except _Open:
            return self.raw(" " + chunk)

    def join(self, a: tuple[str, bytes | None, str], b: tuple[str, bytes | None, str]) -> tuple[str, bytes | None, str]:
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.encode(a[2] + b[0]) + b[1], b[2]

    def node(self, text: str, low: int, high: int) -> tuple[str, bytes | None, str]:
        if high - low <= LEAF_CHARS:
            return self.leaf(text[low:high])
        mid = (low + high) // 2
        return self.join(self.node(text, low, mid), self.node(text, mid, high))

    def encode_tree(self, text: str) -> bytes:
        head, ids, tail = self.node(text, 0, len(text))
        return self.encode(head) if ids is None else self.encode(head) + ids + self.encode(tail)

    def decode_tree(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self.decode_tree(ids[:mid]) + self.decode_tree(ids[mid:])


class JsonCodec(Codec):
    """The codec of a byte-level BPE's JSON file as the tokenizers library reads it: added tokens are found in any text.

    They are no part of a chunk's merges and hold no white space, so no stable cut stands inside one.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added, split = file["model"], file["added_tokens"], file["pre_tokenizer"]
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"]) for x in added):
            raise ValueError(f"{path}: added tokens that reach over white space or depend on words")
        if file["normalizer"] or (split["type"], split["add_prefix_space"], split["use_regex"]) != ("ByteLevel", False, True) or model["ignore_merges"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        order = [model["vocab"]["".join(x)] for x in pairs]
        if any(x >= y for x, y in zip(order, order[1:], strict=False)):
            raise ValueError(f"{path}: ids don't follow the order of merges")
        # the byte-level alphabet: bytes without a letter of their own follow from 256
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in model["vocab"].items()}
        self.added = {x["content"]: x["id"] for x in added}
        self.encoding = tiktoken.Encoding("json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.tokens = [b""] * (max([*ranks.values(), *self.added.values()]) + 1)
        for token, i in [*ranks.items(), *((x.encode(), i) for x, i in self.added.items())]:
            self.tokens[i] = token
        self.chunks = _Chunks(self)

    def raw(self, text: str) -> bytes:
        if any(x in text for x in self.added):
            return np.array(self.encoding.encode(text, allowed_special="all"), dtype="<u4").tobytes()
        return super().raw(text)


def codec(path: str) -> Codec:
    """The codec of a rank file or a tokenizer's JSON file, one for each Python worker."""
    if path not in _CODECS:
        _CODECS[path] = (JsonCodec if path.endswith(".json") else Codec)(path)
    return _CODECS[path]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that Python objects for one slice only are alive."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode_ids(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary: little-endian unsigned 32-bit), n_tokens for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path)
        for b in slices(batches):
            ids = [own.encode_tree(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())], ["id", "ids", "n_tokens"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}, ids binary, n_tokens bigint")


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """encoded (id, ids, n_tokens) with the decoded bytes in the place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path)
        for b in slices(batches):
            out = [own.decode_tree(np.frombuffer(x, dtype="<u4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)], ["id", "bytes", "n_tokens"])

    return encoded.mapInArrow(run, f"id {encoded.schema['id'].dataType.simpleString()}, bytes binary, n_tokens bigint")


def round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, without carrying ids between operators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path)
        for b in slices(batches):
            n, ids_sha, out_sha = [], [], []
            for text in b.column(1).to_pylist():
                ids = own.encode_tree(text or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                out_sha.append(hashlib.sha256(own.decode_tree(np.frombuffer(ids, dtype="<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
