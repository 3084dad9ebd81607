"""Media columns: lossless WebP images, written and read in numpy.

Reading decodes prefix codes, back-references (with the neighbourhood distance codes) and the colour cache, then inverts
the transforms: predictor, cross-colour, subtract-green and palette (with bundled pixels). Where a stream holds literals
in one channel only, code words are looked up at all bit positions at once and the chain of starts is followed; any
other stream is decoded symbol by symbol.

Writing media columns picks, image by image and by estimated size, literals, a palette with bundled pixels, prediction from
the top or the left, or back-references. A colour cache and cross-colour never make images of one channel smaller; encode()
writes these too on request, and prediction by any mode, so that every part of the reader is tested by round trips.

As a media column, a text's UTF-8 bytes, zero-filled to a positive multiple of 64, become the green samples of images 64
pixels wide (of at most 16,384 rows; a longer payload becomes several images, one behind the other).

Defined results: a null text is the empty text; its payload is 64 zero bytes. Equal texts have equal media. Repeated
rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices

WIDTH, ROWS = 64, 16384
PAYS = 16
# Fixed values of the format: order of code-length code lengths; alphabet sizes beside the colour cache.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
GREEN, CHANNEL, DISTANCE = 256 + 24, 256, 40
PREDICTOR, CROSS, SUBTRACT, PALETTE = 0, 1, 2, 3
CACHE_FACTOR = 0x1E35A7BD
#: The 120 nearest pixels before a pixel, by distance; on a tie the higher row, then the right side first.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, -p[1], p[0] < 0))


# --- bits and prefix codes ---------------------------------------------------------------------------------------


class Reader:
    def __init__(self, data: bytes, pos: int = 0):
        self.data, self.pos = data, pos

    def read(self, n: int) -> int:
        at = self.pos >> 3
        x = int.from_bytes(self.data[at : at + (n + 14 >> 3)], "little") >> (self.pos & 7) & ((1 << n) - 1)
        self.pos += n
        return x


class Writer:
    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.value = self.size = 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n
        if self.size > 4096:
            self.flush()

    def flush(self) -> None:
        data = np.frombuffer(self.value.to_bytes(self.size + 7 >> 3, "little"), np.uint8)
        self.parts.append(np.unpackbits(data, count=self.size, bitorder="little"))
        self.value = self.size = 0

    def put_codes(self, codes: np.ndarray, lengths: np.ndarray) -> None:
        """Code words one behind the other."""
        self.flush()
        if len(codes):
            k = np.arange(int(lengths.max()))
            for at in range(0, len(codes), 65536):
                c, n = codes[at : at + 65536, None], lengths[at : at + 65536, None]
                self.parts.append((c >> k & 1).astype(np.uint8)[k < n])

    def put_symbols(self, symbols: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> None:
        """Code words of many symbols of one code: their bits are looked up in a table of all words."""
        self.flush()
        k = np.arange(int(lengths.max(initial=0)))
        bits, used = (words[:, None] >> k & 1).astype(np.uint8), k < lengths[:, None]
        for at in range(0, len(symbols), 65536):
            s = symbols[at : at + 65536]
            self.parts.append(bits[s][used[s]])

    def bytes(self) -> bytes:
        self.flush()
        return np.packbits(np.concatenate(self.parts), bitorder="little").tobytes()


@cache
def turned(bits: int) -> np.ndarray:
    """The numbers of so many bits, each with its bits in reverse."""
    out = np.zeros(1 << bits, np.int64)
    for k in range(bits):
        out |= (np.arange(1 << bits) >> k & 1) << (bits - 1 - k)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code words (first bit lowest) for code lengths; 0: no such symbol."""
    out, most = np.zeros(len(lengths), np.int64), int(lengths.max(initial=0))
    used = np.flatnonzero(lengths)
    if most:
        used = used[np.argsort(lengths[used], kind="stable")]
        room = 1 << most - lengths[used]
        out[used] = turned(most)[np.cumsum(room) - room]
    return out


def code_lengths(counts: np.ndarray, limit: int = 15) -> np.ndarray:
    """Optimal lengths for symbol counts; counts are flattened until none exceeds the limit."""
    used = np.flatnonzero(counts).tolist()
    out = np.zeros(len(counts), np.int64)
    if len(used) == 1:
        out[used[0]] = 1
    floor = 1
    while len(used) > 1:
        heap = [(max(int(counts[s]), floor), s, ()) for s in used]
        heapq.heapify(heap)
        tag = len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], tag, (a, b)))
            tag += 1
        todo = [(heap[0], 0)]
        while todo:
            (_, s, kids), depth = todo.pop()
            if kids:
                todo += [(k, depth + 1) for k in kids]
            else:
                out[s] = depth
        if out.max() <= limit:
            break
        floor *= 4
    return out


class Code:
    """A prefix code for decoding: symbol and length for every window of `bits` bits."""

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        self.single = int(used[0]) if len(used) == 1 else None if len(used) else 0
        self.bits = 0 if self.single is not None else int(lengths.max())
        self.used = used
        if self.single is None:
            order = used[np.argsort(lengths[used], kind="stable")]
            room = 1 << self.bits - lengths[order]
            if room.sum() != 1 << self.bits:
                raise ValueError("a prefix code is incomplete")
            at = turned(self.bits)
            self.symbol = np.repeat(order, room).astype(np.int32)[at]
            self.length = np.repeat(lengths[order], room).astype(np.int32)[at]

    def read(self, r: Reader) -> int:
        if self.single is not None:
            return self.single
        at = r.pos >> 3
        w = int.from_bytes(r.data[at : at + 3], "little") >> (r.pos & 7) & ((1 << self.bits) - 1)
        r.pos += int(self.length[w])
        return int(self.symbol[w])


@cache
def single_code(symbol: int, size: int) -> Code:
    lengths = np.zeros(size, np.int64)
    lengths[symbol] = 1
    return Code(lengths)


def read_code(r: Reader, size: int) -> Code:
    lengths = np.zeros(size, np.int64)
    if r.read(1):
        two = r.read(1)
        first = r.read(8 if r.read(1) else 1)
        if not two:
            return single_code(first, size)
        lengths[first] = 1
        lengths[r.read(8)] = 1
        return Code(lengths)
    own = np.zeros(19, np.int64)
    for k in range(r.read(4) + 4):
        own[LENGTH_ORDER[k]] = r.read(3)
    code, most = Code(own), size
    if r.read(1):
        most = r.read(2 * r.read(3) + 2) + 2
    at, before = 0, 8
    while at < size and most:
        most -= 1
        s = code.read(r)
        if s < 16:
            lengths[at] = s
            at += 1
            before = s or before
        else:
            n = r.read(2) + 3 if s == 16 else r.read(3) + 3 if s == 17 else r.read(7) + 11
            lengths[at : at + n] = before if s == 16 else 0
            at += n
    return Code(lengths)


def write_single(w: Writer, symbol: int) -> None:
    """The code of one symbol below 256, which takes no bits."""
    w.put(0b101 | symbol << 3, 11)


def write_code(w: Writer, lengths: np.ndarray) -> None:
    used = np.flatnonzero(lengths).tolist()
    if len(used) <= 2 and all(s < 256 for s in used):
        used = used or [0]
        w.put(1, 1)
        w.put(len(used) - 1, 1)
        w.put(1, 1)
        for s in used:
            w.put(s, 8)
        return
    if len(used) == 1:  # a single symbol beyond 255: a second one of the same length, which never occurs
        lengths = lengths.copy()
        lengths[0] = 1
    flat, runs, k = lengths.tolist(), [], 0  # runs: (symbol, value of its extra bits, how many)
    while not flat[-1]:
        flat.pop()
    while k < len(flat):
        n = 1
        if not flat[k]:
            while n < 138 and not flat[k + n]:
                n += 1
        if n >= 3:
            runs.append((17, n - 3, 3) if n < 11 else (18, n - 11, 7))
        else:
            n = 1
            runs.append((flat[k], 0, 0))
        k += n
    own = code_lengths(np.bincount([s for s, _, _ in runs], minlength=19), 7)
    if len(np.flatnonzero(own)) == 1:
        own[0 if own[0] == 0 else 1] = 1
    words, own = canonical(own).tolist(), own.tolist()
    w.put(0, 1)
    w.put(15, 4)
    for s in LENGTH_ORDER:
        w.put(own[s], 3)
    w.put(1, 1)
    bits = max(2, (len(runs) - 2).bit_length() + 1 & ~1) if len(runs) > 2 else 2
    w.put((bits - 2) // 2, 3)
    pad = max(0, 2 - len(runs))
    w.put(len(runs) + pad - 2, bits)
    for s, extra, n in runs:
        w.put(words[s], own[s])
        w.put(extra, n)


# --- images ------------------------------------------------------------------------------------------------------


def prefix_value(r: Reader, code: int) -> int:
    if code < 4:
        return code + 1
    extra = code - 2 >> 1
    return (2 + (code & 1) << extra) + r.read(extra) + 1


def prefix_parts(value: int) -> tuple[int, int, int]:
    """Code, extra bits, their number for a length or distance from 1."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    top = v.bit_length() - 1
    return 2 * top + (v >> top - 1 & 1), v & ((1 << top - 1) - 1), top - 1


def read_pixels(r: Reader, width: int, height: int, main: bool) -> np.ndarray:
    """Pixels as ARGB in 32 bits."""
    cache_bits = r.read(4) if r.read(1) else 0
    block, groups = None, 1
    if main and r.read(1):
        bits = r.read(3) + 2
        entropy = read_pixels(r, width + (1 << bits) - 1 >> bits, height + (1 << bits) - 1 >> bits, False)
        block, groups = (entropy >> 8 & 0xFFFF, bits, width + (1 << bits) - 1 >> bits), int((entropy >> 8 & 0xFFFF).max()) + 1
    cache_size = 1 << cache_bits if cache_bits else 0
    codes = [[read_code(r, n) for n in (GREEN + cache_size, CHANNEL, CHANNEL, CHANNEL, DISTANCE)] for _ in range(groups)]
    total = width * height
    green, red, blue, alpha, _ = codes[0]
    if groups == 1 and not cache_size and red.single is not None and blue.single is not None and alpha.single is not None:
        rest = np.uint32(alpha.single << 24 | red.single << 16 | blue.single)
        plain = not len(green.used) or green.used[-1] < 256
        found = literals(r, green, total) if plain else one_channel(r, green, codes[0][4], total, width)
        return found.astype(np.uint32) << np.uint32(8) | rest
    out = np.zeros(total, np.uint32)
    cache = [0] * cache_size
    shift, k = 32 - cache_bits, 0
    fill = 0  # pixels before this one are in the cache

    def fill_cache(upto: int) -> None:
        nonlocal fill
        for p in out[fill:upto].tolist():
            cache[(CACHE_FACTOR * p & 0xFFFFFFFF) >> shift] = p
        fill = upto

    while k < total:
        group = codes[int(block[0][(k // width >> block[1]) * block[2] + (k % width >> block[1])])] if block else codes[0]
        s = group[0].read(r)
        if s < 256:
            x, b, a = group[1].read(r), group[2].read(r), group[3].read(r)
            out[k] = a << 24 | x << 16 | s << 8 | b
            k += 1
        elif s < GREEN:
            n = prefix_value(r, s - 256)
            d = prefix_value(r, group[4].read(r))
            if d > 120:
                d -= 120
            else:
                x, y = NEAR[d - 1]
                d = max(1, y * width + x)
            n = min(n, total - k)
            if d >= n:
                out[k : k + n] = out[k - d : k - d + n]
            else:
                out[k : k + n] = np.resize(out[k - d : k], n)
            k += n
        else:
            fill_cache(k)
            out[k] = cache[s - GREEN]
            k += 1
        if cache_size and fill < k:
            fill_cache(k)
    return out


def literals(r: Reader, code: Code, n: int) -> np.ndarray:
    """n symbols of one code: looked up at all bit positions, then the chain of code words is followed."""
    if code.single is not None:
        return np.full(n, code.single, np.int32)
    start, low = r.pos & 7, r.pos >> 3
    b = np.frombuffer(r.data[low : low + (n * code.bits + start + 7 >> 3)] + b"\0\0\0", np.uint8).astype(np.uint32)
    words = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    window = ((words[:, None] >> np.arange(8, dtype=np.uint32)) & np.uint32((1 << code.bits) - 1)).ravel()
    # jumps over 2, 4, 8 and 16 code words; one start in 16 is found by jumping, those between from them
    jump = [np.minimum(np.arange(len(window), dtype=np.int32) + code.length[window], np.int32(len(window) - 1))]
    for _ in range(4):
        jump.append(jump[-1][jump[-1]])
    at = np.empty(-(-n // 16), np.int64)
    p, far = start, jump[4]
    for k in range(len(at)):
        at[k] = p
        p = far[p]
    for step in reversed(jump[:4]):
        at = np.stack([at, step[at]], 1).ravel()
    at = at[:n]
    r.pos += int(jump[0][at[-1]]) - start
    return code.symbol[window[at]]


def one_channel(r: Reader, code: Code, distances: Code, total: int, width: int) -> np.ndarray:
    """Values of an image with one channel and back-references: runs of literals are followed by jumps, as in literals()."""
    out, k, base = np.zeros(total, np.int32), 0, r.pos & ~7
    b = np.frombuffer(r.data[base >> 3 :] + b"\0\0\0", np.uint8).astype(np.uint32)
    words = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    if code.single is None:
        window = ((words[:, None] >> np.arange(8, dtype=np.uint32)) & np.uint32((1 << code.bits) - 1)).ravel()
        symbol, length = code.symbol[window], code.length[window]
    else:
        symbol, length = np.full(8 * len(words), code.single, np.int32), np.zeros(8 * len(words), np.int32)
    stop, last = symbol >= 256, np.int32(len(symbol) - 1)
    here = np.arange(len(symbol), dtype=np.int32)
    jump = [np.where(stop, here, np.minimum(here + length, last))]
    for _ in range(4):
        jump.append(jump[-1][jump[-1]])
    while k < total:
        at = [r.pos - base]
        while not stop[at[-1]] and 16 * len(at) < total - k and (far := int(jump[4][at[-1]])) != at[-1]:
            at.append(far)
        at = np.array(at)
        for step in reversed(jump[:4]):
            at = np.stack([at, step[at]], 1).ravel()
        n = int(stop[at].argmax()) if stop[at].any() else len(at)
        n = min(n, total - k)
        out[k : k + n] = symbol[at[:n]]
        k += n
        if n:
            r.pos = base + int(at[n - 1] + length[at[n - 1]])
        if k < total and stop[r.pos - base]:
            s = code.read(r)
            n = min(prefix_value(r, s - 256), total - k)
            d = prefix_value(r, distances.read(r))
            if d > 120:
                d -= 120
            else:
                x, y = NEAR[d - 1]
                d = max(1, y * width + x)
            out[k : k + n] = out[k - d : k - d + n] if d >= n else np.resize(out[k - d : k], n)
            k += n
    return out


def write_pixels(w: Writer, argb: np.ndarray, width: int, main: bool, cache_bits: int = 0, back: bool = False) -> None:
    """An image: literals, with back-references and colour-cache hits on request."""
    w.put(1 if cache_bits else 0, 1)
    if cache_bits:
        w.put(cache_bits, 4)
    if main:
        w.put(0, 1)  # one group of prefix codes
    size = GREEN + (1 << cache_bits if cache_bits else 0)
    if not back and not cache_bits:
        b = np.ascontiguousarray(argb.astype("<u4")).view(np.uint8)
        channels = [b[k::4] for k in (1, 2, 0, 3)]
        lengths = [code_lengths(np.bincount(c, minlength=n)) for c, n in zip(channels, (size, 256, 256, 256), strict=True)]
        for x in lengths:
            write_code(w, x)
        write_code(w, np.zeros(DISTANCE, np.int64))
        many = [(c, canonical(x), x) for x, c in zip(lengths, channels, strict=True) if len(np.flatnonzero(x)) > 1]
        if len(many) == 1:
            w.put_symbols(*many[0])
        elif many:
            w.put_codes(np.stack([x[c] for c, x, _ in many], 1).ravel(), np.stack([n[c] for c, _, n in many], 1).ravel())
        return
    tokens = tokenize(argb.tolist(), cache_bits, back)
    counts = [np.zeros(n, np.int64) for n in (size, 256, 256, 256, DISTANCE)]
    for t in tokens:
        for channel, s, _, _ in t:
            counts[channel][s] += 1
    lengths = [code_lengths(c) for c in counts]
    for x in lengths:
        write_code(w, x)
    words = [canonical(x) for x in lengths]
    alone = [len(np.flatnonzero(x)) == 1 and int(np.flatnonzero(x)[0]) < 256 for x in lengths]
    for t in tokens:
        for channel, s, extra, n in t:
            if not alone[channel]:
                w.put(int(words[channel][s]), int(lengths[channel][s]))
            w.put(extra, n)


def tokenize(pixels: list[int], cache_bits: int, back: bool) -> list[list[tuple[int, int, int, int]]]:
    """Literals, cache hits and back-references, each as (code, symbol, extra bits, their number) parts."""
    out, seen, k = [], {}, 0
    cache: list[int | None] = [None] * (1 << cache_bits)
    while k < len(pixels):
        n, p = 1, pixels[k]
        key = tuple(pixels[k : k + 4])
        if back and key in seen:
            d, n = k - seen[key], 0
            while n < 4096 and k + n < len(pixels) and pixels[k + n] == pixels[k + n - d]:
                n += 1
            length, distance = prefix_parts(n), prefix_parts(d + 120)
            out.append([(0, 256 + length[0], length[1], length[2]), (4, distance[0], distance[1], distance[2])])
        elif cache_bits and cache[slot := (CACHE_FACTOR * p & 0xFFFFFFFF) >> 32 - cache_bits] == p:
            out.append([(0, GREEN + slot, 0, 0)])
        else:
            out.append([(0, p >> 8 & 255, 0, 0), (1, p >> 16 & 255, 0, 0), (2, p & 255, 0, 0), (3, p >> 24, 0, 0)])
        for q in range(k, k + n):
            if back and q + 4 <= len(pixels):
                seen[tuple(pixels[q : q + 4])] = q
            if cache_bits:
                cache[(CACHE_FACTOR * pixels[q] & 0xFFFFFFFF) >> 32 - cache_bits] = pixels[q]
        k += n
    return out


# --- transforms --------------------------------------------------------------------------------------------------


def split(argb: np.ndarray) -> np.ndarray:
    """Channels as n x 4 (blue, green, red, alpha)."""
    return np.ascontiguousarray(argb.astype("<u4")).view(np.uint8).reshape(*argb.shape, 4)


def merged(channels: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(channels).view("<u4").reshape(channels.shape[:-1])


def predict(mode: int, left: list[int], top: list[int], right: list[int], corner: list[int]) -> list[int]:
    """A pixel's prediction (4 channels) from its neighbours: left, top, top right, top left."""
    mean = lambda a, b: [x + y >> 1 for x, y in zip(a, b, strict=True)]
    clamp = lambda x: min(255, max(0, x))
    if mode in (0, 14, 15):
        return [0, 0, 0, 255]
    if mode <= 4:
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return mean(mean(left, right), top)
    if mode <= 9:
        return mean(*((left, corner), (left, top), (corner, top), (top, right))[mode - 6])
    if mode == 10:
        return mean(mean(left, corner), mean(top, right))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
        to_top = sum(abs(x - c) for x, c in zip(left, corner, strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return [clamp(x + t - c) for x, t, c in zip(left, top, corner, strict=True)]
    return [clamp(m + int((m - c) / 2)) for m, c in zip(mean(left, top), corner, strict=True)]


def predictor(argb: np.ndarray, width: int, modes: np.ndarray, bits: int, inverse: bool) -> np.ndarray:
    """Residuals of an image, or the image of residuals."""
    if len(set(modes.tolist())) == 1 and int(modes[0]) in (1, 2):
        return uniform(argb, width, int(modes[0]), inverse)
    src = split(argb).reshape(-1, width, 4).astype(int).tolist()
    out = [[None] * width for _ in src]
    known = out if inverse else src
    across = width + (1 << bits) - 1 >> bits
    for y, row in enumerate(src):
        for x, pixel in enumerate(row):
            if not y:
                guess = known[0][x - 1] if x else [0, 0, 0, 255]
            elif not x:
                guess = known[y - 1][0]
            else:
                up = known[y - 1]
                right = up[x + 1] if x + 1 < width else known[y][0]
                guess = predict(int(modes[(y >> bits) * across + (x >> bits)]), known[y][x - 1], up[x], right, up[x - 1])
            sign = 1 if inverse else -1
            out[y][x] = [p + sign * g & 255 for p, g in zip(pixel, guess, strict=True)]
    return merged(np.array(out, np.uint8)).ravel()


def uniform(argb: np.ndarray, width: int, mode: int, inverse: bool) -> np.ndarray:
    """predictor() where all blocks predict from the left (1) or from the top (2)."""
    c = split(argb).reshape(-1, width, 4)
    down = slice(0, 1) if mode == 1 else slice(None)  # columns that are predicted from the top
    if inverse:
        out = c.copy()
        out[0, 0, 3] = (int(out[0, 0, 3]) + 255) & 255
        if mode == 1:
            out[:, 0] = np.cumsum(out[:, 0], axis=0, dtype=np.uint8)
            out = np.cumsum(out, axis=1, dtype=np.uint8)
        else:
            out[0] = np.cumsum(out[0], axis=0, dtype=np.uint8)
            out = np.cumsum(out, axis=0, dtype=np.uint8)
        return merged(out).ravel()
    out = c.copy()
    out[:, 1:] -= c[:, :-1]
    out[1:, down] = c[1:, down] - c[:-1, down]
    out[0, 0, 3] = (int(out[0, 0, 3]) - 255) & 255
    return merged(out).ravel()


def cross_colour(argb: np.ndarray, width: int, elements: np.ndarray, bits: int, inverse: bool) -> np.ndarray:
    """elements: per block the factors green to red, green to blue, red to blue in blue, green, red."""
    c = split(argb).reshape(-1, width, 4)
    y, x = np.indices(c.shape[:2])
    across = width + (1 << bits) - 1 >> bits
    e = split(elements)[(y >> bits) * across + (x >> bits)].view(np.int8).astype(int)
    signed = lambda v: v.astype(np.uint8).view(np.int8).astype(int)
    blue, green, red = (c[..., k].astype(int) for k in range(3))
    sign = 1 if inverse else -1
    new_red = red + sign * (e[..., 0] * signed(green) >> 5) & 255
    base = new_red if inverse else red
    new_blue = blue + sign * ((e[..., 1] * signed(green) >> 5) + (e[..., 2] * signed(base) >> 5)) & 255
    return merged(np.stack([new_blue, green, new_red, c[..., 3]], -1).astype(np.uint8)).ravel()


def subtract_green(argb: np.ndarray, inverse: bool) -> np.ndarray:
    c = split(argb).copy()
    for k in (0, 2):
        c[:, k] = c[:, k] + c[:, 1] if inverse else c[:, k] - c[:, 1]
    return merged(c).ravel()


def bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


# --- files -------------------------------------------------------------------------------------------------------


def encode(argb: np.ndarray, width: int, transforms: tuple[int, ...] = (), cache_bits: int = 0, back: bool = False, block: int = 3, seed: int = 0, mode: int | None = None) -> bytes:
    """A lossless WebP file. transforms are applied in the given order; seed picks predictor modes (if no mode is given) and colour factors."""
    w = Writer()
    height = len(argb) // width
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 1)
    w.put(0, 3)
    rng = np.random.default_rng(seed)
    for kind in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        if kind == SUBTRACT:
            argb = subtract_green(argb, False)
        elif kind == PALETTE:
            colours, index = np.unique(argb, return_inverse=True)
            if len(colours) > 256:
                raise ValueError("a palette has at most 256 colours")
            c = split(colours)
            w.put(len(colours) - 1, 8)
            write_pixels(w, merged(np.concatenate([c[:1], c[1:] - c[:-1]])).ravel(), len(colours), False)
            bits = bundle_bits(len(colours))
            per, each = 1 << bits, 8 >> bits
            rows = index.reshape(height, width)
            rows = np.pad(rows, ((0, 0), (0, -width % per))).reshape(height, -1, per)
            argb = ((rows << (np.arange(per) * each)).sum(axis=2).ravel().astype(np.uint32) << np.uint32(8)) | np.uint32(0xFF000000)
            width = -(-width // per)
        else:
            across = width + (1 << block) - 1 >> block
            cells = across * (height + (1 << block) - 1 >> block)
            w.put(block - 2, 3)
            if kind == PREDICTOR:
                modes = rng.integers(0, 14, cells) if mode is None else np.full(cells, mode)
                write_pixels(w, (modes.astype(np.uint32) << np.uint32(8)) | np.uint32(0xFF000000), across, False)
                argb = predictor(argb, width, modes, block, False)
            else:
                factors = rng.integers(0, 1 << 24, cells).astype(np.uint32) | np.uint32(0xFF000000)
                write_pixels(w, factors, across, False)
                argb = cross_colour(argb, width, factors, block, False)
    w.put(0, 1)
    write_pixels(w, argb, width, True, cache_bits, back)
    return wrapped(w)


def wrapped(w: Writer) -> bytes:
    """The file around an image's bits."""
    body = b"\x2f" + w.bytes()
    chunk = b"VP8L" + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) & 1)
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def repeats(samples: np.ndarray, least: int = 32) -> list[tuple[int, int, int]]:
    """Places, lengths and distances of stretches of `least` samples or more that stand earlier, in order, without overlaps.

    Windows are told by their values in 64 bits each. Those with three zero bits are anchors, an eighth of all, and every 64th; one sort finds the last
    place before with the same anchor, and the stretch is followed in both directions from there.
    """
    n = len(samples) - least + 1
    if n < 2:
        return []
    x = samples.astype(np.uint64)
    span = 1
    with np.errstate(over="ignore"):
        while span < least:
            x = x[: len(x) - span] * np.uint64(0x9E3779B97F4A7C15) + (x[span:] ^ x[span:] >> np.uint64(29)) * np.uint64(span * 2 + 1)
            span *= 2
    anchor = x & np.uint64(7) == 0
    anchor[::64] = True  # short periods may have no other
    anchors = np.flatnonzero(anchor)
    x = x[anchors]
    order = np.argsort(x, kind="stable")
    same = np.flatnonzero(x[order[1:]] == x[order[:-1]])
    if not len(same):
        return []
    before = np.full(len(x), -1, np.int64)
    before[order[same + 1]] = anchors[order[same]]
    places, before = anchors[before >= 0], before[before >= 0]
    out, k, done = [], 0, 0
    while k < len(places):
        at = int(places[k])
        d = at - int(before[k])
        back = min(256, at - done, at - d)
        differ = samples[at - back : at] != samples[at - d - back : at - d]
        at -= int(differ[::-1].argmax()) if differ.any() else back
        most = min(4096, len(samples) - at)
        differ = samples[at : at + most] != samples[at - d : at - d + most]
        size = int(differ.argmax()) if differ.any() else most
        if size >= least:
            out.append((at, size, d))
            done = at + size
            k = int(np.searchsorted(places, done))
        else:
            k += 1
    return out


def encode_repeats(samples: np.ndarray, width: int, found: list[tuple[int, int, int]]) -> bytes:
    """A file whose green samples are literals and back-references."""
    w = Writer()
    w.put(width - 1, 14)
    w.put(len(samples) // width - 1, 14)
    w.put(1, 1)
    w.put(0, 3)
    w.put(0, 1)  # no transform, no colour cache, one group of prefix codes
    w.put(0, 1)
    w.put(0, 1)
    kept = np.ones(len(samples), bool)
    for at, size, _ in found:
        kept[at : at + size] = False
    lengths, distances = [prefix_parts(n) for _, n, _ in found], [prefix_parts(d + 120) for _, _, d in found]
    counts = np.bincount(samples[kept], minlength=GREEN)
    np.add.at(counts, [256 + p[0] for p in lengths], 1)
    green = code_lengths(counts)
    far = code_lengths(np.bincount([p[0] for p in distances], minlength=DISTANCE))
    write_code(w, green)
    for symbol in (0, 0, 255):
        write_single(w, symbol)
    write_code(w, far)
    words, far_words = canonical(green), canonical(far)
    single = len(np.flatnonzero(far)) == 1
    # each part of a back-reference is a symbol of its own behind the 256 literals, so that all bits come from one table
    parts, at, more, sizes = [], 0, [], []
    for place, n, _ in found:
        parts += [samples[at:place], np.arange(256 + len(more), 260 + len(more))]
        k = len(more) // 4
        p, q = lengths[k], distances[k]
        more += [int(words[256 + p[0]]), p[1], 0 if single else int(far_words[q[0]]), q[1]]
        sizes += [int(green[256 + p[0]]), p[2], 0 if single else int(far[q[0]]), q[2]]
        at = place + n
    parts.append(samples[at:])
    w.put_symbols(np.concatenate(parts).astype(np.int64), np.concatenate([words[:256], np.array(more, np.int64)]), np.concatenate([green[:256], np.array(sizes, np.int64)]))
    return wrapped(w)


def encode_literals(samples: np.ndarray, width: int) -> bytes:
    """A file whose green samples are literals; as encode() writes it."""
    w = Writer()
    w.put(width - 1, 14)
    w.put(len(samples) // width - 1, 14)
    w.put(1, 1)
    w.put(0, 3)
    w.put(0, 3)  # no transform, no colour cache, one group of prefix codes
    green = code_lengths(np.bincount(samples, minlength=GREEN))
    write_code(w, green)
    for symbol in (0, 0, 255, 0):
        write_single(w, symbol)
    if np.count_nonzero(green) > 1:
        w.put_symbols(samples, canonical(green), green)
    return wrapped(w)


def bits_of(values: np.ndarray) -> float:
    """Bits of values by their entropy; a prefix code takes a bit a value at least, unless they are all the same."""
    counts = np.bincount(values)
    counts = counts[counts > 0]
    return max(float((counts * np.log2(len(values) / counts)).sum()), float(len(values) * (len(counts) > 1)))


def encode_samples(samples: np.ndarray, width: int) -> bytes:
    """The smallest, by estimate, of some lossless files of 8-bit samples: literals, a palette with bundled pixels, prediction from the
    top or the left, or back-references to stretches that stand earlier. Literals are read fastest, so that the others
    must save one bit in PAYS of theirs. Equal samples give equal files."""
    plain, rows = bits_of(samples), samples.reshape(-1, width)
    ways: list[tuple[float, int]] = [(plain, 0)]
    values = int(np.count_nonzero(np.bincount(samples, minlength=256)))
    if 1 < values <= 16:
        per, each = 1 << bundle_bits(values), 8 >> bundle_bits(values)
        index = np.unique(samples, return_inverse=True)[1].reshape(-1, width // per, per)
        ways.append((bits_of((index << (np.arange(per) * each)).sum(axis=2).ravel()) + 8 * values + 40, 1))
    if values > 1 and len(rows) > 1:
        ways.append((bits_of((rows[1:] - rows[:-1]).ravel()) + 8 * width + 60, 2))
        ways.append((bits_of((rows[:, 1:] - rows[:, :-1]).ravel()) + 8 * len(rows) + 60, 3))
    found = repeats(samples) if values > 1 else []
    if found:
        kept = len(samples) - sum(n for _, n, _ in found)
        ways.append((plain * kept / len(samples) + 32.0 * len(found) + 120, 4))
    best, way = min(ways)
    way = way if best < plain - plain / PAYS else 0
    if way == 4:
        return encode_repeats(samples, width, found)
    if not way:
        return encode_literals(samples, width)
    argb = samples.astype(np.uint32) << np.uint32(8) | np.uint32(0xFF000000)
    if way >= 2:
        return encode(argb, width, (PREDICTOR,), block=9, mode=2 if way == 2 else 1)
    return encode(argb, width, (PALETTE,))


def decode(data: bytes) -> tuple[np.ndarray, int, int]:
    """Pixels (height x width, ARGB in 32 bits) of the file at the start of data, its width, and the file's length."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L" or data[20] != 0x2F:
        raise ValueError("not a lossless WebP file")
    r = Reader(data[21 : 20 + int.from_bytes(data[16:20], "little")])
    width, height = r.read(14) + 1, r.read(14) + 1
    r.read(1)
    if r.read(3):
        raise ValueError("unknown version")
    full, undo = width, []
    while r.read(1):
        kind = r.read(2)
        if kind == SUBTRACT:
            undo.append((kind, width, None, 0))
        elif kind == PALETTE:
            n = r.read(8) + 1
            colours = split(read_pixels(r, n, 1, False)).astype(np.int64).cumsum(axis=0).astype(np.uint8)
            undo.append((kind, width, merged(colours).ravel(), bundle_bits(n)))
            width = width + (1 << bundle_bits(n)) - 1 >> bundle_bits(n)
        else:
            bits = r.read(3) + 2
            cells = read_pixels(r, width + (1 << bits) - 1 >> bits, height + (1 << bits) - 1 >> bits, False)
            undo.append((kind, width, cells, bits))
    argb = read_pixels(r, width, height, True)
    for kind, w, extra, bits in reversed(undo):
        if kind == SUBTRACT:
            argb = subtract_green(argb, True)
        elif kind == PALETTE:
            per, each = 1 << bits, 8 >> bits
            index = ((argb >> np.uint32(8) & np.uint32(255)).reshape(height, -1, 1) >> (np.arange(per) * each).astype(np.uint32)) & np.uint32((1 << each) - 1)
            index = index.reshape(height, -1)[:, :w].ravel()
            argb = np.where(index < len(extra), extra[np.minimum(index, len(extra) - 1)], 0).astype(np.uint32)
        elif kind == PREDICTOR:
            argb = predictor(argb, w, extra >> np.uint32(8) & np.uint32(15), bits, True)
        else:
            argb = cross_colour(argb, w, extra, bits, True)
    size = 8 + int.from_bytes(data[4:8], "little")
    return argb.reshape(height, full), full, size


# --- media columns -----------------------------------------------------------------------------------------------


def payload_of(text: str | None) -> bytes:
    b = (text or "").encode()
    return b + b"\0" * (-len(b) % 64 if b else 64)


def to_media(payload: bytes) -> bytes:
    out = []
    for at in range(0, len(payload), WIDTH * ROWS):
        out.append(encode_samples(np.frombuffer(payload[at : at + WIDTH * ROWS], np.uint8), WIDTH))
    return b"".join(out)


def from_media(media: bytes) -> np.ndarray:
    out, at = [], 0
    while at < len(media):
        pixels, _, size = decode(media[at:] if at else media)
        out.append((pixels >> np.uint32(8) & np.uint32(255)).astype(np.uint8).ravel())
        at += size
    return np.concatenate(out)


def feature(samples: np.ndarray) -> str:
    """Mean, deviation and number of values of the samples, and an 8 x 8 average hash of the picture."""
    counts = np.bincount(samples, minlength=256)
    mean = float(counts @ np.arange(256)) / len(samples)
    dev = (float(counts @ np.arange(256) ** 2) / len(samples) - mean * mean) ** 0.5
    rows = samples.reshape(-1, 8, WIDTH // 8).sum(axis=2)
    edges = np.arange(9) * len(rows) // 8
    sums = np.concatenate([np.zeros((1, 8), np.int64), rows.cumsum(axis=0, dtype=np.int64)])[edges]
    cells = (sums[1:] - sums[:-1]) > mean * (WIDTH // 8) * (edges[1:] - edges[:-1])[:, None]
    bits = int("".join(map(str, cells.astype(int).ravel().tolist())), 2)
    return f"mean={mean:.4f};dev={dev:.4f};values={int(np.count_nonzero(counts))};ahash={bits:016x}"


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (of the text), media (binary) for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([to_media(payload_of(t)) for t in texts], pa.binary())], ["id", "n_bytes", "media"]
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}, n_bytes bigint, media binary")


def read_media(stored: DataFrame) -> DataFrame:
    """stored: id, n_bytes, media. The stored bytes are read back: digests of payload and media, and a feature."""
    names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [None, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for key, n, media in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                samples = from_media(media)
                payload = samples.tobytes()
                rows.append(
                    (key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples))
                )
            cols = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k or b.column(0).type) for c, k in zip(cols, kinds, strict=True)], names)

    kind = stored.schema["id"].dataType.simpleString()
    return stored.select("id", "n_bytes", "media").mapInArrow(
        run, f"id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    )
