"""The suffix array against a brute-force version on random texts with planted copies."""

import hashlib
import random

import numpy as np
import pytest

from docledger.llm import suffix_array
from docledger.llm.suffix_array import FAR, Repeats, Sorter, inner, merged, minimizers, sieved, suffix_dedup

from .conftest import table


def brute(rows, length):
    first = {}
    order = [(FAR if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in order:
        for a in range(len(t) - length + 1):
            first[t[a : a + length]] = min((i, a), first.get(t[a : a + length], (FAR + 1, 0)))
    out = []
    for (key, _), (i, t) in zip(rows, order, strict=True):
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if first[t[a : a + length]] < (i, a):
                gone[a : a + length] = b"\1" * length
        spans = sum(1 for z in range(len(t)) if gone[z] and not (z and gone[z - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, rows = [text(rnd.randint(0, 300)) for _ in range(8)], []
    for i in range(40):
        t = rnd.choice(base)
        if rnd.random() < 0.7:
            a, b = sorted((rnd.randint(0, len(t)), rnd.randint(0, len(t))))
            t = text(rnd.randint(0, 8)) + t[a:b] + text(rnd.randint(0, 30))
        elif rnd.random() < 0.3:
            t = "".join(c if rnd.random() > 0.01 else "é" for c in t)
        rows.append((i, t))
    odd = [(100, "a" * 500), (101, "ab" * 300), (102, "a" * 120 + "b" * 130), (103, None), (104, ""), (105, base[3] + base[3]), (7, base[1]), (7, base[1]), (106, "\0" * 300), (107, "x\0" * 90)]
    return rows + odd + [(None, base[0]), (None, base[1] + "end")]


@pytest.mark.parametrize(("length", "gram", "shard"), [(100, 40, 1 << 12), (30, 8, 700), (12, 5, 300), (5, 3, 300)])
def test_agrees_with_brute_force(spark, monkeypatch, length, gram, shard):
    monkeypatch.setattr(suffix_array, "SHARD", shard)
    rows = corpus(length)
    found = suffix_dedup(table(spark, rows), length, gram=gram).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, length)


def test_a_text_has_one_row_however_many_ranges_hold_its_strings(spark, monkeypatch):
    monkeypatch.setattr(suffix_array, "SHARD", 300)
    op = Repeats(table(spark, corpus(3)[:40]), 30, "doc_id", "text", 8)
    sorter = Sorter(sieved(op.shards(op.marks()), 30, 8), 30)
    assert len(sorter.bounds) > 3
    found = sorter.repeated()
    assert 0 < found.count() == found.select("doc", "tag").distinct().count()  # a row for each range and text before


def test_odd_rows(spark, odd, none):
    found = suffix_dedup(odd)
    assert found.count() == odd.count()
    long = {r["id"]: r for r in found.collect()}[11]
    assert (long["n_bytes"], long["n_removed"], long["n_spans"]) == (50_000, 49_999, 1)
    assert suffix_dedup(none).collect() == []


def test_kept_bytes(spark):
    rows = [(1, "x" + "0123456789" * 3), (2, "é" + "0123456789" * 3 + "tail")]
    found = {r["id"]: bytes(r["kept"]) for r in suffix_dedup(table(spark, rows), 30, with_text=True).collect()}
    assert found == {1: rows[0][1].encode(), 2: "é".encode() + b"tail"}


def test_one_hot_string_in_many_contexts(spark):
    rnd = random.Random(5)
    hot = "".join(rnd.choice("abcdefgh") for _ in range(150))
    rows = [(i, "".join(rnd.choice("ijklmn") for _ in range(40)) + hot + "".join(rnd.choice("opqrst") for _ in range(40))) for i in range(1500)]
    assert sorted(map(tuple, suffix_dedup(table(spark, rows)).collect()), key=str) == brute(rows, 100)


def test_equal_strings_have_one_minimizer_across_stretches(monkeypatch):
    rnd = random.Random(2)
    text = "".join(rnd.choice("ab") for _ in range(300)).encode()
    data = np.frombuffer(text * 3 + b"aaaa" * 40 + text, np.uint8)
    part, _ = inner(data, 30, 8)
    monkeypatch.setattr(suffix_array, "AT", 7)
    place = np.concatenate([p for _, p, _ in minimizers(data, 30, 8)]) - np.arange(len(data) - 29)
    seen = {}
    for i, k in enumerate(zip(place.tolist(), part.tolist(), strict=True)):
        assert seen.setdefault(data[i : i + 30].tobytes(), k) == k


def test_merged_is_the_order_of_suffixes():
    rnd = random.Random(9)
    text = "".join(rnd.choice("ab") for _ in range(60)) + "\0\0\0"
    n = 60
    rank = {p: k + 1 for k, p in enumerate(sorted((p for p in range(n + 3) if p % 3), key=lambda p: text[p:]))}
    at = np.arange(n)
    c = np.array([ord(text[p]) for p in at])
    c1 = np.array([ord(text[p + 1]) for p in at])
    a = np.array([rank.get(p if p % 3 else p + 1, 0) for p in at])
    b = np.array([rank.get(p + 1 if p % 3 == 1 else p + 2, 0) for p in at])
    order = np.argsort(merged(c, c1, a, b, at % 3))
    assert order.tolist() == sorted(range(n), key=lambda p: text[p:])
