"""The prefix trie against a plain trie in Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docledger.llm.prefix_trie import Minima, SmallestOf, branched, common_prefixes, prefix_trie, sequences

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    parents = {p[:-1] for p in members if p}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].split()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(m) if seqs[c] == p)
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), sum(q[:-1] == p for q in members if q), sum(q not in parents for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, parts=3):
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", own string, part int").repartition(parts)
    return sorted(map(tuple, prefix_trie(branched(sequences(turns), F.col("conv_id") - F.col("conv_id") % 20, head)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_a_plain_trie(spark, seed):
    rnd = random.Random(seed)
    rows = [(c, t, rnd.choice(["user", "bot", None]), rnd.choice(["a b", "c", "", None, "d\te f"])) for c in range(120) for t in range(rnd.randint(1, 7))]
    rows += [(c, None, "system", "be kind") for c in range(0, 120, 3)] + rows[:40]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that ranges stay small and nodes reach over borders
    try:
        assert trie(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_odd_rows(spark):
    rows = [(None, 1, "user", "no id"), (40, None, None, None), (41, 2, "user", ""), (41, 2, "user", ""), (2**40, 1, "user", "far"), (61, 1, "user", "no base")]
    assert trie(spark, rows) == brute(rows)
    assert trie(spark, []) == []


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(3)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = trie(spark, rows, 8)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ends = hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert [r[:7] for r in found if r[1] == 3] == [(0, 3, 0, 3000, 0, 1, 2999 * 2)]
    assert [r[7] for r in found if r[1] == 3] == [ends] and len(found) == 4


def test_extents_and_minima():
    rnd = np.random.default_rng(4)
    lcp, ids = rnd.integers(0, 5, 200), rnd.integers(0, 1000, 200)
    minima, smallest = Minima(lcp), SmallestOf(ids)
    rows, depth = np.arange(200), rnd.integers(0, 5, 200)
    for i, d, a, b in zip(rows, depth, minima.left(rows, depth), minima.right(rows, depth), strict=True):
        assert (lcp[a + 1 : b + 1] >= d).all() and (a == 0 or lcp[a] < d) and (b == 199 or lcp[b + 1] < d) and a <= i <= b
        assert smallest(np.array([a]), np.array([b]))[0] == ids[a : b + 1].min()
    keys = np.array([[1, 1], [2, 2], [1, 1], [2, 2], [3, 3], [1, 1], [9, 9]])
    assert common_prefixes(keys, np.array([2, 5, 5, 7])).tolist() == [0, 2, 0, 0]
