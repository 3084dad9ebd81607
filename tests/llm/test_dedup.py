"""Exact dedup, n-gram join and substring dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docledger.llm import exact_dedup as E
from docledger.llm import hashing as H
from docledger.llm import ngram_join as N
from docledger.llm import substring as S
from docledger.llm.graph import components

from .conftest import ODD, WORDS, table


def key(i):
    return (i is not None, i or 0)


def test_exact(odd, none):
    got = [r.asDict() for r in E.exact_dedup(odd).collect()]
    groups = defaultdict(list)
    for i, t, _ in ODD:
        groups[t or ""].append(i)
    assert len(got) == len(ODD)
    by_digest = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_digest[bytes(r["digest"])]
        assert r["keep_id"] == max(ids, key=key) and r["group_size"] == len(ids)
    kept = Counter(bytes(r["digest"]) for r in got if r["kept"])
    assert kept == {d: 1 for d in by_digest}
    assert all(r["id"] == r["keep_id"] for r in got if r["kept"])
    assert E.exact_dedup(none).collect() == []


def test_exact_stage_keeps_columns(odd, none):
    out = E.keep_first(odd)
    assert out.columns == odd.columns
    assert sorted(r["text"] or "" for r in out.collect()) == sorted({t or "" for _, t, _ in ODD})
    assert E.keep_first(none).collect() == []


def test_exact_collision(spark, monkeypatch):
    """With a digest that collides, texts are still told apart."""
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "b")]
    docs = table(spark, rows)
    found = spark.createDataFrame([(b"x" * 32, i, 1, 5, 5) for i, _ in rows], "digest binary, id bigint, copies bigint, keep_id bigint, group_size bigint")
    # all five under one digest, as a colliding digest would have it
    monkeypatch.setattr(E.F, "sha2", lambda c, n: F.lit("78" * 32))
    differ = E._differing(docs, found, "doc_id", "text")
    assert differ.count() == 1
    out = {r["id"]: (r["keep_id"], r["group_size"]) for r in E._regrouped(docs, found, differ, "doc_id", "text").collect()}
    assert out == {1: (2, 2), 2: (2, 2), 3: (5, 2), 4: (4, 1), 5: (5, 2)}


def test_index_lookup(spark):
    index = E.DigestIndex(spark)
    index.add(table(spark, [(1, "a"), (2, "a"), (3, "b")]))
    index.add(table(spark, [(4, "c")]))
    hits = index.lookup(table(spark, [(10, "a"), (11, "z"), (12, "c")]))
    assert {(r["id"], r["min_id"]) for r in hits.collect()} == {(10, 1), (12, 4)}


def test_word_hashes():
    texts = [b"a b  a", b"", b" \t", "é a\nb".encode(), b"abc"]
    h, at = H.word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert len(h) == len(words) == at[-1]
    seen = {}
    for w, x in zip(words, h, strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    w = H.windows(h[:3], 2)
    assert len(w) == 2 and len(H.windows(h[:1], 2)) == 0
    assert (H.windows(np.concatenate([h[3:], h[:3]]), 2)[-2:] == w).all()


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in linked}


def brute_join(rows, n, num, den):
    sets, parent = {}, {}
    for i, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids, links = sorted(sets), Counter()
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = sorted((find(ids[a]), find(ids[b])))
                parent[q] = p
    distinct = set(sets.values())
    for x in distinct:
        for y in distinct:
            if x != y and x and y and den * len(x & y) >= num * len(x | y):
                links[x] += 1
    return {i: (len(sets[i]), find(i), links[sets[i]]) for i in ids}


def near_copies(seed, n=140):
    """Texts of 0 to 90 words in families of copies with few changes."""
    random.seed(seed)
    rows, base = [], []
    for i in range(n):
        if i % 7 == 0:
            base = [random.choice(WORDS) + random.choice("abc") for _ in range(random.choice([0, 1, 3, 8, 11, 14, 20, 40, 90]))]
        words = list(base)
        for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
            if words:
                words[random.randrange(len(words))] = random.choice(WORDS)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("n", "num", "tile"), [(3, 90, 512), (5, 80, 4), (2, 80, 3)])
def test_ngram_join(spark, n, num, tile):
    rows = near_copies(n)
    got = {r["id"]: (r["n_grams"], r["component"], r["n_links"]) for r in N.ngram_join(table(spark, rows), n, num, 100, tile=tile).collect()}
    want = brute_join(rows, n, num, 100)
    assert got == want
    assert len({c for _, c, _ in want.values()}) < len(rows) - 20 and max(k for *_, k in want.values()) > 1


def test_ngram_rows_without_or_with_equal_ids(spark):
    """Links of rows whose ids are null or stand for several texts aren't lost."""
    base = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]
    rows = [(None, " ".join(base)), (None, " ".join(other)), (5, " ".join(base[:59])), (5, " ".join(other[:59])), (7, " ".join(base[1:]))]
    got = N.ngram_join(table(spark, rows), 3, 90).collect()
    assert sorted((r["n_grams"], r["n_links"]) for r in got) == [(57, 1), (57, 2), (57, 2), (58, 1), (58, 2)]
    assert {r["component"] for r in got} == {5}


def test_ngram_odd_rows(odd, none):
    got = N.ngram_join(odd, 3, 90).collect()
    assert len(got) == len(ODD)
    by = defaultdict(set)
    for r in got:
        by[r["id"]].add((r["n_grams"], r["component"]))
    assert by[6] == by[7] == by[8] == by[13] == {(1, 6)} and by[1] == {(0, 1)} and by[3] == {(0, 3)} and by[10] == {(1, 10)}
    assert N.ngram_join(none).collect() == []
    kept = N.keep_smallest(odd, n=3, num=90)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _, _ in ODD} - {7, 8, 13}


def test_levels_cover_all_links():
    """A link's sets always share a level, in which more segments are wanted than the sets can differ by."""
    for num in (80, 90):
        levels = N.Levels(num, 100)
        for a in range(1, 400):
            for b in range(a, a * 100 // num + 1):
                d = a + b - 2 * -(-(a + b) * num // (100 + num))
                if d < 0 or 100 * ((a + b - d) // 2) < num * ((a + b + d) // 2):
                    continue
                shared = set(levels.of(a)) & set(levels.of(b))
                assert d == 0 or any(levels.differ(min(a, levels.bounds[k + 1] - 1)) >= d and levels.differ(min(b, levels.bounds[k + 1] - 1)) >= d for k in shared), (a, b, d)


def test_parities_and_segments_keep_links():
    """Linked sets share a segment in some cut that one of them asks for, and their parities let them pass."""
    rng = np.random.default_rng(5)
    for num in (80, 90):
        levels, turns, small = N.Levels(num, 100), 0, 0
        for _ in range(1500):
            n = int(rng.choice([4, 5, 7, 10, 14, 25, 60, 300]))
            base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64))
            lose, more = int(rng.integers(0, 1 + n // 8)), int(rng.integers(0, 1 + n // 8))
            other = np.unique(np.concatenate([base[lose:], rng.integers(0, 1 << 63, more, dtype=np.int64).astype(np.uint64)]))
            i = len(np.intersect1d(base, other))
            if 100 * i < num * (len(base) + len(other) - i) or i == len(base) == len(other):
                continue
            asked = {c for x in (base, other) for c in N.cuts_wanted(x, levels)}
            turns += bool(asked)
            small += 1
            shared = set(levels.of(len(base))) & set(levels.of(len(other)))
            keys = [{int(k) for level in shared for t in (0, *[c % N.CUTS for c in asked if c // N.CUTS == level]) for k in N.segments(x, level, levels, t)[0]} for x in (base, other)]
            assert keys[0] & keys[1]
            bits = [N.parities(x, levels.width(levels.of(len(x))[-1])) for x in (base, other)]
            assert N.near_forest(np.array([len(base), len(other)]), bits, num, 100) == [(0, 1)]
        assert small > 200 and turns


def test_overlaps_are_sums_of_fragments():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 400, int(rng.integers(0, 200))).astype(np.uint64) * np.uint64(1 << 55)) for _ in range(30)]
    whole = N.overlaps(sets[:12], sets[12:])
    cut = np.array([np.uint64(1 << 62), np.uint64(1 << 63)])
    parts = [[np.split(x, np.searchsorted(x, cut))[k] for x in sets] for k in range(3)]
    assert (whole == sum(N.overlaps(p[:12], p[12:]) for p in parts)).all()
    assert whole.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    for counts in (whole, whole * 300, whole * 100_000):
        assert (N.unpacked(N.packed(counts), counts.size) == counts.ravel()).all()


def test_ngram_join_large_group_and_passages(spark):
    """A group of near copies over several blocks, and texts that share a long passage only."""
    random.seed(12)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(random.choice([0, 1, 1, 2])):
            words[random.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    passage = [f"p{k}" for k in range(60)]
    rows += [(100 + i, " ".join(passage + [f"y{i}-{k}" for k in range(40)])) for i in range(40)]
    got = {r["id"]: (r["n_grams"], r["component"], r["n_links"]) for r in N.ngram_join(table(spark, rows), 3, 90, 100, tile=16, fragments=3).collect()}
    assert got == brute_join(rows, 3, 90, 100)
    assert max(k for *_, k in got.values()) > 20 and all(got[100 + i][1] == 100 + i for i in range(40))


def brute_substring(rows, n):
    seen, out = {}, {}
    order = sorted(rows, key=lambda r: r[0])
    for i, t in order:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            x = tuple(w[k : k + n])
            if x in seen:
                gone[k : k + n] = [True] * n
            else:
                seen[x] = i
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def passages(seed, n=120):
    random.seed(seed)
    shared = [[random.choice(WORDS) for _ in range(random.choice([6, 20, 25, 60]))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(random.randrange(5)):
            words += random.choice(shared) if random.random() < 0.5 else [random.choice(WORDS) for _ in range(random.randrange(30))]
        rows.append((i, " ".join(words)))
    rows.append((n, " ".join(rows[5][1].split() * 3)))
    return rows


@pytest.mark.parametrize("n", [1, 3, 8, 20])
def test_substring(spark, n):
    rows = passages(n)
    got = {r["id"]: tuple(r)[1:] for r in S.substring_dedup(table(spark, rows), n, with_text=True).collect()}
    want = brute_substring(rows, n)
    assert {i: v[:3] for i, v in got.items()} == {i: v[:3] for i, v in want.items()}
    assert all(got[i][3] == (want[i][3] if want[i][1] else None) for i in want)
    assert sum(v[1] for v in want.values()) > 100


def test_substring_odd_rows(odd, none):
    got = S.substring_dedup(odd, 3).collect()
    assert len(got) == len(ODD)
    by = {r["id"]: r for r in got}
    assert by[1]["n_words"] == 0 and by[10]["n_removed"] == 29_999 + 0 * 1
    assert by[6]["n_removed"] == 0 and by[7]["n_removed"] == 3 and by[8]["n_removed"] == 0
    assert S.substring_dedup(none).collect() == []


def test_substring_stage(odd, spark, none):
    rows = passages(5)
    docs = table(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in S.remove_repeats(docs).collect()}
    want = brute_substring(rows, 20)
    for i, t in rows:
        text = want[i][3] if want[i][1] else t
        assert got[i] == (text, len(text))
    out = S.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    assert S.remove_repeats(none).collect() == []
