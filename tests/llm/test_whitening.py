"""Whitening against numpy on plain arrays, and exact sums against Python's integers."""

import math

import numpy as np
import pytest

from docledger.llm.whitening import packed, scatter, unpacked, whiten

SCHEMA = "vec_id bigint, embedding array<float>, id int, x string, n bigint"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=4):
    keep = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in keep}))
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:k]
    out = []
    for i, x in keep:
        deviation = sum((n * a - int(b)) ** 2 for a, b in zip(x, s, strict=True))
        w = (np.array(x) - s / n) @ axes[:, order] / np.sqrt(values[order])
        out += [(i, c + 1, n, deviation, w[c], values[order[c]] / values.sum()) for c in range(k)]
    return out


def test_agrees_with_numpy(spark):
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(400, 12)) * np.linspace(0.05, 0.6, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist()) for i in range(300)]
    rows += [(1, None), (2, [1.0] * 11 + [None]), (3, [float("nan")] * 12), (4, [float("inf")] + [0.0] * 11), (None, base[1].tolist())]
    found = sorted((tuple(r) for r in whiten(frame(spark, rows)).collect()), key=lambda r: (str(r[0]), r[1]))
    want = sorted(brute(rows), key=lambda r: (str(r[0]), r[1]))
    assert [r[:4] for r in found] == [r[:4] for r in want]
    sign = {c: np.sign(next(w[4] / f[4] for f, w in zip(found, want, strict=True) if f[1] == c)) for c in range(1, 5)}
    for f, w in zip(found, want, strict=True):
        assert f[4] * sign[f[1]] == pytest.approx(w[4], abs=1e-9) and f[5] == pytest.approx(w[5], rel=1e-9)
    assert len({r[6] for r in found}) == 1 and found[0][6] < 1e-9


def test_scatter_is_exact():
    rnd = np.random.default_rng(2)
    for low, high, n in ((-150, 150, 1000), (0, 1, 63), (5, 6, 65), (-(1 << 61), 1 << 61, 70)):
        x = rnd.integers(low, high, (n, 5))
        sums, cross = scatter(x)
        whole = x.astype(object)
        assert (sums == whole.sum(axis=0)).all() and (cross == whole.T @ whole).all()


def test_packed_round_trip():
    for values in ([0], [-128, 127], [128, 0], [40000, -3], [1 << 40, 1]):
        assert unpacked([packed(np.array(values))]).tolist() == [values]


def test_odd_rows(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [(1, None), (2, []), (3, [None])])).collect() == []
    one = whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])]))  # no variance, no component
    assert one.collect() == [] and one.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = whiten(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 2.0, 3.0])])).collect()
    assert sorted((r["id"], r["component"], r["n"], r["deviation"], abs(r["whitened"])) for r in line) == [(1, 1, 2, 256**2, 1.0), (2, 1, 2, 256**2, 1.0), (2, 1, 2, 256**2, 1.0)]
    wide = whiten(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])).collect()
    assert {r["id"]: r["deviation"] for r in wide} == {1: None, 2: None, 3: 9 * 256**2}
