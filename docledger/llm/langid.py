"""Language identification: averaged hashed subword embeddings with a linear softmax.

Features of a text are the byte n-grams (2 to 5 bytes) of its words, each word with a space at both ends, hashed into
2^bits buckets; no n-gram reaches over two words. A text is the mean of its n-grams' embedding vectors, and a linear layer
with softmax gives class probabilities. Embeddings and layer are trained together by stochastic gradient descent in
numpy on a bounded sample of labelled rows. For prediction, embedding times layer is folded into one table of scores for
each bucket, which tasks receive with the closure (2^bits * classes floats, a size fixed by parameters).

Calibration: a part of the sample is held back from training; a temperature is fitted on it. A prediction is rejected
(class `und`) if the text has no letters, or if its calibrated score is below the `reject_below` quantile of the held-back
scores of right predictions and below even odds.

The sample: about `sample` rows with a label and a text, chosen by a hash of the id, so that it doesn't depend on how the
table is partitioned. Prediction reads every text whole.

Defined results: a null text or one without letters is `und` with score 1. Rows with a null label are predicted, never
learned from. Repeated rows get equal results. With no labelled row every text is `und`. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices

ORDERS = (2, 3, 4, 5)
#: ASCII letters to lower case; digits and ASCII marks to spaces. Bytes of other characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def buckets(text: str, bits: int) -> np.ndarray:
    """Hashed n-grams of a text's words, one entry per occurrence."""
    line = b" %s " % b" ".join(text.lower().encode().translate(FOLD).split())
    b = np.frombuffer(line, np.uint8)
    gap = b == 32
    out = []
    h = np.zeros(len(b), np.uint32)
    for n in range(1, ORDERS[-1] + 1):
        m = len(b) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(16777619) ^ (b[n - 1 :].astype(np.uint32) + np.uint32(1))
        if n in ORDERS:
            inner = np.zeros(m, bool)
            for k in range(1, n - 1):
                inner |= gap[k : k + m]
            x = h[~inner] * np.uint32(2654435761)
            out.append(x >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    classes: list[str]
    table: np.ndarray  # buckets x classes: embedding times layer
    bias: np.ndarray
    temperature: float
    floor: float
    bits: int

    def logits(self, text: str) -> np.ndarray:
        x = buckets(text, self.bits)
        return self.bias + (self.table[x].mean(axis=0) if len(x) else 0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Class, calibrated score, rejected."""
        if not self.classes or not text or not any(map(str.isalpha, text)):
            return "und", 1.0, True
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.classes[k], float(p[k]), bool(p[k] < self.floor)


def train(
    rows: list[tuple[str, str]], bits: int = 15, dim: int = 16, epochs: int = 12, rate: float = 20.0, reject_below: float = 0.001, seed: int = 7
) -> Model:
    """rows: (text, label). Every eighth row calibrates and isn't trained on."""
    classes = sorted({label for _, label in rows})
    if not classes:
        return Model([], np.zeros((0, 0)), np.zeros(0), 1.0, 0.0, bits)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, len(classes)), np.float32), np.zeros(len(classes), np.float32)
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    feats = []
    for text, label in rows:
        x, n = np.unique(buckets(text, bits), return_counts=True)
        if len(x):
            feats.append((x, (n / n.sum()).astype(np.float32)[:, None], classes.index(label)))
    fit = [f for k, f in enumerate(feats) if k % 8] or feats
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for k in rng.permutation(len(fit)):
            x, w, y = fit[k]
            lr = rate * (1 - done / steps)
            done += 1
            v = (emb[x] * w).sum(axis=0)
            z = v @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            g = layer @ p
            layer -= 0.05 * lr * np.outer(v, p)
            bias -= 0.0005 * lr * p
            emb[x] -= lr * w * g
    table = emb @ layer
    held = [(bias + (table[x] * w).sum(axis=0), y) for k, (x, w, y) in enumerate(feats) if k % 8 == 0]
    z, y = np.array([h[0] for h in held], np.float64), np.array([h[1] for h in held])

    def soft(t: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.25, 8, 41)
    heat = grid[int(np.argmin([-np.log(soft(t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]))]
    p = soft(heat)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    floor = min(0.5, float(np.quantile(right, reject_below))) if len(right) else 0.0
    return Model(classes, table.astype(np.float32), bias, float(heat), floor, bits)


#: Longest text that is learnt from, in characters; with `sample` it bounds what the driver gets.
LONGEST = 100_000


def sample_rows(docs: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> list[tuple[str, str]]:
    """At most `sample` labelled rows (all, if there are fewer): those with the smallest hashes of id and text.

    Texts of more than LONGEST characters aren't learnt from. The tasks filter by the hash first, so that few rows more
    than the sample leave them, whatever the number of partitions; equal rows can't push others out.
    """
    labelled = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= LONGEST))
    share = min(1.0, 1.1 * sample / max(1, labelled.count()))
    h = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1 << 40))
    few = labelled.filter(h < int(share * (1 << 40))).select(h.alias("h"), F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    return [(r["text"], r["label"]) for r in sorted(few.orderBy("h", "label").limit(sample).collect())]


def fit(docs: DataFrame, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> Model:
    return train(sample_rows(docs, sample, id_col, text_col, label_col), **options)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, lang_pred, score, rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = list(zip(*(model.predict(t) for t in b.column(1).to_pylist()), strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(found[2], pa.bool_())], ["id", "lang_pred", "score", "rejected"]
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs whose language the model doesn't reject, with all their columns. Nothing is shuffled."""

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([not model.predict(t)[2] for t in texts], dtype=bool)

    return docs.filter(known(F.col(text_col)))
