"""The corpus pipeline against a brute-force version, stage by stage."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from docledger.llm import bpe as B
from docledger.llm import queries as Q

from .test_dedup import brute_join, brute_substring

SOUNDS = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["str", "unk", "ge", "ich"], "cc": ["éa", "ou", "que", "ré"]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    random.seed(11)
    rows, i = [], 0

    def words(lang, n):
        return ["".join(random.choices(SOUNDS[lang], k=3)) for _ in range(n)]

    while i < 260:
        lang = list(SOUNDS)[i % 3]
        base = words(lang, random.randint(5, 120))
        passage = words(lang, 40)
        for _ in range(random.choice([1, 1, 2, 4])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 12])):
                copy[random.randrange(len(copy))] = words(lang, 1)[0]
            text = " ".join(copy + (passage if random.random() < 0.3 else []))
            rows.append((i, text, lang, "s", len(text)))
            i += 1
    rows += [(i, "12345 --- 67", "aa", "s", 12), (i + 1, None, None, "s", None), (i + 2, "", "bb", "s", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        if name != P.STAGES[-1][0]:
            assert out.columns == columns
            path = f"{folder}/{name}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            found[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        else:
            last = out.collect()
    named = [name for name, _ in P.STAGES]
    assert named == ["language_id", "exact_dedup", "ngram_join", "substring_dedup", "packing"]

    clean = {i: t for i, t in rows.items() if t and any(map(str.isalpha, t))}
    assert set(found["language_id"]) <= set(clean) and len(found["language_id"]) >= 0.98 * len(clean)
    now = found["language_id"]
    best = {}
    for i, t in now.items():
        best[t] = max(i, best.get(t, i))
    assert found["exact_dedup"] == {i: t for t, i in best.items()}
    now = found["exact_dedup"]
    joined = brute_join(sorted(now.items()), 5, 80, 100)
    assert found["ngram_join"] == {i: now[i] for i in now if joined[i][1] == i}
    assert len(found["ngram_join"]) < len(now)
    now = found["ngram_join"]
    cut = brute_substring(sorted(now.items()), 20)
    assert found["substring_dedup"] == {i: cut[i][3] if cut[i][1] else now[i] for i in now}
    assert any(c[1] for c in cut.values())
    codec = B.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tokens = {i: len(codec.encode(t)) // 4 + 1 for i, t in found["substring_dedup"].items()}
    packed = dict.fromkeys(tokens, 0)
    for r in last:
        packed[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == tokens[r["doc_id"]]
    assert packed == tokens


def test_run_is_its_stages(spark, folder):
    assert P.run(spark, folder).agg(F.sum("length"), F.countDistinct("doc_id")).first()[1] > 0


def test_queries_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names


def test_contract_columns(spark, folder):
    want = {
        "op1_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
        "op2_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
        "op3_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
        "op4_langid": {"doc_id", "held_out", "lang_pred", "score"},
        "op5_ngram_join": {"doc_id", "n_shingles", "component_id"},
        "op7_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op8_webp": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
        "op9_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
        "op10_licenses": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    }
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for name, columns in want.items():
        out = Q.QUERIES[name](spark, folder)
        assert columns <= set(out.columns), name
        assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(rows), name
    sha = {r["doc_id"]: r["text_sha256"] for r in Q.QUERIES["op9_exact_dedup"](spark, folder).collect()}
    assert sha == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in rows.items()}
