"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import round_trip

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).withColumnRenamed("id", "doc_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, identify

    docs = documents(spark, sf_dir)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = fit(docs.filter(~held))
    found = identify(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_join

    return ngram_join(documents(spark, sf_dir), n=3, num=90, den=100).select(
        F.col("id").alias("doc_id"), F.col("n_grams").alias("n_shingles"), F.col("component").alias("component_id"), "n_links"
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import substring_dedup

    return substring_dedup(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumnRenamed("id", "page_id").drop("n_deleted")


def op8_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .webp import encode_media, read_media

    return read_media(encode_media(documents(spark, sf_dir))).withColumnRenamed("id", "doc_id")


def op11_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_array import suffix_dedup

    return suffix_dedup(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import branched, prefix_trie, sequences

    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 4
    return prefix_trie(branched(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet")), conv - conv % 20, head))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {
    "op9_exact_dedup": op9_exact_dedup,
    "op3_sharding": op3_sharding,
    "op2_bpe": op2_bpe,
    "op7_packing": op7_packing,
    "op10_licenses": op10_licenses,
    "op4_langid": op4_langid,
    "op5_ngram_join": op5_ngram_join,
    "op1_substring_dedup": op1_substring_dedup,
    "op6_html_extract": op6_html_extract,
    "op8_webp": op8_webp,
    "op11_suffix_array": op11_suffix_array,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}

def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _licenses_sql() -> str:
    from .licenses import TEMPLATES, as_regex

    rules = [(label, as_regex(t)) for label, t in TEMPLATES.items()]
    labels = ", ".join(f"CASE WHEN regexp_matches(s, '{r}') THEN '{label}' END" for label, r in rules)
    covered = " + ".join(f"coalesce(list_sum(list_transform(regexp_extract_all(s, '{r}'), lambda z: len(string_split(trim(z), '  ')))), 0)" for _, r in rules)
    return rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             x AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS i FROM d),
             y AS (SELECT *, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS e FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
             m AS (SELECT doc_id, i, CASE WHEN a = 'gnu' AND b = 'general' AND c = 'public' AND e = 'license' THEN 'gpl' WHEN a = 'apache' AND b = 'license' THEN 'apache'
                   WHEN a = 'cc' AND b = 'by' THEN 'cc-by' WHEN a = 'mit' AND b = 'license' THEN 'mit' END AS label FROM y),
             n AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS base FROM m WHERE label IS NOT NULL GROUP BY 1),
             l AS (SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS s FROM d),
             t AS (SELECT doc_id, n_words, list_filter([{labels}], lambda z: z IS NOT NULL) AS own, CAST({covered} AS DOUBLE) AS covered FROM l)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), own))), ',') AS labels, IF(n_words > 0, least(1.0, covered / n_words), 0.0)::DOUBLE AS score
        FROM t LEFT JOIN n USING (doc_id)
    """


#: Plain forms of the contracts; brute force in SQL, for small tables.
ORACLES: dict[str, str] = {
    "op1_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
             x AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
             g AS (SELECT *, IF(i + 19 <= n, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)), NULL) AS gram FROM x),
             r AS (SELECT *, gram IS NOT NULL AND row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1 AS again FROM g),
             c AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
             k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY 1)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
    """,
    "op5_ngram_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_words(_LOWER)} AS w FROM documents),
             x AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
             g AS (SELECT doc_id, n, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s FROM x),
             s AS (SELECT DISTINCT doc_id, s FROM g WHERE i + 2 <= n OR (n < 3 AND i = 1)),
             z AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS h FROM s GROUP BY 1),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
             l AS (SELECT a, b, x.h AS ha, y.h AS hb FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * p.i >= 90 * (x.n + y.n - p.i)),
             t(a, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, t.c FROM t JOIN l ON l.b = t.a WHERE t.c < l.a),
             m AS (SELECT a AS doc_id, min(c) AS component_id FROM t GROUP BY 1),
             k AS (SELECT a AS doc_id, count(DISTINCT hb) AS n_links FROM l WHERE ha <> hb GROUP BY 1)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM m LEFT JOIN z USING (doc_id) LEFT JOIN k USING (doc_id)
    """,
    "op6_html_extract": r"""
        WITH b AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)\b[^>]*>') AS b FROM pages),
             c AS (SELECT page_id, url, list_transform(b, lambda x: regexp_replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;', '"', 'g')) AS b FROM b),
             e AS (SELECT page_id, url, list_filter(list_transform(b, lambda x: trim(regexp_replace(regexp_replace(x, '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS b FROM c)
        SELECT page_id, url, array_to_string(b, chr(10)) AS text, CAST(length(array_to_string(b, chr(10))) AS BIGINT) AS n_chars FROM e
    """,
    "op10_licenses": _licenses_sql(),
    "op11_suffix_array": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
             x AS (SELECT doc_id, octet_length(b) AS n, b, unnest(range(1, octet_length(b) + 1)) AS i FROM d),
             g AS (SELECT doc_id, i, b[i:i] AS c, IF(i + 99 <= n, md5(b[i:i + 99]), NULL) AS s FROM x),
             r AS (SELECT doc_id, i, c, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM g),
             m AS (SELECT doc_id, i, c, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
             z AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS was FROM m),
             k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT was) AS n_spans, string_agg(hex(c), '' ORDER BY i) FILTER (NOT gone) AS kept FROM z GROUP BY 1)
        SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op12_prefix_trie": f"""
        WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
                   FROM conversations WHERE conv_id IS NOT NULL),
             o AS (SELECT conv_id AS c, list({{'r': r, 'x': x, 'w': len({_words("x")})}} ORDER BY k) AS own FROM t GROUP BY 1),
             h AS (SELECT c, own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),
                       lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, u: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 4 AS h FROM o),
             q AS (SELECT h.c, list_concat(coalesce(o.own[1:h.h], []), h.own[h.h + 1:]) AS s FROM h LEFT JOIN o ON o.c = h.c - h.c % 20),
             p AS (SELECT c, len(s) AS n, s, unnest(range(0, len(s) + 1)) AS d FROM q),
             e AS (SELECT c, d, n, md5(CAST(list_transform(s[1:d], lambda z: [z.r, z.x]) AS VARCHAR)) AS node, md5(CAST(list_transform(s[1:d - 1], lambda z: [z.r, z.x]) AS VARCHAR)) AS up,
                          IF(d > 0, s[d].w, 0) AS w FROM p),
             v AS (SELECT d, node, IF(d > 0, any_value(up), NULL) AS up, any_value(w) AS w, min(c) AS c, count(*) AS m, max(n) = d AS leaf,
                          coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends FROM e GROUP BY 1, 2),
             a AS (SELECT DISTINCT x.d, x.node, y.d AS low, y.node AS below FROM e x JOIN e y ON x.c = y.c AND y.d >= x.d),
             u AS (SELECT a.d, a.node, count(*) FILTER (v.leaf) AS leaves, sum((v.m - 1) * v.w) AS saved FROM a JOIN v ON v.d = a.low AND v.node = a.below GROUP BY 1, 2)
        SELECT v.c AS conv_id, v.d AS depth, y.c AS parent_conv_id, v.m AS n_convs, (SELECT count(*) FROM v k WHERE k.d = v.d + 1 AND k.up = v.node) AS n_children,
               u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
        FROM v JOIN u ON u.d = v.d AND u.node = v.node LEFT JOIN v y ON y.d = v.d - 1 AND y.node = v.up
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
