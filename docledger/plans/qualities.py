"""Quality queries: coverage, multisets, metrics, gates, constraints, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import split_items, squeeze
from ..operators import quality as Q
from ..session import table
from .registry import query

KINDS = ["click", "error", "purchase", "signup", "view"]
SLOTS = """
    o AS (SELECT DISTINCT user_id, ts::DATE AS day, event_type AS kind FROM events),
    e AS (SELECT user_id, d::DATE AS day, k AS kind FROM (SELECT DISTINCT user_id FROM events), unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) a(d),
          (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) b(k))
"""


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), F.col("event_type").alias("kind"))


@query(f"WITH {SLOTS} SELECT user_id, day::VARCHAR AS day, kind FROM e ANTI JOIN o USING (user_id, day, kind)")
def missing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Q.missing_slots(_observed(spark, sf_dir), ["user_id"], "day", "kind", KINDS, "2024-01-01", "2024-01-31")
    return out.withColumn("day", F.col("day").cast("string"))


@query("""
    SELECT user_id, 31::BIGINT AS expected_days, count(DISTINCT ts::DATE) AS observed_days, 155::BIGINT AS expected_slots, count(DISTINCT (ts::DATE, event_type)) AS observed_slots FROM events GROUP BY 1
""")
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.coverage(_observed(spark, sf_dir), ["user_id"], "day", "kind", KINDS, "2024-01-01", "2024-01-31")


@query("""
    SELECT d::DATE::VARCHAR AS day, count(DISTINCT user_id) AS users, count(user_id) > 0 AS available
    FROM unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) t(d) LEFT JOIN events ON ts::DATE = d::DATE GROUP BY 1
""")
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("users"))
    calendar = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-02-05')) AS day")
    out = calendar.join(per, "day", "left")
    return out.select(F.col("day").cast("string").alias("day"), F.coalesce("users", F.lit(0)).alias("users"), F.col("users").isNotNull().alias("available"))


TOKENS = """
    d AS (SELECT source AS k, unnest(string_split_regex(text, '[ \\t\\n\\v\\f\\r]+')) AS item FROM documents WHERE doc_id % 2 = 0),
    b AS (SELECT source AS k, unnest(string_split_regex(text, '[ \\t\\n\\v\\f\\r]+')) AS item FROM documents WHERE doc_id % 2 = 1),
    x AS (SELECT k, item, count(*) AS n FROM d WHERE item <> '' GROUP BY ALL), y AS (SELECT k, item, count(*) AS n FROM b WHERE item <> '' GROUP BY ALL)
"""


def _tokens(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Words by source: those of even documents against those of odd ones."""
    words = F.explode(F.split("text", r"[ \t\n\x0B\f\r]+")).alias("item")
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("k"), "doc_id", words).filter("item <> ''")
    return rows.filter("doc_id % 2 = 0").drop("doc_id"), rows.filter("doc_id % 2 = 1").drop("doc_id")


@query(f"""
    WITH {TOKENS} SELECT coalesce(x.k, y.k) AS k, coalesce(x.item, y.item) AS item, greatest(coalesce(x.n, 0) - coalesce(y.n, 0), 0) AS missing, greatest(coalesce(y.n, 0) - coalesce(x.n, 0), 0) AS extra
    FROM x FULL JOIN y ON x.k = y.k AND x.item = y.item WHERE x.n IS DISTINCT FROM y.n
""")
def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _tokens(spark, sf_dir)
    return Q.multiset_difference(a, b, ["k"], "item")


@query(f"""
    WITH {TOKENS} SELECT coalesce(x.k, y.k) AS k, CAST(sum(coalesce(x.n, 0)) AS BIGINT) AS n_a, CAST(sum(coalesce(y.n, 0)) AS BIGINT) AS n_b, CAST(sum(least(coalesce(x.n, 0), coalesce(y.n, 0))) AS BIGINT) AS n_both
    FROM x FULL JOIN y ON x.k = y.k AND x.item = y.item GROUP BY 1
""")
def multiset_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _tokens(spark, sf_dir)
    return Q.multiset_overlap(a, b, ["k"], "item")


@query("""
    WITH j AS (SELECT lang, quality, (n_chars > 1000)::INT AS found FROM documents JOIN labels USING (doc_id)),
         a AS (SELECT lang, CAST(sum(quality * found) AS BIGINT) AS hits, sum(found) AS f, sum(quality) AS t, CAST(sum((quality = found)::INT) AS BIGINT) AS exact FROM j GROUP BY 1)
    SELECT lang, hits, round(coalesce(hits::DOUBLE / nullif(f, 0), 0), 6) AS precision, round(coalesce(hits::DOUBLE / nullif(t, 0), 0), 6) AS recall, exact FROM a
""")
def golden_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return joined.withColumn("found", (F.col("n_chars") > 1000).cast("int")).groupBy("lang").agg(*Q.metrics(F.col("quality"), F.col("found")))


@query("""
    SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS n, count(DISTINCT event_type) AS n_contents FROM events GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT event_type) = 1
""")
def suspicion_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type")
    return Q.suspicious_days(rows, ["user_id"], "day", "event_type")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 15")
def repeated_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.repeated_single(table(spark, sf_dir, "events"), ["user_id"], "event_type", 15)


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS variants FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_partkey").alias("variants"))
    return per.filter("n > 1")


DERIVED = """
    g AS (SELECT d.doc_id, d.source, d.lang, quality, toxic, d.doc_id % 7 = 0 AS warns, d.doc_id % 5 = 0 AS fails, n_chars FROM documents d LEFT JOIN labels USING (doc_id)),
    r AS (SELECT *, CASE WHEN fails AND doc_id % 2 = 0 THEN 'failed' WHEN NOT fails AND NOT warns AND quality = 1 AND toxic = 0 AND n_chars > 50 THEN 'ready' ELSE 'review' END AS route FROM g)
"""


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    none = F.array().cast("array<string>")
    fails = F.col("doc_id") % 5 == 0
    route = R.publication_gate(
        status=F.when(fails, "PARTIAL").otherwise("PASS"),
        failure_codes=F.when(fails & (F.col("doc_id") % 2 == 0), F.array(F.lit("PARSE_ERROR"))).otherwise(none),
        invalid=F.lit(None).cast("int"),
        coverage_complete=F.col("n_chars") > 50,
        missing_dates=none,
        missing_meals=none,
        source_provenance_valid=F.lit(True),
        institution_id=F.col("source"),
        menu_quality_valid=F.col("quality") == 1,
        source_completeness_valid=F.lit(None).cast("boolean"),
        unresolved_formula_values=F.col("toxic"),
        excel_error_menu_items=F.lit(0),
        unresolved_non_menu_artifacts=F.lit(None).cast("int"),
        items=F.array(F.lit("rice")),
        issue_codes=F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("PERIOD_CONFLICT"))).otherwise(none),
    )
    return d.withColumn("route", route)


@query(f"WITH {DERIVED} SELECT doc_id, route FROM r")
def gate_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("doc_id", "route")


@query("""
    WITH i AS (SELECT doc_id, list_filter([CASE WHEN lang IS NULL THEN 'INVALID_LANG' END, CASE WHEN n_chars < 20 THEN 'BLANK' END, CASE WHEN n_chars <> length(text) THEN 'LENGTH_MISMATCH' END,
        CASE WHEN count(*) OVER (PARTITION BY sha256(text)) > 1 THEN 'DUPLICATE' END, CASE WHEN n_chars > 10000 THEN 'LONG' END], lambda x: x IS NOT NULL) AS c FROM documents)
    SELECT doc_id, array_to_string(list_sort(c), ',') AS issues, CASE WHEN len(list_filter(c, lambda x: x <> 'LONG')) > 0 THEN 'invalid' WHEN len(c) > 0 THEN 'warning' ELSE 'valid' END AS status FROM i
""")
def record_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with sorted issue codes and a status. Duplicates come from an aggregate joined back, not a window over texts."""
    d = table(spark, sf_dir, "documents").withColumn("digest", F.sha2("text", 256))
    many = d.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    n = F.col("n_chars")
    issues = R.codes(
        {"INVALID_LANG": F.col("lang").isNull(), "BLANK": n < 20, "LENGTH_MISMATCH": n != F.length("text"), "DUPLICATE": F.col("copies") > 1, "LONG": n > 10000}
    )
    # null texts have a null digest and are each other's duplicates
    out = d.join(many.withColumnRenamed("digest", "of"), F.col("digest").eqNullSafe(F.col("of"))).select("doc_id", issues.alias("c"))
    status = F.when(F.exists("c", lambda x: x != "LONG"), "invalid").when(F.size("c") > 0, "warning").otherwise("valid")
    return out.select("doc_id", F.array_join("c", ",").alias("issues"), status.alias("status"))


@query("""
    SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(t, 'AIza[0-9A-Za-z_-]{30,}') THEN 'google_api_key' END,
      CASE WHEN regexp_matches(t, '(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{30,})') THEN 'github_token' END,
      CASE WHEN regexp_matches(t, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') THEN 'private_key' END,
      CASE WHEN regexp_matches(t, 'Bearer\\s+[A-Za-z0-9_.-]{20,}') THEN 'bearer_credential' END,
      CASE WHEN regexp_matches(t, '(?i)(?:password|api_key|token|secret)\\s*[=:]\\s*["''][A-Za-z0-9_./+-]{20,}["'']') THEN 'assigned_credential' END,
      CASE WHEN regexp_matches(t, '(?i)(?:C:[\\\\/]+Users[\\\\/]+|E:[\\\\/]+workspace[\\\\/]+)') THEN 'private_windows_path' END], lambda x: x IS NOT NULL), ',') AS hits
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WHERE hits <> ''
""")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = F.array_join(R.secrets_in(F.coalesce("text", F.lit(""))), ",")
    return table(spark, sf_dir, "documents").select("doc_id", hits.alias("hits")).filter("hits <> ''")


PLANTED = ("=SUM(A1)", "# REF!", "소 계", "1200원", "-", "부식물 단가", "※물량공급이어려울시 동일식군내대체가능.")
BRACKETED = "밥(흰,잡곡)/국[소/무,파]"
KINDS_OF = ("formula_literal", "excel_error", "subtotal", "price", "placeholder", "cost_metadata", "instruction_note")


@query("""
    WITH p AS (SELECT doc_id, coalesce(text, '') || '/' || coalesce([""" + ", ".join(f"'{x}'" for x in (*PLANTED, BRACKETED)) + """][doc_id % 9 + 1], 'x') AS text FROM documents),
         h AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(length(text))) AS i FROM p WHERE regexp_matches(text, '[\\[(（]')),
         s AS (SELECT *, sum(CASE WHEN ch IN ('[', '(', '（') THEN 1 WHEN ch IN (']', ')', '）') THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM h),
         d AS (SELECT *, s = least(0, min(s) OVER (PARTITION BY doc_id ORDER BY i)) AND ch IN (chr(10), chr(13), '/', ',', '，') AS cut FROM s),
         k AS (SELECT *, count(*) FILTER (cut) OVER (PARTITION BY doc_id ORDER BY i) AS part FROM d),
         t AS (SELECT doc_id, unnest(string_split_regex(text, '[\n\r/,，]')) AS token FROM p WHERE NOT regexp_matches(text, '[\\[(（]')
           UNION ALL SELECT doc_id, string_agg(ch, '' ORDER BY i) FILTER (NOT cut) FROM k GROUP BY doc_id, part), c AS (SELECT doc_id, trim(token, ' ·•' || chr(9)) AS token FROM t)
    SELECT category, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, CASE
      WHEN ltrim(token) LIKE '=%' THEN 'formula_literal' """ + " ".join(f"WHEN token = '{x}' THEN '{k}'" for x, k in zip(PLANTED[1:4] + PLANTED[5:], KINDS_OF[1:4] + KINDS_OF[5:], strict=True)) + r"""
      WHEN regexp_full_match(regexp_replace(token, '\s', '', 'g'), '0+(?:\.0+)?|-') THEN 'placeholder' WHEN regexp_matches(token, '[\[(（].*[/,，]') THEN 'item_with_list' ELSE 'item' END AS category
      FROM c WHERE token <> '') GROUP BY 1
""")
def token_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all texts by category, with one of all seven planted, or an item with lists in brackets, which stays whole."""
    planted = F.coalesce(F.get(F.array(*map(F.lit, (*PLANTED, BRACKETED))), (F.col("doc_id") % 9).cast("int")), F.lit("x"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("/"), planted)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(split_items(text)).alias("token"))
    tokens = rows.withColumn("squeezed", squeeze(F.col("token")))
    plain = F.when(F.col("token").rlike(r"(?s)[\[(（].*[/,，]"), "item_with_list").otherwise("item")
    kind = F.coalesce(R.token_category(F.col("token"), F.col("squeezed")), plain)
    return tokens.groupBy(kind.alias("category")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("documents"))


@query("""
    WITH p AS (SELECT o_orderkey, o_orderstatus AS s, o_totalprice, CAST(o_orderkey % 4 AS INT) AS k FROM orders)
    SELECT o_orderkey, CASE k WHEN 0 THEN 'rice,soup' WHEN 1 THEN 'rice' WHEN 2 THEN 'rice,soup' ELSE '' END AS clean, CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 1 END AS n_artifacts, k >= 2 AS unsafe FROM p
""")
def clean_vs_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item arrays of four shapes: clean; a trailing price; a placeholder between items; an error only."""
    shapes = F.expr("array(array('rice','soup'), array('rice','1,200원'), array('rice','0.0','soup'), array('#REF!'))")
    o = table(spark, sf_dir, "orders").select("o_orderkey", R.split_artifacts(F.get(shapes, (F.col("o_orderkey") % 4).cast("int"))).alias("s"))
    return o.select("o_orderkey", F.array_join("s.clean", ",").alias("clean"), F.size("s.artifacts").alias("n_artifacts"), F.col("s.unsafe").alias("unsafe"))


@query("""
    SELECT count(*) AS occurrences, count(DISTINCT doc_id) AS documents, count(DISTINCT source) AS sources, count(DISTINCT lang) AS languages
    FROM (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[A-Za-z0-9._]+@[A-Za-z0-9.]+|Licensed under|Released under')
""")
def lint_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.explode(F.split("text", "\n")).alias("line"))
    hits = lines.filter(F.col("line").rlike("[A-Za-z0-9._]+@[A-Za-z0-9.]+|Licensed under|Released under"))
    return hits.agg(F.count(F.lit(1)).alias("occurrences"), *[F.countDistinct(c).alias(a) for c, a in (("doc_id", "documents"), ("source", "sources"), ("lang", "languages"))])


@query("""
    WITH s AS (SELECT source, bool_or(lang = 'de') AS de FROM documents GROUP BY 1)
    SELECT doc_id, CASE WHEN lang = 'fr' AND n_chars > 2000 THEN 'mixed' WHEN lang = 'fr' THEN 'staff' WHEN de AND n_chars < 300 THEN 'ambiguous' ELSE 'unknown' END AS role FROM documents JOIN s USING (source)
""")
def rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rule that holds; one rule looks at sibling rows of the source, by an aggregate joined back."""
    d = table(spark, sf_dir, "documents")
    siblings = d.groupBy("source").agg(F.bool_or(F.col("lang") == "de").alias("de"))
    role = R.first_match(
        [
            ((F.col("lang") == "fr") & (F.col("n_chars") > 2000), F.lit("mixed")),
            (F.col("lang") == "fr", F.lit("staff")),
            (F.col("de") & (F.col("n_chars") < 300), F.lit("ambiguous")),
        ],
        F.lit("unknown"),
    )
    return d.join(siblings, "source").select("doc_id", role.alias("role"))


@query("""
    SELECT conv_id, array_to_string(list_transform(list(IF(regexp_matches(text, '(?i)the'), '[redacted]', text) ORDER BY turn), lambda x: md5(x)), ',') AS texts FROM conversations GROUP BY 1
""")
def redact_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings inside nested structs that match a pattern become a literal."""
    nested = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    from ..operators.contract import redact

    clean = redact(F.col("turns"), nested.schema["turns"].dataType, "(?i)the")
    return nested.select("conv_id", F.array_join(F.transform(clean, lambda t: F.md5(t["text"])), ",").alias("texts"))


@query("SELECT 'text' AS column_name, count(*) AS n FROM conversations WHERE regexp_matches(text, '(?i)the')")
def forbidden_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String leaves of nested public rows that hold a forbidden value, found by walking the schema."""
    from ..operators.contract import forbidden_values

    rows = table(spark, sf_dir, "conversations").select(F.struct("role", F.struct("text").alias("body")).alias("row"))
    return forbidden_values(rows, "(?i)the").select(F.element_at(F.split("path", r"\."), -1).alias("column_name"), "n")
