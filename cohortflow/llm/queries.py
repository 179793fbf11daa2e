"""The named queries over a folder of Parquet tables and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.llm import hard_negatives, latent_leaks, license_scan, odd_sketch, pair_rank, pattern_packing, ppm, role_repair, rule_ledger, source_mix, token_counts, toxic_gru, url_filter
from cohortflow.plans.lineage import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, d, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "token-cache"))


def _licenses(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return license_scan.license_scan(docs).drop("blocks")


#: The listed rules.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def _urls(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    rules = url_filter.rule_entries(spark.createDataFrame(RULES, "rule string, verdict string"))
    listing = rules.unionByName(url_filter.page_entries(url_filter.repeated_pages(pages)))
    return url_filter.judge_urls(pages, listing).drop("url")


URLS_SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    coalesce(contains(url, '://'), false) AS is_url
  FROM pages),
c AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '\.html$', ''), '/+$', '') AS page FROM p),
repeated AS (SELECT page FROM c WHERE is_url GROUP BY page HAVING count(*) > 1),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN is_url AND page IN (SELECT page FROM repeated) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


def _mix(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return source_mix.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def _quality(spark: SparkSession, d: str) -> DataFrame:
    return pair_rank.quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


def _toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxic_gru.toxicity_scores(table(spark, d, "documents"), table(spark, d, "labels"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return latent_leaks.contamination(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))


def _rules(spark: SparkSession, d: str) -> DataFrame:
    judged = rule_ledger.apply_policy(rule_ledger.ledger(table(spark, d, "documents").select("doc_id", "text")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rule_ledger.fails_any(rule_ledger.mask_of(rule_ledger.BASE)).alias("base_failed"), "kept",
    )


RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM h, (SELECT unnest([0, 1, 2]) AS k) WHERE h.n > 1 GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(ls) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '!!')) AS n_bangs
  FROM w LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > 3 * n_words
    OR (n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines) OR 2 * n_upper > word_chars OR 10 * n_bangs > 3 * n_words) AS kept
FROM b
"""

def _near(spark: SparkSession, d: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, d, "documents").select("doc_id", "text"), width=4)


NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, f.b FROM r JOIN f ON f.a = r.reached)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""

def _language(spark: SparkSession, d: str) -> DataFrame:
    return ppm.language_scores(table(spark, d, "documents").select("doc_id", "text"))



def _packing(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers as public

    docs = table(spark, d, "documents").select("doc_id", "text")
    packed = pattern_packing.pack(docs, public.path("byte_bpe_50k.json"), ranks=public.path("byte_bpe_50k.tiktoken"), pattern=public.PATTERN)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")



def _negatives(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    whole = lambda x: F.when(~F.isnan(x) & (F.abs(x) != float("inf")), F.floor(256 * x.cast("double")))
    rows = table(spark, d, "embeddings").select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), F.transform("embedding", whole).alias("v"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""


def _damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, by a hash of conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hashed = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), hashed.alias("_h")).filter("_h <> 0")
    text = F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_h") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _repaired(spark: SparkSession, d: str) -> DataFrame:
    conversations = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    found = role_repair.repair(_damaged(conversations))
    kept = found.summary.join(role_repair.checksums(found).withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    every = conversations.select(F.col("conv_id").alias("_id")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(kept, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


def _repair_sql() -> str:
    """Dynamic programming over the four places of the role pattern: none yet, after s, after u, after a."""
    least = lambda *x: f"list_sort(list_filter([{', '.join(x)}], lambda e: e IS NOT NULL))[1]"
    edit = lambda e, c, a, line="": f"CASE WHEN {e} IS NOT NULL THEN {{'c': {e}.c + {c}, 'a': {e}.a || '{a}', 'r': {e}.r{line}}} END"
    extra = "CASE WHEN fault = 't' THEN 3 ELSE 0 END"
    keep = lambda e, i: f"CASE WHEN may AND left(role, 1) = '{i}' THEN {edit(e, extra, 'K', ' || [role || chr(58) || text]')} END"
    rerole = lambda e, name: f"CASE WHEN may THEN {edit(e, f'3 + {extra}', 'R', f' || [{chr(39)}{name}:{chr(39)} || text]')} END"
    insert = lambda e, name: edit(e, 3, "I", f" || ['{name}:']")
    drop = lambda e: edit(e, 4, "D")
    before_user = ("e0", "e1", "e3")
    u = least(drop("e2"), *(keep(e, "u") for e in before_user), *(rerole(e, "user") for e in before_user))
    a = least(drop("e3"), keep("e2", "a"), rerole("e2", "assistant"))
    inserted_u = lambda n0, n1, n2, n3: least(n2, insert(n0, "user"), insert(n1, "user"), insert(n3, "user"))
    struct = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, 8 * length(k)), lambda i: (ascii(k[i // 8 + 1]) >> CAST(i % 8 AS INTEGER)) & 1)),
    lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)), CAST(4294967295 AS BIGINT)) % 20 AS h FROM src),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE h <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
judged AS (
  SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE '' END AS fault FROM numbered),
ready AS (SELECT *, fault NOT IN ('b', 'd') AS may FROM judged),
begin AS (SELECT {{'c': CAST(0 AS BIGINT), 'a': '', 'r': CAST([] AS VARCHAR[])}} AS e0),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, e0, CAST(NULL AS {struct}) AS e1, {insert("e0", "user")} AS e2, {insert("(" + insert("e0", "user") + ")", "assistant")} AS e3
  FROM (SELECT DISTINCT conv_id FROM ready), begin
  UNION ALL
  SELECT conv_id, n, n0, n1, m2, {least("n3", insert("m2", "assistant"))} FROM (
    SELECT conv_id, n, n0, n1, n3, {inserted_u("n0", "n1", "n2", "n3")} AS m2 FROM (
      SELECT ready.conv_id, ready.n, {drop("e0")} AS n0, {least(drop("e1"), keep("e0", "s"))} AS n1, {u} AS n2, {a} AS n3
      FROM walk JOIN ready ON ready.conv_id IS NOT DISTINCT FROM walk.conv_id AND ready.n = walk.n + 1))),
ends AS (SELECT conv_id, {least("e0", "e3")} AS e FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM ready GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.c, 0) AS BIGINT) AS cost,
  coalesce(e.a, '') AS audit, sha256(coalesce(array_to_string(e.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id
"""


QUERIES = {
    "op1_token_counts": _tokens,
    "op2_license_scan": _licenses,
    "op3_url_filter": _urls,
    "op4_source_mix": _mix,
    "op5_quality": _quality,
    "op6_toxicity": _toxicity,
    "op7_benchmark_leaks": _leaks,
    "op8_rule_ledger": _rules,
    "op9_near_duplicates": _near,
    "op10_ppm_scores": _language,
    "op11_hard_negatives": _negatives,
    "op12_role_repair": _repaired,
    "op13_best_fit_packing": _packing,
}
ORACLES = {"op3_url_filter": URLS_SQL, "op8_rule_ledger": RULES_SQL, "op9_near_duplicates": NEAR_SQL, "op11_hard_negatives": NEGATIVES_SQL, "op12_role_repair": _repair_sql()}
