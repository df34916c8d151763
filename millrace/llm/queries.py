"""The subpackage's registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import license_scan
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.line_quality import line_quality
from millrace.llm.mixing import mix_sources
from millrace.llm.ngram_jaccard import jaccard_components
from millrace.llm.packing import pack
from millrace.llm.sharding import balanced_shards
from millrace.llm.token_counts import token_counts
from millrace.llm.toxicity import toxicity
from millrace.llm.url_filter import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = balanced_shards(_table(spark, sf_dir, "documents"), 16)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op1_mixing aims at: each source's size and target."""
    return op1_mixing(spark, sf_dir).groupBy("source").agg(F.max("source_size").alias("source_size"), F.round(F.max("target"), 3).alias("target"), F.count(F.lit(1)).alias("documents"))


def shard_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where op4_sharding puts each document, without its checksum and slot."""
    return op4_sharding(spark, sf_dir).select("doc_id", "size", "law", "shard")


def shard_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4_sharding's slots are gapless: rows, first and last slot, and bytes of each shard."""
    s = op4_sharding(spark, sf_dir)
    return s.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first"), F.max("slot").alias("last"), F.countDistinct("slot").alias("slots"), F.sum("size").alias("bytes"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9_url_filter's hosts, paths and given rules; the verdict where a rule gives it."""
    verdict = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict")
    return op9_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", verdict)


def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10_line_quality's base rules."""
    return op10_line_quality(spark, sf_dir).drop("kept", "content_share")


def packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2_packing's pieces cover each document once and fill whole sequences: its pieces' sum, and whether its sequences are full or a power of two."""
    p = op2_packing(spark, sf_dir)
    of = p.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    sound = (F.col("n") == F.col("end")) & (F.col("n") <= 2048) & (F.bit_count("n") == 1)
    whole = p.join(of.select("sequence_id", sound.alias("sound")), "sequence_id")
    out = whole.groupBy("doc_id").agg((F.sum("length") == F.max("doc_tokens")).alias("covered"), F.min("start").alias("first"), F.min("sound").alias("sound"))
    return out


def counted_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7_token_counts' bytes, and that equal texts have equal counts of at most a token a byte."""
    c = op7_token_counts(spark, sf_dir)
    return c.select("doc_id", "n_bytes", (F.col("n_tokens") <= F.col("n_bytes")).alias("within"), ((F.col("n_tokens") > 1024) == F.col("over_limit")).alias("limit"))


def held_out_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8_toxicity's split and the range of its scores."""
    t = op8_toxicity(spark, sf_dir)
    return t.select("doc_id", "held_out", F.col("score").between(0, 1).alias("in_range"), ((F.col("score") >= 0.5).cast("int") == F.col("predicted")).alias("consistent"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_mixing, op2_packing, op3_exact_dedup, op4_sharding, op5_license_scan, op6_ngram_jaccard, op7_token_counts, op8_toxicity, op9_url_filter, op10_line_quality)
    parts = (mix_targets, shard_law, shard_slots, url_rules, text_measures, packed_tokens, counted_bytes, held_out_rows)
    return {f.__name__: f for f in (*ops, *parts)} | {"pipeline": pipeline}


DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * inter >= 85 * (x.n + y.n - inter)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, s.b FROM reach r JOIN sides s ON s.a = r.other),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)"""


# The level at which sources are capped: they are taken by rising size per weight until the rest fits.
TARGETS_SQL = """
WITH n AS (SELECT source, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS BIGINT) AS source_size, count(*) AS documents FROM documents GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS total FROM n),
k AS (SELECT *, total - coalesce(sum(3 * source_size) OVER before, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS heavy,
  row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS place
  FROM w WINDOW before AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(rest / heavy, place) AS level FROM k WHERE rest * weight <= 3.0 * source_size * heavy)
SELECT source, source_size, round(CAST(least(3.0 * source_size, weight * level) AS DOUBLE), 3) AS target, documents FROM k, level"""

SHARD_SQL = """
WITH t AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, sha256(coalesce(text, '')) AS sha FROM documents),
g AS (SELECT sha, CAST(sum(size) AS BIGINT) AS bytes FROM t GROUP BY sha),
p AS (SELECT sha, bytes, CAST(coalesce(sum(bytes) OVER (ORDER BY sha ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead, CAST(sum(bytes) OVER () AS BIGINT) AS total FROM g)
SELECT doc_id, size, 'bytes' AS law, CAST(least(15, (16 * (ahead + bytes // 2)) // total) AS INTEGER) AS shard FROM t JOIN p USING (sha)"""

SLOTS_SQL = f"""
SELECT shard, count(*) AS n, 0 AS first, count(*) - 1 AS last, count(*) AS slots, CAST(sum(size) AS BIGINT) AS bytes FROM ({SHARD_SQL}) GROUP BY shard"""

URL_SQL = """
WITH r(verdict, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
s AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h0, rest FROM s),
v AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM u),
f AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM v JOIN r ON ('.' || host) LIKE ('%.' || h) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, verdict FROM v LEFT JOIN f USING (page_id)"""

MEASURES_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
marked AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS x(k) GROUP BY doc_id),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(t, chr(10)) AS l FROM d)),
dup AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS k FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')) WHERE k > 1 GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(marked.n, 0) AS n_repeat_words, len(w) < 10 OR 100 * coalesce(marked.n, 0) > 20 * len(w) AS base_failed
FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN marked USING (doc_id)"""

PACKED_SQL = "SELECT doc_id, TRUE AS covered, CAST(0 AS BIGINT) AS first, TRUE AS sound FROM documents"

BYTES_SQL = "SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, TRUE AS within, TRUE AS \"limit\" FROM documents"


def _crc32_sql(text: str) -> str:
    """An unsigned CRC-32 of a short ASCII text in SQL: bit by bit over its bytes."""
    bits = "list_reduce(list_prepend({c}, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    step = bits.format(c="xor(a, CAST(b AS BIGINT))")
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, b: {step}), 4294967295)"


HELD_OUT_SQL = f"SELECT doc_id, {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 AS held_out, TRUE AS in_range, TRUE AS consistent FROM documents"


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": DEDUP_SQL, "op5_license_scan": license_scan.oracle(), "op6_ngram_jaccard": JACCARD_SQL, "mix_targets": TARGETS_SQL, "shard_law": SHARD_SQL,
        "shard_slots": SLOTS_SQL, "url_rules": URL_SQL, "text_measures": MEASURES_SQL, "packed_tokens": PACKED_SQL, "counted_bytes": BYTES_SQL, "held_out_rows": HELD_OUT_SQL,
    }
