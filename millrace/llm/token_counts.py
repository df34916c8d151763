"""Token counts with a digest cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import joined, materialize, new_path, per_worker, small_batches, text_or_empty
from millrace.llm._tokens import counter, version_digest

SCHEMA = "digest string, version string, n_tokens long"


def _encode(path: str, version: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = per_worker(("counter", path), lambda: counter(path))
        for digests, texts in joined(batches, "digest", "_text"):
            n = count(texts)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], ["digest", "version", "n_tokens"])

    return run


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str | None = None,
    limit: int = 1024,
    normalise: Callable[[Column], Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokens of every whole text, each distinct text encoded once and remembered.

    The cache is a Parquet table (digest, version, n_tokens) at cache_path, keyed by SHA-256 of
    the normalised text and of the tokenizer's file; without cache_path it is a new one in the
    shared folder. Texts are reduced to one per digest, in each task before the shuffle and after
    it, those with a stored count leave by an anti-join on the same partitioning, and what is left
    is encoded and appended. Rows then join the counts on the digest; rows of a frequent text are
    a few bytes each and that join may be split by the engine.

    A second tokenizer has its own entries. Two runs that append the same miss at the same time
    leave equal entries, which are read as one. tokenizer_path must exist on all executors.
    Null texts count as empty: 0 bytes, 0 tokens. Very long texts are encoded whole. Repeated rows each get their result. An empty
    table gives no rows and appends nothing. Other input columns are ignored.

    Returns id_col, n_bytes long (UTF-8 of the text as given), n_tokens long, over_limit boolean.
    """
    spark = docs.sparkSession
    small_batches(spark)
    version = version_digest(tokenizer_path)
    raw = text_or_empty(text_col)
    text = normalise(raw) if normalise else raw
    keyed = materialize(docs.select(F.col(id_col).alias("_id"), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest")), "token-keys")
    cache_path = cache_path or new_path(spark, "token-cache")
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.mode("append").parquet(cache_path)  # so that a new cache can be read
    known = spark.read.schema(SCHEMA).parquet(cache_path).where(F.col("version") == version)
    misses = docs.select(F.sha2(text, 256).alias("digest"), text.alias("_text")).dropDuplicates(["digest"])
    misses = misses.join(known.select("digest"), "digest", "left_anti")
    misses.mapInArrow(_encode(tokenizer_path, version), SCHEMA).write.mode("append").parquet(cache_path)
    counts = spark.read.schema(SCHEMA).parquet(cache_path).where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keyed.join(counts, "digest").select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
