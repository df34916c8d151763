"""Incremental runs over a stream of landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import store
from millrace.sources.readers import exists


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path) if exists(spark, path) else like.limit(0)


def merge_batch(path: str, key: tuple[str, ...], seq: str) -> Callable[[DataFrame, int], None]:
    """Appends a batch's unknown keys to a Parquet store, the first of each by seq. A batch that is
    tried again finds its own rows and adds none, so the sink is idempotent."""

    def run(batch: DataFrame, _: int) -> None:
        first = store.keep_first(batch, key, [F.col(seq)])
        store.unknown(first, stored(batch.sparkSession, path, batch), key=key).write.mode("append").parquet(path)

    return run


def ingest(stream: DataFrame, path: str, checkpoint: str, key: tuple[str, ...] = store.KEY, seq: str = "seq") -> StreamingQuery:
    """Takes what has landed since the last run into the store, then stops."""
    return stream.writeStream.foreachBatch(merge_batch(path, key, seq)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_split(events: DataFrame, ts: str, grace: str = "2 days") -> DataFrame:
    """Batch form of the watermark: whether a row is older than the newest less grace."""
    newest = events.agg(F.max(ts).alias("_newest"))  # one row
    return events.crossJoin(F.broadcast(newest)).withColumn("late", F.col(ts) < F.col("_newest") - F.expr(f"interval {grace}")).drop("_newest")


def windowed_counts(events: DataFrame, ts: str, kind: str, value: str, size: str = "1 hour", delay: str = "2 days") -> DataFrame:
    """Counts and sums per tumbling window; on a stream, a window closes `delay` after its end."""
    stream = events.withWatermark(ts, delay) if events.isStreaming else events
    w = F.window(ts, size)
    out = stream.groupBy(w.alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), kind, "n", "total")
