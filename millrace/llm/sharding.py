"""Balanced shards by global byte-size prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._common import materialize, text_or_empty

#: Runs into which the copies of one text are split, so that none is ranked in one task.
SALTS = 256
#: Digest ranges for which totals are summed; their totals are all that meets in one task.
RANGES = 4096


def balanced_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put all rows into contiguous shards of nearly equal bytes; equal texts share a shard.

    The global order is (SHA-256 of the text, a hash of the id modulo SALTS, id). Digests are uniform,
    so RANGES equal digest ranges partition the order evenly without sampling. Rows with equal text
    and identifier (null is one) are counted first and written out again at the end, since nothing
    tells them apart. Rows are reduced to one entry per (digest, salt); an entry's place is the running sum in its range plus the totals
    of the ranges before it. The order is cut at equal targets: a group of equal texts goes to
    the shard in which the middle of its bytes lies. Shards differ by the largest group at most,
    and a group above the target makes its shard larger, since it is never split.

    Size is the UTF-8 bytes of the text plus 1, and 1 for null, which counts as an own, empty
    text with crc32 0 and shares the group of empty texts. Repeated rows get a slot each. Very long
    texts are only hashed and measured. An
    empty table gives no rows. Other input columns are ignored.

    Returns id_col, size long, text_crc32 long, shard int, slot long (gapless from 0).
    """
    if shards < 1:
        raise ValueError("shards must be 1 at least")
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).cast("long").alias("_crc"), F.unhex(F.sha2(text, 256)).alias("_sha"),
        F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int").alias("_salt"),
    )
    rows = materialize(rows.groupBy("_id", "_sha", "_salt", "_size", "_crc").agg(F.count(F.lit(1)).alias("_same")), "shard-rows")
    runs = rows.groupBy("_sha", "_salt").agg(F.sum(F.col("_size") * F.col("_same")).alias("_b"), F.sum("_same").alias("_n"))
    span = (F.conv(F.hex(F.substring("_sha", 1, 2)), 16, 10).cast("int") % F.lit(65536)) / F.lit(65536 // RANGES)
    runs = materialize(runs.withColumn("_range", F.floor(span).cast("int")), "shard-runs")

    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("_range").agg(F.sum("_b").alias("_tb"), F.sum("_n").alias("_tn"))  # RANGES rows at most
    everything = Window.partitionBy(F.lit(0))
    totals = totals.select(
        "_range", F.coalesce(F.sum("_tb").over(before), F.lit(0)).alias("_b0"), F.coalesce(F.sum("_tn").over(before), F.lit(0)).alias("_n0"),
        F.sum("_tb").over(everything).alias("_all"),
    )
    order = Window.partitionBy("_range").orderBy("_sha", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("_range", "_sha")
    placed = (
        runs.withColumn("_rb", F.coalesce(F.sum("_b").over(order), F.lit(0)))
        .withColumn("_rn", F.coalesce(F.sum("_n").over(order), F.lit(0)))
        .withColumn("_g0", F.min("_rb").over(group))
        .withColumn("_gb", F.sum("_b").over(group))
        .join(F.broadcast(totals), "_range")
    )
    shard = F.least(F.expr(f"({shards} * (_b0 + _g0 + _gb div 2)) div _all"), F.lit(shards - 1)).cast("int")
    placed = materialize(placed.select("_sha", "_salt", shard.alias("_shard"), (F.col("_n0") + F.col("_rn")).alias("_first")), "shard-places")
    starts = placed.groupBy("_shard").agg(F.min("_first").alias("_start"))  # a row per shard
    placed = placed.join(F.broadcast(starts), "_shard").withColumn("_base", F.col("_first") - F.col("_start"))
    earlier = Window.partitionBy("_sha", "_salt").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    first = (F.col("_base") + F.coalesce(F.sum("_same").over(earlier), F.lit(0))).cast("long")
    return rows.join(placed, ["_sha", "_salt"]).withColumn("_first", first).select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"), F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_same") - 1)).alias("slot"),
    )
