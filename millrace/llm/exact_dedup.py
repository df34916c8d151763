"""Exact deduplication: tree merge of sorted digest runs, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialize, power_of_two, shuffle_partitions, text_or_empty

KEY = ["_sha", "_check", "_len"]


def _slot(bits: int) -> Column:
    """Where the tree gathers a digest: its leading bits."""
    return (F.conv(F.hex(F.substring("_sha", 1, 4)), 16, 10).cast("long") % F.lit(1 << bits)).cast("int")


def _merge(entries: DataFrame, runs: int, best: Callable[[Column], Column]) -> DataFrame:
    """The entries of each run, which is one partition, sorted by key and merged in that order.

    A struct is no hash aggregate's value, so the engine merges neighbours of the sorted run."""
    run = entries.repartitionById(runs, "_run").sortWithinPartitions("_run", *KEY)
    return run.groupBy("_run", *KEY).agg(best("_keep").alias("_keep"), F.sum("_n").alias("_n"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
    bits_per_round: int = 3,
) -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Every row starts in one of R runs (R: the next power of two from the number of shuffle
    partitions), dealt by a hash of its identifier and digest. A run is a partition, sorted by key
    and reduced to one entry per key. Then, in log2(R) / bits_per_round rounds, each run exchanges
    entries with the 2**bits_per_round - 1 runs whose numbers differ from its own in the round's
    bits: an entry goes to the run that has the digest's bits there. What meets is sorted and merged
    in order, keeping the smallest (or largest) identifier and the row count; after the last round a
    digest is in one run only. An entry's key is verified: SHA-256, a second hash and the length must
    all agree before two entries merge. The answer goes back to the first runs and from there to the
    rows by (run, key), so a group that holds a third of all rows is spread over all R runs.

    Null texts count as empty, and all of them are one group. Very long texts are only hashed. Rows
    without identifier are members of their group and stay only where no member has one (then all of
    them are marked kept). Repeated rows with the same identifier are members like any other; each of
    them that carries the kept identifier is marked kept. An empty table gives no rows. Other input
    columns are ignored.

    Returns id_col, keep_id, group_size long, kept boolean, text_sha256 (lowercase hex of the
    normalised text in UTF-8).
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    best, last = (F.min, F.col("_id").isNull()) if keep == "smallest" else (F.max, F.col("_id").isNotNull())
    text = text_or_empty(text_col)
    text = normalise(text) if normalise else text
    bits = (power_of_two(max(8, shuffle_partitions(docs.sparkSession))) - 1).bit_length()
    rows = docs.select(
        F.col(id_col).alias("_id"), F.unhex(F.sha2(text, 256)).alias("_sha"),
        F.xxhash64(text).alias("_check"), F.octet_length(text).alias("_len"),
    ).withColumn("_run", F.pmod(F.xxhash64("_id", "_sha"), F.lit(1 << bits)).cast("int"))
    rows = materialize(rows, "dedup-digests")
    entries = rows.select("_run", *KEY, F.struct(last.alias("last"), F.col("_id").alias("id")).alias("_keep"), F.lit(1).cast("long").alias("_n"))
    start = materialize(_merge(entries, 1 << bits, best), "dedup-runs")
    merged = start
    for low in range(0, bits, bits_per_round):
        mask = ((1 << min(bits, low + bits_per_round)) - 1) & ~((1 << low) - 1)
        to = F.col("_run").bitwiseAND(F.lit(~mask)).bitwiseOR(_slot(bits).bitwiseAND(F.lit(mask)))
        merged = _merge(merged.withColumn("_run", to), 1 << bits, best)
    answer = start.select("_run", *KEY).join(merged.select(*KEY, F.col("_keep.id").alias("_keep"), "_n"), KEY)
    return rows.join(answer, ["_run", *KEY]).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The input without all but one row of each group of equal texts, all its columns kept.

    Of repeated rows with the kept identifier one stays. Rows leave by an anti-join with the
    identifiers of dropped rows, which are few, so unique texts need no digest lookup.
    """
    verdict = exact_dedup(docs, id_col, text_col, keep)
    repeated = verdict.groupBy(id_col).agg(F.count(F.lit(1)).alias("__mr_n"), F.max("kept").alias("__mr_kept"))
    bad = materialize(repeated.where((F.col("__mr_n") > 1) | ~F.col("__mr_kept")).select(F.col(id_col).alias("__mr_bad"), "__mr_kept"), "dedup-dropped")
    clean = docs.join(bad.select("__mr_bad"), docs[id_col].eqNullSafe(F.col("__mr_bad")), "left_anti")
    again = bad.where("__mr_kept").select("__mr_bad")
    if again.isEmpty():
        return clean
    one = docs.join(again, docs[id_col].eqNullSafe(F.col("__mr_bad")), "left_semi")
    wanted = verdict.where("kept").select(F.col(id_col).alias("__mr_kid"), F.col("text_sha256").alias("__mr_ksha")).distinct()
    sha = F.sha2(text_or_empty(text_col), 256)
    one = one.withColumn("__mr_sha", sha).join(wanted, F.col(id_col).eqNullSafe(F.col("__mr_kid")) & (F.col("__mr_sha") == F.col("__mr_ksha")), "left_semi")
    return clean.unionByName(one.dropDuplicates([id_col, "__mr_sha"]).select(*docs.columns))
