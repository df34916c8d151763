"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialize, n_words, small_batches

#: Rows of one source that one call of the rounding sees.
BUCKET = 1024
#: Residuals that meet in one node of the reduction tree.
FAN_IN = 256
#: More sources than this are refused; the table of sources is held by the driver.
MAX_SOURCES = 100_000


def capped_targets(sizes: Sequence[int], weights: Sequence[float], cap: float = 3.0) -> list[float]:
    """Shares of sum(sizes) by weight, none above cap times its own size; the excess is
    shared again among the others by weight until none is above. cap is 1 at least."""
    if cap < 1:
        raise ValueError("cap must be 1 at least, else the targets can't sum to all sizes")
    out, left, active = [0.0] * len(sizes), float(sum(sizes)), list(range(len(sizes)))
    while active:
        total = sum(weights[i] for i in active)
        over = [i for i in active if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in active:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = cap * sizes[i]
        left -= sum(out[i] for i in over)
        active = [i for i in active if i not in set(over)]
    return out


def pivotal(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Round probabilities p in (0, 1) so that sum(p * size) is kept but for one residual row.

    Two fractional rows exchange mass: one gains what the other loses in p * size, until one of
    them is 0 or 1; which way is drawn with u so that each row's expectation is unchanged.
    Returns p after that and the index of the row still fractional (-1: none).
    """
    p, held = p.copy(), -1
    for i in range(len(p)):
        if not 1e-12 < p[i] < 1 - 1e-12:
            p[i] = round(p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = p[held] * size[held], p[i] * size[i]
        to_held = min(size[held] - a, b)  # mass that can flow from i to held
        to_i = min(a, size[i] - b)
        if u[i] * (to_held + to_i) < to_i:
            a, b = a + to_held, b - to_held
        else:
            a, b = a - to_i, b + to_i
        p[held], p[i] = a / size[held], b / size[i]
        whole_held, whole_i = not 1e-9 < p[held] < 1 - 1e-9, not 1e-9 < p[i] < 1 - 1e-9
        if whole_held:
            p[held] = round(p[held])
        if whole_i:
            p[i] = round(p[i])
        held = -1 if whole_held and whole_i else i if whole_held else held
    return p, held


def _reduce(pdf: pd.DataFrame) -> pd.DataFrame:
    """One node of the tree: round its rows, mark the one left over."""
    pdf = pdf.sort_values(["_u", "_id", "_size"], kind="stable", na_position="last").reset_index(drop=True)
    p, held = pivotal(pdf["_p"].to_numpy("float64"), pdf["_size"].to_numpy("float64"), pdf["_u"].to_numpy("float64"))
    done = np.ones(len(pdf), bool)
    if held >= 0:
        done[held] = False
    return pdf.assign(_p=p, _done=done)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: float = 3.0,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """How often each row is taken so that each source's words come near its target.

    Sources, sorted by code point with null last, take the weights in turn (repeated as needed)
    and share all words of the table by weight; a target stops at cap times its source's words
    and the excess goes to the others. A row of a source wants target / source_size copies: the
    whole part is certain, the fraction is settled by pivotal rounding that keeps the sum of
    words. Rows are dealt into buckets of about BUCKET by a hash of their identifier; each bucket
    leaves one fractional row at most, and residuals are combined FAN_IN at a time up a tree, until
    each source has one, which a hash decides. A source misses its target by less than its
    longest document. All draws are hashes of identifiers, so reruns agree.

    Size is the number of words, 0 for null or empty texts; such rows take 0 words in 0 copies. Very
    long texts are only counted; one that is larger than all else in its source may be its miss.
    Rows that agree in identifier (null is one), text and source are one entry, whose copies are
    shared out evenly among them at the end; draws and buckets go by identifier and text, so no
    identifier fills a bucket. With row_col every row is an entry. An empty table gives no rows. Only the
    table of sources (MAX_SOURCES at most, else an error) reaches the driver.

    Returns id_col, size long, source_size long, target double, taken long, copies long, source, and
    row_col where it is given (a column that tells rows with equal identifiers apart; no draw uses it).
    """
    spark = docs.sparkSession
    small_batches(spark, 8192)
    row = [F.col(row_col).alias("_row")] if row_col else []
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), n_words(text).alias("_size"), F.xxhash64(text).alias("_mark"), F.col(source_col).cast("string").alias("_source"), *row)
    rows = materialize(rows, "mix-sizes")
    same = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_same")) if not row_col else rows.withColumn("_same", F.lit(1).cast("long"))
    table = rows.groupBy("_source").agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(table) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    table = sorted(table, key=lambda r: (r["_source"] is None, r["_source"] or ""))
    sizes = [r["n"] for r in table]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(table))], cap)
    per = [(r["_source"], i, r["n"], t, t / r["n"] if r["n"] else 0.0, max(1, math.ceil(r["rows"] / BUCKET))) for i, (r, t) in enumerate(zip(table, targets, strict=True))]
    schema = "_s string, _k int, _source_size long, _target double, _rate double, _buckets long"
    shares = F.broadcast(spark.createDataFrame(per, schema))  # a row per source
    hashed = lambda salt: F.pmod(F.xxhash64(F.col("_id"), F.col("_mark"), F.lit(seed), F.lit(salt)), F.lit(1 << 40))
    wanted = F.col("_rate") * F.col("_same")
    rows = same.join(shares, F.col("_source").eqNullSafe(F.col("_s"))).select(
        "_id", "_size", "_source", *(["_row"] if row_col else []), "_same", "_k", "_source_size", "_target",
        F.floor(wanted).cast("long").alias("_whole"), (wanted - F.floor(wanted)).alias("_p"),
        (hashed(1) / F.lit(float(1 << 40))).alias("_u"), (hashed(2) % F.col("_buckets")).alias("_node"), "_mark",
    )
    fixed = rows.where((F.col("_size") == 0) | (F.col("_p") <= 1e-12)).withColumn("_p", F.lit(0.0))
    open_rows = rows.where((F.col("_size") > 0) & (F.col("_p") > 1e-12))
    parts = [fixed.drop("_node")]
    nodes, level = max((x[5] for x in per), default=1), 0
    while True:
        schema = ", ".join(f"{n} {t}" for n, t in open_rows.dtypes) + ", _done boolean"
        out = materialize(open_rows.groupBy("_k", "_node").applyInPandas(_reduce, schema), f"mix-level{level}")
        parts.append(out.where("_done").drop("_node", "_done"))
        rest = out.where(~F.col("_done")).drop("_done")
        if nodes <= 1:
            last = F.when(hashed(3) / F.lit(float(1 << 40)) < F.col("_p"), 1.0).otherwise(0.0)
            parts.append(rest.withColumn("_p", last).drop("_node"))
            break
        nodes, level = math.ceil(nodes / FAN_IN), level + 1
        open_rows = rest.withColumn("_node", F.floor(F.col("_node") / FAN_IN))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    all_copies = F.when(F.col("_size") > 0, F.col("_whole") + F.col("_p").cast("long")).otherwise(F.lit(0)).cast("long")
    result = result.withColumn("_all", all_copies).withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_same"))))
    copies = F.expr("_all div _same") + (F.col("_nth") <= F.expr("_all % _same")).cast("long")
    return result.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (copies * F.col("_size")).alias("taken"), copies.alias("copies"), F.col("_source").alias("source"),
        *([F.col("_row").alias(row_col)] if row_col else []),
    )


def repeat_rows(docs: DataFrame, mix: DataFrame, row_col: str) -> DataFrame:
    """The input's rows, each as often as mix says; its columns are unchanged. row_col is what
    mix_sources() had as row_col: a column of docs that tells its rows apart, and is never null.
    Rows that mix lacks or takes 0 times go; a null text is never taken; an empty table stays empty."""
    many = mix.where("copies > 0").select(F.col(row_col).alias("__mr_id"), F.col("copies").cast("int").alias("__mr_copies"))
    both = docs.join(many, docs[row_col] == F.col("__mr_id"))
    return both.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__mr_copies"))).alias("__mr_copy")).drop("__mr_copy")
