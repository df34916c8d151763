"""A training corpus from documents: each stage works on what its predecessor kept."""

from __future__ import annotations

import threading
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import ROW, mark, materialize, release, text_or_empty, with_row_key, written_since
from millrace.llm.exact_dedup import drop_exact_copies
from millrace.llm.mixing import mix_sources, repeat_rows
from millrace.llm.ngram_jaccard import jaccard_components
from millrace.llm.packing import pack
from millrace.llm.toxicity import drop_toxic

#: Tables that the stage before wrote for its own use, by thread; no later stage reads them.
_own = threading.local()


def _stage(first: bool = False):
    """A stage begins by deleting what its predecessor wrote for its own use. The first one deletes
    nothing, so a run before, whose result may still be read, keeps its tables."""

    def wrap(f):
        @wraps(f)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if not first:
                release(spark, getattr(_own, "tables", []))
            begin = mark()
            out = f(spark, docs, sf_dir)
            _own.tables = written_since(begin)
            return out

        return run_stage

    return wrap


@_stage(first=True)
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go.

    A row is judged by its text alone, null as empty, whatever its identifier; repeated rows go or
    stay together. Clean, empty and very long documents stay or go by their whole text. An empty
    table stays empty; columns are those of docs."""
    out = drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out


@_stage()
def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; of repeated rows with it, one.

    Null texts count as empty and are one group; where no row of a group has an identifier, one of
    them stays. Very long texts are compared whole. An empty table stays empty; columns are those
    of docs."""
    out = drop_exact_copies(docs, keep="largest")
    return out


@_stage()
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of 5-word-shingle Jaccard 0.8 or more, the row with the smallest doc_id stays
    (null is the largest; of equal ones the smallest digest of the text, then any one of the equal rows).

    Rows are told apart by a key, so null and repeated identifiers neither drop nor keep each other.
    Null and empty texts have no shingles, link with nothing and stay. Very long texts are compared
    whole. An empty table stays empty; columns are those of docs."""
    rows = with_row_key(docs, "near-rows")
    found = jaccard_components(rows, words=5, percent=80, id_col=ROW)
    others = materialize(found.where(F.col(ROW) != F.col("component_id")).select("component_id", ROW), "near-others")
    members = others.unionByName(others.select("component_id", F.col("component_id").alias(ROW)).distinct())
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(text_or_empty(), 256), ROW)
    first = members.join(rows.select(ROW, order.alias("_order")), ROW).groupBy("component_id").agg(F.min("_order")[ROW].alias(ROW))
    drop = members.select(ROW).join(first.select(ROW), ROW, "left_anti")
    out = rows.join(drop, ROW, "left_anti").select(*docs.columns)
    return out


@_stage()
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, three times at most.

    Null sources are one source, the last. Null and empty texts have no words and are never taken.
    Rows are told apart by a key, so repeated rows are each taken for themselves. Very long texts are
    repeated whole. An empty table stays empty; columns are those of docs."""
    rows = with_row_key(docs, "mix-rows")
    out = repeat_rows(rows, mix_sources(rows, row_col=ROW), ROW).select(*docs.columns)
    return out


@_stage()
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, a row each; see pack().

    Null texts count as empty, their only token is the end's; each repeated row is packed, very long
    texts are cut into several sequences, null identifiers are returned as they are. An empty table
    gives no pieces."""
    out = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Classifier, components, rounding and packing are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one keeps is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        docs = materialize(kept, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
