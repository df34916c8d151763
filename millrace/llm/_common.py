"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import sys
import threading
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Used where no spark.checkpoint.dir is set, which only a local master (one machine) allows.
LOCAL_SHARED = "/tmp/checkpoints/millrace"

#: The column that with_row_key() adds.
ROW = "__mr_row"

#: Text that joined() hands on at a time, beside the batch that reaches it.
BATCH_BYTES = 6_000_000

_local = threading.local()


def _written() -> list[str]:
    """Paths that this thread's operators wrote."""
    return _local.__dict__.setdefault("paths", [])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local master may leave the setting out; a cluster without it is an error,
    since a machine's own temporary folder is invisible to the other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return LOCAL_SHARED


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex}"
    _written().append(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back, which cuts its lineage."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, tag: str) -> DataFrame:
    """df with a column ROW that tells its rows apart, equal ones too; written, so that it stays the same."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), tag)


def mark() -> int:
    """A position in the list of tables written so far, for written_since()."""
    return len(_written())


def written_since(position: int) -> list[str]:
    """The tables that materialize() has written since mark() gave this position."""
    return _written()[position:]


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete tables that materialize() wrote (default: all of this thread).

    Call it only when no DataFrame that reads them will run again.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _written() if paths is None else paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows of an Arrow batch, since single texts can be very long. The setting is the
    session's and is read when a plan runs, after its operator has returned, so it can only be
    lowered here: a caller's smaller number stays."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Return to the system what this worker has freed. Allocators keep it otherwise, and a worker
    lives on through the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def joined(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """The columns' values of as many batches as reach BATCH_BYTES, for work that is done once for
    what repeats. What that work took is given back after each of them."""
    held, n = tuple([] for _ in columns), 0
    for b in batches:
        for values, c in zip(held, columns, strict=True):
            values += b.column(c).to_pylist()
        n += b.nbytes
        if n >= BATCH_BYTES:
            yield held
            held, n = tuple([] for _ in columns), 0
            give_back()
    if held[0]:
        yield held
        del held
        give_back()


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def power_of_two(n: int) -> int:
    """The smallest power of two that is n at least."""
    return 1 << max(0, int(n) - 1).bit_length()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What a Python worker makes once and keeps for its next tasks, until another key is asked
    for: a worker holds one such thing. Functions reach a worker with globals of their own in each
    task, so it is held by a module of the worker's."""
    held = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]
