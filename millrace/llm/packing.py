"""Lexical retrieval packing: a sharded BM25 index fills each window with unused neighbours."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import joined, materialize, per_worker, small_batches, text_or_empty
from millrace.llm._tokens import word_encoder

#: Tails that share one index; the memory and time of a task follow it, not the input.
SHARD = 512
K1, B = 1.2, 0.75
#: A seed's query: its terms of the highest BM25 weight in it, as many of them.
QUERY_TERMS = 64
TOKENIZED = "doc_id long, doc_tokens long, full array<long>, start long, length int, ids binary, top int"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, seq long, offset long"


def _tokenize(path: str, window: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each text's full windows (their checksums) and the tail behind them (its ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stop = per_worker(("word_encoder", path), lambda: word_encoder(path)), end.to_bytes(4, "little")
        for doc_ids, texts in joined(batches, "doc_id", "_text"):
            rows = []
            for i, ids in zip(doc_ids, encode(texts), strict=True):
                ids += stop
                n = len(ids) // 4
                cut = n // window * window
                tail = np.frombuffer(ids, "<u4", offset=4 * cut)
                full = [zlib.crc32(ids[4 * s : 4 * (s + window)]) for s in range(0, cut, window)]
                rows.append((i, n, full, cut, n - cut, tail.tobytes(), int(tail.max(initial=0))))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in TOKENIZED.split(", ")])

    return run


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many tails of this task each token occurs: a row per token of the vocabulary at most."""
    df = np.zeros(1 << 16, np.int64)
    for b in batches:
        for x in b.column("ids").to_pylist():
            terms = np.unique(np.frombuffer(x, "<u4"))
            if len(terms) and terms[-1] >= len(df):
                df = np.concatenate([df, np.zeros(int(terms[-1]) + 1 - len(df), np.int64)])
            df[terms] += 1
    t = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(df[t], pa.int64())], ["token", "df"])


class Index:
    """An inverted index of one shard: postings by term with their BM25 weight."""

    def __init__(self, tails: list[np.ndarray], idf: Callable[[np.ndarray], np.ndarray], mean: float):
        self.terms, self.n = [], len(tails)
        token, doc, weight = [], [], []
        for d, ids in enumerate(tails):
            t, tf = np.unique(ids, return_counts=True)
            w = idf(t) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / max(mean, 1e-9)))
            self.terms.append(t if len(t) <= QUERY_TERMS else t[np.argsort(-w, kind="stable")[:QUERY_TERMS]])
            token.append(t)
            doc.append(np.full(len(t), d))
            weight.append(w)
        token = np.concatenate(token)
        order = np.argsort(token, kind="stable")
        self.doc, self.weight = np.concatenate(doc)[order], np.concatenate(weight)[order]
        self.vocabulary, first = np.unique(token[order], return_index=True)
        self.bounds = np.append(first, len(token))

    def scores(self, d: int) -> np.ndarray:
        """BM25 of all tails (0 for those that forget() took out) for the query of tail d."""
        at = np.searchsorted(self.vocabulary, self.terms[d])
        low, n = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        take = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.doc[take], self.weight[take], self.n)


    def forget(self, used: np.ndarray) -> None:
        """Take the postings of used tails out of the index."""
        keep = ~used[self.doc]
        self.bounds = np.append(0, np.cumsum(keep))[self.bounds]
        self.doc, self.weight = self.doc[keep], self.weight[keep]


def pack_shard(lengths: list[int], index: Index, window: int) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Windows of (tail, from, length), all full, and what is left over, less than a window.

    The seed is the longest unused tail. Neighbours follow by falling score: first those that fit
    whole, then the best remaining one is cut to fill the window; its rest stays unused.
    """
    at, rest = [0] * len(lengths), np.array(lengths, np.int64)
    full: list[list[tuple[int, int, int]]] = []
    total, held = int(rest.sum()), len(lengths)
    while total >= window:
        seed = int(rest.argmax())
        room, here = window, []

        def use(d: int, n: int) -> None:
            nonlocal room
            here.append((d, at[d], n))
            at[d] += n
            rest[d] -= n
            room -= n

        use(seed, min(int(rest[seed]), room))
        if room:
            unused = np.flatnonzero(rest)
            if len(unused) < held * 0.7:
                index.forget(rest == 0)
                held = len(unused)
            order = unused[np.argsort(-index.scores(seed)[unused], kind="stable")]
            behind = order
            while room and len(fits := np.flatnonzero(rest[behind] <= room)):
                use(int(behind[fits[0]]), int(rest[behind[fits[0]]]))
                behind = behind[fits[0] + 1 :]
            for d in order:
                if not room:
                    break
                if rest[d] > 0:
                    use(int(d), min(int(rest[d]), room))
        full.append(here)
        total -= window
    return full, [(d, at[d], int(rest[d])) for d in range(len(lengths)) if rest[d] > 0]


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _pack(idf: np.ndarray, mean: float, window: int, last: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def lookup(t: np.ndarray) -> np.ndarray:
        return idf[np.minimum(t, len(idf) - 1)]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "length", "ids"], kind="stable").reset_index(drop=True)
        tails = [np.frombuffer(x, "<u4") for x in pdf["ids"]]
        full, left = pack_shard([len(x) for x in tails], Index(tails, lookup, mean), window)
        if last:  # a sequence needs no padding where its length is a power of two
            for n in powers(sum(x[2] for x in left)):
                here = []
                while n:
                    d, s, m = left.pop(0)
                    here.append((d, s, min(m, n)))
                    if m > n:
                        left.insert(0, (d, s + n, m - n))
                    n -= here[-1][2]
                full.append(here)
        ids, start, total, who = tails, pdf["start"].to_numpy(), pdf["doc_tokens"].to_numpy(), pdf["doc_id"].to_numpy()
        out = []
        for k, here in enumerate(full):
            at = 0
            for d, s, n in here:
                out.append((who[d], start[d] + s, n, zlib.crc32(ids[d][s : s + n].tobytes()), total[d], k, at, None))
                at += n
        if not last:
            out += [(who[d], start[d] + s, n, 0, total[d], -1, 0, ids[d][s : s + n].tobytes()) for d, s, n in left]
        frame = pd.DataFrame(out, columns=[x.split()[0] for x in PIECES.split(", ")] + ["ids"])
        return frame.assign(shard=int(key[0]))

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all rows into sequences of at most `window` tokens, one row per piece.

    A row's tokens are its ids plus end_id. Its full windows are sequences of their own; the tail
    behind them is packed. Tails are dealt into shards of about SHARD by their highest token id
    (the rarest word piece, so copies and lexically close texts meet; a frequent one is split by a
    hash of the row, so that neither copies nor repeated identifiers fill one shard). Each shard holds an inverted index with BM25 weights whose
    document frequencies and mean length are those of all tails of the table. Seed after seed takes
    its unused neighbours, all of them ranked by the seed's QUERY_TERMS weightiest terms, until its
    window is full. Less than a window is left per shard; those
    pieces meet in the next round's shards, until the last round's one shard closes with
    sequences of power-of-two lengths. So no sequence needs padding.

    Null texts count as empty: their only token is end_id. Repeated rows are packed each.
    An empty table gives no rows. Frequencies take a number per token of the vocabulary, which
    bounds what reaches the driver. Other input columns are ignored. tokenizer_path must exist on
    all executors.

    Returns doc_id, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,
    offset long.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("_text"))
    table = materialize(texts.mapInArrow(_tokenize(tokenizer_path, window, end_id), TOKENIZED), "pack-tokens")
    whole = table.select("doc_id", "doc_tokens", F.posexplode("full").alias("_pos", "ids_crc32")).select(
        "doc_id", (F.col("_pos") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    rest = table.where("length > 0").select("doc_id", "doc_tokens", "start", "length", "ids", "top")
    stats = rest.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    df = rest.select("ids").mapInArrow(_document_frequencies, "token int, df long").groupBy("token").agg(F.sum("df").alias("df")).toPandas()
    idf = np.zeros(int(df["token"].max()) + 1 if len(df) else 1)
    idf[df["token"].to_numpy("int64")] = np.log(1 + (stats["n"] - df["df"].to_numpy("float64") + 0.5) / (df["df"].to_numpy("float64") + 0.5))

    parts, n, first = [], int(stats["n"]), 0
    while n:
        shards = max(1, math.ceil(n / SHARD))
        dealt = rest.withColumn("_row", F.xxhash64("doc_id", "start", F.monotonically_increasing_id()))  # rest is a written table
        if shards == 1:
            dealt = dealt.withColumn("shard", F.lit(0).cast("long"))
        elif first:
            dealt = dealt.withColumn("shard", F.pmod("_row", F.lit(shards)).cast("long"))
        else:
            per_top = F.broadcast(rest.groupBy("top").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("_sub")))  # a row per token id
            sub = F.pmod(F.col("_row"), F.col("_sub"))
            dealt = dealt.join(per_top, "top").withColumn("shard", F.pmod(F.xxhash64("top", sub), F.lit(shards))).drop("_sub")
        done = dealt.drop("_row", "top").groupBy("shard").applyInPandas(_pack(idf, float(stats["mean"]), window, shards == 1), PIECES + ", ids binary, shard long")
        done = materialize(done, "pack-round")
        parts.append(done.where("seq >= 0").withColumn("sequence_id", ((F.col("shard") + F.lit(first)) * (1 << 20) + F.col("seq")) * 2).drop("shard", "seq", "ids"))
        if shards == 1:
            break
        rest = done.where("seq < 0").select("doc_id", "doc_tokens", "start", F.col("length").cast("int").alias("length"), "ids")
        first, n_before = first + shards, n
        # a round keeps less than a window per shard; its pieces go to far fewer shards
        n = min(rest.count(), n_before)
        if math.ceil(n / SHARD) >= shards:
            n = SHARD * max(1, shards // 2)
    result = whole
    for part in parts:
        result = result.unionByName(part)
    return result
